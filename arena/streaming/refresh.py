"""Incremental jobs: file streams, late data, page monitoring, growth, re-mapping, versions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from arena.operators.normalise import tier_of
from arena.sources.export import vocabulary_hash

BATCH = "batch_id"


def stored_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of all finished batches; an empty frame before the first one."""
    try:
        return spark.read.schema(f"{schema}, {BATCH} long").parquet(path)
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], f"{schema}, {BATCH} long")


def ingest_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, key: str, partition: str | None = None
) -> None:
    """Appends rows of new files whose key is not stored yet; rerunning adds nothing.

    Each micro-batch owns one ``batch_id`` folder and overwrites it, so a batch
    replayed after a failure leaves the same rows. With ``partition`` (a column
    the key determines, such as its day) a batch reads only the stored
    partitions it touches, so its cost does not grow with the store.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        known = stored_rows(session, target, schema).filter(F.col(BATCH) != batch_id)
        on = [key]
        if partition is not None:
            on.append(partition)
            known = known.join(batch.select(partition).distinct(), partition, "left_semi")
        fresh = batch.dropDuplicates([key]).join(known.select(*on), on, "left_anti")
        writer = fresh.write.mode("overwrite")
        if partition is not None:
            writer = writer.partitionBy(partition)
        writer.parquet(f"{target}/{BATCH}={batch_id}")

    stream = spark.readStream.schema(schema).parquet(source)
    job = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    job.awaitTermination()


BUCKETS = 64  # parts of a day, so that one day is the work of many tasks
DAY_MS = 86_400_000


def _day_state(fields: Sequence[str]):
    """One (day, bucket) of a batch: adds to its totals while the day is open, else hands its rows on as late."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        day, bucket = key
        watermark = state.getCurrentWatermarkMs()
        end = ((day - date(1970, 1, 1)).days + 1) * DAY_MS
        if 0 < watermark and end <= watermark:
            if state.exists:  # the day is over: its totals are in the sink
                state.remove()
            for frame in frames:
                yield frame[list(fields)].assign(day=day, bucket=bucket, late=True, n=None, total=None)
            return
        n, total = state.get if state.exists else (0, 0)
        for frame in frames:
            n, total = n + len(frame), total + int(frame["amount"].sum())
        state.update((n, total))
        yield pd.DataFrame({**{f: [None] for f in fields}, "day": [day], "bucket": [bucket], "late": [False], "n": [n], "total": [total]})

    return step


def daily_totals(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, key: str, lateness_days: int = 14) -> None:
    """Day totals of a file stream, kept as state by event time; a day is open until the watermark passes its end.

    The watermark trails the newest row of earlier batches by ``lateness_days``.
    Totals of open days live in the state store, by (day, bucket of ``key``);
    rows of closed days come out whole. Each micro-batch owns one folder and
    overwrites it, so a replayed batch leaves the same rows. ``schema`` has ts
    and amount.
    """
    fields = [f.strip().split(" ")[0] for f in schema.split(",")]
    events = spark.readStream.schema(schema).parquet(source).withColumn("ts", F.col("ts").cast("timestamp"))
    keyed = events.withWatermark("ts", f"{lateness_days} days").withColumns(
        {"day": F.to_date("ts"), "bucket": F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")}
    )
    out = keyed.groupBy("day", "bucket").applyInPandasWithState(
        _day_state(fields), f"{schema}, day date, bucket int, late boolean, n long, total long", "n long, total long", "update", GroupStateTimeout.NoTimeout
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("late").parquet(f"{target}/{BATCH}={batch_id}")

    job = out.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    job.awaitTermination()


def _day_rows(spark: SparkSession, target: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, day date, bucket int, n long, total long, late boolean, {BATCH} long").parquet(target)


def current_totals(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """day, n, amount: the newest state of every part of a day."""
    rows = _day_rows(spark, target, schema).filter("not late")
    newest = rows.groupBy("day", "bucket").agg(F.max(BATCH).alias(BATCH))
    return rows.join(newest, ["day", "bucket", BATCH], "left_semi").groupBy("day").agg(F.sum("n").alias("n"), F.sum("total").alias("amount"))


def late_rejects(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """Rows that came after their day was closed."""
    return _day_rows(spark, target, schema).filter("late").select(*[f.strip().split(" ")[0] for f in schema.split(",")])


def page_changes(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """baseline / unchanged / changed / noop per page, with the added and removed blocks of a change.

    Both tables: page_id, content_hash, blocks. A new hash over the same set of
    blocks is a noop: nothing to propose.
    """
    old = stored.select("page_id", F.col("content_hash").alias("_hash"), F.col("blocks").alias("_blocks"))
    joined = fetched.join(old, "page_id", "left")
    added, removed = F.array_except("blocks", "_blocks"), F.array_except("_blocks", "blocks")
    status = (
        F.when(F.col("_hash").isNull(), "baseline").when(F.col("_hash") == F.col("content_hash"), "unchanged")
        .when((F.size(added) == 0) & (F.size(removed) == 0), "noop").otherwise("changed")
    )
    diff = lambda a: F.when(status == "changed", a)
    return joined.select("page_id", status.alias("status"), diff(added).alias("added"), diff(removed).alias("removed"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(key, change, field): added and removed members, and changed fields of common ones."""
    o = old.select(*key, F.struct(*fields).alias("_o"))
    n = new.select(*key, F.struct(*fields).alias("_n"))
    joined = o.join(n, list(key), "full_outer")
    changed = F.array_compact(F.array(*[
        F.when(~F.col(f"_o.{f}").eqNullSafe(F.col(f"_n.{f}")), F.struct(F.lit("changed").alias("change"), F.lit(f).alias("field"))) for f in fields
    ]))
    one = lambda what: F.array(F.struct(F.lit(what).alias("change"), F.lit("").alias("field")))
    rows = F.when(F.col("_o").isNull(), one("added")).when(F.col("_n").isNull(), one("removed")).otherwise(changed)
    return joined.select(*key, F.explode(rows).alias("c")).select(*key, "c.change", "c.field")


def new_items(current: DataFrame, previous: DataFrame, key: str, text: str, keywords: str) -> DataFrame:
    """Items the previous snapshot did not have; ``flagged`` when the text has a keyword."""
    return current.join(previous.select(key), key, "left_anti").withColumn("flagged", F.col(text).rlike(keywords))


def detect_increments(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """set_id, kind new / grown / shrunk, expected, current; unchanged sets are absent. Tables: set_id, n."""
    old = stored.select("set_id", F.col("n").alias("current"))
    joined = fresh.select("set_id", F.col("n").alias("expected")).filter(F.col("expected").isNotNull()).join(old, "set_id", "left")
    kind = F.when(F.col("current").isNull(), "new").when(F.col("expected") > F.col("current"), "grown").when(F.col("expected") < F.col("current"), "shrunk")
    return joined.select("set_id", kind.alias("kind"), "expected", "current").filter(F.col("kind").isNotNull())


def recaliber(tournaments: DataFrame, tiers: Sequence[tuple[str, float, list[str]]], stored_hash: str | None) -> tuple[DataFrame, DataFrame]:
    """(competitions with the coefficient of the new vocabulary, one summary row).

    Without drift of the vocabulary hash nothing is rewritten.
    """
    current = vocabulary_hash(tiers)
    if current == stored_hash:
        zero = tournaments.sparkSession.createDataFrame([(False, 0, 0)], "drift boolean, scanned long, changed long")
        return tournaments, zero
    mapped = tier_of(tournaments.withColumnsRenamed({"tier": "_old_tier", "tier_coef": "_old_coef"}), "_old_tier", tiers)
    summary = mapped.agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(~F.col("tier_coef").eqNullSafe(F.col("_old_coef"))).alias("changed")
    ).select(F.lit(True).alias("drift"), "scanned", "changed")
    # the tier label itself is left as it was
    renewed = mapped.drop("tier", "tier_known", "_old_coef").withColumnRenamed("_old_tier", "tier")
    return renewed.select(*tournaments.columns), summary


def write_version(df: DataFrame, root: str, version: int) -> None:
    """A full version in its own folder, then its manifest row: a version without one is incomplete."""
    path = f"{root}/data/version={version}"
    df.write.mode("overwrite").parquet(path)
    rows = df.sparkSession.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    rows.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{root}/manifest/v={version}")


def rollback(spark: SparkSession, root: str, before: int) -> tuple[int, DataFrame]:
    """(version, data) of the newest complete version before ``before`` whose row count still holds."""
    manifest = spark.read.schema("rows long, version int").parquet(f"{root}/manifest").filter(F.col("version") < before)
    for row in manifest.orderBy(F.col("version").desc()).toLocalIterator():
        data = spark.read.parquet(f"{root}/data/version={row['version']}")
        if data.count() == row["rows"]:
            return row["version"], data
    raise LookupError("no consistent earlier version")


def contract_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows one backend has and the other has not, with multiplicity; empty when the contract holds."""
    columns = left.columns
    signed = left.withColumn("_s", F.lit(1)).unionByName(right.select(*columns).withColumn("_s", F.lit(-1)))
    net = signed.groupBy(*columns).agg(F.sum("_s").alias("_net")).filter(F.col("_net") != 0)
    return net.select(F.when(F.col("_net") > 0, "left").otherwise("right").alias("only_in"), F.abs("_net").alias("times"), *columns)


def reingest(fresh: DataFrame, stored: DataFrame, key: str, sets: str, enriched: Mapping[str, str]) -> DataFrame:
    """Fresh rows of a set replace the old ones but keep active status and enriched columns.

    ``enriched``: column -> SQL type. Sets not in ``fresh`` stay as stored.
    """
    old = stored.select(F.col(key).alias("_k"), F.col("status").alias("_status"), *[F.col(c).alias(f"_{c}") for c in enriched])
    joined = fresh.join(old, F.col(key) == F.col("_k"), "left")
    kept = [
        (F.when(F.col("_k").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)) if c in fresh.columns else F.col(f"_{c}").cast(t)).alias(c)
        for c, t in enriched.items()
    ]
    plain = [c for c in fresh.columns if c != "status" and c not in enriched]
    renewed = joined.select(*plain, F.when(F.col("_status") == "active", "active").otherwise(F.col("status")).alias("status"), *kept)
    touched = fresh.select(sets).distinct()
    return stored.join(touched, sets, "left_anti").unionByName(renewed, allowMissingColumns=True)


def replace_children(stored: DataFrame, incoming: DataFrame, parent: str) -> DataFrame:
    """All child rows of the parents in ``incoming`` are replaced, others stay; rerun changes nothing."""
    return stored.join(incoming.select(parent).distinct(), parent, "left_anti").unionByName(incoming)


def unify_sources(channels: Mapping[str, DataFrame], id_columns: Sequence[str]) -> DataFrame:
    """One table of all channels with source-prefixed ids; columns a channel lacks are NULL."""
    out = None
    for source, df in channels.items():
        ids = {c: F.concat(F.lit(f"{source}:"), F.col(c).cast("string")) for c in id_columns if c in df.columns}
        one = df.withColumns(ids).withColumn("source", F.lit(source))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
