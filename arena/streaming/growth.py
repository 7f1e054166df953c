"""Catalogue growth as a staged publish by set.

A store keeps cards as immutable runs of whole sets, and a version as a table of
pointers (set -> run). A growth run normalises the touched sets, stages them, lets
all checks judge what was staged, and points at the runs of the clean sets; item
rows of newly resolved misses and the text overrides follow. Nothing of that is
visible before the manifest row of the version is written, so a run that dies, or
a set that is blocked, leaves no trace. Costs follow the touched sets and baskets.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.functions.rank import quantile_splits
from arena.operators import baskets as k
from arena.operators import checks as ch
from arena.operators import legality as lg
from arena.operators import normalise as n
from arena.operators import quality as q
from arena.operators import resolve as r
from arena.session import stored_rows
from arena.streaming.refresh import detect_increments, reingest

MANIFEST = "version long, data_version string, activated long, attempted long, resolved long, decks_affected long, decks_upgraded long"
POINTERS = "set_id string, run string, expected long, cards long"
ITEMS = "deck_id long, card_id string, raw_name string, count long, stat_scope string"
OVERRIDES = "snapshot_id string, card_id string, target string"


@dataclass(frozen=True)
class Store:
    """A versioned catalogue below ``root`` with its item rows and overrides."""

    spark: SparkSession
    root: str

    def version(self) -> int | None:
        """The newest version that has its manifest row."""
        rows = self._read("manifest", MANIFEST)
        return None if rows is None else rows.agg(F.max("version")).first()[0]

    def _read(self, name: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except Exception as error:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")

    def pointers(self) -> DataFrame:
        return self.spark.read.schema(POINTERS).parquet(f"{self.root}/pointers/version={self.version()}")

    def cards(self) -> DataFrame:
        """Published cards; a draft that is pointed at is active. Only the runs that are pointed at are read."""
        shown = self.staged().join(self.pointers().select("run", "set_id"), ["run", "set_id"], "left_semi")
        return shown.drop("run").withColumn("status", F.lit("active"))

    def staged(self) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.root}/cards").parquet(f"{self.root}/cards")

    def items(self) -> DataFrame:
        """Item rows: those of the newest published version of each basket."""
        now = self.version()
        rows = self.spark.read.schema(f"{ITEMS}, version long").parquet(f"{self.root}/items").filter(F.col("version") <= now)
        changed = rows.filter(F.col("version") > 0)
        newest = changed.groupBy("deck_id").agg(F.max("version").alias("version"))
        base = rows.filter(F.col("version") == 0).join(newest.select("deck_id"), "deck_id", "left_anti")
        return base.unionByName(changed.join(newest, ["deck_id", "version"], "left_semi")).drop("version")

    def overrides(self) -> DataFrame:
        return self.spark.read.schema(OVERRIDES).parquet(f"{self.root}/overrides/version={self.version()}")

    def stage(self, cards: DataFrame) -> str:
        """Writes whole sets as a new run, which no version points at yet."""
        run = uuid.uuid4().hex
        # few files a set, and a large set still is written by several tasks
        cards.hint("rebalance", "set_id").write.partitionBy("set_id").parquet(f"{self.root}/cards/run={run}")
        return run

    def note(self, run: str, name: str, df: DataFrame) -> DataFrame:
        """Rows of a run kept beside it: computed once, and the reason of what was blocked."""
        path = f"{self.root}/runs/run={run}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def run(self, run: str) -> DataFrame:
        return self.staged().filter(F.col("run") == run).drop("run")

    def publish(self, version: int, pointers: DataFrame, overrides: DataFrame, row: tuple, items: DataFrame | None = None) -> None:
        """All tables of a version, and its manifest row last."""
        pointers.select(*[f.split()[0] for f in POINTERS.split(", ")]).write.mode("overwrite").parquet(f"{self.root}/pointers/version={version}")
        overrides.write.mode("overwrite").parquet(f"{self.root}/overrides/version={version}")
        if items is not None:
            items.write.mode("overwrite").parquet(f"{self.root}/items/version={version}")
        self.spark.createDataFrame([(version, *row)], MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/version={version}")


def seed(store: Store, cards: DataFrame, expected: DataFrame, items: DataFrame, overrides: DataFrame, data_version: str) -> None:
    """Version 0 of a store. ``expected``: set_id, expected."""
    run = store.stage(cards)
    counts = store.run(run).groupBy("set_id").agg(F.count(F.lit(1)).alias("cards"))
    pointers = expected.join(counts, "set_id").withColumn("run", F.lit(run))
    store.publish(0, pointers, overrides, (data_version, 0, 0, 0, 0, 0), items)


def ordered_cards(raw: DataFrame) -> DataFrame:
    """Normalised cards of raw records (column ``r``) with a numeric order ``seq``; letter numbers come after all others."""
    cards, _ = n.normalise_cards(raw.select("r"))
    cards = cards.withColumn("name_ja", F.lit(None).cast("string"))
    seq = F.coalesce(F.col("number").try_cast("double"), F.lit(1e9) + F.pmod(F.xxhash64("number"), F.lit(10**9)))
    return cards.withColumn("seq", seq)


def drafts(raw: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Normalised cards of raw records (set_id, number, r) with their parent and order.

    Parents are looked for in the drafts' own sets, then in all drafts and ``known`` cards.
    """
    # every step of the lookup reads the cards: the records are normalised once
    cards = stored_rows(ordered_cards(raw), "drafts")
    lookup = lambda df, parent: df.select(
        "card_id", "set_id", "name_full", F.when(F.col("card_type") == "pokemon", F.col("species")).alias("species"), parent.alias("parent_name")
    )
    pool = lookup(cards, F.col("evolves_from_text"))
    if known is not None:
        pool = pool.unionByName(lookup(known.join(cards.select("card_id"), "card_id", "left_anti"), F.lit(None).cast("string")))
    parents = r.resolve_parents(pool).select(F.col("card_id").alias("_child"), F.col("parent_id").alias("evolves_from_id"))
    return cards.join(parents, F.col("card_id") == F.col("_child"), "left").drop("_child")


def union_relations(cards: DataFrame, splits: Sequence[float]) -> DataFrame:
    """card_id, related_id: parts of one union name in a set, four by four in order."""
    parts = cards.filter(F.col("rule_box_type") == "v_union").select("set_id", "name_full", "seq", "card_id")
    edges = q.chunks_of(parts, ["set_id", "name_full"], "seq", splits).withColumnRenamed("hub", "_hub")
    hubs = parts.select(F.col("set_id").alias("_s"), F.col("name_full").alias("_n"), F.col("seq").alias("_hub"), F.col("card_id").alias("related_id"))
    own = parts.join(edges, ["set_id", "name_full", "seq"])
    same = (F.col("set_id") == F.col("_s")) & (F.col("name_full") == F.col("_n")) & (own["_hub"] == hubs["_hub"])
    return own.join(hubs, same).select("card_id", "related_id")


def judged(store: Store, run: str, raw: DataFrame, known: DataFrame, voc: ch.Vocabulary | None = None) -> DataFrame:
    """Failures of a staged run under all checks; ids of the published catalogue are known parents."""
    cards = store.run(run)
    splits = quantile_splits(cards, "seq")
    ids = known.select("card_id").unionByName(cards.select("card_id"))
    return ch.run(cards, raw, ids, union_relations(cards, splits), "seq", splits, voc)


def resolved_misses(items: DataFrame, fresh: DataFrame, name_column: str = "name_en") -> DataFrame:
    """deck_id, raw_name, card_id, stat_scope of open items that a new card (with its release) resolves, by the name chain.

    An open name had no card before, so only names of new cards can resolve it.
    """
    names = items.filter(F.col("card_id").isNull()).select(F.col("raw_name").alias("name")).distinct()
    probes = names.withColumn("env_marks", F.lit(None).cast("array<string>"))
    index = r.name_index(fresh.withColumnRenamed("regulation_mark", "mark"), name_column)
    hits = r.map_by_name(probes, index, F.lit("name_fallback")).filter(F.col("card_id").isNotNull()).select(F.col("name").alias("raw_name"), "card_id")
    scope = fresh.select("card_id", n.stat_scope(F.col("card_type"), F.col("trainer_subtype")).alias("stat_scope"))
    found = hits.join(scope, "card_id")
    return items.filter(F.col("card_id").isNull()).select("deck_id", "raw_name").join(found, "raw_name")


@dataclass(frozen=True)
class Growth:
    """``sets``: set_id, kind, expected, current, state, rules; ``version``: the published one, or None without a change."""

    sets: DataFrame
    version: int | None


def grow(
    store: Store, products: DataFrame, raw: DataFrame, releases: DataFrame, snapshots: DataFrame, whitelists: DataFrame, data_version: str,
    *, dry_run: bool = False, voc: ch.Vocabulary | None = None,
) -> Growth:
    """One growth run: detect, normalise, stage, check, point, resolve misses, renew overrides, publish.

    ``products``: set_id, n (size upstream); ``raw``: set_id, number, r;
    ``releases``: set_id, release_date; ``snapshots``: snapshot_id,
    effective_to; ``whitelists``: snapshot_id, group_key (a card name).
    """
    pointers = store.pointers()
    found = detect_increments(products, pointers.select("set_id", F.col("expected").alias("n")))
    suspicious = F.when(F.col("kind") == "shrunk", "suspicious")
    rules = F.lit(None).cast("string")
    touched = found.filter(F.col("kind") != "shrunk").select("set_id")
    if dry_run or touched.isEmpty():
        return Growth(found.withColumn("state", F.coalesce(suspicious, F.lit("detected"))).withColumn("rules", rules), None)

    published = store.cards()
    records = raw.join(touched, "set_id", "left_semi")
    fresh = drafts(records, published)
    stored = published.join(touched, "set_id", "left_semi")
    renewed = reingest(fresh, stored, "card_id", "set_id", {"name_ja": "string"})
    run = store.stage(renewed.join(touched, "set_id", "left_semi"))
    failures = store.note(run, "failures", judged(store, run, records, published, voc))
    verdict = q.activation_gate(store.run(run), failures)[1]
    broken = failures.groupBy("set_id").agg(F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("rules"))
    state = F.coalesce(suspicious, F.when(F.col("rules").isNotNull(), "blocked"), F.lit("activated"))
    sets = found.join(broken, "set_id", "left").withColumn("state", state).select("set_id", "kind", "expected", "current", "state", "rules")
    sets = store.note(run, "sets", sets)
    active = sets.filter(F.col("state") == "activated").join(verdict.filter("passed"), "set_id", "left_semi").select("set_id", "expected")
    if active.isEmpty():
        return Growth(sets, None)

    counts = store.run(run).groupBy("set_id").agg(F.count(F.lit(1)).alias("cards"))
    moved = active.join(counts, "set_id").withColumn("run", F.lit(run))
    after_pointers = pointers.join(active, "set_id", "left_anti").unionByName(moved)
    mine = store.run(run).join(active, "set_id", "left_semi")
    after = published.join(active, "set_id", "left_anti").unionByName(mine, allowMissingColumns=True)

    gained = mine.join(published.select("card_id"), "card_id", "left_anti").join(releases, "set_id", "left")
    items = store.items()
    misses = store.note(run, "misses", items.filter(F.col("card_id").isNull()).select("deck_id", "card_id", "raw_name"))
    resolved = store.note(run, "resolved", resolved_misses(misses, gained))
    # a basket without a hit keeps its items and its status: all items are dealt out once, and only baskets with a hit go on
    touched = store.note(run, "touched", items.join(resolved.select("deck_id").distinct(), "deck_id", "left_semi"))
    changed, status = k.remap_misses(touched, resolved)
    stats = status.agg(
        F.sum("resolved").alias("resolved"), F.count_if(F.col("resolved") > 0).alias("affected"),
        F.count_if((F.col("status_before") != "full") & (F.col("mapping_status") == "full")).alias("upgraded"),
    ).first()

    dated = after.join(releases, "set_id", "left")
    latest = lg.latest_print_overrides(dated, dated.select("card_id", F.col("name_full").alias("group_key")))
    overrides = lg.refresh_overrides(snapshots, whitelists, store.overrides(), latest)
    version = store.version() + 1
    row = (data_version, active.count(), misses.count(), *[int(stats[c] or 0) for c in ("resolved", "affected", "upgraded")])
    store.publish(version, after_pointers, overrides, row, changed.select(*[f.split()[0] for f in ITEMS.split(", ")]))
    return Growth(sets, version)
