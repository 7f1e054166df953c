"""Readers of the driver tables and their binding to the competition model.

competition = order month and customer segment, entry = order, basket = its
line items, item group = part brand. ``Star`` holds the five tables the metrics
need; real data can be put into it directly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arena.functions.rank import quantile_splits, split_rank
from arena.operators.baskets import mapping_status, with_status
from arena.session import stored_rows, stored_together


@dataclass(frozen=True)
class Star:
    """tournaments, decks, appearances, deck_cards, card_groups (None: group_key is in deck_cards)."""

    tournaments: DataFrame
    decks: DataFrame
    appearances: DataFrame
    deck_cards: DataFrame
    card_groups: DataFrame | None = None


class Tables:
    """Lazy access to the parquet tables of one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._schemas: dict[str, StructType] = {}

    def __getattr__(self, name: str) -> DataFrame:
        """A fresh scan each time; the schema is read from the files once."""
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.sf_dir}/{name}.parquet"
        if name in self._schemas:
            return self.spark.read.schema(self._schemas[name]).parquet(path)
        table = self.spark.read.parquet(path)
        self._schemas[name] = table.schema
        return table


def day_text(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def lookup(col: Column, mapping: dict[str, object]) -> Column:
    """Value of a fixed map as a CASE expression; NULL when the key is unknown."""
    out = None
    for key, value in mapping.items():
        cond, val = col == F.lit(key), F.lit(value)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


SEGMENT_TIER = {"AUTOMOBILE": "master", "BUILDING": "super", "FURNITURE": "advanced", "HOUSEHOLD": "city"}
SEGMENT_COEF = {"AUTOMOBILE": 4.0, "BUILDING": 2.0, "FURNITURE": 1.5, "HOUSEHOLD": 1.0}
SEGMENT_SOURCE = {
    "AUTOMOBILE": "mik_moe",
    "BUILDING": "limitless",
    "FURNITURE": "limitless_site",
    "HOUSEHOLD": "pokemon_card_jp",
    "MACHINERY": "mik_moe",
}
MAX_RESOLVED_SIZE = 48  # larger parts play the role of unresolved items


Window = tuple[str, str]  # first and last day of the competitions that are asked for


def months_of(window: Window) -> tuple[str, str]:
    """First day of the first month, and of the month after the last one: whole competitions, as ids hold the month."""
    year, month = int(window[1][:4]), int(window[1][5:7])
    after = (year + 1, 1) if month == 12 else (year, month + 1)
    return f"{window[0][:7]}-01", f"{after[0]:04d}-{after[1]:02d}-01"


def orders_of(t: Tables, window: Window | None) -> DataFrame:
    """Orders of the months of a window; the bounds reach the scan."""
    if window is None:
        return t.orders
    first, after = months_of(window)
    stamp = t.orders.schema["o_orderdate"].dataType
    return t.orders.filter((F.col("o_orderdate") >= F.lit(first).cast(stamp)) & (F.col("o_orderdate") < F.lit(after).cast(stamp)))


def entries(t: Tables, window: Window | None = None) -> DataFrame:
    """orders with competition id, segment and day."""
    orders = orders_of(t, window).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.to_date("o_orderdate").alias("day"),
    )
    customer = t.customer.select("c_custkey", "c_mktsegment")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    tid = F.concat(F.date_format("day", "yyyy-MM"), F.lit(":"), F.col("c_mktsegment"))
    return joined.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "day",
        F.col("c_mktsegment").alias("segment"), tid.alias("tournament_id"),
    )


def tournaments(t: Tables, window: Window | None = None) -> DataFrame:
    return tournaments_of(entries(t, window))


def tournaments_of(played: DataFrame) -> DataFrame:
    """Competitions of entry rows."""
    agg = played.groupBy("tournament_id", "segment").agg(
        F.max("day").alias("date"), F.count_distinct("o_custkey").alias("buyers")
    )
    month, year = F.month("date"), F.year("date")
    seg = F.col("segment")
    return agg.select(
        "tournament_id",
        F.concat(F.lit("Cup "), F.col("tournament_id")).alias("name"),
        lookup(seg, SEGMENT_SOURCE).alias("source"),
        lookup(seg, SEGMENT_TIER).alias("tier"),
        lookup(seg, SEGMENT_COEF).alias("tier_coef"),
        F.when(month % 2 == 1, F.lit(None)).when(year % 2 == 0, "master").otherwise("senior").alias("division"),
        "date",
        F.when(month != 7, F.col("buyers")).alias("participant_count"),
        F.when(month != 2, F.lit(8)).alias("topcut_slots"),
        (month == 1).alias("is_qual"),
        ((month == 12) & (seg == "HOUSEHOLD")).alias("is_team"),
    )


def item_scope() -> Column:
    kind = F.col("p_type")
    return (
        F.when(F.col("p_size") > MAX_RESOLVED_SIZE, "other")
        .when(kind.isin("ECONOMY", "STANDARD"), "pokemon")
        .when(kind.isin("SMALL", "MEDIUM"), "supporter")
        .when(kind == "LARGE", "stadium")
        .otherwise("other")
    )


def lines_of(t: Tables, window: Window | None) -> DataFrame:
    """Line items of the orders of a window, before anything is aggregated or joined."""
    if window is None:
        return t.lineitem
    keys = orders_of(t, window).select(F.col("o_orderkey").alias("l_orderkey"))
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag").join(keys, "l_orderkey", "left_semi")


def basket_lines(t: Tables, window: Window | None = None) -> DataFrame:
    """One row per line item with the catalogue columns the baskets need."""
    lines = lines_of(t, window).select("l_orderkey", "l_partkey", F.col("l_quantity").cast("long").alias("copies"))
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    resolved = F.col("p_size") <= MAX_RESOLVED_SIZE
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("deck_id"),
        F.when(resolved, F.col("l_partkey")).alias("card_id"),
        F.col("p_name").alias("raw_name"),
        F.when(resolved, F.col("p_brand")).alias("group_key"),
        item_scope().alias("stat_scope"),
        F.col("copies").alias("count"),
    )


def records(t: Tables, window: Window | None = None) -> DataFrame:
    flag = F.col("l_returnflag")
    return lines_of(t, window).groupBy(F.col("l_orderkey").alias("deck_id")).agg(
        F.count_if(flag == "R").alias("w"),
        F.count_if(flag == "A").alias("l"),
        F.count_if(flag == "N").alias("t"),
    )


def ranked_entries(t: Tables, window: Window | None = None) -> DataFrame:
    """Entries ranked by price inside each competition; a hot competition is split by price range."""
    splits, ties = quantile_splits(orders_of(t, window), "o_totalprice", "o_orderkey")
    return split_rank(
        entries(t, window), ["tournament_id"], "o_totalprice", splits=splits, desc=True, tie=["o_orderkey"], tie_splits=ties, name="rank"
    )


def appearances(t: Tables, window: Window | None = None) -> DataFrame:
    return appearances_of(ranked_entries(t, window), records(t, window))


def appearances_of(ranked: DataFrame, results: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Entry rows with their points and record. ``results``: deck_id, w, l, t and ``more``."""
    status = F.col("o_orderstatus")
    points = F.when(status == "O", F.lit(0.0)).when(status == "F", F.col("o_totalprice") / 1000)
    played = status != "P"
    joined = ranked.withColumnRenamed("o_orderkey", "deck_id").join(results, "deck_id", "left")
    result = [
        F.when(played, F.coalesce(F.col(c), F.lit(0))).alias(n)
        for c, n in (("w", "record_wins"), ("l", "record_losses"), ("t", "record_ties"))
    ]
    return joined.select(
        "deck_id", "tournament_id", "rank", points.alias("points"), *result,
        lookup(F.col("segment"), SEGMENT_SOURCE).alias("source"), *more,
    )


def basket_star(t: Tables, window: Window | None = None) -> Star:
    """The driver tables as a star; item groups are already carried by the basket rows.

    With a window, only whole competitions of its months are read, and only once:
    the entries of those months and their baskets by group are written to the
    scratch folder, and everything else comes from these two tables.
    """
    if window is not None:
        played = stored_rows(entries(t, window), "star-entries")
        return star_of(t, played)
    cards = basket_lines(t)
    return Star(tournaments(t), mapping_status(cards), appearances(t), cards)


def group_lines(t: Tables, played: DataFrame) -> DataFrame:
    """One row per (basket, group, scope): copies and games of the line items of the entries ``played``; one pass."""
    keys = played.select(F.col("o_orderkey").alias("l_orderkey"))
    lines = t.lineitem.select("l_orderkey", "l_partkey", F.col("l_quantity").cast("long").alias("copies"), "l_returnflag").join(keys, "l_orderkey", "left_semi")
    part = t.part.select("p_partkey", "p_brand", "p_type", "p_size")
    resolved, flag = F.col("p_size") <= MAX_RESOLVED_SIZE, F.col("l_returnflag")
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy(
        F.col("l_orderkey").alias("deck_id"), F.when(resolved, F.col("p_brand")).alias("group_key"), item_scope().alias("stat_scope")
    ).agg(
        F.sum("copies").alias("count"), F.count_if(flag == "R").alias("w"), F.count_if(flag == "A").alias("l"), F.count_if(flag == "N").alias("t")
    )


def ranks_of(played: DataFrame) -> DataFrame:
    """Entry rows with their rank by price inside the competition."""
    splits, ties = quantile_splits(played, "o_totalprice", "o_orderkey")
    return split_rank(played, ["tournament_id"], "o_totalprice", splits=splits, desc=True, tie=["o_orderkey"], tie_splits=ties, name="rank")


def star_of(t: Tables, played: DataFrame) -> Star:
    """A star from entries and the baskets they played; a part that has a group is a resolved one.

    Baskets by group, ranks and competitions need the entries alone and are
    written at the same time; entries with rank, record and mapping state after them.
    """
    made = stored_together(
        played.sparkSession, star_groups=lambda: group_lines(t, played), star_ranks=lambda: ranks_of(played),
        star_competitions=lambda: tournaments_of(played),
    )
    groups = made["star_groups"]
    cards = groups.select("deck_id", F.col("group_key").alias("card_id"), "group_key", "stat_scope", "count")
    in_group = F.col("group_key").isNotNull()
    per_deck = groups.groupBy("deck_id").agg(
        *[F.sum(c).alias(c) for c in ("w", "l", "t")], F.sum("count").alias("total"), F.sum(F.when(in_group, F.col("count")).otherwise(0)).alias("mapped")
    )
    full = stored_rows(appearances_of(made["star_ranks"], per_deck, ("total", "mapped")), "star-appearances")
    decks = with_status(full.filter("total is not null").select("deck_id", "total", "mapped"))
    return Star(made["star_competitions"], decks, full.drop("total", "mapped"), cards)


def calendar_star(t: Tables, window: Window | None = None) -> Star:
    """A star for what reads competitions alone: no ranks are prepared."""
    none = t.orders.limit(0)
    return Star(tournaments(t, window), none, none, none)
