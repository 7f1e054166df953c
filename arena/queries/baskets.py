"""Basket queries: gates, mapping, content, top cut and deck rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.functions.parallel import tasks_for
from arena.operators import baskets as k
from arena.operators import normalise as n
from arena.queries.normalise import PAIR_SQL, raw_pairings
from arena.queries.sql import star
from arena.registry import query
from arena.session import stored_rows
from arena.sources import catalogue as c
from arena.sources import tables as b
from arena.sources.tables import Tables, lookup


def line_items(t: Tables) -> DataFrame:
    return b.basket_lines(t)


@query(
    "basket_size_gate",
    """WITH s AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey AS deck_id, n AS total, CASE WHEN n <> 4 THEN 'size' END AS reason, CASE WHEN n = 4 THEN n END AS kept_lines FROM s""",
)
def basket_size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = Tables(spark, sf_dir).lineitem.select(F.col("l_orderkey").alias("deck_id"), F.lit(1).alias("count"))
    kept, blocked = k.size_gate(items, 4)
    good = kept.groupBy("deck_id").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("kept_lines"))
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(blocked, allowMissingColumns=True)


MERGED = """merged AS (
  SELECT deck_id, card_id, min(raw_name) AS raw_name, CAST(sum(cnt) AS BIGINT) AS cnt, stat_scope FROM cards WHERE card_id IS NOT NULL GROUP BY deck_id, card_id, stat_scope
  UNION ALL SELECT deck_id, CAST(NULL AS BIGINT), raw_name, max(cnt), 'other' FROM cards WHERE card_id IS NULL GROUP BY deck_id, raw_name)"""


@query(
    "resolve_items",
    star(MERGED) + "SELECT deck_id, card_id, raw_name, cnt AS copies, stat_scope FROM merged",
)
def resolve_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    names = t.part.select("p_partkey", "p_name")
    items = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").join(names, F.col("l_partkey") == F.col("p_partkey"))
    items = items.select(
        F.col("l_orderkey").alias("deck_id"), F.col("l_partkey").alias("card_id"), F.col("p_name").alias("raw_name"),
        F.col("l_quantity").cast("long").alias("count"),
    )
    known = t.part.filter(F.col("p_size") <= b.MAX_RESOLVED_SIZE).select(
        F.col("p_partkey").alias("card_id"), b.item_scope().alias("stat_scope")
    )
    return k.resolve_items(items, known).withColumnRenamed("count", "copies")


@query(
    "mapped_ratio_status",
    star() + "SELECT deck_id, total, mapped, round(mapped_ratio, 9) AS mapped_ratio, mapping_status FROM decks",
)
def mapped_ratio_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = k.mapping_status(line_items(Tables(spark, sf_dir)))
    return out.withColumn("mapped_ratio", F.round("mapped_ratio", 9))


@query(
    "merge_same_item",
    star(MERGED)
    + """SELECT stat_scope, count(*) AS rows_after, CAST(sum(cnt) AS BIGINT) AS copies, count(card_id) AS mapped_rows, min(raw_name) AS first_name
FROM merged GROUP BY stat_scope""",
)
def merge_same_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = k.merge_same_item(line_items(Tables(spark, sf_dir)).drop("group_key"))
    return merged.groupBy("stat_scope").agg(
        F.count(F.lit(1)).alias("rows_after"), F.sum("count").alias("copies"), F.count("card_id").alias("mapped_rows"),
        F.min("raw_name").alias("first_name"),
    )


@query(
    "content_entity_dedup",
    """WITH l AS (SELECT l_orderkey AS deck_id, p_brand, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
d AS (SELECT deck_id, string_agg(p_brand || 'x' || n, ',' ORDER BY p_brand) AS content FROM l GROUP BY deck_id)
SELECT min(deck_id) AS first_deck, max(deck_id) AS last_deck, count(*) AS appearances FROM d GROUP BY content""",
)
def content_entity_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    part = t.part.select("p_partkey", "p_brand")
    items = t.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("deck_id"), F.col("p_brand").alias("item"), F.lit(1).alias("count")
    )
    entities = k.content_entities(items, "mik_moe", tasks_for(t.lineitem))
    return entities.groupBy("content_id").agg(
        F.min("deck_id").alias("first_deck"), F.max("deck_id").alias("last_deck"), F.count(F.lit(1)).alias("appearances")
    ).drop("content_id")


CUTS = {"master": 32, "super": 16, "advanced": 8}


def tier_entries(t: Tables) -> DataFrame:
    return b.ranked_entries(t).select(
        F.col("o_orderkey").alias("deck_id"), "tournament_id", "rank", "segment",
        F.coalesce(lookup(F.col("segment"), b.SEGMENT_TIER), F.lit("unknown")).alias("tier"),
    )


TIERED = """tiered AS (SELECT a.*, coalesce(tier, 'unknown') AS tier,
  CASE tier WHEN 'master' THEN 32 WHEN 'super' THEN 16 WHEN 'advanced' THEN 8 END AS cut FROM apps a JOIN tours USING (tournament_id))"""


@query(
    "rank_cut_per_tier",
    star(TIERED)
    + "SELECT tier, count(*) FILTER (cut IS NULL OR rank <= cut) AS kept, count(*) FILTER (rank > cut) AS dropped FROM tiered GROUP BY tier",
)
def rank_cut_per_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = n.lookup_table(spark, list(CUTS.items()), "tier string, cut_limit int")
    return k.rank_cut(tier_entries(Tables(spark, sf_dir)), "tier", cuts)[1]


@query(
    "topcut_from_ingested",
    star(TIERED)
    + """SELECT tournament_id, count(*) AS slots FROM tiered t JOIN decks d ON d.deck_id = t.deck_id AND mapping_status = 'full'
WHERE cut IS NULL OR rank <= cut GROUP BY tournament_id""",
)
def topcut_from_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cuts = n.lookup_table(spark, list(CUTS.items()), "tier string, cut_limit int")
    kept, _ = k.rank_cut(tier_entries(t), "tier", cuts)
    full = k.mapping_status(line_items(t)).filter(F.col("mapping_status") == "full").select("deck_id")
    return kept.join(full, "deck_id", "left_semi").groupBy("tournament_id").agg(F.count(F.lit(1)).alias("slots"))


STEPS = [1, 2, 4, 8, 16]


@query(
    "topcut_from_columns",
    star(
        """st AS (SELECT tournament_id, segment, o_orderpriority AS arch,
  count(*) FILTER (rank <= 1) AS c1, count(*) FILTER (rank <= 2) AS c2, count(*) FILTER (rank <= 4) AS c3,
  count(*) FILTER (rank <= 8) AS c4, count(*) FILTER (rank <= 16) AS c5 FROM apps JOIN ord ON o_orderkey = deck_id AND ord.tournament_id = apps.tournament_id
  GROUP BY apps.tournament_id, segment, o_orderpriority)""".replace("SELECT tournament_id, segment", "SELECT apps.tournament_id, ord.segment").replace("apps.tournament_id, segment,", "apps.tournament_id, ord.segment,"),
        """sums AS (SELECT tournament_id, bool_or(segment = 'HOUSEHOLD' AND arch = '5-LOW' AND c1 = 1) AS bad, sum(c1) AS c1,
  sum(CASE WHEN segment = 'FURNITURE' AND arch = '1-URGENT' THEN c2 + 9 ELSE c2 END) AS c2, sum(c3) AS c3, sum(c4) AS c4, sum(c5) AS c5 FROM st GROUP BY tournament_id)""",
        """j AS (SELECT t.*, s.*, CASE WHEN month(date) = 2 THEN 8 END AS slots0 FROM tours t JOIN sums s USING (tournament_id))""",
    )
    + """SELECT tournament_id, outcome, reason, CASE WHEN outcome = 'materialized' THEN CAST(c5 AS BIGINT) END AS slots FROM (
 SELECT *, CASE WHEN reason IS NULL THEN 'materialized' WHEN reason IN ('has_value','team','no_size') THEN 'skipped' ELSE 'question' END AS outcome FROM (
 SELECT *, CASE WHEN slots0 IS NOT NULL THEN 'has_value' WHEN is_team THEN 'team' WHEN coalesce(participant_count, 0) = 0 THEN 'no_size'
   WHEN bad THEN 'malformed' WHEN c1 > c2 OR c2 > c3 OR c3 > c4 OR c4 > c5 THEN 'not_monotone'
   WHEN c5 > participant_count THEN 'larger_than_field' WHEN c5 NOT IN (4, 8, 16, 32) THEN 'size_not_allowed' END AS reason FROM j))""",
)
def topcut_from_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    arch = F.col("o_orderpriority")
    counts = b.ranked_entries(t).groupBy("tournament_id", "segment", "o_orderpriority").agg(
        *[F.count_if(F.col("rank") <= s).alias(f"c{s}") for s in STEPS]
    )
    second = F.when((F.col("segment") == "FURNITURE") & (arch == "1-URGENT"), F.col("c2") + 9).otherwise(F.col("c2"))
    times = F.array(F.col("c1"), second, F.col("c4"), F.col("c8"), F.col("c16"))
    broken = (F.col("segment") == "HOUSEHOLD") & (arch == "5-LOW") & (F.col("c1") == 1)
    static = counts.select("tournament_id", F.when(broken, F.slice(times, 1, 3)).otherwise(times).alias("topcut_times"))
    comps = b.tournaments(t).withColumn("topcut_slots", F.when(F.month("date") == 2, 8))
    return k.topcut_from_columns(static, comps)


@query(
    "topcut_from_pairings",
    f"""WITH {PAIR_SQL} SELECT tournament_id, count(DISTINCT p) AS slots FROM (
  SELECT tournament_id, p1 AS p FROM good WHERE phase = 2 UNION ALL SELECT tournament_id, p2 FROM good WHERE phase = 2) GROUP BY tournament_id""",
)
def topcut_from_pairings(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = n.normalise_pairings(raw_pairings(Tables(spark, sf_dir)), "event_id")
    return k.topcut_from_pairings(good)


@query(
    "collision_last_wins",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, seen FROM (SELECT *,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn,
  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS seen FROM lineitem) WHERE rn = 1""",
)
def collision_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = Tables(spark, sf_dir).lineitem.select(*keys, *order)
    return k.collisions(lines, keys, [F.col(o) for o in order]).drop("l_shipdate")


ENV_MARKS = {"mik_moe": ["E", "F"], "limitless": ["E", "F", "G"], "limitless_site": ["E", "F", "G", "H"]}
MARKS = """marks AS (SELECT l_orderkey AS deck_id, max(CASE WHEN p_type <> 'PROMO' THEN ['E','F','G','H','I'][CAST(ceil(p_size / 10.0) AS INTEGER)] END) AS max_mark
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey)"""


@query(
    "max_mark_crosscheck",
    star(MARKS)
    + """SELECT deck_id, tournament_id, max_mark FROM apps JOIN marks USING (deck_id) JOIN tours USING (tournament_id)
WHERE (source = 'mik_moe' AND max_mark NOT IN ('E','F')) OR (source = 'limitless' AND max_mark NOT IN ('E','F','G'))
   OR (source = 'limitless_site' AND max_mark NOT IN ('E','F','G','H'))""",
)
def max_mark_crosscheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cards = c.catalogue(t).select(F.col("num").alias("card_id"), "mark")
    items = t.lineitem.select(F.col("l_orderkey").alias("deck_id"), F.col("l_partkey").alias("card_id"))
    env = F.lit(None).cast("array<string>")
    for source, marks in ENV_MARKS.items():
        env = F.when(lookup(F.col("segment"), b.SEGMENT_SOURCE) == source, F.array(*[F.lit(m) for m in marks])).otherwise(env)
    entries = b.entries(t).select(F.col("o_orderkey").alias("deck_id"), "tournament_id", env.alias("env_marks"))
    return k.env_mark_warnings(items, cards, entries).select("deck_id", "tournament_id", "max_mark")


def rule_cards(t: Tables) -> DataFrame:
    """part with the columns the deck rules need; parts above the resolved size are unknown."""
    size = F.col("p_size")
    rule = F.when(size % 10 == 0, "radiant").when(size % 10 == 1, "v_union")
    ace = size % 17 == 0
    return t.part.filter(size <= b.MAX_RESOLVED_SIZE).select(
        F.col("p_partkey").alias("card_id"), F.col("p_name").alias("name_full"), rule.alias("rule_box_type"), ace.alias("is_ace_spec"),
        n.deck_limit(rule, ace).alias("deck_limit"), ((F.col("p_type") == "PROMO") & (size % 2 == 0)).alias("is_basic_energy"),
        (F.contains("p_name", F.lit("rod")) & (size % 5 == 2)).alias("is_prism"),
    )


RULES_SQL = """rc AS (SELECT p_partkey AS card_id, p_name AS name_full, CASE WHEN p_size % 10 = 0 THEN 'radiant' WHEN p_size % 10 = 1 THEN 'v_union' END AS rule,
    p_size % 17 = 0 AS ace, CASE WHEN p_size % 17 = 0 OR p_size % 10 IN (0, 1) THEN 1 ELSE 4 END AS lim,
    p_type = 'PROMO' AND p_size % 2 = 0 AS basic, p_name LIKE '%rod%' AND p_size % 5 = 2 AS prism FROM part WHERE p_size <= 48),
ln AS (SELECT l_orderkey AS deck_id, l_partkey AS card_id, CAST(sum(l_linenumber) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2),
gl AS (SELECT name_full, CASE WHEN bool_or(coalesce(rule, '') = 'v_union') THEN 4 ELSE max(lim) END AS glim, bool_and(basic) AS all_basic FROM rc GROUP BY name_full),
jd AS (SELECT ln.*, rc.name_full, rule, ace, lim, basic, prism FROM ln LEFT JOIN rc USING (card_id)),
gd AS (SELECT jd.*, glim FROM jd JOIN gl ON gl.name_full = jd.name_full WHERE NOT all_basic),
viol AS (
  SELECT deck_id, 'deck_size' AS kind, '' AS subject, CAST(sum(n) AS BIGINT) AS cnt, '' AS cards FROM jd GROUP BY deck_id HAVING sum(n) <> 16
  UNION ALL SELECT deck_id, 'unknown_card', '', count(*), string_agg(card_id::VARCHAR, ',' ORDER BY card_id::VARCHAR) FROM jd WHERE name_full IS NULL GROUP BY deck_id
  UNION ALL SELECT deck_id, 'ace_spec_limit', '', CAST(sum(n) AS BIGINT), string_agg(card_id::VARCHAR, ',' ORDER BY card_id::VARCHAR) FROM jd WHERE ace GROUP BY deck_id HAVING sum(n) > 1
  UNION ALL SELECT deck_id, 'radiant_limit', '', CAST(sum(n) AS BIGINT), string_agg(card_id::VARCHAR, ',' ORDER BY card_id::VARCHAR) FROM jd WHERE rule = 'radiant' GROUP BY deck_id HAVING sum(n) > 1
  UNION ALL SELECT deck_id, 'prism_star_limit', '', CAST(sum(n) AS BIGINT), string_agg(card_id::VARCHAR, ',' ORDER BY card_id::VARCHAR) FROM jd WHERE prism GROUP BY deck_id HAVING sum(n) > 1
  UNION ALL SELECT deck_id, 'name_limit', CAST(card_id AS VARCHAR), n, CAST(card_id AS VARCHAR) FROM gd WHERE n > lim AND lim < glim
  UNION ALL SELECT deck_id, 'name_limit', name_full, CAST(sum(n) AS BIGINT), string_agg(card_id::VARCHAR, ',' ORDER BY card_id::VARCHAR) FROM gd GROUP BY deck_id, name_full, glim HAVING sum(n) > glim)"""


def rule_baskets(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("deck_id"), F.col("l_partkey").alias("card_id"), F.col("l_linenumber").cast("long").alias("count")
    )


@query("basket_rule_violations", f"WITH {RULES_SQL} SELECT deck_id, kind, subject, cnt AS copies, cards FROM viol")
def basket_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    baskets, rules = rule_baskets(t), stored_rules(t)
    tasks = tasks_for(t.lineitem)
    counted = stored_rows(k.counted_violations(k.judged_baskets(baskets, rules, 16, tasks)), "rule-violations")
    found = k.with_cards(counted, baskets, rules, tasks)
    return found.withColumnRenamed("count", "copies").withColumn("cards", F.array_join("cards", ","))


def stored_rules(t: Tables, decisions: DataFrame | None = None) -> DataFrame:
    """The rule table of the catalogue, written once: the catalogue is read for it and not again."""
    cards = stored_rows(rule_cards(t), "rule-cards")
    return stored_rows(k.rule_table(cards, cards.select("card_id", F.col("name_full").alias("group_key")), decisions), "rule-table")


@query(
    "delimited_items",
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem)
SELECT l_orderkey AS deck_id, 'g' || l_linenumber AS grp, CAST(l_partkey AS VARCHAR) AS official_id, q AS copies,
  CASE WHEN l_partkey % 4 <> 0 THEN 'part ' || l_partkey END AS item_name, CASE WHEN l_partkey % 4 = 1 THEN 'S' || l_linenumber END AS raw_set,
  CASE WHEN l_partkey % 4 = 1 THEN '0' || l_partkey END AS raw_number, CASE WHEN l_partkey % 4 = 1 THEN '300' END AS raw_total FROM l
UNION ALL SELECT l_orderkey, 'g' || l_linenumber, 's' || l_suppkey, l_linenumber, NULL, NULL, NULL, NULL FROM l WHERE l_linenumber <> 2""",
)
def delimited_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")
    first = F.concat_ws("_", part, F.col("l_quantity").cast("int").cast("string"), F.lit("1"))
    second = F.concat_ws("_", F.concat(F.lit("s"), F.col("l_suppkey").cast("string")), F.when(line == "2", "x").otherwise(line), F.lit("0"))
    value = F.concat_ws("-", first, second, F.lit(""), F.lit("junk"))
    lines = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    groups = lines.select(F.col("l_orderkey").alias("deck_id"), F.concat(F.lit("g"), line).alias("group"), value.alias("value"))
    suffix = F.concat(F.lit("(S"), line, F.lit(" 0"), part, F.lit("/300)"))
    # the name table of a page knows only some ids, and one name per id
    names = lines.filter(F.col("l_partkey") % 4 != 0).select(
        F.col("l_orderkey").alias("deck_id"), F.concat(F.lit("g"), line).alias("_g"), part.alias("official_id"),
        F.concat(F.lit("part "), part, F.when(F.col("l_partkey") % 4 == 1, suffix).otherwise(F.lit(""))).alias("raw_name"),
    )
    items = k.delimited_items(groups)
    scoped = items.withColumn("deck_id", F.concat_ws("|", F.col("deck_id").cast("string"), "group"))
    scoped_names = names.select(F.concat_ws("|", F.col("deck_id").cast("string"), "_g").alias("deck_id"), "official_id", "raw_name").distinct()
    full, _ = k.named_items(scoped, scoped_names)
    return full.select(
        F.split("deck_id", r"\|")[0].cast("long").alias("deck_id"), F.col("group").alias("grp"), "official_id",
        F.col("count").cast("long").alias("copies"), "item_name", "raw_set", "raw_number", "raw_total",
    )
