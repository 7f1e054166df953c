"""Resolution queries: prints, names, bridges, vocabularies, misses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.operators import baskets as k
from arena.operators import resolve as r
from arena.queries.sql import star
from arena.registry import query
from arena.session import stored_rows
from arena.sources import catalogue as c
from arena.sources import tables as b
from arena.sources.tables import Tables

CAT = """cat AS (SELECT p_brand || '-' || p_partkey AS card_id, p_partkey AS num, p_brand AS set_id, CAST(p_partkey AS VARCHAR) AS number,
  p_name AS name_full, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS species,
  CASE WHEN p_type IN ('ECONOMY','STANDARD') THEN 'pokemon' WHEN p_type = 'PROMO' THEN 'energy' ELSE 'trainer' END AS card_type,
  CASE p_type WHEN 'SMALL' THEN '支援者' WHEN 'MEDIUM' THEN '物品' WHEN 'LARGE' THEN '竞技场' END AS trainer_subtype,
  CASE WHEN p_type <> 'PROMO' THEN ['E','F','G','H','I'][CAST(ceil(p_size / 10.0) AS INTEGER)] END AS mark,
  CASE WHEN p_partkey % 50 <> 0 THEN DATE '1995-01-01' + CAST(p_partkey * 37 % 2400 AS INTEGER) END AS release_date,
  p_type = 'PROMO' AND p_size % 2 = 0 AS basic, p_size AS size, p_retailprice AS price FROM part)"""


def text_key(col, width):
    return F.lpad(col.cast("string"), width, "0")


LOC = """prints AS (SELECT p_brand AS s, p_partkey % 100 AS nn, min_by(p_name, p_partkey) AS located_name FROM part GROUP BY 1, 2)"""


def located_lines(t: Tables) -> DataFrame:
    """lineitem as raw (set, number) references with differently padded numbers."""
    short = F.col("l_partkey") % 100
    number = (
        F.when(F.col("l_linenumber") % 3 == 0, text_key(short, 3)).when(F.col("l_linenumber") % 3 == 1, text_key(short, 6))
        .otherwise(short.cast("string"))
    )
    items = t.lineitem.select(
        F.col("l_orderkey").alias("deck_id"), F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 30).cast("string")).alias("raw_set"),
        number.alias("raw_number"),
    )
    uses = items.groupBy("raw_set", "raw_number").agg(F.count(F.lit(1)).alias("uses"))
    prints = t.part.select(
        F.col("p_brand").alias("set_code"), text_key(F.col("p_partkey") % 100, 2).alias("number"),
        F.col("p_name").alias("located_name"), F.col("p_partkey").alias("seq"),
    )
    return r.locate_prints(uses, r.print_index(prints, "seq"))


@query(
    "printing_lookup_padded",
    f"""WITH {LOC}, l AS (SELECT 'Brand#' || (l_suppkey % 30) AS raw_set, l_partkey % 100 AS nn,
  CASE l_linenumber % 3 WHEN 0 THEN lpad(CAST(l_partkey % 100 AS VARCHAR), 3, '0') WHEN 1 THEN lpad(CAST(l_partkey % 100 AS VARCHAR), 6, '0')
    ELSE CAST(l_partkey % 100 AS VARCHAR) END AS raw_number, count(*) AS uses FROM lineitem GROUP BY 1, 2, 3)
SELECT raw_set, raw_number, uses, located_name FROM l LEFT JOIN prints ON s = raw_set AND prints.nn = l.nn""",
)
def printing_lookup_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return located_lines(Tables(spark, sf_dir))


@query(
    "classify_miss",
    f"""WITH {LOC}, l AS (SELECT 'Brand#' || (l_suppkey % 30) AS raw_set, l_partkey % 100 AS nn FROM lineitem)
SELECT CASE WHEN located_name IS NULL THEN 'ptcd_miss' ELSE 'no_cn_printing' END AS miss_kind, count(*) AS items
FROM l LEFT JOIN prints ON s = raw_set AND prints.nn = l.nn GROUP BY 1""",
)
def classify_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = located_lines(Tables(spark, sf_dir))
    return located.groupBy(k.classify_miss(F.col("located_name")).alias("miss_kind")).agg(F.sum("uses").alias("items"))


def name_probes(t: Tables) -> DataFrame:
    part = t.part.select("p_partkey", "p_name")
    joined = t.lineitem.select("l_partkey", "l_linenumber", "l_returnflag", "l_suppkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    name = (
        F.when(line == 2, F.concat(F.lit("Basic "), "p_name")).when(line == 3, F.concat("p_name", F.lit(" (Boss)")))
        .when(line == 4, F.concat(F.lit("Basic "), "p_name", F.lit(" (x)"))).otherwise(F.col("p_name"))
    )
    marks = F.when(flag == "A", F.array(F.lit("E"), F.lit("F"))).when(flag == "R", F.array(F.lit("I")))
    stage = F.when(F.col("l_suppkey") % 2 == 0, "ptcd").otherwise("name_fallback")
    return joined.select(name.alias("name"), marks.alias("env_marks"), stage.alias("stage"))


CHAIN = f"""{CAT}, probes AS (SELECT CASE l_linenumber WHEN 2 THEN 'Basic ' || p_name WHEN 3 THEN p_name || ' (Boss)' WHEN 4 THEN 'Basic ' || p_name || ' (x)' ELSE p_name END AS name,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE p_name END AS hit, l_linenumber IN (2) AS basic, l_linenumber = 3 AS paren,
  CASE l_returnflag WHEN 'A' THEN 'EF' WHEN 'R' THEN 'I' ELSE '' END AS env, CASE WHEN l_suppkey % 2 = 0 THEN 'ptcd' ELSE 'name_fallback' END AS stage, count(*) AS uses
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
best AS (SELECT name_full, e.env, count(*) AS n, bool_or(coalesce(e.env <> '' AND contains(e.env, mark), false)) AS in_env,
  first(card_id ORDER BY coalesce(e.env <> '' AND contains(e.env, mark), false) DESC, release_date DESC NULLS LAST, card_id) AS card_id
  FROM cat, (VALUES ('EF'), ('I'), ('')) e(env) GROUP BY name_full, e.env),
mapped AS (SELECT name, p.env, stage, uses, card_id, CASE WHEN card_id IS NULL THEN 'unmapped' ELSE concat_ws('+', stage,
    CASE WHEN basic THEN 'basic_energy_alias' WHEN paren THEN 'paren_strip' END, CASE WHEN n = 1 THEN 'unique' WHEN in_env THEN 'env+latest' ELSE 'latest' END) END AS rule
  FROM probes p LEFT JOIN best ON name_full = hit AND best.env = p.env)"""


@query("name_chain_match", f"WITH {CHAIN} SELECT name, env, stage, uses, card_id, rule FROM mapped")
def name_chain_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    probes = name_probes(t).groupBy("name", "env_marks", "stage").agg(F.count(F.lit(1)).alias("uses"))
    index = r.name_index(c.catalogue(t), "name_full")
    out = r.map_by_name(probes, index, F.col("stage"))
    return out.select("name", F.coalesce(F.array_join("env_marks", ""), F.lit("")).alias("env"), "stage", "uses", "card_id", "rule")


@query("rule_distribution", f"WITH {CHAIN} SELECT rule, CAST(sum(uses) AS BIGINT) AS n FROM mapped GROUP BY rule")
def rule_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    index = r.name_index(c.catalogue(t), "name_full")
    return k.rule_distribution(r.map_by_name(name_probes(t), index, F.col("stage")))


@query(
    "arbitrate_candidates",
    f"""WITH {CAT} SELECT name_full AS name, first(card_id ORDER BY coalesce(mark IN ('G','H'), false) DESC, release_date DESC NULLS LAST, card_id) AS card_id,
  count(*) AS candidates FROM cat GROUP BY name_full""",
)
def arbitrate_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = c.catalogue(Tables(spark, sf_dir))
    names = cat.groupBy(F.col("name_full").alias("name")).agg(F.count(F.lit(1)).alias("candidates")).withColumn(
        "env_marks", F.array(F.lit("G"), F.lit("H"))
    )
    return r.map_by_name(names, r.name_index(cat, "name_full"), F.lit("ptcd")).select("name", "card_id", "candidates")


@query(
    "same_group_arbitration",
    f"""WITH {CAT}, j AS (SELECT *, CASE WHEN size = 50 THEN 'only ' || num WHEN size % 2 = 0 THEN name_full ELSE species END AS ja FROM cat),
p AS (SELECT DISTINCT CASE WHEN size = 7 THEN '' WHEN size = 9 THEN 'none' ELSE ja END AS name FROM j),
g AS (SELECT ja, count(*) AS n, count(DISTINCT name_full) AS groups, bool_or(coalesce(mark IN ('F','I'), false)) AS in_env,
  first(card_id ORDER BY coalesce(mark IN ('F','I'), false) DESC, release_date DESC NULLS LAST, card_id) AS best FROM j GROUP BY ja)
SELECT name, CASE WHEN name <> '' AND (n = 1 OR groups = 1) THEN best END AS card_id,
  CASE WHEN name = '' THEN 'unknown_card_id' WHEN n IS NULL THEN 'ja_name+unmapped' WHEN n = 1 THEN 'ja_name+unique' WHEN groups > 1 THEN 'ja_name+ambiguous'
       WHEN in_env THEN 'ja_name+group_env' ELSE 'ja_name+group_latest' END AS rule FROM p LEFT JOIN g ON ja = name""",
)
def same_group_arbitration(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size")
    ja = F.when(size == 50, F.concat(F.lit("only "), "number")).when(size % 2 == 0, F.col("name_full")).otherwise(F.col("species"))
    cat = c.catalogue(Tables(spark, sf_dir)).withColumn("name_ja", ja)
    name = F.when(size == 7, "").when(size == 9, "none").otherwise(F.col("name_ja"))
    probes = cat.select(name.alias("name")).distinct().withColumn("env_marks", F.array(F.lit("F"), F.lit("I")))
    return r.map_within_group(probes, r.name_index(cat, "name_ja", "name_full")).drop("env_marks")


def open_misses(t: Tables) -> DataFrame:
    part = t.part.filter(F.col("p_size") > b.MAX_RESOLVED_SIZE).select("p_partkey", "p_name")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("l_orderkey").alias("deck_id"), F.col("p_name").alias("raw_name"),
        F.when(F.col("l_suppkey") % 3 != 0, F.concat(F.lit("S"), (F.col("l_suppkey") % 3).cast("string"))).alias("raw_set"),
        F.col("l_partkey").cast("string").alias("raw_number"), "l_linenumber", "l_partkey",
    )


@query(
    "record_misses",
    """WITH m AS (SELECT l_orderkey AS deck_id, p_name AS raw_name, CASE WHEN l_suppkey % 3 <> 0 THEN 'S' || (l_suppkey % 3) ELSE '' END AS raw_set,
  CAST(l_partkey AS VARCHAR) AS raw_number, l_partkey, bool_or(l_linenumber <= 4) AS stored, bool_or(l_linenumber >= 3) AS found
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 48 GROUP BY 1, 2, 3, 4, 5)
SELECT deck_id, raw_name, raw_set, raw_number, CASE WHEN found AND (NOT stored OR l_partkey % 2 = 1) THEN 'no_cn_printing' ELSE 'ptcd_miss' END AS miss_kind,
  CASE WHEN stored THEN '2001-01-01' ELSE '2001-08-01' END AS first_seen, CASE WHEN NOT stored THEN 'new' WHEN found AND l_partkey % 2 = 1 THEN 'refreshed' ELSE 'kept' END AS action
FROM m WHERE stored OR found""",
)
def record_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    misses = open_misses(Tables(spark, sf_dir))
    day = lambda d: F.lit(d).cast("date")
    stored = misses.filter(F.col("l_linenumber") <= 4).select(
        "deck_id", "raw_name", F.coalesce("raw_set", F.lit("")).alias("raw_set"), "raw_number", F.lit(None).cast("string").alias("resolved_name"),
        F.lit("ptcd_miss").alias("miss_kind"), F.lit(None).cast("string").alias("resolved_card_id"),
        day("2001-01-01").alias("first_seen_at"), F.when(F.col("l_partkey") % 2 == 0, day("2001-02-01")).alias("resolved_at"),
    ).distinct()
    found = misses.filter(F.col("l_linenumber") >= 3).select(
        "deck_id", "raw_name", "raw_set", "raw_number", F.col("raw_name").alias("resolved_name"), F.lit("no_cn_printing").alias("miss_kind")
    )
    out = k.record_misses(stored, found, day("2001-08-01"))
    return out.select(*k.MISS_KEY, "miss_kind", F.date_format("first_seen_at", "yyyy-MM-dd").alias("first_seen"), "action")


@query(
    "backfill_misses",
    star()
    + """, pend AS (SELECT DISTINCT deck_id, raw_name FROM cards WHERE card_id IS NULL),
raw AS (SELECT l_orderkey AS deck_id, p_name AS raw_name, 'S' || (l_suppkey % 9) AS raw_set, CAST(l_partkey AS VARCHAR) AS raw_number,
  row_number() OVER (PARTITION BY l_orderkey, p_name ORDER BY l_linenumber, l_suppkey, l_partkey) AS rn
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <= 5)
SELECT deck_id, raw_name, raw_set, raw_number, raw_set IS NOT NULL AS located FROM pend LEFT JOIN (SELECT * FROM raw WHERE rn = 1) USING (deck_id, raw_name)""",
)
def backfill_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    part = t.part.select("p_partkey", "p_name")
    lines = t.lineitem.filter(F.col("l_linenumber") <= 5).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    raw = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("deck_id"), F.col("p_name").alias("raw_name"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 9).cast("string")).alias("raw_set"), F.col("l_partkey").cast("string").alias("raw_number"),
        F.struct("l_linenumber", "l_suppkey", "l_partkey").alias("seq"),
    )
    return k.backfill_misses(b.basket_lines(t), raw, "seq")


@query(
    "remap_misses",
    star(
        """fresh AS (SELECT p_name AS raw_name, min(p_partkey) AS card_id FROM part WHERE p_size <= 48 AND p_name LIKE '%ring%' GROUP BY 1)""",
        """m0 AS (SELECT deck_id, card_id, CAST(sum(cnt) AS BIGINT) AS cnt FROM cards WHERE card_id IS NOT NULL GROUP BY 1, 2
  UNION ALL SELECT deck_id, NULL, max(cnt) FROM cards WHERE card_id IS NULL GROUP BY deck_id, raw_name)""",
        """m1 AS (SELECT deck_id, card_id, cnt FROM m0 WHERE card_id IS NOT NULL UNION ALL
  SELECT o.deck_id, f.card_id, o.cnt FROM (SELECT deck_id, raw_name, max(cnt) AS cnt FROM cards WHERE card_id IS NULL GROUP BY 1, 2) o LEFT JOIN fresh f USING (raw_name))""",
        """s0 AS (SELECT deck_id, sum(CASE WHEN card_id IS NOT NULL THEN cnt ELSE 0 END) * 1.0::DOUBLE / sum(cnt) AS ratio FROM m0 GROUP BY 1)""",
        """s1 AS (SELECT deck_id, CAST(sum(cnt) AS BIGINT) AS total, CAST(sum(CASE WHEN card_id IS NOT NULL THEN cnt ELSE 0 END) AS BIGINT) AS mapped FROM m1 GROUP BY 1)""",
    )
    + """SELECT deck_id, total, mapped, CASE WHEN ratio >= 0.95 THEN 'full' WHEN ratio > 0 THEN 'partial' ELSE 'unmapped' END AS status_before,
  CASE WHEN mapped * 1.0::DOUBLE / total >= 0.95 THEN 'full' WHEN mapped > 0 THEN 'partial' ELSE 'unmapped' END AS mapping_status FROM s0 JOIN s1 USING (deck_id)""",
)
def remap_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every basket before and after names found later: one pass over the lines, and only new names meet open items."""
    t = Tables(spark, sf_dir)
    lines = b.basket_lines(t)
    open_name = F.when(F.col("card_id").isNull(), F.col("raw_name"))
    items = lines.groupBy("deck_id", "card_id", open_name.alias("raw_name")).agg(
        F.when(F.col("card_id").isNull(), F.max("count")).otherwise(F.sum("count")).alias("count")
    )
    fresh = t.part.filter((F.col("p_size") <= b.MAX_RESOLVED_SIZE) & F.contains("p_name", F.lit("ring"))).groupBy(F.col("p_name").alias("raw_name")).agg(
        F.min("p_partkey").alias("_card")
    )
    status = k.remap_status(items.join(fresh, "raw_name", "left"))
    return status.select("deck_id", "total", "mapped", "status_before", "mapping_status")


@query(
    "set_bridge_by_name",
    """WITH o AS (SELECT DISTINCT p_brand AS code, p_name AS name FROM part), t AS (SELECT p_name, 'x' || min(p_partkey) AS id FROM part GROUP BY p_name),
n AS (SELECT code, id, row_number() OVER (PARTITION BY code ORDER BY length(name), name) AS rn FROM o JOIN t ON p_name = name)
SELECT code, CASE WHEN code = 'Brand#3' THEN 'fixed' ELSE max(id) FILTER (rn = 1) END AS main_id, max(id) FILTER (rn = 2) AS subset_id FROM n GROUP BY code""",
)
def set_bridge_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part
    ours = part.select(F.col("p_brand").alias("code"), F.col("p_name").alias("name")).distinct()
    theirs = part.groupBy("p_name").agg(F.min("p_partkey").alias("k")).select(
        F.concat(F.lit("x"), F.col("k").cast("string")).alias("set_id"), F.upper(F.regexp_replace("p_name", " ", "-")).alias("name")
    )
    return r.set_bridge(ours, theirs, [("Brand#3", "fixed")])


@query(
    "multi_variant_resolve",
    """SELECT p_partkey AS num, CASE WHEN p_brand = 'Brand#25' THEN 'unmapped_set' WHEN p_partkey % 5 = 4 OR p_partkey % 10 = 2 THEN 'missing_card'
  WHEN p_partkey % 13 = 0 THEN 'name_mismatch' ELSE 'resolved' END AS outcome,
  CASE WHEN p_brand <> 'Brand#25' AND NOT (p_partkey % 5 = 4 OR p_partkey % 10 = 2) THEN 'c' || p_partkey END AS target_id FROM part""",
)
def multi_variant_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part.select("p_partkey", "p_name", "p_brand")
    num, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    pad3 = F.when(F.length(text) >= 3, text).otherwise(F.lpad(text, 3, "0"))
    local = (
        F.when(num % 5 == 0, text).when(num % 5 == 1, pad3).when(num % 5 == 2, F.concat(F.lit("SM"), text))
        .when(num % 5 == 3, F.concat(F.lit("GG"), pad3))
    )
    home = F.concat(F.when((num % 5 == 3) & (num % 2 == 0), "s").otherwise("m"), "p_brand")
    cards = part.select(
        home.alias("set_id"), F.explode(F.array_compact(F.array(local, F.when(num % 10 == 2, F.concat(F.lit("XY"), text))))).alias("local_id"),
        F.concat(F.lit("c"), text).alias("card_id"), F.upper("p_name").alias("card_name"),
    )
    items = part.select(
        "p_partkey", F.col("p_brand").alias("set_code"), F.when(num % 5 == 3, F.concat(F.lit("GG"), text)).otherwise(text).alias("number"),
        F.when(num % 13 == 0, "other").otherwise(F.initcap("p_name")).alias("name"),
    )
    bridge = part.filter(F.col("p_brand") != "Brand#25").select(
        F.col("p_brand").alias("code"), F.concat(F.lit("m"), "p_brand").alias("main_id"), F.concat(F.lit("s"), "p_brand").alias("subset_id")
    ).distinct()
    return r.resolve_variants(items, bridge, cards).select(F.col("p_partkey").alias("num"), "outcome", "target_id")


@query(
    "names_equivalent_check",
    "SELECT p_partkey, p_partkey % 9 <> 0 AS same FROM part",
)
def names_equivalent_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part
    ours = F.concat(F.initcap(F.regexp_replace("p_name", " ", "-")), F.when(F.col("p_size") % 2 == 0, " Prism Star").otherwise(""))
    theirs = F.concat("p_name", F.when(F.col("p_partkey") % 9 == 0, " two").otherwise(""), F.lit(" ◇ (Poké)"))
    return part.select("p_partkey", r.names_equivalent(ours, theirs).alias("same"))


@query(
    "flag_enrichment",
    """WITH f AS (SELECT s_suppkey % 20 AS e, s_suppkey % 100 AS nn, bool_or(s_acctbal > 5000) AS flag FROM supplier GROUP BY 1, 2),
c AS (SELECT p_partkey, p_size % 2 = 0 AS old, CASE WHEN p_partkey % 6 <> 0 THEN CAST(substr(p_brand, 7) AS INTEGER) END AS e, p_partkey % 100 AS nn FROM part)
SELECT p_partkey AS card_id, CASE WHEN c.e < 20 AND flag IS NOT NULL THEN flag ELSE old END AS flag,
  CASE WHEN c.e IS NULL THEN 'no_bridge' WHEN c.e >= 20 THEN 'unmapped_set' WHEN flag IS NULL THEN 'missing_card' WHEN flag THEN 'flagged' ELSE 'resolved_negative' END AS state
FROM c LEFT JOIN f ON f.e = c.e AND f.nn = c.nn""",
)
def flag_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    num = F.col("p_partkey")
    cards = t.part.select(num.alias("card_id"), (F.col("p_size") % 2 == 0).alias("flag"))
    bridges = t.part.filter(num % 6 != 0).select(
        num.alias("card_id"), F.col("p_brand").alias("set_code"), F.lpad((num % 100).cast("string"), 3, "0").alias("ext_number")
    )
    code = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    set_map = t.part.select(F.col("p_brand").alias("set_code"), F.when(code < 20, F.concat(F.lit("e"), code.cast("string"))).alias("ext_set")).distinct()
    flags = t.supplier.select(
        F.concat(F.lit("e"), (F.col("s_suppkey") % 20).cast("string")).alias("ext_set"), (F.col("s_suppkey") % 100).cast("string").alias("number"),
        (F.col("s_acctbal") > 5000).alias("flag"),
    )
    return r.enrich_flag(cards.withColumnRenamed("flag", "flag"), bridges, set_map, flags.withColumnRenamed("flag", "flag"))


@query(
    "species_pool_match",
    """SELECT p_partkey AS card_id, CASE WHEN p_partkey % 7 = 0 THEN NULL
  WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 'ジム' || upper(split_part(p_name, ' ', 2)) || 'X☆'
  WHEN p_partkey % 4 = 0 THEN 'ゴーの' || upper(split_part(p_name, ' ', 1)) || '&' || upper(split_part(p_name, ' ', 2))
  ELSE upper(split_part(p_name, ' ', 1)) || '&' || upper(split_part(p_name, ' ', 2)) || ' 後' END AS translated FROM part""",
)
def species_pool_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part
    words = part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("name"))
    species = words.groupBy("name").agg(F.min("p_partkey").alias("k"), F.max("p_partkey").alias("k2")).select(
        "name", (F.xxhash64("name") % 1000000).alias("dex"), F.upper("name").alias("translated")
    )
    first, second, num = F.split("p_name", " ")[0], F.split("p_name", " ")[1], F.col("p_partkey")
    dex = lambda w: F.xxhash64(w) % 1000000
    # the prefix 'Gym', owner 'Bo', suffix ' star', modifier 'Late' and variant letter of the rules
    name = (
        F.when(num % 5 == 0, F.concat(F.lit("Gym "), F.initcap(second), F.lit(" X star")))
        .when(num % 4 == 0, F.concat(F.lit("Bo's "), first, F.lit(" & "), second))
        .otherwise(F.concat(first, F.lit(" & Late "), F.upper(second)))
    )
    pool = F.when(num % 7 == 0, F.array(F.lit(-1).cast("long"))).when(num % 11 == 0, F.array().cast("array<bigint>")).otherwise(F.array(dex(second), dex(first)))
    broken = F.when((num % 11 == 0) & (num % 5 == 0), "Gym nobody").otherwise(name)
    cards = part.select(num.alias("card_id"), broken.alias("name"), pool.alias("dex_ids"))
    rules = r.NameRules(prefixes={"Gym": "ジム"}, suffixes={" star": "☆"}, modifiers={"Late": "後"}, owners={"Bo": "ゴー"})
    return r.compose_names(cards, species, rules)


@query(
    "dex_index_bridge",
    """WITH i AS (SELECT p_brand, p_partkey % 50 AS nn, max(p_partkey) AS last FROM part WHERE p_size > 10 GROUP BY 1, 2)
SELECT p.p_partkey AS card_id, i.last || ',' || (i.last + 1) AS ids FROM part p LEFT JOIN i ON i.p_brand = p.p_brand AND i.nn = p.p_partkey % 50 AND p.p_brand <> 'Brand#9'""",
)
def dex_index_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part
    num = F.col("p_partkey")
    cards = part.select(
        num.alias("card_id"), F.concat(F.lit("t-"), "p_brand").alias("set_id"), F.concat(F.lit("tg"), F.lpad((num % 50).cast("string"), 2, "0")).alias("local_id")
    )
    set_map = part.filter(F.col("p_brand") != "Brand#9").select(F.lower("p_brand").alias("ext_set"), F.concat(F.lit("t-"), "p_brand").alias("set_id")).distinct()
    ids = part.filter(F.col("p_size") > 10).select(
        F.lower("p_brand").alias("ext_set"), F.concat(F.lit("TG"), (num % 50).cast("string")).alias("number"), F.array(num, num + 1).alias("ids"), num.alias("seq")
    )
    out = r.bridge_ids(cards, set_map, ids, "seq")
    return out.select("card_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


VOCAB = """vc AS (SELECT p_partkey AS card_id, p_name AS name_full, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_size = 50 THEN 'solo ' || p_name
  ELSE split_part(p_name, ' ', 2) || (p_size % 3) END AS name_en, CASE WHEN p_partkey % 7 = 0 THEN 'J-' || p_name WHEN p_partkey % 8 = 1 THEN 'old' END AS name_ja FROM part),
vocab AS (SELECT DISTINCT name_en AS en, CASE WHEN name_en LIKE '%1' THEN 'J-' || name_full WHEN name_en LIKE 'solo %' THEN 'J-' || name_full ELSE 'J' END AS ja,
  CASE WHEN name_en LIKE '%1' THEN name_full END AS cn FROM vc WHERE name_en IS NOT NULL AND (name_en LIKE '%0' OR name_en LIKE 'solo %' OR (name_en LIKE '%1' AND name_full < 'm'))),
sp AS (SELECT name_en, count(DISTINCT name_full) AS k FROM vc GROUP BY name_en), op AS (SELECT en, bool_or(cn IS NULL) AS open FROM vocab GROUP BY en),
vj AS (SELECT vc.*, o.en AS in_vocab, o.open AND sp.k > 1 AS amb, v.ja, v.cn FROM vc LEFT JOIN op o ON o.en = vc.name_en LEFT JOIN sp ON sp.name_en = vc.name_en
  LEFT JOIN vocab v ON v.en = vc.name_en AND (v.cn IS NULL OR v.cn = vc.name_full) AND NOT (o.open AND sp.k > 1))"""


def vocab_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    num, name = F.col("p_partkey"), F.col("p_name")
    english = F.when(num % 10 != 0, F.when(F.col("p_size") == 50, F.concat(F.lit("solo "), name)).otherwise(
        F.concat(F.split(name, " ")[1], (F.col("p_size") % 3).cast("string"))
    ))
    cards = t.part.select(
        num.alias("card_id"), name.alias("name_full"), english.alias("name_en"),
        F.when(num % 7 == 0, F.concat(F.lit("J-"), name)).when(num % 8 == 1, "old").alias("name_ja"),
    )
    en, full = F.col("name_en"), F.col("name_full")
    numbered, solo = en.endswith("1"), en.startswith("solo ")
    vocab = cards.filter(en.isNotNull() & (en.endswith("0") | solo | (numbered & (full < "m")))).select(
        en.alias("en"), F.when(numbered | solo, F.concat(F.lit("J-"), full)).otherwise("J").alias("ja"), F.when(numbered, full).alias("cn")
    ).distinct()
    return cards, vocab


@query(
    "vocab_fill_with_ambiguity",
    f"""WITH {VOCAB} SELECT card_id, coalesce(name_ja, ja) AS name_ja, CASE WHEN name_en IS NULL THEN 'no_en_bridge' WHEN in_vocab IS NULL THEN 'vocab_miss'
  WHEN amb THEN 'ambiguous' WHEN ja IS NULL THEN 'vocab_miss' WHEN name_ja IS NULL THEN 'filled' WHEN name_ja = ja THEN 'already' ELSE 'conflict' END AS state FROM vj""",
)
def vocab_fill_with_ambiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.vocab_fill(*vocab_tables(Tables(spark, sf_dir)))[0]


@query(
    "vocab_anchor_check",
    f"""WITH {VOCAB}, u AS (SELECT v.en, coalesce(v.cn, '') AS cn, count(j.card_id) AS cards FROM vocab v LEFT JOIN vj j ON j.name_en = v.en AND j.ja IS NOT NULL AND j.cn IS NOT DISTINCT FROM v.cn GROUP BY ALL)
SELECT 'unused' AS finding, en, cn FROM u WHERE cards = 0
UNION ALL SELECT 'not_anchored', en, coalesce(cn, '') FROM vocab WHERE en NOT LIKE '%g%' AND ja NOT IN (SELECT 'J-' || p_name FROM part WHERE p_size % 5 = 0)""",
)
def vocab_anchor_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cards, vocab = vocab_tables(t)
    usage = r.vocab_fill(cards, vocab)[1].filter(F.col("cards") == 0)
    names = t.part.filter(F.col("p_size") % 5 == 0).select(F.concat(F.lit("J-"), "p_name").alias("name"))
    loose = r.vocab_anchor_check(vocab.withColumn("exempt", F.contains("en", F.lit("g"))), names)
    label = lambda df, what: df.select(F.lit(what).alias("finding"), "en", F.coalesce("cn", F.lit("")).alias("cn"))
    return label(usage, "unused").unionByName(label(loose, "not_anchored"))


@query(
    "english_bridge_fill",
    """SELECT p_brand AS set_id, count(*) FILTER (p_partkey % 9 <> 0) AS mapped, count(*) AS total,
  count(*) FILTER (p_partkey % 9 <> 0 AND p_partkey % 2 = 0) AS already, count(*) FILTER (p_partkey % 9 = 0) AS no_bridge FROM part GROUP BY p_brand""",
)
def english_bridge_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part
    num = F.col("p_partkey")
    cards = part.select(num.alias("card_id"), F.col("p_brand").alias("set_id"), F.when(num % 2 == 0, F.upper("p_name")).alias("name_en"))
    bridge = part.filter(num % 9 != 0).select(num.alias("card_id"), F.upper("p_name").alias("bridged_name"), F.concat(F.lit("E-"), num.cast("string")).alias("external_id"))
    out, coverage = r.bridge_fill(cards, bridge)
    states = out.groupBy("set_id").agg(F.count_if(F.col("state") == "already").alias("already"), F.count_if(F.col("state") == "no_bridge").alias("no_bridge"))
    return coverage.join(states, "set_id")


@query(
    "set_reconcile_outer",
    """WITH o AS (SELECT c_nationkey AS k, 'NATION_' || c_nationkey AS name, count(*) AS n FROM customer WHERE c_nationkey <> 4 GROUP BY 1),
t AS (SELECT c_nationkey AS k, CASE WHEN c_nationkey = 5 THEN 'Other' ELSE 'NATION_' || c_nationkey END AS name,
  count(*) FILTER (c_nationkey % 3 <> 0 OR c_custkey % 20 <> 0) AS n FROM customer WHERE c_nationkey <> 3 GROUP BY 1)
SELECT coalesce(o.k, t.k) AS set_id, o.n AS our_n, t.n AS their_n, CASE WHEN o.k IS NULL THEN 'missing_in_ours' WHEN t.k IS NULL THEN 'missing_in_theirs'
  WHEN o.n <> t.n THEN 'count_diff' WHEN o.name <> t.name THEN 'name_diff' ELSE 'ok' END AS status FROM o FULL JOIN t ON o.k = t.k""",
)
def set_reconcile_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    key, nation = F.col("c_nationkey"), t.nation.select("n_nationkey", "n_name")
    ours = t.customer.filter(key != 4).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).join(nation, key == F.col("n_nationkey")).select(
        key.alias("set_id"), F.col("n_name").alias("name"), "n"
    )
    theirs = t.customer.filter(key != 3).groupBy("c_nationkey").agg(F.count_if((key % 3 != 0) | (F.col("c_custkey") % 20 != 0)).alias("n")).join(
        nation, key == F.col("n_nationkey")
    ).select(key.alias("set_id"), F.when(key == 5, "Other").otherwise(F.col("n_name")).alias("name"), "n")
    return r.reconcile_sets(ours, theirs)


@query(
    "parent_resolution",
    f"""WITH {CAT}, p AS (SELECT *, CASE WHEN card_type = 'pokemon' THEN species END AS sp, CASE WHEN num % 5 = 0 THEN NULL WHEN num % 4 = 0 THEN 'red rod' WHEN num % 3 = 0 THEN name_full
  WHEN num % 3 = 1 THEN species ELSE 'fossil' END AS parent FROM cat),
q AS (SELECT num, (SELECT min(o.num) FROM p o WHERE o.set_id = p.set_id AND o.name_full = p.parent AND o.num <> p.num) AS a,
  EXISTS (SELECT 1 FROM p o WHERE o.set_id = p.set_id AND o.name_full = p.parent) AS a_any,
  (SELECT min(o.num) FROM p o WHERE o.set_id = p.set_id AND o.sp = p.parent AND o.num <> p.num) AS b,
  (SELECT min(o.num) FROM p o WHERE o.name_full = p.parent AND o.num <> p.num) AS c, EXISTS (SELECT 1 FROM p o WHERE o.name_full = p.parent) AS c_any,
  (SELECT min(o.num) FROM p o WHERE o.sp = p.parent AND o.num <> p.num) AS d FROM p WHERE parent IS NOT NULL)
SELECT num AS card_id, coalesce(CASE WHEN a_any THEN a ELSE b END, CASE WHEN c_any THEN c ELSE d END) AS parent_id,
  CASE WHEN CASE WHEN a_any THEN a ELSE b END IS NOT NULL THEN 'in_set' WHEN CASE WHEN c_any THEN c ELSE d END IS NOT NULL THEN 'catalogue' ELSE 'unresolved' END AS how FROM q""",
)
def parent_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    num = F.col("num")
    parent = F.when(num % 5 == 0, None).when(num % 4 == 0, "red rod").when(num % 3 == 0, F.col("name_full")).when(num % 3 == 1, F.col("species")).otherwise("fossil")
    cards = c.catalogue(Tables(spark, sf_dir)).select(
        num.alias("card_id"), "set_id", "name_full", F.when(F.col("card_type") == "pokemon", F.col("species")).alias("species"), parent.alias("parent_name")
    )
    return r.resolve_parents(cards)


@query(
    "longest_prefix_rollup",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM documents),
t AS (SELECT DISTINCT list_slice(ws, 1, 2) AS p FROM w WHERE doc_id % 2 = 0 AND len(ws) >= 2 UNION SELECT DISTINCT list_slice(ws, 1, 1) FROM w WHERE doc_id % 5 = 0 AND len(ws) >= 1
  UNION SELECT DISTINCT list_slice(ws, 1, 3) FROM w WHERE doc_id % 3 = 0 AND len(ws) >= 3),
x AS (SELECT doc_id, p, len(p) AS n FROM w JOIN t ON p = list_slice(ws, 1, 1) UNION ALL SELECT doc_id, p, 2 FROM w JOIN t ON p = list_slice(ws, 1, 2) AND len(ws) >= 2
  UNION ALL SELECT doc_id, p, 3 FROM w JOIN t ON p = list_slice(ws, 1, 3) AND len(ws) >= 3)
SELECT w.doc_id AS key_id, array_to_string(max_by(p, n), ' ') AS target_id, CAST(max(n) AS BIGINT) AS depth FROM w LEFT JOIN x USING (doc_id) GROUP BY w.doc_id""",
)
def longest_prefix_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))
    keys = docs.select(F.col("doc_id").alias("key_id"), words.alias("path"))
    starts = stored_rows(keys.select("key_id", F.slice("path", 1, 3).alias("path")), "prefix-targets")
    cut = lambda mod, size: starts.filter((F.col("key_id") % mod == 0) & (F.size("path") >= size)).select(F.slice("path", 1, size).alias("path"))
    targets = stored_rows(cut(2, 2).unionByName(cut(5, 1)).unionByName(cut(3, 3)).distinct().withColumn("target_id", F.array_join("path", " ")), "prefix-aims")
    return r.longest_prefix(keys, targets).withColumn("depth", F.col("depth").cast("long"))


@query(
    "fk_anti_check",
    """SELECT l_partkey, count(*) AS dangling FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45) GROUP BY l_partkey""",
)
def fk_anti_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    loose = r.dangling(t.lineitem.select("l_partkey"), "l_partkey", t.part.filter(F.col("p_size") <= 45), "p_partkey")
    return loose.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("dangling"))


@query(
    "alias_twin_mark",
    """WITH t AS (SELECT p_brand, p_name, count(*) AS n, min(p_partkey) AS twin FROM part WHERE p_partkey % 4 <> 0 GROUP BY 1, 2)
SELECT p_partkey AS card_id, CASE WHEN n = 1 THEN twin END AS alias_of, CASE WHEN n IS NULL THEN 'no_twin' WHEN n > 1 THEN 'several_twins' END AS question
FROM part p LEFT JOIN t ON t.p_brand = p.p_brand AND t.p_name = p.p_name WHERE p_partkey % 4 = 0""",
)
def alias_twin_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    num = F.col("p_partkey")
    cards = Tables(spark, sf_dir).part.select(
        num.alias("card_id"), F.col("p_brand").alias("set_id"), F.col("p_name").alias("name_full"),
        F.when(num % 4 == 0, F.concat(F.lit("A"), num.cast("string"))).otherwise(num.cast("string")).alias("number"),
    )
    return r.mark_aliases(cards)
