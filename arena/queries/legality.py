"""Legality queries on the part catalogue, orders and documents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arena.operators import baskets as k
from arena.operators import graph as g
from arena.operators import legality as lg
from arena.queries.baskets import RULES_SQL, rule_baskets, stored_rules
from arena.queries.resolve import CAT
from arena.queries.sql import star
from arena.registry import query
from arena.sources import catalogue as c
from arena.sources import tables as b
from arena.sources.tables import Tables, day_text, lookup

# calendar of the test years, in the shape of the rotation calendar
SEASONS = [
    ("cn", "1999-07-01", None, ["G", "H"]),
    ("en", "1996-01-01", "1998-12-31", ["F", "G"]),
    ("en", "1999-01-01", "2000-06-30", ["G", "H", "I"]),
    ("en", "2000-07-01", "2001-03-31", ["G", "H"]),
    ("en", "2001-04-01", None, ["H", "I"]),
    ("ja", "1998-01-01", "2000-12-31", ["G", "H"]),
]
REGIONS = {"BUILDING": "en", "FURNITURE": "en", "HOUSEHOLD": "ja", "AUTOMOBILE": "cn"}


@query(
    "interval_env_join",
    star()
    + """SELECT o_orderkey, CASE
  WHEN segment = 'AUTOMOBILE' AND day >= '1999-07-01' THEN 'GH'
  WHEN segment IN ('BUILDING','FURNITURE') THEN CASE WHEN day BETWEEN '1996-01-01' AND '1998-12-31' THEN 'FG' WHEN day BETWEEN '1999-01-01' AND '2000-06-30' THEN 'GHI'
    WHEN day BETWEEN '2000-07-01' AND '2001-03-31' THEN 'GH' WHEN day >= '2001-04-01' THEN 'HI' END
  WHEN segment = 'HOUSEHOLD' AND day BETWEEN '1998-01-01' AND '2000-12-31' THEN 'GH' END AS env FROM ord""",
)
def interval_env_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = b.entries(Tables(spark, sf_dir))
    marks = lg.env_marks(lookup(F.col("segment"), REGIONS), F.col("day"), SEASONS)
    return entries.select("o_orderkey", F.array_join(marks, "").alias("env"))


@query(
    "window_guard",
    """SELECT count(*) FILTER (d IS NULL OR d BETWEEN DATE '1999-01-01' AND DATE '2001-03-31') AS kept,
  count(*) FILTER (d NOT BETWEEN DATE '1999-01-01' AND DATE '2001-03-31') AS skipped, count(*) FILTER (d IS NULL) AS undated
FROM (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders)""",
)
def window_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders.select(F.when(F.col("o_orderkey") % 10 != 0, F.to_date("o_orderdate")).alias("day"))
    return lg.window_guard(orders, "day", lg.alignment_window("en", SEASONS))[1]


def month_snapshots(t: Tables) -> DataFrame:
    """One snapshot per segment and quarter of the orders; every third stays open."""
    start = F.trunc("day", "quarter")
    heads = b.entries(t).select(F.col("segment").alias("format"), start.alias("effective_from")).distinct()
    end = F.when(F.month("effective_from") != 7, F.date_add("effective_from", 120))
    return heads.select(
        F.concat_ws("-", "format", day_text("effective_from")).alias("snapshot_id"), "format", "effective_from", end.alias("effective_to")
    )


SNAPS = """snaps AS (SELECT DISTINCT segment || '-' || strftime(date_trunc('quarter', day), '%Y-%m-%d') AS snapshot_id, segment AS format,
  CAST(date_trunc('quarter', day) AS DATE) AS f, CASE WHEN month(date_trunc('quarter', day)) <> 7 THEN CAST(date_trunc('quarter', day) AS DATE) + 120 END AS t FROM ord)"""


@query(
    "snapshot_as_of",
    star(SNAPS)
    + """, asked AS (SELECT DISTINCT segment AS format, day - 60 AS day FROM ord)
SELECT a.format, strftime(a.day, '%Y-%m-%d') AS day, max_by(snapshot_id, f) AS snapshot_id FROM asked a
LEFT JOIN snaps s ON s.format = a.format AND f <= a.day AND (t IS NULL OR a.day <= t) GROUP BY a.format, a.day""",
)
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    asked = b.entries(t).select(F.col("segment").alias("format"), F.date_sub("day", 60).alias("day"))
    return lg.snapshot_as_of(asked, month_snapshots(t)).withColumn("day", day_text("day"))


RULES = lg.Snapshot(
    "standard-test", ("F", "G", "H"), ("red", "blue", "hot"), ("small ring", "cold rod", "large", "missing thing"),
    (("red rod", None), ("blue bolt", "hit 7"), ("bolt", "hit 9")),
)
ENERGIES = ["red", "blue", "hot", "cold", "small"]
DECIDE = f"""{CAT}, dec AS (SELECT *, CASE
  WHEN name_full = 'red rod' OR (name_full = 'blue bolt' AND size = 7) OR (species = 'bolt' AND size = 9) THEN 'banned'
  WHEN name_full IN ('small ring', 'cold rod') OR (w1 = 'large' AND num % 3 = 0) THEN 'whitelist'
  WHEN (CASE WHEN num % 40 = 0 THEN 'G' ELSE mark END) IN ('F','G','H') THEN 'mark'
  WHEN basic AND w1 IN ('red','blue','hot') THEN 'basic_energy' ELSE 'not_legal' END AS step FROM cat)"""


def legal_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Catalogue with names and skills, and the mark overrides."""
    cat = c.catalogue(t)
    groups = cat.select("card_id", F.col("species").alias("group_key")).unionByName(
        cat.filter(F.col("num") % 3 == 0).select("card_id", F.col("first_word").alias("group_key"))
    )
    cards = lg.with_names(cat, groups, RULES).withColumn("skills", F.array(F.concat(F.lit("hit "), F.col("size").cast("string"))))
    overrides = cat.filter(F.col("num") % 40 == 0).select("card_id", F.lit("G").alias("mark"))
    return cards, overrides


def decisions(t: Tables) -> DataFrame:
    cards, overrides = legal_inputs(t)
    return lg.legal_decisions(cards, RULES, overrides)


@query("legal_pool", f"WITH {DECIDE} SELECT card_id, step, step NOT IN ('banned','not_legal') AS legal FROM dec")
def legal_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(Tables(spark, sf_dir)).select("card_id", "step", "legal")


@query(
    "pool_by_group",
    f"""WITH {DECIDE} SELECT CASE WHEN name_full IN ('small ring','cold rod') THEN name_full ELSE 'large' END AS group_key, card_id FROM dec WHERE step = 'whitelist'""",
)
def pool_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.pool_by_group(decisions(Tables(spark, sf_dir)))


@query(
    "whitelist_audit",
    f"""WITH {DECIDE}, w AS (SELECT * FROM (VALUES ('small ring'), ('cold rod'), ('large'), ('missing thing')) v(name)),
p AS (SELECT CASE WHEN name_full IN ('small ring','cold rod') THEN name_full ELSE 'large' END AS name, count(*) AS prints FROM dec WHERE step = 'whitelist' GROUP BY 1),
e AS (SELECT * FROM (VALUES ('red', true), ('blue', true), ('hot', true), ('cold', false), ('small', false)) v(name, allowed)),
b AS (SELECT w1 AS name, count(*) AS prints FROM dec WHERE basic AND step NOT IN ('banned','not_legal') GROUP BY 1)
SELECT 'whitelist' AS kind, name, coalesce(prints, 0) AS prints, coalesce(prints, 0) > 0 AS ok, CASE WHEN prints > 0 THEN 'legal' ELSE 'unknown_name' END AS detail FROM w LEFT JOIN p USING (name)
UNION ALL SELECT CASE WHEN allowed THEN 'energy' ELSE 'energy_negative' END, name, coalesce(prints, 0), CASE WHEN allowed THEN coalesce(prints, 0) > 0 ELSE coalesce(prints, 0) = 0 END,
  CASE WHEN allowed AND coalesce(prints, 0) = 0 THEN 'no_legal_basic' WHEN NOT allowed AND coalesce(prints, 0) > 0 THEN 'should_be_outside' ELSE 'as_expected' END FROM e LEFT JOIN b USING (name)""",
)
def whitelist_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cards, overrides = legal_inputs(t)
    return lg.whitelist_audit(cards, lg.legal_decisions(cards, RULES, overrides), RULES, ENERGIES)


@query(
    "basket_legality_report",
    f"""WITH {RULES_SQL}, {DECIDE}, ill AS (SELECT deck_id, ln.card_id FROM ln JOIN dec ON dec.num = ln.card_id WHERE step IN ('banned','not_legal') AND size <= 48),
av AS (SELECT deck_id, 1 AS x FROM viol UNION ALL SELECT deck_id, 1 FROM ill),
v AS (SELECT deck_id, count(*) AS violations FROM av GROUP BY deck_id), s AS (SELECT deck_id, CAST(sum(n) AS BIGINT) AS deck_size FROM ln GROUP BY deck_id)
SELECT deck_id, deck_size, coalesce(violations, 0) AS violations, violations IS NULL AS ok FROM s LEFT JOIN v USING (deck_id)""",
)
def basket_legality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    ids = c.catalogue(t).filter(F.col("size") <= b.MAX_RESOLVED_SIZE).select("card_id", "num")
    decided = decisions(t).join(ids, "card_id").drop("card_id").withColumnRenamed("num", "card_id")
    return k.basket_report(k.judged_baskets(rule_baskets(t), stored_rules(t, decided), 16))


DAY = date(2000, 6, 1)


@query(
    "effective_text",
    """WITH t AS (SELECT doc_id, text, CASE WHEN doc_id % 10 = 0 THEN CASE WHEN doc_id % 20 = 0 THEN doc_id + 2 ELSE doc_id + 3 END
  WHEN doc_id % 10 = 5 THEN doc_id + 1 END AS target FROM documents), r AS (SELECT t.*, coalesce(target, doc_id) AS rid FROM t)
SELECT r.doc_id AS card_id, rid AS resolved_id, md5(CASE WHEN p.doc_id IS NULL AND rid % 7 <> 0 THEN '' WHEN rid % 7 = 0 THEN CASE WHEN rid % 14 = 0 THEN 'new ' ELSE 'old ' END || rid ELSE p.text END) AS text_md5,
  CASE WHEN p.doc_id IS NULL THEN 'missing_print' WHEN rid % 7 = 0 THEN 'errata' WHEN target IS NOT NULL THEN 'latest_print' ELSE 'text_raw' END AS source
FROM r LEFT JOIN documents p ON p.doc_id = rid""",
)
def effective_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents.select(F.col("doc_id").alias("card_id"), "text")
    key = F.col("card_id")
    day = lambda d: F.lit(d).cast("date")

    def override(fmt, start, end, cond, target):
        return docs.filter(cond).select(
            F.lit(fmt).alias("format"), day(start).alias("effective_from"), day(end).alias("effective_to"), "card_id", target.alias("target")
        )

    overrides = (
        override("open", "1999-01-01", None, key % 10 == 0, key + 1)
        .unionByName(override("open", "2000-01-01", None, key % 10 == 0, key + 3))
        .unionByName(override("standard", "2000-01-01", "2001-01-01", key % 20 == 0, key + 2))
        .unionByName(override("open", "1998-01-01", "1999-12-31", key % 10 == 3, key + 1))
        .unionByName(override("open", "1998-01-01", None, key % 10 == 5, key + 1))
    )
    notice = lambda label, start, cond: docs.filter(cond).select(
        "card_id", day(start).alias("effective_from"), F.concat(F.lit(label), key.cast("string")).alias("corrected_text")
    )
    errata = notice("old ", "1999-01-01", key % 7 == 0).unionByName(notice("new ", "2000-01-01", key % 14 == 0)).unionByName(
        notice("late ", "2001-01-01", key % 7 < 2)
    )
    out = lg.effective_text(docs, overrides, errata, DAY)
    return out.select("card_id", "resolved_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "source")


LATEST = """newest AS (SELECT name_full, count(*) AS n, first(card_id ORDER BY release_date DESC NULLS LAST, card_id DESC) AS target FROM cat GROUP BY name_full)"""


@query(
    "latest_print_override",
    f"WITH {CAT}, {LATEST} SELECT name_full AS group_key, card_id, target FROM cat JOIN newest USING (name_full) WHERE n > 1 AND card_id <> target",
)
def latest_print_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = c.catalogue(Tables(spark, sf_dir))
    return lg.latest_print_overrides(cat, cat.select("card_id", F.col("name_full").alias("group_key")))


SCD = """cur AS (SELECT snapshot_id, format, f, CASE WHEN f = max(f) OVER (PARTITION BY format) THEN NULL ELSE lead(f) OVER (PARTITION BY format ORDER BY f) - 1 END AS t
  FROM (SELECT DISTINCT segment || '-' || strftime(date_trunc('quarter', day), '%Y-%m-%d') AS snapshot_id, segment AS format, CAST(date_trunc('quarter', day) AS DATE) AS f FROM ord WHERE day < '2000-10-01')),
prop AS (SELECT DISTINCT segment || '-' || strftime(date_trunc('month', day), '%Y-%m-%d') || CASE WHEN o_orderstatus = 'P' THEN '-b' ELSE '' END AS snapshot_id, segment AS format,
  CAST(date_trunc('month', day) AS DATE) AS f FROM ord WHERE day >= '2000-07-01'),
m AS (SELECT format, max(f) AS newest FROM cur GROUP BY format),
chk AS (SELECT p.*, CASE WHEN p.snapshot_id IN (SELECT snapshot_id FROM cur) THEN 'duplicate_id' WHEN p.f <= newest THEN 'not_after_current'
  WHEN p.snapshot_id <> min(p.snapshot_id) OVER (PARTITION BY p.format, p.f) THEN 'same_start' END AS reason FROM prop p LEFT JOIN m USING (format)),
ok AS (SELECT snapshot_id, format, f FROM chk WHERE reason IS NULL)"""


@query(
    "scd2_apply",
    star(SCD)
    + """, al AS (SELECT snapshot_id, format, f, t FROM cur UNION ALL SELECT snapshot_id, format, f, NULL FROM ok)
SELECT snapshot_id, format, strftime(f, '%Y-%m-%d') AS effective_from, strftime(coalesce(t, lead(f) OVER (PARTITION BY format ORDER BY f) - 1), '%Y-%m-%d') AS effective_to, NULL AS reason FROM al
UNION ALL SELECT snapshot_id, format, strftime(f, '%Y-%m-%d'), NULL, reason FROM chk WHERE reason IS NOT NULL""",
)
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    entries = b.entries(t)
    first_day = F.lit("2000-10-01").cast("date")
    quarter = entries.filter(F.col("day") < first_day).select(F.col("segment").alias("format"), F.trunc("day", "quarter").alias("effective_from")).distinct()
    after = F.lead("effective_from").over(Window.partitionBy("format").orderBy("effective_from"))
    current = quarter.withColumn("_next", after).select(
        F.concat_ws("-", "format", day_text("effective_from")).alias("snapshot_id"), "format", "effective_from", F.date_sub("_next", 1).alias("effective_to")
    )
    month = F.trunc("day", "month")
    suffix = F.when(F.col("o_orderstatus") == "P", "-b").otherwise("")
    proposals = entries.filter(F.col("day") >= F.lit("2000-07-01").cast("date")).select(
        F.concat(F.concat_ws("-", "segment", day_text(month)), suffix).alias("snapshot_id"), F.col("segment").alias("format"), month.alias("effective_from")
    ).distinct()
    history, refused = lg.apply_snapshots(current, proposals)
    text = lambda df: df.withColumns({x: day_text(x) for x in ("effective_from", "effective_to") if x in df.columns})
    return text(history).withColumn("reason", F.lit(None).cast("string")).unionByName(text(refused), allowMissingColumns=True)


@query(
    "snapshot_override_refresh",
    f"""WITH {CAT}, {LATEST}, sn AS (SELECT p_brand AS snapshot_id, max(p_size) % 2 = 0 AS is_open FROM part GROUP BY p_brand)
SELECT p_brand AS snapshot_id, p_brand || '-' || p_partkey AS card_id, 'stored' AS target FROM part JOIN sn ON snapshot_id = p_brand WHERE NOT is_open AND p_partkey % 9 = 0
UNION ALL SELECT DISTINCT w.p_brand, c.card_id, n.target FROM (SELECT DISTINCT p_brand, p_name FROM part WHERE p_size > 45) w JOIN sn ON sn.snapshot_id = w.p_brand AND is_open
  JOIN newest n ON n.name_full = w.p_name AND n.n > 1 JOIN cat c ON c.name_full = w.p_name AND c.card_id <> n.target""",
)
def snapshot_override_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cat = c.catalogue(t)
    fresh = lg.latest_print_overrides(cat, cat.select("card_id", F.col("name_full").alias("group_key")))
    snapshots = cat.groupBy(F.col("set_id").alias("snapshot_id")).agg(F.max("size").alias("_s")).select(
        "snapshot_id", F.when(F.col("_s") % 2 == 1, F.lit("2001-01-01").cast("date")).alias("effective_to")
    )
    whitelists = cat.filter(F.col("size") > 45).select(F.col("set_id").alias("snapshot_id"), F.col("name_full").alias("group_key")).distinct()
    stored = cat.filter(F.col("num") % 9 == 0).select(F.col("set_id").alias("snapshot_id"), "card_id", F.lit("stored").alias("target"))
    return lg.refresh_overrides(snapshots, whitelists, stored, fresh)


@query(
    "errata_import",
    """SELECT 'e' || doc_id AS errata_id, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'old' END AS corrected_text, false AS skipped FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0
UNION ALL SELECT 'e' || doc_id, 'new', true FROM documents WHERE doc_id % 6 = 1""",
)
def errata_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    key = F.col("doc_id")
    row = lambda cond, card, text: docs.filter(cond).select(
        F.concat(F.lit("e"), key.cast("string")).alias("errata_id"), card.alias("card_id"), F.lit("2000-01-01").cast("date").alias("effective_from"),
        F.lit(text).alias("corrected_text"),
    )
    stored = row(key % 2 == 0, key, "old")
    incoming = row(key % 3 == 0, key, "new").unionByName(row(key % 6 == 1, key + 10_000_000_000, "new"))
    merged, skipped = lg.import_errata(stored, incoming, docs.select(key.alias("card_id")))
    tell = lambda df, flag: df.select("errata_id", "corrected_text", F.lit(flag).alias("skipped"))
    return tell(merged, False).unionByName(tell(skipped, True))


@query(
    "chain_root",
    """WITH RECURSIVE p AS (SELECT p_partkey AS id, CASE WHEN p_partkey = 2 THEN 3 WHEN p_partkey = 3 THEN 2 WHEN p_partkey > 20 THEN p_partkey // 2
  WHEN p_partkey > 10 THEN p_partkey - 9 END AS parent FROM part),
w AS (SELECT id, id AS node, CASE WHEN id IN (2, 3) THEN NULL ELSE parent END AS nxt FROM p
  UNION ALL SELECT w.id, w.nxt, CASE WHEN w.nxt IN (2, 3) THEN NULL ELSE p.parent END FROM w JOIN p ON p.id = w.nxt)
SELECT id, node AS root FROM w WHERE nxt IS NULL""",
)
def chain_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    parent = (
        F.when(key == 2, F.lit(3)).when(key == 3, F.lit(2)).when(key > 20, F.floor(key / 2)).when(key > 10, key - 9)
    )
    return g.chain_roots(Tables(spark, sf_dir).part.select(key.alias("id"), parent.cast("long").alias("parent")))


EDGES = "(SELECT a.p_partkey AS src, a.p_partkey // 2 AS dst FROM part a JOIN part b ON b.p_partkey = a.p_partkey // 2 WHERE a.p_partkey > 0 AND a.p_partkey % 3 <> 0)"


def brand_edges(t: Tables) -> DataFrame:
    part = t.part.select("p_partkey")
    child = part.filter((F.col("p_partkey") > 0) & (F.col("p_partkey") % 3 != 0)).select(F.col("p_partkey").alias("src"), F.floor(F.col("p_partkey") / 2).alias("dst"))
    return child.join(part, F.col("dst") == F.col("p_partkey"), "left_semi")


@query(
    "connected_components",
    f"""WITH RECURSIVE e AS (SELECT src, dst FROM {EDGES}), n AS (SELECT p_partkey AS id FROM part),
up AS (SELECT id, id AS node FROM n UNION ALL SELECT up.id, e.dst FROM up JOIN e ON e.src = up.node)
SELECT id, min(node) AS component FROM up GROUP BY id""",
)
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    vertices = t.part.select(F.col("p_partkey").alias("id"))
    return g.connected_components(vertices, brand_edges(t))


@query(
    "union_reverse_edges",
    f"""SELECT src AS card_id, dst AS related_id, 'evolves_from' AS relation FROM {EDGES} UNION SELECT dst, src, 'evolves_to' FROM {EDGES}""",
)
def union_reverse_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.evolve_edges(brand_edges(Tables(spark, sf_dir)), "src", "dst")
