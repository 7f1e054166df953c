"""Source, export and incremental queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.functions import vocab as v
from arena.functions.parallel import tasks_for
from arena.operators import baskets as k
from arena.operators import normalise as n
from arena.operators import pages as p
from arena.plans import metrics as m
from arena.queries.metrics import PARAMS, WINDOW
from arena.queries.quality import GROWING, growing_records
from arena.queries.sql import CARRY, star
from arena.registry import ORACLES, query
from arena.session import scratch_dir, stored_rows
from arena.sources import catalogue as c
from arena.sources import export as e
from arena.sources import snapshots as s
from arena.sources import tables as b
from arena.sources.tables import Tables, day_text
from arena.streaming import growth as gw
from arena.streaming import refresh as r


@query(
    "raw_snapshot_scan",
    """SELECT CASE WHEN event_id % 13 = 0 THEN 'malformed' WHEN event_id % 11 = 0 THEN 'no_envelope' ELSE event_type END AS label, count(*) AS docs,
  CAST(sum(CASE WHEN event_id % 13 <> 0 AND event_id % 11 <> 0 THEN user_id END) AS BIGINT) AS users, CAST(sum(CASE WHEN event_id % 13 <> 0 AND event_id % 11 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END) AS BIGINT) AS k_sum
FROM events GROUP BY 1""",
)
def raw_snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    meta = F.struct(day_text("ts").alias("fetched_at"), F.lit("ev").alias("source"), F.md5("props").alias("content_hash"))
    doc = F.to_json(F.struct(F.when(key % 11 != 0, meta).alias("_meta"), "user_id", "event_type", F.from_json("props", "k long").alias("data")))
    lines = Tables(spark, sf_dir).events.select(F.when(key % 13 == 0, F.concat(doc, F.lit("}{"))).otherwise(doc).alias("value"))
    # a truncated document is malformed; a document without _meta has no envelope
    lines = lines.withColumn("value", F.regexp_replace("value", r"\}\}\{$", ""))
    path = scratch_dir(spark, "raw")
    lines.write.text(path)
    good, rejects = s.scan_snapshots(spark, path, "user_id long, event_type string, data struct<k: long>")
    told = good.groupBy(F.col("event_type").alias("label")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum("user_id").alias("users"), F.sum("data.k").alias("k_sum")
    )
    return told.unionByName(rejects.groupBy(F.col("reason").alias("label")).agg(F.count(F.lit(1)).alias("docs")), allowMissingColumns=True)


@query(
    "content_hash_audit",
    """SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '","text":' || CAST(to_json(text) AS VARCHAR) || '}') AS content_hash,
  CASE WHEN doc_id % 17 = 0 THEN 'malformed' WHEN doc_id % 13 = 0 THEN 'mismatch' ELSE 'valid' END AS state FROM documents""",
)
def content_hash_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    docs = Tables(spark, sf_dir).documents.select("doc_id", "lang", "source", "text")
    canonical = F.to_json(F.struct("doc_id", "lang", "source", "text"))
    written = F.to_json(F.struct("text", "source", "lang", "doc_id"))
    bodies = docs.select(
        "doc_id", F.sha2(canonical, 256).alias("content_hash"), F.when(key % 17 == 0, F.substr(written, F.lit(1), F.lit(9))).otherwise(written).alias("body"),
        F.when(key % 13 == 0, "stale").otherwise(F.sha2(canonical, 256)).alias("stored"),
    )
    return s.audit_hashes(bodies, "body", "stored").select("doc_id", "content_hash", "state")


def _upsert_sql(force: bool) -> str:
    keep = "false" if force else "doc_id % 3 <> 0 AND doc_id % 5 <> 0"
    return f"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new 2' WHEN doc_id % 2 = 0 AND NOT ({keep}) THEN 'new 2' ELSE 'old' END AS payload,
  CASE WHEN doc_id % 3 = 0 THEN 'added' WHEN doc_id % 2 = 0 AND NOT ({keep}) THEN 'replaced' ELSE 'kept' END AS action FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 = 0"""


def _upsert(spark: SparkSession, sf_dir: str, force: bool) -> DataFrame:
    docs, key = Tables(spark, sf_dir).documents.select("doc_id"), F.col("doc_id")
    existing = docs.filter(key % 3 != 0).select("doc_id", F.lit("old").alias("payload"), (key % 5 != 0).alias("valid"))
    twice = docs.filter(key % 2 == 0).withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
    incoming = twice.select("doc_id", F.concat(F.lit("new "), F.col("seq").cast("string")).alias("payload"), "seq")
    return s.append_only_merge(existing, incoming, "doc_id", "seq", force=force)


@query("append_only_upsert", _upsert_sql(False))
def append_only_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, False)


@query("append_only_upsert_forced", _upsert_sql(True))
def append_only_upsert_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, True)


@query(
    "paged_index_last_wins",
    """WITH i AS (SELECT user_id AS id, event_id, 'a' AS tag, event_type FROM events UNION ALL SELECT user_id + 1, event_id, 'b', event_type FROM events WHERE event_id % 4 <> 0)
SELECT id, tag, event_type AS context FROM i QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC, tag DESC) = 1""",
)
def paged_index_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = lambda id_col, tag: F.struct(id_col.alias("id"), F.lit(tag).alias("tag"))
    user = F.col("user_id")
    pages = Tables(spark, sf_dir).events.select(
        F.concat_ws("/", F.lit("list"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("path"), "event_type",
        F.array(item(user, "a"), item(F.when(F.col("event_id") % 4 != 0, user + 1), "b")).alias("items"),
    )
    out = s.paged_index(pages, "items", F.col("item.id"), F.col("event_type"))
    return out.select("id", "item.tag", "context")


@query(
    "embedded_csv_names",
    """SELECT p_partkey AS key, CASE WHEN p_size % 2 = 0 THEN 'J ' || p_name ELSE 'K ' || p_name END AS ja, p_name AS en FROM part""",
)
def embedded_csv_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name = F.col("p_partkey").cast("string"), F.col("p_name")
    row = lambda lang, text: F.concat_ws(",", key, F.lit(str(lang)), text)
    text = F.concat_ws(
        "\n", F.lit("pokemon_species_id,local_language_id,name"), row(1, F.concat(F.lit("K "), name)), row(9, F.lit("stale")),
        F.when(F.col("p_size") % 2 == 0, row(11, F.concat(F.lit("J "), name))), row(9, name),
    )
    docs = Tables(spark, sf_dir).part.select(text.alias("csv"))
    return s.csv_names(docs, "csv", [[11, 1], [9]], ["ja", "en"])


@query(
    "export_bundle",
    star()
    + """SELECT 'tournaments' AS "table", count(*) AS rows, 'v20010801.2' AS version, CAST(0 AS BIGINT) AS bad FROM tours UNION ALL SELECT 'decks', count(*), 'v20010801.2', 0 FROM decks
UNION ALL SELECT 'appearances', count(*), 'v20010801.2', 0 FROM apps UNION ALL SELECT 'deck_cards', count(*), 'v20010801.2', 0 FROM cards""",
)
def export_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "bundle")
    version = e.next_data_version("v20010801.1", date(2001, 8, 1))
    manifest = e.write_bundle(e.star_tables(b.basket_star(Tables(spark, sf_dir))), root, version, {"tiers": e.vocabulary_hash(v.TIERS)})
    return manifest.drop("vocabulary").join(e.verify_bundle(spark, root).select("table", "bad"), "table")


def _exported_star(spark: SparkSession, sf_dir: str) -> b.Star:
    # only the months that are read back are written
    root, live = scratch_dir(spark, "bundle"), b.basket_star(Tables(spark, sf_dir), WINDOW)
    e.write_bundle(e.star_tables(live), root, "v1")
    return e.read_star(spark, root, live)


@query("export_roundtrip", ORACLES["weighted_usage"])
def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = m.weighted_usage(_exported_star(spark, sf_dir), PARAMS)
    return usage.withColumn("value", F.round("value", 9))


@query(
    "contract_check",
    star(CARRY) + "SELECT 'left' AS only_in, CAST(1 AS BIGINT) AS times, group_key, count(*) AS n FROM wc WHERE group_key = 'Brand#7' GROUP BY group_key",
)
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = m.weighted_usage(b.basket_star(Tables(spark, sf_dir), WINDOW), PARAMS).select("group_key", "n", F.round("value", 9).alias("value"))
    back = m.weighted_usage(_exported_star(spark, sf_dir), PARAMS).select("group_key", "n", F.round("value", 9).alias("value"))
    # one group is left out on purpose: exactly its row must be reported
    found = r.contract_differences(live, back.filter(F.col("group_key") != "Brand#7"))
    return found.select("only_in", "times", "group_key", "n")


@query(
    "export_denormalised_items",
    """SELECT l_orderkey AS deck_id, l_partkey AS card_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS copies, CASE WHEN p_size <= 48 THEN p_brand END AS group_key
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey, l_partkey, p_brand, p_size""",
)
def export_denormalised_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    items = t.lineitem.groupBy(F.col("l_orderkey").alias("deck_id"), F.col("l_partkey").alias("card_id")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("copies")
    )
    groups = t.part.filter(F.col("p_size") <= b.MAX_RESOLVED_SIZE).select(F.col("p_partkey").alias("card_id"), F.col("p_brand").alias("group_key"))
    return e.denormalised_items(items, groups)


@query(
    "adhoc_sql_limited",
    "SELECT o_orderpriority, o_orderstatus, count(*) AS n, true AS truncated FROM orders GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 6",
)
def adhoc_sql_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    Tables(spark, sf_dir).orders.createOrReplaceTempView("arena_orders")
    return e.adhoc_sql(
        spark, "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM arena_orders GROUP BY 1, 2 ORDER BY 1, 2", limit=6
    )


EVENT_SCHEMA = "event_id long, user_id long, event_type string, day date"


@query("incremental_ingest", "SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target, checkpoint = (scratch_dir(spark, n) for n in ("files", "store", "progress"))
    events = Tables(spark, sf_dir).events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    run = lambda: r.ingest_files(spark, source, target, checkpoint, EVENT_SCHEMA, "event_id", partition="day")
    events.filter(F.col("event_id") % 2 == 0).write.mode("append").parquet(source)
    run()
    # the second delivery repeats a third of the first; a rerun without new files adds nothing
    events.filter((F.col("event_id") % 2 == 1) | (F.col("event_id") % 6 == 0)).write.mode("append").parquet(source)
    run()
    run()
    return r.stored_rows(spark, target, EVENT_SCHEMA).drop(r.BATCH).withColumn("day", day_text("day"))


@query(
    "late_refresh_window",
    """WITH w AS (SELECT max(ts) FILTER (event_id % 10 <> 0) - INTERVAL 14 DAY AS wm FROM events),
x AS (SELECT CAST(ts AS DATE) AS day, user_id, event_id % 10 = 0 AND CAST(ts AS DATE) + 1 <= wm AS late FROM events, w)
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) FILTER (NOT late) AS n, CAST(sum(user_id) FILTER (NOT late) AS BIGINT) AS amount, count(*) FILTER (late) AS late FROM x GROUP BY day""",
)
def late_refresh_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target, checkpoint = (scratch_dir(spark, n) for n in ("files", "totals", "progress"))
    schema = "event_id long, ts timestamp, amount long"
    events = Tables(spark, sf_dir).events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("amount"))
    first, second = events.filter(F.col("event_id") % 10 != 0), events.filter(F.col("event_id") % 10 == 0)
    first.write.mode("append").parquet(source)
    r.daily_totals(spark, source, target, checkpoint, schema, "event_id")
    second.write.mode("append").parquet(source)
    r.daily_totals(spark, source, target, checkpoint, schema, "event_id")
    # what the job itself set aside, not a second look at the deliveries
    late = r.late_rejects(spark, target, schema).groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("late"))
    totals = r.current_totals(spark, target, schema).join(late, "day", "full_outer")
    return totals.select(day_text("day").alias("day"), F.coalesce("n", F.lit(0)).alias("n"), "amount", F.coalesce("late", F.lit(0)).alias("late"))


@query(
    "page_change_monitor",
    """SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'baseline' WHEN page_id % 5 = 0 THEN 'changed' WHEN page_id % 11 = 0 THEN 'noop' ELSE 'unchanged' END AS status,
  CASE WHEN page_id % 9 <> 0 AND page_id % 5 = 0 THEN 'notice ' || page_id END AS added FROM pages""",
)
def page_change_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, key = Tables(spark, sf_dir).pages.select("page_id", "html"), F.col("page_id")
    insert = lambda text: F.replace(F.col("html"), F.lit("<article><h1>"), F.concat(F.lit("<article>"), text, F.lit("<h1>")))
    changed = insert(F.concat(F.lit("<p>notice "), key.cast("string"), F.lit("</p>")))
    title = F.regexp_extract("html", r"(?s)<article>(<h1>.*?</h1>)", 1)
    html = F.when(key % 5 == 0, changed).when(key % 11 == 0, insert(title)).when(key % 7 == 0, F.replace(F.col("html"), F.lit("</nav>"), F.lit(" </nav>"))).otherwise(F.col("html"))
    stored = p.block_texts(pages.filter(key % 9 != 0), "article")
    fetched = p.block_texts(pages.select("page_id", html.alias("html")), "article")
    out = r.page_changes(stored, fetched)
    return out.select("page_id", "status", F.col("added")[0]["text"].alias("added"))


@query(
    "snapshot_diff",
    """WITH s AS (SELECT CAST(ts AS DATE) AS day, event_type, user_id, count(*) AS n, max(value) AS top FROM events GROUP BY 1, 2, 3),
o AS (SELECT day + 1 AS day, event_type, user_id, n, top FROM s WHERE day < (SELECT max(day) FROM s)), n AS (SELECT * FROM s WHERE day > (SELECT min(day) FROM s)),
j AS (SELECT coalesce(o.day, n.day) AS day, coalesce(o.event_type, n.event_type) AS event_type, coalesce(o.user_id, n.user_id) AS user_id, o.n AS a, n.n AS b, o.top AS c, n.top AS d
  FROM o FULL JOIN n ON n.day = o.day AND n.event_type = o.event_type AND n.user_id = o.user_id),
r AS (SELECT day, event_type, user_id, 'added' AS change, '' AS field FROM j WHERE a IS NULL UNION ALL SELECT day, event_type, user_id, 'removed', '' FROM j WHERE b IS NULL
UNION ALL SELECT day, event_type, user_id, 'changed', 'n' FROM j WHERE a <> b UNION ALL SELECT day, event_type, user_id, 'changed', 'top' FROM j WHERE c <> d)
SELECT strftime(day, '%Y-%m-%d') AS day, event_type, user_id, change, field FROM r""",
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day against the day before, over the whole table."""
    key = ["day", "event_type", "user_id"]
    state = Tables(spark, sf_dir).events.groupBy(F.to_date("ts").alias("day"), "event_type", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top")
    )
    ends = state.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    before = state.filter(F.col("day") < F.lit(ends["last"])).withColumn("day", F.date_add("day", 1))
    diff = r.snapshot_diff(before, state.filter(F.col("day") > F.lit(ends["first"])), key, ["n", "top"])
    return diff.withColumn("day", day_text("day"))


@query(
    "new_items_since",
    """SELECT page_id, url, regexp_matches(html, 'that|que') AS flagged FROM pages WHERE page_id NOT IN (SELECT page_id FROM pages WHERE page_id % 3 <> 0)""",
)
def new_items_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = Tables(spark, sf_dir).pages
    previous = pages.filter(F.col("page_id") % 3 != 0)
    return r.new_items(pages, previous, "page_id", "html", "that|que").select("page_id", "url", "flagged")


@query(
    "increment_detect",
    """WITH f AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_nationkey <> 7 OR c_custkey % 2 = 0 GROUP BY 1), s AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_custkey % 20 <> 0 AND c_nationkey <> 9 GROUP BY 1)
SELECT f.k AS set_id, CASE WHEN s.n IS NULL THEN 'new' WHEN f.n > s.n THEN 'grown' ELSE 'shrunk' END AS kind, f.n AS expected, s.n AS current FROM f LEFT JOIN s ON s.k = f.k WHERE s.n IS NULL OR s.n <> f.n""",
)
def increment_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, key = Tables(spark, sf_dir).customer, F.col("c_nationkey")
    count = lambda df: df.groupBy(key.alias("set_id")).agg(F.count(F.lit(1)).alias("n"))
    fresh = count(customer.filter((key != 7) | (F.col("c_custkey") % 2 == 0)))
    return r.detect_increments(fresh, count(customer.filter((F.col("c_custkey") % 20 != 0) & (key != 9))))


SEEDED = "num % 10 <> 0 AND set_id <> 'Brand#5'"


@query(
    "growth_pipeline",
    f"""WITH {GROWING}, up AS (SELECT set_id, count(*) FILTER (set_id <> 'Brand#8' OR num % 4 <> 0) AS n FROM gr GROUP BY 1), st AS (SELECT set_id, count(*) AS n FROM gr WHERE {SEEDED} GROUP BY 1),
inc AS (SELECT up.set_id, CASE WHEN st.n IS NULL THEN 'new' WHEN up.n > st.n THEN 'grown' ELSE 'shrunk' END AS kind, up.n AS expected, st.n AS current FROM up LEFT JOIN st USING (set_id) WHERE st.n IS NULL OR up.n <> st.n),
bad AS (SELECT set_id, string_agg(DISTINCT rule, ',' ORDER BY rule) AS rules FROM rf GROUP BY 1),
sets AS (SELECT inc.*, CASE WHEN kind = 'shrunk' THEN 'suspicious' WHEN rules IS NOT NULL THEN 'blocked' ELSE 'activated' END AS state, CASE WHEN kind <> 'shrunk' THEN rules END AS rules FROM inc LEFT JOIN bad USING (set_id)),
act AS (SELECT set_id FROM sets WHERE state = 'activated'),
pub AS (SELECT * FROM ok WHERE {SEEDED} OR set_id IN (SELECT set_id FROM act)),
nm AS (SELECT CASE WHEN f AND num % 233 = 0 THEN '' ELSE p_name END AS nm, count(*) AS n FROM pub GROUP BY 1),
ln AS (SELECT l_orderkey AS deck, l_partkey AS num, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
it AS (SELECT deck, ln.num, s.num IS NOT NULL AS mapped, s.num IS NULL AND k.set_id IN (SELECT set_id FROM act) AS hit, CASE WHEN s.num IS NOT NULL THEN sum(q) ELSE max(q) END AS c
  FROM ln JOIN gr k USING (num) LEFT JOIN (SELECT num FROM ok WHERE {SEEDED}) s USING (num) GROUP BY deck, ln.num, s.num, k.set_id),
dk AS (SELECT deck, sum(CASE WHEN mapped THEN c ELSE 0 END) * 1.0::DOUBLE / sum(c) AS before, sum(CASE WHEN mapped OR hit THEN c ELSE 0 END) * 1.0::DOUBLE / sum(c) AS after FROM it GROUP BY 1),
tot AS (SELECT count(*) FILTER (NOT mapped) AS attempted, count(*) FILTER (hit) AS resolved, count(DISTINCT deck) FILTER (hit) AS decks_affected FROM it)
SELECT sets.*, 'v20010801.2' AS data_version, attempted, resolved, decks_affected, (SELECT count(*) FROM dk WHERE before < 0.95 AND after >= 0.95) AS decks_upgraded,
  (SELECT count(*) FROM pub) AS cards, (SELECT count(*) FROM ok WHERE {SEEDED} AND num % 9 = 0)
    + (SELECT CAST(sum(n - 1) AS BIGINT) FROM nm WHERE nm IN (SELECT p_name FROM part WHERE p_size > 45)) AS override_rows FROM sets, tot""",
)
def growth_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A growing source against a seeded store: detected sets, what the checks blocked, and what the new version published."""
    t = Tables(spark, sf_dir)
    root, num = scratch_dir(spark, "catalogue"), F.col("num")
    raw = stored_rows(growing_records(t), "growth-raw")
    older = raw.filter((num % 10 != 0) & (F.col("set_id") != "Brand#5"))
    base = stored_rows(gw.drafts(older), "growth-base")
    lines = t.lineitem.select(F.col("l_orderkey").alias("deck_id"), "l_partkey", F.col("l_quantity").cast("long").alias("count"))
    names = t.part.select("p_partkey", F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("raw_name"))
    known = base.select("card_id", F.col("number").cast("long").alias("_num"), n.stat_scope(F.col("card_type"), F.col("trainer_subtype")).alias("_scope"))
    # lines meet one table of parts, not names and cards in turn, and are not sorted for it; whole baskets then go to tasks by their number
    named = names.join(known, F.col("p_partkey") == F.col("_num"), "left").hint("shuffle_hash")
    items = lines.join(named, F.col("l_partkey") == F.col("p_partkey")).select(
        "deck_id", "card_id", "raw_name", "count", F.coalesce("_scope", F.lit("other")).alias("stat_scope")
    ).repartition(tasks_for(t.lineitem), "deck_id")
    closed = base.filter(F.col("number").cast("long") % 9 == 0).select(F.lit("closed").alias("snapshot_id"), "card_id", F.lit("stored").alias("target"))
    stale = base.filter(F.col("number").cast("long") % 7 == 0).select(F.lit("open").alias("snapshot_id"), "card_id", F.lit("stale").alias("target"))
    store = gw.Store(spark, root)
    expected = older.groupBy("set_id").agg(F.count(F.lit(1)).alias("expected"))
    gw.seed(store, base, expected, k.merge_same_item(items), closed.unionByName(stale), "v20010801.1")

    products = raw.groupBy("set_id").agg(F.count_if((F.col("set_id") != "Brand#8") | (num % 4 != 0)).alias("n"))
    releases = t.part.groupBy(F.col("p_brand").alias("set_id")).agg(F.min(c.release_date(F.col("p_partkey"))).alias("release_date"))
    snapshots = spark.createDataFrame([("open", None), ("closed", date(2001, 1, 1))], "snapshot_id string, effective_to date")
    listed = t.part.filter(F.col("p_size") > 45).select(F.col("p_name").alias("group_key")).distinct()
    whitelists = listed.select(F.explode(F.array(F.lit("open"), F.lit("closed"))).alias("snapshot_id"), "group_key")
    grown = gw.grow(store, products, raw, releases, snapshots, whitelists, e.next_data_version("v20010801.1", date(2001, 8, 1)))
    told = store.manifest().filter(F.col("version") == store.version()).drop("version", "activated")
    sizes = {"cards": store.cards().agg(F.count(F.lit(1))).scalar(), "override_rows": store.overrides().agg(F.count(F.lit(1))).scalar()}
    one = {name: told.select(name).scalar() for name in told.columns}
    return grown.sets.withColumns({**one, **sizes})


@query(
    "recaliber",
    star()
    + """SELECT tournament_id, tier, CASE tier WHEN 'master' THEN 5.0::DOUBLE WHEN 'super' THEN 2.0::DOUBLE WHEN 'city' THEN 0.5::DOUBLE END AS tier_coef, (SELECT count(*) FROM tours) AS scanned,
  (SELECT count(*) FROM tours WHERE tier IN ('master','advanced','city')) AS changed FROM tours""",
)
def recaliber(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = [("master", 5.0, []), ("super", 2.0, []), ("city", 0.5, [])]
    tours = b.tournaments(Tables(spark, sf_dir)).select("tournament_id", "tier", "tier_coef")
    renewed, summary = r.recaliber(tours, tiers, "stored hash of the earlier vocabulary")
    value = lambda name: summary.select(name).scalar()
    return renewed.withColumn("scanned", value("scanned")).withColumn("changed", value("changed"))


@query(
    "version_rollback",
    "SELECT p_brand, count(*) AS cards, CAST(1 AS BIGINT) AS version FROM part GROUP BY p_brand",
)
def version_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, root = Tables(spark, sf_dir).part.select("p_partkey", "p_brand"), scratch_dir(spark, "versions")
    r.write_version(part, root, 1)
    r.write_version(part.filter(F.col("p_partkey") % 7 != 0), root, 2)
    version, data = r.rollback(spark, root, 2)
    return data.groupBy("p_brand").agg(F.count(F.lit(1)).alias("cards")).withColumn("version", F.lit(version).cast("long"))


@query(
    "enriched_reingest",
    """SELECT p_partkey AS card_id, CASE WHEN p_brand < 'Brand#2' AND p_partkey % 13 <> 0 THEN upper(p_name) ELSE p_name END AS name,
  CASE WHEN p_partkey % 4 = 0 AND NOT (p_brand < 'Brand#2' AND p_partkey % 10 = 1) THEN 'active' ELSE 'draft' END AS status,
  CASE WHEN p_partkey % 10 <> 1 THEN CASE WHEN p_partkey % 3 = 0 THEN 'J' || p_partkey END END AS name_ja FROM part WHERE (p_brand >= 'Brand#2' AND p_partkey % 10 <> 1) OR (p_brand < 'Brand#2' AND p_partkey % 13 <> 0)""",
)
def enriched_reingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, num = Tables(spark, sf_dir).part, F.col("p_partkey")
    stored = part.filter(num % 10 != 1).select(
        num.alias("card_id"), F.col("p_brand").alias("set_id"), F.col("p_name").alias("name"), F.when(num % 4 == 0, "active").otherwise("draft").alias("status"),
        F.when(num % 3 == 0, F.concat(F.lit("J"), num.cast("string"))).alias("name_ja"),
    )
    fresh = part.filter((F.col("p_brand") < "Brand#2") & (num % 13 != 0)).select(
        num.alias("card_id"), F.col("p_brand").alias("set_id"), F.upper("p_name").alias("name"), F.lit("draft").alias("status"), F.lit(None).cast("string").alias("name_ja")
    )
    return r.reingest(fresh, stored, "card_id", "set_id", {"name_ja": "string"}).drop("set_id")


@query(
    "idempotent_replace",
    """SELECT l_orderkey AS deck_id, count(*) FILTER (l_orderkey % 5 <> 0 OR l_linenumber <= 3) AS lines, l_orderkey % 5 = 0 AND min(l_linenumber) <= 3 AS replaced FROM lineitem
WHERE l_orderkey % 5 <> 0 OR l_linenumber <= 3 OR l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber <= 3) GROUP BY l_orderkey HAVING count(*) FILTER (l_orderkey % 5 <> 0 OR l_linenumber <= 3) > 0
UNION ALL SELECT l_orderkey, count(*), false FROM lineitem WHERE l_orderkey % 5 = 0 GROUP BY l_orderkey HAVING min(l_linenumber) > 3""",
)
def idempotent_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Tables(spark, sf_dir).lineitem.select(F.col("l_orderkey").alias("deck_id"), "l_linenumber", F.lit(False).alias("fresh"))
    incoming = lines.filter((F.col("deck_id") % 5 == 0) & (F.col("l_linenumber") <= 3)).withColumn("fresh", F.lit(True))
    once = r.replace_children(lines, incoming, "deck_id")
    twice = r.replace_children(once, incoming, "deck_id")
    return twice.groupBy("deck_id").agg(F.count(F.lit(1)).alias("lines"), F.max("fresh").alias("replaced"))


@query(
    "unify_sources",
    star()
    + """SELECT CASE segment WHEN 'BUILDING' THEN 'limitless' WHEN 'FURNITURE' THEN 'limitless_site' WHEN 'HOUSEHOLD' THEN 'pokemon_card_jp' ELSE 'mik_moe' END || ':' || o_orderkey AS deck_id,
  CASE segment WHEN 'BUILDING' THEN 'limitless' WHEN 'FURNITURE' THEN 'limitless_site' WHEN 'HOUSEHOLD' THEN 'pokemon_card_jp' ELSE 'mik_moe' END AS source,
  CASE WHEN segment IN ('AUTOMOBILE','MACHINERY') THEN o_totalprice END AS points, CASE WHEN segment = 'BUILDING' THEN o_orderstatus END AS record, CASE WHEN segment <> 'HOUSEHOLD' THEN o_custkey END AS player FROM ord""",
)
def unify_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, seg = b.entries(Tables(spark, sf_dir)), F.col("segment")
    deck, player = F.col("o_orderkey").alias("deck_id"), F.col("o_custkey").alias("player")
    return r.unify_sources(
        {
            "mik_moe": entries.filter(seg.isin("AUTOMOBILE", "MACHINERY")).select(deck, player, F.col("o_totalprice").alias("points")),
            "limitless": entries.filter(seg == "BUILDING").select(deck, player, F.col("o_orderstatus").alias("record")),
            "limitless_site": entries.filter(seg == "FURNITURE").select(deck, player),
            "pokemon_card_jp": entries.filter(seg == "HOUSEHOLD").select(deck),
        },
        ["deck_id"],
    )
