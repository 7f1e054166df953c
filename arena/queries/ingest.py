"""End-to-end ingest of the four result channels on the basket competition."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.operators import legality as lg
from arena.operators import normalise as n
from arena.operators import quality as q
from arena.plans import ingest as i
from arena.queries.legality import SEASONS
from arena.queries.resolve import CAT
from arena.queries.sql import star
from arena.registry import query
from arena.session import stored_rows
from arena.sources import catalogue as c
from arena.sources import tables as b
from arena.sources.tables import Tables, day_text, lookup

LINES = 4


@query(
    "ingest_channel",
    star(
        """win AS (SELECT tournament_id FROM tours WHERE source = 'limitless' AND date BETWEEN DATE '1999-01-01' AND DATE '2001-03-31')""",
        """dk AS (SELECT l_orderkey, string_agg(p_name || CASE WHEN p_size > 48 THEN ' v2' ELSE '' END, ',' ORDER BY p_name, p_size > 48) AS content, count(*) AS n, count(*) FILTER (p_size <= 48) AS m
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)""",
        """en AS (SELECT * FROM apps JOIN dk ON l_orderkey = deck_id WHERE tournament_id IN (SELECT tournament_id FROM win))""",
    )
    + f"""SELECT CASE WHEN m = {LINES} THEN 'full' WHEN m > 0 THEN 'partial' ELSE 'unmapped' END AS mapping_status, count(DISTINCT content) AS decks, count(*) AS appearances,
  (SELECT count(DISTINCT deck_id) FROM en WHERE n <> {LINES}) AS blocked FROM en WHERE n = {LINES} GROUP BY 1""",
)
def ingest_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    part = t.part.select("p_partkey", "p_name", "p_size")
    version = F.when(F.col("p_size") > b.MAX_RESOLVED_SIZE, " v2").otherwise("")
    items = t.lineitem.select("l_orderkey", "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("basket_id"), F.lit(None).cast("string").alias("raw_set"), F.lit(None).cast("string").alias("raw_number"),
        F.concat("p_name", version).alias("raw_name"), F.lit(1).alias("count"),
    )
    cards = c.catalogue(t).filter(F.col("size") <= b.MAX_RESOLVED_SIZE).withColumn("name_en", F.col("name_full"))
    result = i.ingest_channel(
        "limitless", b.tournaments(t).filter(F.col("source") == "limitless"), b.appearances(t).drop("source").withColumnRenamed("deck_id", "basket_id"),
        items, cards, calendar=SEASONS, window=(date(1999, 1, 1), date(2001, 3, 31)), size=LINES,
    )
    decks = result.star.decks.select("deck_id", "mapping_status")
    per_deck = result.star.appearances.groupBy("deck_id").agg(F.count(F.lit(1)).alias("n"))
    blocked = result.blocked.agg(F.count_distinct("basket_id")).scalar()
    return decks.join(per_deck, "deck_id").groupBy("mapping_status").agg(F.count(F.lit(1)).alias("decks"), F.sum("n").alias("appearances")).withColumn("blocked", blocked)


# what every channel reports, from tables that each statement defines: comp (tournament_id, slots, tier), jd (judged entries with
# deck, reason), ln (lines of kept contents with card, rule, kind), and the marks of entries outside of their environment
REPORT = f"""
 content AS (SELECT deck, count(*) FILTER (card IS NOT NULL) AS m, max(mark) FILTER (card IS NOT NULL) AS top FROM ln GROUP BY deck),
 kept AS (SELECT deck, tournament_id, rank, count(*) AS seen FROM jd WHERE reason IS NULL GROUP BY 1, 2, 3)
SELECT 'slots' AS section, tournament_id AS key, CAST(slots AS BIGINT) AS n FROM comp
UNION ALL SELECT 'tier', coalesce(tier, 'none'), count(*) FROM comp GROUP BY 2
UNION ALL SELECT 'deck', CASE WHEN m = {LINES} THEN 'full' WHEN m > 0 THEN 'partial' ELSE 'unmapped' END, count(*) FROM content GROUP BY 2
UNION ALL SELECT 'entry', 'kept', count(*) FROM kept HAVING count(*) > 0
UNION ALL SELECT 'repeated', 'entry', count(*) FROM kept WHERE seen > 1 HAVING count(*) > 0
UNION ALL SELECT 'lost', reason, count(*) FROM jd WHERE reason IS NOT NULL GROUP BY 2
UNION ALL SELECT 'blocked', 'size', count(DISTINCT basket) FROM jd WHERE early IS NULL AND n <> {LINES} HAVING count(*) > 0
UNION ALL SELECT 'miss', kind, count(DISTINCT (deck, raw_name, raw_set, raw_number)) FROM ln WHERE card IS NULL GROUP BY 2
UNION ALL SELECT 'rule', rule, count(*) FROM ln GROUP BY 2
UNION ALL SELECT 'env', 'outside', count(*) FROM (SELECT DISTINCT deck, tournament_id FROM kept) JOIN comp USING (tournament_id) JOIN content USING (deck)
  WHERE top IS NOT NULL AND env IS NOT NULL AND NOT list_contains(env, top) HAVING count(*) > 0
"""
EN_ENV = """CASE WHEN {d} BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' THEN ['F','G'] WHEN {d} BETWEEN DATE '1999-01-01' AND DATE '2000-06-30' THEN ['G','H','I']
  WHEN {d} BETWEEN DATE '2000-07-01' AND DATE '2001-03-31' THEN ['G','H'] WHEN {d} >= DATE '2001-04-01' THEN ['H','I'] END"""
JA_ENV = "CASE WHEN {d} BETWEEN DATE '1998-01-01' AND DATE '2000-12-31' THEN ['G','H'] END"
# the newest card of a name, and the newest one of an environment
NEWEST = "first({c} ORDER BY release_date DESC NULLS LAST, card_id)"


@query(
    "ingest_cn",
    star(
        CAT,
        """st AS (SELECT tournament_id, least(count(*), 16) AS c5 FROM apps GROUP BY 1)""",
        """oc AS (SELECT t.*, CASE WHEN topcut_slots IS NOT NULL THEN 'has_value' WHEN is_team THEN 'team' WHEN coalesce(participant_count, 0) = 0 THEN 'no_size'
   WHEN c5 > participant_count THEN 'larger_than_field' WHEN c5 NOT IN (4, 8, 16, 32) THEN 'size_not_allowed' END AS why, c5 FROM tours t LEFT JOIN st USING (tournament_id))""",
        """comp AS (SELECT tournament_id, tier, date, CASE WHEN why IS NULL THEN c5 ELSE topcut_slots END AS slots, CASE WHEN date >= DATE '1999-07-01' THEN ['G','H'] END AS env FROM oc)""",
        """sz AS (SELECT l_orderkey AS basket, count(*) AS n FROM lineitem GROUP BY 1)""",
        f"""jd AS (SELECT basket, CASE WHEN n = {LINES} THEN basket END AS deck, tournament_id, NULL AS early, n, rank,
   CASE WHEN n IS NULL THEN 'no_basket' WHEN n <> {LINES} THEN 'basket_blocked' WHEN rank IS NULL THEN 'no_rank' END AS reason FROM
   (SELECT deck_id AS basket, tournament_id, CASE WHEN deck_id % 13 <> 0 THEN rank END AS rank FROM apps) LEFT JOIN sz USING (basket))""",
        f"""ln AS (SELECT l_orderkey AS deck, name_full AS raw_name, '' AS raw_set, '' AS raw_number, CASE WHEN size <= 48 THEN card_id END AS card, mark,
   CASE WHEN size <= 48 THEN 'card_id' ELSE 'unknown_card_id' END AS rule, 'unknown_card_id' AS kind
   FROM lineitem JOIN cat ON num = l_partkey JOIN sz ON basket = l_orderkey AND n = {LINES})""",
        REPORT,
    )
    + "UNION ALL SELECT 'slots_from_columns', coalesce(why, 'materialized'), count(*) FROM oc GROUP BY 2",
)
def ingest_cn(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cat = c.catalogue(t)
    items = t.lineitem.select("l_orderkey", "l_partkey").join(cat.select("num", "card_id", "name_full", "size"), F.col("l_partkey") == F.col("num")).select(
        F.col("l_orderkey").alias("basket_id"), F.when(F.col("size") <= b.MAX_RESOLVED_SIZE, F.col("card_id")).alias("raw_card_id"),
        F.col("name_full").alias("raw_name"), F.lit(1).alias("count"),
    )
    ranked = stored_rows(b.appearances(t).drop("source"), "cn-ranked")
    entries = ranked.withColumn("rank", F.when(F.col("deck_id") % 13 != 0, F.col("rank"))).withColumnRenamed("deck_id", "basket_id")
    within = [F.count_if(F.col("rank") <= s) for s in (1, 2, 4, 8, 16)]
    static = ranked.groupBy("tournament_id").agg(F.array(*within).alias("topcut_times"))
    comps = b.tournaments(t)
    return i.ingest_report(i.ingest_cn(comps, entries, items, cat, static, calendar=SEASONS, size=LINES))


def printed_items(t: Tables) -> DataFrame:
    """Line items by printed set and number; parts that play unknown items have a name alone."""
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_size")
    known = F.col("p_size") <= b.MAX_RESOLVED_SIZE
    return t.lineitem.select("l_orderkey", "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("basket_id"), F.when(known, F.col("p_brand")).alias("raw_set"),
        F.when(known, F.lpad((F.col("p_partkey") % 100).cast("string"), 3, "0")).alias("raw_number"),
        F.when(known, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" v2"))).alias("raw_name"), F.lit(1).alias("count"),
    )


@query(
    "ingest_site",
    star(
        CAT,
        """ix AS (SELECT tournament_id, segment, max(day) AS date, count(DISTINCT o_custkey) * 8 AS players FROM ord GROUP BY 1, 2)""",
        f"""named AS (SELECT tournament_id, CASE WHEN segment <> 'MACHINERY' THEN date END AS date, CASE WHEN segment = 'MACHINERY' OR players < 32 THEN NULL
   WHEN segment = 'AUTOMOBILE' THEN 'regional' WHEN segment = 'BUILDING' THEN 'league_cup' WHEN segment = 'FURNITURE' THEN 'premier_ball_league' END AS tier FROM ix)""",
        f"""taken AS (SELECT *, {EN_ENV.format(d="date")} AS env, CASE tier WHEN 'regional' THEN 32 WHEN 'league_cup' THEN 8 WHEN 'premier_ball_league' THEN 8 END AS cut
   FROM named WHERE date IS NULL OR date BETWEEN DATE '1999-01-01' AND DATE '2001-03-31')""",
        """raw AS (SELECT l_orderkey AS basket, p_name || CASE WHEN p_size > 48 THEN ' v2' ELSE '' END AS raw_name, CASE WHEN p_size <= 48 THEN p_brand END AS raw_set,
   CASE WHEN p_size <= 48 THEN lpad(CAST(p_partkey % 100 AS VARCHAR), 3, '0') END AS raw_number FROM lineitem JOIN part ON p_partkey = l_partkey)""",
        f"""sz AS (SELECT basket, count(*) AS n, CASE WHEN count(*) = {LINES} THEN string_agg(x, ';' ORDER BY x) END AS deck
   FROM (SELECT basket, concat_ws('/', coalesce(raw_set, '-'), coalesce(raw_number, '-'), raw_name) AS x FROM raw) GROUP BY 1)""",
        """en AS (SELECT tournament_id, date, rank, CASE WHEN basket % 17 <> 0 THEN basket END AS basket, CASE WHEN rank IS NULL THEN 'no_rank' WHEN rank > cut THEN 'beyond_cut'
   WHEN basket % 17 = 0 THEN 'no_basket_id' END AS early FROM
   (SELECT deck_id AS basket, tournament_id, CASE WHEN deck_id % 13 <> 0 THEN rank END AS rank FROM apps) JOIN taken USING (tournament_id))""",
        f"""jd AS (SELECT en.*, n, deck, coalesce(early, CASE WHEN n IS NULL THEN 'no_basket' WHEN n <> {LINES} THEN 'basket_blocked' END) AS reason FROM en LEFT JOIN sz USING (basket))""",
        """firsts AS (SELECT deck, min(basket) AS basket, min(date) AS day FROM jd WHERE early IS NULL AND deck IS NOT NULL GROUP BY 1)""",
        f"""comp AS (SELECT t.*, coalesce(s, 0) AS slots FROM taken t LEFT JOIN (SELECT tournament_id, count(DISTINCT (deck, rank)) AS s FROM jd WHERE reason IS NULL GROUP BY 1) USING (tournament_id))""",
        """prints AS (SELECT p_brand AS raw_set, p_partkey % 100 AS nn, min_by(p_name, p_partkey) AS located FROM part GROUP BY 1, 2)""",
        f"""probes AS (SELECT deck, raw_name, raw_set, raw_number, located, coalesce(located, raw_name) AS name, {EN_ENV.format(d="day")} AS env
   FROM firsts JOIN raw USING (basket) LEFT JOIN prints p ON p.raw_set = raw.raw_set AND p.nn = TRY_CAST(raw_number AS INTEGER))""".replace(
            "SELECT deck, raw_name, raw_set, raw_number", "SELECT deck, raw_name, raw.raw_set, raw_number"
        ),
        f"""found AS (SELECT name, env, count(card_id) AS n, {NEWEST.format(c="card_id")} AS any_card, {NEWEST.format(c="mark")} AS any_mark,
   first(card_id ORDER BY release_date DESC NULLS LAST, card_id) FILTER (list_contains(env, mark)) AS env_card,
   first(mark ORDER BY release_date DESC NULLS LAST, card_id) FILTER (list_contains(env, mark)) AS env_mark
   FROM (SELECT DISTINCT name, env FROM probes) JOIN cat ON name_full = name AND size <= 48 GROUP BY 1, 2)""",
        """ln AS (SELECT deck, raw_name, coalesce(raw_set, '') AS raw_set, coalesce(raw_number, '') AS raw_number, CASE WHEN n > 1 AND env_card IS NOT NULL THEN env_card ELSE any_card END AS card,
   CASE WHEN n > 1 AND env_card IS NOT NULL THEN env_mark ELSE any_mark END AS mark,
   CASE WHEN n IS NULL THEN 'unmapped' ELSE CASE WHEN located IS NULL THEN 'name_fallback' ELSE 'ptcd' END || CASE WHEN n = 1 THEN '+unique' WHEN env_card IS NOT NULL THEN '+env+latest' ELSE '+latest' END END AS rule,
   CASE WHEN located IS NULL THEN 'ptcd_miss' ELSE 'no_cn_printing' END AS kind FROM probes p LEFT JOIN found f ON f.name = p.name AND f.env IS NOT DISTINCT FROM p.env)""",
        REPORT,
    )
    + "UNION ALL SELECT 'rejected', 'out_of_window', count(*) FROM named WHERE NOT (date BETWEEN DATE '1999-01-01' AND DATE '2001-03-31') HAVING count(*) > 0",
)
def ingest_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    names = {"AUTOMOBILE": "Regional ", "BUILDING": "League Cup ", "FURNITURE": "Premier Ball League ", "HOUSEHOLD": "Japan Championships "}
    listed = b.entries(t).filter(F.col("segment") != "MACHINERY").groupBy("tournament_id", "segment").agg(
        F.max("day").alias("date"), (F.count_distinct("o_custkey") * 8).alias("players")
    )
    last = listed.select("tournament_id", F.concat(lookup(F.col("segment"), names), "tournament_id").alias("name"), "players", "date")
    old = last.select("tournament_id", F.lit("World Championships").alias("name"), "players", "date", F.lit(0).alias("seq"))
    index = old.unionByName(last.withColumn("seq", F.lit(1)))
    key = F.col("deck_id")
    ranked = stored_rows(b.ranked_entries(t).select("tournament_id", "rank", F.col("o_orderkey").alias("deck_id")), "site-ranked")
    standings = ranked.select(
        "tournament_id", F.when(key % 13 != 0, F.col("rank")).alias("placing"), F.when(key % 17 != 0, key).alias("basket_id")
    )
    prints = t.part.select(
        F.col("p_brand").alias("set_code"), (F.col("p_partkey") % 100).cast("string").alias("number"), F.col("p_name").alias("located_name"), F.col("p_partkey").alias("seq")
    )
    cards = c.catalogue(t).filter(F.col("size") <= b.MAX_RESOLVED_SIZE).withColumn("name_en", F.col("name_full"))
    result = i.ingest_site(index, standings, printed_items(t), cards, prints, calendar=SEASONS, window=lg.alignment_window("en", SEASONS), size=LINES)
    return i.ingest_report(result)


FETCH_BUDGET = 3000
TITLES = {"1-URGENT": "シティ 一部", "2-HIGH": "シティ 一部", "3-MEDIUM": "ジャパンチャンピオンシップス", "4-NOT SPECIFIED": "シティ 二部", "5-LOW": None}
CATEGORIES = {"AUTOMOBILE": "champions", "BUILDING": "city-league", "HOUSEHOLD": "city-league", "MACHINERY": "jim-battle", "FURNITURE": "news"}
PLACES = ["優勝", "準優勝", "TOP4", "TOP8", "TOP16", "ベスト4", "参加", None, "32位"]


@query(
    "ingest_jp",
    star(
        CAT,
        """ev AS (SELECT tournament_id AS article, o_orderpriority AS p, segment, max(max(day)) OVER (PARTITION BY tournament_id) AS date,
   CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'シティ 一部' WHEN o_orderpriority = '3-MEDIUM' THEN 'ジャパンチャンピオンシップス' WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'シティ 二部' END AS title
   FROM ord GROUP BY tournament_id, o_orderpriority, segment)""",
        f"""jg AS (SELECT 'pokemon_card_jp:' || article || ':' || substr(sha1(title), 1, 10) || CASE WHEN row_number() OVER (PARTITION BY article, title ORDER BY p) > 1 THEN '#2' ELSE '' END AS tournament_id,
   article, p, date, CASE WHEN title = 'ジャパンチャンピオンシップス' THEN 'pjcs' WHEN segment = 'AUTOMOBILE' THEN 'cl' ELSE 'city' END AS tier,
   CASE WHEN segment = 'MACHINERY' THEN 'refused_category' WHEN segment = 'FURNITURE' THEN 'unknown_category'
     WHEN segment <> 'AUTOMOBILE' AND (SELECT count(*) FROM orders) > {FETCH_BUDGET} THEN 'degraded'
     WHEN date NOT BETWEEN DATE '1998-01-01' AND DATE '2000-12-31' THEN 'out_of_window' END AS refused FROM ev)""",
        f"""taken AS (SELECT *, {JA_ENV.format(d="date")} AS env FROM jg WHERE refused IS NULL)""",
        """raw AS (SELECT l_orderkey AS basket, l_partkey AS official, CASE WHEN p_size <= 48 THEN p_name || CASE WHEN p_partkey % 3 > 0 THEN ' ' || p_brand ELSE '' END END AS ja FROM lineitem JOIN part ON p_partkey = l_partkey)""",
        f"""sz AS (SELECT basket, count(*) AS n, CASE WHEN count(*) = {LINES} THEN string_agg(official, ';' ORDER BY official) END AS deck FROM raw GROUP BY 1)""",
        f"""jd AS (SELECT t.tournament_id, date, rank, basket, NULL AS early, n, deck,
   CASE WHEN n IS NULL THEN 'no_basket' WHEN n <> {LINES} THEN 'basket_blocked' WHEN rank IS NULL THEN 'unknown_placement' END AS reason FROM
   (SELECT o_orderkey AS basket, tournament_id AS article, o_orderpriority AS p, [1, 2, 4, 8, 16, 4, NULL, NULL, 32][o_orderkey % 9 + 1] AS rank FROM ord)
   JOIN taken t USING (article, p) LEFT JOIN sz USING (basket))""",
        """firsts AS (SELECT deck, min(basket) AS basket, min(date) AS day FROM jd WHERE deck IS NOT NULL GROUP BY 1)""",
        """comp AS (SELECT t.*, coalesce(s, 0) AS slots FROM taken t LEFT JOIN (SELECT tournament_id, count(DISTINCT (deck, rank)) AS s FROM jd WHERE reason IS NULL GROUP BY 1) USING (tournament_id))""",
        f"""probes AS (SELECT deck, official, ja AS name, {JA_ENV.format(d="day")} AS env FROM firsts JOIN raw USING (basket))""",
        f"""found AS (SELECT name, env, count(*) AS n, count(DISTINCT set_id) AS groups, {NEWEST.format(c="card_id")} AS any_card, {NEWEST.format(c="mark")} AS any_mark,
   first(card_id ORDER BY release_date DESC NULLS LAST, card_id) FILTER (list_contains(env, mark)) AS env_card,
   first(mark ORDER BY release_date DESC NULLS LAST, card_id) FILTER (list_contains(env, mark)) AS env_mark
   FROM (SELECT DISTINCT name, env FROM probes WHERE name IS NOT NULL) JOIN cat ON name_full || CASE WHEN num % 3 > 0 THEN ' ' || set_id ELSE '' END = name AND num % 7 <> 0 GROUP BY 1, 2)""",
        """ln AS (SELECT deck, coalesce(p.name, 'card_id:' || official) AS raw_name, '' AS raw_set, '' AS raw_number,
   CASE WHEN n > 1 AND groups > 1 THEN NULL WHEN n > 1 AND env_card IS NOT NULL THEN env_card ELSE any_card END AS card,
   CASE WHEN n > 1 AND env_card IS NOT NULL THEN env_mark ELSE any_mark END AS mark,
   CASE WHEN p.name IS NULL THEN 'unknown_card_id' WHEN n IS NULL THEN 'ja_name+unmapped' WHEN n = 1 THEN 'ja_name+unique' WHEN groups > 1 THEN 'ja_name+ambiguous'
     WHEN env_card IS NOT NULL THEN 'ja_name+group_env' ELSE 'ja_name+group_latest' END AS rule,
   CASE WHEN p.name IS NULL THEN 'unknown_card_id' WHEN n IS NULL THEN 'no_ja_name_match' ELSE 'ambiguous_ja_name' END AS kind
   FROM probes p LEFT JOIN found f ON f.name = p.name AND f.env IS NOT DISTINCT FROM p.env)""",
        REPORT,
    )
    + "UNION ALL SELECT 'rejected', refused, count(*) FROM jg WHERE refused IS NOT NULL GROUP BY 2",
)
def ingest_jp(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    played = b.entries(t)
    priority = F.col("o_orderpriority")
    seq = F.substring(priority, 1, 1).cast("int")
    days = played.groupBy("tournament_id", "segment").agg(F.max("day").alias("date"))
    category = lookup(F.col("segment"), CATEGORIES)
    events = played.select("tournament_id", "o_orderpriority").distinct().join(days, "tournament_id").select(
        F.col("tournament_id").alias("article_id"), seq.alias("seq"), category.alias("category"), F.concat(F.lit("結果 "), "tournament_id").alias("article_title"),
        lookup(priority, TITLES).alias("event_title"), "date",
    )
    words = F.array(*[F.lit(w) for w in PLACES])
    refs = played.select(
        F.col("tournament_id").alias("article_id"), seq.alias("seq"), F.col("o_orderkey").alias("basket_id"),
        F.get(words, (F.col("o_orderkey") % 9).cast("int")).alias("placement"), category.alias("category"),
    )
    plan = q.budget_guard(refs, "basket_id", "category", i.PRIORITY_CATEGORY, FETCH_BUDGET)
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_size")
    named = lambda key, name, group: F.when(key % 3 > 0, F.concat_ws(" ", name, group)).otherwise(F.col(name))
    absent = F.lit(None).cast("string")
    items = t.lineitem.select("l_orderkey", "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("basket_id"), F.col("l_partkey").alias("official_id"), absent.alias("raw_set"), absent.alias("raw_number"),
        F.when(F.col("p_size") <= b.MAX_RESOLVED_SIZE, named(F.col("p_partkey"), "p_name", "p_brand")).alias("raw_name"), F.lit(1).alias("count"),
    )
    cards = c.catalogue(t).withColumn("name_ja", F.when(F.col("num") % 7 != 0, named(F.col("num"), "name_full", "set_id"))).withColumn("group_key", F.col("set_id"))
    result = i.ingest_jp(events, refs.drop("category"), items, cards, plan, calendar=SEASONS, window=lg.alignment_window("ja", SEASONS), size=LINES)
    return i.ingest_report(result)


@query(
    "normalise_sets",
    f"""WITH {CAT} SELECT set_id, 'set ' || set_id AS name_zh, CASE min(num) % 4 WHEN 0 THEN '太阳&月亮' WHEN 1 THEN '朱&紫' WHEN 2 THEN '特典' ELSE '未划分' END AS era,
  CASE WHEN min(num) % 3 <> 0 THEN strftime(min(release_date), '%Y-%m-%d') END AS release_day, string_agg(DISTINCT mark, ',' ORDER BY mark) AS regulation_mark,
  concat_ws(',', CASE WHEN min(num) % 4 = 3 THEN 'series' END, CASE WHEN count(DISTINCT mark) > 1 THEN 'regulation_mark' END) AS questions FROM cat GROUP BY set_id""",
)
def normalise_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = c.catalogue(Tables(spark, sf_dir))
    first, day = F.col("_k"), F.col("_d")
    series = F.element_at(F.array(*[F.lit(s) for s in ("Sun & Moon", "Scarlet & Violet", "30th", "Mystery")]), (first % 4 + 1).cast("int"))
    products = cat.groupBy("set_id").agg(F.min("num").alias("_k"), F.min("release_date").alias("_d"), F.count(F.lit(1)).alias("cards_num")).select(
        "set_id", F.concat(F.lit("set "), "set_id").alias("name"), series.alias("series"),
        F.when(first % 3 == 0, "0001-01-01T00:00:00").otherwise(F.concat(day_text(day), F.lit("T00:00:00"))).alias("release_text"), "cards_num",
    )
    sets = n.normalise_sets(products, q.set_mark_summary(cat))
    return sets.select("set_id", "name_zh", "era", day_text("release_date").alias("release_day"), "regulation_mark", F.array_join("questions", ",").alias("questions"))
