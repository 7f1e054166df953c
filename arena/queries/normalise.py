"""Normalisation and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.functions import text as x
from arena.functions import vocab as v
from arena.functions.parallel import parse_json
from arena.operators import normalise as n
from arena.queries.sql import star
from arena.registry import query
from arena.sources import catalogue as c
from arena.sources import tables as b
from arena.sources.tables import Tables, day_text

RARITIES = ["C", "U", "R"]

# the raw record binding, in SQL
RAW = """raw AS (
  SELECT p_partkey AS k, p_size AS s, p_name, p_brand, p_type,
    p_type IN ('ECONOMY','STANDARD') AS mon,
    CASE WHEN p_partkey % 101 = 0 THEN 'Mystery' ELSE CASE p_type WHEN 'ECONOMY' THEN 'Pokemon' WHEN 'STANDARD' THEN 'Pokemon'
      WHEN 'SMALL' THEN 'Supporter' WHEN 'MEDIUM' THEN 'Item' WHEN 'LARGE' THEN 'Stadium' ELSE 'Special Energy' END END AS ct,
    ['GX','V','ex','Radiant','Prism Star','ACE SPEC','Odd'][p_size % 7 + 1] AS mech,
    ['TAG TEAM','Ancient','Strange'][p_partkey % 3 + 1] AS lab,
    ['Basic','Stage 1','Stage 2','VMAX','V-UNION','VSTAR'][p_partkey % 6 + 1] AS st,
    repeat('GRWLPFDMYC'[p_partkey % 10 + 1], CAST(p_partkey % 3 AS BIGINT)) || repeat('C', CAST(p_size % 3 AS BIGINT)) AS body,
    CASE WHEN p_partkey % 11 = 0 THEN '+' WHEN p_partkey % 97 = 0 THEN '?' ELSE '' END AS tail,
    ['C','U','R','XX'][p_size % 4 + 1] AS rarity
  FROM part)"""

RULE = """CASE WHEN mon AND st = 'VMAX' THEN 'vmax' WHEN mon AND st = 'V-UNION' THEN 'v_union' WHEN mon AND st = 'VSTAR' THEN 'vstar'
    WHEN mech = 'GX' AND lab = 'TAG TEAM' THEN 'tag_team_gx' WHEN mech = 'GX' THEN 'gx' WHEN mech = 'V' THEN 'v'
    WHEN mech = 'ex' THEN 'ex' WHEN mech = 'Radiant' THEN 'radiant' WHEN mech = 'Prism Star' THEN 'prism_star' END"""

PRIZE = """CASE rule WHEN 'ex' THEN 2 WHEN 'gx' THEN 2 WHEN 'tag_team_gx' THEN 3 WHEN 'v_union' THEN 3 WHEN 'v' THEN 2
    WHEN 'vmax' THEN 3 WHEN 'vstar' THEN 2 ELSE 1 END"""

ENERGY_SQL = "map {" + ", ".join(f"'{k}': '{val}'" for k, val in v.ENERGY_CODES.items()) + "}"


def _parsed_cards(t: Tables) -> DataFrame:
    return parse_json(c.raw_cards(t), "body", c.RAW_SCHEMA)


@query(
    "normalise_card_record",
    f"""WITH {RAW}, tot AS (SELECT p_brand AS set_id, count(*) AS total FROM part GROUP BY p_brand),
r AS (SELECT *, {RULE} AS rule,
  CASE WHEN ct = 'Mystery' THEN 'card_type' WHEN mon AND tail = '?' THEN 'cost' END AS reason FROM raw)
SELECT p_brand || '-' || k AS card_id,
  CASE WHEN reason IS NULL THEN k || '/' || total END AS number_display,
  CASE WHEN reason IS NULL THEN rule END AS rule_box_type,
  CASE WHEN reason IS NULL THEN CAST({PRIZE} AS BIGINT) END AS prize_cards,
  CASE WHEN reason IS NULL THEN CAST(CASE WHEN mech = 'ACE SPEC' OR rule IN ('prism_star','radiant','v_union') THEN 1 ELSE 4 END AS BIGINT) END AS deck_limit,
  CASE WHEN reason IS NULL THEN CASE WHEN mon THEN CAST(s * 7 AS BIGINT) END END AS hp,
  CASE WHEN reason IS NULL AND mon THEN coalesce(array_to_string(list_transform(regexp_extract_all(body, '(G+|R+|W+|L+|P+|F+|D+|M+|Y+|N+|C+)'),
     lambda z: {ENERGY_SQL}[z[1]] || length(z)), ','), '') END AS cost,
  CASE WHEN reason IS NULL AND mon AND tail = '+' THEN '+' END AS cost_modifier,
  CASE WHEN reason IS NULL AND mon THEN CAST(s * 10 AS BIGINT) END AS damage_base,
  CASE WHEN reason IS NULL THEN concat_ws(',', CASE WHEN mech = 'Odd' THEN 'mechanic' END, CASE WHEN lab = 'Strange' THEN 'label' END,
     CASE WHEN rarity = 'XX' THEN 'rarity' END, CASE WHEN ct = 'Special Energy' THEN 'provides' END) END AS questions,
  reason
FROM r JOIN tot ON set_id = p_brand""",
)
def normalise_card_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    totals = t.part.groupBy(F.col("p_brand").alias("set_id")).agg(F.count(F.lit(1)).cast("int").alias("face_total"))
    cards, rejects = n.normalise_cards(_parsed_cards(t), totals, rarities=RARITIES)
    cost = F.transform(F.col("attacks")[0]["cost"], lambda p: F.concat(p["type"], p["count"].cast("string")))
    good = cards.select(
        "card_id", "number_display", "rule_box_type", F.col("prize_cards").cast("long").alias("prize_cards"),
        F.col("deck_limit").cast("long").alias("deck_limit"), F.col("hp").cast("long").alias("hp"),
        F.array_join(cost, ",").alias("cost"), F.col("attacks")[0]["cost_modifier"].alias("cost_modifier"),
        F.col("attacks")[0]["damage_base"].cast("long").alias("damage_base"),
        F.array_join("questions", ",").alias("questions"), F.lit(None).cast("string").alias("reason"),
    )
    return good.unionByName(rejects, allowMissingColumns=True)


@query(
    "derive_scope",
    """SELECT card_type, subtype, count(*) AS n,
  CASE WHEN card_type = 'pokemon' THEN 'pokemon' WHEN card_type = 'trainer' AND subtype = '支援者' THEN 'supporter'
       WHEN card_type = 'trainer' AND subtype = '竞技场' THEN 'stadium' ELSE 'other' END AS scope,
  card_type IN ('pokemon','energy') OR (card_type = 'trainer' AND subtype IN ('支援者','竞技场','物品')) AS known
FROM (SELECT CASE WHEN p_partkey % 7 = 0 THEN 'puzzle' WHEN p_type IN ('ECONOMY','STANDARD') THEN 'pokemon'
   WHEN p_type = 'PROMO' THEN 'energy' ELSE 'trainer' END AS card_type,
   CASE p_type WHEN 'SMALL' THEN '支援者' WHEN 'MEDIUM' THEN '物品' WHEN 'LARGE' THEN '竞技场' ELSE '' END AS subtype FROM part)
GROUP BY card_type, subtype""",
)
def derive_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = c.catalogue(Tables(spark, sf_dir)).select(
        F.when(F.col("num") % 7 == 0, "puzzle").otherwise(F.col("card_type")).alias("card_type"),
        F.coalesce("trainer_subtype", F.lit("")).alias("subtype"),
    )
    ct, st = F.col("card_type"), F.col("subtype")
    return cat.groupBy("card_type", "subtype").agg(F.count(F.lit(1)).alias("n")).select(
        "card_type", "subtype", "n", n.stat_scope(ct, st).alias("scope"), n.scope_is_known(ct, st).alias("known")
    )


PRIORITIES = [("high", 2.0, ["1-urgent", "2-high"]), ("medium", 1.0, ["3-medium"])]


@query(
    "normalise_vocab_value",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'high' WHEN o_orderpriority = '3-MEDIUM' THEN 'medium'
    ELSE o_orderpriority END AS tier,
  CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 2.0::DOUBLE WHEN o_orderpriority = '3-MEDIUM' THEN 1.0::DOUBLE END AS tier_coef,
  o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') AS tier_known FROM orders""",
)
def normalise_vocab_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", F.concat(F.lit(" "), "o_orderpriority").alias("raw"))
    return n.tier_of(orders, "raw", PRIORITIES).drop("raw")


@query(
    "classify_first_match",
    """SELECT p_partkey,
  CASE WHEN p_size >= 32 THEN CASE WHEN regexp_matches(p_name, 'ring|rod') THEN 'ringlike' WHEN regexp_matches(p_name, 'hot|red') THEN 'warm' END END AS tier,
  CASE WHEN p_size < 32 THEN 'too_few_players' WHEN regexp_matches(p_name, 'ring|rod|hot|red') THEN 'accepted'
       WHEN regexp_matches(p_name, '^cold') THEN 'cold' ELSE 'no_match' END AS reason FROM part""",
)
def classify_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = n.classify_first_match(
        F.col("p_name"), F.col("p_size"), [("ringlike", "RING|ROD"), ("warm", "hot|red")], [("cold", "^cold")],
        v.SITE_MIN_PLAYERS,
    )
    return Tables(spark, sf_dir).part.select("p_partkey", result.alias("c")).select("p_partkey", "c.tier", "c.reason")


@query(
    "title_override_tier",
    star()
    + """SELECT tournament_id, CASE WHEN segment IN ('BUILDING','HOUSEHOLD') THEN
    CASE WHEN tournament_id LIKE '%-12:%' THEN 'pjcs' WHEN segment = 'BUILDING' THEN 'cl' ELSE 'city' END END AS tier,
  CASE WHEN segment IN ('BUILDING','HOUSEHOLD') THEN 'accepted' WHEN segment = 'MACHINERY' THEN 'refused_category' ELSE 'unknown_category' END AS reason
FROM (SELECT DISTINCT tournament_id, segment FROM ord)""",
)
def title_override_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.entries(Tables(spark, sf_dir)).select("tournament_id", "segment").distinct()
    result = n.title_override_tier(
        [F.lit(None).cast("string"), F.col("tournament_id")], F.col("segment"),
        [("BUILDING", "cl"), ("HOUSEHOLD", "city"), ("MACHINERY", None)], [("-12:", "pjcs")],
    )
    return events.select("tournament_id", result.alias("c")).select("tournament_id", "c.tier", "c.reason")


@query(
    "normalise_competition",
    """WITH l AS (SELECT o_orderkey AS id, o_orderpriority AS type, o_orderstatus, o_custkey, o_orderdate, o_totalprice FROM orders),
r AS (SELECT l.*, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'place ' || c_nationkey ELSE '' END AS d_loc,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'many' END AS d_n,
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 10:00' END AS d_date,
  CASE WHEN c_custkey % 5 = 0 THEN 'Open' ELSE NULL END AS d_reg
  FROM l JOIN customer ON c_custkey = o_custkey)
SELECT 'mik_moe:' || id AS tournament_id, 'cup ' || id AS name,
  type AS tier, CAST(NULL AS DOUBLE) AS tier_coef,
  CASE o_orderstatus WHEN 'O' THEN 'master' WHEN 'F' THEN 'senior' END AS division,
  CASE WHEN d_date <> '' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN id % 6 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
  coalesce(nullif(d_loc, ''), 'hall') AS location,
  CAST(coalesce(TRY_CAST(d_n AS INTEGER), CAST(floor(o_totalprice) AS INTEGER)) AS BIGINT) AS participant_count,
  lower(coalesce(d_reg, 'Standard')) AS format FROM r""",
)
def normalise_competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    day = day_text("o_orderdate")
    orders = t.orders
    listing = orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("cup "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("type"),
        F.when(F.col("o_orderstatus") == "O", "公开组").when(F.col("o_orderstatus") == "F", "Senior").otherwise("").alias("division"),
        F.when(F.col("o_orderkey") % 6 == 0, "soon").otherwise(F.date_format("o_orderdate", "d MMM yy")).alias("endDate"),
        F.lit("hall").alias("location"), F.floor("o_totalprice").cast("string").alias("participantCount"),
        F.lit("Standard").alias("regulation"), F.lit(False).alias("isQual"), F.lit(False).alias("isTeam"),
    )
    key = F.col("c_custkey")
    detail = orders.select("o_orderkey", "o_custkey", "o_orderdate").join(
        t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == key
    ).select(
        F.col("o_orderkey").alias("id"), F.lit(None).cast("string").alias("name"),
        F.when(key % 3 == 1, F.concat(F.lit("place "), F.col("c_nationkey").cast("string"))).when(key % 3 == 2, "").alias("location"),
        F.when(key % 2 == 0, key.cast("string")).otherwise("many").alias("participantCount"),
        F.when(key % 4 == 0, "").otherwise(F.concat(day, F.lit(" 10:00"))).alias("date"),
        F.when(key % 5 == 0, "Open").alias("regulation"), F.lit(None).cast("boolean").alias("isQual"),
        F.lit(None).cast("boolean").alias("isTeam"),
    )
    return n.normalise_competitions(listing, detail).select(
        "tournament_id", "name", "tier", "tier_coef", "division", day_text("date").alias("day"), "location",
        F.col("participant_count").cast("long").alias("participant_count"), "format",
    )


@query(
    "explode_entries",
    """SELECT strftime(o_orderdate, '%Y-%m') AS tournament_id, d.deck AS deck_id,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 64 + 1 AS BIGINT) END AS rank, o_totalprice AS points,
  CASE WHEN o_orderkey % 13 <> 0 THEN 'p' || o_custkey END AS player_ref, o_orderpriority AS archetype_id
FROM orders, (VALUES (0), (1)) i(j),
LATERAL (SELECT CASE WHEN j = 0 THEN CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END
  WHEN o_orderkey % 7 = 0 THEN o_orderkey + 1000000 END AS deck) d WHERE d.deck IS NOT NULL""",
)
def explode_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    deck = lambda cond, val: F.struct(F.when(cond, val).alias("deckId"), F.col("o_orderpriority").alias("variantId"))
    player = lambda prefix: F.struct(F.lit("n").alias("nickname"), F.concat(F.lit(prefix), F.col("o_custkey").cast("string")).alias("pinCode"))  # noqa: E731,E501
    record = F.struct(
        F.when(key % 9 == 0, "DNF").otherwise((key % 64 + 1).cast("string")).alias("rank"),
        F.col("o_totalprice").cast("string").alias("points"),
        F.when(key % 13 != 0, F.array(player("p"), player("q"))).otherwise(F.array()).alias("players"),
        F.array(deck(F.col("o_orderstatus") != "P", key), deck(key % 7 == 0, key + 1000000)).alias("decks"),
    )
    raw = Tables(spark, sf_dir).orders.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("tournament_id"), F.to_json(record).alias("body")
    )
    out = n.explode_entries(parse_json(raw, "body", n.ENTRY_SCHEMA))
    return out.withColumn("rank", F.col("rank").cast("long"))


@query(
    "explode_basket_items",
    """SELECT l_orderkey AS deck_id, CAST(count(*) AS BIGINT) AS items, CAST(sum(q) AS BIGINT) AS copies, min(nm) AS first_name FROM (
  SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS q, 'main ' || l_partkey AS nm FROM lineitem WHERE l_linenumber % 2 = 0
  UNION ALL SELECT l_orderkey, l_linenumber, 'mon ' || l_partkey FROM lineitem WHERE l_linenumber % 2 = 1 AND l_linenumber <> 3
  UNION ALL SELECT l_orderkey, CAST(l_quantity AS BIGINT), 'aid ' || l_suppkey FROM lineitem WHERE l_linenumber % 2 = 1)
GROUP BY l_orderkey""",
)
def explode_basket_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, odd = F.col("l_linenumber"), F.col("l_linenumber") % 2 == 1
    qty = F.col("l_quantity").cast("int").cast("string")

    def item(count, prefix, ref):
        return F.array(F.struct(
            count.alias("count"), F.lit("S1").alias("set"), F.col(ref).cast("string").alias("number"),
            F.concat(F.lit(prefix), F.col(ref).cast("string")).alias("name"),
        ))

    record = F.struct(
        F.when(~odd, item(qty, "main ", "l_partkey")).alias("cards"),
        F.when(odd, item(F.when(line == 3, "x").otherwise(line.cast("string")), "mon ", "l_partkey")).alias("pokemon"),
        F.when(odd, item(qty, "aid ", "l_suppkey")).alias("trainer"),
        F.when(odd, item(qty, "", "l_suppkey")).alias("unused"),
    )
    docs = Tables(spark, sf_dir).lineitem.select(F.col("l_orderkey").alias("deck_id"), F.to_json(record).alias("body"))
    items = n.explode_basket_items(parse_json(docs, "body", n.BASKET_SCHEMA))
    return items.groupBy("deck_id").agg(
        F.count(F.lit(1)).alias("items"), F.sum("count").alias("copies"), F.min("raw_name").alias("first_name")
    )


PAIR_SQL = """pr AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS tournament_id, CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS phase,
  CASE WHEN event_type = 'error' THEN NULL ELSE hour(ts) END AS rnd, user_id % 5 AS tbl, 'u' || user_id AS p1,
  CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'u' || ((user_id * 7 + 3) % 150) END AS p2,
  CASE event_id % 3 WHEN 1 THEN 'u' || user_id WHEN 2 THEN 'x' END AS winner FROM events),
good AS (SELECT * FROM pr WHERE rnd IS NOT NULL AND p2 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY tournament_id, phase, rnd, tbl ORDER BY event_id DESC) = 1)"""


def raw_pairings(t: Tables) -> DataFrame:
    user = F.col("user_id")
    record = F.struct(
        F.when(F.col("event_type") == "error", "?").otherwise(F.hour("ts").cast("string")).alias("round"),
        F.when(F.col("event_type") == "purchase", "2").otherwise("1").alias("phase"),
        (user % 5).cast("string").alias("table"),
        F.when(F.col("event_id") % 3 == 1, F.concat(F.lit("u"), user.cast("string"))).when(F.col("event_id") % 3 == 2, "x").otherwise("").alias("winner"),
        F.concat(F.lit("u"), user.cast("string")).alias("player1"),
        F.when(user % 10 != 0, F.concat(F.lit("u"), ((user * 7 + 3) % 150).cast("string"))).otherwise("").alias("player2"),
    )
    raw = t.events.select("event_id", day_text("ts").alias("tournament_id"), F.to_json(record).alias("body"))
    return parse_json(raw, "body", n.PAIRING_SCHEMA)


@query(
    "normalise_pairings",
    f"""WITH {PAIR_SQL}
SELECT event_id, tournament_id, CAST(phase AS BIGINT) AS phase, CAST(rnd AS BIGINT) AS round, p1 AS player1, p2 AS player2, winner,
  CAST(NULL AS VARCHAR) AS reason FROM good
UNION ALL SELECT event_id, tournament_id, CAST(phase AS BIGINT), CAST(rnd AS BIGINT), p1, p2, winner,
  CASE WHEN rnd IS NULL THEN 'number' ELSE 'player' END FROM pr WHERE rnd IS NULL OR p2 IS NULL""",
)
def normalise_pairings(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, rejects = n.normalise_pairings(raw_pairings(Tables(spark, sf_dir)), "event_id")
    both = good.withColumn("reason", F.lit(None).cast("string")).unionByName(rejects)
    return both.select(
        "event_id", "tournament_id", F.col("phase").cast("long").alias("phase"), F.col("round").cast("long").alias("round"),
        "player1", "player2", "winner", "reason",
    )


@query(
    "split_owner_suffix",
    """SELECT p_partkey, CASE WHEN p_name LIKE 'small %' THEN 'small' WHEN p_name LIKE 'hot %' THEN 'hot' END AS owner,
  CASE WHEN r LIKE '%ring' THEN left(r, length(r) - 4) WHEN r LIKE '%od' THEN left(r, length(r) - 2) ELSE r END AS species
FROM (SELECT *, CASE WHEN p_name LIKE 'small %' THEN substr(p_name, 7) WHEN p_name LIKE 'hot %' THEN substr(p_name, 5) ELSE p_name END AS r FROM part)""",
)
def split_owner_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, owners = F.col("p_name"), ["small", "hot"]
    return Tables(spark, sf_dir).part.select(
        "p_partkey", x.owner_prefix(name, owners, " ").alias("owner"),
        x.species_name(name, owners, " ", ["ring", "od"]).alias("species"),
    )


@query(
    "name_group_key",
    """SELECT g AS group_key, count(*) AS prints FROM (SELECT CASE WHEN p_name IN ('red ring', 'blue bolt') THEN p_name
  WHEN p_size % 2 = 0 THEN p_name || '(' || p_brand || ')' ELSE p_name END AS g FROM part) GROUP BY g""",
)
def name_group_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit("("), "p_brand", F.lit(")"))).otherwise(F.col("p_name"))
    key = x.name_group_key(name, ["red ring", "blue bolt"], "(")
    return Tables(spark, sf_dir).part.groupBy(key.alias("group_key")).agg(F.count(F.lit(1)).alias("prints"))


@query(
    "run_length_cost",
    f"""WITH {RAW} SELECT k AS num, body || tail AS cost,
  coalesce(array_to_string(list_transform(regexp_extract_all(body, '(G+|R+|W+|L+|P+|F+|D+|M+|Y+|N+|C+)'),
     lambda z: {ENERGY_SQL}[z[1]] || length(z)), ','), '') AS parsed,
  CASE WHEN tail = '+' THEN '+' END AS modifier, tail <> '?' AS known FROM raw WHERE mon""",
)
def run_length_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = F.col("r.pokemonAttr.attack")[0]["cost"]
    parts = F.transform(x.run_length_cost(F.col("cost")), lambda p: F.concat(p["type"], p["count"].cast("string")))
    return _parsed_cards(Tables(spark, sf_dir)).filter(cost.isNotNull()).select("num", cost.alias("cost")).select(
        "num", "cost", F.array_join(parts, ",").alias("parsed"), x.cost_modifier(F.col("cost")).alias("modifier"),
        x.cost_is_known(F.col("cost")).alias("known"),
    )


@query(
    "parse_amount_modifier",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag <> 'N') AS BIGINT) AS base_sum,
  CASE l_returnflag WHEN 'R' THEN '×' WHEN 'A' THEN CASE WHEN l_linestatus = 'F' THEN '+' END END AS modifier, l_returnflag <> 'N' AS known
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def parse_amount_modifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    suffix = F.when(flag == "R", "×").when((flag == "A") & (status == "F"), "+").when(flag == "N", "?").otherwise("")
    text = F.concat(F.col("l_quantity").cast("int").cast("string"), suffix)
    lines = Tables(spark, sf_dir).lineitem.select("l_returnflag", "l_linestatus", text.alias("amount"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(x.amount_base(F.col("amount"))).alias("base_sum"),
        F.max(x.amount_modifier(F.col("amount"))).alias("modifier"), F.min(x.amount_is_known(F.col("amount"))).alias("known"),
    )


@query(
    "rule_type_derivation",
    f"""WITH {RAW}, r AS (SELECT *, {RULE} AS rule FROM raw)
SELECT k AS num, rule AS rule_box_type, CAST({PRIZE} AS BIGINT) AS prize_cards,
  CAST(CASE WHEN mech = 'ACE SPEC' OR rule IN ('prism_star','radiant','v_union') THEN 1 ELSE 4 END AS BIGINT) AS deck_limit,
  mech = 'ACE SPEC' AS is_ace_spec, CASE WHEN lab = 'Ancient' THEN '古代' END AS tags FROM r""",
)
def rule_type_derivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    mech, labels, stage = F.col("r.mechanic"), F.col("r.label"), F.col("r.pokemonAttr.stage")
    rule, ace = n.rule_box(mech, labels, stage), n.is_ace_spec(mech, labels, F.col("r.name"))
    return _parsed_cards(Tables(spark, sf_dir)).select(
        "num", rule.alias("rule_box_type"), n.prize_cards(rule).cast("long").alias("prize_cards"),
        n.deck_limit(rule, ace).cast("long").alias("deck_limit"), ace.alias("is_ace_spec"),
        F.array_join(n.label_tags(labels), ",").alias("tags"),
    )


@query(
    "normalise_name",
    """SELECT doc_id, regexp_replace(strip_accents(replace(lower(text), 'ß', 'ss')), '[^a-z0-9]', '', 'g') AS norm FROM documents""",
)
def normalise_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).documents.select("doc_id", "text").select("doc_id", x.normalise_name("text").alias("norm"))


@query(
    "strip_bracket_suffix",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name || ' (' || p_brand || ')' ELSE p_name END AS without_edition, p_name AS base FROM part""",
)
def strip_bracket_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    bracket = F.when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))).otherwise(F.col("p_name"))
    marked = F.when(F.col("p_size") % 2 == 0, F.concat(bracket, F.lit("（ace spec）"))).otherwise(bracket)
    return Tables(spark, sf_dir).part.select("p_partkey", x.strip_edition_marker(marked).alias("without_edition")).select(
        "p_partkey", "without_edition", x.strip_bracket_suffix(F.col("without_edition")).alias("base")
    )


@query(
    "season_label",
    """SELECT season, count(*) AS n, '9900' AS span_first, CAST(3 AS BIGINT) AS span_size FROM (SELECT CASE WHEN month(o_orderdate) >= 8
  THEN printf('%02d%02d', year(o_orderdate) % 100, (year(o_orderdate) + 1) % 100)
  ELSE printf('%02d%02d', (year(o_orderdate) - 1) % 100, year(o_orderdate) % 100) END AS season FROM orders) GROUP BY season""",
)
def season_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = x.seasons_spanned(F.lit("2000-07-01").cast("date"), F.lit("2001-08-01").cast("date"))
    seasons = Tables(spark, sf_dir).orders.groupBy(x.season_label(F.col("o_orderdate")).alias("season"))
    return seasons.agg(F.count(F.lit(1)).alias("n")).select(
        "season", "n", span[0].alias("span_first"), F.size(span).cast("long").alias("span_size")
    )


@query(
    "text_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def text_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey") % 5
    written = (
        F.when(key == 0, day_text("o_orderdate")).when(key == 1, F.concat(day_text("o_orderdate"), F.lit("T10:00:00Z")))
        .when(key == 4, "99 Foo 26").otherwise(F.concat(F.lit("on "), F.date_format("o_orderdate", "d MMM yy")))
    )
    return Tables(spark, sf_dir).orders.select("o_orderkey", day_text(x.text_date(written)).alias("day"))


@query(
    "set_suffix_split",
    """SELECT p_partkey, p_name AS name, CASE WHEN p_size % 4 <> 0 THEN 'S' || p_size END AS set_code,
  CASE WHEN p_size % 4 <> 0 THEN lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') END AS number,
  CASE WHEN p_size % 4 = 1 THEN '250' END AS total FROM part""",
)
def set_suffix_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    number = F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")
    tail = F.when(size % 4 == 1, F.concat(number, F.lit("/250"))).otherwise(number)
    name = F.when(size % 4 != 0, F.concat("p_name", F.lit("(S"), size.cast("string"), F.lit(" "), tail, F.lit(")"))).otherwise(F.col("p_name"))
    out = Tables(spark, sf_dir).part.select("p_partkey", x.set_suffix(name).alias("s"))
    return out.select("p_partkey", "s.name", F.col("s.set").alias("set_code"), "s.number", "s.total")
