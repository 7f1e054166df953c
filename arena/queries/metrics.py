"""Metric queries on the basket competition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.functions.vocab import SOURCE_BASIS
from arena.plans import metrics as m
from arena.queries.sql import CARRY, ELIGIBLE, star
from arena.registry import query
from arena.sources import tables as b
from arena.sources.tables import Tables, day_text

PARAMS = m.metric_params(as_of="2001-08-01", window_days=365, basis=None)
WINDOW = (PARAMS.date_from, PARAMS.date_to)


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in cols})


@query(
    "competition_weight_view",
    star() + "SELECT tournament_id, basis, round(static_weight, 9) AS static_weight FROM weights",
)
def competition_weight_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = m.competition_weights(b.tournaments(Tables(spark, sf_dir)))
    return _round(view.select("tournament_id", "basis", "static_weight"), "static_weight")


@query(
    "eligible_competitions",
    star(ELIGIBLE) + "SELECT tournament_id, strftime(date, '%Y-%m-%d') AS day, round(w_t, 9) AS w_t FROM elig",
)
def eligible_competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    comps = m.eligible(b.calendar_star(Tables(spark, sf_dir), WINDOW), PARAMS)
    return _round(comps.select("tournament_id", day_text("date").alias("day"), "w_t"), "w_t")


@query(
    "stat_fact_view",
    star()
    + """SELECT basis, group_key, stat_scope, count(*) AS facts, CAST(sum(cnt) AS BIGINT) AS copies,
  CAST(sum(rank) AS BIGINT) AS rank_sum, CAST(sum(record_wins) AS BIGINT) AS wins
FROM cards c JOIN decks d ON d.deck_id = c.deck_id AND mapping_status = 'full' JOIN apps a ON a.deck_id = c.deck_id
JOIN tours t ON t.tournament_id = a.tournament_id
WHERE stat_scope IN ('pokemon','supporter','stadium') GROUP BY basis, group_key, stat_scope""",
)
def stat_fact_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    plain = b.basket_star(t)
    groups = t.part.select(F.col("p_partkey").alias("card_id"), F.col("p_brand").alias("group_key"))
    facts = m.stat_facts(
        b.Star(plain.tournaments, plain.decks, plain.appearances, plain.deck_cards.drop("group_key"), groups)
    )
    return facts.groupBy("basis", "group_key", "stat_scope").agg(
        F.count(F.lit(1)).alias("facts"), F.sum("count").alias("copies"), F.sum("rank").alias("rank_sum"),
        F.sum("record_wins").alias("wins"),
    )


@query(
    "eligible_semi_join",
    star(ELIGIBLE)
    + """SELECT deck_id, tournament_id, CAST(rank AS BIGINT) AS rank FROM apps
WHERE tournament_id IN (SELECT tournament_id FROM elig)""",
)
def eligible_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = b.basket_star(Tables(spark, sf_dir), WINDOW)
    comps = m.eligible(s, PARAMS).select("tournament_id")
    return s.appearances.join(comps, "tournament_id", "left_semi").select(
        "deck_id", "tournament_id", F.col("rank").cast("long").alias("rank")
    )


@query(
    "share_within_competition",
    star(CARRY) + "SELECT deck_id, tournament_id, round(share, 9) AS share FROM norm",
)
def share_within_competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = b.basket_star(Tables(spark, sf_dir), WINDOW)
    return _round(m.entry_shares(s, m.eligible(s, PARAMS)).select("deck_id", "tournament_id", "share"), "share")


@query(
    "carry_per_entry",
    star(CARRY)
    + """SELECT group_key, tournament_id, deck_id, round(share, 9) AS carry,
  round(share * copies, 9) AS carry_copies FROM carry""",
)
def carry_per_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = b.basket_star(Tables(spark, sf_dir), WINDOW)
    c = m.carries(s, PARAMS, m.eligible(s, PARAMS))
    return _round(
        c.select("group_key", "tournament_id", "deck_id", "carry", (F.col("share") * F.col("copies")).alias("carry_copies")),
        "carry", "carry_copies",
    )


def _usage_sql(factor: str) -> str:
    return (
        star(CARRY)
        + f"""SELECT group_key, round(sum(w_t * share{factor}) / (SELECT sum(w_t) FROM elig), 9) AS value,
  count(*) AS n, count(*) < 5 AS low_confidence FROM wc GROUP BY group_key"""
    )


@query("weighted_usage", _usage_sql(""))
def weighted_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(m.weighted_usage(b.basket_star(Tables(spark, sf_dir), WINDOW), PARAMS), "value")


NAMES = "names AS (SELECT p_brand AS group_key, 'set of ' || min(p_name) AS display_name FROM part WHERE p_brand <> 'Brand#13' GROUP BY 1)"


@query("weighted_usage_named", f"WITH {NAMES}, metric AS ({_usage_sql('')}) SELECT group_key, display_name, value, n, low_confidence FROM metric JOIN names USING (group_key)")
def weighted_usage_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    groups = t.part.filter(F.col("p_brand") != "Brand#13").groupBy(F.col("p_brand").alias("group_key")).agg(
        F.concat(F.lit("set of "), F.min("p_name")).alias("display_name")
    )
    return m.named(weighted_usage(spark, sf_dir), groups)


@query("weighted_usage_copies", _usage_sql(" * copies"))
def weighted_usage_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = m.replace(PARAMS, usage_basis="copies")
    return _round(m.weighted_usage(b.basket_star(Tables(spark, sf_dir), WINDOW), params), "value")


@query(
    "win_rate_records",
    star(CARRY)
    + """SELECT group_key, round((sum(wins) + 0.5 * sum(ties)) / nullif(sum(wins) + sum(losses) + sum(ties), 0), 9) AS value,
  CAST(sum(wins) + sum(losses) + sum(ties) AS BIGINT) AS n, sum(wins) + sum(losses) + sum(ties) < 5 AS low_confidence
FROM carry WHERE wins IS NOT NULL GROUP BY group_key""",
)
def win_rate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(m.win_rate_records(b.basket_star(Tables(spark, sf_dir), WINDOW), PARAMS), "value")


# layer B normalises over the competitions with a known cut and head count
LAYER_B = CARRY.replace(
    "AND static_weight IS NOT NULL)",
    "AND static_weight IS NOT NULL AND topcut_slots IS NOT NULL AND participant_count IS NOT NULL)",
)


@query(
    "topcut_conversion",
    star(LAYER_B)
    + """SELECT group_key,
  round(sum(CASE WHEN rank <= topcut_slots THEN w_t * share ELSE 0 END) / sum(w_t * share), 9) AS value,
  count(*) AS n, count(*) < 5 AS low_confidence,
  round((SELECT sum(w_t * topcut_slots / participant_count) / sum(w_t) FROM elig), 9) AS q0
FROM wc GROUP BY group_key""",
)
def topcut_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(m.topcut_conversion(b.basket_star(Tables(spark, sf_dir), WINDOW), PARAMS), "value", "q0")


WWS = star(CARRY) + """, s AS (SELECT group_key, sum(w_t * share) AS usage,
  sum(CASE WHEN topcut_slots IS NOT NULL AND participant_count IS NOT NULL THEN w_t * share ELSE 0 END) AS u_w,
  sum(CASE WHEN topcut_slots IS NOT NULL AND participant_count IS NOT NULL AND rank <= topcut_slots
      THEN w_t * share ELSE 0 END) AS t_w, count(*) AS apps,
  sum(coalesce(wins, 0)) AS w, sum(CASE WHEN wins IS NOT NULL THEN losses ELSE 0 END) AS l,
  sum(CASE WHEN wins IS NOT NULL THEN ties ELSE 0 END) AS t FROM wc GROUP BY group_key),
q AS (SELECT sum(w_t * topcut_slots / participant_count) / sum(w_t) AS q0 FROM elig
  WHERE topcut_slots IS NOT NULL AND participant_count IS NOT NULL),
tot AS (SELECT sum(w_t) AS w_all FROM elig)
"""


@query(
    "weighted_win_score_a",
    WWS
    + """SELECT group_key, round(usage / w_all * (w + 0.5 * t + 10.0) / (w + l + t + 20.0), 9) AS value,
  CAST(w + l + t AS BIGINT) AS n, w + l + t < 5 AS low_confidence FROM s, tot""",
)
def weighted_win_score_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(m.weighted_win_score(b.basket_star(Tables(spark, sf_dir), WINDOW), PARAMS, "a"), "value")


@query(
    "weighted_win_score",
    WWS
    + """SELECT group_key, round(usage / w_all * (t_w + 10.0 * q0) / (u_w + 10.0), 9) AS value,
  apps AS n, apps < 5 AS low_confidence FROM s, tot, q""",
)
def weighted_win_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(m.weighted_win_score(b.basket_star(Tables(spark, sf_dir), WINDOW), PARAMS, "b"), "value")


@query(
    "group_drilldown",
    star(CARRY)
    + """SELECT tournament_id, name, strftime(date, '%Y-%m-%d') AS day, tier, count(*) AS n_decks,
  round(sum(share), 9) AS weighted_carry,
  count(*) FILTER (rank <= e.topcut_slots) AS topcut_decks, CAST(min(rank) AS BIGINT) AS best_rank
FROM carry JOIN elig e USING (tournament_id) WHERE group_key = 'Brand#7' GROUP BY tournament_id, name, date, tier""",
)
def group_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = m.group_drilldown(b.basket_star(Tables(spark, sf_dir), WINDOW), PARAMS, "Brand#7")
    return _round(out, "weighted_carry").select(
        "tournament_id", "name", day_text("date").alias("day"), "tier", "n_decks", "weighted_carry", "topcut_decks",
        F.col("best_rank").cast("long").alias("best_rank"),
    )


@query(
    "layer_auto_detect",
    star(CARRY) + "SELECT CASE WHEN count(record_wins) > 0 THEN 'a' ELSE 'b' END AS layer FROM norm",
)
def layer_auto_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.detect_layer(b.basket_star(Tables(spark, sf_dir), WINDOW), PARAMS)


@query(
    "metric_meta_echo",
    star(ELIGIBLE)
    + """SELECT '2001-08-01' AS as_of, '2000-08-01' AS date_from, '2001-08-01' AS date_to,
  'pokemon,supporter,stadium' AS scope, 'master' AS division, '' AS tiers, 'all' AS basis, 'decks' AS usage_basis,
  CAST(5 AS BIGINT) AS min_n, count(*) AS n_tournaments
FROM elig WHERE topcut_slots IS NOT NULL AND participant_count IS NOT NULL""",
)
def metric_meta_echo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.metric_meta(b.calendar_star(Tables(spark, sf_dir), WINDOW), PARAMS, layer="b")


@query("metric_ranking", _usage_sql("") + " ORDER BY value DESC, group_key")
def metric_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.ranking(_round(m.weighted_usage(b.basket_star(Tables(spark, sf_dir), WINDOW), PARAMS), "value"))


@query("metric_ranking_top", _usage_sql("") + " ORDER BY value DESC, group_key LIMIT 10")
def metric_ranking_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.ranking(_round(m.weighted_usage(b.basket_star(Tables(spark, sf_dir), WINDOW), PARAMS), "value"), limit=10)


SOURCES = sorted(SOURCE_BASIS)


@query(
    "weighted_usage_by_basis",
    star(CARRY.replace("NOT is_team AND", "NOT is_team AND basis = 'intl_aligned' AND tier = 'super' AND"))
    + """SELECT group_key, round(sum(w_t * share) / (SELECT sum(w_t) FROM elig), 9) AS value,
  count(*) AS n, count(*) < 5 AS low_confidence FROM wc GROUP BY group_key""",
)
def weighted_usage_by_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = m.replace(PARAMS, basis="intl_aligned", tiers=("super",))
    return _round(m.weighted_usage(b.basket_star(Tables(spark, sf_dir), WINDOW), params), "value")
