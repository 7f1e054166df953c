"""Shared SQL of the model binding, used by the equivalent statements."""

# entries, competitions, basket rows, basket status and ranked entries
STAR = """
ord AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS day,
         c_mktsegment AS segment, strftime(o_orderdate, '%Y-%m') || ':' || c_mktsegment AS tournament_id
  FROM orders JOIN customer ON c_custkey = o_custkey),
tours AS (
  SELECT tournament_id, 'Cup ' || tournament_id AS name,
    CASE segment WHEN 'BUILDING' THEN 'limitless' WHEN 'FURNITURE' THEN 'limitless_site'
         WHEN 'HOUSEHOLD' THEN 'pokemon_card_jp' ELSE 'mik_moe' END AS source,
    CASE segment WHEN 'BUILDING' THEN 'intl_aligned' WHEN 'FURNITURE' THEN 'intl_aligned'
         WHEN 'HOUSEHOLD' THEN 'jp' ELSE 'cn' END AS basis,
    CASE segment WHEN 'AUTOMOBILE' THEN 'master' WHEN 'BUILDING' THEN 'super'
         WHEN 'FURNITURE' THEN 'advanced' WHEN 'HOUSEHOLD' THEN 'city' END AS tier,
    CASE segment WHEN 'AUTOMOBILE' THEN 4.0::DOUBLE WHEN 'BUILDING' THEN 2.0::DOUBLE
         WHEN 'FURNITURE' THEN 1.5::DOUBLE WHEN 'HOUSEHOLD' THEN 1.0::DOUBLE END AS tier_coef,
    CASE WHEN month(max(day)) % 2 = 1 THEN NULL WHEN year(max(day)) % 2 = 0 THEN 'master' ELSE 'senior' END AS division,
    max(day) AS date,
    CASE WHEN month(max(day)) <> 7 THEN count(DISTINCT o_custkey) END AS participant_count,
    CASE WHEN month(max(day)) <> 2 THEN 8 END AS topcut_slots,
    month(max(day)) = 1 AS is_qual,
    month(max(day)) = 12 AND segment = 'HOUSEHOLD' AS is_team
  FROM ord GROUP BY tournament_id, segment),
weights AS (
  SELECT *, CASE WHEN participant_count IS NULL THEN tier_coef
                 ELSE tier_coef * log10(participant_count) END AS static_weight FROM tours),
cards AS (
  SELECT l_orderkey AS deck_id, CASE WHEN p_size <= 48 THEN l_partkey END AS card_id, p_name AS raw_name,
    CASE WHEN p_size <= 48 THEN p_brand END AS group_key,
    CASE WHEN p_size > 48 THEN 'other' WHEN p_type IN ('ECONOMY','STANDARD') THEN 'pokemon'
         WHEN p_type IN ('SMALL','MEDIUM') THEN 'supporter' WHEN p_type = 'LARGE' THEN 'stadium'
         ELSE 'other' END AS stat_scope,
    CAST(l_quantity AS BIGINT) AS cnt
  FROM lineitem JOIN part ON p_partkey = l_partkey),
decks AS (
  SELECT deck_id, total, mapped, mapped * 1.0::DOUBLE / total AS mapped_ratio,
    CASE WHEN mapped * 1.0::DOUBLE / total >= 0.95 THEN 'full' WHEN mapped > 0 THEN 'partial' ELSE 'unmapped' END AS mapping_status
  FROM (SELECT deck_id, CAST(sum(cnt) AS BIGINT) AS total,
          CAST(sum(CASE WHEN card_id IS NOT NULL THEN cnt ELSE 0 END) AS BIGINT) AS mapped FROM cards GROUP BY deck_id)),
apps AS (
  SELECT o_orderkey AS deck_id, tournament_id,
    row_number() OVER (PARTITION BY tournament_id ORDER BY o_totalprice DESC, o_orderkey) AS rank,
    CASE o_orderstatus WHEN 'O' THEN 0.0::DOUBLE WHEN 'F' THEN o_totalprice / 1000 END AS points,
    CASE WHEN o_orderstatus <> 'P' THEN coalesce(w, 0) END AS record_wins,
    CASE WHEN o_orderstatus <> 'P' THEN coalesce(l, 0) END AS record_losses,
    CASE WHEN o_orderstatus <> 'P' THEN coalesce(t, 0) END AS record_ties, segment
  FROM ord LEFT JOIN (
    SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS w, count(*) FILTER (l_returnflag = 'A') AS l,
           count(*) FILTER (l_returnflag = 'N') AS t FROM lineitem GROUP BY l_orderkey) r ON l_orderkey = o_orderkey)
"""

# competitions of the default window with their decayed weight
ELIGIBLE = """
elig AS (
  SELECT *, static_weight * pow(0.5, date_diff('day', date, DATE '2001-08-01') / 90.0) AS w_t
  FROM weights WHERE date BETWEEN DATE '2000-08-01' AND DATE '2001-08-01'
    AND (division IS NULL OR division = 'master') AND NOT is_qual AND NOT is_team AND static_weight IS NOT NULL)
"""

# entry shares and (group, entry) carries of the default window
CARRY = ELIGIBLE + """,
app AS (
  SELECT a.*, CASE WHEN points > 0 THEN points ELSE 1.0::DOUBLE / rank END AS w_d
  FROM apps a JOIN decks d ON d.deck_id = a.deck_id AND d.mapping_status = 'full'
  WHERE tournament_id IN (SELECT tournament_id FROM elig)),
norm AS (SELECT *, w_d / sum(w_d) OVER (PARTITION BY tournament_id) AS share FROM app),
carry AS (
  SELECT group_key, n.tournament_id, n.deck_id, n.rank, max(share) AS share, sum(cnt) AS copies,
    max(record_wins) AS wins, max(record_losses) AS losses, max(record_ties) AS ties
  FROM cards c JOIN norm n ON n.deck_id = c.deck_id
  WHERE stat_scope IN ('pokemon','supporter','stadium') AND group_key IS NOT NULL
  GROUP BY group_key, n.tournament_id, n.deck_id, n.rank),
wc AS (SELECT c.*, w_t, topcut_slots, participant_count FROM carry c JOIN elig USING (tournament_id))
"""


def star(*more: str) -> str:
    """WITH clause of the binding plus further CTEs."""
    return "WITH " + ",\n".join([STAR.strip(), *[m.strip() for m in more]]) + "\n"
