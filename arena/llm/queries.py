"""Registered queries of the operators, each over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.llm.block_anchors import NULL_ID, remove_repeats
from arena.llm.chat_turns import canonical_turns, formatted, loss_text, records_of, turns_back
from arena.llm.common import computed, stored, table, words
from arena.llm.line_runs import drop_frequent_lines
from arena.llm.merkle_audit import audit, warc_body, with_offsets
from arena.llm.metric_join import join_vectors
from arena.llm.periodic_runs import find_runs
from arena.llm.prob_minhash import near_classes
from arena.llm.pu_quality import fit_scorer, held_out, score_texts
from arena.llm.quality_rules import STOP_WORDS, judged
from arena.llm.split_mix import mix
from arena.llm.tier_packing import pack_documents
from arena.llm.turn_repair import repair
from arena.llm.url_rules import WORD_RULES, judge_urls, site_rule
from arena.registry import query

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"
_STOPS = ", ".join(f"'{w}'" for s in STOP_WORDS for w in (s, s.capitalize()))


@query(
    "op10_quality_rules",
    f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    w AS (SELECT doc_id, body, regexp_extract_all(body, '{_WORD}') AS ws,
                 list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM t),
    g AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS win
          FROM w, unnest(range(1, len(ws) - 6)) AS u(i)),
    r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1),
    c AS (SELECT doc_id, sum(least(8, i - coalesce(before, i - 8)))::BIGINT AS n_repeat_words
          FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM r) GROUP BY doc_id),
    m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                 len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                 (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
                 coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                 len(regexp_extract_all(body, '!')) AS n_excl, len(regexp_extract_all(body, '\\p{{Lu}}')) AS n_upper,
                 len(list_filter(ws, lambda x: x IN ({_STOPS}))) AS n_stop
          FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
    b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND n_symbols <= 0.15 * n_words AND n_excl <= 0.15 * n_words
           AND n_upper <= 0.45 * word_chars AND word_chars BETWEEN 2 * n_words AND 15 * n_words
           AND n_dup_lines <= 0.4 * n_lines AND n_stop >= 0.02 * n_words AS kept
    FROM b
    """,
)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("m")
    base = (m.n_words < 20) | (100 * m.n_repeat_words > 30 * m.n_words)
    return judged(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), m.n_words.alias("n_words"), m.word_chars.alias("word_chars"),
        m.n_symbols.alias("n_symbols"), m.lines.dup.alias("n_dup_lines"), m.n_repeat_words.alias("n_repeat_words"),
        base.alias("base_failed"), (F.col("kept") & ~base).alias("kept"),
    )


SITE_RULES = (
    site_rule("block", "net", "/"),
    site_rule("allow", "example.net", "/en/"),
    site_rule("block", "example.com", "/de/"),
    site_rule("allow", "org", "/fr/"),
)


@query(
    "op4_url_rules",
    r"""
    WITH p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
    s AS (SELECT page_id, CASE WHEN instr(u, '://') > 0 THEN substr(u, instr(u, '://') + 3) ELSE '' END AS rest FROM p),
    h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM s),
    k AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
    r(host, path, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                     ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    f AS (SELECT k.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
                 arg_max(r.action, length(r.host || r.path)) AS action
          FROM k JOIN r ON (k.host = r.host OR k.host LIKE '%.' || r.host) AND starts_with(k.path, r.path) GROUP BY 1)
    SELECT k.page_id, host, path, f.rule,
           coalesce(f.action, CASE WHEN regexp_matches(host || path,
               '(?i)(^|[^a-z0-9])(casino|porn|xxx|torrent|escort|viagra|betting|warez)([^a-z0-9]|$)')
               THEN 'block' ELSE 'allow' END) AS verdict
    FROM k LEFT JOIN f ON f.page_id = k.page_id
    """,
)
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, SITE_RULES + WORD_RULES, keep=("page_id",))


@query(
    "op7_schema_turns",
    r"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
    e AS (SELECT *, 23 + length(role) + length(text)
                 + len(regexp_extract_all(text, '\\')) + len(regexp_extract_all(role, '\\'))
                 + len(regexp_extract_all(text, '<\||</?s>|\[/?INST\]')) + len(regexp_extract_all(role, '<\||</?s>|\[/?INST\]')) AS n
          FROM t)
    SELECT conv_id, count(*)::BIGINT AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
           sum(n)::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id
    """,
)
def op7_schema_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = canonical_turns(records_of(rows.unionByName(probe)), keep=("conv_id",))
    back = computed(
        formatted(turns),
        F.struct(turns_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss")).alias("loss")), "b",
    )
    read = F.array_join(F.transform("b.turns", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("b.turns").cast("long").alias("n_turns"), F.sha2(read, 256).alias("turns_sha256"),
        F.length("b.loss").cast("long").alias("loss_chars"), F.sha2("b.loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op5_split_tree_mix")
def op5_split_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    plan = mix(docs, weights=(5, 2, 1))
    by_shard = plan.draws.groupBy("sid", "begin", "shard").agg(F.sum("length").alias("words"))
    each = F.array_sort(F.collect_list(F.struct("shard", "words")))
    taken = by_shard.groupBy("sid", "begin").agg(F.sum("words").alias("taken"), F.array_join(F.transform(each, lambda x: F.concat_ws(":", x.shard, x.words)), " ").alias("shards"))
    # rows without words share their place with the row after them, and take nothing
    sized = plan.rows.join(taken, ["sid", "begin"], "left")
    some = F.col("size") > 0
    return sized.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        F.when(some, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken"),
        F.when(some, F.coalesce("shards", F.lit(""))).otherwise("").alias("shards"),
    )


@query("op2_tier_packing")
def op2_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "context", "step_group"
    )


@query(
    "op6_metric_range_join",
    """
    WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    u AS (SELECT * FROM v WHERE label IS NOT NULL AND list_inner_product(e, e) > 0 AND isfinite(list_inner_product(e, e))),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON b.label = a.label AND b.vec_id <> a.vec_id
          WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.93),
    r AS (SELECT vec_id AS id, vec_id AS node FROM v UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.node),
    c AS (SELECT id, min(node) AS component_id FROM r GROUP BY id),
    n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
    SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, id = component_id AS kept FROM c LEFT JOIN n ON n.a = c.id
    """,
)
def op6_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query("op9_pu_quality")
def op9_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    web = docs.select("doc_id").filter(~held_out(F.col("doc_id")))
    scorer = fit_scorer(docs, labels.filter("quality = 1"), web)
    return score_texts(docs, scorer).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query(
    "op1_merkle_audit",
    """
    WITH r AS (SELECT page_id, (page_id // 1000)::VARCHAR AS archive, substr(md5(page_id::VARCHAR), 1, 2) AS luck,
                      strlen('WARC/1.0' || 'WARC-Type: response' || 'WARC-Target-URI: ' || coalesce(url, '') || 'Content-Length: '
                             || strlen(coalesce(html, ''))::VARCHAR || coalesce(html, '')) + 14 AS length FROM pages),
    o AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
                 AS "offset" FROM r)
    SELECT archive, "offset", length::BIGINT AS length, (length + CASE WHEN luck IN ('02', '12') THEN 3 ELSE 0 END)::BIGINT AS copy_length,
           'changed' AS problem, "offset" // 65536 AS leaf FROM o WHERE luck IN ('00', '10', '02', '12')
    UNION ALL
    SELECT archive, "offset", length::BIGINT, NULL, 'missing', "offset" // 65536 FROM o WHERE luck IN ('01', '11')
    UNION ALL
    SELECT archive, "offset" + 1, NULL, length::BIGINT, 'extra', ("offset" + 1) // 65536 FROM o WHERE luck IN ('03', '13')
    """,
)
def op1_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits the pages as archives of 1000 against a copy that has altered, lost, lengthened and added records."""
    luck = F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 2)
    body = warc_body(F.col("url"), F.col("html"))
    altered = F.when(luck.isin("00", "10"), F.concat(F.lit("X").cast("binary"), F.substring(body, 2, 2**31 - 1)))
    altered = altered.when(luck.isin("02", "12"), F.concat(body, F.lit("\x00\r\n").cast("binary"))).otherwise(body)
    read = table(spark, sf_dir, "pages").select(
        F.floor(F.col("page_id") / 1000).cast("string").alias("archive"), "page_id", luck.alias("luck"),
        F.octet_length(body).cast("long").alias("length"), F.sha2(body, 256).alias("digest"),
        F.octet_length(altered).cast("long").alias("copy_length"), F.sha2(altered, 256).alias("copy_digest"),
    )
    index = stored(with_offsets(read, "archive", "page_id", "length"), "warc-index")
    theirs = index.select("archive", "offset", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest"), "luck")
    added = theirs.filter(F.col("luck").isin("03", "13")).withColumn("offset", F.col("offset") + 1)
    copy = theirs.filter(~F.col("luck").isin("01", "11")).unionByName(added).drop("luck")
    return audit(index.select("archive", "offset", "length", "digest"), copy)


@query(
    "op3_block_anchors",
    f"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
    g AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS win FROM w, unnest(range(1, len(ws) - 18)) AS u(i)),
    r AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
    c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r),
    x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
    k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.p) FILTER (c.p IS NULL) AS kept, count(c.p) AS gone
          FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.p = x.p GROUP BY x.doc_id)
    SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN k ON k.doc_id = w.doc_id
    """,
)
def op3_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
    return left.select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256")
    )


@query(
    "op8_prob_minhash",
    f"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle, len(list_distinct(ws[i:i + 4])) AS weight
          FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS u(i) WHERE len(ws) > 0),
    n AS (SELECT doc_id, sum(weight) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.weight) AS m FROM s a JOIN s b ON b.shingle = a.shingle AND b.doc_id <> a.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE m >= 0.8 * (x.n + y.n - m) - 1e-9),
    r AS (SELECT doc_id AS id, doc_id AS node FROM w UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.node),
    c AS (SELECT id, min(node) AS class_id FROM r GROUP BY id)
    SELECT id AS doc_id, class_id, id = class_id AS kept FROM c
    """,
)
def op8_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text in SQL, bit by bit."""
    bits = f"list_transform(range(8 * strlen({text})), lambda k: (ord(substr({text}, (k // 8 + 1)::INT, 1)) >> (k % 8)::INT) & 1)"
    step = "lambda a, b: xor(a >> 1, 3988292384 * (xor(a, b) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), {step}), 4294967295)"


@query(
    "op11_periodic_runs",
    f"""
    WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws, {_crc32("doc_id::VARCHAR")} AS h FROM documents),
    s AS (SELECT doc_id, ws, len(ws) AS n, h, (h // 10) % greatest(len(ws), 1) AS a, 3 + (h // 10) % 8 AS parts FROM t),
    p AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
                 ws[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END + 1]) ELSE ws END AS ws FROM s),
    k AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 6], ' ') AS gram FROM p, unnest(range(0, n - 5)) AS u(i)),
    e AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM k a JOIN k b ON b.doc_id = a.doc_id AND b.gram = a.gram AND b.i > a.i),
    f AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
    r AS (SELECT doc_id, start, length, min(q) AS period
          FROM (SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length FROM f GROUP BY doc_id, q, island)
          WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
    b AS (SELECT doc_id, count(*) AS n_runs, arg_max(struct_pack(s := start, l := length, p := period), length * 1000000000 - start) AS best,
                 string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY doc_id),
    c AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
    x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM p),
    y AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) FILTER (c.i IS NULL) AS kept
          FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.i = x.i GROUP BY x.doc_id)
    SELECT p.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.p::BIGINT AS period,
           ((1000 * best.l) // best.p)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
           sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM p LEFT JOIN b ON b.doc_id = p.doc_id LEFT JOIN y ON y.doc_id = p.doc_id
    """,
)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents, of which a tenth by checksum is made periodic from some word on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    docs = computed(docs, F.when(F.col("h") % 10 == 0, words(F.col("text"))), "said")
    n, g = F.size("said").cast("long"), F.floor(F.col("h") / 10)
    docs = docs.withColumn("a", F.when(n > 0, g % n))
    docs = docs.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("long"))
    place = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    made = F.array_join(F.transform(place, lambda i: F.get(F.col("said"), i.cast("int"))), " ")
    made = docs.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return find_runs(made).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-best.start).alias("start"), best.length.alias("length"),
        (-best.period).alias("period"), F.floor(1000 * best.length / -best.period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op13_line_runs",
    """
    WITH b AS (SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS blank),
    t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    x AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM t),
    k AS (SELECT doc_id, i, line, translate(trim(line, blank), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x, b),
    f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
    FROM k LEFT JOIN f ON f.key = k.key GROUP BY doc_id
    """,
)
def op13_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def _edits(keep: int | None, due: int, due_role: str, state: int) -> str:
    """Cheapest of the edits of a row in one state of the recursion below, as a struct (cost, audit, text)."""
    kept = "NULL" if keep is None else f"s{keep}"
    return f"""list_min([
        struct_pack(c := s{state}.c + 2, a := 'D' || s{state}.a, t := s{state}.t),
        CASE WHEN NOT goes THEN struct_pack(c := s{due}.c + 1 + more, a := 'R' || s{due}.a, t := chr(10) || '{due_role}:' || text || s{due}.t) END
        {f", CASE WHEN NOT goes AND initial = '{'sua'[keep - 1]}' THEN struct_pack(c := {kept}.c + more, a := 'K' || {kept}.a, t := chr(10) || role || ':' || text || {kept}.t) END" if keep else ""}
        {f", CASE WHEN NOT goes AND initial = 'u' THEN struct_pack(c := s2.c + more, a := 'K' || s2.a, t := chr(10) || role || ':' || text || s2.t) END" if keep == 1 else ""}
    ])"""


def _inserted(state: str, due: str, role: str) -> str:
    return f"list_min([{state}, struct_pack(c := {due}.c + 5, a := 'I' || {due}.a, t := chr(10) || '{role}:' || {due}.t)])"


@query(
    "op12_turn_repair",
    f"""
    WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations),
    h AS (SELECT *, {_crc32("place")} % 20 AS luck FROM o),
    d AS (SELECT conv_id, turn, CASE WHEN luck = 4 THEN 'user' ELSE role END AS role,
                 CASE WHEN luck = 1 THEN '' WHEN luck = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(range(CASE WHEN luck = 3 THEN 2 ELSE 1 END)) AS again FROM h WHERE luck <> 0),
    z AS (SELECT *, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen, substr(role, 1, 1) AS initial,
                 row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) > 1 AS twin,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i FROM d),
    r AS (SELECT *, seen = '' AS blank, seen <> '' AND twin AS duplicate, seen <> '' AND NOT twin AND substr(seen, -1) NOT IN ('.', '!', '?') AS truncated,
                 seen = '' OR twin AS goes, CASE WHEN substr(seen, -1) NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS more,
                 lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM z),
    f AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                 count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
                 count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
    v(conv_id, i, s0, s1, s2, s3) AS (
        SELECT conv_id, n, {{'c': 0::BIGINT, 'a': '', 't': ''}}, {{'c': 10::BIGINT, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}},
               {{'c': 5::BIGINT, 'a': 'I', 't': chr(10) || 'assistant:'}}, {{'c': 0::BIGINT, 'a': '', 't': ''}} FROM f
        UNION ALL
        SELECT conv_id, i, {_inserted("b0", "c2", "user")}, {_inserted("b1", "c2", "user")}, c2, {_inserted("b3", "b2", "user")}
        FROM (SELECT *, {_inserted("b2", "b3", "assistant")} AS c2 FROM (
            SELECT v.conv_id, v.i - 1 AS i, {_edits(1, 2, "user", 0)} AS b0, {_edits(2, 2, "user", 1)} AS b1,
                   {_edits(3, 3, "assistant", 2)} AS b2, {_edits(2, 2, "user", 3)} AS b3
            FROM v JOIN r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.i = v.i))),
    e AS (SELECT conv_id, s0 FROM v WHERE i = 0)
    SELECT p.conv_id, coalesce(f.gaps, 0)::BIGINT AS gaps, coalesce(f.blank, 0)::BIGINT AS blank, coalesce(f.duplicate, 0)::BIGINT AS duplicate,
           coalesce(f.truncated, 0)::BIGINT AS truncated, coalesce(f.illegal, 0)::BIGINT AS illegal, coalesce(e.s0.c, 0)::BIGINT AS cost,
           coalesce(e.s0.a, '') AS audit, sha256(coalesce(substr(e.s0.t, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) p LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id
    LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM p.conv_id
    """,
)
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs the conversations after a fifth of their rows was dropped, emptied, cut, repeated or given another role."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    hurt = rows.withColumn("luck", F.crc32(place) % 20).filter("luck <> 0")
    text = F.coalesce("text", F.lit(" "))
    text = F.when(F.col("luck") == 1, "").when(F.col("luck") == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(F.col("luck") == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    hurt = hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("luck") == 3, 2).otherwise(1))))
    blocks = repair(hurt, digest=True)
    figures = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    pieces = F.array_sort(F.collect_list(F.struct("block", "audit")))
    whole = blocks.groupBy("key").agg(
        *[F.max(c).alias(c) for c in (*figures, "digest")], F.array_join(F.transform(pieces, lambda x: x.audit), "").alias("audit")
    )
    known = rows.select("conv_id").distinct()
    joined = known.join(whole, known["conv_id"].cast("string").eqNullSafe(whole["key"]), "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in figures], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
