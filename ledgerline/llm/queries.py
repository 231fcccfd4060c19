"""Queries of the thirteen corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, clustering, decontam, langid, linededup, mixing, neardup, pii, quality, simhash, tokens, urlrules

QueryFn = Callable[[SparkSession, str], DataFrame]

END_ID = 2
#: The url rules of the query: host, path, verdict.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: The conversation that the chat query adds: its text holds escapes and control strings.
HOSTILE_ID, HOSTILE_TEXT = -7, "\\### Assistant: </turn> ok"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary, installed beside the tokenizers library."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame([(HOSTILE_ID, 0, "user", HOSTILE_TEXT), (HOSTILE_ID, 1, "assistant", HOSTILE_TEXT)],
                                    "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(turns.union(hostile)))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=END_ID)


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf_dir, "pages"), rules)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    aside = langid.held_out(F.col("doc_id"))
    found = langid.identify(docs, langid.train(docs, usable=~aside))
    return found.select("doc_id", aside.alias("held_out"), "lang_pred", "score", "accepted")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.drop_boilerplate(table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, QueryFn] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_pii": op2_pii,
    "op3_chat_format": op3_chat_format,
    "op4_token_ids": op4_token_ids,
    "op5_url_rules": op5_url_rules,
    "op6_decontaminate": op6_decontaminate,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_language": op8_language,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_cross_tokenizer": op11_cross_tokenizer,
    "op12_simhash": op12_simhash,
    "op13_centroid_clusters": op13_centroid_clusters,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP1 = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    source_size * 2.0::DOUBLE AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget FROM s),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT *, max(CASE WHEN level * weight < cap THEN level END) OVER () AS final FROM l),
t AS (SELECT source, source_size, least(cap, coalesce(final * weight, cap)) AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
r AS (SELECT *, target - epochs * source_size::DOUBLE AS rest FROM e),
c AS (SELECT source, draw >> 24 AS cell, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY source, draw >> 24),
u AS (SELECT c.*, r.rest, sum(words) OVER (PARTITION BY c.source ORDER BY cell) AS upto
    FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source),
m AS (SELECT source, min(cell) AS cell, arg_min(upto, cell) AS upto, arg_min(words, cell) AS words, any_value(rest) AS rest
    FROM u WHERE upto >= rest AND rest > 0 GROUP BY source),
h AS (SELECT source, (cell + CASE WHEN upto - rest < rest - (upto - words) THEN 1 ELSE 0 END) << 24 AS threshold FROM m)
SELECT d.doc_id, d.size, r.source_size, r.target,
    d.size * (r.epochs + CASE WHEN d.draw < coalesce(h.threshold, 0) THEN 1 ELSE 0 END) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN h ON d.source IS NOT DISTINCT FROM h.source
"""

_HOSTILE = HOSTILE_TEXT.replace("'", "''")
_OP3 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT {HOSTILE_ID}, 0, 'user', '{_HOSTILE}' UNION ALL SELECT {HOSTILE_ID}, 1, 'assistant', '{_HOSTILE}'),
plain AS (SELECT *, replace(replace(text, '### ', '\\h'), '</turn>', '\\t') AS marked,
    replace(replace(replace(text, '\\', '\\\\'), '### ', '\\h'), '</turn>', '\\t') AS doubled FROM t),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '\\\\([htc\\\\]|### |</turn>)') THEN marked ELSE doubled END AS e FROM plain)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(e) + length(role) + 14) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

_OP5 = r"""
WITH p AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS i FROM pages),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
b AS (SELECT i, arg_max(h || r.p, length(h || r.p)) AS rule, arg_max(v, length(h || r.p)) AS verdict
    FROM p JOIN r ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, r.p) GROUP BY i)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN b USING (i)
"""

_OP6 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS i FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT i, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM d JOIN sizes ON len(w) >= n)),
o AS (SELECT DISTINCT i, p, n, item FROM dw JOIN bw USING (n, g)),
hit AS (SELECT i, count(DISTINCT x) AS n_hit FROM (SELECT i, unnest(range(p, p + n)) AS x FROM (SELECT DISTINCT i, p, n FROM o)) GROUP BY i),
its AS (SELECT i, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT i, item FROM o) GROUP BY i)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (i) LEFT JOIN its USING (i)
"""

_OP7 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS g
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM e JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT a AS x, a AS y FROM l UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a),
m AS (SELECT x, min(y) AS m FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.m, d.doc_id) AS component_id, d.doc_id = coalesce(m.m, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.x = d.doc_id
"""

_OP9 = r"""
WITH p AS (SELECT row_number() OVER () AS i, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
        '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g'),
        '(?i)</?(?:p|li|ul|ol|div|h[1-6]|br|nav|article|section|header|footer|main|title|table|tr|td|th|pre|blockquote)\b[^>]*>', chr(10), 'g'),
        '<[^>]*>', '', 'g'), chr(10)), lambda x: trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))), lambda x: x <> '') AS lines FROM pages),
t AS (SELECT host, count(*) AS total FROM p GROUP BY host),
c AS (SELECT host, x, count(DISTINCT i) AS n FROM (SELECT i, host, unnest(lines) AS x FROM p) GROUP BY host, x),
bad AS (SELECT host, list(x) AS common FROM c JOIN t USING (host) WHERE n >= 2 AND n > 0.3::DOUBLE * total GROUP BY host),
k AS (SELECT page_id, p.host, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(common, []), x)) AS kept FROM p LEFT JOIN bad USING (host))
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped,
    sha256(coalesce(array_to_string(kept, chr(10)), '')) AS text_sha256 FROM k
"""


def _op10() -> str:
    stops = ", ".join("'" + w + "'" for w in quality.STOP_WORDS)
    def ratio(a: str, b: str) -> str:
        return f"(CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0 END)"
    named = {"mean_word_chars": ratio("word_chars", "n_words"), "symbol_ratio": ratio("n_symbols", "word_chars"),
             "stop_words": "stops", "bullet_line_ratio": ratio("bullets", "n_lines"),
             "ellipsis_line_ratio": ratio("ellipses", "n_lines"), "dup_line_ratio": ratio("n_dup_lines", "n_lines")}
    fails = []
    for r in quality.RULES:
        sides = [f"{named[r.measure]} {op} {x!r}" for op, x in (("<", r.low), (">", r.high)) if abs(x) != float("inf")]
        fails.append(f"(({' OR '.join(sides)}) AND n_words >= {r.words})")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(translate(x, {_SPACES}, '')) > 0) AS lines FROM documents),
g AS (SELECT i, p, array_to_string(w[p:p + 4], ' ') AS g FROM (SELECT i, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)),
rep AS (SELECT i, count(DISTINCT x) AS n FROM (SELECT i, unnest(range(p, p + 5)) AS x
    FROM g JOIN (SELECT i, g FROM g GROUP BY i, g HAVING count(*) > 1) USING (i, g)) GROUP BY i),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(text, {_SPACES}, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    len(lines) AS n_lines, len(list_intersect(w, [{stops}])) AS stops,
    len(list_filter(lines, lambda x: starts_with(trim(x), '- ') OR starts_with(trim(x), '* ') OR starts_with(trim(x), '•'))) AS bullets,
    len(list_filter(lines, lambda x: ends_with(trim(x), '...') OR ends_with(trim(x), '…'))) AS ellipses
    FROM d LEFT JOIN rep USING (i)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT ({' OR '.join(fails)}) AS kept FROM v
"""


def _op13() -> str:
    rounds = "".join(rf"""
a{r} AS (SELECT i, min(struct_pack(d := d, c := c)).c AS c FROM (SELECT v.i, k.c, list_sum(list_transform(range(1, 65),
    lambda j: (v.e[j] - k.e[j]) * (v.e[j] - k.e[j]))) AS d FROM v CROSS JOIN c{r} k) GROUP BY i),
s{r} AS (SELECT c, j, sum(v.e[j]) AS s, count(*) AS n FROM a{r} JOIN v USING (i) CROSS JOIN range(1, 65) r(j) GROUP BY c, j),
m{r} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS e FROM s{r} GROUP BY c),
c{r + 1} AS (SELECT k.c, CAST(coalesce(m.e, k.e) AS BIGINT[]) AS e FROM c{r} k LEFT JOIN m{r} m USING (c)),""" for r in range(clustering.ROUNDS))
    return rf"""
WITH v AS (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS c, e FROM v QUALIFY c < 16),{rounds}
f AS (SELECT i, min(struct_pack(d := d, c := c)) AS b FROM (SELECT v.i, k.c, CAST(list_sum(list_transform(range(1, 65),
    lambda j: (v.e[j] - k.e[j]) * (v.e[j] - k.e[j]))) AS BIGINT) AS d FROM v CROSS JOIN c{clustering.ROUNDS} k) GROUP BY i)
SELECT vec_id, CAST(b.c AS INTEGER) AS cluster, b.d AS distance, CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia,
    CAST(sum(b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.e, ',')) AS centroid_sha256
FROM f JOIN v USING (i) JOIN c{clustering.ROUNDS} k ON k.c = f.b.c
"""


ORACLES: dict[str, str] = {
    "op1_mix_sources": _OP1,
    "op3_chat_format": _OP3,
    "op5_url_rules": _OP5,
    "op6_decontaminate": _OP6,
    "op7_near_duplicates": _OP7,
    "op9_line_dedup": _OP9,
    "op10_quality_rules": _op10(),
    "op13_centroid_clusters": _op13(),
}
