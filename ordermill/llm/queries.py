"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import bpe, chat, divergence, embeds, langid, linedup, mixing, neardup, quality, resample, rules, secrets, warc
from ordermill.llm.store import table

def vocabulary() -> str:
    """Vocabulary file of op8, on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and prediction of each document."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for secrets of each document, by hash, and the forest's verdict."""
    got = secrets.scan(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "place", "part", F.length("value").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"), "probability", "secret")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as they are read back from the archives they were written to."""
    got = warc.round_trip(spark, table(spark, sf_dir, "pages"), keep_payload=False)
    return got.select(warc.page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      warc.page_number("refers_to").alias("refers_to"), F.col("error").isNull().alias("verified"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of each embedding."""
    return embeds.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered pieces of the conversations that are no prefix of a longer one."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    sizes = mixing.measured(table(spark, sf_dir, "documents"))
    got = mixing.mix(sizes)
    per = got.groupBy("doc_id", "source", "size", "rows", "source_size", "target").agg((F.count("copy") * F.col("size")).alias("taken"))
    return per.select("doc_id", "size", "source_size", "target", "taken", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("r")).drop("r")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of each document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of each document and of the text decoded from them."""
    path = vocabulary()
    got = bpe.decode_documents(bpe.encode_documents(table(spark, sf_dir, "documents"), path), path)
    return got.select("doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's text without lines that (nearly) equal an earlier one, and how many those are."""
    got = linedup.deduplicate_lines(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines_left"),
                      F.coalesce(F.size("dropped_lines"), F.lit(0)).cast("long").alias("n_dropped"), "text")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, compression figures and verdict of each document."""
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of each (lang, source) group from the other sources of its language, and its most typical terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document."""
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of each document, drawn towards the benchmark's words."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The plan of the mix: targets, then large documents, then small ones, each by position in the order of the key.
OP6_SQL = """
WITH s AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
u AS (SELECT doc_id, source, size, count(*) AS n_rows, CAST(size * count(*) AS BIGINT) AS weight,
  md5(concat_ws('|', '7', coalesce(CAST(doc_id AS VARCHAR), '-'), CAST(size AS VARCHAR))) AS key FROM s GROUP BY doc_id, source, size),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [1, 2, 3][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS w FROM s GROUP BY source),
r AS (SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER o, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS rest_w,
    row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS place
  FROM p WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT rest AS level, rest_w AS level_w FROM r WHERE rest * w <= 3 * source_size * rest_w ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN w * level >= 3 * source_size * level_w THEN CAST(3 * source_size AS DOUBLE)
    ELSE CAST(w * level AS DOUBLE) / CAST(level_w AS DOUBLE) END AS target FROM p, l),
m AS (SELECT u.*, t.source_size, t.target, u.weight * 200 > t.source_size AS coarse FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source),
line AS (SELECT *, CAST(coalesce(sum(weight) OVER (PARTITION BY source, coarse ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
    CAST(sum(weight) OVER (PARTITION BY source, coarse) AS BIGINT) AS line_size FROM m),
big AS (SELECT *, target * line_size / source_size AS goal FROM line WHERE coarse),
big2 AS (SELECT *, CASE WHEN line_size > 0 THEN least(floor(goal / line_size), 3) ELSE 0 END AS passes FROM big),
big3 AS (SELECT *, CAST(passes + CASE WHEN before + weight / 2.0 < goal - passes * line_size AND passes < 3 THEN 1 ELSE 0 END AS BIGINT) AS copies FROM big2),
got AS (SELECT source, sum(copies * weight) AS large_taken FROM big3 GROUP BY source),
small AS (SELECT line.*, greatest(target - coalesce(large_taken, 0), 0.0) AS goal FROM line LEFT JOIN got ON line.source IS NOT DISTINCT FROM got.source WHERE NOT coarse),
small2 AS (SELECT *, CASE WHEN line_size > 0 THEN least(floor(goal / line_size), 3) ELSE 0 END AS passes FROM small),
small3 AS (SELECT *, CAST(passes + CASE WHEN before + weight / 2.0 < goal - passes * line_size AND passes < 3 THEN 1 ELSE 0 END AS BIGINT) AS copies FROM small2),
every AS (SELECT doc_id, size, n_rows, source_size, target, copies FROM big3 UNION ALL SELECT doc_id, size, n_rows, source_size, target, copies FROM small3)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken FROM (SELECT *, unnest(range(n_rows)) FROM every)"""

#: Every group against every kept term of its language, then against each other source.
OP11_SQL = """
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, r, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL),
g AS (SELECT s.lang, s.source, coalesce(o.total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) s
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) o ON s.lang = o.lang AND s.source = o.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS HUGEINT) AS p,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (k.n + 1) // (l.total + l.v) AS HUGEINT) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN l ON l.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
m AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(m.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x) WHERE part = 'pair' OR rank <= 200"""

#: The checksum goes byte by byte over each distinct word, with a table made from the polynomial.
OP13_SQL = """
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word FROM d),
bw AS (SELECT unnest(w) AS word FROM b),
v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
c AS (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
    lambda a, x: xor(a // 256, tab[CAST(xor(a, x) % 256 AS INT) + 1])), 4294967295) % 10000 AS bucket FROM v, tab),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN c USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN c USING (word) GROUP BY bucket),
g AS (SELECT k.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT bucket FROM s UNION SELECT bucket FROM t) k LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
o AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN c USING (word) JOIN g USING (bucket) GROUP BY doc_id),
r AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM documents LEFT JOIN o USING (doc_id)),
z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
y AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS drawn FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM y"""

QUERIES = {
    "op1_quality_score": op1_quality_score,
    "op2_secret_scan": op2_secret_scan,
    "op3_warc": op3_warc,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_chat_format": op5_chat_format,
    "op6_source_mix": op6_source_mix,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_bpe": op8_bpe,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_divergence_audit": op11_divergence_audit,
    "op12_language_id": op12_language_id,
    "op13_importance_resampling": op13_importance_resampling,
}
ORACLE: dict[str, str] = {
    "op3_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, CAST(5 * g + 1 AS INT), 5) AS BIGINT) >> s) & 31 AS INT), 1)),
    'string_agg', '')), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to, true AS verified
FROM d""",
    "op6_source_mix": OP6_SQL,
    "op11_divergence_audit": OP11_SQL,
    "op13_importance_resampling": OP13_SQL,
    "op5_chat_format": """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
p AS (SELECT conv_id, k, n, CAST(list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY k) AS VARCHAR) AS prefix FROM r),
f AS (SELECT min(conv_id) AS conv_id, prefix, n, count(*) AS copies FROM p WHERE k = n GROUP BY prefix, n),
m AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k < p.n AND p.k = f.n AND p.prefix = f.prefix))
SELECT r.conv_id, (r.k - 1) // 64 AS piece, m.n AS n_turns, m.copies,
  string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '' ORDER BY r.k) AS text
FROM r JOIN m ON r.conv_id = m.conv_id GROUP BY r.conv_id, (r.k - 1) // 64, m.n, m.copies""",
}
