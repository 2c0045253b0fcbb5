"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlane.llm.decontaminate import scan_contamination
from fraudlane.llm.fuzzy_lines import dedup_lines
from fraudlane.llm.html_text import extract_main_text
from fraudlane.llm.importance import resample
from fraudlane.llm.language_id import language_of_documents
from fraudlane.llm.mixing import mix_sources
from fraudlane.llm.near_duplicates import near_duplicates
from fraudlane.llm.quality_crf import quality_scores
from fraudlane.llm.quality_rules import quality_rules
from fraudlane.llm.repeated_bytes import remove_repeated_bytes
from fraudlane.llm.sentence_spans import remove_repeated_passages
from fraudlane.llm.warc import archive_round_trip
from fraudlane.llm.whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_of_documents(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85).drop("fp", "component")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = (
    op1_html_extraction,
    op2_substring_dedup,
    op3_language_id,
    op4_line_dedup,
    op5_near_duplicates,
    op6_decontamination,
    op7_quality_classifier,
    op8_mixing,
    op9_quality_rules,
    op10_warc,
    op11_suffix_dedup,
    op12_whitening,
    op13_importance_resampling,
)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


#: Equal payloads are grouped by themselves here, not by their digests.
OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS low FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> low THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> low THEN low END AS refers_to
FROM f
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: All pairs that share a shingle, and everything each document reaches over links.
OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS g
  FROM d),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a),
c AS (SELECT node, min(reach) AS low FROM r GROUP BY node)
SELECT doc_id, len(g)::BIGINT AS n_shingles, low AS component_id, doc_id = low AS kept FROM s JOIN c ON doc_id = node
"""
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
k AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
    SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
o AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k) WHERE len(w) >= n)),
h AS (SELECT o.doc_id, o.i, o.n, k.item FROM o JOIN k ON o.n = k.n AND o.s = k.s),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
#: Blocks and shards do not matter here: the mix takes whole passes and a prefix of the permuted source.
OP8 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix ' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
w AS (SELECT *, ([3, 1, 2])[rank % 3 + 1] AS weight FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size * (6 // weight), rank
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
    (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY source_size * (6 // weight), rank
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM w),
t AS (SELECT source, source_size, least(weight * (SELECT max(level) FROM l), 2 * source_size::DOUBLE) AS target FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS passes,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN size > 0 THEN size * (passes +
    CASE WHEN 2 * before + size <= 2 * (target - passes * source_size) THEN 1 ELSE 0 END) ELSE 0 END)::BIGINT AS taken
FROM p
"""

#: Every string of 200 bytes by itself, from pieces of 455 bytes; a byte is two digits here, so that places are bytes.
OP11 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) AS n, hex(coalesce(text, '')) AS h FROM documents),
x AS (SELECT r, c, substr(h, 2 * c + 1, 910) AS h FROM (SELECT r, h, unnest(range(0, greatest(n - 199, 0), 256)) AS c FROM d)),
s AS (
  SELECT r, c + j AS p, md5_number(substr(h, 2 * j + 1, 400)) AS k
  FROM (SELECT r, c, h, unnest(range(0, least(256, len(h) // 2 - 199))) AS j FROM x)),
m AS (SELECT r, p FROM s WHERE k IN (SELECT k FROM s GROUP BY k HAVING count(*) > 1)),
g AS (SELECT r, p, coalesce(p - lag(p) OVER (PARTITION BY r ORDER BY p) > 200, true)::INT AS new FROM m),
i AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS run FROM g),
u AS (SELECT r, run, min(p) AS a, max(p) + 200 AS b FROM i GROUP BY r, run),
c AS (
  SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM u),
k AS (
  SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM c JOIN d USING (r) GROUP BY r)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


def _crc_table() -> list[int]:
    """What a byte adds to a CRC-32."""
    table = list(range(256))
    for _ in range(8):
        table = [(n >> 1) ^ (0xEDB88320 if n & 1 else 0) for n in table]
    return table


_CRC_TABLE = _crc_table()
#: Each distinct feature is hashed byte by byte; everything else is counting.
OP13 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
g AS (SELECT doc_id, r, len(w) AS n, w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS f FROM d),
df AS (SELECT r, unnest(f) AS f FROM g),
bf AS (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM b),
v AS (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)),
h AS (
  SELECT f, xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, strlen(f)), lambda i: ('0x' || substr(hex(f), 2 * i + 1, 2))::BIGINT),
    lambda c, x: xor(c >> 8, ({_CRC_TABLE})[xor(c, x) % 256 + 1])), 4294967295) % 10000 AS k
  FROM v),
s AS (SELECT k, count(*) AS n FROM df JOIN h USING (f) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM bf JOIN h USING (f) GROUP BY k),
z AS (SELECT (SELECT count(*) FROM df)::DOUBLE AS s, (SELECT count(*) FROM bf)::DOUBLE AS t),
gain AS (
  SELECT k, floor(1000 * ln((coalesce(t.n, 0) + 1) * (z.s + 10000) / ((coalesce(s.n, 0) + 1) * (z.t + 10000))))::BIGINT AS gain
  FROM (SELECT DISTINCT k FROM h) LEFT JOIN s USING (k) LEFT JOIN t USING (k), z),
w AS (SELECT r, sum(gain)::BIGINT AS total FROM df JOIN h USING (f) JOIN gain USING (k) GROUP BY r),
q AS (
  SELECT doc_id, n, r, len(f) AS n_features, coalesce(floor(total::DOUBLE / len(f)), 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM g LEFT JOIN w USING (r)),
p AS (
  SELECT *, weight + noise AS score, n >= 20 AS able, count(*) FILTER (WHERE n >= 20) OVER () AS total,
    row_number() OVER (PARTITION BY n >= 20 ORDER BY weight + noise DESC, doc_id NULLS LAST) AS place FROM q)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN able AND place <= 25 * total // 100 THEN place END AS rank FROM p
"""


def llm_oracles() -> dict[str, str]:
    return {"op5_near_duplicates": OP5, "op6_decontamination": OP6, "op8_mixing": OP8, "op10_warc": OP10, "op11_suffix_dedup": OP11, "op13_importance_resampling": OP13}
