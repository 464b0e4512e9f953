"""The queries of this subpackage's operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm.decontaminate import contamination_report
from gneiss.llm.jaccard_join import jaccard_join
from gneiss.llm.language_id import language_id
from gneiss.llm.line_dedup import dedup_lines
from gneiss.llm.lm_scoring import lm_scores
from gneiss.llm.mixing import mix_sources

from gneiss.llm.quality_rules import quality_rules
from gneiss.llm.suffix_dedup import suffix_dedup
from gneiss.llm.token_counts import token_counts, unigram_vocabulary
from gneiss.llm.warc import archive_round_trip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents"), shingle=4, percent=85)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"), length=200).drop("kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(_table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), unigram_vocabulary())


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(_table(spark, sf_dir, "documents"), short=True)
    return out.select("doc_id", "n_lines", "n_removed", "n_links", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).drop("source")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_lm_scoring, op2_jaccard_join, op3_suffix_dedup, op4_language_id, op5_decontamination, op6_quality_rules, op7_warc, op8_token_counts, op9_line_dedup, op10_mixing)}


_OP2 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 4 THEN [array_to_string(a, ' ')]
    ELSE list_transform(range(1, len(a) - 2), lambda i: array_to_string(a[i:i + 3], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n i ON i.doc_id = a JOIN n j ON j.doc_id = b WHERE 100 * k >= 85 * (i.n + j.n - k)),
r AS (SELECT doc_id AS node, doc_id AS reach FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.reach),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node),
d AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.node = w.doc_id LEFT JOIN d ON d.a = w.doc_id
"""


_OP10 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR)) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2.0::DOUBLE * source_size AS room, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3) + 1]::DOUBLE AS weight FROM s),
f AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5 - coalesce(sum(room) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY room / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT arg_min(level, room / weight) AS level FROM f WHERE level * weight < room),
t AS (SELECT w.source, source_size, coalesce(least(room, g.level * weight), room) AS target FROM w LEFT JOIN g ON true),
p AS (
  SELECT d.doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + least(greatest(budget % source_size - ahead, 0), size) END AS BIGINT) AS taken
FROM p
"""


_OP7 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND n >= 100
"""


_OP3 = """
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 400)) AS h FROM (SELECT doc_id, x, unnest(range(n - 199)) AS i FROM d)),
q AS (SELECT h FROM p GROUP BY h HAVING count(*) > 1),
c AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM p SEMI JOIN q USING (h)),
r AS (SELECT doc_id, i, count(*) FILTER (before IS NULL OR i > before + 200) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM c),
s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM r GROUP BY doc_id, run),
k AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM s
  UNION ALL SELECT d.doc_id, coalesce(max(b), 0), n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id, n)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n - sum(b - a) AS BIGINT) AS n_removed, CAST(count(*) - 1 AS BIGINT) AS n_spans,
  sha256(unhex(string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a))) AS kept_sha256
FROM d JOIN k USING (doc_id) GROUP BY d.doc_id, n, x
"""


# An item of up to 64 words lies in one passage of 128 words, a longer one anywhere in the document.
_OP5 = r"""
WITH w AS (
  SELECT doc_id, NULL AS item_id, text FROM documents UNION ALL SELECT NULL, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
v AS (
  SELECT doc_id, item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM w),
g AS (
  SELECT doc_id, item_id, i, len(a) AS n, greatest(len(a) - 4, 1) AS grams, array_to_string(a[i + 1:i + 5], ' ') AS s
  FROM (SELECT *, unnest(range(greatest(len(a) - 4, 1))) AS i FROM v WHERE len(a) > 0)),
b AS (SELECT DISTINCT item_id, n > 64 AS long, i >= (grams + 1) // 2 AS answer, s FROM g WHERE item_id IS NOT NULL),
z AS (SELECT item_id, answer, count(*) AS size FROM b GROUP BY ALL),
h AS (
  SELECT DISTINCT doc_id, b.item_id, answer, s, CASE WHEN long THEN -1 ELSE i // 64 - back END AS passage
  FROM g JOIN b USING (s), (VALUES (0), (1)) AS t(back)
  WHERE doc_id IS NOT NULL AND (long OR (i // 64 >= back AND i - 64 * (i // 64 - back) < 124 AND i // 64 - back <= greatest((n + 63) // 64 - 2, 0)))),
c AS (SELECT doc_id, item_id, passage, answer, count(*) AS k FROM h GROUP BY ALL),
f AS (SELECT doc_id, item_id, passage, count(*) AS parts FROM c JOIN z USING (item_id, answer) WHERE 100 * k >= 80 * size GROUP BY ALL),
y AS (SELECT DISTINCT doc_id, item_id FROM f JOIN (SELECT item_id, count(*) AS parts FROM z GROUP BY ALL) USING (item_id, parts)),
o AS (SELECT doc_id, count(*) AS n_items, min(item_id) AS first_item FROM y GROUP BY ALL)
SELECT d.doc_id, n_items IS NOT NULL AS contaminated, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, first_item FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN o USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard_join": _OP2, "op3_suffix_dedup": _OP3, "op5_decontamination": _OP5, "op7_warc": _OP7, "op10_mixing": _OP10}
