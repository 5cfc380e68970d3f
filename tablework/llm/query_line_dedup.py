"""Query of the line deduplication."""

from pyspark.sql import functions as F

from tablework.llm.line_dedup import deduplicate_lines
from tablework.llm.registry import query
from tablework.llm.tables import read

ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT rid, doc_id, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i, len(ls) AS n FROM docs
), hashed AS (
  SELECT *, ('0x' || substr(md5(l), 1, 7))::BIGINT AS h FROM lines
), rolled AS (
  SELECT *, ((h * 961 + coalesce(lag(h, 1) OVER w, 0) * 31 + coalesce(lag(h, 2) OVER w, 0)) >> 8) % 4 = 0 OR i = n AS last
  FROM hashed WINDOW w AS (PARTITION BY rid ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(last::INT) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM rolled
), chunks AS (
  SELECT rid, doc_id, c, string_agg(l, chr(10) ORDER BY i) AS chunk,
         count(*) FILTER (regexp_matches(l, '[^\x20\x09-\x0D]')) AS filled
  FROM numbered GROUP BY ALL
), ranked AS (
  SELECT *, filled > 1 AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, rid, c) > 1 AS gone FROM chunks
)
SELECT r.doc_id, count(*)::BIGINT AS n_chunks, count(*) FILTER (gone)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(chunk, chr(10) ORDER BY c) FILTER (NOT gone), '')) AS text_sha256
FROM ranked r GROUP BY r.rid, r.doc_id
"""


@query("op8_line_dedup", ORACLE)
def op8_line_dedup(spark, sf_dir):
    return deduplicate_lines(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_chunks", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
