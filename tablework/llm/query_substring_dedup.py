"""Query of the substring deduplication."""

from pyspark.sql import functions as F

from tablework.llm.registry import query
from tablework.llm.substring_dedup import remove_repeated_passages
from tablework.llm.tables import read

ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), starts AS (
  SELECT rid, unnest(range(1, greatest(len(ws) - 33, 1))) AS p, ws FROM docs
), windows AS (
  SELECT rid, p, md5(array_to_string(ws[p:p + 34], ' ')) AS content FROM starts
), repeated AS (
  SELECT rid, p FROM windows WHERE content IN (SELECT content FROM windows GROUP BY content HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT rid, unnest(range(p, p + 35)) AS i FROM repeated
), words AS (
  SELECT rid, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM docs
), kept AS (
  SELECT w.rid, count(*) AS n, string_agg(w.w, ' ' ORDER BY w.i) AS kept
  FROM words w LEFT JOIN gone g ON g.rid = w.rid AND g.i = w.i WHERE g.i IS NULL GROUP BY w.rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""


@query("op2_substring_dedup", ORACLE)
def op2_substring_dedup(spark, sf_dir):
    return remove_repeated_passages(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
