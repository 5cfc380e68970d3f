"""Query of the benchmark decontamination."""

from pyspark.sql import functions as F

from tablework.llm.decontaminate import find_contamination
from tablework.llm.registry import query
from tablework.llm.tables import read

ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), items AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[p:p + 9], ' ') AS content
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS p FROM items WHERE len(ws) > 0)
), sizes AS (
  SELECT DISTINCT size FROM item_windows
), doc_windows AS (
  SELECT rid, size, p, array_to_string(ws[p:p + size - 1], ' ') AS content
  FROM (SELECT rid, ws, size, unnest(range(1, greatest(len(ws) - size + 2, 1))) AS p FROM docs, sizes)
), hits AS (
  SELECT d.rid, d.p, d.size, i.item_id FROM doc_windows d JOIN item_windows i USING (size, content)
), hit_words AS (
  SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, unnest(range(p, p + size)) AS w FROM hits) GROUP BY rid
), hit_items AS (
  SELECT rid, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hits GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""


@query("op1_decontaminate", ORACLE)
def op1_decontaminate(spark, sf_dir):
    found = find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
