"""Query of the near-duplicate join."""

from tablework.llm.jaccard_join import near_duplicates
from tablework.llm.registry import query
from tablework.llm.tables import read

ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), starts AS (
  SELECT rid, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS p FROM docs WHERE len(ws) > 0
), grams AS (
  SELECT DISTINCT rid, array_to_string(ws[p:p + 4], ' ') AS g FROM starts
), sizes AS (
  SELECT rid, count(*) AS n FROM grams GROUP BY rid
), common AS (
  SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM grams x JOIN grams y ON x.g = y.g AND x.rid <> y.rid GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes s ON s.rid = a JOIN sizes t ON t.rid = b WHERE 100 * c >= 75 * (s.n + t.n - c)
), reach AS (
  SELECT rid, rid AS other FROM docs UNION SELECT reach.rid, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM docs d JOIN reach r ON r.rid = d.rid JOIN docs o ON o.rid = r.other LEFT JOIN sizes s ON s.rid = d.rid
GROUP BY d.rid, d.doc_id
"""


@query("op10_jaccard_join", ORACLE)
def op10_jaccard_join(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))
