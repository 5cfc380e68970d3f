"""Query of the hard-negative mining."""

from pyspark.sql import functions as F

from tablework.llm.registry import query
from tablework.llm.shared_lists import hard_negatives
from tablework.llm.tables import read

ORACLE = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), rows_ AS (
  SELECT vec_id, unnest(min({'label': label, 'q': q})) FROM given GROUP BY vec_id
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.q, r.q), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0)::BIGINT AS score
  FROM rows_ a JOIN rows_ r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""


@query("op11_shared_lists", ORACLE)
def op11_shared_lists(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)
