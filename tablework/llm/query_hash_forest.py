"""Query of the nearest-neighbour forest."""

from pyspark.sql import functions as F

from tablework.llm.hash_forest import nearest_neighbours
from tablework.llm.registry import query
from tablework.llm.tables import read


@query("op12_hash_forest")
def op12_hash_forest(spark, sf_dir):
    return nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
