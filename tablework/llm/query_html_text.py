"""Query of the text extraction; checked on written-out pages in the tests."""

from pyspark.sql import functions as F

from tablework.llm.html_text import extract_text
from tablework.llm.registry import query
from tablework.llm.tables import read


@query("op9_html_text")
def op9_html_text(spark, sf_dir):
    return extract_text(read(spark, sf_dir, "pages").select("page_id", "html")).select(
        "page_id", F.char_length("text").cast("bigint").alias("n_chars"),
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"), F.sha2("text", 256).alias("text_sha256"))
