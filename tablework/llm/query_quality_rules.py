"""Query of the quality rules. SQL has no exact binomial test; it is held against brute force in the tests."""

from tablework.llm.quality_rules import judge
from tablework.llm.registry import query
from tablework.llm.tables import read


@query("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    return judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
