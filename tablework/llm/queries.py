"""Every query of the subpackage, by key."""

from tablework.llm import registry
from tablework.llm import (  # noqa: F401
    query_chat_format, query_decontaminate, query_hash_forest, query_html_text, query_jaccard_join, query_language_id,
    query_line_dedup, query_merkle, query_quality_rules, query_shared_lists, query_substring_dedup,
    query_subword_samples, query_token_files)


def queries():
    return dict(registry.QUERIES)


def oracle_sql():
    return dict(registry.ORACLES)
