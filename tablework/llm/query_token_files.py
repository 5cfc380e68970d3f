"""Query of the token files; checked by whole-text encoding in the tests."""

import public_tokenizers
from pyspark.sql import functions as F

from tablework.llm.registry import query
from tablework.llm.tables import read
from tablework.llm.token_files import read_token_files, write_token_files
from tablework.session import work_path

TOKENIZER = "word_bpe_49k.json"


@query("op6_token_files")
def op6_token_files(spark, sf_dir):
    path = work_path(spark, "tokens")
    write_token_files(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
