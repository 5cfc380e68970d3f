"""Query of the sampled segmentations; checked by round trips and brute force in the tests."""

import public_tokenizers
from pyspark.sql import functions as F

from tablework.llm.registry import query
from tablework.llm.subword_samples import encode_samples
from tablework.llm.tables import read

MODEL = "piece_bpe_32k.model"


@query("op5_subword_samples")
def op5_subword_samples(spark, sf_dir):
    model = public_tokenizers.path(MODEL)
    return encode_samples(read(spark, sf_dir, "documents"), model, decoded=True).select(
        "doc_id", "rank", "n_tokens", F.crc32("ids").alias("ids_crc32"), "log_prob", "perturbed", "inclusion",
        F.sha2("text", 256).alias("text_sha256"))
