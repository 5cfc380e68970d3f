"""Token ids of all documents as Huffman-coded files in ascending doc_id order.

A file set is a folder with two Parquet tables: ``lengths`` (the code length
of each id, which defines the canonical code) and ``documents`` (one row per
document: its coded bits, and the bit offset of every 512th id, so that blocks
decode on their own).
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablework.llm.hashing import block_of, cut, runs, word_hashes, words_of
from tablework.llm.huffman import Code, code_lengths
from tablework.llm.tables import BLOCK_BYTES, parts, stage, text_bytes

END_ID = 1
MAX_VOCABULARY = 1 << 20
#: Words that an encoder remembers from block to block, about 50 bytes each.
_CACHE_WORDS = 1_000_000
_ROWS = 2048
_DOCUMENTS = "doc_id bigint, part int, start_in_part bigint, n_tokens bigint, payload binary, offsets array<bigint>"


class WordEncoder:
    """Encodes texts word by word, each distinct word once; words are remembered from block to block.

    Equal to encoding whole texts for tokenizers that drop white space and
    whose normaliser and pre-tokenizer never join what blanks part. The memory
    holds word hashes in order, and where the ids of each word lie in ``ids``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.hashes, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.begin, self.size, self.blocks = (np.zeros(0, np.int64) for _ in range(3))

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words and how many each has; runs of words are one text, told apart by their places."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        texts = [[w.decode("utf-8", "replace") for w in words[i:i + 256]] for i in range(0, len(words), 256)]
        for run, coded in zip(texts, self.tokenizer.encode_batch([" ".join(t) for t in texts],
                                                                 add_special_tokens=False)):
            begins = np.concatenate([[0], np.cumsum([len(w) + 1 for w in run])])
            owner = np.searchsorted(begins, [a for a, _ in coded.offsets], side="right") - 1
            ids.append(np.array(coded.ids, np.uint32))
            sizes.append(np.bincount(owner, minlength=len(run)) if len(owner) else np.zeros(len(run), np.int64))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        ids, size = self._encode(words)
        at = np.searchsorted(self.hashes, hashes)
        self.begin = np.insert(self.begin, at, len(self.ids) + np.cumsum(size) - size)
        self.ids = np.concatenate([self.ids, ids])
        self.hashes, self.size = np.insert(self.hashes, at, hashes), np.insert(self.size, at, size)
        self.blocks = np.insert(self.blocks, at, 0)

    def _forget(self) -> None:
        """Keep the half of the memory that most blocks had use for."""
        keep = np.sort(np.argsort(self.blocks, kind="stable")[-(_CACHE_WORDS // 2):])
        self.hashes, self.blocks = self.hashes[keep], self.blocks[keep]
        self.ids = self.ids[runs(self.begin[keep], self.size[keep])]
        self.size = self.size[keep]
        self.begin = np.cumsum(self.size) - self.size

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's ids begin."""
        block = block_of(texts)
        words = words_of(block)
        distinct, once, kind = np.unique(word_hashes(block, words), return_index=True, return_inverse=True)
        new = np.flatnonzero(~np.isin(distinct, self.hashes, assume_unique=True))
        raw = block.data.tobytes()
        self._learn(distinct[new], [raw[words.starts[i]:words.stops[i]] for i in once[new]])
        at = np.searchsorted(self.hashes, distinct)
        self.blocks[at] += 1
        at = at[kind]
        size = self.size[at]
        out = self.ids[runs(self.begin[at], size)]
        if len(self.hashes) > _CACHE_WORDS:
            self._forget()
        return out, np.concatenate([[0], np.cumsum(size)])[words.first]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode every whole text of ``docs(doc_id, text)`` and write a file set to ``path``.

    Null and empty texts are the end id alone. Null doc_ids come first;
    documents of equal id are ordered by their code. The tokenizer file must
    be readable under the same name by every executor. Other columns are not
    looked at.
    """
    def encode(batches):
        code = encoder(tokenizer)
        for batch in batches:
            for table in cut(pa.Table.from_batches([batch]), "text", BLOCK_BYTES):
                ids, first = code(table.column("text"))
                ids = np.insert(ids, first[1:], end_id).astype("<u4")
                first = first + np.arange(len(first))
                wide = 2 if int(ids.max(initial=0)) < 1 << 16 else 4
                raw = ids.astype(f"<u{wide}").tobytes()
                yield from pa.table([
                    table.column("doc_id").combine_chunks(), pa.array(np.diff(first)),
                    pa.array([raw[wide * a:wide * b] for a, b in zip(first[:-1], first[1:])], pa.binary())],
                    names=["doc_id", "n_tokens", "ids"]).to_batches()

    size = text_bytes(docs)
    spark = docs.sparkSession
    encoded = stage(docs.select("doc_id", "text").mapInArrow(encode, "doc_id bigint, n_tokens bigint, ids binary"),
                    "ids", compression="zstd")

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(_ids_of(batch))
            if len(found) > MAX_VOCABULARY:
                raise ValueError(f"token id {len(found) - 1}: the files take ids below {MAX_VOCABULARY}")
            if len(found) > len(total):
                total, found = found, total
            total[:len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    counts = encoded.mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()  # one row per token id
    total = np.zeros(max([r["id"] for r in counts], default=0) + 1, np.int64)
    for r in counts:
        total[r["id"]] = r["n"]
    lengths = code_lengths(total)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id bigint, bits int").coalesce(
        1).write.parquet(f"{path}/lengths")

    def shorten(batches):
        code = Code(lengths)
        for batch in batches:
            for rows in _slices(batch):
                sizes = rows.column("n_tokens").to_numpy()
                payload, offsets = code.encode(_ids_of(rows), np.concatenate([[0], np.cumsum(sizes)]))
                yield pa.record_batch([
                    rows.column("doc_id"), rows.column("n_tokens"), pa.array(payload, pa.binary()),
                    pa.array([o.astype(np.int64) for o in offsets], pa.list_(pa.int64()))],
                    names=["doc_id", "n_tokens", "payload", "offsets"])

    def number(batches):
        begin = 0
        for batch in batches:
            sizes = batch.column("n_tokens").to_numpy()
            ends = begin + np.cumsum(sizes)
            columns = [batch.column("doc_id"), batch.column("part"), pa.array(ends - sizes),
                       *[batch.column(c) for c in ("n_tokens", "payload", "offsets")]]
            begin = int(ends[-1]) if len(ends) else begin
            yield pa.record_batch(columns, names=["doc_id", "part", "start_in_part", "n_tokens", "payload", "offsets"])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("payload")]
    coded = encoded.mapInArrow(shorten, "doc_id bigint, n_tokens bigint, payload binary, offsets array<bigint>")
    ranged = coded.repartitionByRange(parts(spark, size), *order).sortWithinPartitions(*order)
    ranged.select("doc_id", F.spark_partition_id().alias("part"), "n_tokens", "payload", "offsets").mapInArrow(
        number, _DOCUMENTS).write.option("compression", "none").parquet(f"{path}/documents")


def _ids_of(batch) -> np.ndarray:
    """The ids of staged rows, two or four bytes each."""
    sizes = batch.column("n_tokens").to_pylist()
    blobs = [x.as_buffer() for x in batch.column("ids")]
    found = [np.frombuffer(b, f"<u{len(b) // n}").astype(np.int64) for b, n in zip(blobs, sizes)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _slices(batch):
    return [batch.slice(i, _ROWS) for i in range(0, batch.num_rows, _ROWS)]


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids: what a file set holds.

    ``start`` counts the ids of all documents before; ``ids`` are
    little-endian unsigned 32-bit integers.
    """
    rows = spark.read.parquet(f"{path}/lengths").collect()  # one row per token id
    lengths = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.uint8)
    for r in rows:
        lengths[r["id"]] = r["bits"]

    def restore(batches):
        code = Code(lengths)
        for batch in batches:
            for piece in _slices(batch):
                sizes = piece.column("n_tokens").to_numpy()
                ids = code.decode([x.as_py() for x in piece.column("payload")],
                                  [np.array(x.values) for x in piece.column("offsets")], sizes)
                raw, ends = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(sizes)])
                yield pa.record_batch([
                    *[piece.column(c) for c in ("doc_id", "part", "start_in_part", "n_tokens")],
                    pa.array([raw[4 * a:4 * b] for a, b in zip(ends[:-1], ends[1:])], pa.binary())],
                    names=["doc_id", "part", "start_in_part", "n_tokens", "ids"])

    files = spark.read.parquet(f"{path}/documents")
    # One row per file part.
    before = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    decoded = files.mapInArrow(restore, re.sub("payload.*", "ids binary", _DOCUMENTS))
    return decoded.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")
