"""Removal of long passages that occur more than once.

Every window of ``window`` consecutive words gets a Rabin-Karp hash; Spark
counts the hashes over the whole table; the words of windows counted twice or
more are removed as maximal intervals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablework.llm.counted import BLOB_SCHEMA, chunked, count_blobs, count_buckets, read_answers
from tablework.llm.hashing import Block, Spans, block_of, text_array, window_hashes, word_hashes, words_of
from tablework.llm.tables import BLOCK_BYTES, parts, text_bytes

WINDOW = 35
OUTPUT = ("doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<start:int,stop:int>>, "
          "text string")
_SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32())])


def remove_repeated_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, removed, text.

    Words are maximal runs of characters other than space and \\x09-\\x0D. A
    word goes when a window of ``window`` words that covers it, word for word,
    also starts anywhere else, in this or another document, overlapping starts
    included. ``removed`` lists the maximal intervals of removed words, the
    stop excluded; ``text`` is the rest, joined by single spaces. Null texts
    and texts without words give no words and an empty text; a null doc_id is
    kept as it is. Rows that repeat an id and text count as further copies, so
    both lose their windows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    size = text_bytes(docs)
    chunks, buckets = parts(spark, size), parts(spark, size, 2 * BLOCK_BYTES)
    blocks = chunked(docs, chunks, "doc_id", "text")

    def send(key, table):
        hashes, _, _, _ = _windows(table, window)
        return count_blobs(key[0].as_py(), hashes, buckets)

    answers = count_buckets(blocks.groupBy("chunk").applyInArrow(send, BLOB_SCHEMA))

    def remove(table, found):
        hashes, at, block, words = _windows(table, window)
        repeated = at[read_answers(found, hashes) >= 2]
        change = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(change, repeated, 1)
        np.add.at(change, repeated + window, -1)
        gone = np.cumsum(change)[:-1] > 0
        return pa.table([table.column("doc_id").combine_chunks(), *_rest(block, words, gone)],
                        names=["doc_id", "n_words", "n_removed", "removed", "text"])

    return blocks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(remove, OUTPUT)


def _windows(table: pa.Table, window: int):
    block = block_of(table.column("text"))
    words = words_of(block)
    hashes, at = window_hashes(word_hashes(block, words), words.first, window)
    return hashes, at, block, words


def _rest(block: Block, words: Spans, gone: np.ndarray) -> list[pa.Array]:
    lengths = np.diff(words.first)
    running = np.concatenate([[0], np.cumsum(gone)])
    removed = running[words.first[1:]] - running[words.first[:-1]]
    # Intervals end where the words do not go on, or with their text.
    head = np.zeros(len(gone), bool)
    head[words.first[:-1][lengths > 0]] = True
    starts = np.flatnonzero(gone & (head | ~np.concatenate([[False], gone[:-1]])))
    last = np.concatenate([head[1:], [True]])[:len(gone)]
    stops = np.flatnonzero(gone & (last | ~np.concatenate([gone[1:], [False]]))) + 1
    per_text = np.searchsorted(starts, words.first)
    base = np.repeat(words.first[:-1], np.diff(per_text))
    spans = pa.StructArray.from_arrays([pa.array((starts - base).astype(np.int32)),
                                        pa.array((stops - base).astype(np.int32))], fields=list(_SPAN))
    # Kept words, each with the separator byte behind it made a space.
    kept = ~gone
    change = np.zeros(len(block.data) + 1, np.int8)
    change[words.starts[kept]] += 1
    change[words.stops[kept] + 1] -= 1
    inside = np.cumsum(change[:-1], dtype=np.int8) > 0
    data = block.data.copy()
    data[words.stops] = 0x20
    sizes = np.concatenate([[0], np.cumsum((words.stops - words.starts + 1) * kept)])
    bounds = sizes[words.first]
    n_kept = lengths - removed
    # The space behind a text's last word goes.
    inside[words.stops[_last_kept(kept, words.first, n_kept)]] = False
    bounds = np.concatenate([[0], np.cumsum(np.diff(bounds) - (n_kept > 0))])
    return [pa.array(lengths), pa.array(removed),
            pa.ListArray.from_arrays(pa.array(per_text.astype(np.int32)), spans),
            text_array(data[inside], bounds)]


def _last_kept(kept: np.ndarray, first: np.ndarray, n_kept: np.ndarray) -> np.ndarray:
    """The index of the last kept word of each text that keeps any."""
    places = np.flatnonzero(kept)
    ends = np.cumsum(n_kept)
    return places[ends[n_kept > 0] - 1]
