"""Vectorised word splitting and 64-bit hashing of Arrow text columns.

All helpers run inside tasks, on one bounded block of texts at a time. A block
is a byte buffer in which every text is followed by one space, so no word and
no line crosses from one text into the next.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_MIX_1, _MIX_2, _STEP = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_BASE = 0xD1342543DE82EF95  # odd, so that powers can be undone modulo 2**64

#: Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def _table(separators) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


_IS_WORD_BYTE = _table(BLANKS)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * _MIX_1
    x = x ^ (x >> U64(27))
    x = x * _MIX_2
    return x ^ (x >> U64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray(shape=(max(len(padded) - 7, 0),), dtype="<u8", buffer=padded, strides=(1,))
    out = mix(sizes.astype(np.uint64) + _STEP)
    at, left, rows = starts, sizes, None
    while True:
        block = words[at] & _KEEP[np.minimum(left, 8)]
        if rows is None:
            out = mix((out ^ block) * _STEP)
        else:
            out[rows] = mix((out[rows] ^ block) * _STEP)
        more = np.flatnonzero(left > 8)
        if not len(more):
            return out
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8


@dataclass
class Block:
    """Texts as one buffer: ``bounds[i]:bounds[i + 1]`` holds text i and a space."""

    data: np.ndarray
    bounds: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Spans:
    """Byte spans of words or lines; ``first[i]:first[i + 1]`` are those of text i."""

    starts: np.ndarray
    stops: np.ndarray
    first: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def block_of(texts) -> Block:
    """The buffer of an Arrow string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    joined = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    if not len(joined):
        return Block(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = joined.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[joined.offset:joined.offset + len(joined) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]]
    return Block(raw, bounds - bounds[0])


def runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``begin[i]`` to ``begin[i] + size[i]`` of all i in a row."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)


def words_of(block: Block, word_byte: np.ndarray = _IS_WORD_BYTE) -> Spans:
    """Maximal runs of bytes that ``word_byte`` marks; the default splits at ASCII blanks."""
    inside = word_byte[block.data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, stops = edges[0::2], edges[1::2]
    return Spans(starts, stops, np.searchsorted(starts, block.bounds))


def word_hashes(block: Block, words: Spans) -> np.ndarray:
    if not len(words.starts):
        return np.zeros(0, np.uint64)
    return span_hashes(block.data, words.starts, words.stops - words.starts)


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def window_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of every run of ``size`` words inside one text, and where each run starts.

    Sum of word hash times power of the base, from differences of one running
    sum; dividing by the first power makes it independent of the place.
    """
    lengths = np.diff(first)
    counts = np.maximum(lengths - size + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _powers(len(hashes) + 1)
    running = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], dtype=np.uint64, out=running[1:])
    ends = np.cumsum(counts)
    at = np.arange(total) + np.repeat(first[:-1] - (ends - counts), counts)
    return mix((running[at + size] - running[at]) * down[at]), at


def cut(table: pa.Table, column: str, limit: int) -> list[pa.Table]:
    """Slices of whole rows of about ``limit`` text bytes; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(table.column(column)), 0).to_numpy()
    slices, begin, held = [], 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            slices.append(table.slice(begin, i - begin))
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        slices.append(table.slice(begin))
    return slices


def text_array(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow string column over a byte buffer."""
    if bounds[-1] < 2**31:
        return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data))
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))
