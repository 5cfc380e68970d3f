"""Canonical, length-limited Huffman codes over token ids, coded and decoded by tables."""

from __future__ import annotations

import numpy as np

MAX_BITS = 16
BLOCK_IDS = 512


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package merge; 0 for a symbol that does not occur.

    The limit rises to what the number of symbols needs.
    """
    symbols = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(symbols) < 2:
        lengths[symbols] = 1
        return lengths
    limit = max(limit, int(len(symbols) - 1).bit_length())
    order = symbols[np.argsort(counts[symbols], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        ranked = np.argsort(both, kind="stable")
        levels.append(ranked < len(leaves))
        both = both[ranked]
        packages = both[0:len(both) // 2 * 2:2] + both[1::2]
    taken = 2 * (len(leaves) - 1)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:taken].sum())
        lengths[order[:n]] += 1
        taken = 2 * (taken - n)
    return lengths


class Code:
    """Codes in canonical order: by length, then by symbol; so the lengths alone define them."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.bits = int(lengths.max(initial=1))
        symbols = np.lexsort((np.arange(len(lengths)), lengths))
        symbols = symbols[lengths[symbols] > 0]
        width = np.int64(1) << (self.bits - self.lengths[symbols])
        begins = np.concatenate([[0], np.cumsum(width)])[:-1]
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[symbols] = (begins >> (self.bits - self.lengths[symbols])).astype(np.uint64)
        self.table = np.zeros(1 << self.bits, np.uint32)
        self.table[:int(width.sum())] = np.repeat(symbols.astype(np.uint32), width)

    def encode(self, ids: np.ndarray, first: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        """Bits of each run ``ids[first[i]:first[i + 1]]``, and the bit offset of every block of it."""
        length = self.lengths[ids]
        running = np.concatenate([[0], np.cumsum(length)])
        spare = running[first]
        words = (np.diff(spare) + 31) // 32
        base = np.concatenate([[0], np.cumsum(words)])
        at = running[:-1] - np.repeat(spare[:-1] - 32 * base[:-1], np.diff(first))
        value = self.codes[ids] << (64 - (at & 31) - length).astype(np.uint64)
        word = at >> 5
        out = np.zeros(int(base[-1]) + 1, np.uint64)
        if len(ids):
            runs = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            # Codes do not overlap, so sums of their bits are unions.
            out[word[runs]] += np.add.reduceat(value >> np.uint64(32), runs)
            out[word[runs] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), runs)
        packed = out.astype(">u4").tobytes()
        offsets = [running[np.arange(a, b, BLOCK_IDS)] - running[a] for a, b in zip(first[:-1], first[1:])]
        return [packed[4 * a:4 * b] for a, b in zip(base[:-1], base[1:])], offsets

    def decode(self, payloads: list[bytes], offsets: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        """The ids of all runs; all blocks advance together, one id at a time."""
        joined = np.frombuffer(b"".join(payloads) + bytes(8), np.uint8)
        window = np.ndarray(shape=(len(joined) - 7,), dtype=">u8", buffer=joined, strides=(1,))
        base = np.concatenate([[0], np.cumsum([8 * len(p) for p in payloads])])[:-1]
        blocks = (sizes + BLOCK_IDS - 1) // BLOCK_IDS
        owner = np.repeat(np.arange(len(sizes)), blocks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = base[owner] + (np.concatenate(offsets).astype(np.int64) if len(owner) else 0)
        left = np.minimum(sizes[owner] - BLOCK_IDS * number, BLOCK_IDS)
        place = np.repeat(np.cumsum(sizes) - sizes, blocks) + BLOCK_IDS * number
        ids = np.zeros(int(sizes.sum()), np.uint32)
        longest = np.argsort(-left, kind="stable")
        at, left, place = at[longest], left[longest], place[longest]
        going = len(left)
        for step in range(int(left[0]) if going else 0):
            going = np.searchsorted(-left[:going], -step)
            here = at[:going]
            peek = window[here >> 3].astype(np.uint64) >> (64 - self.bits - (here & 7)).astype(np.uint64)
            found = self.table[(peek & np.uint64((1 << self.bits) - 1)).astype(np.int64)]
            ids[place[:going] + step] = found
            at[:going] += self.lengths[found]
        return ids
