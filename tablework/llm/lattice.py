"""Segmentation lattices of many short strings at once, and random paths through them.

A string is cut only where no vocabulary piece can cross, so the lattice of a
text is the row of its strings' lattices. Every node holds the total weight of
the paths to the end (computed backwards), which gives exact probabilities of
its edges.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from tablework.llm.hashing import Spans, mix, runs

U64 = np.uint64
_BASE = U64(0xD1342543DE82EF95)
_BACK = U64(pow(0xD1342543DE82EF95, -1, 1 << 64))
SPACE = "▁"
#: Weight of the piece of rank r is 1 / (r + FLAT): frequent pieces come first in the vocabulary.
FLAT = 50.0
#: Nodes of the strings whose lattices are built together.
_GROUP = 1 << 15
#: Edges that a worker remembers from block to block, about 30 bytes each.
_MEMORY_EDGES = 4_000_000
#: Edges that fit into a memory's arrays from the start, with those of one block.
_ROOM = 5_000_000


def _ladder(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _hash_each(strings: list[bytes]) -> np.ndarray:
    """The hash that ``_substring_hashes`` gives these bytes."""
    data = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint64) + U64(1)
    ends = np.cumsum([len(s) for s in strings])
    starts = ends - np.array([len(s) for s in strings])
    running = np.concatenate([[U64(0)], np.cumsum(data * _ladder(_BASE, len(data)), dtype=np.uint64)])
    return mix((running[ends] - running[starts]) * _ladder(_BACK, len(data) + 1)[starts])


class Pieces:
    """The vocabulary of a SentencePiece model as byte strings with log weights."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * size
        fallback = np.full(256, -1, np.int64)
        words, ids = [], []
        for i in range(size):
            if model.is_byte(i):
                fallback[int(model.id_to_piece(i)[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = model.id_to_piece(i)
                if "\n" in text or SPACE in text.lstrip(SPACE):
                    raise ValueError(f"piece {i} crosses a word boundary")
                self.bytes_of[i] = text.replace(SPACE, " ").encode()
                words.append(self.bytes_of[i])
                ids.append(i)
        if (fallback < 0).any():
            raise ValueError("the model has no byte pieces")
        self.fallback = fallback
        rank = np.arange(size, dtype=np.float64)
        self.weight = -np.log(rank + FLAT)
        self.weight -= np.log(np.exp(self.weight).sum())
        # Sums of byte weights are differences of running sums: these are exact, wherever a string lies in its block.
        self.weight[fallback] = np.round(self.weight[fallback] * (1 << 24)) / (1 << 24)
        self.longest = max(map(len, words))
        self.lengths = np.unique([len(w) for w in words])
        self._place(_hash_each(words), np.array(ids))
        self.sizes = np.array([len(b) for b in self.bytes_of])
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def _place(self, hashes: np.ndarray, ids: np.ndarray) -> None:
        """An open table: a hash lies at its low bits or in one of the next few slots."""
        bits = int(len(ids) * 8).bit_length()
        self.mask = U64((1 << bits) - 1)
        self.keys, self.values = np.zeros((1 << bits) + 64, np.uint64), np.full((1 << bits) + 64, -1, np.int64)
        self.probes = 1
        for h, i in zip(hashes, ids):
            at = int(h & self.mask)
            tries = 1
            while self.values[at] >= 0:
                at, tries = at + 1, tries + 1
            self.keys[at], self.values[at] = h, i
            self.probes = max(self.probes, tries)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 for none."""
        at = (hashes & self.mask).astype(np.int64)
        out = np.where(self.keys[at] == hashes, self.values[at], -1)
        rest = np.flatnonzero((out < 0) & (self.values[at] >= 0))
        for step in range(1, self.probes):
            if not len(rest):
                break
            slot = at[rest] + step
            hit = self.keys[slot] == hashes[rest]
            out[rest[hit]] = self.values[slot[hit]]
            rest = rest[~hit & (self.values[slot] >= 0)]
        return out

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids, without the blank that encoding puts in front."""
        size = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        data = self.flat[np.arange(ends[-1]) + np.repeat(self.begins[ids] - ends[:-1], size)].tobytes()
        at = ends[first]
        return [data[a + 1:b] if b > a else b"" for a, b in zip(at[:-1], at[1:])]


def split(data: np.ndarray, bounds: np.ndarray) -> Spans:
    """Strings between which no piece can lie: cut before blanks that follow other bytes, and around line feeds."""
    blank, feed = data == 0x20, data == 0x0A
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = blank[1:] & ~blank[:-1]
    cut[:-1] |= feed
    cut[1:] |= feed
    cut[bounds] = True
    edges = np.flatnonzero(cut)
    starts, stops = edges[:-1], edges[1:]
    return Spans(starts, stops, np.searchsorted(starts, bounds))


@dataclass
class Lattice:
    """Edges in node order; node ``start[k] + i`` is byte i of string k, ``share`` the chance of an edge at its node.

    ``upto`` sums the shares of a node from its first edge on. ``piece`` is -1
    for a character of several bytes without a piece. The last node of a
    string is the only target without edges.
    """

    start: np.ndarray
    text: np.ndarray
    first: np.ndarray
    origin: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    share: np.ndarray
    upto: np.ndarray

    @classmethod
    def build(cls, pieces: Pieces, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> Lattice:
        """Lattices of the given byte spans."""
        out = _Growing()
        for part in cls.groups(pieces, data, starts, stops):
            out.add(part)
        return out.lattice

    @classmethod
    def groups(cls, pieces: Pieces, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> Iterator[Lattice]:
        """The same by groups of strings, so that working arrays stay small."""
        group = np.cumsum(stops - starts + 1) // _GROUP
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                yield cls._group(pieces, data, starts[a:b], stops[a:b])

    def only(self, strings: np.ndarray) -> Lattice:
        """The lattices of these strings, in their order."""
        begin, size = self.start[strings], self.start[strings + 1] - self.start[strings]
        nodes = runs(begin, size)
        start = np.concatenate([[0], np.cumsum(size)])
        at, many = self.first[begin], self.first[begin + size] - self.first[begin]
        edges = runs(at, many)
        shift = np.repeat(start[:-1] - begin, many).astype(np.int32)
        first = np.concatenate([[0], np.cumsum(self.first[nodes + 1] - self.first[nodes])])
        return Lattice(start, self.text[nodes], first, self.origin[edges] + shift, self.target[edges] + shift,
                       self.piece[edges], self.share[edges], self.upto[edges])

    def degree(self, edges: np.ndarray) -> np.ndarray:
        """How many edges leave the node that each of ``edges`` leaves."""
        origin = self.origin[edges]
        return self.first[origin + 1] - self.first[origin]

    def is_last(self, nodes: np.ndarray) -> np.ndarray:
        return self.first[nodes] == self.first[nodes + 1]

    @staticmethod
    def _group(pieces: Pieces, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> Lattice:
        """The lattice of one group. A character that is no piece gets an edge of its byte pieces."""
        size = stops - starts
        begin = np.concatenate([[0], np.cumsum(size + 1)])  # one node more than bytes
        n = int(begin[-1])
        node = np.arange(n)
        owner = np.repeat(np.arange(len(size)), size + 1)
        left = begin[owner + 1] - 1 - node  # bytes to the end of the string
        text = np.zeros(n, np.uint8)
        inner = left > 0
        source = starts[owner] + node - begin[owner]
        text[inner] = data[source[inner]]
        lead = (~inner) | ((text & 0xC0) != 0x80)
        lead[begin[:-1]] = True
        running = np.concatenate([[U64(0)], np.cumsum((text.astype(np.uint64) + U64(1)) * _ladder(_BASE, n),
                                                      dtype=np.uint64)])
        back = _ladder(_BACK, n + 1)
        at = node[inner & lead]
        origins, targets, found = [], [], []
        for length in pieces.lengths:
            at = at[left[at] >= length]
            here = at[lead[at + length]]
            piece = pieces.find(mix((running[here + length] - running[here]) * back[here]))
            hit = piece >= 0
            origins.append(here[hit])
            targets.append(here[hit] + length)
            found.append(piece[hit])
        # Characters without a piece of their own; malformed bytes count as characters.
        begins = node[inner & lead]
        follow = np.searchsorted(node[lead], begins, side="right")
        ends = node[lead][follow]
        own = np.zeros(n, bool)
        o, t = np.concatenate(origins), np.concatenate(targets)
        next_lead = np.zeros(n, np.int64)
        next_lead[begins] = ends
        own[o[next_lead[o] == t]] = True
        bare = ~own[begins]
        weight = np.concatenate([pieces.weight[np.concatenate(found)], np.zeros(int(bare.sum()))])
        bytes_weight = np.concatenate([[0.0], np.cumsum(pieces.weight[pieces.fallback[text]] * inner)])
        weight[len(o):] = bytes_weight[ends[bare]] - bytes_weight[begins[bare]]
        origin = np.concatenate([o, begins[bare]])
        target = np.concatenate([t, ends[bare]])
        single = ends[bare] - begins[bare] == 1
        piece = np.concatenate([*found, np.where(single, pieces.fallback[text[begins[bare]]], -1)])

        # Sixteen-bit keys are sorted in linear time; only a group of one very long string needs wider ones.
        key = np.uint16 if n <= 1 << 16 else np.int64
        ranked = np.argsort(origin.astype(key), kind="stable")
        origin, target, piece, weight = (x[ranked] for x in (origin, target, piece, weight))
        mass = np.zeros(n)
        order = np.argsort(left[origin].astype(key), kind="stable")
        distance = left[origin[order]]
        cuts = np.flatnonzero(np.concatenate([[True], distance[1:] != distance[:-1], [True]])) if len(order) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            edges = order[a:b]
            value = weight[edges] + mass[target[edges]]
            node_of = origin[edges]
            heads = np.flatnonzero(np.concatenate([[True], node_of[1:] != node_of[:-1]]))
            top = np.maximum.reduceat(value, heads)
            spread = np.repeat(top, np.diff(np.append(heads, len(value))))
            mass[node_of[heads]] = top + np.log(np.add.reduceat(np.exp(value - spread), heads))

        share = np.exp(weight + mass[target] - mass[origin])
        first = np.searchsorted(origin, np.arange(n + 1))
        upto = share.copy()
        open_ = first[:-1][np.diff(first) > 1]
        last = first[1:][np.diff(first) > 1] - 1
        while len(open_):  # nodes have few edges
            upto[open_ + 1] += upto[open_]
            open_, last = open_[open_ + 1 < last] + 1, last[open_ + 1 < last]
        return Lattice(begin, text, first, origin.astype(np.int32), target.astype(np.int32), piece.astype(np.int32),
                       share, upto)

    def draw(self, nodes: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Random paths from ``nodes`` to ``ends``: all edges in a row, and where each path's edges begin."""
        rows, edges = [], []
        going = np.flatnonzero(nodes < ends)
        at, step = nodes[going], 0
        while len(going):
            lo, hi = self.first[at], self.first[at + 1]
            goal = uniform(seeds[going], step) * self.upto[hi - 1]
            edge = hi - 1  # the longest piece is the likeliest
            open_ = np.flatnonzero(edge > lo)
            while len(open_):
                open_ = open_[self.upto[edge[open_] - 1] > goal[open_]]
                edge[open_] -= 1
                open_ = open_[edge[open_] > lo[open_]]
            rows.append(going)
            edges.append(edge)
            at, step = self.target[edge], step + 1
            more = at < ends[going]
            going, at = going[more], at[more]
        count = np.zeros(len(nodes), np.int64)
        for r in rows:
            count[r] += 1
        first = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(int(first[-1]), np.int64)
        for k, (r, e) in enumerate(zip(rows, edges)):
            out[first[r] + k] = e
        return out, first


class _Growing:
    """A lattice that grows in place: adding to it copies what is added, and beyond its room one array at a time.

    Room that is not yet written to takes no memory.
    """

    def __init__(self, edges: int = 0):
        types = {f: np.int64 if f in ("start", "first") else np.uint8 if f == "text" else
                 np.float64 if f in ("share", "upto") else np.int32 for f in Lattice.__dataclass_fields__}
        self.room = {f: np.empty(edges + 1, t) for f, t in types.items()}
        self.clear()

    def clear(self) -> None:
        self.room["start"][0] = self.room["first"][0] = 0
        self.strings = self.nodes = self.edges = 0

    @property
    def lattice(self) -> Lattice:
        """What is there now; valid until the next change."""
        used = {"start": self.strings + 1, "text": self.nodes, "first": self.nodes + 1}
        return Lattice(**{f: a[:used.get(f, self.edges)] for f, a in self.room.items()})

    def add(self, part: Lattice) -> None:
        self._put("start", self.strings, part.start, self.nodes)
        self._put("text", self.nodes, part.text)
        self._put("first", self.nodes, part.first, self.edges)
        for name in ("origin", "target"):
            self._put(name, self.edges, getattr(part, name), self.nodes)
        for name in ("piece", "share", "upto"):
            self._put(name, self.edges, getattr(part, name))
        self.strings += len(part.start) - 1
        self.nodes += len(part.text)
        self.edges += len(part.origin)

    def _put(self, name: str, at: int, values: np.ndarray, shift: int = 0) -> None:
        room, end = self.room[name], at + len(values)
        if end > len(room):
            self.room[name] = np.empty(end + end // 4, room.dtype)
            self.room[name][:at] = room[:at]
            room = self.room[name]
        np.add(values, shift, out=room[at:end], casting="unsafe") if shift else np.copyto(room[at:end], values)

    def keep(self, strings: np.ndarray) -> None:
        """Only these strings stay; they ascend, so each moves to where nothing that is still to be moved lies."""
        old = self.lattice
        parts = np.split(strings, np.flatnonzero(np.diff(old.start[strings] // _GROUP)) + 1)
        self.clear()
        for part in parts:
            if len(part):
                self.add(old.only(part))


class Memory:
    """The lattices of strings that a worker has met; those that most blocks had use for stay longest."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.growing = _Growing(_ROOM)
        self.lattice = self.growing.lattice
        self.hashes, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.blocks = np.zeros(0, np.int64)

    def places(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Where the strings lie in ``lattice``; their hashes are distinct and ascend.

        A remembered string counts only if its bytes are equal.
        """
        if len(self.lattice.origin) > _MEMORY_EDGES:
            self._forget()
        at = np.searchsorted(self.hashes, hashes)
        listed = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        listed[inside] = self.hashes[at[inside]] == hashes[inside]
        out = np.full(len(hashes), -1)
        out[listed] = self.place[at[listed]]
        out[self._differ(out, data, starts, stops)] = -1
        new = np.flatnonzero(out < 0)
        if len(new):
            out[new] = len(self.blocks) + np.arange(len(new))
            for part in Lattice.groups(self.pieces, data, starts[new], stops[new]):
                self.growing.add(part)
            self.lattice = self.growing.lattice
            self.blocks = np.append(self.blocks, np.zeros(len(new), np.int64))
            fresh = new[~listed[new]]
            self.hashes = np.insert(self.hashes, at[fresh], hashes[fresh])
            self.place = np.insert(self.place, at[fresh], out[fresh])
        self.blocks[out] += 1
        return out

    def _differ(self, place: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        known = np.flatnonzero(place >= 0)
        begin = self.lattice.start[place[known]]
        size = self.lattice.start[place[known] + 1] - 1 - begin
        longer = size != stops[known] - starts[known]
        size[longer] = 0
        unequal = data[runs(starts[known], size)] != self.lattice.text[runs(begin, size)]
        return np.concatenate([known[longer], known[np.unique(np.repeat(np.arange(len(known)), size)[unequal])]])

    def _forget(self) -> None:
        edges = self.lattice.first[self.lattice.start]
        order = np.argsort(-self.blocks, kind="stable")
        room = np.cumsum(np.diff(edges)[order]) <= _MEMORY_EDGES // 2
        keep = np.sort(order[room])
        keep = keep[np.isin(keep, self.place)]
        number = np.full(len(self.blocks), -1)
        number[keep] = np.arange(len(keep))
        self.growing.keep(keep)
        self.lattice, self.blocks = self.growing.lattice, self.blocks[keep]
        stay = number[self.place] >= 0
        self.hashes, self.place = self.hashes[stay], number[self.place[stay]]


def uniform(seeds: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1) that hang on the seeds alone."""
    bits = mix(seeds + U64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return ((bits >> U64(11)).astype(np.float64) + 0.5) / (1 << 53)


_PIECES: dict[str, Pieces] = {}
_MEMORIES: dict[str, Memory] = {}


def pieces(path: str) -> Pieces:
    """One vocabulary per worker process."""
    if path not in _PIECES:
        _PIECES[path] = Pieces(os.fspath(path))
    return _PIECES[path]


def memory(path: str) -> Memory:
    """One memory per worker process."""
    if path not in _MEMORIES:
        _MEMORIES[path] = Memory(pieces(path))
    return _MEMORIES[path]
