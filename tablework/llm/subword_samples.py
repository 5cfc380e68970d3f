"""SentencePiece segmentations of whole texts, sampled without replacement.

The k segmentations of a text are those with the largest Gumbel-perturbed log
probabilities, found by A* search: the best path is drawn; every node on it
then stands for the paths that leave there, whose best perturbed value is a
Gumbel variable cut off at the value of the path; the largest of these values
over all nodes so far says where the next path leaves. All random numbers
hang on the row's key.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.hashing import Spans, block_of, cut, mix, runs, span_hashes
from tablework.llm.lattice import Lattice, Memory, Pieces, memory, pieces, split, uniform
from tablework.llm.tables import key_columns

SAMPLES = 2
_BLOCK = 5 << 17
_SCHEMA = "doc_id bigint, rank int, ids binary, n_tokens bigint, log_prob double, perturbed double, inclusion double"
_NAMES = ["doc_id", "rank", "ids", "n_tokens", "log_prob", "perturbed", "inclusion"]
U64 = np.uint64


def encode_samples(docs: DataFrame, model: str, samples: int = SAMPLES, decoded: bool = False,
                   remember: bool = True) -> DataFrame:
    """Up to ``samples`` distinct segmentations of each whole text, best perturbed value first.

    One row per document row and rank: doc_id, rank (from 1), ids
    (little-endian unsigned 32-bit), n_tokens, log_prob under the lattice,
    perturbed (the Gumbel value) and inclusion (the chance, given the value of
    the next segmentation, that this one is among those taken; 1 when there is
    no next). With ``decoded``, ``text`` is what ``decode_samples`` makes of the ids,
    in the same pass. Texts with fewer segmentations give fewer rows; null and empty
    texts give one row without ids. Rows with equal doc_id and text get equal
    samples. ``model`` must be readable under the same name by every executor.
    Other columns are not looked at. Lattices are remembered from task to task,
    or without ``remember`` go with the task: then they are not held while the
    worker serves other operators.
    """
    def sample(batches):
        vocabulary, known = pieces(model), memory(model) if remember else Memory(pieces(model))
        for batch in batches:
            for table in cut(pa.Table.from_batches([batch]), "text", _BLOCK):
                rows = _sample_block(known, table, samples)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))]
                names = _NAMES
                if decoded:
                    columns, names = [*columns, _texts(vocabulary, columns[2].to_pylist())], [*_NAMES, "text"]
                yield from pa.table(columns, names=names).to_batches()

    return docs.select("doc_id", key_columns("doc_id", "text")[0], "text").mapInArrow(
        sample, _SCHEMA + (", text string" if decoded else ""))


def _texts(vocabulary: Pieces, blobs: list[bytes | None]) -> pa.Array:
    first = np.concatenate([[0], np.cumsum([len(b or b"") // 4 for b in blobs])])
    ids = np.frombuffer(b"".join(b or b"" for b in blobs), "<u4").astype(np.int64)
    return pa.array([None if b is None else t.decode("utf-8", "replace")
                     for b, t in zip(blobs, vocabulary.decode(ids, first))], pa.string())


def decode_samples(samples: DataFrame, model: str) -> DataFrame:
    """The rows with all their columns and ``text``, decoded from ``ids``; a column text is replaced.

    Null ids give a null text. Bytes that are no UTF-8 become U+FFFD.
    """
    kept = [c for c in samples.columns if c != "text"]

    def decode(batches):
        vocabulary = pieces(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = _texts(vocabulary, part.column("ids").to_pylist())
                yield pa.record_batch([part.column("row"), texts], names=["row", "text"])

    whole = samples.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "ids")
    out = whole.mapInArrow(decode, f"row {whole.schema['row'].dataType.simpleString()}, text string")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], "text")


def _with_blank(texts) -> tuple[np.ndarray, np.ndarray]:
    """The texts in a row, each that is not empty behind one blank."""
    block = block_of(texts)
    sizes = np.diff(block.bounds)  # a text and the blank behind it
    empty = sizes == 1
    # The blank behind a text serves as the one before the next; empty texts give up theirs.
    data = np.concatenate([[np.uint8(0x20)], block.data[:-1]]) if len(block.data) else block.data
    keep = np.ones(len(data), bool)
    keep[block.bounds[:-1][empty]] = False
    return data[keep], np.concatenate([[0], np.cumsum(sizes - empty)])


class _Text:
    """The search over one text: its paths so far, and the best places to leave them."""

    def __init__(self):
        self.paths, self.heap, self.taken = [], [], {}

    def offer(self, path: int, at: np.ndarray, value: np.ndarray, mass: np.ndarray, most: int) -> None:
        """Nodes of a path as places to leave it; only the best ``most`` can ever be used."""
        if len(value) > most:
            best = np.argpartition(-value, most - 1)[:most]
            at, value, mass = at[best], value[best], mass[best]
        for a, v, m in zip(at, value, mass):
            if v > -np.inf:
                heapq.heappush(self.heap, (-float(v), path, int(a), float(m)))


def _gumbel_below(mass: np.ndarray, top, u: np.ndarray) -> np.ndarray:
    """Gumbel variables at ``mass`` (log weights), given that they are below ``top``."""
    with np.errstate(divide="ignore", over="ignore"):
        return np.where(mass > -np.inf, mass - np.log(np.exp(mass - top) - np.log(u)), -np.inf)


def _sample_block(known: Memory, table: pa.Table, samples: int) -> list[tuple]:
    data, bounds = _with_blank(table.column("text"))
    strings = split(data, bounds)
    doc_ids = table.column("doc_id").to_pylist()
    keys = mix(table.column("key_a").to_numpy().view(np.uint64))
    if not len(strings.starts):
        return [(d, 1, b"", 0, 0.0, 0.0, 1.0) for d in doc_ids]
    hashes, once, kind = np.unique(span_hashes(data, strings.starts, strings.stops - strings.starts),
                                   return_index=True, return_inverse=True)
    places = known.places(hashes, data, strings.starts[once], strings.stops[once])
    walk = _Walk(known.lattice, known.pieces, strings, places[kind], keys)
    texts = [_Text() for _ in doc_ids]
    filled = np.flatnonzero(np.diff(strings.first) > 0)
    top = -np.log(-np.log(uniform(keys, 0)))
    start = {int(d): (float(top[d]), None, 0, 0) for d in filled}
    for rank in range(samples):
        walk.take(start, texts, rank, samples - rank)
        start = {} if rank + 1 == samples else {
            d: leave for d in start if (leave := walk.leave(texts[d], d, rank)) is not None}
        if not start:
            break
    rows = []
    for d, text in enumerate(texts):
        if not text.paths:
            rows.append((doc_ids[d], 1, b"", 0, 0.0, 0.0, 1.0))
            continue
        bar = -text.heap[0][0] if text.heap else -np.inf
        for rank, (edges, value, log_prob) in enumerate(text.paths):
            ids = walk.ids(edges)
            inclusion = 1.0 if bar == -np.inf else float(-np.expm1(-np.exp(log_prob - bar)))
            rows.append((doc_ids[d], rank + 1, ids.astype("<u4").tobytes(), len(ids), log_prob, value, inclusion))
    return rows


class _Walk:
    """Paths through the texts of one block."""

    def __init__(self, lattice: Lattice, vocabulary: Pieces, strings: Spans, kind: np.ndarray, keys: np.ndarray):
        self.lattice, self.fallback, self.strings = lattice, vocabulary.fallback, strings
        self.nodes, self.ends = lattice.start[kind], lattice.start[kind + 1] - 1
        owner = strings.owner()
        place = np.arange(len(kind)) - np.repeat(strings.first[:-1], np.diff(strings.first))
        self.seeds = mix(keys[owner] + mix(place.astype(np.uint64) + U64(1)))
        self.keys = keys

    def log_share(self, edges: np.ndarray) -> np.ndarray:
        return np.log(np.maximum(self.lattice.share[edges], 1e-300))

    def take(self, start: dict, texts: list[_Text], rank: int, most: int) -> None:
        """Draw the next path of each text in ``start``: (value, parent edges, string to go on in, node)."""
        nodes = self.nodes.copy()
        for d, (_, parent, string, node) in start.items():
            nodes[self.strings.first[d]:string] = self.ends[self.strings.first[d]:string]  # kept from the parent
            if parent is not None:
                nodes[string] = node
        active = np.zeros(len(self.strings.first) - 1, bool)
        active[list(start)] = True
        idle = ~np.repeat(active, np.diff(self.strings.first))
        nodes[idle] = self.ends[idle]
        drawn, first = self.lattice.draw(nodes, self.ends, mix(self.seeds + U64(rank + 1)))
        bounds, logs = first[self.strings.first], self.log_share(drawn)
        # Of every fresh edge: the log share of the path before it, then of leaving there.
        mass, known = np.zeros(len(drawn)), np.zeros(len(active), np.int64)
        for d, (value, parent, *_) in start.items():
            lo, hi = bounds[d], bounds[d + 1]
            fresh = logs[lo:hi]
            edges = drawn[lo:hi] if parent is None else np.concatenate([parent, drawn[lo:hi]])
            known[d] = len(edges) - len(fresh)
            before = np.cumsum(fresh if parent is None else np.concatenate([self.log_share(parent), fresh]))
            if len(fresh):
                mass[lo + 1:hi] = before[known[d]:-1]
                mass[lo] = before[known[d] - 1] if known[d] else 0.0
            texts[d].paths.append((edges, value, float(before[-1])))
        # An edge without a sibling leaves nothing, whatever rounding says.
        alone = self.lattice.degree(drawn) == 1
        with np.errstate(divide="ignore"):
            mass += np.where(alone, -np.inf, np.log(np.maximum(1.0 - self.lattice.share[drawn], 0.0)))
        size = np.diff(bounds)
        owner, at = np.repeat(np.arange(len(active)), size), runs(known, size)
        tops = np.zeros(len(active))
        tops[list(start)] = [value for value, *_ in start.values()]
        u = uniform(mix(self.keys[owner] + mix(at.astype(np.uint64) + U64((rank + 1) << 40))), 1)
        values = _gumbel_below(mass, tops[owner], u)
        for d in start:
            lo, hi = bounds[d], bounds[d + 1]
            texts[d].offer(len(texts[d].paths) - 1, at[lo:hi], values[lo:hi], mass[lo:hi], most)

    def leave(self, text: _Text, d: int, rank: int):
        """Where the next path of a text leaves an earlier one; None when every segmentation is taken."""
        if not text.heap:
            return None
        value, path, at, mass = heapq.heappop(text.heap)
        value = -value
        edges = text.paths[path][0]
        origin = int(self.lattice.origin[edges[at]])
        lo, hi = int(self.lattice.first[origin]), int(self.lattice.first[origin + 1])
        used = text.taken.setdefault((path, at), {int(edges[at])})
        free = np.array([e for e in range(lo, hi) if e not in used])
        share = self.lattice.share[free]
        key = self.keys[d:d + 1] + U64(rank + 1)
        chosen = int(free[min(np.searchsorted(np.cumsum(share), uniform(mix(key), 2)[0] * share.sum(), side="right"),
                              len(free) - 1)])
        used.add(chosen)
        others = [e for e in free if e != chosen]
        if others:
            # The siblings that are left, as a set, stay below the value just taken.
            before = float(self.log_share(edges[:at]).sum())
            left = before + float(np.log(max(self.lattice.share[others].sum(), 1e-300)))
            u = uniform(mix(key), 3)
            heapq.heappush(text.heap, (-float(_gumbel_below(np.array([left]), value, u)[0]), path, at, left))
        parent = np.append(edges[:at], chosen)
        # The string of the text in which the path leaves: strings end where targets are last nodes.
        done = int(np.count_nonzero(self.lattice.is_last(self.lattice.target[edges[:at]])))
        return value, parent, int(self.strings.first[d]) + done, int(self.lattice.target[chosen])

    def ids(self, edges: np.ndarray) -> np.ndarray:
        """The ids of a path, with a character without a piece as the ids of its bytes."""
        out = self.lattice.piece[edges]
        holes = out < 0
        if not holes.any():
            return out
        origin = self.lattice.origin[edges]
        size = np.where(holes, self.lattice.target[edges] - origin, 1)
        wide, spelled = np.repeat(out, size), np.repeat(holes, size)
        wide[spelled] = self.fallback[self.lattice.text[runs(origin, size)[spelled]]]
        return wide
