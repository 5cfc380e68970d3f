"""Draws without replacement and their inclusion against enumeration; results do not hang on what a worker remembers."""

import collections
import math
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from tablework.llm import lattice
from tablework.llm.hashing import span_hashes
from tablework.llm.lattice import Lattice, Memory, pieces
from tablework.llm.subword_samples import _sample_block

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def table(texts):
    keys = np.arange(len(texts), dtype=np.int64) * 977
    return pa.table({"doc_id": pa.array(range(len(texts))), "key_a": keys, "text": pa.array(texts, pa.string())})


def enumerated(word):
    """Every segmentation of one word as ids, with its chance."""
    data = np.frombuffer(b" " + word, np.uint8)
    whole = Lattice.build(pieces(MODEL), data, np.array([0]), np.array([len(data)]))
    open_, done = [(0, (), 1.0)], {}
    while open_:
        node, ids, chance = open_.pop()
        if node == len(data):
            done[ids] = chance
        for e in range(whole.first[node], whole.first[node + 1]):
            open_.append((int(whole.target[e]), (*ids, int(whole.piece[e])), chance * float(whole.share[e])))
    return done


def test_pairs_are_drawn_without_replacement():
    chances, n = enumerated(b"cat"), 20_000
    assert math.isclose(sum(chances.values()), 1)
    rows = _sample_block(Memory(pieces(MODEL)), table(["cat"] * n), 2)
    drawn, unbiased = collections.defaultdict(list), np.zeros(n)
    for doc_id, _, ids, _, log_prob, _, inclusion in rows:
        ids = tuple(np.frombuffer(ids, "<u4").tolist())
        assert math.isclose(math.exp(log_prob), chances[ids], rel_tol=1e-9)
        drawn[doc_id].append(ids)
        unbiased[doc_id] += chances[ids] / inclusion
    seen = collections.Counter(map(tuple, drawn.values()))
    for (a, b), count in seen.items():
        chance = chances[a] * chances[b] / (1 - chances[a])
        assert a != b and abs(count / n - chance) < 5 * math.sqrt(chance / n) + 1e-4
    assert abs(unbiased.mean() - 1) < 5 * unbiased.std() / math.sqrt(n)


def test_perturbed_values_fall_and_all_segmentations_come_once():
    chances = enumerated(b"ab")
    rows = _sample_block(Memory(pieces(MODEL)), table(["ab"] * 50), len(chances) + 3)
    for d in range(50):
        mine = [r for r in rows if r[0] == d]
        assert len(mine) == len({r[2] for r in mine}) == len(chances)
        values = [r[5] for r in mine]
        assert values == sorted(values, reverse=True) and all(r[6] == 1 for r in mine)


def test_what_is_remembered_changes_nothing(monkeypatch):
    random = np.random.default_rng(5)
    words = ["".join(random.choice(list("abcdeé日🙂 \n"), 6)) for _ in range(400)]
    blocks = [table([" ".join(random.choice(words, 40)) for _ in range(6)] + [None, "", "x" * 3000]) for _ in range(12)]
    fresh = [_sample_block(Memory(pieces(MODEL)), b, 3) for b in blocks]
    for edges in (1 << 30, 3_000, 0):
        monkeypatch.setattr(lattice, "_MEMORY_EDGES", edges)
        known = Memory(pieces(MODEL))
        assert [_sample_block(known, b, 3) for b in blocks] == fresh
        assert edges or len(known.lattice.origin) < 20_000


def test_equal_hashes_of_unequal_strings_do_no_harm():
    known, data = Memory(pieces(MODEL)), np.frombuffer(b" one two three", np.uint8)
    hashes = np.array([5], np.uint64)
    for a, b in ((0, 4), (4, 8), (8, 14), (0, 4)):
        place = int(known.places(hashes, data, np.array([a]), np.array([b]))[0])
        begin = known.lattice.start[place]
        assert known.lattice.text[begin:begin + b - a].tobytes() == data[a:b].tobytes()


def test_a_memory_takes_new_strings_without_a_copy_of_the_old(monkeypatch):
    def places(known, words):
        data = np.frombuffer("".join(words).encode(), np.uint8)
        stops = np.cumsum([len(w) for w in words])
        starts = stops - [len(w) for w in words]
        hashes, once = np.unique(span_hashes(data, starts, stops - starts), return_index=True)
        return known.places(hashes, data, starts[once], stops[once])

    known = lattice.Memory(pieces(MODEL))
    places(known, [f" word{i:06d}" for i in range(60_000)])
    held = sum(getattr(known.lattice, f).nbytes for f in known.lattice.__dataclass_fields__)
    tracemalloc.start()
    try:
        places(known, [f" other{i}" for i in range(100)])
        assert tracemalloc.get_traced_memory()[1] < held / 2
        # Half of the strings go: the rest moves up in place, and is what it was.
        monkeypatch.setattr(lattice, "_MEMORY_EDGES", len(known.lattice.origin) - 1)
        before, blocks = known.lattice.only(np.arange(5)), len(known.blocks)
        tracemalloc.reset_peak()
        start = tracemalloc.get_traced_memory()[0]
        known._forget()
        assert tracemalloc.get_traced_memory()[1] - start < held / 2
    finally:
        tracemalloc.stop()
    assert 100 < len(known.blocks) < 0.6 * blocks
    for field in before.__dataclass_fields__:
        assert (getattr(known.lattice.only(np.arange(5)), field) == getattr(before, field)).all()
