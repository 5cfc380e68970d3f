"""What the operators of the pipeline hold in a Python worker, during their work and after it."""

import gc
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tablework.llm import counted, jaccard_join, lattice
from tablework.llm.counted import count_blobs, count_buckets, read_answers
from tablework.llm.jaccard_join import shingles


def peak(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def texts(rows, words):
    random = np.random.default_rng(11)
    return pa.array([" ".join(f"Word{i}" for i in random.integers(0, 5_000, n)) for n in random.integers(0, words, rows)]
                    + [None, "", "one two"], pa.string())


def test_shingles_of_a_block_are_made_in_slices(monkeypatch):
    block = texts(2_000, 300)
    (found, first), most = peak(lambda: shingles(block, 5))
    monkeypatch.setattr(jaccard_join, "_SLICE", 1 << 40)
    (whole, bounds), at_once = peak(lambda: shingles(block, 5))
    assert (found == whole).all() and (first == bounds).all() and len(first) == len(block) + 1
    assert most < 0.6 * at_once
    assert [len(x) for x in shingles(pa.array([], pa.string()), 5)] == [0, 1]


class _Total:
    """Takes the place of a DataFrame and keeps the function that would run on each of its groups."""

    def withColumn(self, *columns):
        return self

    def select(self, *columns):
        return self

    def groupBy(self, *columns):
        return self

    def applyInArrow(self, work, schema):
        return work


@pytest.mark.parametrize("at_once", [1 << 40, 1 << 12, 7])
def test_counts_of_a_range_hang_on_no_slices(monkeypatch, at_once):
    monkeypatch.setattr(counted, "_AT_ONCE", at_once)
    random = np.random.default_rng(3)
    blocks = [random.choice(random.integers(0, 1 << 64, 900, np.uint64), n) for n in (2_000, 1, 700, 5_000)]
    blocks.append(np.full(3_000, blocks[0][0]))
    table = pa.concat_tables([count_blobs(k, b, 1) for k, b in enumerate(blocks)])
    answers = count_buckets(_Total())((pa.scalar(0, pa.int32()),), table)
    values, counts = np.unique(np.concatenate(blocks), return_counts=True)
    for k, b in enumerate(blocks):
        mine = answers.filter(pa.compute.equal(answers.column("chunk"), k))
        assert [int(c).bit_length() for c in counts[np.searchsorted(values, b)]] == read_answers(mine, b).tolist()


def test_a_range_is_counted_in_little_memory():
    random = np.random.default_rng(4)
    table = pa.concat_tables([count_blobs(k, random.integers(0, 1 << 64, 100_000, np.uint64), 1) for k in range(16)])
    _, most = peak(lambda: count_buckets(_Total())((pa.scalar(0, pa.int32()),), table))
    assert most < 25 * 1_600_000


def test_pairs_of_two_blocks_leave_some_at_a_time(spark, monkeypatch):
    def lists(held):
        label = [f"l{i % 300}" for i in range(held)]
        n = [20 + i % 9 for i in range(held)]
        return [(7, held, f"n{i:05d}", label[i], n[i], i % 4) for i in range(held)]

    def possible(x, y):
        common = min(x[4] - x[5], y[4] - y[5])
        return x[3] != y[3] and 100 * common >= 75 * (x[4] + y[4] - common)

    monkeypatch.setattr(jaccard_join, "PAIR_BLOCK", 100)
    monkeypatch.setattr(jaccard_join, "_PAIRS_AT_ONCE", 500)
    rows = lists(400)
    df = spark.createDataFrame(rows, "token long, held long, node string, label string, n long, position long")
    found = jaccard_join._apart_pairs(df, 75).collect()
    expected = {(x[2], y[2]) for x in rows for y in rows if x[2] > y[2] and possible(x, y)}
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected

    taken = []
    monkeypatch.setattr(_Total, "applyInArrow", lambda self, work, schema: taken.append(work) or self)
    jaccard_join._apart_pairs(_Total(), 75)
    rows = lists(600)
    table = pa.table({"own": pa.array([i % 2 for i in range(600)], pa.int32()), "node": [r[2] for r in rows],
                      "label": [r[3] for r in rows], "n": [r[4] for r in rows], "position": [r[5] for r in rows]})
    batches = list(taken[0]((pa.scalar(7), pa.scalar(0), pa.scalar(1)), iter(table.to_batches())))
    assert len(batches) > 9 and all(b.num_rows < 500 + 300 for b in batches)
    assert sum(b.num_rows for b in batches) == sum(
        possible(x, y) for x in rows[0::2] for y in rows[1::2])


def test_a_worker_of_the_pipeline_remembers_no_lattices_when_its_task_is_over(spark, monkeypatch):
    monkeypatch.setitem(spark.sparkContext.environment, "WORKERS_OF", "this test")
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(40)], "doc_id long, text string")
    assert corpus_pipeline.subwords(spark, docs, "").count() == 80

    def held(batches):
        for _ in batches:
            gc.collect()
            yield pa.record_batch([pa.array([len(lattice._PIECES)]), pa.array([sum(
                type(x).__name__ == "Memory" for x in gc.get_objects())])], names=["used", "memories"])

    rows = docs.repartition(16).select("doc_id").mapInArrow(held, "used long, memories long").collect()
    assert any(r.used for r in rows) and not any(r.memories for r in rows)


def test_workers_of_the_pipeline_give_freed_memory_back(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    corpus_pipeline.near_duplicates(spark, docs, "").collect()

    def allocator(batches):
        for _ in batches:
            yield pa.record_batch([pa.array([pa.default_memory_pool().backend_name])], names=["name"])

    assert docs.select("doc_id").mapInArrow(allocator, "name string").first().name == "system"
