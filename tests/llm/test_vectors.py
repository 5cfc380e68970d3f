"""The vector searches against brute force: hard negatives, and nearest neighbours by hash forest."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import connect, differences
from tablework.llm import hash_forest, queries, shared_lists, vectors
from tablework.llm.hash_forest import Forest, nearest_neighbours
from tablework.llm.shared_lists import Windows, centres, hard_negatives, inner_products, walk

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, rank string, tag string, _piece string"
NAN, INF = float("nan"), float("inf")


def odd_rows():
    random = np.random.default_rng(5)
    rows = [(i, random.standard_normal(6).tolist(), i % 3) for i in range(0, 400, 2)]
    same = random.standard_normal(6).tolist()
    rows += [(i, same, i % 3) for i in range(1, 301, 2)]  # a large group of copies: ties everywhere
    rows += [(800, same, 0), (800, same, 0), (800, [9.0] * 6, 1), (900, [0.0] * 6, 1), (901, [], 1), (902, [1.0, 2.0], 2)]
    rows += [(950, None, 1), (951, [1.0, None] * 3, 1), (952, [1.0, NAN] * 3, 1), (953, [INF] * 6, 1), (1000, same, None),
             (None, same, 1), (1050, [1e4] * 6, 2), (1100, [-3e4] * 6, 1), (1200, [0.001] * 6, 2)]
    return [(*r, "clash", "clash", "clash", "clash") for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def test_hard_negatives_equal_the_sql_on_odd_rows(spark, odd, tmp_path, monkeypatch):
    odd.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = connect("/nowhere")
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    name = "op11_shared_lists"
    for block in (vectors.VECTOR_BLOCK_BYTES, 1):  # 1: blocks of 256 rows, so several pieces of a label
        monkeypatch.setattr(vectors, "VECTOR_BLOCK_BYTES", block)
        assert differences(queries.queries()[name](spark, str(tmp_path)), con, queries.oracle_sql()[name]) == []


def test_a_walk_stops_early_and_misses_nothing():
    random = np.random.default_rng(1)
    middle = random.standard_normal(16) * 400
    members = np.floor(middle + random.standard_normal((20, 16)) * 20)
    rows = np.floor(np.concatenate([middle + random.standard_normal((300, 16)) * 40, random.standard_normal((20_000, 16)) * 400]))
    ids, centre = np.arange(len(rows)), centres(members, 1)[0]
    wanted = Windows(np.arange(20), np.zeros(20, np.int64), np.full(20, -2**62), np.full(20, 2**62), 10)
    reached = walk(members, np.full(20, -1), np.zeros(20), rows, ids, np.zeros(len(rows)), centre, wanted, True)
    assert reached < len(rows) / 2
    scores = inner_products(members, rows)
    for m in range(20):
        expected = sorted(zip(-scores[m], ids))[:10]
        mine = wanted.member[wanted.window] == m
        assert sorted(zip(-wanted.score[mine], wanted.id[mine])) == expected


def test_inner_products_are_exact_or_refused():
    a, b = np.array([[2.0 ** 31 + 1, 3]]), np.array([[2.0 ** 30 + 7, -5]])
    assert inner_products(a, b)[0, 0] == (2 ** 31 + 1) * (2 ** 30 + 7) - 15
    with pytest.raises(OverflowError):
        inner_products(np.array([[2.0 ** 40]]), np.array([[2.0 ** 40]]))


def brute(rows, asks, k):
    once = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = tuple(np.float32(v).tolist())
            once[i] = min(once.get(i, v), v)
    ids = np.array(sorted(once))
    x = np.zeros((len(ids), max(map(len, once.values()))))
    for at, i in enumerate(ids):
        x[at, :len(once[i])] = once[i]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in ids[[bool(asks(i)) for i in ids]]:
        score = unit @ unit[np.searchsorted(ids, q)]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != q][:k]
        out[q] = [(ids[j], score[j]) for j in order]
    return out


def found_by(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def test_a_forest_that_gathers_all_rows_is_exact(odd, monkeypatch):
    for block in (vectors.VECTOR_BLOCK_BYTES, 1):
        monkeypatch.setattr(vectors, "VECTOR_BLOCK_BYTES", block)
        found = found_by(nearest_neighbours(odd, F.col("vec_id") % 50 == 0, share=1.0))
        expected = brute(odd_rows(), lambda i: i % 50 == 0, 5)
        assert found.keys() == expected.keys()
        for q, rows in expected.items():
            assert np.allclose([s for _, s in found[q]], [s for _, s in rows], atol=1e-12)
            assert {i for i, _ in found[q]} == {i for i, _ in rows}


def test_gathered_rows_share_the_longest_prefixes():
    random = np.random.default_rng(2)
    unit = random.standard_normal((500, 8))
    forest = Forest(unit, trees=3)
    strings = forest.strings(unit)
    got = dict(forest.gather(unit[:40], 50))
    assert sorted(got) == list(range(40))
    for q, rows in got.items():
        shared = np.max([64 - np.array([int(x).bit_length() for x in s ^ s[q]]) for s in strings], axis=0)
        depth = shared[rows].min()
        assert len(rows) >= 50 and set(rows) == set(np.flatnonzero(shared >= depth))
        assert (shared >= depth + 1).sum() < 50  # nobody went up further than needed


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    expected = brute(rows, lambda i: i % 50 == 0, 5)
    found = found_by(queries.queries()["op12_hash_forest"](spark, sf))
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in e}) for q, e in expected.items())
    assert hits / sum(map(len, expected.values())) >= 0.9
    assert all(len(found[q]) == 5 for q in expected)


def test_no_rows_and_few_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert nearest_neighbours(none, F.col("vec_id") % 50 == 0).collect() == []
    assert hard_negatives(none, F.col("vec_id") % 100 == 0).collect() == []
    one = spark.createDataFrame([(100, [1.0], 1, *"abcd"), (150, None, 1, *"abcd")], SCHEMA)
    assert nearest_neighbours(one, F.col("vec_id") % 50 == 0).collect() == []
    assert hard_negatives(one, F.col("vec_id") % 100 == 0).collect() == []
    assert hash_forest.SHARE < 1 and shared_lists.SAMPLE == 4096
