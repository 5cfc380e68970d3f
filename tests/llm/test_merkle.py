"""The Merkle manifest against a plain recursion."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from oracle import connect, differences
from tablework.llm import queries
from tablework.llm.merkle import build_manifest, document_manifest, verify

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos string, n string, leaf string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(level, at):
    """Root of a level, and what stands beside the path of the node ``at``."""
    beside = ""
    while len(level) > 1:
        pair = level[at // 2 * 2:at // 2 * 2 + 2]
        beside += "".join(x for i, x in enumerate(pair) if i != at % 2)
        level, at = [h(*level[i:i + 2]) for i in range(0, len(level), 2)], at // 2
    return level[0], beside


def leaves(spark, sizes):
    rows = [(f"={name}", i, h(f"{name}{i}")) for name, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "tree string, i int, leaf string").repartition(5)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 1, "b": 1}, {"a": 3, "b": 1, "c": 6}, {"a": 2500, "b": 1024, "c": 1025}])
def test_roots_and_proofs_equal_the_recursion(spark, sizes):
    df = build_manifest(leaves(spark, sizes), "i").withColumn("again", verify(F.col("leaf"))).withColumn(
        "wrong", verify(F.sha2(F.concat("leaf", F.lit("x")), 256)))
    tops = {name: climb([h(f"{name}{i}") for i in range(n)], 0)[0] for name, n in sizes.items()}
    root = climb(list(tops.values()), 0)[0]
    rows = df.collect()
    assert len(rows) == sum(sizes.values())
    for r in rows[::7]:
        name = r.tree[1:]
        level = [h(f"{name}{i}") for i in range(sizes[name])]
        proof = climb(level, r.i)[1] + climb(list(tops.values()), list(tops).index(name))[1]
        assert (r.pos, r.n, r.subroot, r.root) == (r.i, sizes[name], tops[name], root)
        assert bytes(r.proof + r.top_proof).hex() == proof
    assert all(r.again == root != r.wrong for r in rows)


def test_odd_rows_equal_the_sql(spark, tmp_path):
    rows = [(i, f"text {i}", "en", "s", i) for i in range(40)] + [(7, "other", "en", None, None), (7, "text 7", "en", "s", 7)]
    rows += [(None, None, None, None, None), (None, "x", None, "s", 1), (1, "", "", "", 0), (2, "é日🙂" * 9000, "日", "ü", -5)]
    rows += [(i, "t", "hot", "s", 3) for i in range(-3, 200)]
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = connect("/nowhere")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    name = "op13_merkle_manifest"
    df = queries.queries()[name](spark, str(tmp_path))
    assert differences(df, con, queries.oracle_sql()[name]) == []
    bad = {r.doc_id for r in df.where("NOT verified").collect()}
    assert bad == {i for i, *_, n in rows if i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0}


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert document_manifest(none, F.lit(True)).collect() == []
