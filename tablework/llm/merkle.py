"""A Merkle manifest of a table: a root for all rows and a proof for each, by pointer jumping.

Every group of leaves is a tree of its own; the roots of the groups are the
leaves of one tree more. While a tree has several nodes on a level, every two
neighbours become one node, and a last lone one becomes a node by itself.

Leaves get their places from a range partitioning, so no task sorts a whole
group. The nodes of 1,024 neighbouring leaves are hashed together, ten levels
at a time. Then every node holds the digest beside it. Each self-join doubles
how far up a node points and appends the digests its ancestor holds, so a
proof of length n takes the logarithm of n joins. After a join only nodes that
later joins start from are kept, so the table never grows past its leaves.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.tables import parts, stage
from tablework.operators.joins import lookup

STEP = 10  # levels that one grouping climbs; a group holds 2**STEP digests at most
ROW_BYTES = 128

_NODES = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("pos", pa.int64()), ("beside", pa.binary()),
                    ("digest", pa.binary())])
_NODES_DDL = "tree string, level int, pos bigint, beside binary, digest binary"


def field(value: Column) -> Column:
    """A value as it enters a leaf: its UTF-8 byte count, a colon and itself, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def tree_key(group: Column) -> Column:
    """A group's name without null; null comes first and the rest keep their bytewise order."""
    return F.coalesce(F.concat(F.lit("="), group), F.lit("-"))


def placed(leaves: DataFrame, *order: str) -> DataFrame:
    """``leaves(tree, leaf, ...)`` with ``pos``, the place within the tree, and ``n``, the leaves of the tree.

    Leaves ascend by ``order`` and then by digest, null first; equal leaves are
    interchangeable. Only one row per range and tree is numbered in a window.
    """
    spark = leaves.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order, "leaf")]
    n = parts(spark, leaves.count() * ROW_BYTES)
    dealt = stage(leaves.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                  .withColumn("_id", F.monotonically_increasing_id()), "leaves")
    dealt = dealt.withColumn("_part", F.shiftright("_id", 33))
    runs = dealt.groupBy("tree", "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    runs = stage(runs.selectExpr(
        "tree", "_part",
        "sum(_rows) OVER (PARTITION BY tree ORDER BY _part) - _rows - _first AS _shift",
        "sum(_rows) OVER (PARTITION BY tree) AS n"), "runs")
    return lookup(dealt, runs, ["tree", "_part"]).withColumn("pos", F.col("_id") + F.col("_shift")).drop(
        "_id", "_part", "_shift")


def _height(n: int) -> int:
    return (n - 1).bit_length()


def _climb(base: int):
    """Nodes of one run of neighbours: what stands beside each, and the digest above them all."""
    def climb(key, table):
        tree = key[0].as_py()
        rows = sorted(zip(table.column("pos").to_pylist(), table.column("digest").to_pylist()))
        wide = table.column("n")[0].as_py()
        digests = [d.hex() for _, d in rows]
        at, levels = rows[0][0], min(STEP, _height(wide) - base)
        out: list[tuple] = []
        for level in range(base, base + levels):
            up = []
            for i in range(0, len(digests), 2):
                pair = digests[i:i + 2]
                out += [(level, at + i + k, bytes.fromhex(pair[1 - k]) if len(pair) == 2 else None, None)
                        for k in range(len(pair))]
                up.append(hashlib.sha256("".join(pair).encode()).hexdigest())
            digests, at = up, at // 2
        out += [(base + levels, at + i, None, bytes.fromhex(d)) for i, d in enumerate(digests)]
        columns = list(zip(*out))
        return pa.Table.from_arrays([pa.array([tree] * len(out), pa.string()),
                                     *[pa.array(c, f.type) for c, f in zip(columns, list(_NODES)[1:])]], schema=_NODES)
    return climb


def tree_nodes(leaves: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """From ``leaves(tree, pos, n, leaf)``: all nodes (tree, level, pos, beside), the roots (tree, root), the greatest height.

    ``beside`` is the digest of the other node of the pair, null for a lone one.
    A leaf that is alone in its tree is the root.
    """
    height = _height(leaves.agg(F.max("n")).first()[0] or 1)
    level = leaves.select("tree", "pos", "n", F.unhex("leaf").alias("digest"))
    nodes, roots = None, level.where("n = 1").select("tree", "digest")
    for base in range(0, height, STEP):
        several = level.where(F.col("n") > (1 << base))
        made = stage(several.groupBy("tree", F.shiftright("pos", STEP).alias("run")).applyInArrow(_climb(base), _NODES_DDL),
                     "nodes")
        beside = made.where("digest IS NULL").select("tree", "level", "pos", "beside")
        nodes = beside if nodes is None else nodes.unionByName(beside)
        tops = made.where("digest IS NOT NULL")
        sizes = several.where("pos = 0").select("tree", "n")
        level = lookup(tops.select("tree", "pos", "digest", "level"), sizes, ["tree"])
        done = F.col("n") <= F.shiftleft(F.lit(1).cast("bigint"), base + STEP)
        roots = roots.unionByName(level.where(done).select("tree", "digest"))
        level = stage(level.where(~done).select("tree", "pos", "n", "digest"), "level")
    if nodes is None:
        nodes = level.where("false").selectExpr("tree", "0 AS level", "pos", "CAST(NULL AS binary) AS beside")
    return nodes, roots.select("tree", F.lower(F.hex("digest")).alias("root")), height


def proofs(nodes: DataFrame, height: int) -> DataFrame:
    """(tree, pos, proof) for every leaf: the digests beside its path to the root, 32 bytes each, lowest first."""
    held = nodes.select("tree", "level", "pos", F.coalesce("beside", F.lit(b"")).alias("proof"))
    reach = 1
    while reach < height:
        # A node that points ``reach`` levels up takes over what its ancestor holds. Paths that end earlier stay.
        above = held.where(F.col("level") % (2 * reach) == reach).select(
            "tree", F.col("level").alias("_level"), F.col("pos").alias("_pos"), F.col("proof").alias("_more"))
        start = held.where(F.col("level") % (2 * reach) == 0).withColumn("_level", (F.col("level") + reach).cast("int")) \
            .withColumn("_pos", F.shiftright("pos", reach) if reach < 63 else F.lit(0).cast("bigint"))
        held = stage(lookup(start, above, ["tree", "_level", "_pos"]).select(
            "tree", "level", "pos", F.concat("proof", F.coalesce("_more", F.lit(b""))).alias("proof")), "proofs")
        reach *= 2
    return held.where("level = 0").select("tree", "pos", "proof")


def fold(leaf: Column, proof: Column, pos: Column, n: Column) -> Column:
    """The root that a leaf and the digests beside its path lead to."""
    half = lambda c: F.call_function("shiftright", c, F.lit(1))

    def up(at, _):
        lone = (at["pos"] % 2 == 0) & (at["pos"] == at["n"] - 1)
        beside = F.lower(F.hex(F.substring(proof, at["used"] * 32 + 1, F.lit(32))))
        pair = F.when(lone, at["digest"]).when(at["pos"] % 2 == 0, F.concat(at["digest"], beside)).otherwise(
            F.concat(beside, at["digest"]))
        return F.struct(F.sha2(pair.cast("binary"), 256).alias("digest"),
                        (at["used"] + F.when(lone, 0).otherwise(1)).alias("used"),
                        half(at["pos"]).alias("pos"), half(at["n"] + 1).alias("n"))

    levels = F.length(F.conv((n - 1).cast("string"), 10, 2)).cast("int")
    steps = F.when(n > 1, F.sequence(F.lit(1), levels)).otherwise(F.array().cast("array<int>"))
    start = F.struct(leaf.alias("digest"), F.lit(0).alias("used"), pos.alias("pos"), n.alias("n"))
    return F.aggregate(steps, start, up)["digest"]


def build_manifest(leaves: DataFrame, *order: str) -> DataFrame:
    """Subroot, root and proof of every leaf.

    ``leaves(tree, leaf, ...)`` holds lowercase hex digests and the group's
    ``tree_key``; other columns stay. Added are ``pos`` and ``n`` within the
    group, ``subroot``, ``proof``, the group's ``top_pos``, ``top_n`` and
    ``top_proof``, and ``root``. Rows may repeat: each is a leaf of its own.
    An empty table gives no rows.
    """
    leaves = placed(leaves, *order)
    nodes, subroots, height = tree_nodes(leaves)
    subroots = stage(subroots, "subroots")
    tops = placed(subroots.select(F.lit("all").alias("tree"), F.col("root").alias("leaf"), F.col("tree").alias("group")),
                  "group")
    top_nodes, roots, top_height = tree_nodes(tops)
    tops = lookup(lookup(tops, proofs(top_nodes, top_height), ["tree", "pos"]), roots, ["tree"])
    tops = stage(tops.select(
        F.col("group").alias("tree"), F.col("leaf").alias("subroot"), F.col("pos").alias("top_pos"),
        F.col("n").alias("top_n"), F.coalesce("proof", F.lit(b"")).alias("top_proof"), "root"), "tops")
    found = lookup(leaves, proofs(nodes, height), ["tree", "pos"])
    return lookup(found.withColumn("proof", F.coalesce("proof", F.lit(b""))), tops, ["tree"])


def verify(leaf: Column) -> Column:
    """The root that ``leaf`` leads to, by the columns of ``build_manifest``."""
    subroot = fold(leaf, F.col("proof"), F.col("pos"), F.col("n"))
    return fold(subroot, F.col("top_proof"), F.col("top_pos"), F.col("top_n"))


def document_manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """A leaf for every document, grouped by lang in order of doc_id, and whether it verifies when read again.

    Where ``tampered`` holds, the row is read again with one character more in
    ``n_chars``; a null ``n_chars`` stays. Null in any column, empty texts and
    repeated rows are leaves like others; rows of equal doc_id in one lang
    ascend by digest. Further columns of ``docs`` play no part.
    """
    values = [F.col(f"`{c}`") for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [F.col("n_chars") + 1 if c == "n_chars" else F.col(f"`{c}`")
               for c in ("doc_id", "source", "lang", "n_chars", "text")]
    altered = F.coalesce(tampered, F.lit(False)) & F.col("n_chars").isNotNull()
    leaves = stage(docs.select(tree_key(F.col("lang")).alias("tree"), "doc_id", leaf_digest(*values).alias("leaf"),
                               F.when(altered, leaf_digest(*changed)).alias("read_again")), "digests")
    manifest = build_manifest(leaves, "doc_id")
    siblings = F.concat(F.lower(F.hex("proof")), F.lower(F.hex("top_proof")))
    out = manifest.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
                          verify(F.coalesce("read_again", "leaf")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
