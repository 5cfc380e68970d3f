"""Near-duplicate documents by a grouped prefix join on word shingles.

Documents with equal shingle sets are one class. Shingles are ordered by how
many classes hold them, rare ones first, so two classes that are similar
enough share one of the first few; a shingle of one class alone is counted in
positions but never looked up. Classes of the same size and the same first
shingles form one group, and only groups are paired. Within the groups that
share a shingle, all are first held against the most central one; pairs that
are still in different components, and that size and position do not rule out,
are then held against each other. So no link that joins two components is
lost, and a cluster of near copies does not cost all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.components import components
from tablework.llm.counted import BLOB_SCHEMA, count_blobs, count_buckets, read_answers
from tablework.llm.hashing import Block, block_of, cut, mix, window_hashes, word_hashes, words_of
from tablework.llm.tables import BLOCK_BYTES, key_columns, parts, stage, text_bytes
from tablework.operators.joins import lookup

SHINGLE, PERCENT = 5, 75
PAIR_BLOCK = 2048
#: Pairs that leave a task at once, and those of one more member.
_PAIRS_AT_ONCE = 1 << 16
#: Bytes of text whose shingles a task holds at once.
_CHUNK = BLOCK_BYTES // 2
#: Bytes of text whose words are hashed at once; the arrays on the way take many times that.
_SLICE = BLOCK_BYTES // 8
_SUMMARY = ("chunk int, doc_id bigint, key_a bigint, key_b bigint, n bigint, set_a bigint, set_b bigint")
_RECORD = ("node string, n bigint, alone bigint, prefix_a bigint, prefix_b bigint, firsts array<bigint>, "
           "shared binary")


def lowered(block: Block) -> Block:
    """A-Z as a-z, other bytes unchanged."""
    upper = (block.data >= 65) & (block.data <= 90)
    return Block(block.data + upper.astype(np.uint8) * np.uint8(32), block.bounds)


def shingles(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, and the first of each text.

    A text of fewer words than ``size``, but not none, has its whole word
    sequence as its one shingle.
    """
    found, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for table in cut(pa.table([texts], names=["text"]), "text", _SLICE):
        hashes, first = _shingles_at_once(table.column("text"), size)
        found.append(hashes)
        counts.append(np.diff(first))
    return np.concatenate(found), np.cumsum(np.concatenate(counts))


def _shingles_at_once(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    block = lowered(block_of(texts))
    words = words_of(block)
    hashes = word_hashes(block, words)
    lengths = np.diff(words.first)
    found, at = window_hashes(hashes, words.first, size)
    owner = np.repeat(np.arange(len(lengths)), np.maximum(lengths - size + 1, 0))
    short = [(i, window_hashes(hashes[words.first[i]:words.first[i + 1]], np.array([0, lengths[i]]), lengths[i])[0])
             for i in np.flatnonzero((lengths > 0) & (lengths < size))]
    if short:
        owner = np.concatenate([owner, [i for i, _ in short]])
        found = np.concatenate([found, *[h for _, h in short]])
        order = np.argsort(owner, kind="stable")
        owner, found = owner[order], found[order]
    _, once = np.unique(found ^ mix(owner.astype(np.uint64) + np.uint64(1)), return_index=True)
    once.sort()
    return found[once], np.searchsorted(owner[once], np.arange(len(lengths) + 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return running[first[1:]] - running[first[:-1]]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id.

    Texts are lower-cased in A-Z and split at space and \\x09-\\x0D. Documents
    link when 100 * common shingles >= percent * shingles of either;
    ``component_id`` is the smallest doc_id that links lead to, the document's
    own included. A document without words (null text included) has no
    shingles and only itself. A null doc_id takes part, but is never the
    smallest unless no other is there; repeated rows get one row each. Other
    columns are not looked at.
    """
    return _placed(docs, size, percent).select("doc_id", F.col("n").alias("n_shingles"), F.when(
        F.col("n") > 0, F.col("chosen.doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, that stay when each component keeps one.

    The one with the smallest doc_id stays; of equal ids, and where all are
    null, the one with the smallest key. Documents without words stay. Rows
    with equal doc_id and text count as one document; one of them stays.
    """
    stay = _placed(docs, size, percent).where(
        (F.col("n") == 0) | ((F.col("key_a") == F.col("chosen.key_a")) & (F.col("key_b") == F.col("chosen.key_b")))
    ).select("key_a", "key_b").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key_columns("doc_id", "text"))
    kept = rows.join(stay, ["key_a", "key_b"], "left_semi").groupBy("key_a", "key_b").agg(F.first("row").alias("row"))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _placed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, key_a, key_b, n and ``chosen(unknown, doc_id, key_a, key_b, chunk)``, the row that stands for the component."""
    spark = docs.sparkSession
    bytes_in = text_bytes(docs)
    chunks, buckets = parts(spark, bytes_in, _CHUNK), parts(spark, bytes_in, 2 * BLOCK_BYTES)
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk")
    keyed = docs.select(chunk, "doc_id", *key_columns("doc_id", "text"), "text")

    def summarise(batches):
        for batch in batches:
            for table in cut(pa.Table.from_batches([batch]), "text", _CHUNK):
                found, first = shingles(table.column("text"), size)
                for b in pa.Table.from_arrays(
                        [*[table.column(c).combine_chunks() for c in ("chunk", "doc_id", "key_a", "key_b")],
                         pa.array(np.diff(first)), _signed(_sums(mix(found), first)),
                         _signed(_sums(mix(found * np.uint64(0x9E3779B97F4A7C15)), first))],
                        names=["chunk", "doc_id", "key_a", "key_b", "n", "set_a", "set_b"]).to_batches():
                    yield b

    summary = stage(keyed.mapInArrow(summarise, _SUMMARY), "summary")
    classes = stage(summary.where("n > 0").groupBy("set_a", "set_b", "n").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key_a", "key_b", "chunk")).alias("least"))
        .select("set_a", "set_b", "n", "least.chunk", "least.key_a", "least"), "classes")
    labels = _labels(_records(keyed, classes, size, percent, buckets), percent)
    node = F.concat(F.hex("set_a"), F.lit("."), F.hex("set_b")).alias("node")
    placed = lookup(classes.select(node, "set_a", "set_b", "least"), labels, ["node"]).withColumn(
        "label", F.coalesce("label", "node"))
    chosen = placed.groupBy("label").agg(F.min("least").alias("chosen"))
    members = lookup(placed, chosen, ["label"]).select("set_a", "set_b", "chosen")
    # Documents without words share one key there, and get no partner.
    return lookup(summary, members, ["set_a", "set_b"]).select("doc_id", "key_a", "key_b", "n", "chosen")


def _records(keyed: DataFrame, classes: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """One row for every class whose prefix holds a shingle of another class."""
    blocks = keyed.select("chunk", "key_a", "text")
    reps = classes.select("chunk", "key_a", "set_a", "set_b")

    def chosen(table, wanted):
        """One row of the block for each class that it speaks for."""
        keys = table.column("key_a").to_numpy()
        _, once = np.unique(keys, return_index=True)
        return table.take(np.sort(once[np.isin(keys[once], wanted)]))

    def send(key, table, side):
        rows = chosen(table, side.column("key_a").to_numpy())
        found, _ = shingles(rows.column("text"), size)
        return count_blobs(key[0].as_py(), found, buckets)

    answers = count_buckets(blocks.groupBy("chunk").cogroup(reps.groupBy("chunk")).applyInArrow(send, BLOB_SCHEMA))
    empty = [F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("answer")]
    none = [F.lit(None).cast("bigint").alias(c) for c in ("key_a", "set_a", "set_b")]
    side = reps.select("*", *empty).unionByName(answers.select("chunk", *none, "bucket", "answer"))

    def record(table, side):
        known = pa.compute.is_valid(side.column("key_a"))
        reps, found = side.filter(known), side.filter(pa.compute.invert(known))
        rows = chosen(table, reps.column("key_a").to_numpy())
        place = {k: i for i, k in enumerate(reps.column("key_a").to_pylist())}
        names = [f"{a & (2**64 - 1):X}.{b & (2**64 - 1):X}" for a, b in
                 zip(reps.column("set_a").to_pylist(), reps.column("set_b").to_pylist())]
        hashes, first = shingles(rows.column("text"), size)
        spread = read_answers(found, hashes)
        out = []
        for i, key in enumerate(rows.column("key_a").to_pylist()):
            own, df = hashes[first[i]:first[i + 1]], spread[first[i]:first[i + 1]]
            n, alone = len(own), int((df == 1).sum())
            prefix = n - -(-percent * n // 100) + 1
            if alone >= prefix:
                continue
            order = np.lexsort((own, df))
            head = own[order[:prefix]]
            out.append((names[place[key]], n, alone, *_prefix_key(head),
                        head[alone:].view(np.int64).tolist(), own[order[alone:]].tobytes()))
        return pa.Table.from_pylist([dict(zip(RECORD_ARROW.names, r)) for r in out], schema=RECORD_ARROW)

    return stage(blocks.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(record, _RECORD), "records")


RECORD_ARROW = pa.schema([("node", pa.string()), ("n", pa.int64()), ("alone", pa.int64()), ("prefix_a", pa.int64()),
                          ("prefix_b", pa.int64()), ("firsts", pa.list_(pa.int64())), ("shared", pa.binary())])


def _prefix_key(head: np.ndarray) -> tuple[int, int]:
    place = np.arange(1, len(head) + 1, dtype=np.uint64)
    return tuple(int(mix(head * np.uint64(odd) + place).sum(dtype=np.uint64).view(np.int64))
                 for odd in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95))


def _labels(records: DataFrame, percent: int) -> DataFrame:
    """(node, label) for the classes that link with another."""
    group = ["n", "alone", "prefix_a", "prefix_b"]
    groups = records.groupBy(*group).agg(F.min("node").alias("gid"), F.min_by("firsts", "node").alias("firsts"))
    postings = stage(groups.select("gid", "n", "alone", F.posexplode("firsts").alias("i", "token")).withColumn(
        "position", F.col("alone") + F.col("i")).drop("i", "firsts"), "postings")
    members = stage(lookup(records.select("node", *group), groups.drop("firsts"), group).select("gid", "node"),
                    "members")

    # Held against the most central group of each shingle, and of their own group.
    central = postings.groupBy("token").agg(
        F.count("*").alias("held"), F.min(F.struct((F.col("alone") / F.col("n")).alias("share"), "gid", "n",
                                                   "position")).alias("hub")).where("held > 1")
    near = lookup(postings, central, ["token"]).where("hub.gid <> gid").where(
        _possible(F.col("n"), F.col("position"), F.col("hub.n"), F.col("hub.position"), percent)).select(
        "gid", F.col("hub.gid").alias("b")).distinct()
    spokes = near.join(members, "gid").select(F.col("node").alias("a"), "b").unionByName(
        members.where("node <> gid").select(F.col("node").alias("a"), F.col("gid").alias("b")))
    first = stage(_verified(spokes, records, percent), "links")
    labels = stage(components(first), "labels")

    # What is left: groups that share a shingle and lie in different components.
    labelled = lookup(members, labels, ["node"]).withColumn("label", F.coalesce("label", "node"))
    lists = postings.join(labelled, "gid")
    apart = lists.groupBy("token").agg(F.count("*").alias("held"), F.min("label").alias("lo"),
                                       F.max("label").alias("hi")).where("lo <> hi").select("token", "held")
    rest = _verified(_apart_pairs(lists.join(apart, "token"), percent).distinct(), records, percent)
    more = stage(rest, "links")
    if more.isEmpty():
        return labels
    tree = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    return stage(components(tree.unionByName(more)), "labels")


def _possible(n, at, other_n, other_at, percent: int):
    """May sets of these sizes reach the threshold when their first common shingle is at these positions?"""
    common = F.least(n - at, other_n - other_at)
    return 100 * common >= percent * (n + other_n - common)


def _apart_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): members of one list in different components that sizes and positions do not rule out.

    A list is cut into blocks, and each pair of blocks is one group, so no
    task holds a long list; only pairs that pass leave the task, some at a time.
    """
    blocks = F.ceil(F.col("held") / PAIR_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = lists.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "token", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own",
        "node", "label", "n", "position")

    def pair(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        lo, hi = key[1].as_py(), key[2].as_py()
        own = table.column("own").to_numpy()
        n, at = table.column("n").to_numpy(), table.column("position").to_numpy()
        label = table.column("label").combine_chunks().dictionary_encode()
        label = label.indices.to_numpy()
        left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        node = table.column("node").combine_chunks()
        a, b, held = [], [], 0
        for place, i in enumerate(left, 1):
            j = right[right > i] if lo == hi else right
            common = np.minimum(n[i] - at[i], n[j] - at[j])
            j = j[(label[i] != label[j]) & (100 * common >= percent * (n[i] + n[j] - common))]
            a.append(np.full(len(j), i))
            b.append(j)
            held += len(j)
            if held >= _PAIRS_AT_ONCE or held and place == len(left):
                yield pa.record_batch([node.take(pa.array(np.concatenate(x))) for x in (a, b)], names=["a", "b"])
                a, b, held = [], [], 0

    pairs = dealt.groupBy("token", "lo", "hi").applyInArrow(pair, "a string, b string")
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _verified(pairs: DataFrame, records: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the threshold."""
    for side in ("a", "b"):
        held = records.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"),
                              F.col("shared").alias(f"set_{side}"))
        pairs = lookup(pairs, held, [side])

    def check(batches):
        for batch in batches:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            common = np.array([len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64),
                                                  np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True))
                               for x, y in zip(batch.column("set_a"), batch.column("set_b"))], np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(100 * common >= percent * (n - common)))

    return pairs.mapInArrow(check, "a string, b string")
