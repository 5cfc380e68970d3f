"""Hard negatives by exact search over candidate lists that the anchors of a cluster share.

Anchors are dealt to clusters by direction. An anchor lies within the cluster's
widest angle of the centre, so a candidate's inner product with it is at most
|anchor| * |candidate| * cos(angle to the centre - widest angle). A cluster
sorts the candidates by that bound once, and each of its anchors walks the list
from the top. It stops where the bound falls below what it still looks for: no
later candidate can matter, so the result is exact.

Scores are inner products of whole numbers. They are computed in doubles where
these hold every partial sum exactly, and in 64-bit integers elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.tables import stage
from tablework.llm.vectors import best, dimensions, finite, matrix, meet
from tablework.operators.joins import lookup

CLUSTERS = 32
#: The centres are fitted on so many anchors at most, those of the smallest hash; all anchors are dealt to them.
SAMPLE = 4096
SCALE = 256
_ROUNDS = 8
_FIRST_STEP, _LAST_STEP = 256, 4096
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

_FOUND = pa.schema([("anchor_id", pa.int64()), ("tag", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "anchor_id bigint, tag bigint, vec_id bigint, score bigint"


def centres(sample: np.ndarray, clusters: int = CLUSTERS) -> np.ndarray:
    """Unit directions of spherical k-means; the first ones are spread evenly over the sample."""
    norms = np.sqrt((sample * sample).sum(axis=1))
    unit = sample[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.eye(1, sample.shape[1])
    found = unit[np.linspace(0, len(unit) - 1, min(clusters, len(unit))).astype(int)]
    for _ in range(_ROUNDS):
        nearest = (unit @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, unit)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        found = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), found)
    return found


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows; a result beyond 64 bits is an error."""
    rough = a @ b.T
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1)
    if largest < 2 ** 53:
        return rough.astype(np.int64)
    if np.abs(a).max(initial=0) >= 2 ** 63 or np.abs(b).max(initial=0) >= 2 ** 63 or np.abs(rough).max(initial=0) >= 2 ** 63:
        raise OverflowError("a score does not fit in 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T  # wraps within sums, exact where the result fits


class Windows:
    """What each member looks for: the ``k`` best scores from ``low`` to ``high``, for one or more tags."""

    def __init__(self, member: np.ndarray, tag: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        order = np.argsort(member, kind="stable")
        self.member, self.tag, self.high, self.k = member[order], tag[order], high[order], k
        self.floor, self.floor_id = low[order].copy(), np.full(len(order), _MOST)
        self.window = self.row = np.zeros(0, np.int64)
        self.score = self.id = np.zeros(0, np.int64)

    def offer(self, member: np.ndarray, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Keep those that are among the best of a window; raise the floors of full windows."""
        first = np.searchsorted(self.member, member)
        each = np.searchsorted(self.member, member, side="right") - first
        pair = np.repeat(np.arange(len(member)), each)
        window = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each) + first[pair]
        s, i = score[pair], ids[pair]
        fits = (s <= self.high[window]) & ((s > self.floor[window]) | ((s == self.floor[window]) & (i < self.floor_id[window])))
        if not fits.any():
            return
        window = np.concatenate([self.window, window[fits]])
        s, i = np.concatenate([self.score, s[fits]]), np.concatenate([self.id, i[fits]])
        top = best(window, s, i, self.k)
        self.window, self.score, self.id = window[top], s[top], i[top]
        last = np.concatenate([self.window[1:] != self.window[:-1], [True]])
        rank = np.arange(len(top)) - np.searchsorted(self.window, self.window)
        full = last & (rank == self.k - 1)
        self.floor[self.window[full]] = self.score[full]
        self.floor_id[self.window[full]] = self.id[full]


def walk(members: np.ndarray, member_ids: np.ndarray, member_labels: np.ndarray, rows: np.ndarray, row_ids: np.ndarray,
         row_labels: np.ndarray, centre: np.ndarray, wanted: Windows, same_label: bool) -> int:
    """One cluster against one block of candidates; returns how many candidates of the shared list were reached."""
    member_norm, row_norm = (np.sqrt((x * x).sum(axis=1)) for x in (members, rows))
    angle = lambda x, norm: np.arccos(np.clip((x @ centre) / np.where(norm > 0, norm, 1), -1, 1))
    widest = angle(members, member_norm)[member_norm > 0].max(initial=0)
    bound = row_norm * np.cos(np.maximum(0, angle(rows, row_norm) - widest))
    order = np.argsort(-bound, kind="stable")
    bound, slack = bound[order], 1e-6 + 1e-7 * row_norm.max(initial=0) * member_norm
    start, step = 0, _FIRST_STEP
    while start < len(order):
        open_ = (member_norm * bound[start] + slack)[wanted.member] >= wanted.floor
        active = np.unique(wanted.member[open_])
        if not len(active):
            break  # certified: every later bound is below every floor
        block = order[start:start + step]
        scores = inner_products(members[active], rows[block])
        at = np.searchsorted(active, wanted.member[open_])
        low, high = np.full(len(active), _MOST), np.full(len(active), _LEAST)
        np.minimum.at(low, at, wanted.floor[open_])
        np.maximum.at(high, at, wanted.high[open_])
        passing = (scores >= low[:, None]) & (scores <= high[:, None])
        passing &= (member_labels[active][:, None] == row_labels[block][None, :]) == same_label
        passing &= member_ids[active][:, None] != row_ids[block][None, :]
        m, r = np.nonzero(passing)
        wanted.offer(active[m], block[r], scores[m, r], row_ids[block[r]])
        start, step = start + len(block), min(step * 2, _LAST_STEP)
    return start


def _search(dims: int, k: int, found_centres: np.ndarray, same_label: bool):
    def work(key, asking, rows):
        if not asking.num_rows or not rows.num_rows:
            return _FOUND.empty_table()
        members, candidates = matrix(asking.column("vector"), dims), matrix(rows.column("vector"), dims)
        ids, row_ids = asking.column("vec_id").to_numpy(), rows.column("vec_id").to_numpy()
        labels, row_labels = asking.column("label").to_numpy(), rows.column("label").to_numpy()
        if same_label:
            member, tag = np.arange(len(ids)), np.zeros(len(ids), np.int64)
            low, high = np.full(len(ids), _LEAST), np.full(len(ids), _MOST)
        else:
            lists = asking.column("positives").combine_chunks()
            member = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
            tag, score = (lists.flatten().field(i).to_numpy() for i in (0, 1))
            tens, ones = score // 10, score % 10
            low, high = 3 * tens + (3 * ones + 9) // 10, 9 * tens + 9 * ones // 10  # 30 p <= 100 s <= 90 p
        cluster = (members @ found_centres.T).argmax(axis=1)
        out: list[list[np.ndarray]] = []
        for c in np.unique(cluster):
            inside = np.flatnonzero(cluster == c)
            mine = (cluster[member] == c) & (low <= high)
            wanted = Windows(np.searchsorted(inside, member[mine]), tag[mine], low[mine], high[mine], k)
            walk(members[inside], ids[inside], labels[inside], candidates, row_ids, row_labels, found_centres[c], wanted,
                 same_label)
            out.append([ids[inside][wanted.member[wanted.window]], wanted.tag[wanted.window], wanted.id, wanted.score])
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=_FOUND)
    return work


def _floor(x: Column) -> Column:
    """The floor as a double, for numbers of any size; from 2**53 on every double is whole."""
    return F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x)


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, clusters: int = CLUSTERS) -> DataFrame:
    """Negatives of every anchor and positive, by exact search.

    ``vectors`` has vec_id, label and embedding; ``anchors`` is a Column that
    marks the anchors. A component x counts as floor(256 * x). An anchor's
    positives are its best other rows of the same label. Its negatives for one
    of them are the best rows of other labels that score from 0.3 to 0.9 times
    as high, so a positive of negative score has none.

    Rows with a null id, label or vector, or a null or non-finite component
    take no part; where rows share an id, the smallest label and vector stand
    for it. A shorter vector counts as continued with zeros. Ties go to the
    smaller vec_id. An empty table gives no rows. Further columns of ``vectors``
    may have any name and are not read.
    """
    vector = F.col("embedding").cast("array<double>")
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(vector))
    whole = F.transform(vector, lambda x: _floor(x * SCALE))
    once = good.select("vec_id", F.struct(F.col("label").cast("bigint").alias("label"), whole.alias("vector")).alias("_row"),
                       anchors.alias("_anchor")).groupBy("vec_id").agg(F.min("_row").alias("_row"), F.max("_anchor").alias("_anchor"))
    rows = stage(once.select("vec_id", "_row.label", "_row.vector", "_anchor"), "vectors")
    dims = dimensions(rows)
    asking = stage(rows.where("_anchor").drop("_anchor"), "anchors")
    rows = rows.drop("_anchor")
    sample = asking.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toArrow()
    middles = centres(matrix(sample.column("vector"), dims), clusters)
    found = meet(asking, rows, _search(dims, positives, middles, True), _FOUND_DDL, dims, by=["label"])
    chosen = stage(_best(found, ["anchor_id"], positives).select("anchor_id", "vec_id", "score"), "positives")
    grouped = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    asking = stage(lookup(asking, grouped, ["vec_id"]).where("positives IS NOT NULL"), "asking")
    found = meet(asking, rows, _search(dims, negatives, middles, False), _FOUND_DDL, dims)
    best = _best(found, ["anchor_id", "tag"], negatives)
    named = chosen.select("anchor_id", F.col("vec_id").alias("tag"), F.col("score").alias("positive_score"))
    return lookup(best, named, ["anchor_id", "tag"]).select(
        "anchor_id", F.col("tag").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
