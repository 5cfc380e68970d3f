"""Quality rules whose cutoffs are proven on labelled documents.

Fixed base rules drop very short and very repetitive texts. Further rules
reject a text when a measure of it reaches a cutoff. Cutoffs are tested per
stratum from the loosest to the tightest: one passes while the exact binomial
test says that at most ``RISK / rules`` of the good documents lie beyond it.
The first that fails ends the sequence, so the grid needs no correction; the
level is divided by the number of rules and strata. Evidence is one distinct
text: copies of a text and repeated rows of a document count once. So with
probability 1 - ``LEVEL``, the rules reject in no stratum more than ``RISK`` of
the good texts that pass the base rules. What the base rules drop comes on top.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.hashing import Block, block_of, cut, mix, span_hashes, window_hashes, word_hashes, words_of
from tablework.llm.tables import BLOCK_BYTES, key_columns, stage
from tablework.operators.joins import lookup

RISK, LEVEL = 0.05, 0.05
REPEAT_WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20
#: A passed cutoff must reject this many bad documents for each good one.
WORTH = 5
BINS = 400
BROADCAST_STRATA = 10_000
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_NOT_LINE_FEED = np.arange(256) != 0x0A


def _bin(value: Column) -> Column:
    return F.least(F.floor(value), F.lit(BINS)).cast("int")


def _rules() -> dict[str, Column]:
    """The grid place of each measure; a text is rejected from a place upward."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    length = F.col("word_chars") / words
    return {
        "symbols": _bin(F.col("n_symbols") / words * 50),
        "dup_lines": _bin(F.col("n_dup_lines") / lines * 50),
        "repeats": _bin(F.col("n_repeat_words") / words * 50),
        "long_words": _bin(length * 4),
        "short_words": _bin(F.greatest(F.lit(0), 20 - length) * 4),
    }


def text_measures(docs: DataFrame) -> DataFrame:
    """doc_id, stratum (lang, or empty for null) and the counts of each whole text.

    Words are runs of characters other than space and \\x09-\\x0D; null texts
    have none. ``n_repeat_words`` counts words in 5-word windows that the text
    holds twice or more; ``n_dup_lines`` counts lines with a word that equal an
    earlier line.
    """
    return _measured(docs).drop("key_a", "key_b")


def _measured(docs: DataFrame) -> DataFrame:
    """``text_measures`` with two hashes that together name the text."""
    def measure(batches):
        for batch in batches:
            for table in cut(pa.Table.from_batches([batch]), "text", BLOCK_BYTES):
                counts = [pa.array(c.astype(np.int64)) for c in _counts(table.column("text"))]
                kept = [table.column(c).combine_chunks() for c in named]
                yield from pa.Table.from_arrays([*kept, *counts], names=[*named, *_MEASURES]).to_batches()

    named = ["doc_id", "stratum", "key_a", "key_b"]
    return docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"),
                       *key_columns("text"), "text").mapInArrow(
        measure, "doc_id bigint, stratum string, key_a bigint, key_b bigint, " + ", ".join(f"{m} bigint" for m in _MEASURES))


def _totals(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(flags)])
    return running[bounds[1:]] - running[bounds[:-1]]


def _once(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: is it the first of its kind in its text, and how often does the text hold it?"""
    _, first, back, count = np.unique(hashes ^ mix(owner.astype(np.uint64) + np.uint64(1)), return_index=True,
                                      return_inverse=True, return_counts=True)
    is_first = np.zeros(len(hashes), bool)
    is_first[first] = True
    return is_first, count[back] if len(hashes) else np.zeros(0, np.int64)


def _counts(texts) -> list[np.ndarray]:
    block = block_of(texts)
    words = words_of(block)
    n_words = np.diff(words.first)
    is_char = np.zeros(len(block.data) + 1, np.int8)
    is_char[words.starts] += 1
    is_char[words.stops] -= 1
    is_char = (np.cumsum(is_char[:-1], dtype=np.int8) > 0) & ((block.data & 0xC0) != 0x80)

    found, at = window_hashes(word_hashes(block, words), words.first, REPEAT_WINDOW)
    owner = np.repeat(np.arange(block.texts), np.maximum(n_words - REPEAT_WINDOW + 1, 0))
    _, times = _once(found, owner)
    change = np.zeros(len(words.starts) + 1, np.int64)
    again = at[times > 1]
    np.add.at(change, again, 1)
    np.add.at(change, again + REPEAT_WINDOW, -1)

    data = block.data.copy()
    data[block.bounds[1:] - 1] = 0x0A
    lines = words_of(Block(data, block.bounds), _NOT_LINE_FEED)
    place = np.searchsorted(words.starts, lines.starts)
    filled = (np.append(words.starts, len(data))[place] < lines.stops) if len(lines.starts) else np.zeros(0, bool)
    owner = lines.owner()[filled]
    hashes = (span_hashes(data, lines.starts[filled], (lines.stops - lines.starts)[filled])
              if filled.any() else np.zeros(0, np.uint64))
    first, _ = _once(hashes, owner)
    per_text = np.searchsorted(owner, np.arange(block.texts + 1))
    return [n_words, _totals(is_char, block.bounds), _totals(_SYMBOLS[block.data], block.bounds), np.diff(per_text),
            _totals(~first, per_text), _totals(np.cumsum(change[:-1]) > 0, words.first)]


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for a binomial X, summed exactly."""
    if k >= n:
        return 1.0
    i = np.arange(k)
    logs = n * np.log1p(-p) + np.concatenate([[0.0], np.cumsum(np.log((n - i) / (i + 1)) + np.log(p) - np.log1p(-p))])
    top = logs.max()
    return float(min(1.0, np.exp(top) * np.exp(logs - top).sum()))


def choose_cutoff(places, good, bad, risk: float, level: float) -> int | None:
    """The grid place to reject from; None to reject nothing.

    ``good`` and ``bad`` count labelled documents at each of ``places``. Of the
    places that pass the test, the one with the best balance is taken, the
    loosest of equals.
    """
    total_good, beyond_good, beyond_bad = int(sum(good)), 0, 0
    best, gain = None, 0
    for place, g, b in sorted(zip(places, good, bad), reverse=True):
        beyond_good, beyond_bad = beyond_good + int(g), beyond_bad + int(b)
        if at_most(beyond_good, total_good, risk) > level:
            break
        if beyond_bad - WORTH * beyond_good > gain:
            best, gain = int(place), beyond_bad - WORTH * beyond_good
    return best


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def fit_cutoffs(measures: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(stratum, rule, cutoff) for the rules that may reject in a stratum.

    ``measures`` need the text's hashes. All labelled documents that pass the
    base rules take part; a document is good when a label row of it says
    quality 1, bad when one says 0 and none says 1. Null ids and null
    qualities are no labels. A doc_id with several texts stands for the one of
    the smallest hash; a text of several documents counts once in a stratum,
    good when one of them is.
    """
    rules = _rules()
    truth = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), place.alias("place")) for name, place in rules.items()])
    once = measures.where(~base_failed()).select(
        "doc_id", F.struct("key_a", "key_b", "stratum", pairs.alias("rules")).alias("m")).join(truth, "doc_id").groupBy(
        "doc_id").agg(F.min("m").alias("m"), F.max("quality").alias("quality"))
    texts = once.groupBy("m.stratum", "m.key_a", "m.key_b").agg(
        F.max(F.col("quality") == 1).alias("good"), F.min("m.rules").alias("rules"))
    histogram = stage(texts.select("stratum", "good", F.explode("rules").alias("r")).groupBy(
        "stratum", "r.rule", "r.place").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")), "histogram")
    strata = max(1, histogram.select("stratum").distinct().count())
    share, chance = risk / len(rules), level / (len(rules) * strata)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        cutoff = choose_cutoff(group["place"], group["good"], group["bad"], share, chance)
        rows = [] if cutoff is None else [(group["stratum"].iloc[0], group["rule"].iloc[0], cutoff)]
        return pd.DataFrame(rows, columns=["stratum", "rule", "cutoff"])

    return histogram.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cutoff int")


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """One row per document row: doc_id, the counts, base_failed, rejected_by, kept.

    ``docs`` needs doc_id, text and lang. Null texts have no words and fail
    the base rules. Without labels only the base rules reject. Repeated rows
    get one row each; other columns are not looked at.
    """
    measures = stage(_measured(docs), "measures")
    cutoffs = stage(fit_cutoffs(measures, labels, risk, level).groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")), "cutoffs")
    if cutoffs.count() <= BROADCAST_STRATA:
        placed = measures.join(F.broadcast(cutoffs), "stratum", "left")
    else:
        placed = lookup(measures, cutoffs, ["stratum"])
    beyond = [F.when(place >= F.try_element_at("cutoffs", F.lit(name)), F.lit(name)) for name, place in _rules().items()]
    failed = base_failed()
    return placed.withColumn("rejected_by", F.array_compact(F.array(*beyond))).select(
        "doc_id", *_MEASURES, failed.alias("base_failed"), "rejected_by",
        (~failed & (F.size("rejected_by") == 0)).alias("kept"))
