"""Benchmark decontamination by winnowing, with Spark expressions only.

Of the hashes of all 5-word grams, each run of six keeps its least one, in
documents and in benchmark items alike. Any ten words in a row hold six grams,
so a passage of ten or more shared words shares a kept hash. Documents and
items are joined on kept hashes; each hit is extended to the left and right,
word by word, and counts when it reaches ten words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.expressions import common_head, let, up_to
from tablework.llm.tables import key_columns, stage

WINDOW, GRAM = 10, 5
RUN = WINDOW - GRAM + 1
BROADCAST_ROWS = 200_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEY = ("key_a", "key_b")


def words_of(text: Column) -> Column:
    """Words of digits, letters a-z and characters beyond ASCII, after lower-casing A-Z; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _BETWEEN_WORDS), "")


def _grams(hashes: Column, size: int) -> Column:
    return F.transform(up_to(F.size(hashes) - (size - 1)),
                       lambda i: F.xxhash64(F.lit(size), *[F.get(hashes, i + k) for k in range(size)]))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _kept(grams: Column) -> Column:
    """The least hash of every run of ``RUN`` grams."""
    return F.transform(up_to(F.size(grams) - (RUN - 1)), lambda i: F.array_min(F.slice(grams, i + 1, RUN)))


def _places(words: Column, grams: Column, wanted: Column, size: int) -> Column:
    """Where grams of one size are among the wanted, with the words that a hit can be extended over."""
    def place(p):
        return F.struct(
            p.alias("at"), F.get(grams, p).alias("gram"), F.lit(size).alias("size"),
            F.reverse(F.slice(words, F.greatest(p - RUN + 1, F.lit(0)) + 1, F.least(F.lit(RUN - 1), p))).alias("left"),
            F.slice(words, p + 1, size).alias("middle"), F.slice(words, p + size + 1, RUN - 1).alias("right"))

    hits = F.filter(up_to(F.size(grams)), lambda i: F.array_contains(wanted, F.get(grams, i)))
    return F.transform(hits, place)


def _all_places(words: Column, wanted: Callable[[Column, int], Column], sizes: list[int]) -> Column:
    def of_size(words: Column, hashes: Column, size: int) -> Column:
        return let(_grams(hashes, size), lambda g: let(wanted(g, size), lambda x: _places(words, g, x, size)))

    return let(words, lambda w: let(_hashes(w), lambda h: F.concat(*[of_size(w, h, size) for size in sizes])))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a staged table only when it is known to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items, contaminated.

    An item's windows are its runs of ten words; an item of fewer words, but
    not none, is one window. A document word inside an occurrence of a window
    is hit. ``items`` lists the item_ids with occurring windows, sorted as
    strings. Null and empty texts have no words. Items with a null id hit
    words but are not listed; items may repeat. Repeated document rows get one
    row each, a null doc_id is kept, and other columns are not looked at.
    """
    return _judged(docs, benchmark).select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                                           "items", (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, of which no word is hit (see ``find_contamination``)."""
    hit = _judged(docs, benchmark).where("n_hit > 0").select(*_KEY).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key_columns("doc_id", "text"))
    return rows.join(hit, list(_KEY), "left_anti").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, key_a, key_b, n_words, n_hit, items for every document row."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words"))
    short = [r[0] for r in items.where(F.size("words").between(1, WINDOW - 1)).select(
        F.size("words")).distinct().collect()]  # nine values at most
    n = F.size("words")

    def selected(grams: Column, size: int) -> Column:
        whole = F.when(n == size, grams) if size in short else F.lit(None)
        if size != GRAM:
            return F.coalesce(whole, F.array().cast("array<bigint>"))
        return F.coalesce(whole, _kept(grams))

    sizes = sorted({GRAM, *short})
    index = stage(items.where(n > 0).select("item_id", F.least(n, F.lit(WINDOW)).alias("need"), F.explode(
        _all_places(F.col("words"), selected, sizes)).alias("i")).select("item_id", "need", "i.*").distinct(), "index")
    listed = _small(stage(index.select("gram").distinct(), "grams"))

    def fingerprints(h: Column) -> Column:
        return F.array_distinct(F.concat(let(_grams(h, GRAM), _kept), *[_grams(h, s) for s in short]))

    words = docs.select("doc_id", *key_columns("doc_id", "text"), words_of(F.col("text")).alias("words"))
    printed = words.select("doc_id", *_KEY, F.size("words").cast("bigint").alias("n_words"), F.posexplode_outer(
        let(_hashes(F.col("words")), fingerprints)).alias("i", "gram"))
    # A document's fingerprints are in one task: they are gathered before anything moves.
    rows = stage(printed.join(listed.withColumn("listed", F.col("gram")), "gram", "left").groupBy(
        "doc_id", *_KEY, "n_words").agg(
        F.count_if(F.coalesce(F.col("i"), F.lit(0)) == 0).alias("copies"),
        F.collect_set("listed").alias("grams")), "prints")

    hit = rows.where(F.size("grams") > 0).select(*_KEY, "grams")
    spans = _spans(docs.select(*key_columns("doc_id", "text"), "text").join(hit, list(_KEY)), index, sizes)
    found = spans.groupBy(*_KEY).agg(F.collect_set(F.col("item_id").cast("string")).alias("items"),
                                     F.collect_set(F.struct("start", "stop")).alias("spans"))
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["stop"] - 1))))
    none = F.array().cast("array<string>")
    return rows.drop("grams").join(found, list(_KEY), "left").select(
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"), "doc_id", *_KEY, "n_words",
        F.coalesce(F.size(covered), F.lit(0)).cast("bigint").alias("n_hit"),
        F.array_sort(F.coalesce("items", none)).alias("items")).drop("copy")


def _spans(docs: DataFrame, index: DataFrame, sizes: list[int]) -> DataFrame:
    """Runs of document words that are also in an item, long enough to be windows."""
    places = docs.select(*_KEY, F.explode(
        _all_places(words_of(F.col("text")), lambda *_: F.col("grams"), sizes)).alias("d"))
    hits = places.select(*_KEY, "d.*").alias("d").join(
        _small(index).alias("b"), (F.col("d.gram") == F.col("b.gram")) & (F.col("d.size") == F.col("b.size"))
        & (F.col("d.middle") == F.col("b.middle")))
    left, right = (common_head(F.col(f"d.{side}"), F.col(f"b.{side}"), RUN - 1) for side in ("left", "right"))
    return hits.select(*_KEY, "item_id", "need", (F.col("d.at") - left).alias("start"),
                       (F.col("d.at") + F.col("d.size") + right).alias("stop")).where(
        F.col("stop") - F.col("start") >= F.col("need")).distinct()
