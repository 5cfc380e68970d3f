"""Removal of multi-line chunks that occur again.

Chunk ends are chosen by content: a rolling hash over the hashes of a line and
the two before it ends a chunk at every fourth line or so. Inserted or removed
lines move the ends next to them only, so equal stretches of two documents
fall into equal chunks soon after their start.

``remove_repeated_runs`` does without chunk ends: it looks at every two
neighbouring lines, so it finds runs that no chunk falls into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.expressions import let, up_to
from tablework.llm.tables import key_columns, stage

LINES, EVERY = 3, 4
_FACTOR = 31
_KEY = ("key_a", "key_b")
_BLANKS = " \t\n\x0b\x0c\r"


def line_hash(line: Column) -> Column:
    """A number of 28 bits."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("bigint")


def chunks_of(text: Column) -> Column:
    """array<string>: the text cut behind the lines where the rolling hash says so; joined by line feeds, the text."""
    def ends(h: Column) -> Column:
        def rolling(i: Column) -> Column:
            terms = [F.coalesce(F.get(h, i - k), F.lit(0)) * (_FACTOR ** (LINES - 1 - k)) for k in range(LINES)]
            # Low bits of the sum hang on few bits of the hashes, so higher ones choose.
            return F.shiftright(sum(terms[1:], terms[0]), 8) % EVERY == 0

        inner = F.filter(up_to(F.size(h) - 1), rolling)
        return F.concat(F.array(F.lit(-1)), inner, F.array(F.size(h) - 1))

    def cut(lines: Column) -> Column:
        return let(F.transform(lines, line_hash), lambda h: let(ends(h), lambda e: F.transform(
            up_to(F.size(e) - 1), lambda i: F.array_join(
                F.slice(lines, F.get(e, i) + 2, F.get(e, i + 1) - F.get(e, i)), "\n"))))

    return let(F.split(F.coalesce(text, F.lit("")), "\n"), cut)


def _multi_line(chunk: Column) -> Column:
    """Two lines or more that hold something besides blanks."""
    return F.contains(F.btrim(chunk, F.lit(_BLANKS)), F.lit("\n"))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(key_a, key_b, gone): the chunk numbers of a document that an earlier place also holds.

    Earlier means a smaller doc_id, then the smaller key, then further up in
    the document; null ids come first. Chunks are found by hash and then
    grouped by their bytes.
    """
    placed = docs.select("doc_id", *key_columns("doc_id", "text"), F.posexplode(
        chunks_of(F.col("text"))).alias("i", "chunk")).where(_multi_line(F.col("chunk")))
    place = F.struct("doc_id", *_KEY, "i")
    mark = [F.xxhash64("chunk").alias("hash"), F.length("chunk").alias("size")]
    often = placed.select(*mark, place.alias("at")).groupBy("hash", "size").agg(
        F.min("at").alias("first"), F.max("at").alias("last")).where("first <> last").select("hash", "size")
    again = stage(placed.select("*", *mark).join(often, ["hash", "size"], "left_semi"), "chunks")
    first = again.groupBy("hash", "chunk").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(
        "first <> last").drop("last")
    later = again.join(first, ["hash", "chunk"]).where(place > F.col("first"))
    return later.groupBy(*_KEY).agg(F.collect_set("i").alias("gone"))


def deduplicate_lines(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, and ``text`` without chunks that occur earlier.

    A chunk of two or more non-blank lines that also stands at an earlier place
    (see ``repeated_chunks``) goes; its first place stays. Columns
    ``n_chunks`` and ``n_removed`` tell how many there were and went; they
    replace columns of these names. Null and empty texts have one chunk, which
    never goes. Rows with equal doc_id and text are one document and get equal
    results.
    """
    gone = repeated_chunks(docs)
    others = [c for c in docs.columns if c not in ("text", "n_chunks", "n_removed")]
    # The documents keep their columns in one struct, clear of the names used here.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text",
                        *key_columns("doc_id", "text"))
    joined = keyed.join(gone, list(_KEY), "left")
    chunks = let(chunks_of(F.col("text")), lambda c: F.struct(
        F.size(c).cast("bigint").alias("n"), F.array_join(F.transform(F.filter(
            up_to(F.size(c)), lambda i: ~F.array_contains(F.col("gone"), i)), lambda i: F.get(c, i)), "\n")
        .alias("text")))
    touched = joined.select("row", "text", "gone", F.when(F.col("gone").isNotNull(), chunks).otherwise(
        F.struct(F.size(chunks_of(F.col("text"))).cast("bigint").alias("n"), F.col("text").alias("text"))).alias("kept"))
    out = {"text": F.col("kept.text"), **{c: F.col(f"row.`{c}`") for c in others}}
    return touched.select(*[out[c].alias(c) for c in docs.columns if c in out], F.col("kept.n").alias("n_chunks"),
                          F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"))


def _line_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, key_a, key_b, begin, end, pair_a, pair_b): every two neighbouring filled lines, with the blank ones between.

    Two 64-bit hashes name the bytes of a pair, as they name documents.
    """
    def pairs(lines: Column) -> Column:
        filled = F.filter(up_to(F.size(lines)), lambda i: F.btrim(F.get(lines, i), F.lit(_BLANKS)) != "")

        def pair(begin: Column, end: Column) -> Column:
            both = F.array_join(F.slice(lines, begin + 1, end - begin + 1), "\n")
            return let(both, lambda x: F.struct(begin.alias("begin"), end.alias("end"), *[
                F.xxhash64(F.lit(salt), x).alias(name) for salt, name in ((1, "pair_a"), (2, "pair_b"))]))

        return let(filled, lambda f: F.transform(up_to(F.size(f) - 1), lambda k: pair(F.get(f, k), F.get(f, k + 1))))

    found = docs.select("doc_id", *key_columns("doc_id", "text"), F.explode(
        let(F.split(F.coalesce("text", F.lit("")), "\n"), pairs)).alias("pair"))
    return found.select("doc_id", *_KEY, "pair.*")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(key_a, key_b, gone): the line numbers of a document that lie in a pair of lines with an earlier place.

    Earlier means as in ``repeated_chunks``. A pair does not repeat another
    one that it overlaps, so its first place is never removed for its sake.
    """
    pairs, mark = stage(_line_pairs(docs), "pairs"), ["pair_a", "pair_b"]
    place = F.struct("doc_id", *_KEY, "begin", "end")
    first = pairs.groupBy(*mark).agg(F.min(place).alias("first"), F.max(place).alias("last")).where(
        "first <> last").drop("last")
    apart = (F.col("key_a") != F.col("first.key_a")) | (F.col("key_b") != F.col("first.key_b")) | (
        F.col("begin") > F.col("first.end"))
    later = pairs.join(first, mark).where((place > F.col("first")) & apart)
    return later.groupBy(*_KEY).agg(F.collect_list(F.sequence("begin", "end")).alias("runs")).select(
        *_KEY, F.array_distinct(F.flatten("runs")).alias("gone"))


def remove_repeated_runs(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, and ``text`` without runs of lines that occur earlier.

    Of every run of two or more filled lines that also stands at an earlier
    place all lines go, and the blank ones between; every line keeps its first
    place. ``n_removed``, the number of lines that went, replaces a column of
    this name. Rows with equal doc_id and text are one document and get equal
    results.
    """
    others = [c for c in docs.columns if c not in ("text", "n_removed")]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text",
                        *key_columns("doc_id", "text"))
    joined = keyed.join(repeated_lines(docs), list(_KEY), "left")
    left = let(F.split("text", "\n"), lambda lines: F.array_join(F.transform(F.array_except(
        up_to(F.size(lines)), F.col("gone")), lambda i: F.get(lines, i)), "\n"))
    out = {"text": F.when(F.col("gone").isNull(), F.col("text")).otherwise(left),
           **{c: F.col(f"row.`{c}`") for c in others}}
    return joined.select(*[out[c].alias(c) for c in docs.columns if c in out],
                         F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("n_removed"))
