"""Language identification in two steps: the family, then the language within it.

Texts become frequencies of hashed byte trigrams. One-versus-rest linear
support vector machines choose the family; within it, one machine for every
two languages votes for one of them. All machines are fitted in tasks, on a
bounded sample of labelled documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.hashing import block_of, cut
from tablework.llm.tables import key_columns, stage

#: So many distinct texts of each language are fitted on, those of the smallest hash.
SAMPLE_PER_LANGUAGE = 400
#: The machines of families learn from at most so many texts in all, or one of each language.
SAMPLE_FOR_FAMILIES = 8_000
MAX_LANGUAGES = 500
#: A document whose family and language are both nearly a tie scores less.
MIN_SCORE = 0.3
UNKNOWN = "und"
DIMENSIONS = 4096
_BATCH_BYTES, _BATCH_TEXTS = 2 << 20, 256

#: Language families by ISO 639-1 code. A code that is not listed is its own family.
FAMILIES = {
    "germanic": "en de nl af fy lb sv da no nb nn is fo yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be bg mk sr hr bs sl cs sk pl",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "indic": "hi bn pa gu mr ne si ur",
    "iranian": "fa ps ku tg",
    "dravidian": "ta te kn ml",
    "turkic": "tr az kk ky uz tk",
    "uralic": "fi et hu",
    "semitic": "ar he mt am",
    "austronesian": "id ms tl jv",
}


def family_of(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang in codes.split()), f"only {lang}")


def trigram_frequencies(texts) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams, one row per text; all zero without letters.

    A-Z count as a-z, other ASCII as a blank, and trigrams of blanks in a row
    are left out, so that layout and digits do not matter.
    """
    block = block_of(texts)
    data = block.data + ((block.data >= 65) & (block.data <= 90)) * np.uint8(32)
    data = np.where(((data >= 97) & (data <= 122)) | (data >= 128), data, np.uint8(32))
    out = np.zeros((block.texts, DIMENSIONS))
    if len(data) < 3:
        return out
    wide = data.astype(np.uint32)
    code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    blank = data == 32
    use = ~((blank[:-2] & blank[1:-1]) | (blank[1:-1] & blank[2:]))
    owner = np.repeat(np.arange(block.texts, dtype=np.uint32), np.diff(block.bounds))
    use &= owner[:-2] == owner[2:]
    slot = (code[use] * np.uint32(2654435761)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
    counts = np.bincount(owner[:-2][use].astype(np.int64) * DIMENSIONS + slot, minlength=block.texts * DIMENSIONS)
    counts = counts.reshape(block.texts, DIMENSIONS)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def fit_svm(x: np.ndarray, positive: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss, by dual coordinate descent.

    The last column of ``x`` is 1; its weight is the offset.
    """
    y = np.where(positive, 1.0, -1.0)
    # Rare classes count as much as common ones.
    upper = cost * len(y) / 2 / np.where(positive, max(positive.sum(), 1), max((~positive).sum(), 1))
    slack = 0.5 / upper
    curve = np.einsum("ij,ij->i", x, x) + slack
    w, alpha, random = np.zeros(x.shape[1]), np.zeros(len(y)), np.random.default_rng(0)
    for _ in range(rounds):
        for i in random.permutation(len(y)):
            slope = y[i] * (w @ x[i]) - 1 + slack[i] * alpha[i]
            new = max(alpha[i] - slope / curve[i], 0.0)
            w += (new - alpha[i]) * y[i] * x[i]
            alpha[i] = new
    return w


def _trust(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(2 * margin, -60, 60)))


@dataclass
class Rest:
    """One-versus-rest machines over ``names``; a single name needs none."""

    names: list[str]
    weights: np.ndarray | None

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen index, and a score from 0.5 to 1 that grows with the lead over the next."""
        if self.weights is None:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        margins = x @ self.weights[:-1] + self.weights[-1]
        order = np.sort(margins, axis=1)
        return margins.argmax(axis=1), _trust(order[:, -1] - order[:, -2])


@dataclass
class Duels:
    """One-versus-one machines: column k of ``weights`` is positive for the first name of ``pairs[k]``."""

    names: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray | None

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index with most votes and the mean trust of its own duels, from 0 to 1.

        Equal votes go to the larger sum of margins, then to the smaller name.
        """
        if self.weights is None:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        margins = x @ self.weights[:-1] + self.weights[-1]
        votes, sums, trust = (np.zeros((len(x), len(self.names))) for _ in range(3))
        for (i, j), margin in zip(self.pairs, margins.T):
            votes[:, i] += margin > 0
            votes[:, j] += margin <= 0
            sums[:, i] += margin
            sums[:, j] -= margin
            trust[:, i] += _trust(margin)
            trust[:, j] += _trust(-margin)
        best = np.where(votes == votes.max(axis=1, keepdims=True), sums, -np.inf).argmax(axis=1)
        return best, trust[np.arange(len(x)), best] / (len(self.names) - 1)


@dataclass
class Hierarchy:
    families: Rest
    members: list[Duels]

    @classmethod
    def of(cls, langs: list[str], machine) -> Hierarchy:
        """The model over ``langs``; ``machine(kind, name)`` gives the weights of one fitted machine."""
        names = sorted({family_of(lang) for lang in langs})
        top = np.stack([machine("family", f) for f in names], axis=1) if len(names) > 1 else None
        members = []
        for family in names:
            inside = sorted(lang for lang in langs if family_of(lang) == family)
            pairs = [(i, j) for i in range(len(inside)) for j in range(i + 1, len(inside))]
            members.append(Duels(inside, pairs, np.stack(
                [machine("duel", _duel(inside[i], inside[j])) for i, j in pairs], axis=1) if pairs else None))
        return cls(Rest(names, top), members)

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        family, score = self.families(x)
        names = np.empty(len(x), object)
        for f, choice in enumerate(self.members):
            rows = np.flatnonzero(family == f)
            lang, share = choice(x[rows])
            names[rows] = np.array(choice.names, object)[lang]
            score[rows] *= share
        return names, score


def _duel(a: str, b: str) -> str:
    """One name for two languages, a < b; the length keeps names apart whatever characters they hold."""
    return f"{len(a)} {a} {b}"


def _parts_in(langs: list[str]) -> list[tuple[str, str, str, bool, int]]:
    """(lang, kind, name, positive, most): the machines that learn from a language, and from how many of its texts."""
    families = sorted({family_of(lang) for lang in langs})
    few = max(1, SAMPLE_FOR_FAMILIES // len(langs))
    out = [(lang, "family", f, family_of(lang) == f, few) for lang in langs for f in families if len(families) > 1]
    for a in langs:
        for b in langs:
            if a < b and family_of(a) == family_of(b):
                out += [(a, "duel", _duel(a, b), True, 1 << 30), (b, "duel", _duel(a, b), False, 1 << 30)]
    return out


def _blocks(batch):
    for table in cut(pa.Table.from_batches([batch]), "text", _BATCH_BYTES):
        for begin in range(0, len(table), _BATCH_TEXTS):
            yield table.slice(begin, _BATCH_TEXTS)


def held_out() -> Column:
    """A quarter of the documents, by id, kept from fitting; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def learning_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame | None:
    """(lang, place, text): the ``per_language`` distinct texts of each language with the smallest hashes.

    Copies of a text count once and the order of rows does not matter. Texts
    without letters and null languages take no part; None when nothing is left.
    An estimate of the distinct texts first leaves some four times as many as
    are wanted, so that few texts move.
    """
    known = docs.where("lang is not null").where(F.regexp_like("text", F.lit(r"\p{L}"))).select(
        F.col("lang").cast("string").alias("lang"), "text", *key_columns("text"))
    sizes = {r["lang"]: r["texts"] for r in known.groupBy("lang").agg(
        F.approx_count_distinct("key_a").alias("texts")).limit(MAX_LANGUAGES + 1).collect()}
    if not sizes:
        return None
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang; learn from fewer")
    scale = 1 << 40
    shares = F.create_map(*[F.lit(v) for lang, n in sorted(sizes.items())
                            for v in (lang, int(min(1, 4 * per_language / max(n, 1)) * scale))])
    draw = F.pmod("key_a", F.lit(scale))
    first = Window.partitionBy("lang").orderBy(draw, "key_a", "key_b")
    return known.where(draw < F.element_at(shares, F.col("lang"))).dropDuplicates(["lang", "key_a", "key_b"]).withColumn(
        "place", F.row_number().over(first)).where(F.col("place") <= per_language).select("lang", "place", "text")


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Hierarchy | None:
    """Learn from ``docs(text, lang)``; None when no document has both a language and letters.

    Every machine is fitted in a task of its own on ``learning_sample``. The
    driver gets their weights: one machine per family, and one for every two
    languages of a family.
    """
    sample = learning_sample(docs, per_language)
    if sample is None:
        return None

    def describe(batches):
        for batch in batches:
            for table in _blocks(batch):
                rows = trigram_frequencies(table.column("text")).astype(np.float32)
                slots = [np.flatnonzero(r) for r in rows]
                yield pa.record_batch([
                    table.column("lang").combine_chunks(), table.column("place").combine_chunks(),
                    pa.array([s.astype("<u2").tobytes() for s in slots], pa.binary()),
                    pa.array([r[s].tobytes() for r, s in zip(rows, slots)], pa.binary())],
                    names=["lang", "place", "slots", "shares"])

    described = stage(sample.mapInArrow(describe, "lang string, place int, slots binary, shares binary"), "trigrams")
    langs = sorted(r["lang"] for r in described.select("lang").distinct().collect())  # at most MAX_LANGUAGES

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "place"])
        x = np.zeros((len(rows), DIMENSIONS + 1), np.float32)
        x[:, -1] = 1
        for row, slots, shares in zip(x, rows["slots"], rows["shares"]):
            row[np.frombuffer(slots, "<u2")] = np.frombuffer(shares, np.float32)
        weights = fit_svm(x, rows["positive"].to_numpy())
        return pd.DataFrame({"kind": rows["kind"].iloc[:1], "name": rows["name"].iloc[:1], "weights": [weights.tobytes()]})

    parts = _parts_in(langs)
    found = {}
    if parts:
        roles = docs.sparkSession.createDataFrame(parts, "lang string, kind string, name string, positive boolean, most int")
        fitted = described.join(F.broadcast(roles), "lang").where("place <= most").groupBy("kind", "name").applyInPandas(
            learn, "kind string, name string, weights binary")
        found = {(r["kind"], r["name"]): np.frombuffer(r["weights"]) for r in fitted.collect()}  # one row per machine
    return Hierarchy.of(langs, lambda kind, name: found[kind, name])


def identify(docs: DataFrame, model: Hierarchy | None) -> DataFrame:
    """The documents with all their columns, ``lang_pred`` and ``score``, which replace columns of these names.

    Only the text is looked at. ``und`` with score 0 if it is null or has no
    letter, or nothing was learned.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return _predicted(docs, model).select(*[F.col(f"row.`{c}`").alias(c) for c in kept], "lang_pred", "score")


def _predicted(docs: DataFrame, model: Hierarchy | None) -> DataFrame:
    """row (all columns in one struct), lang_pred and score; each text travels to the workers once."""
    def predict(batches):
        for batch in batches:
            row = batch.column("row")
            texts = row.field(row.type.get_field_index("text"))
            for table in _blocks(batch.append_column("text", texts)):
                n = len(table)
                names, score = (np.full(n, UNKNOWN, object), np.zeros(n))
                rows = np.flatnonzero(table.column("lettered").to_numpy(zero_copy_only=False)) if model else []
                if len(rows):
                    names[rows], score[rows] = model(trigram_frequencies(table.column("text").take(pa.array(rows))))
                yield from pa.table([table.column("row").combine_chunks(), pa.array(names, pa.string()),
                                     pa.array(score)], names=["row", "lang_pred", "score"]).to_batches()

    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(
        F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False)).alias("lettered"))
    return whole.mapInArrow(predict, f"row {whole.schema['row'].dataType.simpleString()}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Hierarchy | None, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, with all their columns, whose language is known with a score of ``min_score`` or more."""
    found = _predicted(docs, model)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
