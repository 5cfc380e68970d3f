"""Language identification: the sample, the vote against brute force, odd labels."""

import collections
import itertools

import numpy as np
from pyspark.sql import functions as F

from tablework.llm.language_id import DIMENSIONS, Duels, family_of, fit, identify, learning_sample

WORDS = {"en": "the house and water with which they could never speak about", "fr": "la maison et une eau avec des mots que nous voulons",
         "de": "das haus und wasser mit dem wir nicht sprechen wollen über", "nl": "het huis en water met wie wij niet willen spreken over",
         "sv": "huset och vatten med vilka vi inte vill tala om när"}


def texts(lang, n, seed=0):
    random = np.random.default_rng(seed)
    return [" ".join(random.choice(WORDS[lang].split(), 12)) + f" {i}" for i in range(n)]


def test_copies_take_no_places_and_no_language_is_lost(spark):
    rows = [(t, lang) for lang in ("en", "fr") for t in texts(lang, 300)]
    copies = [(rows[7][0], "en")] * 20_000
    found = [sorted(tuple(r) for r in learning_sample(spark.createDataFrame(x, "text string, lang string"), 50).collect())
             for x in (copies + rows, rows + copies, rows)]
    assert found[0] == found[1] == found[2]
    assert collections.Counter(r[0] for r in found[0]) == {"en": 50, "fr": 50}
    assert len({r[2] for r in found[0]}) == 100


def test_the_vote_equals_brute_force():
    random = np.random.default_rng(3)
    names = ["a", "b", "c", "d"]
    pairs = list(itertools.combinations(range(4), 2))
    x, weights = random.normal(size=(500, 6)), random.normal(size=(7, 6))
    best, score = Duels(names, pairs, weights)(x)
    for row, found, value in zip(x, best, score):
        margins = {p: float(row @ weights[:-1, k] + weights[-1, k]) for k, p in enumerate(pairs)}
        own = {n: [m if n == i else -m for (i, j), m in margins.items() if n in (i, j)] for n in range(4)}
        assert found == max(own, key=lambda n: (sum(m > 0 for m in own[n]), sum(own[n])))
        assert abs(value - np.mean([1 / (1 + np.exp(-2 * m)) for m in own[found]])) < 1e-9


def test_three_close_languages_meet_in_pairs(spark):
    docs = spark.createDataFrame([(i, t, lang, "clash", "clash") for lang in WORDS for i, t in enumerate(texts(lang, 120))],
                                 "doc_id long, text string, lang string, lang_pred string, key_a string")
    model = fit(docs, 60)
    germanic = model.members[model.families.names.index("germanic")]
    assert germanic.names == ["de", "en", "nl", "sv"] and germanic.weights.shape == (DIMENSIONS + 1, 6)
    found = identify(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "key_a", "lang_pred", "score"]
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    assert found.where("score < 0 or score > 1").count() == 0


def test_one_language_nulls_and_odd_labels(spark):
    rows = [(1, "hello there", "en"), (2, None, "en"), (3, "123", "fr"), (4, "x", None), (5, "", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, fit(docs)).collect()}
    assert found == {1: ("en", 1.0), 2: ("und", 0.0), 3: ("und", 0.0), 4: ("en", 1.0), 5: ("und", 0.0)}
    odd = spark.createDataFrame([(1, "aaa bbb", ""), (2, "ccc ddd", " "), (3, "eee fff", "x y"), (3, "eee fff", "x y")],
                                "doc_id long, text string, lang string")
    assert [r.lang_pred for r in identify(odd, fit(odd)).orderBy("doc_id").collect()] == ["", " ", "x y", "x y"]
    assert family_of("") == "only "
