"""The quality rules end to end against brute force, on repeated rows, copies, ties and odd labels."""

import collections
import math

import pytest

from tablework.llm.quality_rules import BINS, LEVEL, RISK, WORTH, judge

DOCS = "doc_id long, text string, lang string, rejected_by string, key_a string, quality int"
RULES = ("symbols", "dup_lines", "repeats", "long_words", "short_words")


def text(i, symbols):
    return " ".join([f"word{chr(97 + i % 26)}{i}x{k}" for k in range(20)] + ["##"] * symbols)


def corpus(good, bad, lang="en", start=0):
    """Good texts hold no symbols, bad ones many."""
    docs = [(start + i, text(start + i, 0 if i < good else 4), lang) for i in range(good + bad)]
    return docs, [(d[0], int(i < good), 0) for i, d in enumerate(docs)]


def places(row):
    words, lines = max(row.n_words, 1), max(row.n_lines, 1)
    length = row.word_chars / words
    raw = (row.n_symbols / words * 50, row.n_dup_lines / lines * 50, row.n_repeat_words / words * 50, length * 4,
           max(0, 20 - length) * 4)
    return {name: min(math.floor(value), BINS) for name, value in zip(RULES, raw)}


def by_hand(rows, docs, labels):
    """(doc_id, kept) of every row: a binomial test of each cutoff on distinct texts."""
    truth = {}
    for i, quality, _ in labels:
        if i is not None and quality is not None:
            truth[i] = max(truth.get(i, 0), quality)
    content = {i: (lang or "", t) for i, t, lang in docs}  # the tests give each id one text
    seen = {}
    for row in rows:
        if row.doc_id in truth and not row.base_failed:
            key = content[row.doc_id]
            seen[key] = (max(seen.get(key, (0,))[0], truth[row.doc_id]), places(row))
    strata = {key[0] for key in seen}
    cutoffs = {}
    for stratum in strata:
        mine = [v for k, v in seen.items() if k[0] == stratum]
        n = sum(good for good, _ in mine)
        for rule in RULES:
            gain = 0
            for place in sorted({p[rule] for _, p in mine}, reverse=True):
                lost = sum(good for good, p in mine if p[rule] >= place)
                won = sum(not good for good, p in mine if p[rule] >= place)
                risk = RISK / len(RULES)
                chance = 1.0 if lost >= n else sum(math.comb(n, k) * risk ** k * (1 - risk) ** (n - k) for k in range(lost + 1))
                if chance > LEVEL / (len(RULES) * len(strata)):
                    break
                if won - WORTH * lost > gain:
                    gain, cutoffs[stratum, rule] = won - WORTH * lost, place
    return collections.Counter((r.doc_id, not r.base_failed and not any(
        p >= cutoffs.get((content[r.doc_id][0], rule), math.inf) for rule, p in places(r).items())) for r in rows), cutoffs


def judged(spark, docs, labels):
    df = spark.createDataFrame([(*d, "clash", "clash", 7) for d in docs], DOCS).repartition(3)
    return judge(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()


def test_kept_equals_brute_force(spark):
    docs, labels = corpus(700, 60)
    more, few = corpus(40, 30, "fr", 5000)
    odd = [(9000, None, "en"), (9001, "", None), (9002, text(1, 4), None), (None, text(3, 0), "en")]
    labels = labels + few + [(5, 0, 0), (5, None, 0), (None, 1, 0), (9000, 1, 0), (77777, 1, 0)]
    rows = judged(spark, docs + more + odd, labels)
    expected, cutoffs = by_hand(rows, docs + more + odd, labels)
    assert ("en", "symbols") in cutoffs and not any(s == "fr" for s, _ in cutoffs)
    assert collections.Counter((r.doc_id, r.kept) for r in rows) == expected
    assert {r.kept for r in rows if r.doc_id is not None and 700 <= r.doc_id < 760} == {False}


@pytest.mark.parametrize("how", ["rows", "ids"])
def test_copies_are_no_evidence(spark, how):
    docs, labels = corpus(300, 100)
    good, judged_good = docs[:300], labels[:300]
    if how == "rows":
        docs, labels = docs + good * 3, labels + judged_good
    else:
        for n in (1, 2, 3):
            docs, labels = docs + [(i + 10_000 * n, t, g) for i, t, g in good], labels + [(i + 10_000 * n, q, x) for i, q, x in judged_good]
    rows = judged(spark, docs, labels)
    assert len(rows) == len(docs) and all(r.kept and not r.rejected_by for r in rows)
