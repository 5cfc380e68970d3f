"""Runs of lines that stand twice, against brute force and with planted copies."""

import corpus_pipeline
from tablework.llm.line_dedup import remove_repeated_runs

SCHEMA = "doc_id long, text string, n_chars long"


def line(i):
    return " ".join(f"word{i}x{k}" for k in range(20))


def brute_force(texts):
    """What stays of each text; the ids ascend."""
    first, out = {}, []
    for d, text in enumerate(texts):
        lines = (text or "").split("\n")
        filled = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for a, b in zip(filled, filled[1:]):
            at, end = first.setdefault("\n".join(lines[a:b + 1]), ((d, a), b))
            if at != (d, a) and (at[0] != d or a > end):
                gone.update(range(a, b + 1))
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
    return out


def rows_of(texts):
    return [(i, t, len(t or "")) for i, t in enumerate(texts)]


def stage_of(spark, texts):
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)
    return {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}


def test_a_short_passage_goes_wherever_it_stands(spark):
    passage = [line(i) for i in range(3)]
    texts = ["\n".join([*(line(1000 * d + k) for k in range(1, d % 4 + 2)), *passage,
                        *(line(1000 * d + k) for k in range(10, 12 + d % 3))]) for d in range(1, 41)]
    found = stage_of(spark, texts)
    assert found[0] == (texts[0], len(texts[0]))
    for d, text in enumerate(texts[1:], 1):
        rest = "\n".join(x for x in text.split("\n") if x not in passage)
        assert found[d] == (rest, len(rest))


def test_runs_equal_brute_force(spark):
    texts = ["a\nb\nc", "x\nb\nc\ny", "a\nb", None, "", "\n \n", "one line", "one line", "b", "q\nq\nq\nq\nq", "a\n\nb",
             "z\na\n\nb\n\nz", "a\r\nb\r\nc", "k\na\r\nb\r", "r\ns\nt\nr\ns\nt\nr", "c\nq\nq\nq", "é\n日本\n🙂", "é\n日本"]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)
    found = {r.doc_id: r.text for r in remove_repeated_runs(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_force(texts)
    assert remove_repeated_runs(docs).columns == ["doc_id", "text", "n_chars", "n_removed"]


def test_exact_copies_go_whole_and_near_copies_keep_what_is_new(spark):
    # 2 to 9 lines, with blank ones between and around; most of them too short to be told by chunk ends.
    texts = ["\n".join(line(100 * d + k) + "\n" * (k % 3 == 2) for k in range(2 + d % 8)) + "\n" * (d % 2) for d in range(1, 41)]
    near = [t.replace(line(100 * d + 1), f"new {d} " + line(100 * d + 1)) for d, t in enumerate(texts, 1)]
    found = stage_of(spark, [*texts, *texts, *near])
    assert {i: found[i][0] for i in range(40)} == dict(enumerate(texts))
    assert not found.keys() & set(range(40, 80))
    for d in range(1, 41):
        kept = set(filter(None, found[79 + d][0].split("\n")))
        n = 2 + d % 8  # line 0, and line 2 where it is the last, stand alone beside the new line
        alone = {line(100 * d)} | ({line(100 * d + 2)} if n == 3 else set())
        assert kept == {f"new {d} " + line(100 * d + 1)} | alone
