"""The operators on odd rows, against brute force and round trips; every query with SQL against it."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle import connect, differences
from tablework.llm import queries
from tablework.llm.chat_format import format_conversations, loss_text, read_turns
from tablework.llm.components import components
from tablework.llm.decontaminate import drop_contaminated, find_contamination
from tablework.llm.html_layout import render
from tablework.llm.html_text import extract_text
from tablework.llm.huffman import BLOCK_IDS, Code, code_lengths
from tablework.llm.jaccard_join import keep_one_each, near_duplicates
from tablework.llm.language_id import fit, identify
from tablework.llm.lattice import Lattice, pieces
from tablework.llm.line_dedup import deduplicate_lines
from tablework.llm.quality_rules import at_most, choose_cutoff, judge, text_measures
from tablework.llm.subword_samples import decode_samples, encode_samples
from tablework.llm.substring_dedup import remove_repeated_passages
from tablework.llm.token_files import read_token_files, write_token_files

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, key_a string, row string"
PASSAGE = " ".join(f"w{i}" for i in range(60))
COPY = "\n".join(f"line {i} of a text that somebody copied word for word" for i in range(30))
TEXTS = [(1, PASSAGE), (2, "a b " + PASSAGE + " c"), (3, None), (4, ""), (5, " \t\n "), (6, COPY), (7, COPY),
         (7, COPY), (8, COPY + "\none line more"), (9, "é" * 30_000), (10, "z " * 20_000), (11, "Ünï ▁   \x00 日本 🙂"),
         (None, "x y z"), (None, None), (12, "x Y z"), (13, "k" * 9 + " short"), (13, "another text of the same id")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i and i % 2 else None, "s", 0, "clash", "clash", "clash") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert differences(queries.queries()[name](spark, sf_dir), connect(sf_dir), queries.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["op1_decontaminate", "op2_substring_dedup", "op8_line_dedup", "op10_jaccard_join"])
def test_odd_rows_equal_the_sql(spark, docs, tmp_path, name):
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE), (2, "X y Z"), (3, None), (4, ""), (2, "x y z"), (5, "k" * 9)],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = connect("/nowhere")
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    df = queries.queries()[name](spark, str(tmp_path))
    if name == "op8_line_dedup":  # rows of equal id and text count as one document there
        once = con.sql(queries.oracle_sql()[name]).fetchall()
        assert len(df.collect()) == len(once)
    else:
        assert differences(df, con, queries.oracle_sql()[name]) == []


def test_no_rows(spark, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (remove_repeated_passages(none), near_duplicates(none), keep_one_each(none), deduplicate_lines(none),
               find_contamination(none, bench), drop_contaminated(none, bench), judge(none, labels),
               identify(none, fit(none)), encode_samples(none, MODEL), decode_samples(encode_samples(none, MODEL), MODEL)):
        assert df.collect() == []


def test_extra_columns_stay(docs, spark):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in TEXTS} - {1, 2}
    once = keep_one_each(docs)
    assert once.columns == docs.columns
    assert collections.Counter(r.doc_id for r in once.collect() if r.doc_id in (1, 2, 6, 7, 8, 13)) == {1: 1, 6: 1, 13: 2}
    assert {r.doc_id for r in once.collect()} >= {1, 6, 13} and 7 not in {r.doc_id for r in once.collect()}
    lines = deduplicate_lines(docs)
    assert lines.columns == [*docs.columns, "n_chunks", "n_removed"]
    kept = {(r.doc_id, r.text) for r in lines.collect()}
    assert (6, COPY) in kept and (7, COPY) not in kept and (3, None) in kept


def test_components_of_a_long_path(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(60)] + [("x", "x"), ("y", "z"), ("z", "y")]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {found[f"{i:03}"] for i in range(61)} == {"000"} and found["z"] == "y"


def test_conversations_come_back(spark):
    turns = [(1, 0, "user", "<|im_end|>\n\\"), (1, 1, "user", "<|im_part|>\\<|"), (1, 2, "assistant", "a\\|b"),
             (1, 3, "assistant", ""), (2, 0, "as\n<|x", None), (2, 0, "as\n<|x", None), (None, None, None, None)]
    df = format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    found = {r.conv_id: (r.turns, r.loss) for r in df.select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [tuple(t) for t in found[1][0]] == [t[2:] for t in turns[:4]] and found[1][1] == "a\\|b"
    assert [tuple(t) for t in found[2][0]] == [("as\n<|x", "")] * 2 and found[2][1] == ""
    assert [tuple(t) for t in found[None][0]] == [("", "")]


def measures(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(windows)
    again = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines),
            len(lines) - len(set(lines)), len(again))


def test_measures_equal_brute_force(docs):
    found = collections.Counter(tuple(r)[:1] + tuple(r)[2:] for r in text_measures(docs).collect())
    assert found == collections.Counter((i, *measures(t)) for i, t in TEXTS)


def test_cutoffs_keep_their_promise():
    exact = sum(math.comb(50, i) * 0.1 ** i * 0.9 ** (50 - i) for i in range(4))
    assert math.isclose(at_most(3, 50, 0.1), exact) and at_most(50, 50, 0.1) == 1
    assert choose_cutoff([0, 5, 9], [5000, 2, 0], [0, 400, 300], 0.01, 0.001) == 5
    assert choose_cutoff([0, 9], [100, 0], [0, 300], 0.01, 0.001) is None  # too few to prove anything


def test_languages_are_told_apart(spark, sf_dir):
    df = queries.queries()["op7_language_id"](spark, sf_dir)
    lang = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    right = df.where("held_out").join(lang, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_huffman_round_trip():
    random = np.random.default_rng(1)
    ids = (random.pareto(0.7, 20_000) * 3).astype(np.int64) % 5000
    lengths = code_lengths(np.bincount(ids, minlength=5000))
    assert lengths.max() <= 16 and math.isclose(sum(2.0 ** -int(n) for n in lengths if n), 1.0)
    first = np.array([0, 0, 1, BLOCK_IDS, 3 * BLOCK_IDS + 1, len(ids)])
    code = Code(lengths)
    payloads, offsets = code.encode(ids, first)
    assert (code.decode(payloads, offsets, np.diff(first)) == ids).all()


def test_token_files_equal_whole_texts(spark, docs, tmp_path):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(TOKENIZER)
    whole.encode_special_tokens = True
    write_token_files(docs, TOKENIZER, f"file:{tmp_path}/t")
    rows = sorted(read_token_files(spark, f"file:{tmp_path}/t").collect(), key=lambda r: r.start)
    expected = collections.Counter(
        (i, zlib.crc32(np.array(whole.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()))
        for i, t in TEXTS)
    assert collections.Counter((r.doc_id, zlib.crc32(r.ids)) for r in rows) == expected
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_special_tokens_are_encoded_as_the_file_says(spark, tmp_path):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(TOKENIZER)
    texts = ["the end <|endoftext|> here", "<|endoftext|>", "glued<|endoftext|>to words", "<|startoftext|>x <|endoftext|>",
             "a <|endoftext|><|endoftext|>\n\n<|startoftext|> b", "<|endoftext |> <| endoftext|> <|ENDOFTEXT|>"]
    write_token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), TOKENIZER, f"file:{tmp_path}/t")
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in read_token_files(spark, f"file:{tmp_path}/t").collect()}
    assert found == {i: whole.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    assert found[0] == [518, 806, 49407, 763, 1]


def test_samples_decode_to_their_texts(docs):
    rows = decode_samples(encode_samples(docs, MODEL, 3), MODEL).collect()
    texts = collections.defaultdict(set)
    for i, t in TEXTS:
        texts[i].add(t or "")
    assert all(r.text in texts[r.doc_id] for r in rows)
    assert {i for i, _ in TEXTS} == {r.doc_id for r in rows}
    assert len({(r.doc_id, r.text, r.ids) for r in rows if r.doc_id == 12}) == 3


def test_samples_follow_the_lattice():
    vocabulary = pieces(MODEL)
    data = np.frombuffer(b" the", np.uint8)
    lattice = Lattice.build(vocabulary, data, np.array([0]), np.array([4]))
    n = 20_000
    edges, first = lattice.draw(np.zeros(n, np.int64), np.full(n, 4), np.arange(n, dtype=np.uint64) * np.uint64(977))
    seen = collections.Counter(tuple(edges[a:b]) for a, b in zip(first[:-1], first[1:]))
    for path, count in seen.items():
        chance = float(np.prod(lattice.share[list(path)]))
        assert abs(count / n - chance) < 5 * math.sqrt(chance / n) + 1e-3


def test_pages(spark):
    assert render("<p>a<p>b <b>c</b>d<ul><li>x<li>y</ul>") == "a\n\nb cd\n\n- x\n- y"
    assert render("<table><tr><th>Name<th>Qty<tr><td>kiwi fruit<td>12</table>t") == "Name        Qty\nkiwi fruit  12\n\nt"
    assert render("<head><title>t</title></head><div hidden>no</div><script>x</script>a &amp; b<!-- c") == "a & b"
    assert render("<pre> a\n  b</pre><ol start=3><li>x</ol>") == " a\n  b\n\n3. x"
    rows = [(1, None, "u"), (2, "", "u"), (3, "<" * 50 + "x", "u"), (3, "<b>y", "u"), (None, "</p></td></table>z", "u")]
    found = extract_text(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert [r.text for r in found] == [None, "", "<" * 49, "y", "z"]  # a tag that never ends is no text


def test_the_pipeline_keeps_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontaminate",
                                                      "subword_samples"]
    kept = corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct()
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids) > 0.8 * docs.count()
    hit = {r.doc_id for r in find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").collect()}
    assert not ids & hit
