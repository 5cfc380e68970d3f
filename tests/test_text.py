import decimal

import pytest
from pyspark.sql import functions as F

from tablework.functions import text


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "s string").select(expression(F.col("s")).alias("x")).first()["x"]


@pytest.mark.parametrize("raw, clean", [
    ("  a b ", "a b"), ("\t x　\n", "x"), ("   ", None), ("", None), (None, None)])
def test_blank_to_null_trims_all_white_space(spark, raw, clean):
    assert one(spark, text.blank_to_null, raw) == clean


def test_inner_white_space_collapses(spark):
    assert one(spark, text.collapse_spaces, "  closed \t\n won ") == "closed won"


@pytest.mark.parametrize("raw, cased", [
    ("CLOSED won", "Closed Won"), ("mary-jane o'NEIL", "Mary-Jane O'neil"), ("a/b.c_d e", "A/B.C_D E"),
    ("3rd PARTY", "3rd Party"), ("x y\tz", "X Y\tZ"), ("-lead", "-Lead"), ("", ""), (None, None)])
def test_initcap_breaks_words_at_punctuation(spark, raw, cased):
    assert one(spark, text.initcap_words, raw) == cased


@pytest.mark.parametrize("raw, amount", [
    ("$17,800.00", "17800"), (" 12.5 ", "12.5"), ("", None), ("abc", None), ("1e3", "1000"), (None, None)])
def test_currency(spark, raw, amount):
    assert one(spark, text.currency_to_numeric, raw) == (None if amount is None else decimal.Decimal(amount))


@pytest.mark.parametrize("raw, day", [
    ("2026-09-03", "2026-09-03"), (" 2026-9-3 ", "2026-09-03"), ("2026-02-30", None), ("soon", None), ("", None)])
def test_dates(spark, raw, day):
    found = one(spark, text.safe_date, raw)
    assert (str(found) if found else None) == day


def test_timestamps_need_the_literal_z(spark):
    assert str(one(spark, lambda c: text.safe_utc_timestamp(c).cast("timestamp_ntz"),
                   "2026-10-01T05:00:00Z")) == "2026-10-01 05:00:00"
    assert one(spark, text.safe_utc_timestamp, "2026-10-01 05:00:00") is None


@pytest.mark.parametrize("title, expected", [
    ("Help me", True), ("I can't win", True), ("Nice show", True), ("any tips?", True), ("Nice farm", False),
    ("TRYING again", True)])
def test_question_keywords_are_substrings(spark, title, expected):
    assert one(spark, text.looks_like_question, title) is expected


def test_dropping_redundant_keywords_changes_nothing(spark):
    titles = ["what's up", "how's it", "where's", "when's", "why's", "whatever", "nothing", "shower", "ca'nt"]
    rows = spark.createDataFrame([(t,) for t in titles], "s string").select(
        "s", text.looks_like_question(F.col("s")).alias("q")).collect()
    for r in rows:
        assert r.q == any(k.lower() in r.s.lower() for k in text.QUESTION_KEYWORDS)


@pytest.mark.parametrize("reply, prompt, caption", [
    ('Image prompt: a fox-owl\n\nCaption: "Hoot!"', "a fox-owl", "Hoot!"),
    ("Image prompt: only this", "only this", ""),
    ("Image prompt: a Caption: 'b' Caption: c", "a", "b"),
    ("", "", "")])
def test_reply_split(spark, reply, prompt, caption):
    assert one(spark, text.reply_prompt, reply) == prompt
    assert one(spark, text.reply_caption, reply) == caption
