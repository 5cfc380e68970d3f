"""Text clean-up. Every function maps a Column to a Column and stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters with the Unicode White_Space property.
UNICODE_BLANKS = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What Python's str.strip() removes beyond the list above.
PYTHON_BLANKS = "\x1c\x1d\x1e\x1f" + UNICODE_BLANKS

# Characters that start a new word, besides white space.
WORD_BREAKS = "[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"

# The keywords that make a title look like a question.
QUESTION_KEYWORDS = (
    "?", "Help", "help", "What", "What's", "what", "How", "How's", "how", "Where", "Where's",
    "When", "When's", "when", "Why", "Why's", "why", "Trying", "trying", "Can't", "can't",
)

# The two labels in a delimited reply.
PROMPT_LABEL = "Image prompt:"
CAPTION_LABEL = "Caption:"

# A Unicode noncharacter, so it cannot occur in interchanged text.
_MARK = "\ufdd0"
# The blanks, but for the space, as ranges: one test for many characters keeps the match cheap.
_BLANK_RANGES = r"\t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BREAK_CLASS = "[" + _BLANK_RANGES + "".join("\\" + ch for ch in WORD_BREAKS) + "]"


def trim_text(c: Column) -> Column:
    """Trim all Unicode white space, not only spaces."""
    return F.btrim(c, F.lit(UNICODE_BLANKS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_text(c), F.lit(""))


def collapse_spaces(c: Column) -> Column:
    """Trim, then turn every inner run of ASCII white space into one space."""
    return F.regexp_replace(trim_text(c), r"[\t\n\f\r ]+", " ")


def initcap_words(c: Column) -> Column:
    """Capitalise after any word break, punctuation included.

    Spark's initcap only splits on spaces, so each other break is followed by
    a marked space for the duration of the call. Text without such a break,
    which is most text, skips the two regular expressions.
    """
    marked = F.regexp_replace(c, "(" + _BREAK_CLASS + ")", "$1" + _MARK + " ")
    return F.when(~c.rlike(_BREAK_CLASS), F.initcap(c)).otherwise(
        F.regexp_replace(F.initcap(marked), _MARK + " ", ""))


def currency_to_numeric(c: Column) -> Column:
    """``$17,800.00`` -> 17800; text that is not a number -> NULL."""
    return F.translate(c, "$, \t\n\r\f", "").try_cast(T.DecimalType(38, 9))


def safe_date(c: Column) -> Column:
    """ISO date with one- or two-digit month and day; anything else -> NULL."""
    return F.try_to_date(trim_text(c), "yyyy-M-d")


def safe_utc_timestamp(c: Column) -> Column:
    """``2026-10-01T05:00:00Z``; anything else -> NULL."""
    return F.try_to_timestamp(trim_text(c), F.lit("yyyy-M-d'T'H:m:s'Z'"))


def looks_like_question(c: Column) -> Column:
    """Lower-cased text contains any keyword (substring, so "show" counts for "how")."""
    lowered = {k.lower() for k in QUESTION_KEYWORDS}
    needed = sorted(k for k in lowered if not any(o != k and o in k for o in lowered))
    text = F.lower(c)
    found = text.contains(needed[0])
    for keyword in needed[1:]:
        found = found | text.contains(keyword)
    return found


def reply_prompt(c: Column) -> Column:
    """The text before the caption label, without the prompt label."""
    head = F.split_part(c, F.lit(CAPTION_LABEL), F.lit(1))
    return F.btrim(F.replace(head, F.lit(PROMPT_LABEL), F.lit("")), F.lit(PYTHON_BLANKS))


def reply_caption(c: Column) -> Column:
    """The text after the first caption label, unquoted; no label -> empty."""
    tail = F.split_part(c, F.lit(CAPTION_LABEL), F.lit(2))
    return F.btrim(F.btrim(tail, F.lit(PYTHON_BLANKS)), F.lit("'\""))
