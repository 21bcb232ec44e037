"""Text columns: strip, collapse, defaults, tokens and per-row term counts.

Everything here is a JVM expression over one row, so none of it shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from newsflow.schemas import NO_CONTENT, SENTIMENT_CHARS, UNKNOWN_LABEL

# The characters Python strips as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as a class the regex engine tests fastest. Every run but a single
# plain space, which needs no rewriting: a space and more, or another character first.
_SPACE = r"[\s\x1c-\x1f]"
UNEVEN_RUN = rf"(?U) {_SPACE}+|[\s\x1c-\x1f&&[^ ]]{_SPACE}*"
# Anything that is no letter, digit or underscore separates words.
WORD_GAP = r"[^\p{L}\p{N}_]+"

# A short default; pass another list for another language or a longer one.
STOP_WORDS = (
    "a an and are as at be been but by can could did do does for from had has have he "
    "her him his how if in into is it its may me more most my no not of on one or our "
    "out over she should so some such than that the their them then there these they "
    "this those to under up us was we were what when which who will with would you your"
).split()


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def unnest(df: DataFrame, array: Column, *keep: str) -> DataFrame:
    """One row per element, as ``_at`` and ``_item``; rows with an empty array go.

    The outer form with a filter after it: for the inner form the planner also tests the
    array beforehand, and so works it out (UDFs included) a second time.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias("_at", "_item"))
    return rows.filter(F.col("_at").isNotNull())


def strip(c: Column) -> Column:
    """Trim Unicode whitespace on both ends; null becomes the empty string."""
    return F.coalesce(F.trim(c, F.lit(WHITESPACE)), F.lit(""))


def clean(c: Column) -> Column:
    """Strip, then collapse every whitespace run to one space."""
    return F.regexp_replace(strip(c), UNEVEN_RUN, " ")


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def default_title(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def default_content(c: Column, sentinel: str = NO_CONTENT) -> Column:
    """Null or empty content becomes the sentinel text."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(sentinel))


def truncate(c: Column, chars: int = SENTIMENT_CHARS) -> Column:
    return F.substring(c, 1, chars)


def normalise_label(c: Column, missing: str = UNKNOWN_LABEL) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(missing)), F.lit(WHITESPACE)))


def base_text(summary: Column, content: Column) -> Column:
    """The summary, or the content where the summary is empty."""
    return F.coalesce(F.nullif(summary, F.lit("")), content)


def error_text(error: Column) -> Column:
    return F.concat(F.lit("error: "), error)


def summary_error_text(error: Column) -> Column:
    return F.concat(F.lit("[요약 오류: "), error, F.lit("]"))


def tokens(c: Column, stop_words: Iterable[str] = (), min_len: int = 2) -> Column:
    """Lower-cased words in text order, without stop words and short words."""
    stop = sorted({w.lower() for w in stop_words})
    words = F.split(F.lower(F.coalesce(c, F.lit(""))), WORD_GAP)
    if stop:
        # A list of literals becomes one hash set in the plan.
        return F.filter(words, lambda t: (F.length(t) >= min_len) & ~t.isin(stop))
    return F.filter(words, lambda t: F.length(t) >= min_len)


def term_counts(words: Column) -> Column:
    """``array<struct<neg, term>>`` of distinct words, ``neg`` being minus their count.

    Sorting the row's own words and measuring the runs keeps the count inside the row:
    a document's words never travel. The negated count makes natural order "most
    frequent first, then alphabetic".
    """

    def runs(ordered: Column) -> Column:
        starts = F.array_compact(
            F.transform(
                ordered,
                lambda w, i: F.when((i == 0) | (w != F.get(ordered, i - 1)), i),
            )
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda here, j: F.struct(
                    (here - F.coalesce(F.get(at, j + 1), F.size(ordered))).alias("neg"),
                    F.get(ordered, here).alias("term"),
                ),
            ),
        )

    return let(F.sort_array(words), runs)
