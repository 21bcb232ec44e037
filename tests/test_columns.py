"""Text, date and vector columns on values the tables lack."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from newsflow.functions import dates as D
from newsflow.functions import text as X
from newsflow.functions import urls as U
from newsflow.functions.vectors import cosine

ODD = ["\xa0 a　b \x1c", " ", "", None, "a\t\n b", "​x", "\x1fa\x1fb\x1f", "é ü"]


def one(spark, values, kind, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", column(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strip_like_python(spark):
    assert one(spark, ODD, "string", X.strip) == [(v or "").strip() for v in ODD]


def test_clean_like_python(spark):
    assert one(spark, ODD, "string", X.clean) == [" ".join((v or "").split()) for v in ODD]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \t\x1c\xa0　-.", max_size=30), min_size=20, max_size=20))
def test_strip_and_clean_any_text(spark, texts):
    assert one(spark, texts, "string", X.strip) == [t.strip() for t in texts]
    assert one(spark, texts, "string", X.clean) == [" ".join(t.split()) for t in texts]


def test_defaults(spark):
    assert one(spark, [None, "t"], "string", X.default_title) == ["", "t"]
    assert one(spark, [None, "", "c"], "string", X.default_content) == ["본문 없음", "본문 없음", "c"]
    assert one(spark, [None, " POS\t"], "string", X.normalise_label) == ["unknown", "pos"]
    assert one(spark, ["😀" * 600], "string", X.truncate) == ["😀" * 512]
    assert one(spark, ["bad"], "string", X.error_text) == ["error: bad"]
    assert one(spark, ["bad"], "string", X.summary_error_text) == ["[요약 오류: bad]"]


def test_term_counts_like_a_counter(spark):
    texts = ["b a b c a b", "", None, "one", "x_y X_Y z", "É é"]
    got = one(spark, texts, "string", lambda c: X.term_counts(X.tokens(c, min_len=1)))
    for text, terms in zip(texts, got):
        words = (text or "").lower().split()
        assert {t.term: -t.neg for t in terms} == dict(Counter(words))


def test_stop_words_and_short_words(spark):
    got = one(spark, ["The cat a of Fog x"], "string", lambda c: X.tokens(c, ["the", "of"]))
    assert got == [["cat", "fog"]]


def test_urls(spark):
    hrefs = ["http://a", "https://b", "/c", "d"]
    assert one(spark, hrefs, "string", U.absolute) == [
        "http://a", "https://b", "https://finance.yahoo.com/c", "https://finance.yahoo.comd",
    ]
    assert one(spark, ["AAPL"], "string", U.listing_url) == [
        "https://finance.yahoo.com/quote/AAPL/news?p=AAPL"
    ]
    day = F.lit(dt.date(2024, 1, 2))
    assert one(spark, ["A"], "string", lambda c: U.raw_key(c, day)) == ["raw/A/2024-01-02/news.csv"]
    assert one(spark, ["A"], "string", lambda c: U.result_key(c, day)) == ["results/A/2024-01-02.csv"]


def test_date_guess_and_not_before(spark):
    assert one(spark, ["2024-01-01T20:00:00Z", "x", None], "string", D.date_guess) == ["2024-01-01", "x", None]
    last = F.lit(dt.date(2024, 1, 2))
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
    assert one(spark, days, "date", lambda c: D.not_before(c, last, True)) == [False, True, True]
    assert one(spark, days, "date", lambda c: D.not_before(c, last, False)) == [False, True, False]
    none = F.lit(None).cast("date")
    assert one(spark, days, "date", lambda c: D.not_before(c, none, False)) == [True, True, True]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [r.c for r in df.select(cosine(F.col("a"), F.col("b")).alias("c")).collect()] == [0.707107, 0.0]
