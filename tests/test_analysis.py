"""Chunks, model hooks, labels and keywords against plain Python."""

import math
import random
import textwrap
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from newsflow.operators import keywords as K
from newsflow.operators import summaries as M
from newsflow.operators.inference import model_column
from newsflow.operators.sentiment import lexicon_label, model_label
from newsflow.plans.analyze import Backends, analyze_articles

TEXTS = [
    "", " \xa0 ", "short", "w" * 1100, "w" * 1101, "a " * 700, "well-known " * 200, ("x" * 600 + " ") * 4,
    "one\n\ttwo　three", "a--b " * 400, "-" * 1500,
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, content string")


def test_chunks_like_the_wrapper(spark):
    got = M.chunk_table(frame(spark, TEXTS), ["doc_id"]).orderBy("doc_id", "chunk_pos").collect()
    want = [
        (i, k, chunk) for i, t in enumerate(TEXTS) for k, chunk in enumerate(textwrap.wrap(" ".join(t.split()), 1100))
    ]
    assert [tuple(r) for r in got] == want


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aaé1-_. \U0001f600'", max_size=120), min_size=30, max_size=30), st.integers(5, 30))
def test_any_chunks_like_the_wrapper(spark, texts, width):
    got = M.with_chunks(frame(spark, texts), width=width).orderBy("doc_id").collect()
    assert [r.chunks for r in got] == [textwrap.wrap(" ".join(t.split()), width) for t in texts]


def failing():
    def predict(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("no way")
        return [t.upper() for t in texts]

    return predict


def test_model_errors_are_values(spark):
    df = frame(spark, ["good", "bad", "fine"])
    got = df.select(model_column(failing, 10)(F.col("content")).alias("r")).collect()
    assert [(r.r.value, r.r.error) for r in got] == [("GOOD", None), (None, "no way"), ("FINE", None)]


def test_model_summary_keeps_chunk_order_and_errors(spark):
    text = " ".join(["aa"] * 5 + ["bad"] + ["cc"] * 5)
    df = frame(spark, [text, "", "x"])
    got = M.summarize_with_model(df, ["doc_id"], model_column(failing, 4), width=10, spread=3)
    by_id = {r.doc_id: r.summary for r in got.collect()}
    parts = [("[요약 오류: no way]" if "bad" in c else c.upper()) for c in textwrap.wrap(text, 10)]
    assert by_id == {0: " ".join(parts), 1: "", 2: "X"}


def labeller():
    return lambda texts: [f" POS{len(t)} " if "none" not in t else None for t in texts]


def test_model_label(spark):
    df = frame(spark, ["x" * 600, " ", "none"])
    got = df.select("doc_id", model_label(F.col("content"), model_column(labeller)).alias("l")).orderBy("doc_id").collect()
    assert [r.l for r in got] == ["pos512", "unknown", "unknown"]
    bad = frame(spark, ["bad"]).select(model_label(F.col("content"), model_column(failing)).alias("l"))
    assert bad.collect()[0].l == "error: no way"


def test_lexicon_label(spark):
    texts = ["Up up down", "down", "flat", "", None, "x" * 510 + " up"]
    df = frame(spark, texts).select("doc_id", lexicon_label(F.col("content"), {"up": 1, "down": -1.5}).alias("l"))
    assert [r.l for r in df.orderBy("doc_id").collect()] == ["positive", "negative", "neutral", "unknown", "unknown", "positive"]
    cut = frame(spark, texts).select("doc_id", lexicon_label(F.col("content"), {"up": 1}, chars=512).alias("l"))
    assert cut.orderBy("doc_id").collect()[5].l == "neutral"


def corpus(n=60):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    return [" ".join(["common"] * rng.randrange(1, 4) + rng.choices(words, k=rng.randrange(3, 30))) for _ in range(n)]


def test_texts_are_split_once(spark):
    df = frame(spark, ["a b"])
    plan = M.chunk_table(df, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    plan = K.term_table(df, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1


def test_words_are_not_shuffled(spark):
    df = frame(spark, ["a b"]).select(K.frequent_terms(F.col("content")), lexicon_label(F.col("content"), {"a": 1}))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_frequent_terms(spark):
    texts = corpus()
    got = frame(spark, texts).select("doc_id", K.frequent_terms(F.col("content"), 3, ()).alias("k")).orderBy("doc_id").collect()
    for text, row in zip(texts, got):
        want = sorted(Counter(text.split()).items(), key=lambda p: (-p[1], p[0]))[:3]
        assert row.k == [w for w, _ in want]


def test_tfidf_with_hot_terms(spark):
    texts = corpus()
    terms = K.term_table(frame(spark, texts), ["doc_id"], stop_words=())
    counted = K.with_document_frequency(terms).collect()
    freq = Counter(w for t in texts for w in set(t.split()))
    assert len(counted) == sum(freq.values())
    assert all(r.doc_freq == freq[r.term] for r in counted)
    got = {r.doc_id: r.keywords for r in K.tfidf_keywords(frame(spark, texts), ["doc_id"], top_k=3, stop_words=()).collect()}
    for i, text in enumerate(texts):
        tf = Counter(text.split())
        score = {w: round(n * (math.log((len(texts) + 1) / (freq[w] + 1)) + 1), 6) for w, n in tf.items()}
        assert got[i] == ", ".join(sorted(score, key=lambda w: (-score[w], w))[:3])


def embedder():
    def embed(texts):
        return np.array([[t.count(c) for c in "abc"] for t in texts], dtype=float)

    return embed


def test_similar_terms(spark):
    df = frame(spark, ["aab ab ccc aab", "", "zz"])
    got = df.select("doc_id", K.similar_terms(F.col("content"), embedder, 2).alias("k")).orderBy("doc_id").collect()
    assert [r.k for r in got] == [["aab", "ab"], [], ["zz"]]


def test_cosine_top_k_and_mean(spark):
    rng = np.random.default_rng(4)
    data = [(i, i % 3 % 2, rng.normal(size=5).tolist()) for i in range(90)]
    df = spark.createDataFrame(data, "id int, g int, vector array<double>")
    mean = {r.g: r.vector for r in K.mean_vector(df, ["g"]).collect()}
    for g in (0, 1):
        want = np.mean([v for _, h, v in data if h == g], axis=0)
        assert np.allclose(mean[g], want, atol=1e-8)
    got = K.cosine_top_k(df, K.mean_vector(df, ["g"]), ["g"], "id", 4).orderBy("g", "rank").collect()
    for g in (0, 1):
        cos = lambda v: float(np.dot(v, mean[g]) / np.linalg.norm(v) / np.linalg.norm(mean[g]))
        want = sorted((( -round(cos(v), 6), i) for i, h, v in data if h == g))[:4]
        assert [r.id for r in got if r.g == g] == [i for _, i in want]


def test_analysis_contract(spark):
    import datetime as dt

    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame(
        [("A", day, "u1", 0, "Up today. Then more."), ("A", day, "u2", 1, "  "), ("A", day, "u3", 2, "본문 없음")],
        "ticker string, date date, url string, pos int, content string",
    )
    backends = Backends(sentiment_weights={"up": 1})
    got = {r.url: r for r in analyze_articles(df, backends).collect()}
    assert set(got) == {"u1", "u3"}
    assert (got["u1"].summary, got["u1"].sentiment, got["u1"].keywords) == ("Up today.", "positive", "today")
    assert {r.url for r in analyze_articles(df, backends, skip_sentinel=True).collect()} == {"u1"}
    modelled = Backends(summary_model=model_column(failing), sentiment_model=model_column(labeller), keyword_model=model_column(failing))
    row = {r.url: r for r in analyze_articles(df, modelled).collect()}["u1"]
    assert (row.summary, row.sentiment) == ("UP TODAY. THEN MORE.", "pos20")
