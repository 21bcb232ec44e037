"""The appending stream: as the batch job, in any number of batches, and nothing twice."""

import datetime as dt
import glob
import os

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsflow.plans.analyze import Backends, analyze_news
from newsflow.schemas import RAW_NEWS
from newsflow.sources.landing import read_landed, write_partitions
from newsflow.streaming import appending
from newsflow.streaming.appending import _PROVIDER, FirstOfKey, appended_results, best_rows, start_appending_analysis

BACKENDS = Backends(sentiment_weights={"good": 1})
#: run, ticker, day, position, text: texts repeat within a day, over runs and over days.
ROWS = [
    (1, "A", 1, 3, "good one. x"), (1, "A", 1, 1, "good one. y"), (1, "A", 1, 2, "two."), (1, "B", 1, 1, "good one."),
    (1, "A", 2, 1, "good one."), (1, "A", 1, 4, "  "), (2, "A", 1, 1, "good one. z"), (2, "A", 1, 2, "three."),
    (2, "B", 1, 7, "four."), (2, "B", 1, 6, "four. late"), (3, "A", 2, 1, "good one."), (3, "C", 3, 1, "five."),
]


def news(spark, run):
    rows = [(f"u{r}{t}{d}{p}", "t", text, 200, f"2024-01-0{r}T00:00:00", f"run-{r}", None, p, t, dt.date(2024, 1, d)) for r, t, d, p, text in ROWS if run is None or r == run]
    return spark.createDataFrame(rows, RAW_NEWS)


def found(df):
    return sorted((r["ticker"], r["date"].day, r["url"], r["summary"], r["sentiment"]) for r in df.collect())


def test_batches_append_what_the_batch_job_gives(spark, tmp_path):
    base, results, checkpoint = (str(tmp_path / n) for n in ("raw", "results", "checkpoint"))
    before = spark.conf.get(_PROVIDER, None)
    files = []
    for run in (1, 2, 3):
        write_partitions(news(spark, run), base, "append")
        query = start_appending_analysis(spark, base, results, checkpoint, BACKENDS)
        query.awaitTermination()
        files.append(set(glob.glob(f"{results}/ticker=*/date=*/*.parquet")))
    assert found(appended_results(spark, results)) == found(analyze_news(news(spark, None), None, BACKENDS))
    # Files of earlier batches are still there: nothing was rewritten.
    assert files[0] < files[1] < files[2]
    # A restart has nothing to do.
    query = start_appending_analysis(spark, base, results, checkpoint, BACKENDS)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 0
    assert set(glob.glob(f"{results}/ticker=*/date=*/*.parquet")) == files[2]
    # The only source is the landing.
    assert [s["description"] for s in query.lastProgress["sources"]] == [f"FileStreamSource[file:{base}]"] if query.lastProgress else True
    assert spark.conf.get(_PROVIDER, None) == before


def test_file_by_file_gives_one_result_per_key(spark, tmp_path):
    base, results, checkpoint = (str(tmp_path / n) for n in ("raw", "results", "checkpoint"))
    for run in (1, 2, 3):
        write_partitions(news(spark, run), base, "append")
    query = start_appending_analysis(spark, base, results, checkpoint, BACKENDS, max_files=1)
    query.awaitTermination()
    assert len({p["batchId"] for p in query.recentProgress}) > 3
    want = {(t, d, s) for t, d, _, s, _ in found(analyze_news(news(spark, None), None, BACKENDS))}
    got = [(t, d, s) for t, d, _, s, _ in found(appended_results(spark, results))]
    assert len(got) == len(want) and set(got) == want


def test_known_results_are_not_given_out_again(spark, tmp_path):
    base, results, checkpoint = (str(tmp_path / n) for n in ("raw", "results", "checkpoint"))
    known = analyze_news(news(spark, 1), None, BACKENDS)
    for run in (1, 2, 3):
        write_partitions(news(spark, run), base, "append")
    start_appending_analysis(spark, base, results, checkpoint, BACKENDS, known=known).awaitTermination()
    both = found(known.select("ticker", "date", "url", "summary", "sentiment").unionByName(appended_results(spark, results).select("ticker", "date", "url", "summary", "sentiment")))
    assert both == found(analyze_news(news(spark, None), None, BACKENDS))


def test_a_batch_that_did_not_end_is_done_again_without_repeats(spark, tmp_path):
    base, results, checkpoint = (str(tmp_path / n) for n in ("raw", "results", "checkpoint"))
    write_partitions(news(spark, 1), base, "append")
    start_appending_analysis(spark, base, results, checkpoint, BACKENDS).awaitTermination()
    want = found(appended_results(spark, results))
    # As if the job had died after writing and before the commit of its batch.
    for name in glob.glob(f"{checkpoint}/commits/*") + glob.glob(f"{checkpoint}/commits/.*.crc"):
        os.remove(name)
    start_appending_analysis(spark, base, results, checkpoint, BACKENDS).awaitTermination()
    assert found(appended_results(spark, results)) == want


class State:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value


class Handle:
    def getValueState(self, *_):
        return State()


@pytest.mark.parametrize("size", [1, 2, 100])
def test_the_first_row_of_a_key_in_order_whatever_the_batches(size):
    rows = pd.DataFrame({"url": list("edcba"), "pos": [3, 1, None, 1, 2], "run_id": ["r2", "r2", "r1", "r1", "r1"]})
    one = FirstOfKey(["url", "pos"], ["run_id", "pos", "url"])
    one.init(Handle())
    parts = [rows.iloc[i : i + size] for i in range(0, len(rows), size)]
    out = list(one.handleInputRows(("k",), iter(parts), None))
    assert [o["url"].tolist() for o in out] == [["c"]]
    assert list(one.handleInputRows(("k",), iter(parts), None)) == []


def test_no_key_costs_a_call_to_python_and_a_day_few_files(spark, tmp_path):
    base, results, checkpoint = (str(tmp_path / n) for n in ("raw", "results", "checkpoint"))
    rows = [(f"u{i}", "t", f"text {i % 300}.", 200, "2024-01-01T00:00:00", "run-1", None, 1000 - i, "A", dt.date(2024, 1, 1)) for i in range(600)]
    write_partitions(spark.createDataFrame(rows, RAW_NEWS), base, "append")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        query = start_appending_analysis(spark, base, results, checkpoint, BACKENDS)
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [s["operatorName"] for s in query.lastProgress["stateOperators"]] == ["dedupe"]
    assert {r["url"] for r in appended_results(spark, results).collect()} == {f"u{i}" for i in range(300, 600)}
    assert len(glob.glob(f"{results}/ticker=*/date=*/*.parquet")) <= 8


@pytest.mark.parametrize("size", [1, 2, 100])
@pytest.mark.parametrize("least", [1, 3, 10_000])
def test_best_rows_whatever_the_batches(monkeypatch, size, least):
    monkeypatch.setattr(appending, "_ROUND", least)
    table = pa.table({"k": ["x", "y", None, "x", "x", "y", None], "run": ["2", "2", "1", "1", "1", None, "1"], "pos": [3, 1, 5, 2, None, 9, 4], "url": list("gfedcba")})
    out = pa.Table.from_batches(best_rows(iter(table.to_batches(max_chunksize=size)), ["k"], ["run", "pos", "url"]))
    assert {r["k"]: r["url"] for r in out.to_pylist()} == {"x": "c", "y": "b", None: "a"} and out.num_rows == 3
    assert list(best_rows(iter([]), ["k"], ["pos"])) == []
