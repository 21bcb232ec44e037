"""The ingest as a stream: pages in any order, links whose page does not come, replays."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from newsflow.schemas import RAW_NEWS, RAW_PAGES
from newsflow.sources import landing as L
from newsflow.streaming.pages import LINKS, parsed_pages, page_stream, start_page_ingest

DAY = dt.datetime(2024, 1, 10)


def html(body, date=None):
    stamp = f'<time datetime="{date}">x</time>' if date else ""
    return f"<html><head><title>T</title></head><body>{stamp}<article><p>{body}</p></article></body></html>"


class Run:
    def __init__(self, spark, folder):
        self.spark = spark
        self.links, self.pages, self.base, self.checkpoint = (str(folder / n) for n in ("links", "pages", "raw", "checkpoint"))

    def link(self, *rows):
        made = [(ticker, pos, url, last, DAY + dt.timedelta(hours=hour)) for ticker, pos, url, last, hour in rows]
        self.spark.createDataFrame(made, LINKS).write.mode("append").parquet(self.links)

    def page(self, *rows):
        made = [(url, text, 200, kind, DAY + dt.timedelta(hours=hour)) for url, text, kind, hour in rows]
        self.spark.createDataFrame(made, RAW_PAGES).write.mode("append").parquet(self.pages)

    def go(self, **options):
        start_page_ingest(self.spark, self.links, self.pages, self.base, self.checkpoint, "run-1", "6 hours", **options).awaitTermination()
        landed = {(r["ticker"], r["url"], r["date"].day, r["content"]) for r in L.read_landed(self.spark, self.base, RAW_NEWS).collect()}
        held = [(r["ticker"], r["url"], r["reason"]) for r in L.read_landed(self.spark, L.quarantine_path(self.base), f"{RAW_NEWS}, reason string").collect()]
        return landed, sorted(held)


def test_links_wait_for_their_pages_and_time_out(spark, tmp_path):
    run = Run(spark, tmp_path)
    run.link(("A", 1, "u1", None, 0), ("B", 1, "u1", None, 0), ("A", 2, "u2", None, 0), ("A", 3, "u3", None, 0), ("A", 4, "old", dt.date(2024, 1, 9), 0))
    # The page of u1 is for two tickers; one of an unknown URL is for nobody.
    run.page(("u1", html("one"), None, 1), ("stray", html("x"), None, 1), ("old", html("before", "2024-01-02T00:00:00Z"), None, 1))
    landed, held = run.go()
    assert landed == {("A", "u1", 10, "one"), ("B", "u1", 10, "one")} and held == []
    # u2 comes later, with a date of its own; u3 only after its time.
    run.page(("u2", html("two", "2024-01-11T20:00:00Z"), None, 5))
    landed, held = run.go()
    assert ("A", "u2", 12, "two") in landed and held == []
    run.link(("A", 9, "next", None, 30))
    run.page(("u3", html("three"), None, 29), ("other", html("x"), None, 30))
    landed, held = run.go()
    assert held == [("A", "u3", "not fetched")]
    assert {u for _, u, _, _ in landed} == {"u1", "u2"}


def test_the_better_fetch_of_a_batch_is_landed(spark, tmp_path):
    run = Run(spark, tmp_path)
    url = "https://finance.yahoo.com/news/1"
    run.link(("A", 1, url, None, 0))
    run.page((url, html("thin"), None, 1), (url, html("much longer " * 5), "browser", 2))
    landed, _ = run.go()
    assert [c for *_, c in landed] == [("much longer " * 5).strip()]


def test_errors_land_if_asked(spark, tmp_path):
    run = Run(spark, tmp_path)
    run.link(("A", 1, "u1", None, 0))
    run.page(("x", html("x"), None, 0))
    run.go(land_errors=True)
    run.link(("A", 9, "next", None, 30))
    run.page(("x", html("x"), None, 30))
    landed, held = run.go(land_errors=True)
    assert landed == {("A", "u1", 10, "")} and held == []


def test_a_batch_run_again_adds_nothing(spark, tmp_path):
    run = Run(spark, tmp_path)
    run.link(("A", 1, "u1", None, 0), ("A", 2, "u2", None, 0))
    run.page(("u1", html("one"), None, 1))
    run.go()
    run.link(("A", 9, "next", None, 30))
    run.page(("x", html("x"), None, 30))
    before = run.go()
    assert before[1] == [("A", "u2", "not fetched")]
    for name in sorted(glob.glob(f"{run.checkpoint}/commits/*"))[-1:]:
        os.remove(name)
        crc = f"{run.checkpoint}/commits/.{os.path.basename(name)}.crc"
        if os.path.exists(crc):
            os.remove(crc)
    assert run.go() == before
    assert L.read_landed(spark, run.base, RAW_NEWS).count() == 1


def test_pages_are_dealt_by_url_before_they_are_parsed(spark, tmp_path):
    run = Run(spark, tmp_path)
    run.page(("u1", html("one"), None, 1))
    plan = parsed_pages(page_stream(spark, run.pages))._jdf.queryExecution().analyzed().toString()
    parse, deal, read = (plan.index(word) for word in ("AS facts", "RepartitionByExpression [url", "StreamingRelation"))
    assert parse < deal < read
