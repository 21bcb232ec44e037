"""Last dates, stop sets, anti joins, pending tests and ranking against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from newsflow.operators import incremental as I
from newsflow.operators import ranking as R
from newsflow.sources import news as N

TODAY = dt.date(2024, 1, 30)
LANDED = "ticker string, date date, url string, pos bigint"


def back(days):
    return TODAY - dt.timedelta(days=days)


def test_last_dates_ignore_names_that_are_no_date(rows):
    df = rows(
        [("A", "2024-01-02"), ("A", "2024-01-10"), ("A", "zzz"), ("B", "tmp")], "ticker string, date string"
    )
    got = {r.ticker: r.last_date for r in I.last_dates(df).collect()}
    assert got == {"A": dt.date(2024, 1, 10), "B": None}
    names = [(r.ticker, r.date) for r in N.ticker_dates(df).collect()]
    assert names == [("A", "2024-01-02"), ("A", "2024-01-10"), ("A", "zzz"), ("B", "tmp")]


def brute_stop_set(table, lookback, top_n):
    out = {}
    for ticker in {r[0] for r in table}:
        mine = [r for r in table if r[0] == ticker and r[2] is not None]
        days = sorted({r[1] for r in mine if (TODAY - r[1]).days <= lookback}, reverse=True)
        seen = []
        for day in days:
            head = [r[2].strip() for r in sorted(mine, key=lambda r: r[3]) if r[1] == day][:top_n]
            for url in head:
                if url not in seen and len(seen) < top_n:
                    seen.append(url)
        if seen:
            out[ticker] = seen
    return out


def test_stop_set_edges(rows):
    table = [
        ("A", back(-3), "future", 9), ("A", back(0), "u1", 0), ("A", back(0), " u1 ", 1),
        ("A", back(7), "edge", 2), ("A", back(8), "old", 3), ("A", back(7), "u1", 4), ("A", back(0), None, 5),
    ]
    got = I.stop_set(rows(table, LANDED), TODAY).orderBy("rank").collect()
    assert [r.url for r in got] == ["future", "u1", "edge"]


def test_stop_set_like_the_loop(rows):
    rng = random.Random(1)
    table = [
        (rng.choice("AAAAAB"), back(rng.randrange(-2, 12)), f"u{rng.randrange(40)}", i) for i in range(600)
    ]
    got = I.stop_set(rows(table, LANDED), TODAY, 7, 5).orderBy("ticker", "rank").collect()
    by_ticker = {}
    for r in got:
        by_ticker.setdefault(r.ticker, []).append(r.url)
    assert by_ticker == brute_stop_set(table, 7, 5)


def test_url_heads(rows):
    day = back(0)
    table = [("A", day, " b ", 2), ("A", day, None, 0), ("A", day, "a", 1), ("A", day, "c", 3)]
    heads = N.url_heads(rows(table, LANDED), 2).orderBy("rank").collect()
    assert [r.url for r in heads] == ["a", "b"]


def test_drop_stopped_and_landed(rows):
    day = back(0)
    old = rows([("A", day, " x ", 0), ("B", day, "y", 0)], LANDED)
    new = rows([("A", day, "x", 1), ("A", day, "y", 2), ("A", back(1), "x", 3), ("B", day, "y", 4)], LANDED)
    assert {r.pos for r in I.drop_stopped(new, old).collect()} == {2}
    assert {r.pos for r in I.drop_landed(new, old).collect()} == {2, 3}


def test_since_last(rows):
    last = rows([("A", back(5))], "ticker string, last_date date")
    df = rows(
        [("A", back(5), "u", 0), ("A", back(6), "u", 1), ("A", None, "u", 2), ("N", back(90), "u", 3), ("N", None, "u", 4)],
        LANDED,
    )
    assert {r.pos for r in I.since_last(df, last).collect()} == {0, 2, 3, 4}
    assert {r.pos for r in I.since_last(df, last, keep_null=False).collect()} == {0, 3, 4}


STATS = "ticker string, date date, row_count bigint, mtime int"


def test_pending_and_selection(rows):
    days = [back(i) for i in range(6)]
    inputs = rows([("A", d, 3, 10) for d in days[:5]] + [("B", days[0], 1, 10)], STATS)
    outputs = rows(
        [("A", days[1], 1, 9), ("A", days[2], 1, 10), ("A", days[3], 1, 11), ("A", days[4], 0, 11), ("A", days[5], 1, 1)],
        STATS,
    )
    keys = lambda df: {(r.ticker, r.date) for r in df.collect()}
    pending = keys(I.pending_partitions(inputs, outputs))
    assert pending == {("A", days[0]), ("A", days[1]), ("A", days[4]), ("B", days[0])}
    full_only = keys(I.pending_partitions(inputs, outputs, empty_is_pending=False))
    assert full_only == pending - {("A", days[4])}
    assert keys(I.select_partitions(inputs, outputs, ticker="A")) == pending - {("B", days[0])}
    assert keys(I.select_partitions(inputs, outputs, date=days[2])) == {("A", days[2])}
    assert len(keys(I.select_partitions(inputs, outputs, mode="all"))) == 6
    with pytest.raises(ValueError):
        I.select_partitions(inputs, mode="some")


@pytest.mark.parametrize("salts", [1, 7])
def test_first_n_with_a_hot_key(rows, salts):
    rng = random.Random(2)
    table = [("hot" if i % 3 else f"k{i % 50}", rng.random(), i) for i in range(3000)]
    df = rows(table, "k string, v double, i int")
    got = R.first_n_per_key(df, ["k"], [F.col("v"), F.col("i")], 4, rank_col="rank", salts=salts)
    want = {}
    for k, v, i in sorted(table, key=lambda r: (r[1], r[2])):
        if len(want.setdefault(k, [])) < 4:
            want[k].append(i)
    have = {}
    for r in got.orderBy("rank").collect():
        have.setdefault(r.k, []).append(r.i)
    assert have == want


def test_large_n_is_cut_in_shares_first(rows):
    df = rows([("a", i) for i in range(3000)], "k string, pos int")
    capped = R.cap_per_ticker(df, 1500, ["k"])
    assert {r.pos for r in capped.collect()} == set(range(1500))
    assert capped._jdf.queryExecution().toString().count("Window [row_number") >= 2


def test_group_limit_runs_before_the_shuffle(rows):
    df = rows([("a", i) for i in range(10)], "ticker string, pos int")
    plan = R.cap_per_ticker(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") == 4


def test_dedup_keep_first(rows):
    schema = "ticker string, date date, url string, pos bigint, v string"
    day = back(0)
    old = rows([("A", day, "u", 5, "old"), ("A", day, None, 1, "null old")], schema)
    new = rows(
        [("A", day, "u", 0, "new"), ("A", back(1), "u", 1, "other day"), ("A", day, "w", 3, "second"),
         ("A", day, "w", 2, "first"), ("A", day, None, 0, "null new")],
        schema,
    )
    kept = {r.v for r in R.dedup_keep_first(old, new).collect()}
    assert kept == {"old", "null old", "other day", "first"}
    assert R.dedup_keep_first(old, new, ()).count() == 7
    assert {r.v for r in R.dedup_keep_first(None, new, ("ticker", "url")).collect()} == {"new", "first", "null new"}
