"""Run history: states, upserts, reports and the store."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from newsflow.operators import history as H
from newsflow.operators import stats as S
from newsflow.sources.history_store import HistoryStore

LOG = (
    "id bigint, n int, changed_at timestamp_ntz, status string, run_id string, "
    "article_count int, s3_raw_path string, error_message string"
)


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


LOG_ROWS = [
    (1, 0, at(0), "running", "r1", None, None, None),
    (2, 1, at(1), "running", "r2", None, None, None),
    (2, 2, at(2), "success", None, 7, "raw/x", None),
    (3, 3, at(3), "running", "r3", None, None, None),
    (3, 4, at(4), "failed", None, None, None, "boom"),
    (4, 5, at(5), "running", "r4", None, None, None),
    (4, 6, at(6), "failed", None, None, None, "first"),
    (4, 7, at(7), "success", None, 9, "raw/y", None),
    (99, 8, at(8), "success", None, 1, "raw/z", None),
]


def state(df):
    return H.history_state(
        df, ["changed_at", "n"], ["run_id"], ["article_count", "s3_raw_path", "error_message"]
    )


def test_history_state(rows):
    got = {r.id: r for r in state(rows(LOG_ROWS, LOG)).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert (got[1].status, got[1].completed_at) == ("running", None)
    assert (got[2].status, got[2].article_count, got[2].completed_at) == ("success", 7, at(2))
    assert (got[3].status, got[3].error_message) == ("failed", "boom")
    # the old error text survives a later success
    assert (got[4].status, got[4].error_message, got[4].s3_raw_path) == ("success", "first", "raw/y")
    assert (got[4].created_at, got[4].updated_at, got[4].started_at) == (at(5), at(7), at(5))


def test_replayed_log_gives_the_same_state(rows):
    df = rows(LOG_ROWS, LOG)
    once, twice = state(df).collect(), state(df.union(df)).collect()
    assert sorted(map(str, once)) == sorted(map(str, twice))


def test_start_and_finish_share_their_key(rows):
    runs = rows([("r", "A", dt.date(2024, 1, 1)), ("r", "B", dt.date(2024, 1, 1))], "run_id string, ticker string, date date")
    started = H.start_records(runs, F.lit(at(0)))
    finished = H.finish_records(runs.withColumn("article_count", F.lit(3)), F.lit(at(1)), F.lit(H.SUCCESS))
    ids = {r.id for r in started.collect()}
    assert len(ids) == 2 and ids == {r.id for r in finished.collect()}
    assert {r.status for r in started.collect()} == {"running"}
    log = started.withColumnRenamed("started_at", "changed_at").withColumn("article_count", F.lit(None).cast("int"))
    log = log.unionByName(finished.withColumnRenamed("completed_at", "changed_at"), allowMissingColumns=True)
    done = H.history_state(log, ["changed_at"], ["run_id", "ticker", "date"], ["article_count"]).collect()
    assert {(r.status, r.article_count) for r in done} == {("success", 3)}


def test_run_upsert_keeps_the_first_description(rows):
    schema = "n int, run_id string, dag_id string, execution_date date, tickers string, status string, started_at timestamp_ntz"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    df = rows([(0, "r", "d1", d1, "[]", "running", at(0)), (1, "r", "d2", d2, '["A"]', "failed", at(1))], schema)
    row = H.run_upsert(df, ["n"]).collect()[0]
    assert (row.dag_id, row.execution_date, row.tickers) == ("d1", d1, "[]")
    assert (row.status, row.started_at) == ("failed", at(1))


def test_file_upsert_compares_255_characters(rows):
    schema = "n int, file_type string, ticker string, file_date date, s3_bucket string, s3_key string, file_size_bytes bigint, row_count int, uploaded_at timestamp_ntz"
    day, long = dt.date(2024, 1, 1), "k" * 255
    df = rows(
        [(0, "raw", "A", day, "b1", long + "1", 1, 1, at(0)), (1, "raw", "A", day, "b2", long + "2", 2, None, at(1)),
         (2, "raw", "A", day, "b1", "k" * 254, 3, 3, at(2))],
        schema,
    )
    got = {len(r.s3_key): r for r in H.file_upsert(df, ["n"], key_chars=255).collect()}
    assert set(got) == {256, 254}
    # an overwrite with no row count overwrites it with none
    assert (got[256].s3_bucket, got[256].file_size_bytes, got[256].row_count) == ("b1", 2, None)


def test_defaults(rows):
    df = rows([(None, None, at(0), None), (3, "failed", at(0), at(1))], "n int, status string, c timestamp_ntz, u timestamp_ntz")
    got = H.with_defaults(df, {"n": 0, "status": "pending"}, "c", "u").collect()
    assert [tuple(r) for r in got] == [(0, "pending", at(0), at(0)), (3, "failed", at(0), at(1))]


def test_tickers_json(spark):
    row = spark.range(1).select(H.tickers_to_json(F.array(F.lit("A"), F.lit("B"))).alias("j"))
    assert row.select("j", H.tickers_from_json(F.col("j")).alias("a")).collect()[0] == ('["A","B"]', ["A", "B"])


CRAWL = "id bigint, ticker string, crawl_date date, article_count int, status string, created_at timestamp_ntz"
DAY = dt.date(2024, 1, 1)


def test_reports(rows):
    df = rows(
        [(1, "A", DAY, 3, "success", at(0)), (2, "A", DAY, 4, "failed", at(1)), (3, "B", DAY, 0, "running", at(2))], CRAWL
    )
    a = S.ticker_stats_one(df, "A").collect()
    assert [(r.total_crawl_days, r.total_articles, r.avg_articles_per_day, r.success_count, r.failed_count) for r in a] == [(1, 7, 3.5, 1, 1)]
    assert S.ticker_stats_one(df, "none").count() == 0
    assert [r.latest_date for r in S.latest_crawl_date(df, "A").collect()] == [DAY]
    assert [r.latest_date for r in S.latest_crawl_date(df, "B").collect()] == [None]
    assert [r.latest_date for r in S.latest_crawl_date(df, "none").collect()] == [None]


def test_latest_runs_like_the_plain_join(rows):
    crawls = [(i, "A", DAY, i, "success", at(i % 7)) for i in range(60)]
    analyses = [(i % 25, 0.5, "success", at(j), j) for i in range(25) for j in range((i * 3) % 11)]
    analyses += [(6, 0.1, "failed", at(1), 100 + j) for j in range(200)]
    c = rows(crawls, CRAWL)
    a = rows(analyses, "crawling_history_id bigint, sentiment_avg double, status string, created_at timestamp_ntz, n int")
    got = S.latest_runs(c, a, [F.col("created_at"), F.col("n")], limit=30).collect()
    joined = []
    for crawl in crawls:
        mine = [x for x in analyses if x[0] == crawl[0]]
        joined += [(crawl, x) for x in mine] or [(crawl, None)]
    joined.sort(key=lambda p: (-p[0][5].minute, p[0][0], (p[1][3], p[1][4]) if p[1] else (at(59), 0)))
    want = [(p[0][3], p[1][2] if p[1] else None, p[1][3] if p[1] else None) for p in joined[:30]]
    assert [(r.article_count, r.analysis_status, r.analysis_time) for r in got] == want


@pytest.mark.parametrize(
    "parts, status",
    [
        (["running", "failed"], "running"), (["success", "success"], "success"), (["failed"], "failed"),
        (["pending", "pending"], "pending"), (["success", "failed"], "partial"), (["success", "pending"], "partial"),
    ],
)
def test_run_status(rows, parts, status):
    df = rows([("r", p) for p in parts], "run_id string, status string")
    assert S.run_status(df).collect()[0].run_status == status


def test_orphans_and_violations(rows):
    children = rows([(1, "x"), (2, "y"), (None, "z")], "crawling_history_id bigint, v string")
    parents = rows([(1,)], "id bigint")
    got = S.set_null_orphans(children, parents, "crawling_history_id").collect()
    assert {(r.crawling_history_id, r.v) for r in got} == {(1, "x"), (None, "y"), (None, "z")}
    df = rows([("r", "odd"), ("r", "success"), (None, "failed")], "run_id string, status string")
    assert S.constraint_violations(df, lengths={"status": 6}).count() == 1
    bad = {(r.rule, r.key): r.violations for r in S.status_violations(df, required=["run_id"], unique=[["run_id"]]).collect()}
    assert bad == {("domain:status", "odd"): 1, ("required:run_id", ""): 1, ("unique:run_id", "r"): 2}


def test_sentiment_stats(rows):
    df = rows(
        [("A", DAY, "positive"), ("A", DAY, "negative"), ("A", DAY, "positive"), ("A", DAY, None), ("B", DAY, "unknown")],
        "ticker string, date date, sentiment string",
    )
    got = {r.ticker: r for r in S.sentiment_stats(df).collect()}
    assert got["A"].sentiment_avg == decimal.Decimal("0.3333")
    assert got["A"].sentiment_positive_ratio == decimal.Decimal("0.6667")
    assert got["B"].sentiment_avg == 0


def test_store(spark, tmp_path, rows):
    store = HistoryStore(spark, path=str(tmp_path))
    assert store.read("crawling_history").count() == 0
    row = (1, "r", "A", DAY, 2, None, "running", None, None, None, None, None)
    from newsflow.schemas import CRAWLING_HISTORY

    store.append("crawling_history", rows([row], CRAWLING_HISTORY))
    store.append("crawling_history", rows([row], CRAWLING_HISTORY))
    assert store.read("crawling_history").count() == 2
    with pytest.raises(KeyError):
        store.append("other", rows([row], CRAWLING_HISTORY))
    with pytest.raises(ValueError):
        HistoryStore(spark)


def test_dag_runs_finish_only_what_was_started(rows):
    schema = "n int, run_id string, dag_id string, execution_date date, tickers string, status string, total_articles int, error_message string, changed_at timestamp_ntz"
    day = dt.date(2024, 1, 1)
    log = [
        (0, "a", "d1", day, "[1]", "running", None, None, at(0)), (1, "a", None, None, None, "failed", None, "bad", at(1)),
        (2, "a", "d2", day, "[2]", "running", None, None, at(2)), (3, "a", None, None, None, "success", 7, None, at(3)),
        (4, "unknown", None, None, None, "success", 9, None, at(4)),
        (5, "late", None, None, None, "failed", None, "early", at(5)), (6, "late", "d3", day, "[3]", "running", None, None, at(6)),
    ]
    got = {r.run_id: r for r in H.dag_run_state(rows(log, schema), ["n"]).collect()}
    assert set(got) == {"a", "late"}
    a, late = got["a"], got["late"]
    assert (a.dag_id, a.tickers, a.status, a.total_articles, a.error_message) == ("d1", "[1]", "success", 7, "bad")
    assert (a.started_at, a.completed_at) == (at(2), at(3))
    assert (late.status, late.error_message, late.completed_at, late.started_at) == ("running", None, None, at(6))
    kept = H.run_upsert(rows([(0, "a", "d", day, "t", "running", at(0)), (1, "a", None, None, None, "success", None)],
        "n int, run_id string, dag_id string, execution_date date, tickers string, status string, started_at timestamp_ntz"), ["n"]).collect()
    assert [(r.status, r.started_at, r.dag_id) for r in kept] == [("success", at(0), "d")]
