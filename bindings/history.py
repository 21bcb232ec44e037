"""Run history: reports and upserts over orders, lineitem and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.tables import (
    ANALYSES,
    CRAWLS,
    LINKS,
    analyses,
    big,
    crawls,
    day,
    links,
    second,
    table,
)
from newsflow.operators import folds
from newsflow.operators import history as H
from newsflow.operators import stats as S
from newsflow.operators.folds import advance
from newsflow.operators.report_states import put_state, report_state, stored_states, ticker_stats_of
from newsflow.schemas import FILE_KEY_CHARS, LATEST_RUNS
from newsflow.session import scratch_path


def _stats_out(df):
    return df.select(
        "ticker",
        big("total_crawl_days"),
        big("total_articles"),
        F.round("avg_articles_per_day", 4).alias("avg_articles_per_day"),
        day("last_crawl_date").alias("last_crawl_date"),
        big("success_count"),
        big("failed_count"),
    )


_STATS_SQL = f"""WITH {CRAWLS}
SELECT ticker, count(DISTINCT crawl_date) AS total_crawl_days,
       CAST(sum(article_count) AS BIGINT) AS total_articles,
       round(avg(article_count), 4) AS avg_articles_per_day,
       strftime(max(crawl_date), '%Y-%m-%d') AS last_crawl_date,
       count(CASE WHEN status = 'success' THEN 1 END) AS success_count,
       count(CASE WHEN status = 'failed' THEN 1 END) AS failed_count
FROM crawls {{where}} GROUP BY ticker"""


def ticker_stats(spark, sf_dir):
    return _stats_out(S.ticker_stats(crawls(spark, sf_dir)))


def ticker_stats_kept(spark, sf_dir):
    """Crawls come in three batches that share their days; one batch is run twice."""
    path = scratch_path(spark, "states")
    for part in (0, 1, 2, 1):
        state = report_state(crawls(spark, sf_dir).filter(F.col("id") % 3 == part))
        put_state(state, path, f"batch-{part}")
    return _stats_out(ticker_stats_of(stored_states(spark, path, state)))


def ticker_stats_one(spark, sf_dir):
    return _stats_out(S.ticker_stats_one(crawls(spark, sf_dir), "1-URGENT"))


def latest_crawl_date(spark, sf_dir):
    return S.latest_crawl_date(crawls(spark, sf_dir)).select(
        "ticker", day("latest_date").alias("latest_date")
    )


def latest_crawl_date_one(spark, sf_dir):
    return S.latest_crawl_date(crawls(spark, sf_dir), "1-URGENT").select(
        day("latest_date").alias("latest_date")
    )


def latest_runs(spark, sf_dir):
    tie = [F.col("created_at"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")]
    runs = S.latest_runs(crawls(spark, sf_dir), analyses(spark, sf_dir), tie, LATEST_RUNS)
    return runs.select(
        "ticker",
        day("crawl_date").alias("crawl_date"),
        big("article_count"),
        "crawl_status",
        "sentiment_avg",
        "analysis_status",
        second("crawl_time").alias("crawl_time"),
        second("analysis_time").alias("analysis_time"),
    )


def fk_set_null(spark, sf_dir):
    parents = crawls(spark, sf_dir).filter(F.col("status") == "success")
    children = analyses(spark, sf_dir)
    return S.set_null_orphans(children, parents, "crawling_history_id").select(
        "crawling_history_id", "l_partkey", "l_suppkey", big("l_linenumber")
    )


def run_totals(spark, sf_dir):
    return S.run_totals(crawls(spark, sf_dir))


def run_status(spark, sf_dir):
    return S.run_status(crawls(spark, sf_dir))


def constraint_violations(spark, sf_dir):
    return S.constraint_violations(
        crawls(spark, sf_dir),
        domains={"status": ("pending", "success", "failed")},
        required=("run_id", "ticker", "crawl_date"),
        unique=(("id",), ("ticker", "crawl_date")),
    )


def _run_starts(spark, sf_dir):
    return links(spark, sf_dir).select(
        F.concat_ws("-", "ticker", "pos").alias("run_id"), "ticker", "date", "ts"
    )


def history_start(spark, sf_dir):
    started = H.start_records(_run_starts(spark, sf_dir), F.col("ts"))
    return started.select(
        "run_id", "ticker", day("date").alias("date"), "status", second("started_at").alias("started_at")
    )


def _history_log(spark, sf_dir):
    """Every event is a change: signups and views start a run, the others finish it."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"), "event_id", "event_type", "props",
        F.floor("value").alias("value"), "ts",
    )
    kind = F.col("event_type")
    starts = H.start_records(
        events.filter(kind.isin("signup", "view")).select("run_id", "event_id", "props", "ts"), F.col("ts"), ["run_id"]
    ).withColumnRenamed("started_at", "changed_at")
    done = kind.isin("purchase", "click")
    ends = H.finish_records(
        events.filter(~kind.isin("signup", "view")).select(
            "run_id", "event_id", "ts", F.when(done, F.col("value")).alias("article_count"),
            F.when(~done, F.concat(F.lit("e"), F.col("value").cast("string"))).alias("error_message"),
            done.alias("done"),
        ),
        F.col("ts"), F.when(F.col("done"), "success").otherwise("failed"), ["run_id"],
    ).withColumnRenamed("completed_at", "changed_at").drop("done")
    return starts.unionByName(ends, allowMissingColumns=True)


_HISTORY = (["changed_at", "event_id"], ["run_id", "props"], ["article_count", "error_message"])


def _shown_history(state):
    times = {c: second(c) for c in ("started_at", "completed_at", "created_at", "updated_at")}
    return state.drop("id").withColumns(times)


_CHANGES = """log AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, ts AS changed_at, (ts, event_id) AS ord, event_type, props, event_id,
         CASE WHEN event_type IN ('signup', 'view') THEN 'running'
              WHEN event_type IN ('purchase', 'click') THEN 'success' ELSE 'failed' END AS status,
         CASE WHEN event_type IN ('purchase', 'click') THEN CAST(floor(value) AS BIGINT) END AS article_count,
         CASE WHEN event_type = 'error' THEN 'e' || CAST(floor(value) AS BIGINT) END AS error_message
  FROM events)"""
_HISTORY_STATE = f"""WITH {_CHANGES}
SELECT run_id, arg_min(props, ord) FILTER (status = 'running') AS props,
       arg_max(article_count, ord) FILTER (article_count IS NOT NULL) AS article_count,
       arg_max(error_message, ord) FILTER (error_message IS NOT NULL) AS error_message,
       arg_max(status, ord) AS status,
       strftime(max(changed_at) FILTER (status = 'running'), '%Y-%m-%d %H:%M:%S.%f') AS started_at,
       strftime(arg_max(changed_at, ord) FILTER (status <> 'running'), '%Y-%m-%d %H:%M:%S.%f') AS completed_at,
       strftime(min(changed_at), '%Y-%m-%d %H:%M:%S.%f') AS created_at,
       strftime(max(changed_at), '%Y-%m-%d %H:%M:%S.%f') AS updated_at
FROM log GROUP BY run_id HAVING bool_or(status = 'running')"""


def history_state(spark, sf_dir):
    return _shown_history(H.history_state(_history_log(spark, sf_dir), *_HISTORY))


def _in_three(spark, log, by, fold):
    """The log comes in three parts, each with early and late changes, and the first part
    comes once more at the end."""
    path = scratch_path(spark, "state")
    for part in (2, 0, 1, 2):
        state = advance(spark, path, fold, log.filter(by % 3 == part))
    return fold.result(state)


def history_folded(spark, sf_dir):
    return _shown_history(_in_three(spark, _history_log(spark, sf_dir), F.col("event_id"), folds.history_fold(*_HISTORY)))


def _run_log(spark, sf_dir):
    """Runs of two users each: starts, successes, failures, and finishes before any start."""
    kind = F.col("event_type")
    started, done = kind.isin("signup", "view"), kind.isin("purchase", "click")
    return table(spark, sf_dir, "events").select(
        F.floor(F.col("user_id") / 2).alias("run_id"),
        "event_id",
        F.when(started, kind).alias("dag_id"),
        F.when(started, F.to_date("ts")).alias("execution_date"),
        F.when(started, F.col("props")).alias("tickers"),
        F.when(started, "running").when(done, "success").otherwise("failed").alias("status"),
        F.when(done, F.floor("value")).alias("total_articles"),
        F.when(kind == "error", F.concat(F.lit("e"), F.floor("value").cast("string"))).alias("error_message"),
        F.col("ts").alias("changed_at"),
    )


def _shown_runs(runs):
    return runs.withColumns(
        {"execution_date": day("execution_date"), "started_at": second("started_at"), "completed_at": second("completed_at")}
    )


def dag_run_state(spark, sf_dir):
    return _shown_runs(H.dag_run_state(_run_log(spark, sf_dir), ["changed_at", "event_id"]))


def dag_run_folded(spark, sf_dir):
    return _shown_runs(_in_three(spark, _run_log(spark, sf_dir), F.col("event_id"), folds.dag_run_fold(["changed_at", "event_id"])))


_DAG_RUNS = f"""WITH {_CHANGES},
runs AS (SELECT CAST(run_id AS BIGINT) // 2 AS run_id, * EXCLUDE (run_id) FROM log),
first AS (SELECT run_id, min(ord) AS f FROM runs WHERE status = 'running' GROUP BY run_id),
valid AS (SELECT runs.* FROM runs JOIN first USING (run_id) WHERE ord >= f)
SELECT run_id, arg_min(event_type, ord) AS dag_id, strftime(arg_min(CAST(changed_at AS DATE), ord), '%Y-%m-%d') AS execution_date,
       arg_min(props, ord) AS tickers, arg_max(status, ord) AS status,
       arg_max(article_count, ord) FILTER (article_count IS NOT NULL) AS total_articles,
       arg_max(error_message, ord) FILTER (error_message IS NOT NULL) AS error_message,
       strftime(arg_max(changed_at, ord) FILTER (status = 'running'), '%Y-%m-%d %H:%M:%S.%f') AS started_at,
       strftime(arg_max(changed_at, ord) FILTER (status <> 'running'), '%Y-%m-%d %H:%M:%S.%f') AS completed_at
FROM valid GROUP BY run_id"""


def run_upsert(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        "event_id",
        F.col("event_type").alias("dag_id"),
        F.to_date("ts").alias("execution_date"),
        F.col("props").alias("tickers"),
        F.concat(F.lit("s-"), "event_type").alias("status"),
        F.col("ts").alias("started_at"),
    )
    runs = H.run_upsert(log, ["started_at", "event_id"])
    return runs.withColumns(
        {"execution_date": day("execution_date"), "started_at": second("started_at")}
    )


_FILE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _file_log(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *_FILE_ORDER,
        F.when(F.col("l_returnflag") == "R", "raw").otherwise("result").alias("file_type"),
        F.col("l_linestatus").alias("ticker"),
        F.to_date("l_shipdate").alias("file_date"),
        F.lit("bucket").alias("s3_bucket"),
        F.concat(
            F.lit("raw/"), F.col("l_linenumber").cast("string"), F.repeat(F.lit("x"), 250),
            F.col("l_partkey").cast("string"),
        ).alias("s3_key"),
        F.col("l_partkey").alias("file_size_bytes"),
        F.col("l_quantity").cast("bigint").alias("row_count"),
        F.col("l_suppkey").alias("uploaded_at"),
    )


def file_upsert(spark, sf_dir):
    return H.file_upsert(_file_log(spark, sf_dir), _FILE_ORDER, key_chars=FILE_KEY_CHARS).withColumn("file_date", day("file_date"))


def file_folded(spark, sf_dir):
    fold = folds.file_fold(_FILE_ORDER, key_chars=FILE_KEY_CHARS)
    return _in_three(spark, _file_log(spark, sf_dir), F.col("l_orderkey"), fold).withColumn("file_date", day("file_date"))


_FILE_UPSERT = """WITH log AS (
  SELECT (l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ord,
         CASE WHEN l_returnflag = 'R' THEN 'raw' ELSE 'result' END AS file_type,
         l_linestatus AS ticker, CAST(l_shipdate AS DATE) AS file_date, 'bucket' AS s3_bucket,
         'raw/' || l_linenumber || repeat('x', 250) || l_partkey AS s3_key,
         l_partkey AS file_size_bytes, CAST(l_quantity AS BIGINT) AS row_count, l_suppkey AS uploaded_at
  FROM lineitem)
SELECT file_type, ticker, strftime(file_date, '%Y-%m-%d') AS file_date,
       arg_min(s3_bucket, ord) AS s3_bucket, arg_min(s3_key, ord) AS s3_key,
       arg_max(file_size_bytes, ord) AS file_size_bytes, arg_max(row_count, ord) AS row_count,
       arg_max(uploaded_at, ord) AS uploaded_at
FROM log GROUP BY file_type, ticker, log.file_date, substr(s3_key, 1, 255)"""


def history_defaults(spark, sf_dir):
    joined = crawls(spark, sf_dir).join(
        analyses(spark, sf_dir).select(
            F.col("crawling_history_id").alias("id"),
            F.col("l_linenumber").cast("bigint").alias("keyword_count"),
            F.col("status").alias("analysis_status"),
            F.col("created_at").alias("updated_at"),
            "l_partkey",
        ),
        "id",
        "left",
    )
    filled = H.with_defaults(
        joined, {"keyword_count": 0, "analysis_status": "pending"}, "created_at", "updated_at"
    )
    return filled.select(
        "id", "l_partkey", big("keyword_count"), "analysis_status",
        second("created_at").alias("created_at"), second("updated_at").alias("updated_at"),
    )


def json_props(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    pair = H.tickers_to_json(F.array(F.col("user_id").cast("string"), F.col("event_type")))
    return rows.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        pair.alias("tickers"),
        F.array_join(H.tickers_from_json(pair), "+").alias("back"),
    )


QUERIES = {
    "ticker_stats": (ticker_stats, _STATS_SQL.format(where="")),
    "ticker_stats_kept": (ticker_stats_kept, _STATS_SQL.format(where="")),
    "ticker_stats_one": (ticker_stats_one, _STATS_SQL.format(where="WHERE ticker = '1-URGENT'")),
    "latest_crawl_date": (
        latest_crawl_date,
        f"""WITH {CRAWLS} SELECT ticker,
        strftime(max(CASE WHEN status = 'success' THEN crawl_date END), '%Y-%m-%d') AS latest_date
        FROM crawls GROUP BY ticker""",
    ),
    "latest_crawl_date_one": (
        latest_crawl_date_one,
        f"""WITH {CRAWLS} SELECT strftime(max(crawl_date), '%Y-%m-%d') AS latest_date
        FROM crawls WHERE ticker = '1-URGENT' AND status = 'success'""",
    ),
    "latest_runs": (
        latest_runs,
        f"""WITH {CRAWLS}, {ANALYSES}
        SELECT c.ticker, strftime(c.crawl_date, '%Y-%m-%d') AS crawl_date, c.article_count,
               c.status AS crawl_status, a.sentiment_avg, a.status AS analysis_status,
               strftime(c.created_at, '%Y-%m-%d %H:%M:%S.%f') AS crawl_time,
               strftime(a.created_at, '%Y-%m-%d %H:%M:%S.%f') AS analysis_time
        FROM crawls c LEFT JOIN analyses a ON c.id = a.crawling_history_id
        ORDER BY c.created_at DESC, c.id, a.created_at NULLS LAST, a.l_partkey NULLS LAST,
                 a.l_suppkey NULLS LAST, a.l_linenumber NULLS LAST
        LIMIT 100""",
    ),
    "fk_set_null": (
        fk_set_null,
        """SELECT o_orderkey AS crawling_history_id, l_partkey, l_suppkey,
                  CAST(l_linenumber AS BIGINT) AS l_linenumber
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'F'""",
    ),
    "run_totals": (
        run_totals,
        f"""WITH {CRAWLS} SELECT run_id, CAST(sum(article_count) AS BIGINT) AS total_articles
        FROM crawls GROUP BY run_id""",
    ),
    "run_status": (
        run_status,
        f"""WITH {CRAWLS} SELECT run_id,
          CASE WHEN bool_or(status = 'running') THEN 'running'
               WHEN bool_and(status = 'success') THEN 'success'
               WHEN bool_and(status = 'failed') THEN 'failed'
               WHEN bool_and(status = 'pending') THEN 'pending'
               ELSE 'partial' END AS run_status
        FROM crawls GROUP BY run_id""",
    ),
    "constraint_violations": (
        constraint_violations,
        f"""WITH {CRAWLS}
        SELECT 'domain:status' AS rule, status AS key, count(*) AS violations FROM crawls
        WHERE status NOT IN ('pending', 'success', 'failed') GROUP BY status
        UNION ALL
        SELECT 'unique:id', CAST(id AS VARCHAR), count(*) FROM crawls GROUP BY id HAVING count(*) > 1
        UNION ALL
        SELECT 'unique:ticker,crawl_date', ticker || '|' || strftime(crawl_date, '%Y-%m-%d'), count(*)
        FROM crawls GROUP BY ticker, crawl_date HAVING count(*) > 1""",
    ),
    "history_start": (
        history_start,
        f"""WITH {LINKS} SELECT ticker || '-' || pos AS run_id, ticker,
               strftime(date, '%Y-%m-%d') AS date, 'running' AS status,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS started_at
        FROM links""",
    ),
    "history_state": (history_state, _HISTORY_STATE),
    "history_folded": (history_folded, _HISTORY_STATE),
    "dag_run_state": (dag_run_state, _DAG_RUNS),
    "dag_run_folded": (dag_run_folded, _DAG_RUNS),
    "file_folded": (file_folded, _FILE_UPSERT),
    "run_upsert": (
        run_upsert,
        """SELECT user_id AS run_id, arg_min(event_type, (ts, event_id)) AS dag_id,
               strftime(arg_min(CAST(ts AS DATE), (ts, event_id)), '%Y-%m-%d') AS execution_date,
               arg_min(props, (ts, event_id)) AS tickers,
               's-' || arg_max(event_type, (ts, event_id)) AS status,
               strftime(arg_max(ts, (ts, event_id)), '%Y-%m-%d %H:%M:%S.%f') AS started_at
        FROM events GROUP BY user_id""",
    ),
    "file_upsert": (file_upsert, _FILE_UPSERT),
    "history_defaults": (
        history_defaults,
        f"""WITH {CRAWLS}, {ANALYSES}
        SELECT c.id, a.l_partkey, coalesce(CAST(a.l_linenumber AS BIGINT), 0) AS keyword_count,
               coalesce(a.status, 'pending') AS analysis_status,
               strftime(c.created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
               strftime(coalesce(a.created_at, c.created_at), '%Y-%m-%d %H:%M:%S.%f') AS updated_at
        FROM crawls c LEFT JOIN analyses a ON c.id = a.crawling_history_id""",
    ),
    "json_props": (
        json_props,
        """SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k,
               '["' || user_id || '","' || event_type || '"]' AS tickers,
               user_id || '+' || event_type AS back
        FROM events""",
    ),
}
