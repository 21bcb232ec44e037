"""Reports over the run history and over results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsflow.functions.text import unnest
from newsflow.operators.ranking import first_n_per_key
from newsflow.schemas import DAG_STATUSES


# latest_runs broadcasts at most the square of this many rows.
BROADCAST_LIMIT = 200


def ticker_stats(
    history: DataFrame,
    ticker: str = "ticker",
    date: str = "crawl_date",
    articles: str = "article_count",
    status: str = "status",
) -> DataFrame:
    """Days, articles, last date and outcome counts of every ticker.

    The distinct count goes over (ticker, date) first, so a hot ticker is spread by date.
    """
    return history.groupBy(F.col(ticker).alias("ticker")).agg(
        F.count_distinct(F.col(date)).alias("total_crawl_days"),
        F.sum(F.col(articles)).alias("total_articles"),
        F.avg(F.col(articles)).alias("avg_articles_per_day"),
        F.max(F.col(date)).alias("last_crawl_date"),
        F.count_if(F.col(status) == "success").alias("success_count"),
        F.count_if(F.col(status) == "failed").alias("failed_count"),
    )


def ticker_stats_one(history: DataFrame, ticker: str, **columns: str) -> DataFrame:
    """The row of one ticker; none for an unknown ticker."""
    return ticker_stats(history, **columns).filter(F.col("ticker") == ticker)


def latest_crawl_date(
    history: DataFrame,
    ticker: str | None = None,
    by: str = "ticker",
    date: str = "crawl_date",
    status: str = "status",
) -> DataFrame:
    """Last successful date: of one ticker (one row, null if none), or of each ticker."""
    last = F.max(F.when(F.col(status) == "success", F.col(date))).alias("latest_date")
    if ticker is not None:
        return history.filter(F.col(by) == ticker).agg(last)
    return history.groupBy(F.col(by).alias("ticker")).agg(last)


def latest_runs(
    crawls: DataFrame,
    analyses: DataFrame,
    tie_break: Sequence[Column],
    limit: int | None = None,
) -> DataFrame:
    """Newest crawls with their analyses; ``tie_break`` orders analyses. All of them, or
    the first ``limit`` rows (the stored report shows ``LATEST_RUNS``).

    A left join keeps every crawl, so the first ``limit`` result rows belong to the first
    ``limit`` crawls, and no crawl shows more than ``limit`` analyses. Both cuts are made
    before the join: at most ``limit`` crawls and ``limit`` squared analyses take part,
    and neither table is shuffled as a whole. For a usual limit that bound is small
    enough to broadcast.
    """
    bounded = F.broadcast if limit is not None and limit <= BROADCAST_LIMIT else lambda df: df
    newest = crawls.select("id", "ticker", "crawl_date", "article_count", "status", "created_at")
    matched = analyses.withColumn("_order", F.struct(*tie_break))
    if limit is not None:
        newest = newest.orderBy(F.desc("created_at"), F.col("id")).limit(limit)
        ids = bounded(newest.select(F.col("id").alias("crawling_history_id")))
        matched = matched.join(ids, "crawling_history_id", "left_semi")
        matched = first_n_per_key(matched, ["crawling_history_id"], [F.col("_order")], limit)
    few = matched.select(
        "crawling_history_id",
        "sentiment_avg",
        F.col("status").alias("analysis_status"),
        F.col("created_at").alias("analysis_time"),
        "_order",
    )
    shown = newest.join(bounded(few), newest["id"] == few["crawling_history_id"], "left").orderBy(
        F.desc("created_at"), F.col("id"), F.col("_order").asc_nulls_last()
    )
    return (shown if limit is None else shown.limit(limit)).select(
        "ticker",
        "crawl_date",
        "article_count",
        F.col("status").alias("crawl_status"),
        "sentiment_avg",
        "analysis_status",
        F.col("created_at").alias("crawl_time"),
        "analysis_time",
    )


def set_null_orphans(
    children: DataFrame, parents: DataFrame, child_key: str, parent_key: str = "id"
) -> DataFrame:
    """Null the reference of child rows whose parent is gone.

    One row per parent id on the right; a hot parent's children on the left are split at
    run time.
    """
    ids = parents.select(F.col(parent_key).alias("_parent")).distinct()
    joined = children.join(ids, children[child_key] == ids["_parent"], "left")
    return joined.withColumn(child_key, F.col("_parent")).drop("_parent")


def run_totals(history: DataFrame, run: str = "run_id", articles: str = "article_count") -> DataFrame:
    return history.groupBy(run).agg(F.sum(F.col(articles)).alias("total_articles"))


def run_status(history: DataFrame, run: str = "run_id", status: str = "status") -> DataFrame:
    """Status of a run from the statuses of its parts."""
    s = F.col(status)
    rolled = (
        F.when(F.bool_or(s == "running"), "running")
        .when(F.bool_and(s == "success"), "success")
        .when(F.bool_and(s == "failed"), "failed")
        .when(F.bool_and(s == "pending"), "pending")
        .otherwise("partial")
    )
    return history.groupBy(run).agg(rolled.alias("run_status"))


def constraint_violations(
    df: DataFrame,
    domains: dict[str, Sequence[str]] | None = None,
    required: Sequence[str] = (),
    lengths: dict[str, int] | None = None,
    unique: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """``(rule, key, violations)`` for values outside a domain, nulls, texts that are too
    long and repeated keys."""
    checks = {}
    for column, allowed in (domains or {}).items():
        checks[f"domain:{column}"] = (~F.col(column).isin(list(allowed)), F.col(column))
    for column in required:
        checks[f"required:{column}"] = (F.col(column).isNull(), F.lit(""))
    for column, most in (lengths or {}).items():
        checks[f"length:{column}"] = (F.length(column) > most, F.col(column))
    parts = []
    if checks:
        # One scan for all row rules: a row yields one entry per rule it breaks.
        hits = F.array_compact(
            F.array(
                *[
                    F.when(bad, F.struct(F.lit(rule).alias("rule"), key.cast("string").alias("key")))
                    for rule, (bad, key) in checks.items()
                ]
            )
        )
        parts.append(
            unnest(df, hits)
            .groupBy(F.col("_item.rule").alias("rule"), F.col("_item.key").alias("key"))
            .agg(F.count(F.lit(1)).alias("violations"))
        )
    for keys in unique:
        name = ",".join(keys)
        parts.append(
            df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("violations"))
            .filter(F.col("violations") > 1)
            .select(
                F.lit(f"unique:{name}").alias("rule"),
                F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"),
                "violations",
            )
        )
    if not parts:
        raise ValueError("no rule given")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def status_violations(history: DataFrame, **rules) -> DataFrame:
    return constraint_violations(history, {"status": DAG_STATUSES}, **rules)


def articles_per_day(rows: DataFrame, keys: Sequence[str] = ("ticker", "date")) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("articles"))


def sentiment_stats(
    rows: DataFrame, keys: Sequence[str] = ("ticker", "date"), label: str = "sentiment"
) -> DataFrame:
    """Average score and label shares per partition, over its labelled rows."""
    scored = F.col(label).isin("positive", "negative", "neutral")

    def share(value: str) -> Column:
        return F.avg(F.when(scored, (F.col(label) == value).cast("int")))

    score = F.avg(
        F.when(F.col(label) == "positive", 1)
        .when(F.col(label) == "negative", -1)
        .when(F.col(label) == "neutral", 0)
    )
    fit = lambda c: F.coalesce(c, F.lit(0.0)).cast("decimal(5,4)")
    return rows.groupBy(*keys).agg(
        fit(score).alias("sentiment_avg"),
        fit(share("positive")).alias("sentiment_positive_ratio"),
        fit(share("negative")).alias("sentiment_negative_ratio"),
        fit(share("neutral")).alias("sentiment_neutral_ratio"),
    )


def results_with_articles(
    results: DataFrame, articles: DataFrame, keys: Sequence[str] = ("ticker", "date", "url"), columns: Sequence[str] = ("content",)
) -> DataFrame:
    """Results with columns of the article they were made from; results without one are left out."""
    return results.join(articles.select(*keys, *columns), list(keys))


def keyword_count(
    rows: DataFrame,
    keys: Sequence[str] = ("ticker", "date"),
    keywords: str = "keywords",
    distinct: bool = False,
) -> DataFrame:
    """Keywords per partition: all of them, or different ones, of an array column."""
    if distinct:
        words = rows.select(*keys, F.explode_outer(keywords).alias("_word"))
        return words.groupBy(*keys).agg(F.count_distinct("_word").alias("keyword_count"))
    total = F.sum(F.coalesce(F.array_size(keywords), F.lit(0)))
    return rows.groupBy(*keys).agg(total.alias("keyword_count"))


def keyword_counts(
    rows: DataFrame, keys: Sequence[str] = ("ticker", "date"), keywords: str = "keywords"
) -> DataFrame:
    """``keywords`` and ``different`` per partition from one pass over the rows: counts per
    word first, so that a busy partition is folded before it meets in one task."""
    words = rows.select(*keys, F.explode_outer(keywords).alias("_word"))
    per_word = words.groupBy(*keys, "_word").agg(F.count("_word").alias("_n"))
    return per_word.groupBy(*keys).agg(F.sum("_n").alias("keywords"), F.count("_word").alias("different"))
