"""Reports that are kept up batch by batch, from partial states instead of all history.

A state has one row per key and stretch of days: sums and counts, the last dates, and an
exact bitmap of the days seen. States of batches merge by adding, by taking the later date
and by joining the bitmaps, so a day that several batches know counts once. A batch's state
is stored under the batch's name and replaced when the batch is run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow.sources.landing import read_landed, write_partitions

#: Figures that add up.
SUMS = ("articles", "counted", "success_count", "failed_count")


def report_state(
    history: DataFrame,
    by: str = "ticker",
    date: str = "crawl_date",
    articles: str = "article_count",
    status: str = "status",
) -> DataFrame:
    """``by, stretch, days, articles, counted, success_count, failed_count, last_date,
    last_success`` of a batch of finished rows.

    A stretch is what one bitmap holds, some ninety years; rows without a date have none.
    """
    number = F.unix_date(F.col(date))
    ok = F.col(status) == "success"
    return history.groupBy(F.col(by).alias(by), F.bitmap_bucket_number(number).alias("stretch")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("days"),
        F.sum(F.col(articles).cast("bigint")).alias("articles"),
        F.count(F.col(articles)).alias("counted"),
        F.count_if(ok).alias("success_count"),
        F.count_if(F.col(status) == "failed").alias("failed_count"),
        F.max(F.col(date)).alias("last_date"),
        F.max(F.when(ok, F.col(date))).alias("last_success"),
    )


def merge_states(states: DataFrame, by: str = "ticker") -> DataFrame:
    """One row per key and stretch out of the states of any number of batches."""
    return states.groupBy(by, "stretch").agg(
        F.bitmap_or_agg("days").alias("days"),
        *[F.sum(c).alias(c) for c in SUMS],
        F.max("last_date").alias("last_date"),
        F.max("last_success").alias("last_success"),
    )


def put_state(state: DataFrame, path: str, batch: str) -> None:
    """Store the state of a batch; the same batch again replaces what it stored."""
    write_partitions(state.withColumn("batch", F.lit(batch)), path, "overwrite", ["batch"])


def stored_states(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The states of all batches; ``like`` is a state of the same kind."""
    return read_landed(spark, path, like.withColumn("batch", F.lit("")).schema).drop("batch")


def ticker_stats_of(states: DataFrame, by: str = "ticker") -> DataFrame:
    """The report of ``stats.ticker_stats`` from states."""
    merged = merge_states(states, by)
    days = F.when(F.col("stretch").isNotNull(), F.bitmap_count("days")).otherwise(0)
    return merged.groupBy(by).agg(
        F.sum(days).alias("total_crawl_days"),
        F.sum("articles").alias("total_articles"),
        F.try_divide(F.sum("articles").cast("double"), F.sum("counted")).alias("avg_articles_per_day"),
        F.max("last_date").alias("last_crawl_date"),
        F.sum("success_count").alias("success_count"),
        F.sum("failed_count").alias("failed_count"),
    )


def latest_crawl_date_of(states: DataFrame, by: str = "ticker") -> DataFrame:
    """The report of ``stats.latest_crawl_date`` of every key."""
    return states.groupBy(by).agg(F.max("last_success").alias("latest_date"))


def run_totals_of(states: DataFrame, by: str = "run_id") -> DataFrame:
    """The report of ``stats.run_totals``; needs no merged bitmaps."""
    return states.groupBy(by).agg(F.sum("articles").alias("total_articles"))
