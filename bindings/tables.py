"""Driver tables in the shape the operators expect, in Spark and in SQL.

Dates and times leave a query as text, counts as bigint, so that both engines hand over
the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AS_OF = "2024-01-30"
NEWS_HOST = "https://finance.yahoo.com/news/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def second(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def big(c: str) -> Column:
    return F.col(c).cast("bigint").alias(c)


def _status(c: str) -> Column:
    return F.when(F.col(c) == "F", "success").when(F.col(c) == "P", "failed").otherwise("running")


def crawls(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("ticker"),
        F.to_date("o_orderdate").alias("crawl_date"),
        (F.col("o_custkey") % 50).cast("int").alias("article_count"),
        _status("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


CRAWLS = """crawls AS (
  SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS run_id, o_orderpriority AS ticker,
         CAST(o_orderdate AS DATE) AS crawl_date, o_custkey % 50 AS article_count,
         CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'running' END AS status,
         o_orderdate AS created_at
  FROM orders)"""


def analyses(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("crawling_history_id"),
        F.col("l_discount").alias("sentiment_avg"),
        _status("l_linestatus").alias("status"),
        F.col("l_shipdate").alias("created_at"),
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
    )


ANALYSES = """analyses AS (
  SELECT l_orderkey AS crawling_history_id, l_discount AS sentiment_avg,
         CASE l_linestatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'running' END AS status,
         l_shipdate AS created_at, l_partkey, l_suppkey, l_linenumber
  FROM lineitem)"""


def news(spark, sf_dir) -> DataFrame:
    """Documents as raw news: one ticker per source, thirty days."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("ticker"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("date"),
        F.concat(F.lit(NEWS_HOST), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("content"),
        F.col("doc_id").alias("pos"),
        "doc_id",
        "lang",
        "n_chars",
    )


NEWS = f"""news AS (
  SELECT source AS ticker, CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS date,
         '{NEWS_HOST}' || doc_id AS url, text AS content, doc_id AS pos, doc_id, lang, n_chars
  FROM documents)"""


def links(spark, sf_dir) -> DataFrame:
    """Events as links of a ticker and day."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("ticker"),
        F.to_date("ts").alias("date"),
        F.concat_ws("/", "event_type", F.floor("value").cast("string")).alias("url"),
        F.col("event_id").alias("pos"),
        "event_type",
        "ts",
    )


LINKS = """links AS (
  SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date,
         event_type || '/' || CAST(floor(value) AS BIGINT) AS url,
         event_id AS pos, event_type, ts
  FROM events)"""


def labelled(spark, sf_dir) -> DataFrame:
    """A sentiment label for every labelled document."""
    return table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .otherwise("neutral")
        .alias("sentiment"),
    )


LABELLED = """labelled AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
                 ELSE 'neutral' END AS sentiment
  FROM labels)"""


def sql_chars(chars: str) -> str:
    return "(" + " || ".join(f"chr({ord(c)})" for c in chars) + ")"
