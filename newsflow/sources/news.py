"""Reading landed news and results, with the catalog of their partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsflow.functions.text import strip
from newsflow.operators.ranking import first_n_per_key
from newsflow.schemas import LANDING_ORDER, RAW_PAGES, RESULT_COLUMNS

# ticker and date as the path of one file spells them
LEGACY_RAW_PATH = r"([^/]+)/([^/]+)/news\.(?:csv|parquet)$"
LEGACY_RESULT_PATH = r"([^/]+)/([^/]+)\.csv$"
_CSV = {"header": True, "multiLine": True, "escape": '"', "quote": '"'}


def normalise_news(news: DataFrame, content: str = "content") -> DataFrame:
    """Content stripped; missing, null or non-text content becomes the empty string."""
    kind = dict(news.dtypes).get(content)
    return news.withColumn(content, strip(F.col(content)) if kind == "string" else F.lit(""))


def scan_news(spark: SparkSession, base: str, schema: str | None = None) -> DataFrame:
    """The landed table, partitioned by ticker and date."""
    reader = spark.read.schema(schema) if schema else spark.read
    return normalise_news(reader.parquet(base))


def scan_csv(
    spark: SparkSession, path: str, schema: str | None = None, recursive: bool = False
) -> DataFrame:
    """A CSV table whose texts may hold line breaks and quotes. Without ``schema`` all
    columns are read as text."""
    reader = spark.read.options(**_CSV)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema:
        reader = reader.schema(schema)
    return reader.csv(path)


def with_path_keys(df: DataFrame, pattern: str = LEGACY_RAW_PATH) -> DataFrame:
    """Ticker and date out of the file path, for tables laid out without key columns."""
    path = F.col("_metadata.file_path")
    return df.withColumns(
        {
            "ticker": F.regexp_extract(path, pattern, 1),
            "date": F.regexp_extract(path, pattern, 2).try_cast("date"),
        }
    )


def scan_legacy_news(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """``{base}/{ticker}/{date}/news.csv`` of all tickers and days in one job.

    Path-derived columns do not prune files; land such a base once to get partitions.
    """
    rows = scan_csv(spark, f"{base.rstrip('/')}/*/*/news.csv", schema)
    return normalise_news(with_path_keys(rows))


def scan_legacy_results(spark: SparkSession, base: str) -> DataFrame:
    """``{base}/{ticker}/{date}.csv``: earlier results, which carry no article key."""
    schema = ", ".join(f"{c} string" for c in RESULT_COLUMNS)
    return with_path_keys(scan_csv(spark, f"{base.rstrip('/')}/*/*.csv", schema), LEGACY_RESULT_PATH)


def url_heads(
    news: DataFrame,
    top_n: int,
    keys: tuple[str, ...] = ("ticker", "date"),
    order: tuple[str, ...] = LANDING_ORDER,
) -> DataFrame:
    """First URLs of every partition in landing order, trimmed, without nulls. Only keys,
    URL and the columns of the order are read."""
    order = [c for c in order if c in news.columns]
    urls = news.select(*dict.fromkeys([*keys, "url", *order])).filter(F.col("url").isNotNull())
    heads = first_n_per_key(urls, list(keys), [F.col(c) for c in order], top_n, rank_col="rank", coarse=True)
    return heads.withColumn("url", strip(F.col("url")))


def scan_pages(spark: SparkSession, base: str) -> DataFrame:
    """Fetched pages; columns that a fetcher did not write are null."""
    return spark.read.schema(RAW_PAGES).parquet(base)


def ticker_dates(news: DataFrame, ticker: str = "ticker", date: str | Column = "date") -> DataFrame:
    """Distinct (ticker, date), sorted."""
    day = F.col(date) if isinstance(date, str) else date
    return (
        news.select(F.col(ticker).alias("ticker"), day.alias("date"))
        .distinct()
        .orderBy("ticker", "date")
    )


def tickers(news: DataFrame, ticker: str = "ticker") -> DataFrame:
    return news.select(F.col(ticker).alias("ticker")).distinct()
