"""The ingest as a stream: links and the pages that come in for them, in any order.

Links worth fetching are written to a folder, pages to another as fetchers bring them. The
stream reads both, spreads the pages by a hash of their URL, parses them, and joins them to
the links that wait. A link whose page does not come in time leaves the join without one
when the watermark passes, and becomes a row with its error. Both sides of the join keep
state only for as long as a partner may still come.

A batch lands what left the join. Landing and quarantine add nothing twice, so a batch
that is run again after a failure changes nothing. Of several fetches of a URL within a
batch one is chosen as in the batch ingest; among batches the first that lands stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsflow.operators.pages import to_articles
from newsflow.plans.ingest import article_rows, one_article_per_url
from newsflow.schemas import LOCAL_ZONE, RAW_PAGES
from newsflow.session import Scratch
from newsflow.sources.landing import land_by_date
from newsflow.streaming.appending import rocks_state

LINKS = "ticker STRING, pos BIGINT, url STRING, last_date DATE, linked_at TIMESTAMP"
_LINK = ("ticker", "pos", "url", "last_date", "linked_at")
_ARTICLE = ("title", "content", "date", "status_code", "error", "fetch_kind", "fetched_at")


def write_links(links: DataFrame, folder: str, linked_at: Column) -> None:
    """Hand the links of a crawl (``ticker, pos, url, last_date``) to the stream."""
    rows = links.select("ticker", F.col("pos").cast("bigint").alias("pos"), "url", "last_date", linked_at.cast("timestamp").alias("linked_at"))
    rows.write.mode("append").parquet(folder)


def link_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(LINKS).option("maxFilesPerTrigger", max_files).parquet(folder)


def page_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Fetched pages as they come; columns that a fetcher did not write are null."""
    return spark.readStream.schema(RAW_PAGES).option("maxFilesPerTrigger", max_files).parquet(folder)


def spread_pages(pages: DataFrame, tasks: int | None = None) -> DataFrame:
    """Deal pages out by a hash of their URL, so that neither a hot ticker nor a large file
    is parsed by one task. As many tasks as the join has, which then needs no new shuffle."""
    return pages.repartition(tasks or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("url"))


def parsed_pages(pages: DataFrame, zone: str = LOCAL_ZONE, nested_p: bool = False, open_refs: bool = True) -> DataFrame:
    """Articles of a stream of pages. One without a date of its own has the local date on
    which it was fetched. Texts go on, the larger pages do not enter the state."""
    as_of = F.to_date(F.from_utc_timestamp("fetched_at", zone))
    return to_articles(spread_pages(pages), as_of, zone=zone, nested_p=nested_p, open_refs=open_refs).drop("html")


def links_with_articles(links: DataFrame, articles: DataFrame, wait: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Every link with the articles fetched within ``wait`` of it, or with none.

    ``late`` is how much later than newer ones a row may arrive and still be seen.
    """
    link = links.withWatermark("linked_at", late)
    article = articles.withWatermark("fetched_at", late).select(F.col("url").alias("_url"), *_ARTICLE)
    in_time = (F.col("fetched_at") >= F.col("linked_at")) & (F.col("fetched_at") <= F.col("linked_at") + F.expr(f"INTERVAL {wait}"))
    return link.join(article, (F.col("url") == F.col("_url")) & in_time, "leftOuter")


def landing_sink(base: str, run_id: str, zone: str = LOCAL_ZONE, land_errors: bool = False):
    """A batch function that lands what left the join."""

    def land(batch: DataFrame, _batch_id: int) -> None:
        scratch = Scratch(batch.sparkSession)
        rows = scratch.keep(batch, "joined")
        articles = one_article_per_url(rows.filter("_url is not null").select("url", *_ARTICLE).distinct())
        as_of = F.to_date(F.from_utc_timestamp("linked_at", zone))
        out = article_rows(rows.select(*_LINK).distinct(), articles, as_of, run_id, F.col("linked_at"))
        held = None if land_errors else F.col("error").isNotNull()
        land_by_date(out, base, held=held, why=F.col("error")).drop()
        scratch.drop()

    return land


def start_page_ingest(
    spark: SparkSession,
    links: str,
    pages: str,
    base: str,
    checkpoint: str,
    run_id: str,
    wait: str = "1 day",
    late: str = "1 hour",
    zone: str = LOCAL_ZONE,
    nested_p: bool = False,
    land_errors: bool = False,
    max_files: int = 1000,
    open_refs: bool = True,
) -> StreamingQuery:
    """Take in the links and pages that came since the last call, land what is complete,
    then stop. What waits is in the state and goes on with the next call."""
    articles = parsed_pages(page_stream(spark, pages, max_files), zone, nested_p, open_refs)
    joined = links_with_articles(link_stream(spark, links, max_files), articles, wait, late)
    with rocks_state(spark):
        return (
            joined.writeStream.foreachBatch(landing_sink(base, run_id, zone, land_errors))
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
