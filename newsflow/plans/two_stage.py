"""The whole run: listing pages or cards to articles, then analysis of all pending days."""

from __future__ import annotations

from pyspark.sql import DataFrame

from newsflow.plans.analyze import Backends, run_backfill
from newsflow.plans.ingest import ingest_listings, ingest_news
from newsflow.schemas import RAW_NEWS, RESULTS
from newsflow.sources.landing import read_landed


def two_stage_run(
    links: DataFrame,
    pages: DataFrame,
    base: str,
    results: str,
    backends: Backends = Backends(),
    mode: str = "pending",
    **options,
) -> DataFrame:
    """Land what is new, analyse every pending day into ``results``, return that table.

    ``links`` are listing pages (with ``html``) or cards. Pending are all landed days
    without result, with an older or an empty one, whether this run touched them or not.
    """
    spark = links.sparkSession
    landed = read_landed(spark, base, RAW_NEWS)
    ingest = ingest_listings if "html" in links.columns else ingest_news
    ingest(links, pages, landed, base, **options).drop()
    run_backfill(spark, base, results, backends, mode=mode)
    return read_landed(spark, results, RESULTS)
