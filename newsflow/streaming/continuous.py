"""The analysis as a stream over landed files: the checkpoint says what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from newsflow.operators.incremental import in_partitions
from newsflow.plans.analyze import Backends, analyze_articles, merge_results
from newsflow.schemas import RAW_NEWS, RESULTS
from newsflow.session import Scratch
from newsflow.sources.landing import read_landed, write_partitions


def analysis_sink(results: str, backends: Backends, dedup=("summary",)):
    """A batch function that merges new articles into the result table.

    Only the partitions the batch touches are read and replaced, from a staged copy. A
    replayed batch finds its own rows as earlier results, so it changes nothing.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        spark, scratch = batch.sparkSession, Scratch(batch.sparkSession)
        current = scratch.keep(analyze_articles(batch, backends), "current")
        touched = current.select("ticker", "date").distinct()
        previous = in_partitions(read_landed(spark, results, RESULTS), touched)
        write_partitions(scratch.keep(merge_results(previous, current, dedup), "merged"), results, "overwrite")
        scratch.drop()

    return merge


def start_analysis(
    spark: SparkSession,
    landed: str,
    results: str,
    checkpoint: str,
    backends: Backends = Backends(),
    max_files: int = 1000,
) -> StreamingQuery:
    """Analyse the files that landed since the last call, then stop."""
    news = (
        spark.readStream.schema(RAW_NEWS).option("maxFilesPerTrigger", max_files).parquet(landed)
    )
    return (
        news.writeStream.foreachBatch(analysis_sink(results, backends))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
