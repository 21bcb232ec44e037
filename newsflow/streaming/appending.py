"""The analysis as a stream that only appends: keyed state knows what is there already.

The state holds, per ticker, day and digest of the dedup columns, that a result was given
out. A batch emits the first article of every key it sees for the first time, in landing
order, and the file sink appends these rows once. No batch reads a result or rewrites a
day, so the work of a batch follows its own rows, however large the days have grown.

A batch's rows are dealt by key and each task keeps the best row of every key, by Arrow
tables, as they come: a summary that a third of all articles share costs its task time,
not memory. What is left, a row per key, goes through Spark's own deduplication, so no
key costs a call to Python. Before they are shuffled, rows of a key within one input file
are not combined; a batch is bounded by its files.

Spark's deduplication knows neither a state to begin with nor one that expires. With
``known`` or ``ttl_ms`` the state is kept by ``FirstOfKey``, which costs some milliseconds
of Python a key. A checkpoint goes on only in the way in which it was begun.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from newsflow.plans.analyze import Backends, analyze_articles
from newsflow.schemas import LANDING_ORDER, PARTITION_KEYS, RAW_NEWS, RESULTS
from newsflow.sources.landing import read_landed

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Rows that come in before they are compared with those held, at least.
_ROUND = 10_000
#: Tasks that a batch's rows of one day are written by, a file each.
FILES_PER_DAY = 8


@contextmanager
def rocks_state(spark: SparkSession):
    """Streams that start in here keep their state in RocksDB; the session is as before."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class FirstOfKey(StatefulProcessor):
    """Emits the first row of a key, by the columns of ``order``, the first time it comes."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], ttl_ms: int | None = None):
        self.columns, self.order, self.ttl_ms = list(columns), list(order), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((True,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        known = self.seen.exists()
        for batch in rows:
            if known or batch.empty:
                continue
            best = batch if first is None else pd.concat([first, batch])
            # Missing values come first, as in a sort by Spark.
            first = best.sort_values(self.order, na_position="first", kind="stable").head(1)
        if first is not None:
            self.seen.update((True,))
            yield first[self.columns]

    def close(self) -> None:
        pass


def best_rows(batches: Iterator[pa.RecordBatch], keys: Sequence[str], order: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The first row of every key, by the columns of ``order``; missing values come first."""

    def best(rows: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(rows)
        if order:
            table = table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in order], null_placement="at_start"))
        numbered = table.select(list(keys)).append_column("_row", pa.array(range(table.num_rows), pa.int64()))
        return table.take(numbered.group_by(list(keys), use_threads=False).aggregate([("_row", "min")]).column("_row_min"))

    held, fresh, size = [], [], 0
    for batch in batches:
        fresh.append(batch)
        size += batch.num_rows
        # As many rows as are held, so that each is moved a bounded number of times.
        if size >= max(_ROUND, sum(b.num_rows for b in held)):
            held, fresh, size = best(held + fresh).combine_chunks().to_batches(), [], 0
    if held or fresh:
        yield from best(held + fresh).to_batches()


def _keyed(rows: DataFrame, dedup: Sequence[str]) -> DataFrame:
    """The rows with the digest of their dedup columns, as a key of fixed size."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in dedup]
    sized = [F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in parts]
    return rows.withColumn("_key", F.sha2(F.concat(*sized), 256))


def first_results(results: DataFrame, dedup: Sequence[str] = ("summary",), known: DataFrame | None = None, ttl_ms: int | None = None) -> DataFrame:
    """The first result of every key of a stream of results.

    ``known`` are results that count as given out when the stream starts for the first
    time. ``ttl_ms`` bounds the state: a key not seen for that long is forgotten.
    """
    keyed, keys = _keyed(results, dedup), [*PARTITION_KEYS, "_key"]
    order = [c for c in LANDING_ORDER if c in results.columns]
    if known is None and ttl_ms is None:
        first = keyed.repartition(*keys).mapInArrow(lambda batches: best_rows(batches, keys, order), keyed.schema)
        return first.dropDuplicates(keys).select(*results.columns)
    grouped = keyed.groupBy(*keys)
    initial = None
    if known is not None:
        initial = _keyed(known, dedup).select(*PARTITION_KEYS, "_key").distinct().groupBy(*PARTITION_KEYS, "_key")
    return grouped.transformWithStateInPandas(
        FirstOfKey(results.columns, order, ttl_ms), outputStructType=results.schema, outputMode="append", timeMode="ProcessingTime" if ttl_ms else "none", initialState=initial
    )


def start_appending_analysis(
    spark: SparkSession,
    landed: str,
    results: str,
    checkpoint: str,
    backends: Backends = Backends(),
    dedup: Sequence[str] = ("summary",),
    known: DataFrame | None = None,
    ttl_ms: int | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Analyse the files that landed since the last call, append their results, then stop.

    The result folder belongs to this stream: its file log says which files count, so a
    batch that failed half-way leaves nothing behind and a finished one is not done again.
    The state lives in RocksDB below the checkpoint.
    """
    news = spark.readStream.schema(RAW_NEWS).option("maxFilesPerTrigger", max_files).parquet(landed)
    fields = T.StructType.fromDDL(RESULTS).names
    first = first_results(analyze_articles(news, backends).select(*fields), dedup, known, ttl_ms)
    # By day, so that not every task writes a file of its own to every day.
    part = F.pmod(F.xxhash64("url"), F.lit(FILES_PER_DAY))
    with rocks_state(spark):
        return (
            first.repartition(*PARTITION_KEYS, part)
            .writeStream.format("parquet")
            .partitionBy(*PARTITION_KEYS)
            .option("path", results)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )


def appended_results(spark: SparkSession, results: str) -> DataFrame:
    """What the stream has appended so far."""
    return read_landed(spark, results, RESULTS)
