"""Which files of a landed table can be read: rows and errors as values, file by file.

One unreadable file ends a Spark job that reads it. A probe lists the files, scans the
table with such files skipped, and joins the two: a file that gave no rows, or fewer than
its footer says, is a row with its error, and all others are read as ever. The scans are
distributed and count only; contents are looked at for suspicious files alone. A file
without bytes, which scans pass over, counts as unreadable.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from newsflow.operators.incremental import in_partitions
from newsflow.schemas import PARTITION_KEYS
from newsflow.session import materialise
from newsflow.sources.files import file_days, metadata_path, plain_path
from newsflow.sources.listing import listed_files

MAGIC = b"PAR1"
#: Bytes of a file that Spark can hold in one row.
LARGEST_CONTENT = 2**31 - 1024
#: Bytes of a footer at most; real ones have some kilobytes.
LARGEST_FOOTER = 64 << 20


def listed(spark: SparkSession, base: str) -> DataFrame:
    """Files below ``base`` with their day, none where the folder is not there."""
    return file_days(listed_files(spark, base))


def _scan(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """All rows that can be read, with the path of their file."""
    try:
        rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(base)
        return rows.withColumn("_path", metadata_path(F.col("_metadata.file_path")))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, _path string")


def _by_file(rows: DataFrame, *figures: Column) -> DataFrame:
    return rows.groupBy(F.col("_path").alias("path")).agg(*figures)


def _decoded(columns: list[str]) -> Column:
    """How many rows could be decoded, all columns of them. Two counts, as a count of
    anything that is never null would read nothing."""
    odd = F.pmod(F.xxhash64(*columns), F.lit(2))
    return (F.count_if(odd == 0) + F.count_if(odd == 1)).alias("rows_read")


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows that a footer counts, or why it cannot be read."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    for batch in batches:
        rows, errors = [], []
        for footer in batch["footer"]:
            try:
                rows.append(pq.read_metadata(pa.BufferReader(MAGIC + bytes(footer))).num_rows)
                errors.append(None)
            except Exception as problem:  # noqa: BLE001
                rows.append(None)
                errors.append(f"footer cannot be read: {str(problem).splitlines()[0][:200]}")
        yield pd.DataFrame({"path": batch["path"], "footer_rows": pd.array(rows, "Int64"), "footer_error": pd.array(errors, "string")})


def _suspected(spark: SparkSession, suspects: DataFrame) -> DataFrame:
    """``path, footer_rows, footer_error`` of suspicious files, from their first and last
    bytes. Their paths come to the driver, which holds the listing of every scan anyway."""
    schema = "path string, footer_rows bigint, footer_error string"
    paths = [r["raw_path"] for r in suspects.filter("size > 0").select("raw_path").collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    small = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).load(paths).filter(F.col("length") <= LARGEST_CONTENT)
    length = F.expr("cast(conv(hex(reverse(substring(content, -8, 4))), 16, 10) as bigint)")
    ends = small.select(
        plain_path(F.col("path")).alias("path"),
        F.when(F.substring("content", 1, 4) != F.lit(MAGIC), "not a parquet file")
        .when(F.substring("content", -4, 4) != F.lit(MAGIC), "cut off: no footer at the end")
        .when((length + 8 > F.col("length")) | (length > LARGEST_FOOTER), "footer length is wrong")
        .alias("plain_error"),
        F.expr("substring(content, -(least(cast(conv(hex(reverse(substring(content, -8, 4))), 16, 10) as bigint), length) + 8), 2147483647)").alias("footer"),
    )
    ends = materialise(ends.withColumn("footer", F.when(F.col("plain_error").isNull(), F.col("footer"))), "suspects")
    parsed = ends.filter("plain_error is null").select("path", "footer").mapInPandas(_footers, schema)
    told = ends.filter("plain_error is not null").select("path", F.lit(None).cast("bigint").alias("footer_rows"), F.col("plain_error").alias("footer_error"))
    return told.unionByName(parsed)


def probe_files(spark: SparkSession, base: str, schema: str, deep: bool = False, days: DataFrame | None = None) -> DataFrame:
    """``path, size, modified, ticker, date, row_count, readable, error``, a row per file.

    ``row_count`` is what can be read: 0 for an unreadable file. Without ``deep`` only
    footers are read; with it all columns are decoded, so damaged data is seen too.
    ``days`` limits the probe to some partitions (``ticker, date``).
    """
    files = listed(spark, base)
    rows = _scan(spark, base, schema)
    if days is not None:
        files = files.join(days.select(*PARTITION_KEYS), list(PARTITION_KEYS), "left_semi")
        rows = in_partitions(rows, days)
    files = files.withColumnRenamed("path", "raw_path").withColumn("path", plain_path(F.col("raw_path")))
    columns = [f.name for f in T.StructType.fromDDL(schema).fields if f.name not in PARTITION_KEYS]
    counts = _by_file(rows, F.count(F.lit(1)).alias("rows"))
    counts = counts.join(_by_file(rows, _decoded(columns)), "path", "left") if deep else counts.withColumn("rows_read", F.col("rows"))
    found = materialise(files.join(counts, "path", "left"), "probe")
    doubtful = found.filter("rows is null or coalesce(rows_read, 0) < rows")
    told = _suspected(spark, doubtful)
    lost = F.format_string("%d of %d rows can be read", F.coalesce("rows_read", F.lit(0)), F.coalesce("rows", "footer_rows"))
    short = F.coalesce("rows_read", F.lit(0)) < F.coalesce("rows", "footer_rows")
    silent = F.col("rows").isNull() & F.col("footer_rows").isNull()
    error = F.coalesce("footer_error", F.when(short, lost), F.when(F.col("size") == 0, "empty file"), F.when(silent, "cannot be opened"))
    return found.join(told, "path", "left").select(
        "path", "size", "modified", "ticker", "date", F.coalesce("rows_read", F.lit(0)).alias("row_count"), error.isNull().alias("readable"), error.alias("error")
    )


def day_faults(probed: DataFrame) -> DataFrame:
    """``ticker, date, error`` of the days with an unreadable file, the first error in order."""
    return probed.filter(~F.col("readable")).groupBy(*PARTITION_KEYS).agg(F.min("error").alias("error"))


def day_write_times(spark: SparkSession, base: str) -> DataFrame:
    """``ticker, date, mtime, smallest`` of every stored day: its last write time and the
    size of its smallest file, from the listing; no file is opened."""
    return listed(spark, base).groupBy(*PARTITION_KEYS).agg(F.max("modified").alias("mtime"), F.min("size").alias("smallest"))


def day_row_counts(probed: DataFrame) -> DataFrame:
    """``ticker, date, row_count`` of probed days; 0 where a file of the day is unreadable."""
    every = F.bool_and("readable")
    return probed.groupBy(*PARTITION_KEYS).agg(F.when(every, F.sum("row_count")).otherwise(0).alias("row_count"))


def is_read_failure(problem: Exception) -> bool:
    """Whether a job ended because a file could not be read."""
    return "FAILED_READ_FILE" in str(problem)
