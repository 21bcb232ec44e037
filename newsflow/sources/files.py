"""Facts about files: listing, sizes, row counts, metadata rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def all_files(spark: SparkSession, base: str, glob: str | None = None) -> DataFrame:
    """``path, size, modified`` of every file below ``base``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(base).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def file_inventory(
    spark: SparkSession, base: str, max_keys: int | None = None, glob: str | None = None
) -> DataFrame:
    """All files below a folder; with ``max_keys`` the first page, in path order."""
    files = all_files(spark, base, glob)
    return files if max_keys is None else files.orderBy("path").limit(max_keys)


def find_file(spark: SparkSession, path: str) -> DataFrame:
    """``found, size`` of one path; ``(false, null)`` where there is none."""
    folder, _, name = path.rpartition("/")
    try:
        files = all_files(spark, folder, name)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, size bigint, modified timestamp")
    return files.filter(F.endswith("path", F.lit(f"/{name}"))).agg(
        (F.count(F.lit(1)) > 0).alias("found"), F.max("size").alias("size")
    )


def file_row_counts(rows: DataFrame) -> DataFrame:
    """Rows of every file of a scan, in one job; no column is read for it."""
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def table_row_counts(rows: DataFrame, name: str) -> DataFrame:
    """``name, row_count`` of one stored table out of the counts of its files, be it a file
    or a folder of parts; a table without rows counts 0."""
    total = F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
    return file_row_counts(rows).agg(total).select(F.lit(name).alias("name"), "row_count")


def plain_path(path: Column) -> Column:
    """One spelling for listed paths: some sources say "file:/x", some "file:///x"."""
    return F.regexp_replace(path, r"^([a-z0-9+.-]+):/+", "$1:/")


def _unescaped(text: Column) -> Column:
    """What is behind percent signs; a plus is a plus."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def metadata_path(path: Column) -> Column:
    """A path as rows name their file, which is URI-encoded, in the spelling of a listing."""
    return _unescaped(plain_path(path))


def path_value(path: Column, key: str) -> Column:
    """The value of a partition column out of a folder name; null for the default folder."""
    name = F.nullif(F.regexp_extract(path, f"/{key}=([^/]+)/", 1), F.lit(""))
    value = _unescaped(name)
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", value)


def file_days(files: DataFrame) -> DataFrame:
    """``path, size, modified`` of listed files with the ``ticker, date`` of their folder."""
    return files.withColumns({"ticker": path_value(F.col("path"), "ticker"), "date": path_value(F.col("path"), "date").try_cast("date")})


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def file_facts(
    files: DataFrame, counts: DataFrame, file_type: str, key: Column | None = None
) -> DataFrame:
    """One metadata row per landed file: key, size and rows (0 where none were read)."""
    sized = files.select(plain_path(F.col("path")).alias("path"), "size", "modified")
    counted = counts.select(metadata_path(F.col("path")).alias("path"), "row_count")
    return sized.join(counted, "path", "left").select(
        F.lit(file_type).alias("file_type"),
        F.regexp_extract("path", r"ticker=([^/]+)", 1).alias("ticker"),
        F.regexp_extract("path", r"date=([^/]+)", 1).try_cast("date").alias("file_date"),
        (F.col("path") if key is None else key).alias("s3_key"),
        F.col("size").alias("file_size_bytes"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.col("modified").alias("uploaded_at"),
    )
