"""CSV files that may be broken: counts and heads file by file, errors as values.

Files are listed first and what can be read of them is joined to the listing, so that
every listed file has its row: one that is empty, has a header only, cannot be opened or
breaks its own table counts 0 and hinders no other. Rows are read in permissive mode. A
record with more fields than the table has columns breaks the file, as does a text that is
not UTF-8; one with fewer fields is a row whose last values are missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from newsflow.functions.text import strip
from newsflow.operators.ranking import first_n_per_key
from newsflow.sources.files import metadata_path
from newsflow.sources.listing import listed_files

_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record", "ignoreCorruptFiles": True, "columnPruning": False}
#: Names of CSV files, packed ones too, as a glob and as a pattern.
CSV_GLOB, CSV_NAME = "*.csv*", r"\.csv[^/]*$"
#: A day's folder in the layout with one file per day, which may also be a folder of parts.
LEGACY_DAY = r"/([^/]+)/([^/]+)/news\.(csv|parquet)(?:/[^/]+)?$"


def _path() -> Column:
    return metadata_path(F.col("_metadata.file_path"))


def too_many_fields(record: Column, columns: int) -> Column:
    """Whether a record that does not fit has more fields than columns: commas outside of
    quotes are counted. A doubled quote ends one quoted stretch and begins the next."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    return F.coalesce(F.length(bare) - F.length(F.replace(bare, F.lit(","))) >= columns, F.lit(False))


def permissive_rows(spark: SparkSession, path: str, schema: str, recursive: bool = True) -> DataFrame:
    """All rows of CSV files with ``_record``, the text of a record that does not fit."""
    reader = spark.read.schema(f"{schema}, _record string").options(**_OPTIONS)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", CSV_GLOB)
    return reader.csv(path)


def csv_row_counts(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """``path, size, row_count, error`` of every CSV file below a folder.

    Rows are counted without the header. Two scans: one parses, one looks for bytes that
    are no UTF-8, which the parser would replace.
    """
    files = listed_files(spark, base).filter(F.col("path").rlike(CSV_NAME)).select("path", "size")
    fields = T.StructType.fromDDL(schema).fields
    width = len(fields)
    rows = permissive_rows(spark, base, schema)
    # Spark reads the record's text together with a column of the table only.
    parsed = F.coalesce(F.length(F.col(fields[0].name).cast("string")), F.lit(0)) >= 0
    counts = rows.select(_path().alias("path"), (parsed & too_many_fields(F.col("_record"), width)).alias("wide")).groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("wide").alias("broken")
    )
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", CSV_GLOB).option("ignoreCorruptFiles", True).text(base)
    texts = lines.select(_path().alias("path"), F.is_valid_utf8("value").alias("valid")).groupBy("path").agg(F.bool_and("valid").alias("valid"))
    judged = files.join(counts, "path", "left").join(texts, "path", "left")
    error = (
        F.when(F.col("size") == 0, "empty file")
        .when(F.col("valid").isNull(), "cannot be opened")
        .when(~F.col("valid"), "not UTF-8")
        .when(F.col("broken") > 0, F.format_string("%d records have more than %d fields", "broken", F.lit(width)))
    )
    return judged.select("path", "size", F.when(error.isNull(), F.coalesce("rows", F.lit(0))).otherwise(0).alias("row_count"), error.alias("error"))


def _day_keys(rows: DataFrame, path: str = "path") -> DataFrame:
    """``ticker, date`` of the folders of a path; names that are no date are left out."""
    keyed = rows.withColumns({
        "ticker": F.regexp_extract(path, LEGACY_DAY, 1),
        "date": F.regexp_extract(path, LEGACY_DAY, 2).try_cast("date"),
        "_kind": F.regexp_extract(path, LEGACY_DAY, 3),
    })
    return keyed.filter("date is not null")


def legacy_url_heads(spark: SparkSession, base: str, top_n: int, schema: str) -> DataFrame:
    """``ticker, date, url, rank``: the first URLs of every ``{base}/{ticker}/{date}/news``
    file in the order of its rows, trimmed, without missing ones.

    A day with a parquet file is read from that alone, and has no rows if it cannot be
    read; other days from their CSV, of which the first ``2 * top_n`` rows count. A record
    with too many fields among these leaves the day without rows. Of parquet only the URL
    is read. ``schema`` names the columns of the CSV files.
    """
    kinds = _day_keys(listed_files(spark, base).select("path")).select("ticker", "date", "_kind").distinct()
    stored = kinds.filter("_kind = 'parquet'").select("ticker", "date")
    plain = kinds.filter("_kind = 'csv'").select("ticker", "date").join(stored, ["ticker", "date"], "left_anti")
    keys = ["ticker", "date"]

    whole = spark.read.schema("url string").option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(base)
    whole = _day_keys(whole.select("url", _path().alias("path"), F.col("_metadata.row_index").alias("at"))).filter("url is not null")
    whole = first_n_per_key(whole.select(*keys, "url", "path", "at"), keys, [F.col("path"), F.col("at")], top_n, rank_col="rank", coarse=True)

    width = len(T.StructType.fromDDL(schema).fields)
    # A CSV file with line breaks in texts is read by one task from front to back, so an
    # ascending number per task is the order of its rows.
    rows = permissive_rows(spark, base, schema).select("url", _path().alias("path"), F.monotonically_increasing_id().alias("at"), too_many_fields(F.col("_record"), width).alias("broken"))
    rows = _day_keys(rows).join(plain, keys, "left_semi").select(*keys, "url", "path", "at", "broken")
    first = first_n_per_key(rows, keys, [F.col("path"), F.col("at")], 2 * top_n, coarse=True)
    sound = first.join(first.filter("broken").select(*keys).distinct(), keys, "left_anti").filter("url is not null")
    sound = first_n_per_key(sound, keys, [F.col("path"), F.col("at")], top_n, rank_col="rank")
    heads = whole.select(*keys, "url", "rank").unionByName(sound.select(*keys, "url", "rank"))
    return heads.withColumn("url", strip(F.col("url")))
