"""Landing rows by ticker and date, and writing results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsflow.functions.dates import iso_seconds
from newsflow.functions.text import strip
from newsflow.operators.incremental import drop_landed, in_partitions
from newsflow.operators.key_filters import days_to_read, key_filters, rows_of_days
from newsflow.operators.ranking import dedup_keep_first, first_per_key
from newsflow.schemas import LANDING_ORDER, PARTITION_KEYS, RESULT_COLUMNS
from newsflow.session import Scratch


def with_lineage(rows: DataFrame, run_id: str, fetched_at: Column) -> DataFrame:
    """Which run brought the row, and when."""
    return rows.withColumns({"fetched_at": iso_seconds(fetched_at), "run_id": F.lit(run_id)})


def complete_columns(rows: DataFrame, columns: Sequence[str], fill: str = "") -> DataFrame:
    """Add the columns that are missing, filled with text."""
    return rows.withColumns({c: F.lit(fill) for c in columns if c not in rows.columns})


def union_by_name(old: DataFrame, new: DataFrame, fill: str = "") -> DataFrame:
    """Old and new rows; text columns that one side lacks are filled there, nulls stay."""
    text = lambda rows: [c for c, kind in rows.dtypes if kind == "string"]
    one, two = complete_columns(old, text(new), fill), complete_columns(new, text(old), fill)
    return one.unionByName(two, allowMissingColumns=True)


def read_landed(spark: SparkSession, base: str, schema, skip_unreadable: bool = False) -> DataFrame:
    """The landed table, or no rows where nothing has landed yet.

    ``skip_unreadable`` goes on after a file that cannot be read, with the rows it had up
    to there; ``sources.probe`` says which files those are.
    """
    try:
        return spark.read.schema(schema).option("ignoreCorruptFiles", skip_unreadable).parquet(base)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_partitions(rows: DataFrame, base: str, mode: str, keys: Sequence[str] = PARTITION_KEYS) -> None:
    """Write by partition. Rebalancing gives small partitions one file each and splits a
    partition that is too large for one task over several."""
    (
        rows.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(base)
    )


def quarantine_reason(held: Column | None = None, why: Column | None = None) -> Column:
    """Why a row cannot land, null where it can: it lacks a key, or it is ``held``."""
    reason = F.when(F.col("ticker").isNull(), "no ticker").when(F.col("url").isNull(), "no url").when(F.col("date").isNull(), "no date")
    return reason if held is None else reason.when(held, F.coalesce(why, F.lit("held")) if why is not None else F.lit("held"))


def landable(rows: DataFrame, held: Column | None = None, why: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with URL, date and ticker, trimmed; and the rest with its ``reason``."""
    judged = rows.withColumn("reason", quarantine_reason(held, why))
    return (
        judged.filter("reason is null").drop("reason").withColumn("url", strip(F.col("url"))),
        judged.filter("reason is not null"),
    )


def quarantine_path(base: str) -> str:
    return f"{base.rstrip('/')}.quarantine"


def append_new(rows: DataFrame, path: str) -> None:
    """Append the rows that are not stored yet, compared in all columns, so that a batch
    that is run again adds nothing. Rows repeated within a batch stay as often as they are."""
    whole = F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(rows.columns)])), 256))
    try:
        stored = rows.sparkSession.read.schema(rows.schema).parquet(path).select(whole.alias("_whole"))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        rows.write.mode("append").parquet(path)
        return
    rows.withColumn("_whole", whole).join(stored, "_whole", "left_anti").drop("_whole").write.mode("append").parquet(path)


FILTER_SCHEMA = "ticker string, date date, pages int, page int, bits binary"


def filter_path(base: str) -> str:
    return f"{base.rstrip('/')}.filters"


def add_key_filters(rows: DataFrame, path: str) -> None:
    """Append filters of the URLs of ``rows``."""
    typed = rows.select("ticker", F.col("date").cast("date").alias("date"), "url")
    key_filters(typed).select("ticker", "date", "pages", "page", "bits").write.mode("append").parquet(path)


def read_key_filters(landed: DataFrame, path: str) -> DataFrame:
    """The filters of a landed table; made from the table first where there are none yet."""
    spark = landed.sparkSession
    try:
        return spark.read.schema(FILTER_SCHEMA).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        add_key_filters(landed, path)
        return spark.read.schema(FILTER_SCHEMA).parquet(path)


@dataclass(frozen=True)
class Landing:
    """What became of a batch: every row is added, quarantined or rejected.

    ``rejected`` rows are of a URL that its day has already, from the batch or from
    before. The tables read staged copies until ``drop``.
    """

    added: DataFrame
    quarantined: DataFrame
    rejected: DataFrame
    scratch: Scratch

    def drop(self) -> None:
        self.scratch.drop()


def land_by_date(
    rows: DataFrame,
    base: str,
    rewrite: bool = False,
    order: Sequence[str] = LANDING_ORDER,
    held: Column | None = None,
    why: Column | None = None,
    quarantine: str | None = None,
    filters: str | None = None,
) -> Landing:
    """Land the new rows of a batch by ticker and day.

    The first row of a URL within a day wins, and a landed row wins over a new one. So
    landed days need no rewrite: rows that are not there yet are appended. ``rewrite``
    also merges the touched days (and only those) into fresh files, through a staged
    copy, so that a failure in between leaves the merged rows on disk.

    Rows without ticker, URL or date, and ``held`` ones, are appended to the quarantine
    table with the reason (``why`` for held ones), once each however often a batch is run;
    by default it lies beside ``base``.

    With ``filters`` (a folder, see ``filter_path``) only days whose filter may hold a URL of
    the batch are compared. All later landings of the table must name the folder too. A
    batch's filters are written before its rows: if it fails in between, a filter holds
    URLs that are not there, which costs a look and loses nothing.

    The batch is written once before it is compared, so pages are not parsed twice. The
    comparison handles keys and row numbers only. What it rejects, few rows as a rule, is
    what the batch is filtered by, so the texts move once, to be written.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    batch = scratch.keep(rows.withColumn("_row", F.monotonically_increasing_id()), "batch")
    good, bad = landable(batch, held, why)
    bad = bad.drop("_row")
    ranks = [c for c in order if c in rows.columns]
    keys = good.select(*dict.fromkeys([*PARTITION_KEYS, "url", *ranks, "_row"]))
    first = first_per_key(keys, [*PARTITION_KEYS, "url"], [*map(F.col, ranks), F.col("_row")])
    landed = read_landed(spark, base, rows.schema)
    stored = landed.select(*PARTITION_KEYS, "url")
    if filters:
        known = rows_of_days(stored, scratch.keep(days_to_read(first, read_key_filters(landed, filters)), "days"))
    else:
        known = in_partitions(stored, good.select(*PARTITION_KEYS).distinct())
    chosen = drop_landed(first, known).select("_row")
    rejected = scratch.keep(keys.select("_row").join(chosen, "_row", "left_anti"), "rejected")
    added = good.join(rejected, "_row", "left_anti").drop("_row")
    if filters:
        add_key_filters(added, filters)
    if rewrite:
        touched = scratch.keep(added.select(*PARTITION_KEYS).distinct(), "touched")
        merged = scratch.keep(dedup_keep_first(in_partitions(landed, touched), added, pos=order), "merged")
        write_partitions(merged, base, "overwrite")
    else:
        write_partitions(added, base, "append")
    append_new(bad, quarantine or quarantine_path(base))
    return Landing(added, bad, good.join(rejected, "_row", "left_semi").drop("_row"), scratch)


def result_rows(
    results: DataFrame, columns: Sequence[str] = RESULT_COLUMNS, keys: Sequence[str] = ()
) -> DataFrame:
    """The output projection: text stripped, lists joined, anything else empty; keys as they are."""
    kinds = dict(results.dtypes)
    return results.select(
        *keys,
        *[
            (
                strip(F.array_join(c, ", "))
                if kinds[c].startswith("array")
                else strip(F.col(c)) if kinds[c] == "string" else F.lit("")
            ).alias(c)
            for c in columns
        ]
    )


def write_results(
    results: DataFrame,
    path: str,
    columns: Sequence[str] = RESULT_COLUMNS,
    keys: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """CSV with header; with ``keys`` one folder per partition."""
    out = result_rows(results, columns, keys)
    writer = out.hint("rebalance", *[F.col(k) for k in keys]) if keys else out
    writer = writer.write.mode(mode).option("header", True).option("escape", '"')
    if keys:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
    writer.csv(path)
