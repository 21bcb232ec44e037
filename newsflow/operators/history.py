"""Run history: an append-only change log reduced to the current state.

Each reduction is one aggregation with map-side combine, so the log of one busy run is
folded where it lies before it travels. Values of any type are picked by an order, which
Spark does by sorting; a hash of the key goes first, so that the sort compares numbers
and not long texts. ``ord`` is a total order over the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

START, SUCCESS, FAILED = "running", "success", "failed"


def record_id(*keys: str) -> Column:
    """Deterministic stand-in for an auto-increment key."""
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def start_records(
    runs: DataFrame, as_of: Column, keys: Sequence[str] = ("run_id", "ticker", "date")
) -> DataFrame:
    """One ``running`` change per run, to be appended to the log."""
    return runs.select(
        record_id(*keys).alias("id"),
        *runs.columns,
        F.lit(START).alias("status"),
        as_of.alias("started_at"),
    )


def finish_records(
    finished: DataFrame, as_of: Column, status: Column, keys: Sequence[str] = ("run_id", "ticker", "date")
) -> DataFrame:
    """One ``success`` or ``failed`` change per finished run, with whatever it reports."""
    return finished.select(
        record_id(*keys).alias("id"),
        *[c for c in finished.columns if c not in keys],
        status.alias("status"),
        as_of.alias("completed_at"),
    )


def _last_written(column: str, ord_: Column) -> Column:
    """Value of the last change that wrote the column; a change without it leaves it."""
    written = F.col(column).isNotNull()
    return F.max_by(F.col(column), F.when(written, ord_)).alias(column)


def history_state(
    log: DataFrame,
    ord_cols: Sequence[str],
    fixed: Sequence[str],
    mutable: Sequence[str],
    id_col: str = "id",
    status: str = "status",
    time: str = "changed_at",
) -> DataFrame:
    """Current row of every started run.

    ``fixed`` columns come from the start, ``mutable`` ones from the last change that
    wrote them, so a success after a failure keeps the old error text. Changes to an id
    that was never started have no effect.
    """
    order = F.struct(*[F.col(c) for c in ord_cols])
    started = F.col(status) == START
    return (
        log.groupBy(id_col)
        .agg(
            F.min_by(F.struct(*fixed), F.when(started, order)).alias("_fixed"),
            *[_last_written(c, order) for c in mutable],
            F.max_by(F.col(status), order).alias(status),
            F.max(F.when(started, F.col(time))).alias("started_at"),
            F.max_by(F.col(time), F.when(~started, order)).alias("completed_at"),
            F.min(F.col(time)).alias("created_at"),
            F.max(F.col(time)).alias("updated_at"),
            F.bool_or(started).alias("_started"),
        )
        .filter("_started")
        .select("*", "_fixed.*")
        .drop("_started", "_fixed")
    )


def upsert_state(
    log: DataFrame,
    keys: Sequence[str | Column],
    ord_cols: Sequence[str],
    fixed: Sequence[str],
    mutable: Sequence[str],
    keep_unwritten: bool = False,
) -> DataFrame:
    """Insert, or on a duplicate key overwrite only the ``mutable`` columns.

    ``fixed`` columns keep the value of the first insert. A null overwrites like any
    value, unless ``keep_unwritten``: then a change without a column leaves it as it was.
    """
    order = F.struct(*[F.col(c) for c in ord_cols])
    folded = log.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(
        F.min_by(F.struct(*fixed), order).alias("_fixed"),
        *[_last_written(c, order) if keep_unwritten else F.max_by(F.col(c), order).alias(c) for c in mutable],
    )
    return folded.select("*", "_fixed.*").drop("_fixed", "_hash")


def run_upsert(
    log: DataFrame,
    ord_cols: Sequence[str],
    key: str = "run_id",
    fixed: Sequence[str] = ("dag_id", "execution_date", "tickers"),
    mutable: Sequence[str] = ("status", "started_at"),
) -> DataFrame:
    """One row per run; starting it again only renews status and start time."""
    return upsert_state(log, [key], ord_cols, fixed, mutable, keep_unwritten=True)


def dag_run_state(
    log: DataFrame,
    ord_cols: Sequence[str],
    key: str = "run_id",
    fixed: Sequence[str] = ("dag_id", "execution_date", "tickers"),
    reported: Sequence[str] = ("total_articles", "error_message"),
    status: str = "status",
    time: str = "changed_at",
) -> DataFrame:
    """One row per started run out of its starts and finishes.

    The first start describes the run, a later one renews status and start time. A finish
    sets status, completion time and what it reports; the rest stays as it was. A finish
    of a run that was not started yet has no effect, also when the run starts later.
    """
    order = F.struct(*[F.col(c) for c in ord_cols])
    started = F.col(status) == START
    first = log.filter(started).groupBy(key).agg(F.min(order).alias("_first"))
    counted = log.join(first, key).filter(order >= F.col("_first"))
    return counted.groupBy(key).agg(
        F.min_by(F.struct(*fixed), order).alias("_fixed"),
        F.max_by(F.col(status), order).alias(status),
        F.max_by(F.col(time), F.when(started, order)).alias("started_at"),
        F.max_by(F.col(time), F.when(~started, order)).alias("completed_at"),
        *[_last_written(c, order) for c in reported],
    ).select("*", "_fixed.*").drop("_fixed")


def file_upsert(
    log: DataFrame,
    ord_cols: Sequence[str],
    keys: Sequence[str] = ("file_type", "ticker", "file_date"),
    path: str = "s3_key",
    fixed: Sequence[str] = ("s3_bucket", "s3_key"),
    mutable: Sequence[str] = ("file_size_bytes", "row_count", "uploaded_at"),
    key_chars: int | None = None,
) -> DataFrame:
    """One row per file. ``key_chars`` (255 in the stored schema's unique key) compares
    the first characters of the path only; two longer paths are then one file."""
    compared = F.col(path) if key_chars is None else F.substring(F.col(path), 1, key_chars)
    prefix = compared.alias("_prefix")
    return upsert_state(log, [*keys, prefix], ord_cols, fixed, mutable).drop("_prefix")


def with_defaults(
    df: DataFrame, defaults: dict[str, object], created: str | None = None, updated: str | None = None
) -> DataFrame:
    """Column defaults; ``updated`` falls back to ``created``."""
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}
    if created and updated:
        filled[updated] = F.coalesce(F.col(updated), F.col(created))
    return df.withColumns(filled)


def tickers_to_json(tickers: Column) -> Column:
    return F.to_json(tickers)


def tickers_from_json(text: Column) -> Column:
    return F.from_json(text, "array<string>")
