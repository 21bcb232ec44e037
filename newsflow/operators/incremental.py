"""What is new: last dates, stop sets, anti joins, pending partitions, selections.

None of the joins is hinted. The small sides (one row per ticker, at most ``top_n`` rows
per ticker) grow with the number of tickers, so Spark compares their size with
``spark.sql.autoBroadcastJoinThreshold`` and broadcasts, or else sort-merges and splits a
hot ticker at run time. All are inner, left, semi or anti joins, whose left side Spark
can split.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsflow.functions.dates import not_before
from newsflow.functions.text import strip
from newsflow.operators.ranking import first_n_per_key, first_per_key
from newsflow.schemas import LANDING_ORDER, STOP_LOOKBACK_DAYS, STOP_TOP_N


def last_dates(partitions: DataFrame, ticker: str = "ticker", date: str = "date") -> DataFrame:
    """Latest valid date of every ticker; names that are no date do not count."""
    typed = dict(partitions.dtypes)[date] == "date"
    valid = F.col(date) if typed else F.col(date).cast("string").try_cast("date")
    return partitions.groupBy(ticker).agg(F.max(valid).alias("last_date"))


def since_last(
    rows: DataFrame,
    last: DataFrame,
    date: str = "date",
    keep_null: bool = True,
    on: Sequence[str] = ("ticker",),
) -> DataFrame:
    """Rows on or after their ticker's last date; a ticker without one keeps all rows.

    The last date stays as a column, for a second test of the same rows."""
    joined = rows.join(last, list(on), "left")
    return joined.filter(not_before(F.col(date), F.col("last_date"), keep_null))


def stop_set(
    landed: DataFrame,
    today: Column | dt.date,
    lookback_days: int = STOP_LOOKBACK_DAYS,
    top_n: int = STOP_TOP_N,
    order: Sequence[str] = LANDING_ORDER,
) -> DataFrame:
    """The ``top_n`` most recent distinct URLs of every ticker, ``rank`` 1 the newest.

    Only the head of each recent day is looked at, newest day first, in landing order:
    earlier runs first, since positions restart with every listing. Columns of ``order``
    that the table lacks are left out.
    """
    order = [c for c in order if c in landed.columns]
    today = today if isinstance(today, Column) else F.lit(today)
    recent = landed.select("ticker", "date", *dict.fromkeys(["url", *order])).filter(
        F.col("url").isNotNull() & (F.col("date") >= F.date_sub(today, lookback_days))
    )
    heads = first_n_per_key(recent, ["ticker", "date"], [F.col(c) for c in order], top_n, coarse=True)
    newest_first = [F.desc("date"), *[F.col(c) for c in order]]
    distinct = first_per_key(heads.withColumn("url", strip(F.col("url"))), ["ticker", "url"], newest_first)
    return first_n_per_key(distinct, ["ticker"], newest_first, top_n, rank_col="rank")


def drop_stopped(links: DataFrame, stop: DataFrame, url: str = "url") -> DataFrame:
    """Links whose trimmed URL is not in their ticker's stop set."""
    known = stop.select("ticker", strip(F.col("url")).alias("_url"))
    keyed = links.withColumn("_url", strip(F.col(url)))
    return keyed.join(known, ["ticker", "_url"], "left_anti").select(*links.columns)


def drop_landed(
    new: DataFrame, landed: DataFrame, keys: Sequence[str] = ("ticker", "date"), url: str = "url"
) -> DataFrame:
    """New rows whose trimmed URL is not yet in their own landed partition."""
    known = landed.select(*keys, strip(F.col(url)).alias("_url"))
    keyed = new.withColumn("_url", strip(F.col(url)))
    return keyed.join(known, [*keys, "_url"], "left_anti").select(*new.columns)


def partition_stats(
    rows: DataFrame, mtime: Column | str, keys: Sequence[str] = ("ticker", "date")
) -> DataFrame:
    """Row count and newest write time of every partition."""
    newest = F.max(F.col(mtime) if isinstance(mtime, str) else mtime)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"), newest.alias("mtime")
    )


def pending_partitions(
    inputs: DataFrame,
    outputs: DataFrame,
    keys: Sequence[str] = ("ticker", "date"),
    empty_is_pending: bool = True,
) -> DataFrame:
    """Input partitions without output, with an older output or with an empty one.

    Both sides are partition statistics: one row per partition, never the articles.
    """
    done = outputs.select(
        *keys, F.col("mtime").alias("_out_mtime"), F.col("row_count").alias("_out_rows")
    )
    missing = F.col("_out_rows").isNull()
    stale = F.coalesce(F.col("mtime") > F.col("_out_mtime"), F.lit(False))
    pending = missing | stale
    if empty_is_pending:
        pending = pending | (F.col("_out_rows") == 0)
    return inputs.join(done, list(keys), "left").filter(pending).select(*inputs.columns)


def select_partitions(
    catalog: DataFrame,
    outputs: DataFrame | None = None,
    ticker: str | None = None,
    date: dt.date | str | None = None,
    mode: str = "pending",
) -> DataFrame:
    """Partitions to process. An explicit date skips the pending test."""
    if mode not in ("all", "pending"):
        raise ValueError(f"mode must be 'all' or 'pending', not {mode!r}")
    chosen = catalog
    if ticker is not None:
        chosen = chosen.filter(F.col("ticker") == ticker)
    if date is not None:
        return chosen.filter(F.col("date") == F.lit(date).cast("date"))
    if mode == "all" or outputs is None:
        return chosen
    return pending_partitions(chosen, outputs)


def in_partitions(rows: DataFrame, partitions: DataFrame) -> DataFrame:
    """Rows of the chosen partitions only.

    The first and last day of the choice are fetched and stand as a filter on both sides.
    On the rows it prunes days when the plan is made; on the choice it is the selective
    filter without which Spark does not prune partitions at run time, which helps when
    one odd date stretches the range. ``partitions`` is read twice: give a written table.
    """
    chosen = partitions.select("ticker", "date")
    first, last = chosen.agg(F.min("date"), F.max("date")).first()
    between = F.col("date").between(F.lit(first), F.lit(last))
    return rows.filter(between).join(chosen.filter(between), ["ticker", "date"], "left_semi")
