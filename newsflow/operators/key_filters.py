"""Filters of landed URLs per ticker and day, so that days without a known URL stay unread.

A filter is a Bloom filter: every trimmed URL sets ``HASHES`` bits of a bitmap. A day of
more than ``PER_PAGE`` URLs is spread over several bitmaps by a hash of the URL, so that a
filter stays as sure on a huge day as on a tiny one and no bitmap outgrows its 4 KiB. At
``PER_PAGE`` URLs about one unknown URL in four hundred is taken for known; a known one is
never taken for unknown. Filters of several batches lie side by side: a URL may be landed
if any of them says so. Rows without ticker or day set no bits and match none; a missing URL
counts as an empty one, as when landed rows are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsflow.functions.text import strip
from newsflow.operators.incremental import drop_landed, in_partitions
from newsflow.schemas import PARTITION_KEYS
from newsflow.session import materialise

#: Bits of a bitmap as Spark's bitmap aggregates make them.
BITS = 32768
HASHES, PER_PAGE = 4, 2048
#: Days that are named in a partition filter at most; more are joined.
NAMED_DAYS = 1000


def _page(url: Column, pages: Column) -> Column:
    return F.pmod(F.xxhash64(url, F.lit(-1)), pages).cast("int")


def _bits(url: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(url, F.lit(i)), F.lit(BITS)) for i in range(HASHES)]


def key_filters(
    rows: DataFrame, keys: Sequence[str] = PARTITION_KEYS, url: str = "url", per_page: int = PER_PAGE
) -> DataFrame:
    """``*keys, pages, page, bits`` of all URLs of every day."""
    urls = rows.select(*keys, strip(F.col(url)).alias("_url")).dropna().distinct()
    pages = urls.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / per_page).cast("int").alias("pages"))
    spread = urls.join(pages, list(keys)).withColumn("page", _page(F.col("_url"), F.col("pages")))
    bits = spread.select(*keys, "pages", "page", F.explode(F.array(*_bits(F.col("_url")))).alias("bit"))
    return bits.groupBy(*keys, "pages", "page").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), bit % 8)), F.lit(2)) == 1


def maybe_landed(
    new: DataFrame, filters: DataFrame, keys: Sequence[str] = PARTITION_KEYS, url: str = "url"
) -> DataFrame:
    """``*keys, _url`` of the new URLs that some filter of their day may hold.

    Every URL is tested against the one page of each layout of its day that it would be on.
    """
    urls = new.select(*keys, strip(F.col(url)).alias("_url")).dropna().distinct()
    layouts = filters.select(*keys, "pages").distinct()
    placed = urls.join(layouts, list(keys)).withColumn("page", _page(F.col("_url"), F.col("pages")))
    met = placed.join(filters, [*keys, "pages", "page"])
    every = None
    for bit in _bits(F.col("_url")):
        is_set = _is_set(F.col("bits"), bit)
        every = is_set if every is None else every & is_set
    return met.filter(every).select(*keys, "_url").distinct()


def days_to_read(
    new: DataFrame, filters: DataFrame, keys: Sequence[str] = PARTITION_KEYS, url: str = "url"
) -> DataFrame:
    """The days that may hold one of the new URLs; all others need no look."""
    return maybe_landed(new, filters, keys, url).select(*keys).distinct()


def rows_of_days(landed: DataFrame, days: DataFrame, named: int = NAMED_DAYS) -> DataFrame:
    """The rows of the chosen days, ``days`` being a written table.

    Up to ``named`` days stand in the plan as a filter of the folders, so that no other
    folder is opened; more are joined, and Spark prunes by their range and at run time.
    """
    few = days.select("ticker", "date").distinct().limit(named + 1).collect()
    if len(few) > named:
        return in_partitions(landed, days)
    by_ticker: dict = {}
    for ticker, date in few:
        by_ticker.setdefault(ticker, []).append(date)
    chosen = F.lit(False)
    for ticker, dates in sorted(by_ticker.items()):
        chosen = chosen | ((F.col("ticker") == ticker) & F.col("date").isin(sorted(dates)))
    return landed.filter(chosen)


def drop_landed_filtered(
    new: DataFrame, landed: DataFrame, filters: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """New rows whose trimmed URL is not landed on their day; reads only days that may hold one.

    The result is that of ``drop_landed``, provided that every landed URL is in a filter.
    ``days`` are the days to read, as a written table, where the caller has them already.
    """
    chosen = days if days is not None else materialise(days_to_read(new, filters), "days")
    return drop_landed(new, rows_of_days(landed.select(*PARTITION_KEYS, "url"), chosen))
