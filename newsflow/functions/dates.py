"""Date columns: card date guess, instant to local date, since-last tests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsflow.functions.text import let
from newsflow.schemas import LOCAL_ZONE

# date, T or blank, time with optional minutes, seconds and fraction, offset
ZONED_ISO = (
    r"^\s*(\d{4}-\d{1,2}-\d{1,2})[Tt ](\d{1,2}(?::\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?)"
    r"\s*([+-])(\d{1,2}):?(\d{2})?\s*$"
)


def date_guess(c: Column) -> Column:
    """The part of a card's datetime text before ``T`` (so a UTC date)."""
    return F.substring_index(c, "T", 1)


def zoned_text_to_utc(c: Column) -> Column:
    """UTC wall time of an ISO text that carries an offset; null for any other text.

    A text without an offset is refused, not read in some default zone. The arithmetic
    is on zone-less timestamps, so the session's zone has no part in it.
    """
    text = F.replace(c, F.lit("Z"), F.lit("+00:00"))

    def shifted(parts: Column) -> Column:
        part = lambda i: F.get(parts, F.lit(i))
        clock = F.when(F.contains(part(1), F.lit(":")), part(1)).otherwise(
            F.concat(part(1), F.lit(":00"))
        )
        wall = F.concat_ws(" ", part(0), clock).try_cast("timestamp_ntz")
        minutes = part(3).try_cast("int") * 60 + F.coalesce(part(4).try_cast("int"), F.lit(0))
        return wall - F.make_dt_interval(mins=F.when(part(2) == "-", -minutes).otherwise(minutes))

    # One match splits the text into its parts.
    parts = F.split(F.regexp_replace(text, ZONED_ISO, "$1|$2|$3|$4|$5"), r"\|")
    return F.when(text.rlike(ZONED_ISO), let(parts, shifted))


def utc_to_local_date(ts_ntz: Column, zone: str = LOCAL_ZONE) -> Column:
    """Calendar date in ``zone`` of a UTC wall time (``timestamp_ntz``)."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_ntz))


def local_date(c: Column, zone: str = LOCAL_ZONE) -> Column:
    """Calendar date in ``zone`` of an ISO text with an offset, else null."""
    return utc_to_local_date(zoned_text_to_utc(c), zone)


def first_local_date(candidates: Column, as_of: Column, zone: str = LOCAL_ZONE) -> Column:
    """First candidate text that is a zoned instant, as local date; else ``as_of``."""
    parsed = F.filter(
        F.transform(candidates, lambda s: local_date(s, zone)), lambda d: d.isNotNull()
    )
    return F.coalesce(F.get(parsed, F.lit(0)), as_of)


def not_before(value: Column, last: Column, keep_null: bool) -> Column:
    """``value >= last``; no last date keeps the row. ``keep_null`` keeps unknown values."""
    test = F.coalesce(value >= last, F.lit(False))
    if keep_null:
        test = test | value.isNull()
    return last.isNull() | test


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
