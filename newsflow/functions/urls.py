"""URL and object-key columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsflow.schemas import (
    LISTING_TEMPLATE,
    NEWS_TOKEN,
    RAW_KEY_TEMPLATE,
    RESULT_KEY_TEMPLATE,
    SITE_HOST,
)


def absolute(href: Column, host: str = SITE_HOST) -> Column:
    """A link that starts with ``http`` stays, any other gets the host in front."""
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(host), href))


def is_news_link(url: Column, token: str = NEWS_TOKEN) -> Column:
    return F.contains(url, F.lit(token))


def listing_url(ticker: Column, template: str = LISTING_TEMPLATE) -> Column:
    return F.format_string(template, ticker)


def raw_key(ticker: Column, date: Column) -> Column:
    return F.format_string(RAW_KEY_TEMPLATE, ticker, date.cast("string"))


def result_key(ticker: Column, date: Column) -> Column:
    return F.format_string(RESULT_KEY_TEMPLATE, ticker, date.cast("string"))
