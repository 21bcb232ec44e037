"""Pages to articles: the extraction as table jobs.

Reading tags is the only Python step. It needs no shuffle: file splits are even in bytes
whatever the tickers are, so the page text is parsed where it was read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from newsflow.functions.dates import first_local_date
from newsflow.functions.text import default_content, default_title, strip, unnest
from newsflow.functions.urls import absolute, is_news_link, listing_url
from newsflow.operators.html_facts import article_facts, link_cards
from newsflow.operators.ranking import dedup_links
from newsflow.schemas import (
    LISTING_TEMPLATE,
    LOCAL_ZONE,
    MIN_LEN_FOR_OK,
    NEWS_TOKEN,
    SITE_HOST,
    SITE_TOKEN,
)
from newsflow.session import bounded_batches

FACTS = (
    "meta_titles: array<string>, headings: array<string>, title_tag: string, "
    "paragraphs: array<string>, description: string, date_texts: array<string>, error: string"
)
CARDS = "array<struct<pos:int, href:string, datetime:string>>"


#: Page text that is parsed at a time; what is read of it is handed on before the next.
SLICE_BYTES = 1 << 20


def page_slices(batch: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of a batch of pages, each of one page or of ``limit`` bytes at most."""
    first, size = 0, 0
    for i, n in enumerate(pc.binary_length(batch).to_pylist()):
        if size + (n or 0) > limit and i > first:
            yield batch.slice(first, i - first)
            first, size = i, 0
        size += n or 0
    yield batch.slice(first)


def _page_udf(returns: str, read: Callable):
    """Read pages a slice at a time: a task holds one batch as it came and one slice read."""
    kind = to_arrow_type(T.DataType.fromDDL(returns))

    @F.arrow_udf(returns)
    def pages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in page_slices(batch):
                yield pa.array([read(h.as_py()) for h in part], kind)

    return pages


def _facts_udf(nested_p: bool, inline_sep: str, open_refs: bool):
    return _page_udf(f"struct<{FACTS}>", lambda h: article_facts(h, nested_p, inline_sep, open_refs))


def _cards_udf(which: str):
    return _page_udf(CARDS, lambda h: link_cards(h, which))


def with_facts(
    pages: DataFrame,
    html: str = "html",
    out: str = "facts",
    nested_p: bool = False,
    inline_sep: str = "",
    open_refs: bool = True,
) -> DataFrame:
    """Replace the page text by the struct of its facts."""
    return bounded_batches(pages).withColumn(out, _facts_udf(nested_p, inline_sep, open_refs)(F.col(html))).drop(html)


def title_of(facts: Column) -> Column:
    """A non-empty meta title, else the first non-empty heading, else the title tag."""
    metas = F.filter(facts["meta_titles"], lambda m: m != "")
    heads = F.filter(facts["headings"], lambda h: h != "")
    return F.coalesce(
        F.when(F.size(metas) > 0, strip(F.get(metas, F.lit(0)))),
        F.get(heads, F.lit(0)),
        facts["title_tag"],
        F.lit(""),
    )


def content_of(facts: Column) -> Column:
    """The paragraphs of the best body selector that matched at all, else the description."""
    return F.coalesce(
        F.array_join(facts["paragraphs"], " "), strip(facts["description"])
    )


def date_of(facts: Column, as_of: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.coalesce(first_local_date(facts["date_texts"], as_of, zone), as_of)


def to_articles(
    pages: DataFrame,
    as_of: Column,
    html: str = "html",
    zone: str = LOCAL_ZONE,
    ok_only: bool = False,
    nested_p: bool = False,
    inline_sep: str = "",
    open_refs: bool = True,
) -> DataFrame:
    """``title, content, date, error`` for every page; other columns are kept.

    A page that cannot be read stays as a row with its error and ``as_of`` as date. Any
    status is accepted unless ``ok_only``.
    """
    if ok_only:
        pages = pages.filter(F.col("status_code") == 200)
    read = with_facts(pages, html, "facts", nested_p, inline_sep, open_refs)
    facts = F.col("facts")
    failed = facts["error"].isNotNull()
    return read.select(
        *[c for c in read.columns if c != "facts"],
        F.when(~failed, default_title(title_of(facts))).alias("title"),
        F.when(~failed, default_content(content_of(facts))).alias("content"),
        F.when(failed, as_of).otherwise(date_of(facts, as_of, zone)).alias("date"),
        facts["error"].alias("error"),
    )


def to_links(
    listings: DataFrame,
    html: str = "html",
    which: str = "story",
    host: str = SITE_HOST,
    token: str | None = None,
) -> DataFrame:
    """One row per card: ``pos, href, url, datetime``; ``token`` filters on the URL."""
    kept = [c for c in listings.columns if c != html]
    read = bounded_batches(listings).withColumn("_cards", _cards_udf(which)(F.col(html)))
    cards = unnest(read, F.col("_cards"), *kept).select(*kept, "_item.*")
    links = cards.withColumn("url", absolute(F.col("href"), host))
    return links.filter(is_news_link(F.col("url"), token)) if token else links


def collect_links(
    listings: DataFrame,
    group: Sequence[str] = ("ticker",),
    html: str = "html",
    which: str = "story",
    host: str = SITE_HOST,
    token: str | None = None,
) -> DataFrame:
    """Distinct links of every listing page, in page order."""
    return dedup_links(to_links(listings, html, which, host, token), group)


def news_links(listings: DataFrame, group: Sequence[str] = ("ticker",), html: str = "html") -> DataFrame:
    """The older collection: more selectors, and news paths only."""
    return collect_links(listings, group, html, "fallback", token=NEWS_TOKEN)


def best_fetch(
    fetches: DataFrame,
    is_second: Column,
    key: str = "url",
    pos: str = "pos",
    fields: Sequence[str] = ("title", "content", "date"),
    min_len: int = MIN_LEN_FOR_OK,
    site: str = SITE_TOKEN,
    of_first: Sequence[str] = (),
) -> DataFrame:
    """One row per URL from a first fetch and an optional second one.

    The second fetch counts only for a thin page of the site, and only when its content
    is strictly longer; it then gives content and date, and its title unless empty;
    ``of_first`` fields stay those of the first. One (sort-based) aggregation folds both
    attempts, so no self join is needed.
    """
    values = F.struct(*[F.col(f) for f in fields])
    first = F.min_by(values, F.when(~is_second, F.col(pos)))
    second = F.min_by(values, F.when(is_second, F.col(pos)))
    both = fetches.groupBy(key).agg(first.alias("_a"), second.alias("_b")).filter("_a is not null")
    a, b = F.col("_a"), F.col("_b")
    thin = F.length(a["content"]) < min_len
    better = F.coalesce(
        thin & F.contains(F.col(key), F.lit(site)) & (F.length(b["content"]) > F.length(a["content"])),
        F.lit(False),
    )
    chosen = {}
    for field in fields:
        if field in of_first:
            chosen[field] = a[field]
            continue
        second_value = F.coalesce(b[field], a[field]) if field == "date" else b[field]
        if field == "title":
            second_value = F.when(b[field] != "", b[field]).otherwise(a[field])
        chosen[field] = F.when(better, second_value).otherwise(a[field])
    return both.select(key, *[v.alias(k) for k, v in chosen.items()], better.alias("used_second"))


def frontier(tickers: DataFrame, ticker: str = "ticker", template: str = LISTING_TEMPLATE) -> DataFrame:
    """One listing URL per ticker."""
    names = tickers.select(F.col(ticker).alias("ticker")).distinct()
    return names.select("ticker", listing_url(F.col("ticker"), template).alias("url"))
