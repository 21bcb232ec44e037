"""Chunking and chunked summaries."""

from __future__ import annotations

import textwrap
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from newsflow.functions.text import clean, strip, summary_error_text, unnest
from newsflow.schemas import CHUNK_CHARS


# A line may end after a hyphen with letters on both sides.
_LETTER = r"[\p{L}\p{Nl}\p{No}_]"
_HYPHEN_BREAK = rf"(?<={_LETTER}{{2}}-|{_LETTER}-{_LETTER}-)(?={_LETTER}-?{_LETTER})"


def with_chunks(
    articles: DataFrame, text: str = "content", width: int = CHUNK_CHARS, out: str = "chunks"
) -> DataFrame:
    """Add the cleaned text wrapped to ``width`` characters; blank text has no chunks.

    A greedy match that has to end at a break is the greedy wrapping. Only text with
    words longer than a line or with dashes of several hyphens, for which there are more
    rules, is sent to a Python worker.
    """

    @F.pandas_udf("array<string>")
    def wrap(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: None if t is None else textwrap.wrap(t, width))

    cleaned = F.col("_cleaned")
    long = F.length(cleaned) > width
    special = F.contains(cleaned, F.lit("--")) | cleaned.rlike(f"[^ ]{{{width + 1}}}")
    line = f"(?s)(.{{1,{width}}})(?: |$|{_HYPHEN_BREAK})"
    return (
        articles.withColumn("_cleaned", clean(F.col(text)))
        .withColumn("_wrapped", wrap(F.when(long & special, cleaned)))
        .withColumn(
            out,
            F.when(F.col("_wrapped").isNotNull(), F.col("_wrapped"))
            .when(long, F.regexp_extract_all(cleaned, F.lit(line), F.lit(1)))
            .when(cleaned != "", F.array(cleaned))
            .otherwise(F.array().cast("array<string>")),
        )
        .drop("_cleaned", "_wrapped")
    )


def chunk_table(
    articles: DataFrame, keys: Sequence[str], text: str = "content", width: int = CHUNK_CHARS
) -> DataFrame:
    """One row per chunk: ``keys, chunk_pos, chunk``."""
    rows = with_chunks(articles.select(*keys, text), text, width, "_chunks")
    return unnest(rows, F.col("_chunks"), *keys).select(
        *keys, F.col("_at").alias("chunk_pos"), F.col("_item").alias("chunk")
    )


def leading_sentence(chunk: Column) -> Column:
    """A deterministic summary of one chunk: its text up to the first sentence end."""
    return strip(F.regexp_extract(chunk, r"^(.*?[.!?])(?:\s|$)|^(.*)$", 0))


def summarize_in_rows(
    articles: DataFrame,
    summarise: Callable[[Column], Column] = leading_sentence,
    text: str = "content",
    out: str = "summary",
    width: int = CHUNK_CHARS,
) -> DataFrame:
    """Summaries by a column expression: chunks stay in their row, nothing is shuffled."""
    parts = F.transform("_chunks", summarise)
    return (
        with_chunks(articles, text, width, "_chunks")
        .withColumn(out, strip(F.array_join(parts, " ")))
        .drop("_chunks")
    )


def summarize_with_model(
    articles: DataFrame,
    keys: Sequence[str],
    model: Callable[[Column], Column],
    text: str = "content",
    out: str = "summary",
    width: int = CHUNK_CHARS,
    spread: int | None = None,
    keep_blank: bool = True,
) -> DataFrame:
    """``keys, summary`` by a model column (see ``model_column``).

    Model time far exceeds the cost of moving a chunk, so ``spread`` deals the chunks out
    evenly and the chunks of a long article are worked on by many tasks. A failing chunk
    puts its error text in the summary. ``keep_blank`` reads the articles once more for
    those without text; switch it off where they are filtered already.
    """
    chunks = chunk_table(articles, keys, text, width)
    if spread:
        chunks = chunks.repartition(spread, *keys, "chunk_pos")
    scored = chunks.withColumn("_result", model(F.col("chunk")))
    part = F.coalesce(F.col("_result.value"), summary_error_text(F.col("_result.error")))
    joined = scored.select(*keys, F.struct("chunk_pos", part.alias("part")).alias("_part"))
    ordered = F.sort_array(F.collect_list("_part"))
    # One article's chunks were one row before, so a group is never larger than a row.
    summaries = joined.groupBy(*keys).agg(
        strip(F.array_join(F.transform(ordered, lambda p: p["part"]), " ")).alias(out)
    )
    if not keep_blank:
        return summaries
    blank = articles.filter(clean(F.col(text)) == "").select(*keys, F.lit("").alias(out))
    return summaries.unionByName(blank)
