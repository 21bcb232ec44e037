"""Analysis of chosen partitions: summary, sentiment, keywords, merged with earlier results."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsflow.functions.text import STOP_WORDS, base_text, error_text, is_blank, strip
from newsflow.operators.incremental import (
    in_partitions,
    select_partitions,
)
from newsflow.operators.keywords import frequent_terms, joined_keywords
from newsflow.operators.ranking import dedup_keep_first
from newsflow.operators.sentiment import lexicon_label, model_label
from newsflow.operators.summaries import leading_sentence, summarize_in_rows, summarize_with_model
from newsflow.schemas import (
    CHUNK_CHARS,
    KEYWORDS_TOP_K,
    LANDING_ORDER,
    NO_CONTENT,
    PARTITION_KEYS,
    RAW_NEWS,
    RESULTS,
)
from newsflow.session import Scratch, materialise
from newsflow.sources.landing import read_landed, write_partitions
from newsflow.sources.probe import day_faults, day_row_counts, day_write_times, is_read_failure, probe_files


@dataclass(frozen=True)
class Backends:
    """How each analysis is done: column expressions by default, model columns if given.

    ``summary_model`` and ``sentiment_model`` come from ``model_column``;
    ``keywords`` is a function from a text column to ``array<string>``.
    """

    summarise: Callable[[Column], Column] = leading_sentence
    summary_model: Callable[[Column], Column] | None = None
    sentiment_weights: dict[str, float] = field(default_factory=dict)
    sentiment_model: Callable[[Column], Column] | None = None
    keywords: Callable[[Column], Column] | None = None
    keyword_model: Callable[[Column], Column] | None = None
    stop_words: Sequence[str] = tuple(STOP_WORDS)
    chunk_chars: int = CHUNK_CHARS
    top_k: int = KEYWORDS_TOP_K
    spread: int | None = None


def _model_summaries(rows: DataFrame, keys: Sequence[str], backends: Backends) -> DataFrame:
    """``keys, content, summary``; ``content`` only where the model returned no summary.

    Model output is written once. Nothing later reads the text of an article that has a
    summary, so only the texts of those without one are joined back.
    """
    summaries = materialise(
        summarize_with_model(
            rows,
            keys,
            backends.summary_model,
            width=backends.chunk_chars,
            spread=backends.spread,
            keep_blank=False,
        ),
        "summaries",
    )
    silent = summaries.filter(F.col("summary") == "").select(*keys)
    texts = rows.select(*keys, "content").join(silent, keys, "left_semi")
    return summaries.join(texts, keys, "left")


def analyze_articles(
    articles: DataFrame,
    backends: Backends = Backends(),
    keys: Sequence[str] = ("ticker", "date", "url"),
    skip_sentinel: bool = False,
) -> DataFrame:
    """``keys, pos, summary, sentiment, keywords`` of every article with content, and the
    landing columns the articles have."""
    if backends.sentiment_model is None and not backends.sentiment_weights:
        raise ValueError("sentiment needs word weights or a model")
    order = [c for c in LANDING_ORDER if c in articles.columns and c not in keys]
    rows = articles.select(*keys, *order, strip(F.col("content")).alias("content"))
    rows = rows.filter(~is_blank(F.col("content")))
    if skip_sentinel:
        rows = rows.filter(F.col("content") != NO_CONTENT)
    if backends.summary_model is None:
        summed = summarize_in_rows(
            rows, backends.summarise, width=backends.chunk_chars
        )
    else:
        summed = _model_summaries(rows, [*keys, *order], backends)
    summed = summed.withColumn("_base", base_text(F.col("summary"), F.col("content")))
    base = F.col("_base")
    if backends.sentiment_model is None:
        label = lexicon_label(base, backends.sentiment_weights)
    else:
        label = model_label(base, backends.sentiment_model)
    if backends.keyword_model is not None:
        summed = summed.withColumn("_keywords", backends.keyword_model(base))
        keywords = F.coalesce(
            F.col("_keywords.value"), error_text(F.col("_keywords.error")), F.lit("")
        )
    else:
        words = backends.keywords or (
            lambda c: frequent_terms(c, backends.top_k, backends.stop_words)
        )
        keywords = joined_keywords(words(base))
    return summed.select(
        *keys,
        *order,
        strip(F.col("summary")).alias("summary"),
        strip(label).alias("sentiment"),
        strip(keywords).alias("keywords"),
    )


def merge_results(
    previous: DataFrame | None,
    current: DataFrame,
    dedup: Sequence[str] = ("summary",),
    keys: Sequence[str] = PARTITION_KEYS,
    order: Sequence[str] = LANDING_ORDER,
) -> DataFrame:
    """Earlier and new results; within a partition the first row of a summary stays.

    Without ``dedup`` columns the article is the key, so that merging the same results
    again changes nothing.
    """
    compared = [*keys, *(dedup or ("url",))]
    texts = {c: F.coalesce(F.col(c), F.lit("")) for c in dedup if dict(current.dtypes)[c] == "string"}
    return dedup_keep_first(previous, current, compared, order, texts)


def analyze_news(
    news: DataFrame,
    previous: DataFrame | None = None,
    backends: Backends = Backends(),
    dedup: Sequence[str] = ("summary",),
    skip_sentinel: bool = False,
) -> DataFrame:
    """All partitions of ``news`` in one job."""
    current = analyze_articles(news, backends, skip_sentinel=skip_sentinel)
    return merge_results(previous, current, dedup)


@dataclass(frozen=True)
class Backfill:
    """What became of the chosen days.

    ``outcomes`` has one row per day: ``ticker, date, status`` (``done`` or ``failed``),
    ``row_count`` written and the ``error``. ``results`` are the stored rows of these days.
    """

    outcomes: DataFrame
    results: DataFrame


def choose_days(
    spark: SparkSession, base: str, results: str, ticker: str | None = None, date: str | None = None, mode: str = "pending"
) -> DataFrame:
    """Days to analyse. Write times come from the listings. Rows are counted, in footers,
    only for days whose result is not older than its input, as all others are decided."""
    inputs = day_write_times(spark, base)
    if date is not None or mode == "all":
        return select_partitions(inputs, None, ticker, date, mode)
    if ticker is not None:
        inputs = inputs.filter(F.col("ticker") == ticker)
    written = day_write_times(spark, results).select(*PARTITION_KEYS, F.col("mtime").alias("_out_mtime"))
    times = materialise(inputs.join(written, list(PARTITION_KEYS), "left"), "write-times")
    fresh = times.filter("_out_mtime >= mtime")
    if fresh.isEmpty():
        return times.drop("_out_mtime")
    counts = day_row_counts(probe_files(spark, results, RESULTS, days=fresh))
    outputs = times.filter("_out_mtime is not null").select(*PARTITION_KEYS, F.col("_out_mtime").alias("mtime")).join(counts, list(PARTITION_KEYS), "left")
    # Older results are pending whatever they hold, so nobody counted them.
    outputs = outputs.withColumn("row_count", F.coalesce("row_count", F.lit(1)))
    return select_partitions(times.drop("_out_mtime"), outputs, mode=mode)


def backfill(
    spark: SparkSession,
    base: str,
    results: str,
    backends: Backends = Backends(),
    ticker: str | None = None,
    date: str | None = None,
    mode: str = "pending",
    dedup: Sequence[str] = ("summary",),
    check_first: bool = False,
) -> Backfill:
    """Analyse stored news into a stored result table; a day that cannot be read does not
    stop the others.

    A day is pending without result, with an older, an empty or an unreadable one. A day
    with an unreadable file is reported with its error and left as it is; unreadable
    earlier results are replaced. As a rule all files are sound, so the analysis just reads
    them. If that fails, all files of the chosen days are decoded to find the faulty ones,
    and the other days are analysed. ``check_first`` looks before the analysis: better
    where faults are frequent, or where doing it twice costs more than reading twice. The
    merged rows are staged before they replace their partitions, and the staged copy is
    deleted.
    """
    scratch, keys = Scratch(spark), list(PARTITION_KEYS)
    chosen = materialise(choose_days(spark, base, results, ticker, date, mode), "selection")

    def analysed(faults: DataFrame, skip_unreadable: bool) -> DataFrame:
        days = chosen.select(*keys)
        sound = days if faults.isEmpty() else materialise(days.join(faults, keys, "left_anti"), "sound")
        news = in_partitions(read_landed(spark, base, RAW_NEWS, skip_unreadable), sound)
        previous = in_partitions(read_landed(spark, results, RESULTS, skip_unreadable=True), sound)
        return scratch.keep(analyze_news(news, previous, backends, dedup), "results")

    def checked() -> DataFrame:
        return materialise(day_faults(probe_files(spark, base, RAW_NEWS, True, chosen)), "faults")

    if check_first:
        faults = checked()
        merged = analysed(faults, True)
    else:
        faults = chosen.filter("smallest = 0").select(*keys, F.lit("empty file").alias("error"))
        try:
            merged = analysed(faults, False)
        except Exception as problem:  # noqa: BLE001
            if not is_read_failure(problem):
                raise
            faults = checked()
            merged = analysed(faults, True)
    write_partitions(merged, results, "overwrite")
    written = merged.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    status = F.when(F.col("error").isNotNull(), "failed").otherwise("done").alias("status")
    outcomes = chosen.join(faults, keys, "left").join(written, keys, "left")
    outcomes = materialise(outcomes.select(*keys, status, F.coalesce("row_count", F.lit(0)).alias("row_count"), "error"), "outcomes")
    scratch.drop()
    return Backfill(outcomes, in_partitions(read_landed(spark, results, RESULTS, skip_unreadable=True), chosen))


def run_backfill(spark: SparkSession, base: str, results: str, *args, **options) -> DataFrame:
    """The backfill, for those who want the stored rows of the chosen days only."""
    return backfill(spark, base, results, *args, **options).results


def analysis_backfill(
    news: DataFrame,
    catalog: DataFrame,
    outputs: DataFrame | None = None,
    previous: DataFrame | None = None,
    backends: Backends = Backends(),
    ticker: str | None = None,
    date: str | None = None,
    mode: str = "pending",
    dedup: Sequence[str] = ("summary",),
) -> DataFrame:
    """Analyse the selected partitions only, merged with their own earlier results.

    ``catalog`` and ``outputs`` are partition statistics (``row_count``, ``mtime``).
    """
    chosen = materialise(select_partitions(catalog, outputs, ticker, date, mode).select(*PARTITION_KEYS), "selection")
    rows = in_partitions(news, chosen)
    if previous is not None:
        previous = in_partitions(previous, chosen)
    return analyze_news(rows, previous, backends, dedup)
