"""Keywords: frequent terms, tf-idf terms, terms closest to their document."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from newsflow.functions.text import STOP_WORDS, let, strip, term_counts, tokens, unnest
from newsflow.functions.vectors import cosine
from newsflow.operators.ranking import first_n_per_key, ranked_join
from newsflow.schemas import KEYWORD_SEPARATOR, KEYWORDS_TOP_K
from newsflow.session import materialise


#: More rows than this are never broadcast as the common part of a vocabulary.
COMMON_TERMS = 200_000


def frequent_terms(
    text: Column,
    top_k: int = KEYWORDS_TOP_K,
    stop_words: Iterable[str] = STOP_WORDS,
    min_len: int = 2,
) -> Column:
    """``array<string>`` of the ``top_k`` most frequent words, ties alphabetic.

    Counted inside the row, so no word is shuffled.
    """
    best = F.slice(F.sort_array(term_counts(tokens(text, stop_words, min_len))), 1, top_k)
    return F.transform(best, lambda x: x["term"])


def joined_keywords(words: Column, separator: str = KEYWORD_SEPARATOR) -> Column:
    return F.array_join(words, separator)


def term_table(
    articles: DataFrame,
    keys: Sequence[str],
    text: str = "content",
    stop_words: Iterable[str] = STOP_WORDS,
    min_len: int = 2,
) -> DataFrame:
    """``keys, term, tf``: distinct words of every article with their counts."""
    counted = term_counts(tokens(F.col(text), stop_words, min_len))
    return unnest(articles, counted, *keys).select(
        *keys, F.col("_item.term").alias("term"), (-F.col("_item.neg")).alias("tf")
    )


def with_document_frequency(terms: DataFrame) -> DataFrame:
    """Add ``doc_freq``, the number of articles that hold the term. ``terms`` is read
    twice, so it should come from a written table.

    Only terms of two articles or more are looked up; the long tail of terms that occur
    once needs no row in the vocabulary. Terms with more than one in ``COMMON_TERMS`` of all
    occurrences, which are fewer than that, are broadcast, so most rows find theirs without
    a shuffle. For the others Spark broadcasts the vocabulary if its written size allows,
    else it joins on the term.
    """
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq")).filter("doc_freq > 1")
    vocabulary = materialise(counts, "vocabulary")
    occurrences = vocabulary.agg(F.sum("doc_freq")).first()[0] or 0
    is_common = F.col("doc_freq") > occurrences / COMMON_TERMS
    looked_up = terms.join(F.broadcast(vocabulary.filter(is_common)), "term", "left")
    rest = looked_up.filter("doc_freq is null").drop("doc_freq").join(vocabulary.filter(~is_common), "term", "left")
    joined = looked_up.filter("doc_freq is not null").unionByName(rest)
    return joined.withColumn("doc_freq", F.coalesce("doc_freq", F.lit(1)))


def tfidf_keywords(
    articles: DataFrame,
    keys: Sequence[str],
    text: str = "content",
    top_k: int = KEYWORDS_TOP_K,
    stop_words: Iterable[str] = STOP_WORDS,
    digits: int = 6,
    min_len: int = 2,
) -> DataFrame:
    """``keys, keywords`` by term frequency times smoothed inverse document frequency.

    Articles without a term are not in the result. The texts are split once: one row per
    article with its counted terms is written to the shared scratch folder and read from
    there.
    """
    counted = term_counts(tokens(F.col(text), stop_words, min_len))
    rows = materialise(articles.select(*keys, counted.alias("_terms")), "terms")
    terms = with_document_frequency(
        unnest(rows, F.col("_terms"), *keys).select(
            *keys, F.col("_item.term").alias("term"), (-F.col("_item.neg")).alias("tf")
        )
    )
    documents = articles.select(F.count(F.lit(1))).scalar()
    idf = F.ln((documents + 1) / (F.col("doc_freq") + 1)) + 1
    scored = terms.withColumn("score", F.round(F.col("tf") * idf, digits))
    return ranked_join(scored, keys, "term", [F.desc("score"), F.col("term")], top_k)


def _similarity_udf(factory: Callable[[], Callable[[list], np.ndarray]]):
    @F.pandas_udf("array<double>")
    def similarities(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        embed = factory()

        def unit(texts: list) -> np.ndarray:
            vectors = np.asarray(embed(texts), dtype=float)
            length = np.linalg.norm(vectors, axis=1, keepdims=True)
            return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)

        for texts, terms in batches:
            if not len(texts):
                yield pd.Series([], dtype=object)
                continue
            # Each different term of the batch is embedded once.
            vocabulary = sorted({t for row in terms for t in row})
            at = {t: i for i, t in enumerate(vocabulary)}
            term_vectors = unit(vocabulary) if vocabulary else None
            documents = unit(list(texts))
            yield pd.Series(
                [
                    (term_vectors[[at[t] for t in row]] @ doc).tolist() if len(row) else []
                    for row, doc in zip(terms, documents)
                ]
            )

    return similarities


def similar_terms(
    text: Column,
    factory: Callable[[], Callable[[list], np.ndarray]],
    top_k: int = KEYWORDS_TOP_K,
    stop_words: Iterable[str] = STOP_WORDS,
    min_len: int = 2,
    digits: int = 6,
) -> Column:
    """``array<string>`` of the words closest to their text by embedding cosine.

    ``factory()`` gives ``embed(list[str]) -> matrix`` once per worker. Vectors stay in
    the worker; only the scores come back and are ranked in the plan.
    """
    words = F.array_distinct(tokens(strip(text), stop_words, min_len))
    scores = _similarity_udf(factory)(F.coalesce(text, F.lit("")), words)

    def ranked(pair: Column) -> Column:
        zipped = F.zip_with(
            pair["s"],
            pair["w"],
            lambda s, w: F.struct((-F.round(s, digits)).alias("neg"), w.alias("term")),
        )
        return F.transform(F.slice(F.sort_array(zipped), 1, top_k), lambda x: x["term"])

    return let(F.struct(scores.alias("s"), words.alias("w")), ranked)


def cosine_top_k(
    candidates: DataFrame,
    queries: DataFrame,
    on: Sequence[str],
    candidate_id: str,
    top_k: int = KEYWORDS_TOP_K,
    vector: str = "vector",
) -> DataFrame:
    """The candidates of every group closest to the group's one query vector.

    An equi join with one query row per group: the number of cosines is the number of
    candidates, and no more than ``top_k`` rows of a group leave a task.
    """
    asked = queries.select(*on, F.col(vector).alias("_query"))
    scored = candidates.join(asked, list(on)).withColumn(
        "score", cosine(F.col(vector), F.col("_query"))
    )
    slim = scored.select(*on, candidate_id, "score")
    return first_n_per_key(
        slim, list(on), [F.desc("score"), F.col(candidate_id)], top_k, rank_col="rank"
    )


def mean_vector(rows: DataFrame, keys: Sequence[str], vector: str = "vector", digits: int = 9) -> DataFrame:
    """Element-wise mean of every group's vectors, by partial sums per element."""
    cells = rows.select(*keys, F.posexplode(vector).alias("_i", "_v"))
    means = cells.groupBy(*keys, "_i").agg(F.round(F.avg("_v"), digits).alias("_m"))
    ordered = F.sort_array(F.collect_list(F.struct("_i", "_m")))
    return means.groupBy(*keys).agg(
        F.transform(ordered, lambda c: c["_m"]).alias(vector)
    )
