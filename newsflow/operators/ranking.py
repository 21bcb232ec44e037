"""First rows per key: keep-first dedup, heads, caps and top-k.

``row_number() <= n`` lets Spark cut each map task's share of a key to ``n`` rows before
the shuffle (up to ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000). With many
map tasks that is still much for the one task of a hot key, so coarse keys (a ticker, a
day) and any larger ``n`` are first cut in shares: as many as there are shuffle
partitions, which follow the input, so no task of the first cut gets more than its share
of the table and none of the second more than ``n`` rows per share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

GROUP_LIMIT = 1000


def _cut(df: DataFrame, keys: Sequence, order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n)


def first_n_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank_col: str | None = None,
    salts: int | None = None,
    coarse: bool = False,
) -> DataFrame:
    """The first ``n`` rows of every key in a total ``order``; null keys are a key.

    ``coarse`` says that one key may hold a large part of the table.
    """
    if salts is None:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if coarse or n > GROUP_LIMIT else 1
    if salts > 1:
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
        salted = df.withColumn("_salt", spread)
        df = _cut(salted, [*keys, "_salt"], order, n).drop("_rank", "_salt")
    ranked = _cut(df, keys, order, n)
    if rank_col:
        return ranked.withColumnRenamed("_rank", rank_col)
    return ranked.drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return first_n_per_key(df, keys, order, 1)


def dedup_keep_first(
    old: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str] = ("ticker", "date", "url"),
    pos: str | Sequence[str] = ("pos", "url"),
    normalise: dict[str, Column] | None = None,
) -> DataFrame:
    """Bag union by column name, then one row per key: old rows win, then row order.

    ``pos`` names the columns of the row order; those a table lacks are left out. The
    order must be total, or the winner depends on chance: positions restart with every
    listing, so the URL decides between equal ones. ``normalise`` replaces key columns by
    an expression for the comparison only; a digest of it stands in for it, so no second
    copy of a text is shuffled. An empty ``keys`` switches the dedup off.
    """
    both = new.withColumn("_source", F.lit(1))
    if old is not None:
        both = old.withColumn("_source", F.lit(0)).unionByName(both, allowMissingColumns=True)
    if not keys:
        return both.drop("_source")
    digests = {f"_key_{k}": F.unhex(F.sha2(c, 256)) for k, c in (normalise or {}).items() if k in keys}
    if digests:
        both = both.withColumns(digests)
    compared = [f"_key_{k}" if f"_key_{k}" in digests else k for k in keys]
    order = [c for c in ([pos] if isinstance(pos, str) else pos) if c in both.columns]
    kept = first_per_key(both, compared, [F.col("_source"), *map(F.col, order)])
    return kept.drop("_source", *digests)


def dedup_links(
    links: DataFrame, group: Sequence[str] = ("ticker",), url: str = "url", pos: str = "pos"
) -> DataFrame:
    """First occurrence of every link of a page, in page order (``pos`` stays)."""
    return first_per_key(links, [*group, url], [F.col(pos)])


def cap_per_ticker(
    df: DataFrame, n: int, keys: Sequence[str] = ("ticker",), order: Sequence[Column] = ()
) -> DataFrame:
    """The first ``n`` rows of every key, in page order unless told otherwise."""
    given = list(order) or [F.col(c) for c in ("pos", "url") if c in df.columns]
    return first_n_per_key(df, keys, given, n, coarse=True)


def ranked_join(
    df: DataFrame,
    keys: Sequence[str],
    term: str,
    order: Sequence[Column],
    k: int,
    separator: str = ", ",
    out: str = "keywords",
) -> DataFrame:
    """The ``k`` best terms of every key, joined in rank order."""
    top = first_n_per_key(df, keys, order, k, rank_col="_pos")
    words = F.sort_array(F.collect_list(F.struct("_pos", F.col(term).alias("_term"))))
    return top.groupBy(*keys).agg(
        F.array_join(F.transform(words, lambda x: x["_term"]), separator).alias(out)
    )
