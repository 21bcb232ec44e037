"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsflow.llm.tasks import written


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node with a link to another.

    Every round hangs the larger neighbours of a node, then the smaller ones, below the
    smallest of them, until all links point from a node to the root of its component.
    The rounds grow with the logarithm of the longest path. A round is written to the
    shared folder, so lost executors cost one round; only counts and a checksum come to
    the driver. Links to oneself and missing ends are ignored.
    """
    pairs = links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"), F.col(left).alias("l"), F.col(right).alias("r"))
    edges = written(pairs.filter("l is not null and r is not null and a <> b").select("a", "b").distinct(), "links")
    before = _fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(root, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(hung.unionByName(root.withColumnRenamed("m", "b")).distinct(), "links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
