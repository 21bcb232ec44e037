"""Vector columns over ``array<double>``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v
    )


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v))


def cosine(a: Column, b: Column, digits: int = 6) -> Column:
    """Cosine rounded before ranking, so that equal scores tie the same way everywhere."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(F.round(dot(a, b) / size, digits))
