"""Vector columns as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null for a zero vector."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)


def unit_distance(cos: Column) -> Column:
    """Euclidean distance of unit vectors."""
    return F.sqrt(F.greatest(2 - 2 * cos, F.lit(0.0)))


def normalised(a: Column) -> Column:
    n = norm(a)
    return F.when(n > 0, F.transform(doubles(a), lambda x: x / n)).otherwise(doubles(a))


def jaccard(a: Column, b: Column) -> Column:
    """0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)
