"""Column builders for vectors: sums are in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    """Cosine with norms of at least 1e-12."""
    least = F.lit(1e-12)
    return dot(a, b) / (F.greatest(norm(a), least) * F.greatest(norm(b), least))


def unit(v: Column) -> Column:
    n = F.greatest(norm(v), F.lit(1e-12))
    return F.transform(v, lambda x: x.cast("double") / n)


def mean(v: Column) -> Column:
    return total(doubles(v)) / F.size(v)


def deviation(v: Column) -> Column:
    """Population standard deviation of the elements."""
    return F.sqrt(F.greatest(F.lit(0.0), dot(v, v) / F.size(v) - mean(v) * mean(v)))


def is_valid(v: Column, dim: int) -> Column:
    """Right width, finite everywhere, and not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(v) == dim) & finite & (norm(v) > 0), F.lit(False))


def close(a: Column, b: Column, absolute: float = 1e-5, relative: float = 1e-4) -> Column:
    return F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= absolute + relative * F.abs(y)), lambda ok: ok)


def max_difference(a: Column, b: Column) -> Column:
    """Largest absolute difference of the elements; null if a side is null."""
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def hash_of(v: Column) -> Column:
    return F.sha2(F.array_join(F.transform(v, lambda x: x.cast("string")), ","), 256)
