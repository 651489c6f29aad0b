"""Vectors as array columns: built-in higher-order functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-9


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def squared_distance(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))))


def norm(x: Column) -> Column:
    return F.sqrt(dot(x, x))


def mean(x: Column) -> Column:
    return total(F.transform(x, lambda v: v.cast("double"))) / F.size(x)


def centred(x: Column) -> Column:
    m = mean(x)
    return F.transform(x, lambda v: v.cast("double") - m)


def unit(x: Column) -> Column:
    length = norm(x) + F.lit(TINY)
    return F.transform(x, lambda v: v.cast("double") / length)


def standard(x: Column) -> Column:
    """Zero mean and unit length."""
    return unit(centred(x))


def correlation(a: Column, b: Column) -> Column:
    """Pearson's, 0 for a constant vector."""
    x, y = centred(a), centred(b)
    return dot(x, y) / (norm(x) * norm(y) + F.lit(TINY))


def histogram_distance(a: Column, b: Column) -> Column:
    """Bhattacharyya's distance of two histograms: 0 for equal ones, 1 for disjoint ones."""
    shared = total(F.zip_with(a, b, lambda x, y: F.sqrt(x.cast("double") * y.cast("double"))))
    scale = F.sqrt(total(F.transform(a, lambda v: v.cast("double"))) * total(F.transform(b, lambda v: v.cast("double"))))
    # Null where a histogram is missing (the first frame has none before it), not the distance of disjoint ones.
    return F.when(scale.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - F.when(scale > 0, shared / scale).otherwise(F.lit(0.0)))))


def block_sum(x: Column, columns: int, rows: range, places: range) -> Column:
    """Sum over a block of a matrix that is stored row by row."""
    parts = [total(F.transform(F.slice(x, r * columns + places.start + 1, len(places)), lambda v: v.cast("double"))) for r in rows]
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out
