"""Joins and table operations with the semantics that plain joins lack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(before: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``before`` whose key isn't in ``new``, and all rows of ``new``."""
    return before.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def replace_columns(left: DataFrame, right: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """Join, with the right side's columns in place of those of the same name."""
    both = [c for c in right.columns if c in left.columns and c not in key]
    return left.drop(*both).join(right, key, how)


def first_within(left: DataFrame, right: DataFrame, key: list[str], x: str, other: str, tolerance: float, order: list[str], columns: list[str]) -> DataFrame:
    """For each left row, the first right row (by ``order``) with abs(x - other) < tolerance, or nulls.

    Both sides are put in bands of the tolerance's width and joined by key and band, the right in three: no range join."""
    band = lambda c: F.floor(F.col(c).cast("double") / F.lit(float(tolerance))).cast("bigint")
    # Equal rows are one while they are matched, and as many as before in the end.
    l = left.groupBy(*left.columns).agg(F.count("*").cast("int").alias("_copies")).withColumn("_band", band(x))  # noqa: E741
    r = right.select(*key, F.col(other).alias("_x"), F.struct(*order).alias("_order"), F.struct(*columns).alias("_found"), F.explode(F.array(band(other) - 1, band(other), band(other) + 1)).alias("_band"))
    own = left.columns
    near = l.join(r, [*key, "_band"], "left").withColumn("_hit", F.coalesce(F.abs(F.col(x) - F.col("_x")) < tolerance, F.lit(False)))
    best = near.groupBy(*own, "_copies").agg(F.min_by(F.when(F.col("_hit"), F.col("_found")), F.when(F.col("_hit"), F.col("_order"))).alias("_f"))
    best = best.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return best.select(*own, *(F.col(f"_f.{c}").alias(c if c not in own else f"{c}_found") for c in columns))


def within_windows(events: DataFrame, windows: DataFrame, key: list[str], t: str, start: str, stop: str, width: float, extra: Column | None = None) -> DataFrame:
    """Events strictly inside the windows of their key.  Windows are laid over bands of ``width``, so that the join is by key and band."""
    band = lambda c: F.floor(c.cast("double") / F.lit(float(width))).cast("bigint")
    w = windows.withColumn("_band", F.explode(F.sequence(band(F.col(start)), F.greatest(band(F.col(start)), band(F.col(stop))))))
    inside = (F.col(t) > F.col(start)) & (F.col(t) < F.col(stop))
    return events.withColumn("_band", band(F.col(t))).join(w, [*key, "_band"]).where(inside if extra is None else inside & extra).drop("_band")


def top_by_count(df: DataFrame, key: list[str], n: int) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), *key).limit(n)


def nearest_row(df: DataFrame, key: list[str], order: str, target: Column, columns: list[str]) -> DataFrame:
    """Each key's row nearest to ``target`` (the earlier of two as near)."""
    return df.groupBy(*key).agg(F.min_by(F.struct(*columns), F.struct(F.abs(F.col(order) - target).alias("d"), F.col(order).alias("o"))).alias("_r")).select(*key, *(f"_r.{c}" for c in columns))


def largest_step(df: DataFrame, key: list[str], order: str, value: str, out: str = "max_step") -> DataFrame:
    """The largest change per unit of ``order`` between rows next to each other that have values."""
    w = Window.partitionBy(*key).orderBy(order)
    step = F.abs((F.col(value) - F.lag(value).over(w)) / (F.col(order) - F.lag(order).over(w)))
    return df.where(F.col(value).isNotNull()).withColumn("_step", step).groupBy(*key).agg(F.max("_step").alias(out))


def counts_rollup(df: DataFrame, a: str, b: str, entity: str) -> DataFrame:
    """Rows and entities by a and b, by a, and in all."""
    return df.rollup(a, b).agg(F.count("*").alias("runs"), F.count_distinct(entity).alias("athletes"))
