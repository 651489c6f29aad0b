"""Ordered-sequence operators.

Each takes a DataFrame, the key columns, the order column and a value column, and adds a column.  All are window
functions over (key, order), so that one shuffle by key serves a chain of them, and a long key is streamed through
rather than gathered in an array.  What looks ahead uses a descending window with a running frame, which is linear,
instead of a frame to the end of the partition, which is not.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Frames a second of the source footage: the rational 30000/1001.
FPS = 30000 / 1001


def along(key: list[str], *order: str):
    return Window.partitionBy(*key).orderBy(*order)


def back(key: list[str], order: str):
    return Window.partitionBy(*key).orderBy(F.col(order).desc())


def running(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def neighbours(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Adds _i (position from 1) and _before and _after: structs (i, v) of the nearest values that aren't null, the row's own included."""
    df = df.withColumn("_i", F.row_number().over(along(key, order)))
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(value).alias("v")))
    df = df.withColumn("_known", known)
    df = df.withColumn("_before", F.last("_known", ignorenulls=True).over(running(along(key, order))))
    return df.withColumn("_after", F.last("_known", ignorenulls=True).over(running(back(key, order)))).drop("_known")


def between(i: Column, before: Column, after: Column) -> Column:
    """Linear interpolation by position; the value itself where both neighbours are the row."""
    slope = (after["v"] - before["v"]) / (after["i"] - before["i"])
    return F.when(after["i"] == before["i"], before["v"]).otherwise(before["v"] + slope * (i - before["i"]))


def gap_fill(df: DataFrame, key: list[str], order: str, value: str, max_gap: int | None = 4, edges: str = "null", out: str = "filled") -> DataFrame:
    """Interpolate interior gaps of at most ``max_gap`` rows (None: any).  ``edges`` "hold" repeats the end values outwards.

    A key with fewer than two values stays as it is."""
    df = neighbours(df, key, order, value)
    count = F.count(value).over(Window.partitionBy(*key))
    b, a = F.col("_before"), F.col("_after")
    inside = b.isNotNull() & a.isNotNull()
    if max_gap is not None:
        inside = inside & (a["i"] - b["i"] - 1 <= max_gap)
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(inside, between(F.col("_i"), b, a))
    if edges == "hold":
        filled = filled.when(b.isNull(), a["v"]).when(a.isNull(), b["v"])
    return df.withColumn(out, F.when(count >= 2, filled).otherwise(F.col(value))).drop("_i", "_before", "_after")


def rolling_median(df: DataFrame, key: list[str], order: str, value: str, width: int = 7, out: str = "median") -> DataFrame:
    """Centred; frames are cut off at the ends."""
    half = width // 2
    return df.withColumn(out, F.percentile(value, F.lit(0.5)).over(along(key, order).rowsBetween(-half, half)))


def despike(df: DataFrame, key: list[str], order: str, value: str, width: int = 7, limit: float = 0.2, out: str = "clean") -> DataFrame:
    """Null for values more than ``limit`` off the rolling median of the filled series, in keys with more than ``width`` values."""
    df = gap_fill(df, key, order, value, None, "hold", "_filled")
    df = rolling_median(df, key, order, "_filled", width, "_median")
    many = F.count(value).over(Window.partitionBy(*key)) > width
    return df.withColumn(out, F.when(many & (F.abs(F.col(value) - F.col("_median")) > limit), None).otherwise(F.col(value))).drop("_filled", "_median")


def savgol_coefficients(width: int, order: int, deriv: int = 0, rate: float = 1.0) -> np.ndarray:
    """Row p: the weights of a window's values for the fitted polynomial's derivative at its p-th place."""
    x = np.arange(width, dtype=float)
    fit = np.linalg.pinv(np.vander(x - width // 2, order + 1, increasing=True))
    rows = []
    for p in x - width // 2:
        powers = [math.perm(j, deriv) * p ** (j - deriv) if j >= deriv else 0.0 for j in range(order + 1)]
        rows.append(np.array(powers) @ fit * rate**deriv)
    return np.array(rows)


def savgol(df: DataFrame, key: list[str], order: str, value: str, width: int = 7, degree: int = 2, deriv: int = 0, rate: float = FPS, out: str = "smooth") -> DataFrame:
    """Savitzky-Golay over each stretch without nulls; the ends use the polynomial of the end window.

    Stretches shorter than ``width`` keep their values, and have no derivative."""
    half = width // 2
    number = F.row_number().over(along(key, order))
    df = df.withColumn("_n", number).withColumn("_null", F.col(value).isNull())
    # A stretch's rows have the same difference between the position and the count of values so far.
    df = df.withColumn("_stretch", F.when(~F.col("_null"), F.col("_n") - F.count(value).over(running(along(key, order)))))
    part = Window.partitionBy(*key, "_stretch")
    df = df.withColumn("_size", F.count(F.lit(1)).over(part)).withColumn("_p", F.row_number().over(part.orderBy(order)) - 1)
    near = F.collect_list(value).over(part.orderBy(order).rowsBetween(1 - width, width - 1))
    centre = F.greatest(F.lit(half), F.least(F.col("_p"), F.col("_size") - 1 - half))
    first = centre - half - F.greatest(F.lit(0), F.col("_p") - width + 1) + 1
    table = F.array(*(F.array(*(F.lit(float(c)) for c in row)) for row in savgol_coefficients(width, degree, deriv, rate)))
    df = df.withColumn("_near", near).withColumn("_first", first.cast("int")).withColumn("_row", (F.col("_p") - centre + half + 1).cast("int"))
    fitted = F.aggregate(F.zip_with(F.slice("_near", F.col("_first"), width), F.element_at(table, F.col("_row")), lambda v, c: v * c), F.lit(0.0), lambda s, v: s + v)
    short = F.col(value) if deriv == 0 else F.lit(None).cast("double")
    return df.withColumn(out, F.when(F.col("_null"), None).when(F.col("_size") >= width, fitted).otherwise(short)).drop("_n", "_null", "_stretch", "_size", "_p", "_near", "_first", "_row")


def robust_smooth(df: DataFrame, key: list[str], order: str, value: str, median: int = 9, width: int = 15, hold: int = 15, out: str = "robust") -> DataFrame:
    """Fill, rolling median, Savitzky-Golay; kept as far as ``hold`` rows beyond the first and last value.  Keys with fewer than three values stay as they are."""
    whole = Window.partitionBy(*key)
    df = gap_fill(df, key, order, value, None, "hold", "_f")
    df = rolling_median(df, key, order, "_f", median, "_m")
    df = savgol(df, key, order, "_m", width, 2, 0, 1.0, "_s").withColumn("_at", F.row_number().over(along(key, order)))
    seen = F.when(F.col(value).isNotNull(), F.col("_at"))
    df = df.withColumn("_lo", F.min(seen).over(whole)).withColumn("_hi", F.max(seen).over(whole)).withColumn("_c", F.count(value).over(whole))
    smooth = F.when(F.col("_at").between(F.col("_lo") - hold, F.col("_hi") + hold), F.col("_s"))
    return df.withColumn(out, F.when(F.col("_c") >= 3, smooth).otherwise(F.col(value))).drop("_f", "_m", "_s", "_at", "_lo", "_hi", "_c")


def gradient(df: DataFrame, key: list[str], order: str, value: str, rate: float = FPS, out: str = "gradient") -> DataFrame:
    """Central differences, one-sided at the ends; null next to a null."""
    w = along(key, order)
    v, before, after = F.col(value), F.lag(value).over(w), F.lead(value).over(w)
    first, last = F.row_number().over(w) == 1, F.row_number().over(back(key, order)) == 1
    return df.withColumn(out, F.when(first & last, None).when(first, (after - v) * rate).when(last, (v - before) * rate).otherwise((after - before) * (rate / 2)))


def running_max(df: DataFrame, key: list[str], order: str, value: str, out: str = "peak") -> DataFrame:
    return df.withColumn(out, F.max(value).over(running(along(key, order))))


def rising(df: DataFrame, key: list[str], order: str, value: str, least: float = 1e-6, out: str = "peak") -> DataFrame:
    """Rows at which the running maximum rises by more than ``least``, and the first; the maximum is added."""
    df = running_max(df.where(F.col(value).isNotNull()), key, order, value, out)
    df = df.withColumn("_step", F.col(out) - F.lag(out).over(along(key, order)))
    return df.where(F.col("_step").isNull() | (F.col("_step") > least)).drop("_step")


def counting(df: DataFrame, key: list[str], order: str, value: str, max_dt: float = 0.3, tolerance: float = 0.08, out: str = "counting") -> DataFrame:
    """Rows at which a clock counts: the value is positive and moves as far as the time since the row before."""
    w = along(key, order)
    dt, dv = F.col(order) - F.lag(order).over(w), F.col(value) - F.lag(value).over(w)
    return df.withColumn(out, F.coalesce((F.col(value) > 0) & (dt < max_dt) & (F.abs(dv - dt) < tolerance), F.lit(False)))


def clusters(df: DataFrame, key: list[str], value: str, tolerance: float = 30, out: str = "slot") -> DataFrame:
    """Label values by the median (towards zero) of the distinct values of their cluster; a gap of more than ``tolerance`` begins a new one."""
    seen = df.select(*key, value).where(F.col(value).isNotNull()).distinct()
    w = along(key, value)
    seen = seen.withColumn("_new", F.coalesce((F.col(value) - F.lag(value).over(w) > tolerance).cast("int"), F.lit(0))).withColumn("_cluster", F.sum("_new").over(running(w)))
    labels = seen.groupBy(*key, "_cluster").agg(F.median(value).cast("int").alias(out))
    return df.join(seen.join(labels, [*key, "_cluster"]).select(*key, value, out), [*key, value], "left").select(*df.columns, out)


def gap_sessions(df: DataFrame, key: list[str], order: str, gap: float, out: str = "session") -> DataFrame:
    """Number stretches of rows without a gap of more than ``gap``, from 0."""
    w = along(key, order)
    new = F.coalesce((F.col(order) - F.lag(order).over(w) > gap).cast("bigint"), F.lit(0).cast("bigint"))
    return df.withColumn("_new", new).withColumn(out, F.sum("_new").over(running(w))).drop("_new")


def hold_steps(df: DataFrame, touches: DataFrame, key: list[str], order: str, place: str, rate: float = FPS) -> DataFrame:
    """Step frequency and length, held from each touchdown to the next; nothing after the last.

    ``touches`` has the key, the order and the place of each touchdown; it joins by the rows' latest touchdown, without a range join."""
    w = along(key, order)
    step = touches.select(*key, order, (rate / (F.lead(order).over(w) - F.col(order))).alias("_f"), (F.lead(place).over(w) - F.col(place)).alias("_l"))
    df = df.join(step.withColumn("_touch", F.struct("_f", "_l")).drop("_f", "_l"), [*key, order], "left")
    df = df.withColumn("_held", F.last("_touch", ignorenulls=True).over(running(w)))
    return df.withColumn("step_freq_hz", F.col("_held._f")).withColumn("step_len_yd", F.col("_held._l")).drop("_touch", "_held")


def first_repeat(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Each key's first value that the next row repeats, and when."""
    w = along(key, order)
    again = df.withColumn("_next", F.lead(value).over(w)).where(F.col("_next") == F.col(value))
    return again.groupBy(*key).agg(F.min(order).alias("repeat_at"), F.min_by(value, order).alias("repeated"))


def foot_contact(slowest: Column, body: Column, share: float = 0.35, least: float = 1.5) -> Column:
    """1 if the slowest foot is slower than a share of the body's speed (but at least ``least``), else 0; null without a foot."""
    return F.when(slowest.isNotNull(), (slowest < F.greatest(F.lit(share) * F.coalesce(body, F.lit(0.0)), F.lit(least))).cast("double"))


def value_near(samples: DataFrame, key: list[str], order: str, value: str, at: DataFrame, reach: float = 5, ends: int = 4, out: str = "value") -> DataFrame:
    """The value at the places in ``at`` (key and _at, one or more a key): interpolated, or continued by the line through the
    last (first) ``ends`` samples over at most ``reach``; null for fewer than ``ends`` samples."""
    s = samples.where(F.col(value).isNotNull()).select(*key, F.col(order).cast("double").alias("_t"), F.col(value).alias("_v"))
    s = s.withColumn("_r", F.row_number().over(along(key, "_t"))).withColumn("_q", F.row_number().over(back(key, "_t")))
    s = s.withColumn("_t1", F.lead("_t").over(along(key, "_t"))).withColumn("_v1", F.lead("_v").over(along(key, "_t")))
    span = s.groupBy(*key).agg(
        F.count("*").alias("_n"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi"), F.max_by("_v", "_t").alias("_vhi"),
        *(f(F.when(F.col(c) <= ends, F.col("_v")), F.when(F.col(c) <= ends, F.col("_t"))).alias(n) for c, p in (("_r", "_a"), ("_q", "_b")) for f, n in ((F.regr_slope, p + "s"), (F.regr_intercept, p + "i"))),
    )
    asked = at.join(span, key, "left")
    inside = asked.join(s.select(*key, "_t", "_v", "_t1", "_v1"), key, "left").where((F.col("_t") <= F.col("_at")) & (F.col("_at") < F.col("_t1")))
    inside = inside.select(*key, "_at", (F.col("_v") + (F.col("_v1") - F.col("_v")) * (F.col("_at") - F.col("_t")) / (F.col("_t1") - F.col("_t"))).alias("_in"))
    got = asked.join(inside, [*key, "_at"], "left")
    below, above = F.col("_as") * F.col("_at") + F.col("_ai"), F.col("_bs") * F.col("_at") + F.col("_bi")
    found = F.when(F.col("_n") < ends, None).when((F.col("_at") < F.col("_lo") - reach) | (F.col("_at") > F.col("_hi") + reach), None).when(F.col("_at") < F.col("_lo"), below).when(F.col("_at") > F.col("_hi"), above).when(F.col("_at") == F.col("_hi"), F.col("_vhi")).otherwise(F.col("_in"))
    return got.select(*key, "_at", found.alias(out))
