"""Resampling on grids.

Two neighbouring samples enclose the grid points between them, so that each segment makes its own grid points by
arithmetic and no range join is needed: the work is samples plus grid points, and the only shuffle is by key.
Points before the first and after the last sample come from the first and last row of the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators.series import along, rising


def segments(samples: DataFrame, key: list[str], t: str, v: str) -> DataFrame:
    """Samples without nulls as segments: key, t0, v0, t1, v1 (null after the last), first, n."""
    w, whole = along(key, "t0"), Window.partitionBy(*key)
    s = samples.where(F.col(v).isNotNull() & F.col(t).isNotNull()).select(*key, F.col(t).cast("double").alias("t0"), F.col(v).cast("double").alias("v0"))
    return s.select(*key, "t0", "v0", F.lead("t0").over(w).alias("t1"), F.lead("v0").over(w).alias("v1"), F.lag("v0").over(w).alias("_v"), F.lag("t0").over(w).alias("_t"), F.count("t0").over(whole).alias("n")).withColumn("first", F.col("_t").isNull())


class Grid:
    """Regular points origin + number * step, for the numbers low to high; each a column of what is constant for a key."""

    def __init__(self, origin: Column, step: Column, low: Column, high: Column):
        self.origin, self.step, self.low, self.high = origin, step, low.cast("bigint"), high.cast("bigint")

    def point(self, i: Column) -> Column:
        return self.origin + self.step * i

    def number(self, x: Column) -> Column:
        return F.when(self.step > 0, F.floor((x - self.origin) / self.step)).otherwise(self.low).cast("bigint")


def on_grid(samples: DataFrame, key: list[str], t: str, v: str, grid: Grid, carry: list[str] | None = None, method: str = "linear", out: str = "value") -> DataFrame:
    """The series at the points of ``grid``: key, ``carry``, _i, _at and the value.

    ``carry`` names columns that are constant for a key and that the grid may use.  ``linear`` bridges gaps and gives null outside
    of the samples; ``nearest`` takes the closer sample (the later of two as close) and clamps.  Keys with fewer than two samples get nulls.
    """
    whole = [*key, *(carry or [])]
    s = segments(samples, whole, t, v)
    clip = lambda x: F.greatest(grid.low, F.least(grid.high, x))
    # A number more on either side against rounding; the exact test follows.
    begin = F.when(F.col("first"), grid.low).otherwise(clip(grid.number(F.col("t0")) - 1))
    end = F.when(F.col("t1").isNull(), grid.high).otherwise(clip(grid.number(F.col("t1")) + 1))
    s = s.withColumn("_b", begin).withColumn("_e", F.greatest(begin, end)).withColumn("_i", F.explode(F.sequence("_b", "_e")))
    s = s.withColumn("_at", grid.point(F.col("_i")))
    x, t0, t1 = F.col("_at"), F.col("t0"), F.col("t1")
    s = s.where(((x >= t0) | F.col("first")) & (t1.isNull() | (x < t1)))
    if method == "linear":
        found = F.when((x < t0) | (t1.isNull() & (x > t0)), None).when(x == t0, F.col("v0")).otherwise(F.col("v0") + (F.col("v1") - F.col("v0")) / (t1 - t0) * (x - t0))
    else:
        found = F.when((x < t0) | t1.isNull() | (x - t0 < t1 - x), F.col("v0")).otherwise(F.col("v1"))
    return s.select(*whole, "_i", "_at", F.when(F.col("n") >= 2, found).alias(out))


def by_phase(samples: DataFrame, key: list[str], t: str, v: str, start: str, stop: str, points: int = 101, method: str = "linear", out: str = "value") -> DataFrame:
    """The window from ``start`` to ``stop`` (columns, constant for a key) at ``points`` equal steps: key, phase number and place."""
    span = (F.col(stop) - F.col(start)).cast("double")
    grid = Grid(F.col(start).cast("double"), span / (points - 1), F.lit(0), F.lit(points - 1))
    return on_grid(samples, key, t, v, grid, [start, stop], method, out)


def time_at_distance(samples: DataFrame, key: list[str], t: str, x: str, step: float = 0.25, last: float = 39.0, out: str = "t_at") -> DataFrame:
    """When the running maximum of ``x`` crosses each multiple of ``step`` (from 0 to ``last``) that lies within its range."""
    up = rising(samples, key, t, x, out="_peak")
    grid = Grid(F.lit(0.0), F.lit(float(step)), F.lit(0), F.lit(round(last / step)))
    return on_grid(up, key, "_peak", t, grid, None, "linear", out).where(F.col(out).isNotNull()).withColumnRenamed("_at", "distance")


def at_times(samples: DataFrame, key: list[str], t: str, v: str, asked: DataFrame, at: str, method: str = "linear", out: str = "value") -> DataFrame:
    """The series at any places: ``asked`` has the key and the column ``at``.  Samples and places are merged by one sort per key."""
    s = samples.where(F.col(v).isNotNull()).select(*key, F.col(t).cast("double").alias("_t"), F.col(v).cast("double").alias("_v"), F.lit(0).alias("_kind"))
    a = asked.select(*key, F.col(at).cast("double").alias("_t"), F.lit(None).cast("double").alias("_v"), F.lit(1).alias("_kind"))
    both = s.unionByName(a)
    known = F.when(F.col("_kind") == 0, F.struct(F.col("_t").alias("t"), F.col("_v").alias("v")))
    both = both.withColumn("_known", known)
    up = Window.partitionBy(*key).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*key).orderBy(F.col("_t").desc(), F.col("_kind").asc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("_b", F.last("_known", ignorenulls=True).over(up)).withColumn("_a", F.last("_known", ignorenulls=True).over(down)).withColumn("_n", F.count("_v").over(Window.partitionBy(*key)))
    x, b, a = F.col("_t"), F.col("_b"), F.col("_a")
    if method == "linear":
        found = F.when(b.isNull() | a.isNull(), None).when(a["t"] == b["t"], b["v"]).otherwise(b["v"] + (a["v"] - b["v"]) / (a["t"] - b["t"]) * (x - b["t"]))
    else:
        found = F.when(b.isNull(), a["v"]).when(a.isNull(), b["v"]).when(x - b["t"] < a["t"] - x, b["v"]).otherwise(a["v"])
    return both.where("_kind = 1").select(*key, x.alias(at), F.when(F.col("_n") >= 2, found).alias(out))
