"""Robust and least-squares fits as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators.series import FPS


def clock_fit(readings: DataFrame, key: list[str], frame: str, value: str, rate: float = FPS, below: str | None = None) -> DataFrame:
    """The frame at which each key's clock is zero, by the median with the slope fixed by the frame rate; the 95th percentile of the
    residuals' sizes, whether readings never fall, and their number.  ``below`` names a column that readings stay under."""
    use = readings.where(F.col(value) > 0)
    if below:
        use = use.where(F.col(value) < F.col(below) - 1e-6)
    use = use.withColumn("_fall", F.col(value) - F.lag(value).over(Window.partitionBy(*key).orderBy(frame)) < -1e-6)
    zero = use.groupBy(*key).agg(F.median(F.col(frame) - F.col(value) * rate).alias("k0"), (~F.coalesce(F.bool_or("_fall"), F.lit(False))).alias("monotone"), F.count("*").alias("n"))
    rest = use.join(zero.select(*key, "k0"), key).withColumn("_r", F.abs(F.col(value) - (F.col(frame) - F.col("k0")) / rate))
    return zero.join(rest.groupBy(*key).agg(F.percentile("_r", F.lit(0.95)).alias("resid_p95")), key)


def vote(readings: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Each key's most common value (of equals, the one seen first), and its share."""
    counts = readings.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    best = counts.groupBy(*key).agg(F.max_by(F.col(value), F.struct(F.col("n"), -F.col("_first"))).alias("winner"), F.max("n").alias("_n"), F.sum("n").alias("_all"))
    return best.select(*key, "winner", (F.col("_n") / F.col("_all")).alias("agreement"))


def line(df: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    return df.groupBy(*key).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def slope_through_zero(x: Column, y: Column) -> Column:
    return F.sum(x * y) / F.sum(x * x)


def grid_fit(df: DataFrame, key: list[str], s: str, spacing: float = 5.0, low: float = 1.9, step: float = 0.0005, count: int = 401, near: float = 0.25, inside: float = 0.3) -> DataFrame:
    """The scale that puts most places near a multiple of ``spacing`` (the first of equals), then least squares over those inside.

    The candidates that a place supports are a range for each multiple in reach.  Only where a range begins and ends is sent on, added before the
    shuffle, and summed along the candidates: two rows for a multiple, whatever the grid's fineness."""
    off = lambda p: F.abs(F.col(s) * p - spacing * F.rint(F.col(s) * p / spacing))
    scale = lambda g: F.lit(low) + g * F.lit(step)
    # Around each multiple in reach lies a range of candidates, a step wider here against rounding; the exact test follows.
    size, last = F.abs(F.col(s)), count - 1
    number = lambda p: (p / size - low) / step

    def around(n: Column) -> Column:
        a = F.greatest(F.lit(0), F.floor(number(spacing * n - near)).cast("int"))
        b = F.least(F.lit(last), F.ceil(number(spacing * n + near)).cast("int"))
        return F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))

    multiples = F.sequence(F.floor(size * low / spacing), F.ceil(size * (low + last * step) / spacing))
    ends = lambda a, b: F.array(F.struct(a.alias("g"), F.lit(1).alias("d")), F.struct((b + 1).alias("g"), F.lit(-1).alias("d")))
    hit = lambda tried: F.filter(tried, lambda g: off(scale(g)) < near)
    ranges = F.flatten(F.transform(F.filter(F.transform(multiples, lambda n: hit(around(n))), lambda h: F.size(h) > 0), lambda h: ends(h[0], F.element_at(h, -1))))
    steps = F.when(size < near / 10, ends(F.lit(0), F.lit(last))).otherwise(ranges)
    votes = df.where(F.col(s).isNotNull()).select(*key, F.explode(steps).alias("_e")).groupBy(*key, F.col("_e.g").alias("_g")).agg(F.sum("_e.d").alias("_d"))
    votes = votes.withColumn("_n", F.sum("_d").over(Window.partitionBy(*key).orderBy("_g")))
    top = votes.groupBy(*key).agg(F.max(F.struct(F.col("_n"), (-F.col("_g")).alias("_g"))).alias("_t"))
    sizes = df.groupBy(*key).agg(F.count(s).alias("_size")).where("_size > 0")
    best = sizes.join(top, key, "left") if key else sizes.crossJoin(F.broadcast(top))  # without a key, one row each
    best = best.select(*key, scale(F.coalesce(-F.col("_t._g"), F.lit(0))).alias("coarse"), (F.coalesce("_t._n", F.lit(0)) / F.col("_size")).alias("share"))
    joined = df.join(best, key) if key else df.crossJoin(F.broadcast(best))  # one row
    target = spacing * F.rint(F.col(s) * F.col("coarse") / spacing)
    hit = joined.withColumn("_target", target).where(F.abs(F.col(s) * F.col("coarse") - F.col("_target")) < inside)
    fitted = hit.groupBy(*key).agg(slope_through_zero(F.col(s), F.col("_target")).alias("scale"))
    return best.join(fitted, key, "left") if key else best.crossJoin(F.broadcast(fitted))


def consensus(df: DataFrame, key: list[str], frame: str, place: str, value: str, reach: float = 0.1) -> DataFrame:
    """The place that most different frames support within ``reach`` (the first of equals), its number of frames, and the median of ``value`` there.

    Places are put in bands of ``reach``; only neighbouring bands are compared, so that the join is by equality."""
    d = df.select(*key, F.col(frame).alias("_k"), F.col(place).alias("_s"), F.col(value).alias("_v")).withColumn("_b", F.floor(F.col("_s") / reach)).withColumn("_o", F.row_number().over(Window.partitionBy(*key).orderBy("_k", "_s", "_v")))
    other = d.select(*key, F.col("_k").alias("_k2"), F.col("_s").alias("_s2"), F.col("_v").alias("_v2"), F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)).alias("_b"))
    pairs = d.join(other, [*key, "_b"]).where(F.abs(F.col("_s") - F.col("_s2")) < reach)
    support = pairs.groupBy(*key, "_o").agg(F.count_distinct("_k2").alias("support"), F.median("_v2").alias("median"))
    return support.groupBy(*key).agg(F.max_by(F.struct("support", "median"), F.struct(F.col("support"), -F.col("_o"))).alias("_w")).select(*key, "_w.median", "_w.support")


def projective_fit(df: DataFrame, key: list[str], s: str, u: str) -> DataFrame:
    """a, b and c of u = (a s + b) / (c s + 1) by least squares: the normal equations as sums, solved in closed form."""
    x, y = F.col(s), F.col(u)
    z = -x * y
    sums = {"xx": x * x, "x1": x, "xz": x * z, "11": F.lit(1.0), "1z": z, "zz": z * z, "xy": x * y, "1y": y, "zy": z * y}
    m = df.groupBy(*key).agg(*(F.sum(v).alias(f"_{k}") for k, v in sums.items()))
    c = {k: F.col(f"_{k}") for k in sums}

    def det(p, q, r):
        return p[0] * (q[1] * r[2] - q[2] * r[1]) - q[0] * (p[1] * r[2] - p[2] * r[1]) + r[0] * (p[1] * q[2] - p[2] * q[1])

    one, two, three, right = [c["xx"], c["x1"], c["xz"]], [c["x1"], c["11"], c["1z"]], [c["xz"], c["1z"], c["zz"]], [c["xy"], c["1y"], c["zy"]]
    whole = det(one, two, three)
    solve = lambda d: F.when(F.abs(whole) > 1e-12, d / whole)
    return m.select(*key, solve(det(right, two, three)).alias("a"), solve(det(one, right, three)).alias("b"), solve(det(one, two, right)).alias("c"))


def multiple_residual(x: Column, spacing: float = 5.0) -> Column:
    """The median distance to the nearest multiple of ``spacing``."""
    return F.median(F.abs(x - spacing * F.rint(x / spacing)))


def mode_of(df: DataFrame, key: list[str], value: str, least: int = 3) -> DataFrame:
    """The most common value (the smallest of equals) of keys with at least ``least`` values."""
    return df.groupBy(*key).agg(F.when(F.count(value) >= least, F.mode(value, True)).alias("mode"))
