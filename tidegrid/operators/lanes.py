"""Positions on a lane: rows of marks seen in perspective, lines across them, and places along them.

A row is a struct (x, y, dx, dy, a, b, c, resid): a point and the unit direction of its line in the image, and the projective map
from the mark number s to the place u along the line.  World places are mark numbers plus a row's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions import geometry as G
from tidegrid.operators.fits import consensus
from tidegrid.operators.series import robust_smooth

ROW = "struct<x:double,y:double,dx:double,dy:double,a:double,b:double,c:double,resid:double>"
#: The largest residual of a usable row, and the image's middle.
RESID_MAX = 0.08
MIDDLE = 960.0


def usable(rows: Column) -> Column:
    """Two rows, both fitted well."""
    return (F.size(rows) == 2) & F.forall(rows, lambda r: r["resid"] <= RESID_MAX)


def start_of(row: Column) -> G.Point:
    return row["x"], row["y"]


def direction(row: Column) -> G.Point:
    return row["dx"], row["dy"]


def along_row(row: Column, p: G.Point) -> Column:
    """The place u of the foot of p on the row's line."""
    return G.dot(G.minus(p, start_of(row)), direction(row))


def number_at(row: Column, u: Column) -> Column:
    return G.unproject(u, row["a"], row["b"], row["c"])


def point_at(row: Column, s: Column) -> G.Point:
    u = G.project(s, row["a"], row["b"], row["c"])
    return row["x"] + u * row["dx"], row["y"] + u * row["dy"]


def below(row: Column, x: Column) -> Column:
    """The mark number straight below (or above) an abscissa."""
    return number_at(row, along_row(row, G.at_x(start_of(row), direction(row), x)))


def rung(near: Column, far: Column, s: Column, offset: Column, theta: Column) -> G.Point:
    """The vector from the near row's line to the far row at world place s, in the direction of the angle theta from the far row."""
    t, angle = direction(far), F.radians(theta)
    d = (F.cos(angle) * t[0] + F.sin(angle) * t[1], F.cos(angle) * t[1] - F.sin(angle) * t[0])
    p = point_at(far, s - offset)
    _, _, way = G.cross_line(p, d, start_of(near), direction(near))
    return -way * d[0], -way * d[1]


def lane_point(near: Column, far: Column, s: Column, w: Column, offset: Column, theta: Column) -> G.Point:
    """The image of world place s at lateral position w (0: near row, 1: far row)."""
    p, d = point_at(far, s - offset), rung(near, far, s, offset, theta)
    return p[0] + (w - 1) * d[0], p[1] + (w - 1) * d[1]


def across(near: Column, far: Column, p: G.Point, offset: Column, theta: Column) -> tuple[Column, Column]:
    """World place and lateral position of the rung through an image point.  Rungs are parallel, so that this is a plain crossing of lines."""
    t, angle = direction(far), F.radians(theta)
    d = (F.cos(angle) * t[0] + F.sin(angle) * t[1], F.cos(angle) * t[1] - F.sin(angle) * t[0])
    x, y, _ = G.cross_line(p, d, start_of(far), t)
    s = number_at(far, along_row(far, (x, y))) + offset
    r = rung(near, far, s, offset, theta)
    foot = point_at(far, s - offset)
    return s, 1 + G.dot(G.minus(p, foot), r) / G.dot(r, r)


def place_below(near: Column, far: Column, x: Column, w: Column, offset: Column, theta: Column, low: Column, high: Column) -> Column:
    """The world place between low and high at which the lane at lateral position w passes the abscissa x.

    For a fixed w the lane is a straight line on which the place along the row is linear, so that two of its points give the root."""
    t, angle = direction(far), F.radians(theta)
    d = (F.cos(angle) * t[0] + F.sin(angle) * t[1], F.cos(angle) * t[1] - F.sin(angle) * t[0])

    def abscissa(u: Column) -> Column:
        px, py = far["x"] + u * t[0], far["y"] + u * t[1]
        qx, _, _ = G.cross_line((px, py), d, start_of(near), direction(near))
        return w * px + (1 - w) * qx

    first, second = abscissa(F.lit(0.0)), abscissa(F.lit(1.0))
    s = number_at(far, (x - first) / (second - first)) + offset
    return F.when(s.between(low, high), s)


def first_root(values: Column, low: Column, step: Column) -> Column:
    """The first root of a function that is given at regular places, as an array of structs (i, f)."""
    pairs = F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values) - 1), lambda p, q: F.struct(p["i"].alias("i"), p["f"].alias("f"), q["f"].alias("g")))
    turn = F.get(F.filter(pairs, lambda p: F.signum(p["f"]) * F.signum(p["g"]) <= 0), F.lit(0))
    return low + step * turn["i"] + step * turn["f"] / (turn["f"] - turn["g"] + F.lit(1e-12))


def line_hits(lines: DataFrame, key: list[str], far: str, ends: tuple[str, str, str, str], reach: float = 250, apart: float = 25, tilt: float = 20) -> DataFrame:
    """Where painted lines meet the far row: place u and angle, one row per line.

    Segments that end more than ``reach`` from the row are left out, those within ``apart`` of the next are one line (medians), and
    lines whose angle is ``tilt`` or more off the key's median are dropped."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ends)
    row, a, b = F.col(far), (x0, y0), (x1, y1)
    size = G.norm(G.minus(b, a))
    d = ((x1 - x0) / size, (y1 - y0) / size)
    px, py, _ = G.cross_line(a, d, start_of(row), direction(row))
    hits = lines.withColumn("_x", px).withColumn("_y", py).where(F.col("_x").isNotNull())
    p = (F.col("_x"), F.col("_y"))
    hits = hits.where(F.least(G.norm(G.minus(a, p)), G.norm(G.minus(b, p))) <= reach)
    way = F.when(d[1] < 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    hits = hits.select(*key, along_row(row, p).alias("u"), G.rung_angle(direction(row), (way * d[0], way * d[1])).alias("angle"))
    w = Window.partitionBy(*key).orderBy("u", "angle")
    hits = hits.withColumn("_new", F.coalesce((F.col("u") - F.lag("u").over(w) > apart).cast("int"), F.lit(0)))
    hits = hits.withColumn("_line", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    lines = hits.groupBy(*key, "_line").agg(F.median("u").alias("u"), F.median("angle").alias("angle"))
    middle = F.percentile("angle", F.lit(0.5)).over(Window.partitionBy(*key))
    return lines.withColumn("_m", middle).where(F.abs(F.col("angle") - F.col("_m")) < tilt).select(*key, "u", "angle")


def angle_at(hits: DataFrame, key: list[str], at: DataFrame, u_ref: str, beyond: float = 300) -> DataFrame:
    """The rung angle at each key's place ``u_ref``: null without lines, the line's own with one, else by regression, at most ``beyond`` past the lines."""
    fit = hits.groupBy(*key).agg(F.count("*").alias("_n"), F.regr_slope("angle", "u").alias("_s"), F.regr_intercept("angle", "u").alias("_i"), F.min("u").alias("_lo"), F.max("u").alias("_hi"), F.avg("angle").alias("_one"))
    u = F.greatest(F.col("_lo") - beyond, F.least(F.col("_hi") + beyond, F.col(u_ref)))
    return at.join(fit, key, "left").withColumn("theta", F.when(F.col("_n") == 1, F.col("_one")).when(F.col("_n") > 1, F.col("_s") * u + F.col("_i"))).drop("_n", "_s", "_i", "_lo", "_hi", "_one")


def smooth_angles(angles: DataFrame, key: list[str], frame: str, theta: str = "theta") -> DataFrame:
    return robust_smooth(angles, key, frame, theta, out="theta_smooth")


def between_rows(near: Column, far: Column, p: G.Point, margin: float = 0.6) -> Column:
    """Whether a point is between the two rows, with a margin in units of their distance."""
    yn, yf = G.at_x(start_of(near), direction(near), p[0])[1], G.at_x(start_of(far), direction(far), p[0])[1]
    return p[1].between(yf - margin * (yn - yf), yn + margin * (yn - yf))


def midpoint_if_sure(points: Column, a: int, b: int, least: float = 0.3) -> Column:
    """The middle of two keypoints (structs x, y, conf; numbers from 0) as a struct, null if either is unsure or any keypoint is null."""
    p, q = F.element_at(points, a + 1), F.element_at(points, b + 1)
    whole = F.forall(points, lambda k: k["x"].isNotNull() & k["y"].isNotNull() & k["conf"].isNotNull())
    return F.when(whole & (p["conf"] >= least) & (q["conf"] >= least), F.struct(((p["x"] + q["x"]) / 2).alias("x"), ((p["y"] + q["y"]) / 2).alias("y")))


def body_core(points: Column, box: Column, least: float = 0.3) -> Column:
    """Hip and shoulder middles; from the box (x0, y0, x1, y1) where a keypoint is unsure."""
    k = {n: F.element_at(points, i + 1) for n, i in (("ls", 5), ("rs", 6), ("lh", 11), ("rh", 12))}
    sure = F.least(*(v["conf"] for v in k.values())) >= least
    cx, h = (box[0] + box[2]) / 2, box[3] - box[1]
    middle = lambda a, b, c: ((k[a][c] + k[b][c]) / 2).cast("double")
    whole = F.struct(middle("lh", "rh", "x").alias("hx"), middle("lh", "rh", "y").alias("hy"), middle("ls", "rs", "x").alias("sx"), middle("ls", "rs", "y").alias("sy"), F.lit(True).alias("sure"))
    guess = F.struct(cx.cast("double").alias("hx"), (box[1] + 0.55 * h).cast("double").alias("hy"), cx.cast("double").alias("sx"), (box[1] + 0.25 * h).cast("double").alias("sy"), F.lit(False).alias("sure"))
    return F.when(sure, whole).otherwise(guess)


def start_line(marks: DataFrame, key: list[str], frame: str, near: str, far: str, hands: str, reach: float = 1.5) -> DataFrame:
    """The start line's place on the far row and the frames that support it.

    ``marks`` has the places at which cross-lane marks meet both rows; those further than ``reach`` from the hands (constant for a key, null if
    not seen) are other marks."""
    some = marks.where(F.col(hands).isNull() | (F.abs(F.col(near) - F.col(hands)) < reach))
    found = consensus(some, key, frame, near, far, 0.1)
    return marks.select(*key).distinct().join(found, key, "left").select(*key, F.col("median").alias("s_start"), F.coalesce("support", F.lit(0)).alias("start_support"))


def lane_angle(marks: DataFrame, key: list[str], theta: str, close: float = 6) -> DataFrame:
    """The angle that most marks share within ``close`` degrees (of equals, the largest), from counts in 1-degree bands of neighbours.

    A mark meets the marks of its own frame in bands near its own, not every mark."""
    d = marks.select(*key, F.pmod(F.col(theta).cast("double"), F.lit(180.0)).alias("_t")).withColumn("_b", F.floor("_t").cast("int"))
    reach = int(close) + 1
    other = d.withColumn("_near", F.explode(F.sequence(F.col("_b") - reach, F.col("_b") + reach))).select(*key, F.col("_t").alias("_o"), F.pmod(F.col("_near"), F.lit(180)).alias("_b"))
    votes = d.distinct().join(other, [*key, "_b"]).where(G.angular_distance(F.col("_t"), F.col("_o")) < close).groupBy(*key, "_t").agg(F.count("*").alias("_n"))
    return votes.groupBy(*key).agg(F.max_by("_t", F.struct("_n", "_t")).alias("lane_theta"), F.max("_n").alias("votes"))


def classify_marks(marks: DataFrame, key: list[str], theta: str, length: str, along: float = 8, off: float = 25, longest: float = 60) -> DataFrame:
    """``kind``: "along" the lane, "across" it, or null."""
    d = G.angular_distance(F.col(theta), F.col("lane_theta"))
    return marks.join(lane_angle(marks, key, theta).drop("votes"), key).withColumn("kind", F.when(d < along, "along").when((d > off) & (F.col(length) > longest), "across"))


def near_and_far(rows: DataFrame, key: list[str], row: str) -> DataFrame:
    """A key's two rows with the one that is lower in the image first."""
    y = F.when(F.abs(F.col(f"{row}.dx")) > 1e-6, G.at_x(start_of(F.col(row)), direction(F.col(row)), F.lit(MIDDLE))[1]).otherwise(F.col(f"{row}.y"))
    packed = rows.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct((-y).alias("y"), F.col(row).alias("r")))).alias("_rows"))
    return packed.select(*key, F.transform("_rows", lambda r: r["r"]).alias("rows"))


def lateral_position(marks: DataFrame, key: list[str], w: str) -> DataFrame:
    return marks.groupBy(*key).agg(F.median(w).alias("w_run"))
