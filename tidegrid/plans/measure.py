"""From what a camera saw to places along the lane.

Inputs, all with run_id and the frame k: ``frames`` (one row for each frame: rows, an array of the near and the far row of marks, see
``operators.lanes``), ``bodies`` (number, kpts: 17 structs x, y, conf, box: x0, y0, x1, y1), ``lines`` and ``marks`` (segments x0, y0, x1, y1: painted
lines, and marks across the lane), and ``runs`` (run_id, k0).  Everything is joined by run and frame; three scans are grouped Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions import geometry as G
from tidegrid.operators import kernels, lanes

KEY = ["run_id", "k"]
Stage = Callable[[str, DataFrame], DataFrame]


def as_it_is(name: str, df: DataFrame) -> DataFrame:
    return df


# Keypoint numbers, and the least confidence of one.
WRISTS, HIPS, LEGS, ANKLES = (9, 10), (11, 12), (13, 14, 15, 16), (15, 16)
SURE = 0.3


def usable_frames(frames: DataFrame) -> DataFrame:
    """Frames with two well-fitted rows, as near and far."""
    return frames.where(lanes.usable(F.col("rows"))).select(*KEY, F.col("rows")[0].alias("near"), F.col("rows")[1].alias("far"))


def _noted(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the column ``error``: the message that a run's scans left."""
    rows = rows if "error" in rows.columns else rows.withColumn("error", F.lit(None).cast("string"))
    failed = kernels.failures(found, ["run_id"]).groupBy("run_id").agg(F.min("error").alias("_error"))
    return rows.join(failed, "run_id", "left").withColumn("error", F.coalesce("error", "_error")).drop("_error")


def offsets(rows: DataFrame) -> DataFrame:
    """Whole offsets of both rows that make places continuous from frame to frame."""
    sides = F.array(*(F.struct(F.lit(i).alias("row"), lanes.below(F.col(c), F.lit(lanes.MIDDLE)).alias("raw")) for i, c in enumerate(("near", "far"))))
    long = rows.select(*KEY, F.explode(sides).alias("s")).select(*KEY, "s.row", "s.raw")
    found = kernels.unwrap_offsets(long, ["run_id", "row"], "k", "raw")
    rows = _noted(rows, found)
    found = found.where("error IS NULL")
    side = lambda i, name: found.where(F.col("row") == i).select("run_id", F.col("frame").alias("k"), F.col("offset").alias(name))
    return rows.join(side(0, "off_near"), KEY, "left").join(side(1, "off_far"), KEY, "left")


def _count(points: Column, which: tuple[int, ...], test) -> Column:
    return sum(((_at(points, j)["conf"] > SURE) & test(_at(points, j))).cast("int") for j in which)


def _at(points: Column, j: int) -> Column:
    return F.element_at(points, j + 1)


def follow(bodies: DataFrame, rows: DataFrame, runs: DataFrame, frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The runner's keypoints in each frame, and ``rows`` with what failed."""
    b = bodies.join(rows.select(*KEY, "near", "far"), KEY, "left")
    on = lambda margin: lambda p: F.coalesce(lanes.between_rows(F.col("near"), F.col("far"), (p["x"], p["y"]), margin), F.lit(False))
    core = lanes.body_core(F.col("kpts"), F.col("box"))
    seen = _count(F.col("kpts"), LEGS, lambda p: F.lit(True))
    off = F.col("near").isNotNull() & (seen > 0) & (_count(F.col("kpts"), LEGS, on(1.0)) == 0)
    last = frames.groupBy("run_id").agg(F.max("k").alias("last"))
    flat = b.select(*KEY, "number", core.alias("c"), off.alias("off"), _count(F.col("kpts"), ANKLES + WRISTS, on(0.6)).alias("inside"), "box").join(runs.select("run_id", "k0"), "run_id").join(last, "run_id")
    flat = flat.select("run_id", F.col("k").alias("frame"), "number", "c.hx", "c.hy", "c.sx", "c.sy", "c.sure", *(F.col("box")[i].cast("double").alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))), "off", "inside", "k0", "last")
    tracked = kernels.track_bodies(flat, ["run_id"])
    found = tracked.where("error IS NULL").select("run_id", F.col("frame").alias("k"), "number")
    return found.join(bodies.select(*KEY, "number", "kpts"), [*KEY, "number"]).select(*KEY, "kpts", lanes.midpoint_if_sure(F.col("kpts"), *HIPS, SURE).alias("hip")), _noted(rows, tracked)


def repaired(rows: DataFrame, runner: DataFrame, runs: DataFrame) -> DataFrame:
    """``rows`` with the far offsets freed of slips."""
    seen = rows.join(runner.select(*KEY, "hip"), KEY, "left").join(runs.select("run_id", "k0"), "run_id")
    seen = seen.select(*KEY, "off_far", lanes.below(F.col("far"), F.col("hip")["x"]).alias("below"), (F.floor("k0") - 5).cast("int").alias("ref"))
    found = kernels.repair_offsets(seen, ["run_id"], "k", "off_far", "below", "ref")
    rows = _noted(rows, found)
    fixed = found.where("error IS NULL").select("run_id", F.col("frame").alias("k"), F.col("offset").alias("_far"))
    return rows.join(fixed, KEY, "left").withColumn("off_far", F.col("_far")).drop("_far")


def starts(rows: DataFrame, runner: DataFrame, marks: DataFrame, runs: DataFrame) -> DataFrame:
    """Each run's start line and its support."""
    near, far = F.col("near"), F.col("far")
    near_time = lambda low, high: F.col("k").between(F.floor("k0") - low, F.floor("k0") + high)
    hands = runner.join(rows.select(*KEY, "near", "off_near"), KEY).join(runs.select("run_id", "k0"), "run_id").where(near_time(10, 0))
    hands = hands.select("run_id", "near", "off_near", F.explode(F.array(*(_at(F.col("kpts"), j) for j in WRISTS))).alias("p")).where(F.col("p.conf") > SURE)
    hands = hands.groupBy("run_id").agg(F.median(lanes.below(near, F.col("p.x")) + F.col("off_near")).alias("hands"))
    m = marks.join(rows, KEY).join(runs.select("run_id", "k0"), "run_id").where(near_time(40, 44) & F.col("off_near").isNotNull() & F.col("off_far").isNotNull())
    size = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    a, d = (F.col("x0"), F.col("y0")), ((F.col("x1") - F.col("x0")) / size, (F.col("y1") - F.col("y0")) / size)
    crossing = [G.cross_line(a, d, lanes.start_of(r), lanes.direction(r)) for r in (near, far)]
    place = [lanes.number_at(r, lanes.along_row(r, (x, y))) + F.col(o) for r, (x, y, _), o in zip((near, far), crossing, ("off_near", "off_far"), strict=True)]
    m = m.select("run_id", "k", place[0].alias("near"), place[1].alias("far"), crossing[0][2].alias("tn"), crossing[1][2].alias("tf"), size.alias("size"))
    m = m.where((F.least("tn", "tf") >= -25) & (F.greatest("tn", "tf") <= F.col("size") + 25)).join(hands, "run_id", "left")
    return runs.select("run_id").join(lanes.start_line(m, ["run_id"], "k", "near", "far", "hands"), "run_id", "left")


def measure(frames: DataFrame, bodies: DataFrame, lines: DataFrame, marks: DataFrame, runs: DataFrame, low: float = -50.0, high: float = 500.0) -> tuple[DataFrame, DataFrame]:
    """Places and crossings, as ``measured`` describes them."""
    places, crossings, _ = measured(frames, bodies, lines, marks, runs, low, high)
    return places, crossings


def measured(frames: DataFrame, bodies: DataFrame, lines: DataFrame, marks: DataFrame, runs: DataFrame, low: float = -50.0, high: float = 500.0, stage: Stage = as_it_is) -> tuple[DataFrame, DataFrame, tuple[DataFrame, DataFrame, DataFrame]]:
    """Places, crossings, and (the usable rows with their offsets, the runner, the start lines).

    Places: run_id, k, s (periods from the start line, null where unknown), on_lane, theta, w_run, start_support and error (what a run's scan failed of).  Crossings: run_id, k and s of
    each painted line on the far row.  ``stage`` may write a table and read it again."""
    rows = stage("offsets", offsets(usable_frames(frames)))
    runner, rows = follow(bodies, rows, runs, frames)
    runner = stage("runner", runner)
    rows = stage("repaired", repaired(stage("followed", rows), runner, runs))
    begin = stage("starts", starts(rows, runner, marks, runs))
    far = F.col("far")
    known = rows.where(F.col("off_far").isNotNull()).join(runner, KEY, "left")
    hits = stage("hits", lanes.line_hits(lines.join(known.select(*KEY, "far"), KEY), KEY, "far", ("x0", "y0", "x1", "y1")))
    x = F.coalesce(F.col("hip")["x"], F.lit(lanes.MIDDLE))
    at = known.select(*KEY, lanes.along_row(far, G.at_x(lanes.start_of(far), lanes.direction(far), x)).alias("u_ref"))
    angles = lanes.smooth_angles(frames.select(*KEY).join(lanes.angle_at(hits, KEY, at, "u_ref").select(*KEY, "theta"), KEY, "left"), ["run_id"], "k")
    angles = stage("angles", angles)
    full = known.join(angles.select(*KEY, F.col("theta_smooth").alias("theta")), KEY).join(begin, "run_id").where(F.col("theta").isNotNull() & F.col("s_start").isNotNull())
    args = F.col("near"), far
    feet = full.select("run_id", "near", "far", "off_far", "theta", F.explode(F.array(*(_at(F.col("kpts"), j) for j in ANKLES))).alias("p")).where(F.col("p.conf") > SURE)
    _, w = lanes.across(*args, (F.col("p.x"), F.col("p.y")), F.col("off_far"), F.col("theta"))
    side = lanes.lateral_position(feet.withColumn("w", w), ["run_id"], "w")
    full = full.join(side, "run_id", "left")
    s = lanes.place_below(*args, F.col("hip")["x"], F.col("w_run"), F.col("off_far"), F.col("theta"), F.lit(low), F.lit(high)) - F.col("s_start")
    full = full.select(*KEY, s.alias("s"), F.lit(True).alias("on_lane"), "theta", "w_run")
    errors = rows.groupBy("run_id").agg(F.min("error").alias("error"))
    places = frames.select(*KEY).join(full, KEY, "left").join(errors, "run_id", "left").join(begin.select("run_id", "start_support"), "run_id", "left").withColumn("on_lane", F.coalesce("on_lane", F.lit(False)))
    crossings = hits.join(known.select(*KEY, "far", "off_far"), KEY).join(begin, "run_id").where("s_start IS NOT NULL").select(*KEY, (lanes.number_at(far, F.col("u")) + F.col("off_far") - F.col("s_start")).alias("s"))
    return places, crossings, (rows, runner, begin)


def lane_frames(frames: DataFrame, bodies: DataFrame, lines: DataFrame, marks: DataFrame, runs: DataFrame, stage: Stage = as_it_is) -> tuple[DataFrame, DataFrame]:
    """What ``plans.build.channels`` takes, a row for each frame of the clips, and the crossings."""
    places, crossings, (rows, runner, begin) = measured(frames, bodies, lines, marks, runs, stage=stage)
    places = stage("places", places)
    seen = places.drop("start_support").join(rows.select(*KEY, "near", "far", "off_far"), KEY, "left").join(runner.select(*KEY, "kpts"), KEY, "left").join(begin, "run_id", "left")
    out = seen.join(runs.select("run_id", "k0"), "run_id").withColumnRenamed("k", "frame")
    return out.withColumn("kpts", F.coalesce("kpts", F.array().cast(runner.schema["kpts"].dataType))), crossings
