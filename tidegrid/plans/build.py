"""The dataset build: runs with quality, identity and split, and their series, per frame and on both grids.

Input is what the vision layer leaves: a registry of runs, and per run and frame the measured place (x) and channels, lane
flags, logo and histogram.  The per-frame table is shuffled by run once; windows reuse that partitioning.  Only the touchdown
scan is grouped Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions import vectors
from tidegrid.functions.nulls import differs, lookup, round_floats, text_or
from tidegrid.operators import fits, identity, kernels, lanes, learn, pose, relational, resample, rulebook, series
from tidegrid.operators.series import FPS
from tidegrid.sources.schemas import CHANNELS, CORE, SCHEMAS

# Classes by code, and the panel's code by the session's positions.
CLASSES = {"skill": "SKILL", "strong": "STRONG", "line": "LINEMAN"}
GROUPS = {"WR": "WR", "CB": "DB", "SAF": "DB", "RB": "RB", "TE": "TE", "LB": "LB", "EDGE": "DL", "DT": "DL", "OT|G|C": "OL"}
POSITIONS = {"OT|G|C": "OL"}
# Yards in a period of the lane's marks, and the grids.
YARDS_PER_PERIOD = 1.8 / 0.9144
PHASES, STEP_YD, LAST_YD = 101, 0.25, 39.0
NAMES = [n for n, _, _ in CHANNELS]


def registry(runs_raw: DataFrame, videos: DataFrame, panel: DataFrame) -> DataFrame:
    """Runs with class, position, athlete and whether they belong to the session's group."""
    runs = runs_raw.join(learn.small(videos.select("video_id", "cls")), "video_id").join(panel.select("run_id", "panel_pos"), "run_id", "left")
    return runs.select(
        *(c for c in runs.columns if c not in ("cls", "panel_pos")), "panel_pos", lookup(F.col("cls"), CLASSES).alias("cls"), lookup(F.col("positions"), POSITIONS, F.col("positions")).alias("position"),
        F.concat("panel_pos", F.lit("-"), text_or(F.col("bib"), "<NA>")).alias("athlete"), differs(F.col("panel_pos"), lookup(F.col("positions"), GROUPS)).alias("off_group"),
    )


def in_window(frame: Column, k0: Column, final: Column, frames: Column) -> Column:
    """The clock's window and a frame either side."""
    low, high = F.greatest(F.lit(0), F.ceil(k0) - 1), F.least(frames, F.floor(k0 + final * FPS) + 2) - 1
    return frame.between(low, high)


def window_size(k0: Column, final: Column, frames: Column) -> Column:
    return F.greatest(F.lit(0), F.least(frames, F.floor(k0 + final * FPS) + 2) - F.greatest(F.lit(0), F.ceil(k0) - 1))


def kinematics(frames: DataFrame, s: str = "s") -> DataFrame:
    """x, v and a of each frame from the place s in periods; ``frames`` has run_id, frame and k0."""
    out = series.despike(frames, ["run_id"], "frame", s, 7, 0.2, "_s")
    out = out.withColumn("_x", F.col("_s") * YARDS_PER_PERIOD)
    out = series.gap_fill(out, ["run_id"], "frame", "_x", 4, "null", "_f")
    for name, width, degree, deriv in (("x_yd", 9, 2, 0), ("v_yds", 15, 3, 1), ("a_yds2", 21, 3, 2)):
        out = series.savgol(out, ["run_id"], "frame", "_f", width, degree, deriv, FPS, name)
    return out.withColumn("t_clock", F.bround((F.col("frame") - F.col("k0")) / FPS, 4)).drop("_s", "_x", "_f")


def on_the_ground(frames: DataFrame) -> DataFrame:
    """The run's direction in the image, the lane under the hip, and the ankles' places in yards.

    ``frames``: kpts (17 structs x, y, conf), near, far, off_far, theta (the lane), s (periods from the start), s_start and w_run; null lanes or places
    give nulls.  A foot stands for a few frames only, so that ankles are taken as they were seen, not smoothed."""
    lane = F.col("near"), F.col("far")
    at = F.col("s") + F.col("s_start")
    here, ahead = (lanes.lane_point(*lane, s, F.col("w_run"), F.col("off_far"), F.col("theta")) for s in (at, at + 0.25))
    step = (ahead[0] - here[0], ahead[1] - here[1])
    size = F.hypot(*step)
    out = frames.withColumn("forward", F.when(size.isNotNull(), F.struct((step[0] / size).alias("x"), (step[1] / size).alias("y")))).withColumn("ground_y", here[1])
    for side, joint in zip(("l", "r"), pose.ANKLES, strict=True):
        foot = pose.masked(F.col("kpts"), joint)
        place, _ = lanes.across(*lane, (foot["x"], foot["y"]), F.col("off_far"), F.col("theta"))
        out = out.withColumn(f"ankle_{side}", F.when(F.col("s").isNotNull(), place * YARDS_PER_PERIOD))
    return out


def body(frames: DataFrame, stage=lambda name, df: df) -> DataFrame:
    """The pose channels and the ankles' places of frames from ``plans.measure.lane_frames``: one shuffle by run and keypoint, then one by run.

    ``stage`` may write a table and read it again."""
    seen = stage("ground", on_the_ground(frames).drop("near", "far"))
    points = stage("keypoints", pose.smooth_keypoints(frames.select("run_id", "frame", "kpts"), ["run_id"], "frame", "kpts"))
    whole = seen.join(points, ["run_id", "frame"]).join(pose.body_scale(points, ["run_id"]), "run_id", "left")
    return pose.channels(whole).drop(*(f"p{j}" for j in pose.JOINTS), "forward", "ground_y", "leg_len", "arm_len", "kpts")


def channels(frames: DataFrame) -> DataFrame:
    """All channels of each frame of the clip, rounded, with ``valid``."""
    return finish_channels(strides(kinematics(body(frames))))


def strides(frames: DataFrame) -> DataFrame:
    """Foot contact and step channels, from the ankles' places (ankle_l, ankle_r, in yards) and the speed."""
    out = frames
    for side in ("l", "r"):
        out = series.gap_fill(out, ["run_id"], "frame", f"ankle_{side}", 2, "null", f"_a{side}")
        out = series.gradient(out, ["run_id"], "frame", f"_a{side}", FPS, f"_g{side}").withColumn(f"_v{side}", F.abs(F.col(f"_g{side}")))
    slowest = F.least("_vl", "_vr")
    left = F.coalesce(F.col("_vl"), F.lit(float("inf"))) <= F.coalesce(F.col("_vr"), F.lit(float("inf")))
    out = out.withColumn("foot_contact", series.foot_contact(slowest, F.col("v_yds"))).withColumn("_foot", F.when(left, F.col("ankle_l")).otherwise(F.col("ankle_r")))
    touches = kernels.find_touchdowns(out.select("run_id", "frame", "foot_contact", "_foot", "v_yds", "k0"), ["run_id"], "frame", "foot_contact", "_foot", "v_yds", "k0")
    out = with_errors(out, kernels.failures(touches, ["run_id"]))
    touches = touches.where(F.col("error").isNull()).select("run_id", "frame", "place")
    return series.hold_steps(out, touches, ["run_id"], "frame", "place").drop("_al", "_ar", "_gl", "_gr", "_vl", "_vr", "_foot")


def with_errors(frames: DataFrame, *failed: DataFrame) -> DataFrame:
    """The column ``error``: the first message that a run's scans left, or the one that is there already."""
    out = frames if "error" in frames.columns else frames.withColumn("error", F.lit(None).cast("string"))
    for f in failed:
        out = out.join(f.groupBy("run_id").agg(F.min("error").alias("_error")), "run_id", "left").withColumn("error", F.coalesce("error", "_error")).drop("_error")
    return out


def finish_channels(frames: DataFrame) -> DataFrame:
    """Rounding, and the flag for frames whose core channels are there."""
    out = round_floats(frames, 3, [c for c in NAMES if c != "foot_contact"])
    whole = F.lit(True)
    for c in CORE:
        whole = whole & F.col(c).isNotNull()
    return out.withColumn("valid", whole.cast("int"))


def metrics(frames: DataFrame, runs: DataFrame, support: DataFrame, crossings: DataFrame) -> DataFrame:
    """Quality metrics of each run.  ``frames``: run_id, frame, x_yd, on_lane, logo, hist, logo_ref; ``support``: run_id, start_support;
    ``crossings``: run_id, yd (painted lines in yards)."""
    r = runs.select("run_id", "k0", "final_time", F.col("clip_frames").alias("n"))
    every = frames.join(r, "run_id")
    before = F.lag("hist").over(Window.partitionBy("run_id").orderBy("frame"))
    every = every.withColumn("_cut", vectors.histogram_distance(F.col("hist"), before)).withColumn("_corr", vectors.correlation(F.col("logo"), F.col("logo_ref"))).withColumn("_turf", vectors.block_sum(F.col("hist"), 8, range(3, 9), range(2, 8)))
    live = every.where(in_window(F.col("frame"), F.col("k0"), F.col("final_time"), F.col("n")))
    out = live.groupBy("run_id").agg(
        F.min("_corr").alias("panel_min_corr"), F.max("_cut").alias("max_cut"), F.min("_turf").alias("turf_min"), F.median("_turf").alias("turf_median"),
        F.avg(F.coalesce(F.col("on_lane"), F.lit(False)).cast("double")).alias("lane_frac"), F.count("x_yd").alias("_seen"),
    )
    errors = (frames if "error" in frames.columns else frames.withColumn("error", F.lit(None).cast("string"))).groupBy("run_id").agg(F.min("error").alias("error"))
    stop = F.col("k0") + F.col("final_time") * FPS
    around = every.where(F.col("frame").between(F.greatest(F.lit(0), F.floor("k0") - 3), F.least(F.col("n"), F.ceil(stop) + 4) - 1)).select("run_id", "frame", "x_yd")
    at = r.select("run_id", F.explode(F.array("k0", stop)).alias("_at"))
    places = series.value_near(around, ["run_id"], "frame", "x_yd", at, out="_x").join(r, "run_id")
    places = places.groupBy("run_id").agg(F.max(F.when(F.col("_at") == F.col("k0"), F.col("_x"))).alias("x_at_zero"), F.max(F.when(F.col("_at") == stop, F.col("_x"))).alias("x_at_stop"))
    steps = relational.largest_step(around, ["run_id"], "frame", "x_yd", "max_step_yd")
    lines = crossings.where((F.col("yd") > 2) & (F.col("yd") < 38)).groupBy("run_id").agg(fits.multiple_residual(F.col("yd")).alias("yardline_resid"))
    out = runs.select("run_id", "k0", "final_time", "clip_frames", "clock_resid_p95", "n_clock", "bib_agree").join(out, "run_id", "left")
    for more in (places, steps, lines, support.select("run_id", "start_support"), errors):
        out = out.join(more, "run_id", "left")
    size = window_size(F.col("k0"), F.col("final_time"), F.col("clip_frames"))
    return out.select(
        "run_id", "clock_resid_p95", (F.col("n_clock") / F.greatest(F.lit(1.0), F.col("final_time") * FPS)).alias("clock_coverage"), "bib_agree", "panel_min_corr", "max_cut", "turf_min", "turf_median", "lane_frac",
        (F.col("_seen") / F.greatest(F.lit(1), size)).alias("track_frac"), "start_support", "x_at_stop", "x_at_zero", "max_step_yd", "yardline_resid", "error",
    )


def logo_references(frames: DataFrame, runs: DataFrame, sample: int = 6) -> DataFrame:
    """The median logo of each video, from its first runs."""
    first = identity.head_n(runs.select("video_id", "run_id"), ["video_id"], ["run_id"], sample)
    return learn.median_vector(frames.join(first, "run_id"), ["video_id"], "logo", "logo_ref")


def identify(runs: DataFrame, videos: DataFrame, quality: DataFrame) -> DataFrame:
    """Verdict, duplicates, attempts and status.  ``videos`` gives the order of the sources (column ``number``)."""
    passed, reasons = rulebook.verdict(rulebook.run_rules())
    judged = quality.withColumn("qc_pass", passed).withColumn("qc_reason", reasons)
    if "error" in quality.columns:  # a run whose scan failed is rejected, and says why
        failed = F.col("error").isNotNull()
        judged = judged.withColumn("qc_pass", F.col("qc_pass") & ~failed).withColumn("qc_reason", F.when(failed, F.concat(F.lit("error="), F.col("error"))).otherwise(F.col("qc_reason"))).drop("error")
    out = relational.replace_columns(runs, judged, ["run_id"]).join(learn.small(videos.select("video_id", F.col("number").alias("_v"))), "video_id", "left")
    out = identity.cross_source_duplicates(out, ["athlete", "final_time"], "video_id", ["_v", "t_origin"])
    out = identity.attempts(out, "athlete", ["_v", "t_origin"], ~F.col("duplicate") & ~F.col("off_group"))
    out = out.withColumn("status", identity.status(F.col("off_group"), F.col("duplicate"), F.col("qc_pass")))
    return out.withColumn("qc_reason", F.when(F.col("off_group"), F.concat(F.lit("panel position "), text_or(F.col("panel_pos"), "nan"))).otherwise(F.col("qc_reason")))


def with_split(runs: DataFrame, seed: int = 2026) -> DataFrame:
    """Train and test from athletes with a good run, mapped to all of their runs."""
    good = identity.representatives(runs.where("status = 'ok'"), "athlete", ["_v", "t_origin"], "cls", "position")
    return identity.map_split(runs, identity.stratified_split(good, "athlete", "cls", "position", seed), "athlete")


def long_channels(frames: DataFrame, channels: list[str]) -> DataFrame:
    """run_id, t_clock, channel, value: one shuffle by run and channel serves all channels of a resampler."""
    pairs = F.array(*(F.struct(F.lit(c).alias("channel"), F.col(c).cast("double").alias("value")) for c in channels))
    return frames.select("run_id", "t_clock", F.explode(pairs).alias("p")).select("run_id", "t_clock", "p.channel", "p.value")


def _wide(points: DataFrame, key: list[str], channels: list[str], places: int = 3) -> DataFrame:
    value = lambda c: F.max(F.when(F.col("channel") == c, F.col("value")))
    return points.groupBy(*key).agg(*((value(c) if c == "foot_contact" else F.bround(value(c), places)).alias(c) for c in channels))


def series_by_time(frames: DataFrame, runs: DataFrame, channels: list[str] | None = None, points: int = PHASES) -> DataFrame:
    """The clock's window at equal phases.  ``frames`` are of the whole clip; those a frame around the window are used."""
    channels = channels or NAMES
    r = runs.select("run_id", F.col("final_time").alias("_stop"), F.lit(0.0).alias("_start"))
    slack = 1 / 29.97 + 1e-6
    near = frames.join(r, "run_id").where(F.col("t_clock").between(-F.lit(slack), F.col("_stop") + slack))
    pairs = F.array(*(F.struct(F.lit(c).alias("channel"), F.col(c).cast("double").alias("value")) for c in channels))
    long = near.select("run_id", "t_clock", "_start", "_stop", F.explode(pairs).alias("p")).select("run_id", "t_clock", "_start", "_stop", "p.channel", "p.value")
    parts = [resample.by_phase(long.where(F.col("channel") == "foot_contact") if m == "nearest" else long.where(F.col("channel") != "foot_contact"), ["run_id", "channel"], "t_clock", "value", "_start", "_stop", points, m) for m in ("linear", "nearest")]
    both = parts[0].unionByName(parts[1])
    grid = r.select("run_id", "_stop", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("_i"))
    wide = _wide(both, ["run_id", "_i"], channels)
    out = grid.join(wide, ["run_id", "_i"], "left")
    return out.select("run_id", F.bround(F.col("_i") / (points - 1), 3).alias("phase"), F.bround(F.col("_stop") * F.col("_i") / (points - 1), 4).alias("t_clock"), *channels)


def series_by_distance(frames: DataFrame, channels: list[str] | None = None, step: float = STEP_YD, last: float = LAST_YD) -> DataFrame:
    """Equal distances, by the time at which the running maximum of x crosses them.  ``frames`` are of the clock's window."""
    channels = channels or [c for c in NAMES if c != "x_yd"]
    crossed = resample.time_at_distance(frames, ["run_id"], "t_clock", "x_yd", step, last)
    long = long_channels(frames, channels)
    asked = crossed.select("run_id", "distance", F.col("t_at")).withColumn("channel", F.explode(F.array(*map(F.lit, channels))))
    parts = []
    for method in ("linear", "nearest"):
        some = (F.col("channel") == "foot_contact") if method == "nearest" else (F.col("channel") != "foot_contact")
        parts.append(resample.at_times(long.where(some), ["run_id", "channel"], "t_clock", "value", asked.where(some), "t_at", method))
    wide = _wide(parts[0].unionByName(parts[1]), ["run_id", "t_at"], channels)
    out = crossed.select("run_id", "distance", "t_at").join(wide, ["run_id", "t_at"], "left")
    return out.select("run_id", F.round("distance", 2).alias("x_yd"), F.bround("t_at", 4).alias("t_clock"), *channels)


def publish_runs(runs: DataFrame, by_distance: DataFrame) -> DataFrame:
    """The runs table: renamed, with the time at 10 yards, in order, rounded."""
    cross = by_distance.where(F.col("x_yd") == 10.0).select("run_id", F.col("t_clock").alias("t_at_10yd"))
    out = runs.join(cross, "run_id", "left").withColumnsRenamed({"final_time": "time_40yd", "split10": "time_10yd"})
    out = out.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in SCHEMAS["runs"].fields))
    return round_floats(out, 4).orderBy("run_id")


def counts(runs: DataFrame) -> DataFrame:
    """Runs and athletes by class and split, with totals."""
    return relational.counts_rollup(runs.where("status = 'ok'"), "cls", "split", "athlete")
