"""Analysis of a built dataset: class profiles, the scale's calibration and baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators import fits, learn

# The channel groups of the baseline.
GROUPS = {
    "progress": ["t_clock", "x_yd"],
    "kinematics": ["v_yds", "a_yds2"],
    "posture": ["trunk_angle", "hip_height_ratio"],
    "joint angles": ["knee_lead", "knee_trail", "hip_flex_lead", "hip_flex_trail", "shin_angle_lead", "thigh_sep", "elbow_angle"],
    "stride": ["step_freq_hz", "step_len_yd"],
    "pose only": ["trunk_angle", "hip_height_ratio", "knee_lead", "knee_trail", "hip_flex_lead", "hip_flex_trail", "shin_angle_lead", "thigh_sep", "elbow_angle", "arm_swing"],
}


def calibrate(crossings: DataFrame, low: float = 1.0, high: float = 21.5) -> DataFrame:
    """Yards in a period, over all videos (video_id null) and for each."""
    use = crossings.where((F.col("s") > low) & (F.col("s") < high))
    size = use.groupBy("video_id").agg(F.count("*").alias("crossings"))
    each = fits.grid_fit(use.select("video_id", "s"), ["video_id"], "s").join(size, "video_id")
    every = fits.grid_fit(use.select(F.lit("all").alias("_k"), "s"), ["_k"], "s").join(use.agg(F.count("*").alias("crossings"), F.lit("all").alias("_k")), "_k")
    return every.select(F.lit(None).cast("string").alias("video_id"), "scale", "share", "crossings").unionByName(each.select("video_id", "scale", "share", "crossings"))


def class_profiles(series: DataFrame, runs: DataFrame, grid: str, channel: str) -> DataFrame:
    """Quartiles by class and grid point."""
    labelled = series.join(learn.small(runs.where("status = 'ok'").select("run_id", "cls")), "run_id")
    q = F.percentile(channel, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return labelled.groupBy("cls", grid).agg(q.alias("_q"), F.count(channel).alias("n")).select("cls", grid, F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q75"), "n")


def baseline(series: DataFrame, runs: DataFrame, grid: str, points: list[float], groups: dict[str, list[str]] | None = None) -> DataFrame:
    """Accuracy of the nearest neighbour, from train to test, for each group of channels."""
    good = runs.where("status = 'ok'").select("run_id", "cls", "split")
    out = None
    for name, channels in (groups or GROUPS).items():
        use = [c for c in channels if c != grid]
        cube = learn.tensor(series.join(good.select("run_id"), "run_id", "left_semi"), "run_id", grid, use, points).join(good, "run_id")
        cells = cube.where("split = 'train'").select(F.explode(F.arrays_zip(*use)).alias("c"))
        stats = cells.agg(*(F.avg(f"c.{c}").alias(f"m_{c}") for c in use), *((F.stddev_pop(f"c.{c}") + F.lit(1e-9)).alias(f"d_{c}") for c in use))
        vector = F.concat(*(_scaled(c) for c in use))
        # One row of statistics.  Ties go to the first training run: runs are numbered by their ids, in a table of a row for each run.
        rows = cube.crossJoin(F.broadcast(stats)).select("run_id", "cls", "split", vector.alias("v"))
        order = good.where("split = 'train'").select("run_id", F.row_number().over(Window.orderBy("run_id")).alias("o"))
        train = rows.where("split = 'train'").join(order, "run_id")
        found = learn.nearest(rows.where("split = 'test'"), train, "run_id", "v", "o", "cls").join(rows.select("run_id", "cls"), "run_id")
        one = found.agg(F.lit(name).alias("channels"), learn.accuracy(F.col("predicted"), F.col("cls")).alias("accuracy"))
        out = one if out is None else out.unionByName(one)
    return out


def _scaled(c: str):
    return F.transform(c, lambda v: (v - F.col(f"m_{c}")) / F.col(f"d_{c}"))


def run_vectors(series: DataFrame, grid: str, channels: list[str], points: list[float]) -> DataFrame:
    """One vector for each run, channel after channel, for the logistic regression."""
    from pyspark.ml.functions import array_to_vector

    cube = learn.tensor(series, "run_id", grid, channels, points)
    return cube.select("run_id", array_to_vector(F.concat(*channels)).alias("features"))
