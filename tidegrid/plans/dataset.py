"""The whole job from tables of what a camera saw to the published tables.

Tables in: videos (video_id, cls, number), runs_raw, panel_positions, and the frame bundles: frames (run_id, k, rows, logo, hist), bodies, lines and marks
as ``plans.measure`` takes them.  Each stage's table is written to the shared folder and read again: plans stay short, nothing is computed twice, and a lost
executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.operators import relational
from tidegrid.plans import analysis, build, measure
from tidegrid.plans.scratch import scratch_path
from tidegrid.sources import tables

INPUTS = ("videos", "runs_raw", "panel_positions", "frames", "bodies", "lines", "marks")


def build_dataset(spark: SparkSession, given: dict[str, DataFrame], seed: int = 2026) -> dict[str, DataFrame]:
    """runs, series, series_by_time, series_by_distance, and crossings (video_id, run_id, k, s)."""

    def stage(name: str, df: DataFrame) -> DataFrame:
        return tables.cached(spark, scratch_path(spark, f"{name}.parquet"), lambda: df)

    videos, bundles = given["videos"], given["frames"]
    runs = stage("registry", tables.present(build.registry(given["runs_raw"], videos, given["panel_positions"]), bundles, "run_id"))
    clock = runs.select("run_id", "k0")
    seen, crossings = measure.lane_frames(bundles, given["bodies"], given["lines"], given["marks"], clock, stage)
    seen, crossings = stage("lane", seen), stage("crossings", crossings.join(runs.select("run_id", "video_id"), "run_id"))
    moved = stage("kinematics", build.kinematics(stage("body", build.body(seen, stage))))
    frames = stage("channels", build.finish_channels(build.strides(moved)))
    looks = bundles.select("run_id", F.col("k").alias("frame"), "logo", "hist")
    looks = looks.join(runs.select("run_id", "video_id"), "run_id").join(build.logo_references(looks, runs), "video_id", "left").drop("video_id")
    lines = crossings.select("run_id", (F.col("s") * build.YARDS_PER_PERIOD).alias("yd"))
    support = seen.groupBy("run_id").agg(F.max("start_support").alias("start_support"))
    quality = stage("quality", build.metrics(frames.select("run_id", "frame", "x_yd", "on_lane", "error").join(looks, ["run_id", "frame"], "left"), runs, support, lines))
    done = stage("identity", build.with_split(build.identify(runs, videos, quality), seed))
    kept = done.where("status = 'ok'")
    size = kept.select("run_id", F.col("k0").alias("_k0"), F.col("final_time").alias("_t"), F.col("clip_frames").alias("_n"))
    whole = frames.join(size, "run_id")
    window = whole.where(build.in_window(F.col("frame"), F.col("_k0"), F.col("_t"), F.col("_n")))
    series = window.select("run_id", "frame", "t_clock", *build.NAMES, "valid")
    by_time = build.series_by_time(whole.drop("_k0", "_t", "_n"), kept)
    by_distance = stage("by_distance", build.series_by_distance(window))
    return {"runs": build.publish_runs(done, by_distance), "series": series, "series_by_time": by_time, "series_by_distance": by_distance, "crossings": crossings}


def calibration_report(runs: DataFrame, crossings: DataFrame) -> DataFrame:
    """The scale over all good runs' crossings and for each video."""
    good = runs.where("status = 'ok'").select("run_id")
    return analysis.calibrate(crossings.join(good, "run_id", "left_semi"))


def counts_report(runs: DataFrame) -> DataFrame:
    """Runs by status, and good runs and athletes by class and split."""
    by_status = runs.groupBy(F.col("status").alias("of")).agg(F.count("*").alias("runs"))
    split = relational.counts_rollup(runs.where("status = 'ok'"), "cls", "split", "athlete")
    return by_status.unionByName(split.select(F.concat_ws(" ", F.coalesce("cls", F.lit("all")), "split").alias("of"), *(F.col(c) for c in split.columns if c not in ("cls", "split"))), allowMissingColumns=True)
