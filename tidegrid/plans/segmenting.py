"""From clock readings to runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.operators import fits, identity, kernels, relational
from tidegrid.operators.series import FPS, clusters


def detect_runs(readings: DataFrame, low: float = 3.9, high: float = 6.5, tolerance: float = 30) -> DataFrame:
    """Runs in the readings (video_id, t, x, value): slot, x, t_origin, final, and the split that another slot shows.

    A slot whose scan failed has a row with ``error`` alone.

    One shuffle by video and slot serves the streaks; splits come from a join of each run with its video's readings by time."""
    seen = clusters(readings.where(F.col("value").isNotNull()), ["video_id"], "x", tolerance)
    found = kernels.find_streaks(seen.select("video_id", "slot", "t", "value"), ["video_id", "slot"], "t", "value")
    broken = kernels.failures(found, ["video_id", "slot"])
    runs = found.where(F.col("error").isNull() & F.col("final").between(low, high)).drop("error", "first", "last")
    runs = runs.withColumn("until", F.col("t_origin") + F.col("final") + 1.0)
    other = seen.where(F.col("value").between(1.2, 2.5)).select("video_id", F.col("slot").alias("other"), "t", "value", "x")
    inside = relational.within_windows(other, runs, ["video_id"], "t", "t_origin", "until", high + 1.0, F.col("other") != F.col("slot"))
    modes = inside.groupBy("video_id", "slot", "t_origin", "other").agg(F.count("*").alias("_n"), F.mode("value", True).alias("_v"), F.median("x").cast("int").alias("_x")).where("_n >= 3")
    splits = modes.groupBy("video_id", "slot", "t_origin").agg(F.min_by(F.struct("_v", "_x"), "other").alias("_s")).select("video_id", "slot", "t_origin", F.col("_s._v").alias("split10_coarse"), F.col("_s._x").alias("split_x"))
    counted = seen.join(runs.select("video_id", "slot", "t_origin", "t_last"), ["video_id", "slot"]).where((F.col("t") >= F.col("t_origin")) & (F.col("t") <= F.col("t_last")) & (F.col("value") > 0))
    places = counted.groupBy("video_id", "slot", "t_origin").agg(F.median("x").cast("int").alias("x"))
    keys = ["video_id", "slot", "t_origin"]
    return runs.drop("until").join(places, keys, "left").join(splits, keys, "left").unionByName(broken, allowMissingColumns=True)


def refine_runs(runs: DataFrame, frames: DataFrame, tolerance: float = 30) -> DataFrame:
    """The frame-accurate clock of each run, from its frames' readings (run_id, k, fields: array of (x, value), bib).

    ``runs`` has run_id, x, split_x and final."""
    first = lambda x0: F.get(F.filter("fields", lambda f: F.abs(f["x"] - F.col(x0)) < tolerance), F.lit(0))["value"]
    rows = frames.join(runs.select("run_id", "x", "split_x", "final"), "run_id")
    rows = rows.withColumn("value", first("x")).withColumn("split", F.when(F.col("split_x").isNotNull(), first("split_x")))
    clock = fits.clock_fit(rows, ["run_id"], "k", "value", FPS, "final")
    late = rows.join(clock.select("run_id", "k0"), "run_id")
    final = fits.vote(late.where(F.col("k") > F.col("k0") + F.col("final") * FPS), ["run_id"], "k", "value")
    split = fits.vote(late.where(F.col("k") > F.col("k0") + 2.5 * FPS), ["run_id"], "k", "split")
    bib = fits.vote(rows.where(F.col("bib").isNotNull() & (F.col("bib") != "")), ["run_id"], "k", "bib")
    sizes = rows.groupBy("run_id").agg(F.count("*").cast("int").alias("clip_frames"))
    out = sizes.join(clock, "run_id", "left").join(final.select("run_id", F.col("winner").alias("final_time")), "run_id", "left").join(split.select("run_id", F.col("winner").alias("split10")), "run_id", "left")
    out = out.join(bib.select("run_id", F.col("winner").alias("bib"), F.col("agreement").alias("bib_agree")), "run_id", "left")
    return out.select("run_id", "clip_frames", F.bround("k0", 3).alias("k0"), "final_time", "split10", F.bround("resid_p95", 4).alias("clock_resid_p95"), F.coalesce("monotone", F.lit(True)).alias("clock_monotone"), F.coalesce("n", F.lit(0)).cast("int").alias("n_clock"), F.col("bib").try_cast("int").alias("bib"), F.coalesce(F.bround("bib_agree", 3), F.lit(0.0)).alias("bib_agree"))


def number_runs(runs: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Ids in the order of time within a video; videos that are there anew replace their former runs."""
    out = identity.sequential_ids(runs, "video_id", ["t_origin"])
    return out if before is None else relational.upsert(before, out, ["video_id"])
