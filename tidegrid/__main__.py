"""Jobs from the command line: ``python -m tidegrid <job> --tables FOLDER --out FOLDER``.

A table is ``<name>.parquet`` or ``<name>.csv`` in the folder.  Under ``spark-submit`` the session's own settings hold.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tidegrid", description=__doc__.splitlines()[0])
    jobs = out.add_subparsers(dest="job", required=True)
    about = {
        "segment": "find runs in clock readings and refine them by their frames", "build": "runs and their series from frame bundles", "calibrate": "yards in a period, over all videos and for each",
        "baseline": "nearest-neighbour accuracy for each group of channels", "datapackage": "describe the published tables", "panel": "label prototypes of glyphs", "positions": "position codes from mean patches",
    }
    for name, text in about.items():
        job = jobs.add_parser(name, help=text)
        job.add_argument("--tables", required=True, help="folder of the tables that are read")
        job.add_argument("--out", required=True, help="folder that is written to")
        if name == "segment":
            job.add_argument("--videos", help="only these, separated by commas")
        if name == "baseline":
            job.add_argument("--grid", choices=("time", "distance"), default="time")
        if name == "datapackage":
            job.add_argument("--version", default="1.0.0")
    return out


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame] | str:
    """The job's tables by name, or its text."""
    from tidegrid.operators import learn, panel
    from tidegrid.plans import analysis, build, dataset, segmenting
    from tidegrid.sources import tables

    def table(name: str) -> DataFrame:
        return tables.read_any(spark, args.tables, name)

    if args.job == "segment":
        readings = table("readings")
        if args.videos:
            readings = readings.where(F.col("video_id").isin(args.videos.split(",")))
        found = segmenting.number_runs(segmenting.detect_runs(readings).where("error IS NULL").drop("error"))
        return {"runs_coarse": found, "runs_raw": segmenting.refine_runs(found, table("clock_frames")).join(found.select("run_id", "video_id", "slot", "t_origin", "split10_coarse"), "run_id")}
    if args.job == "build":
        return dataset.build_dataset(spark, {name: table(name) for name in dataset.INPUTS})
    if args.job == "calibrate":
        return {"calibration": dataset.calibration_report(table("runs"), table("crossings"))}
    if args.job == "baseline":
        by, points = ("phase", [round(k / 100, 2) for k in range(build.PHASES)]) if args.grid == "time" else ("x_yd", [k * build.STEP_YD for k in range(int(build.LAST_YD / build.STEP_YD) + 1)])
        return {"baseline": analysis.baseline(table(f"series_by_{args.grid}"), table("runs"), by, points)}
    if args.job == "panel":
        return {"templates": panel.label_prototypes(table("prototypes"), table("labels"))}
    if args.job == "positions":
        means = learn.mean_vector(table("patches"), ["run_id"], "vector")
        return {"panel_positions": learn.template_match(means, "vector", table("templates"), "vector", "label", "number").select("run_id", F.col("label").alias("panel_pos"), F.col("score").alias("panel_pos_score"))}
    published = ("runs", "series", "series_by_time", "series_by_distance")
    return tables.package("dashes", args.version, [tables.describe(table(n), n, f"{n}.parquet", n.replace("_", " "), files=tables.checksums(spark, f"{args.tables}/{n}.parquet", "*.parquet")) for n in published])


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tidegrid {args.job}").getOrCreate()
    out = run(spark, args)
    if isinstance(out, str):
        spark.createDataFrame([(out.rstrip("\n"),)], "value string").coalesce(1).write.mode("overwrite").text(f"{args.out}/datapackage.json")
        return
    for name, df in out.items():
        df.write.mode("overwrite").parquet(f"{args.out}/{name}.parquet")


if __name__ == "__main__":
    main()
