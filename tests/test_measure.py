import numpy as np
import pytest

from pyspark.sql import functions as F

from tidegrid import __main__ as cli
from tidegrid.operators import lanes, pose
from tidegrid.plans import build, dataset, measure
from tidegrid.sources import tables


def test_a_known_run_on_a_panning_camera(spark, tmp_path):
    """A level lane, 40 px between marks; the camera pans 13 px a frame, so that row numbers jump; a rival stands by."""
    frames, bodies, lines, marks = [], [], [], []
    start, n, k0 = 5.0, 60, 20.0
    for k in range(n):
        pan = 13.0 * k  # world x = image x + pan
        true = start + (0.0 if k < k0 else 0.006 * (k - k0) ** 2)  # the runner's place in periods
        hip = true * 40 - pan + 300
        # Each frame numbers its marks from its own first one.
        shift = np.floor(pan / 40)
        row = lambda y: (0.0, y, 1.0, 0.0, 40.0, float(300 - pan + 40 * shift), 0.0, 0.01 if k != 33 else 0.5)  # noqa: B023, E731
        frames.append(("r", k, [row(500.0), row(400.0)]))
        person = lambda x, y: [(float(x + 3 * (j % 3 - 1)), float(y - 10 * (16 - j)), 0.9) for j in range(17)]
        own = person(hip, 470)
        for j in (9, 10):
            own[j] = (float(hip), 460.0, 0.9)
        for j in (11, 12, 5, 6):
            own[j] = (float(hip), 380.0 if j > 10 else 330.0, 0.9)
        for j in (15, 16):
            own[j] = (float(hip), 475.0, 0.9)
        other = person(hip + 400, 250)
        order = [own, other] if k % 2 else [other, own]
        for i, p in enumerate(order):
            xs, ys = [q[0] for q in p], [q[1] for q in p]
            bodies.append(("r", k, i, p, [min(xs) - 20, min(ys) - 20, max(xs) + 20, max(ys) + 5]))
        for yard in range(5):
            x = (start + 2.54 * yard) * 40 - pan + 300
            lines.append(("r", k, x, 390.0, x, 150.0))
        if k < 40:
            x = start * 40 - pan + 300
            marks.append(("r", k, float(x), 510.0, float(x), 390.0))
    point = "array<struct<x:double,y:double,conf:double>>"
    f = spark.createDataFrame(frames, f"run_id string, k int, rows array<{lanes.ROW}>")
    b = spark.createDataFrame(bodies, f"run_id string, k int, number int, kpts {point}, box array<double>")
    segment = "run_id string, k int, x0 double, y0 double, x1 double, y1 double"
    keep = lambda name, df: tables.cached(spark, f"{tmp_path}/{name}.parquet", lambda: df)
    places, crossings, _ = measure.measured(f, b, spark.createDataFrame(lines, segment), spark.createDataFrame(marks, segment), spark.createDataFrame([("r", k0)], "run_id string, k0 double"), stage=keep)
    got = {r.k: r for r in places.collect()}
    assert len(got) == n and not got[33].on_lane and got[33].s is None and got[0].start_support >= 30
    seen = [k for k in got if got[k].s is not None]
    assert len(seen) == n - 1
    for k in seen:
        assert got[k].s == pytest.approx(0.0 if k < k0 else 0.006 * (k - k0) ** 2, abs=1e-6) and got[k].w_run == pytest.approx(0.25)
    s = sorted({round(r.s, 4) for r in crossings.collect()})
    assert s == [0.0, 2.54, 5.08, 7.62, 10.16]

    # The channels of the same run: an upright body, whose ankles are straight below its hips.
    seen_frames, _ = measure.lane_frames(f, b, spark.createDataFrame(lines, segment), spark.createDataFrame(marks, segment), spark.createDataFrame([("r", k0)], "run_id string, k0 double"), keep)
    body = {r.frame: r for r in build.body(keep("seen", seen_frames), keep).collect()}
    assert len(body) == n and body[33].hip_height_ratio is None and body[33].ankle_l is None and body[33].error is None
    for k in (5, 12, 25, 45):
        true = start + (0.0 if k < k0 else 0.006 * (k - k0) ** 2)
        assert body[k].ankle_l == pytest.approx(true * build.YARDS_PER_PERIOD, abs=1e-6) and body[k].ankle_l == pytest.approx(body[k].ankle_r)
        assert body[k].trunk_angle == pytest.approx(0.0, abs=1e-6) and 0 < body[k].hip_height_ratio < 3
        assert all(body[k][c] is not None for c in pose.NAMES)

    # The whole dataset of this run, which stops far from the line.
    looks = f.withColumn("logo", F.array(*(F.lit(1 + j % 5) for j in range(32)))).withColumn("hist", F.array_repeat(F.lit(1 / 144), 144))
    raw = spark.createDataFrame([("r", "v", "WR", "WR", 100, 1.0, 0.0, n, k0, 1.2, 0.5, 0.01, 36, 4, 1.0)], "run_id string, video_id string, group string, positions string, slot int, t_origin double, clip_ss double, clip_frames int, k0 double, final_time double, split10 double, clock_resid_p95 double, n_clock int, bib int, bib_agree double")
    given = {
        "videos": spark.createDataFrame([("v", "skill", 0)], "video_id string, cls string, number int"), "runs_raw": raw, "panel_positions": spark.createDataFrame([("r", "WR")], "run_id string, panel_pos string"),
        "frames": looks, "bodies": b, "lines": spark.createDataFrame(lines, segment), "marks": spark.createDataFrame(marks, segment),
    }
    out = dataset.build_dataset(spark, given)
    run = out["runs"].collect()
    assert [(r.run_id, r.athlete, r.status, r.attempt) for r in run] == [("r", "WR-4", "rejected", 1)] and "x_at_stop_err=" in run[0].qc_reason
    assert run[0].start_support >= 30 and run[0].x_at_zero == pytest.approx(0.0, abs=0.05)
    assert out["series"].columns == ["run_id", "frame", "t_clock", *build.NAMES, "valid"] and out["series"].count() == 0 and out["crossings"].count() > 200
    assert dataset.counts_report(out["runs"]).where("of = 'rejected'").first().runs == 1


def test_command_line(spark, tmp_path):
    args = cli.parser().parse_args(["calibrate", "--tables", str(tmp_path), "--out", "x"])
    spark.createDataFrame([("r", "ok")], "run_id string, status string").write.parquet(f"{tmp_path}/runs.parquet")
    spark.createDataFrame([("v", "r", 2.54 * k) for k in range(1, 8)], "video_id string, run_id string, s double").write.parquet(f"{tmp_path}/crossings.parquet")
    got = cli.run(spark, args)["calibration"].collect()
    assert {r.video_id: round(r.scale, 3) for r in got} == {None: 1.969, "v": 1.969}
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["nothing"])
