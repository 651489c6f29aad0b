import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import sprint
from tidegrid.functions import nulls
from tidegrid.operators.series import FPS
from tidegrid.plans import analysis, build, segmenting
from tidegrid.sources import schemas, tables

POSITIONS = {"WR": "skill", "TE": "strong", "OT|G|C": "line"}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Runs of three classes, with a duplicate, an off-group run and a bad one, through the whole plan."""
    raw, panel, frames, lanes = [], [], [], tmp_path_factory.mktemp("stages")
    # Each stage's table is written and read again: plans stay short, and nothing is computed twice.
    keep = lambda name, df: tables.cached(spark, f"{lanes}/{name}.parquet", lambda: df)
    number = 0
    for v, (pos, cls) in enumerate(POSITIONS.items()):
        for bib in range(2, 5):
            for attempt in (0, 1):
                speed = 10.5 - v + 0.1 * bib + 0.02 * attempt
                rid = f"v{v}_{number:03d}"
                number += 1
                rows, n, total = sprint.run_frames(rid, speed, seed=number)
                frames += rows
                code = {"WR": "WR", "TE": "TE", "OT|G|C": "OL"}[pos]
                raw.append((rid, f"v{v}", pos, pos, 100, 10.0 * number, 20.0, n, 30.4, round(total, 2), 1.6, 0.01, int(total * FPS), bib, 1.0))
                panel.append((rid, "QB" if bib == 4 and attempt and v == 0 else code))
    bad = raw[1]
    raw[1] = (*bad[:11], 0.5, *bad[12:])
    twin = list(raw[2])
    twin[0], twin[1] = "v1_900", "v1"
    rows, *_ = sprint.run_frames("v1_900", 10.7, seed=900)
    frames += rows
    panel.append(("v1_900", "WR"))
    raw.append((twin[0], twin[1], "WR", "WR", *twin[4:]))
    videos = spark.createDataFrame([(f"v{v}", c, v) for v, c in enumerate(POSITIONS.values())], "video_id string, cls string, number int")
    runs_raw = spark.createDataFrame(raw, "run_id string, video_id string, group string, positions string, slot int, t_origin double, clip_ss double, clip_frames int, k0 double, final_time double, split10 double, clock_resid_p95 double, n_clock int, bib int, bib_agree double")
    runs = build.registry(runs_raw, videos, spark.createDataFrame(panel, "run_id string, panel_pos string"))
    f = spark.createDataFrame(frames, "run_id string, frame int, s double, ankle_l double, ankle_r double, trunk_angle double, hip_height_ratio double, on_lane boolean")
    runs = keep("registry", runs)
    f = f.join(runs.select("run_id", "k0"), "run_id")
    per_frame = keep("kinematics", build.kinematics(f))
    per_frame = keep("strides", build.strides(per_frame))
    per_frame = per_frame.select("*", *(F.lit(5.0).alias(c) for c in build.NAMES if c not in per_frame.columns))
    per_frame = keep("frames", build.finish_channels(per_frame))
    flat = F.array(*(F.lit(float(1 + i % 7)) for i in range(32)))
    hist = F.array(*(F.lit(1 / 144) for _ in range(144)))
    seen = per_frame.select("run_id", "frame", "x_yd", "on_lane", flat.alias("logo"), hist.alias("hist"), flat.alias("logo_ref"))
    support = runs.select("run_id", F.lit(6).alias("start_support"))
    lines = runs.select("run_id", F.explode(F.array(*(F.lit(5.0 * k + 0.1) for k in range(1, 8)))).alias("yd"))
    quality = keep("quality", build.metrics(seen, runs, support, lines).withColumn("turf_min", F.lit(0.5)).withColumn("turf_median", F.lit(0.5)))
    done = keep("done", build.with_split(build.identify(runs, videos, quality)))
    yield runs, per_frame, quality, done, lanes


def test_kinematics_follow_the_motion(built):
    _, frames, _, _, _ = built
    rows = frames.where("run_id = 'v0_000' AND x_yd IS NOT NULL AND v_yds IS NOT NULL").collect()
    t = np.array([r.t_clock for r in rows])
    inside = (t > 0.3) & (t < 4.0)
    speed = 10.7
    want = speed * (1 - np.exp(-t / sprint.TAU))
    assert np.abs(np.array([r.x_yd for r in rows]) - sprint.motion(t, speed))[inside].max() < 0.05
    assert np.abs(np.array([r.v_yds for r in rows]) - want)[inside].mean() < 0.15


def test_quality_metrics(built):
    _, _, quality, _, _ = built
    rows = quality.collect()
    assert len(rows) == 19
    assert max(abs(r.x_at_zero + 1) for r in rows) < 0.2 and max(abs(r.x_at_stop - 39.6) for r in rows if r.run_id != 'v1_900') < 0.2
    assert all(r.yardline_resid == pytest.approx(0.1) and r.max_cut == pytest.approx(0, abs=1e-6) and r.panel_min_corr == pytest.approx(1) for r in rows)
    assert min(r.track_frac for r in rows) > 0.9 and max(r.max_step_yd for r in rows) < 0.8


def test_identity(built):
    _, _, _, done, _ = built
    rows = {r.run_id: r for r in done.collect()}
    assert rows["v0_005"].status == "excluded" and rows["v0_005"].qc_reason == "panel position QB" and rows["v0_005"].attempt is None
    assert rows["v1_900"].status == "excluded" or rows["v1_900"].status == "duplicate"
    assert rows["v0_001"].status == "rejected" and rows["v0_001"].qc_reason == "clock_resid_p95=0.5" and rows["v0_001"].attempt == 2
    assert rows["v0_000"].status == "ok" and rows["v0_000"].cls == "SKILL" and rows["v2_012"].position == "OL"
    sides = {}
    for r in rows.values():
        if r.split:
            sides.setdefault(r.athlete, set()).add(r.split)
    assert sides and all(len(s) == 1 for s in sides.values()) and rows["v0_001"].split == rows["v0_000"].split


def test_grids_and_publishing(spark, built):
    runs, frames, _, done, folder = built
    keep = lambda name, df: tables.cached(spark, f"{folder}/{name}.parquet", lambda: df)
    good = done.where("status = 'ok'").select("run_id", "k0", "final_time", "clip_frames")
    by_time = keep("by_time", build.series_by_time(frames.join(good.select("run_id"), "run_id", "left_semi"), good))
    n = good.count()
    assert by_time.count() == 101 * n and by_time.columns == [f.name for f in schemas.SCHEMAS["series_by_time"].fields]
    window = frames.join(good.select("run_id", "final_time", "clip_frames"), "run_id").where(build.in_window(F.col("frame"), F.col("k0"), F.col("final_time"), F.col("clip_frames")))
    by_distance = keep("by_distance", build.series_by_distance(window))
    assert 150 * n <= by_distance.count() <= 157 * n
    one = by_distance.where("run_id = 'v0_000'").orderBy("x_yd").collect()
    want = [sprint.motion(np.array([r.t_clock]), 10.7)[0] for r in one]
    assert max(abs(r.x_yd - w) for r, w in zip(one, want, strict=True) if r.x_yd > 1) < 0.1
    assert {r.foot_contact for r in one} <= {0.0, 1.0, None}
    out = build.publish_runs(done, by_distance)
    assert out.columns == [f.name for f in schemas.SCHEMAS["runs"].fields] and out.count() == runs.count()
    assert out.where("status = 'ok' AND t_at_10yd IS NULL").count() == 0
    counts = {(r.cls, r.split): r.runs for r in build.counts(done).collect()}
    assert counts[None, None] == n
    profile = analysis.class_profiles(by_time, done, "phase", "v_yds").collect()
    assert all(r.q25 <= r.median <= r.q75 for r in profile if r.n)
    scores = analysis.baseline(by_time, done, "phase", [round(k / 100, 3) for k in range(101)], {"kinematics": ["v_yds", "a_yds2"]}).collect()
    assert [r.channels for r in scores] == ["kinematics"] and scores[0].accuracy > 0.8


def test_window_case(spark):
    n = spark.range(200).where(build.in_window(F.col("id"), F.lit(30.4), F.lit(4.0), F.lit(200))).agg(F.min("id"), F.max("id"), F.count("*")).first()
    assert tuple(n) == (30, 151, 122)
    assert spark.range(1).select(build.window_size(F.lit(30.4), F.lit(4.0), F.lit(200))).first()[0] == 122


def test_segmenting(spark):
    rows = []
    for video, finals in (("a", (4.41, 4.62)), ("b", (5.1,))):
        for j, final in enumerate(finals):
            start = 20 * j + 3.1
            for t in np.arange(20 * j, 20 * j + 18, 0.25):
                clock = 0.0 if t < start else float(min(round(t - start, 2), final))
                rows.append((video, float(t), 100 + int(t * 4) % 5, clock, "7"))
                split = 0.0 if t < start + 2 else 1.57
                rows.append((video, float(t), 400 + int(t * 4) % 3, split, "7"))
    readings = spark.createDataFrame(rows, schemas.SCHEMAS["readings"])
    runs = segmenting.number_runs(segmenting.detect_runs(readings)).orderBy("run_id").collect()
    assert [(r.run_id, r.final, r.split10_coarse) for r in runs] == [("a_000", 4.41, 1.57), ("a_001", 4.62, 1.57), ("b_000", 5.1, 1.57)]
    assert runs[0].t_origin == pytest.approx(3.1, abs=0.02) and abs(runs[0].x - 102) <= 2 and abs(runs[0].split_x - 401) <= 1
    k = np.arange(200)
    clock = np.where(k < 30.4, 0, np.minimum(np.round((k - 30.4) / FPS, 2), 4.41))
    fr = spark.createDataFrame([("a_000", int(i), [(102, float(c)), (401, 1.57 if i > 110 else 0.0)], "7" if i % 9 else "1") for i, c in zip(k, clock, strict=True)], "run_id string, k int, fields array<struct<x:int,value:double>>, bib string")
    got = segmenting.refine_runs(spark.createDataFrame(runs[:1]), fr).first()
    assert got.k0 == pytest.approx(30.4, abs=0.15) and got.final_time == 4.41 and got.split10 == 1.57 and got.bib == 7 and got.clip_frames == 200 and got.clock_monotone


def test_calibration(spark):
    rng = np.random.default_rng(1)
    rows = [(v, float(y / 1.9685 + rng.normal(0, 0.02))) for v in ("a", "b") for y in rng.choice(np.arange(5, 40, 5), 300)]
    got = {r.video_id: r for r in analysis.calibrate(spark.createDataFrame(rows, "video_id string, s double")).collect()}
    assert set(got) == {None, "a", "b"} and all(abs(r.scale - 1.9685) < 0.002 for r in got.values())


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("p1", "WR", 0.9), ("p2", None, float("nan"))], schemas.SCHEMAS["panel_positions"])
    for ending in ("csv", "parquet", "orc"):
        tables.write_table(df, f"{tmp_path}/t.{ending}", single=True)
        back = tables.read_table(spark, f"{tmp_path}/t.{ending}", "panel_positions", ["run_id", "panel_pos_score"])
        assert sorted(map(tuple, back.collect())) == [("p1", 0.9), ("p2", None)]
    calls = []
    for _ in range(2):
        assert tables.cached(spark, f"{tmp_path}/c.parquet", lambda: calls.append(1) or df).count() == 2
    assert calls == [1]
    sums = tables.checksums(spark, f"{tmp_path}/t.csv", "*.csv")
    assert sums.count() == 1 and len(sums.first().sha256) == 64
    assert tables.mismatches(sums, sums.withColumn("sha256", F.lit("0")), "path").count() == 1 and tables.mismatches(sums, sums, "path").count() == 0
    text = tables.package("p", "1", [tables.describe(df, "panel_positions", "t.csv", "codes", files=sums)])
    assert json.loads(text)["resources"][0]["schema"]["fields"][0] == {"name": "run_id", "type": "string", "description": "run"}
    with pytest.raises(ValueError, match="no description"):
        tables.describe(df.withColumn("zz", F.lit(1)), "panel_positions", "t.csv", "codes")
    assert tables.profile(df).where("column = 'panel_pos'").first().nulls == 1
    assert spark.createDataFrame([("30000/1001",), ("25",)], "f string").select(tables.rate("f").alias("r")).collect()[0].r == pytest.approx(FPS)


def test_schemas_are_described():
    for name, schema in schemas.SCHEMAS.items():
        assert all(f.metadata["description"] for f in schema.fields), name
    assert nulls.FLOATS
