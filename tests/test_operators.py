import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import fits, identity, kernels, lanes, learn, panel, relational, rulebook
from tidegrid.operators.series import FPS


def test_rulebook(spark):
    good = dict(clock_resid_p95=0.025, clock_coverage=0.6, bib_agree=0.8, panel_min_corr=0.85, max_cut=0.35, turf_min=0.18, turf_median=0.4, lane_frac=0.9, track_frac=0.9, start_support=5.0, x_at_stop=38.5, x_at_zero=-2.2, max_step_yd=0.8)
    schema = ", ".join(f"{k} double" for k in good)
    passed, reasons = rulebook.verdict(rulebook.run_rules())

    def judge(**change):
        r = spark.createDataFrame([tuple({**good, **change}.values())], schema).select(passed.alias("p"), reasons.alias("r")).first()
        return r.p, r.r

    assert judge() == (True, "")
    assert judge(max_cut=0.51234, lane_frac=None) == (False, "max_cut=0.512;lane_frac=nan")
    assert judge(x_at_stop=38.0) == (False, "x_at_stop_err=2")
    assert judge(clock_resid_p95=0.0251)[0] is False and judge(x_at_zero=0.11) == (False, "x_at_zero=0.11") and judge(x_at_stop=None) == (False, "x_at_stop_err=nan")
    for rule in rulebook.run_rules():
        if rule.derived is None:
            assert judge(**{rule.name: None}) == (False, f"{rule.name}=nan")


def test_duplicates_and_attempts(spark):
    rows = [("a", 4.5, "v1", 1, True), ("a", 4.5, "v2", 2, True), ("a", 4.6, "v1", 3, True), ("a", 4.6, "v1", 4, True), (None, 4.5, "v1", 5, True), ("b", None, "v1", 6, True), ("c", 4.0, "v1", 7, False), ("c", 4.1, "v1", 8, True)]
    df = spark.createDataFrame(rows, "athlete string, final double, video string, t int, ok boolean")
    df = identity.cross_source_duplicates(df, ["athlete", "final"], "video", ["t"])
    assert {r.t: r.duplicate for r in df.collect()} == {1: False, 2: True, 3: False, 4: False, 5: True, 6: True, 7: False, 8: False}
    df = identity.attempts(df, "athlete", ["t"], ~F.col("duplicate") & F.col("ok"))
    assert {r.t: r.attempt for r in df.collect()} == {1: 1, 2: None, 3: 2, 4: 3, 5: None, 6: None, 7: None, 8: 1}


def test_status_priority(spark):
    rows = [(a, b, c) for a in (True, False) for b in (True, False) for c in (True, False)]
    got = spark.createDataFrame(rows, "a boolean, b boolean, c boolean").select("*", identity.status(F.col("a"), F.col("b"), F.col("c")).alias("s")).collect()
    assert all(r.s == ("excluded" if r.a else "duplicate" if r.b else "ok" if r.c else "rejected") for r in got)


def test_split_is_balanced_and_repeatable(spark):
    df = spark.createDataFrame([(f"x{k}", "ABC"[k % 3], f"p{k % 7}") for k in range(101)], "e string, cls string, pos string")
    a = {r.e: r.split for r in identity.stratified_split(df, "e", "cls", "pos").collect()}
    assert a == {r.e: r.split for r in identity.stratified_split(df.repartition(5), "e", "cls", "pos").collect()}
    assert a != {r.e: r.split for r in identity.stratified_split(df, "e", "cls", "pos", seed=1).collect()}
    for c in range(3):
        side = [a[f"x{k}"] for k in range(101) if k % 3 == c]
        assert side.count("train") - side.count("test") in (0, 1)


def test_clock_fit_and_vote(spark):
    rng = np.random.default_rng(0)
    rows = [("r", k, round((k - 30.4) / FPS, 2)) for k in range(31, 150)] + [("r", 160, 0.01)]
    got = fits.clock_fit(spark.createDataFrame(rows, "k string, f int, v double"), ["k"], "f", "v").first()
    assert got.k0 == pytest.approx(30.4, abs=0.1) and got.monotone is False and got.n == 120 and got.resid_p95 < 0.012
    bibs = spark.createDataFrame([("r", i, b) for i, b in enumerate(["7", "7", "1", None])] + [("s", 0, "2"), ("s", 1, "1")], "k string, i int, b string")
    assert {r.k: (r.winner, round(r.agreement, 3)) for r in fits.vote(bibs, ["k"], "i", "b").collect()} == {"r": ("7", 0.667), "s": ("2", 0.5)}
    assert rng is not None


def test_scale_is_recovered(spark):
    rng = np.random.default_rng(5)
    true = 1.8 / 0.9144
    s = [(v, float(y / true + rng.normal(0, 0.03))) for v in ("a", "b") for y in rng.choice(np.arange(5, 40, 5), 400)]
    got = fits.grid_fit(spark.createDataFrame(s, "v string, s double"), ["v"], "s").collect()
    assert len(got) == 2 and all(abs(r.scale - true) < 0.002 and r.share > 0.9 for r in got)


def test_projective_fit_and_consensus(spark):
    rows = [("r", float(s), (40.0 * s + 3) / (0.01 * s + 1)) for s in range(8)]
    got = fits.projective_fit(spark.createDataFrame(rows, "k string, s double, u double"), ["k"], "s", "u").first()
    assert (got.a, got.b, got.c) == (pytest.approx(40), pytest.approx(3), pytest.approx(0.01))
    marks = [("r", k, 2.0 + 0.01 * (k % 3), 5.0 + k) for k in range(6)] + [("r", k, 7.0, 1.0) for k in range(3)] + [("r", 0, 7.01, 1.0)] * 9
    best = fits.consensus(spark.createDataFrame(marks, "k string, f int, s double, v double"), ["k"], "f", "s", "v").first()
    assert best.support == 6 and best.median == 7.5


def test_tolerance_join_takes_the_first_field(spark):
    left = spark.createDataFrame([("a", 100), ("a", 500)], "k string, x int")
    right = spark.createDataFrame([("a", 0, 120, 1.0), ("a", 1, 101, 2.0), ("a", 2, 129, 3.0)], "k string, n int, y int, v double")
    got = {r.x: r.v for r in relational.first_within(left, right, ["k"], "x", "y", 30, ["n"], ["v"]).collect()}
    assert got == {100: 1.0, 500: None}


def test_windows_are_open(spark):
    events = spark.createDataFrame([("a", float(t)) for t in range(20)], "k string, t double")
    windows = spark.createDataFrame([("a", 1, 3.0, 7.0), ("a", 2, 6.0, 18.5)], "k string, w int, lo double, hi double")
    got = relational.within_windows(events, windows, ["k"], "t", "lo", "hi", 4.0).collect()
    assert sorted((r.w, r.t) for r in got) == [(1, float(t)) for t in range(4, 7)] + [(2, float(t)) for t in range(7, 19)]


def test_upsert_and_replace(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, relational.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, relational.replace_columns(old, new, ["k"]).collect())) == [(2, "c")]


def test_streaks():
    t = np.arange(0, 10, 0.25)
    v = np.where(t < 2, 0, np.minimum(np.round(t - 2, 2), 4.41))
    got = kernels.streaks(t, v)
    assert len(got) == 1 and got[0]["final"] == 4.41 and got[0]["t_origin"] == pytest.approx(2, abs=0.01)
    assert kernels.streaks(t, np.zeros_like(t)) == [] and kernels.streaks(t[:0], v[:0]) == []
    # a misread in the middle ends the stretch, which then doesn't freeze
    v2 = v.copy()
    v2[16] = 9.0
    assert all(s["final"] == 4.41 for s in kernels.streaks(t, v2)) and len(kernels.streaks(t, v2)) == 1


def test_touchdowns():
    n = 60
    contact, place = np.zeros(n), np.full(n, np.nan)
    for k, at in enumerate(range(12, 60, 6)):
        contact[at : at + 2] = 1
        place[at : at + 2] = 1.0 + 2 * k
    place[5:11] = 0.2
    contact[5:9] = 1
    assert kernels.touchdowns(contact, place, np.full(n, 5.0), 10.2) == list(range(12, 60, 6))
    assert kernels.touchdowns(contact, place, np.full(n, 30.0), 10.2) == [12, 24, 36, 48]


def test_unwrap_and_slips():
    frames = np.arange(60)
    true = 0.3 * frames + 0.002 * frames**2
    got = kernels.unwrap(frames, true % 1.0 + 3)
    assert np.allclose(got + true % 1.0 + 3 - (true % 1.0 + 3)[0], true - true[0] + 0 * got, atol=1e-9) or np.allclose(np.diff(got + true % 1.0), np.diff(true))
    far = np.array([0, 1, 2, 20, 21])
    assert np.isnan(kernels.unwrap(far, np.zeros(5))[3:]).all()
    offset = np.where(frames > 30, 1.0, 0.0)
    body = 0.1 * frames
    assert np.allclose(kernels.repair_slips(frames, offset, body, 5), 0)
    assert np.allclose(kernels.repair_slips(frames[:0], offset[:0], body[:0], 5), [])


def test_tracker_keeps_to_its_body():
    rng = np.random.default_rng(3)
    frames = {}
    for k in range(80):
        own = {"core": (100 + 4 * k + rng.normal(0, 1), 300, 105 + 4 * k, 240), "sure": True, "box": (70 + 4 * k, 200, 130 + 4 * k, 400), "off": False}
        other = {"core": (400, 305, 400, 245), "sure": True, "box": (370, 205, 430, 405), "off": False}
        frames[k] = [other, own] if k % 2 else [own, other]
    frames[40] = []
    got = kernels.track(frames, (10, 0), 79)
    assert set(got) == set(range(80)) - {40} and all(got[k] == k % 2 for k in got)


def test_row_index():
    s = np.arange(9)
    u = (40 * s + 5) / (0.004 * s + 1)
    points = np.column_stack((u * np.cos(0.1), u * np.sin(0.1)))
    low, high = u - u.mean() - 6, u - u.mean() + 6
    keep = np.array([0, 1, 2, 4, 5, 6, 8])
    got = kernels.index_row(points[keep], low[keep], high[keep])
    assert got["number"].tolist() == keep.tolist() and got["resid"] < 0.02
    assert kernels.index_row(points[:2], low[:2], high[:2]) is None
    noise = np.random.default_rng(0).uniform(0, 400, (5, 2)) + [0, 500]
    inside = kernels.line_inliers(np.vstack((points, noise)))
    assert inside[:9].all() and inside.sum() <= 11 and kernels.line_inliers(points[:1]) is None


def test_leaders():
    v = np.array([[1, 0], [0.99, 0.14], [0, 1], [0.1, 0.995], [0.7, 0.714]])
    own, heads = kernels.leaders(v, 0.93)
    assert own.tolist() == [0, 0, 1, 1, 2] and heads.tolist() == [0, 2, 4]


def test_a_broken_group_is_a_finding(spark):
    import pandas as pd

    def fn(rows):
        if rows.v.iloc[0] > 1:
            raise ValueError("broken")
        return pd.DataFrame({"y": [float("nan"), 1.0]})

    out = kernels.grouped(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), ["k"], ["v"], fn, "y double").collect()
    assert sorted((r.k, r.y, r.error is None) for r in out if r.y) == [("a", 1.0, True)] and [r.error for r in out if r.k == "b"] == ["ValueError('broken')"]
    assert sum(r.y is None for r in out) == 2


def test_template_match_and_nearest(spark):
    lib = spark.createDataFrame([(0, "a", [1.0, 0.0]), (1, "b", [0.0, 1.0]), (2, "c", [1.0, 0.0])], "n int, l string, v array<double>")
    df = spark.createDataFrame([(1, [0.9, 0.1]), (2, [0.1, 0.9])], "id int, x array<double>")
    assert {r.id: r.label for r in learn.template_match(df, "x", lib, "v", "l", "n").collect()} == {1: "a", 2: "b"}
    assert {r.id: r.predicted for r in learn.nearest(df, lib.withColumnRenamed("v", "x"), "id", "x", "n", "l").collect()} == {1: "a", 2: "b"}


def test_lane_classification_and_rows(spark):
    marks = [("f", float(t), 30.0) for t in (2, 3, 4, 178, 1)] + [("f", 80.0, 100.0), ("f", 85.0, 40.0), ("f", 20.0, 90.0)]
    got = lanes.classify_marks(spark.createDataFrame(marks, "k string, theta double, length double"), ["k"], "theta", "length").collect()
    assert {r.theta: r.kind for r in got} == {2.0: "along", 3.0: "along", 4.0: "along", 178.0: "along", 1.0: "along", 80.0: "across", 85.0: None, 20.0: None}
    rows = spark.createDataFrame([("f", (0.0, 300.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0)), ("f", (0.0, 420.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0))], f"k string, row {lanes.ROW}")
    assert [r["y"] for r in lanes.near_and_far(rows, ["k"], "row").first().rows] == [420.0, 300.0]


def test_lane_places_on_a_tilted_lane(spark):
    near = "named_struct('x', 10.0D, 'y', 520.0D, 'dx', 0.995D, 'dy', 0.0998749D, 'a', 40.0D, 'b', 2.0D, 'c', 0.002D, 'resid', 0.0D)"
    far = "named_struct('x', 0.0D, 'y', 400.0D, 'dx', 0.998D, 'dy', 0.0632139D, 'a', 38.0D, 'b', 1.0D, 'c', 0.003D, 'resid', 0.0D)"
    df = spark.range(30).select(F.expr(near).alias("n"), F.expr(far).alias("f"), F.col("id").cast("double").alias("s"))
    offset, theta = F.lit(2.0), F.lit(75.0)
    p = lanes.lane_point(F.col("n"), F.col("f"), F.col("s"), F.lit(0.3), offset, theta)
    s, w = lanes.across(F.col("n"), F.col("f"), p, offset, theta)
    b = lanes.place_below(F.col("n"), F.col("f"), p[0], F.lit(0.3), offset, theta, F.lit(-5.0), F.lit(40.0))
    for r in df.select("s", s.alias("a"), w.alias("w"), b.alias("b")).collect():
        assert r.a == pytest.approx(r.s, abs=1e-6) and r.w == pytest.approx(0.3) and r.b == pytest.approx(r.s, abs=1e-6)


def test_panel(spark):
    digits = [("f", x, 12, d, 0.95) for x, d in ((100, "4"), (120, "3"), (135, "8"), (300, "1"), (320, "x"), (335, "8"))]
    df = spark.createDataFrame(digits, "k string, x int, w int, label string, score double").withColumn("p", F.array(F.lit(115), F.lit(315)))
    got = panel.read_times(df, ["k"], "p").orderBy("x").collect()
    assert [(r.x, r.value) for r in got] == [(123, 4.38), (323, None)]
    bib = spark.createDataFrame([("f", 0, 10, "W", 0.9), ("f", 30, 8, "1", 0.9), ("f", 40, 8, "23", 0.9), ("g", 0, 10, "W", 0.9), ("g", 30, 8, "x", 0.9)], "k string, x int, w int, label string, score double")
    assert {r.k: r.bib for r in panel.read_bib(bib, ["k"]).collect()} == {"f": "123", "g": None}


def test_logistic(spark):
    rng = np.random.default_rng(0)
    rows = [(("A", "B", "C")[k % 3], *map(float, rng.normal([[0, 0], [3, 0], [0, 3]][k % 3], 0.5))) for k in range(150)]
    df = spark.createDataFrame(rows, "cls string, x double, y double")
    model = learn.logistic(df, ["x", "y"], "cls")
    assert model.transform(df).agg(F.avg((F.col("prediction") == F.col("_label")).cast("int"))).first()[0] > 0.95


def test_nearest_in_blocks_gives_the_same(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6))
    x[40:50] = x[10:20]  # equal training rows: the first by order counts
    rows = [(k, "ab"[k % 2], [float(v) for v in x[k]]) for k in range(60)]
    train = spark.createDataFrame(rows, "n int, l string, v array<double>")
    test = spark.createDataFrame([(k, [float(v) for v in x[k] + 0.01]) for k in range(30)], "id int, v array<double>")
    want = [(k, min((float(((x[k] + 0.01 - y) ** 2).sum()), n) for n, y in enumerate(x))) for k in range(30)]
    for limit, block in ((learn.BROADCAST_BYTES, 2048), (100, 7)):
        monkeypatch.setattr(learn, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(learn, "BLOCK_ROWS", block)
        got = {r.id: (r.predicted, r.distance) for r in learn.nearest(test, train, "id", "v", "n", "l").collect()}
        assert len(got) == 30 and all(got[k] == ("ab"[n % 2], pytest.approx(d)) for k, (d, n) in want)


def test_angles_and_distances_of_unknown_points_are_unknown(spark):
    from tidegrid.functions import geometry, vectors

    one, none = (F.lit(1.0), F.lit(2.0)), (F.lit(None).cast("double"), F.lit(None).cast("double"))
    r = spark.range(1).select(geometry.joint_angle(one, (F.lit(0.0), F.lit(0.0)), none).alias("a"), geometry.lean(none, one, one).alias("b"), vectors.histogram_distance(F.array(F.lit(1.0)), F.lit(None).cast("array<double>")).alias("c")).first()
    assert tuple(r) == (None, None, None)


def test_equal_rows_stay_as_many(spark):
    left = spark.createDataFrame([(1, 10.0), (1, 10.0), (2, 50.0)], "k int, x double")
    right = spark.createDataFrame([(1, 11.0, "a")], "k int, y double, name string")
    from tidegrid.operators import relational

    assert sorted(map(tuple, relational.first_within(left, right, ["k"], "x", "y", 3, ["name"], ["name"]).collect()), key=str) == [(1, 10.0, "a"), (1, 10.0, "a"), (2, 50.0, None)]


def test_a_failed_group_fails_the_job_or_goes_on(spark):
    import pandas as pd

    def fn(rows):
        if rows.v.iloc[0] > 1:
            raise ValueError("broken")
        return pd.DataFrame({"y": [1.0]})

    found = kernels.grouped(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), ["k"], ["v"], fn, "y double")
    assert [tuple(r) for r in kernels.failures(found, ["k"]).collect()] == [("b", "ValueError('broken')")]
    with pytest.raises(Exception, match="broken"):
        kernels.sound(found).collect()


def test_tracker_is_linear_in_frames(spark):
    import time

    many = 30_000
    rows = spark.range(many).select(F.lit(1).alias("run_id"), F.col("id").cast("int").alias("frame"), F.explode(F.sequence(F.lit(0), F.lit(1))).alias("number"))
    x = F.lit(100.0) + 400 * F.col("number") + F.col("frame") * 3.0
    rows = rows.select("*", x.alias("hx"), F.lit(300.0).alias("hy"), (x + 5).alias("sx"), F.lit(240.0).alias("sy"), F.lit(True).alias("sure"), (x - 30).alias("x0"), F.lit(200.0).alias("y0"), (x + 30).alias("x1"), F.lit(400.0).alias("y1"))
    rows = rows.select("*", F.lit(False).alias("off"), (F.col("number") * 4).alias("inside"), F.lit(10.0).alias("k0"), F.lit(many - 1).alias("last"))
    start = time.time()
    got = kernels.sound(kernels.track_bodies(rows, ["run_id"])).select("frame", "number").collect()
    assert sorted(map(tuple, got)) == [(k, 1) for k in range(many)]
    assert time.time() - start < 8
