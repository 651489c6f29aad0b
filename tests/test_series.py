import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import resample, series


def frame(spark, values, key="a"):
    return spark.createDataFrame([(key, i, None if v is None else float(v)) for i, v in enumerate(values)], "k string, i int, v double")


def column(df, name, order="i"):
    return [r[name] for r in df.orderBy(order).collect()]


@pytest.mark.parametrize(
    "values,gap,want",
    [
        ([None, 1, None, None, 4, None], 4, [None, 1, 2, 3, 4, None]),
        ([0, None, None, None, None, None, 6], 4, [0, None, None, None, None, None, 6]),
        ([None, 3, None], 4, [None, 3, None]),
        ([0, None, None, None, None, 5], 4, [0, 1, 2, 3, 4, 5]),
    ],
)
def test_bounded_fill(spark, values, gap, want):
    df = series.gap_fill(frame(spark, values), ["k"], "i", "v", gap)
    assert column(df, "filled") == want
    again = series.gap_fill(df.select("k", "i", F.col("filled").alias("v")), ["k"], "i", "v", gap)
    assert column(again, "filled") == want


def test_fill_holds_edges(spark):
    assert column(series.gap_fill(frame(spark, [None, 1, None, 3, None]), ["k"], "i", "v", None, "hold"), "filled") == [1, 1, 2, 3, 3]


def test_savgol_kernel():
    assert np.allclose(series.savgol_coefficients(7, 2)[3] * 21, [-2, 3, 6, 7, 6, 3, -2])


@pytest.mark.parametrize("width,degree,deriv", [(7, 2, 0), (9, 2, 0), (15, 3, 1), (21, 3, 2)])
def test_savgol_reproduces_polynomials(spark, width, degree, deriv):
    coefficients = [0.5, -2.0, 0.3, 0.01][: degree + 1]
    rate = 30.0
    t = np.arange(30) / rate
    poly = np.polynomial.Polynomial(coefficients)
    want = poly.deriv(deriv)(t) if deriv else poly(t)
    got = column(series.savgol(frame(spark, poly(t)), ["k"], "i", "v", width, degree, deriv, rate), "smooth")
    assert np.allclose(got, want, atol=1e-6)


def test_savgol_stretches(spark):
    values = [1, 5, 2, 8, 3, None] + [float(x * x) for x in range(8)]
    got = column(series.savgol(frame(spark, values), ["k"], "i", "v", 7, 2, 0), "smooth")
    assert got[:6] == [1, 5, 2, 8, 3, None] and np.allclose(got[6:], [x * x for x in range(8)])
    assert column(series.savgol(frame(spark, values), ["k"], "i", "v", 7, 2, 1), "smooth")[:6] == [None] * 6


def test_results_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(f"k{j}", i, None if rng.random() < 0.2 else float(rng.normal())) for j in range(5) for i in range(60)], "k string, i int, v double")
    run = lambda d: sorted(map(tuple, series.savgol(series.gap_fill(d, ["k"], "i", "v", 4), ["k"], "i", "filled", 7, 2).select("k", "i", "smooth").collect()), key=str)
    assert run(df) == run(df.orderBy(F.rand(3)).repartition(7))


def test_despike(spark):
    values = [x * 0.01 for x in range(20)]
    values[9] += 0.6
    got = column(series.despike(frame(spark, values), ["k"], "i", "v"), "clean")
    assert got[9] is None and sum(x is None for x in got) == 1
    assert column(series.despike(frame(spark, [0, 9, 0, 0, 0, 0, 0]), ["k"], "i", "v"), "clean") == [0, 9, 0, 0, 0, 0, 0]


def test_gradient(spark):
    assert column(series.gradient(frame(spark, [0, 1, 4, None, 2, 3]), ["k"], "i", "v", 1.0), "gradient") == [1, 2, None, -1, None, 1]


def test_clusters_do_not_split_a_jittering_slot(spark):
    df = spark.createDataFrame([("a", x) for x in (100, 104, 131, 170, 100, 104)], "k string, x int")
    got = {r.x: r.slot for r in series.clusters(df, ["k"], "x", 30).collect()}
    assert got == {100: 104, 104: 104, 131: 104, 170: 170}


def test_rising(spark):
    got = series.rising(frame(spark, [0, 1, 0.9, 2]), ["k"], "i", "v")
    assert column(got, "peak") == [0, 1, 2] and column(got, "i") == [0, 1, 3]


def grid(spark, t, v, at, method="linear"):
    df = spark.createDataFrame([("a", float(x), None if y is None else float(y)) for x, y in zip(t, v, strict=True)], "k string, t double, v double")
    asked = spark.createDataFrame([("a", float(x)) for x in at], "k string, at double")
    return column(resample.at_times(df, ["k"], "t", "v", asked, "at", method), "value", "at")


def test_resample_cases(spark):
    assert grid(spark, [0, 1, 2], [0, None, 4], [0.5, 1]) == [1, 2]
    assert grid(spark, [1, 2], [5, 6], [0.5, 1, 2, 2.5]) == [None, 5, 6, None]
    assert grid(spark, [1], [5], [1]) == [None]
    assert grid(spark, [0, 1], [0, 1], [0.5, -3, 9, 0.49], "nearest") == [0, 0, 1, 1]
    # in the order of places: -3 and 0.49 take the first sample, the tie and 9 the second


def test_phases_agree_with_interpolation(spark):
    rng = np.random.default_rng(2)
    rows = [(f"k{j}", float(t), float(v)) for j in range(4) for t, v in zip(np.sort(rng.random(25)) * 5, rng.normal(size=25), strict=True)]
    df = spark.createDataFrame(rows, "k string, t double, v double").withColumn("lo", F.lit(0.5)).withColumn("hi", F.lit(4.5))
    got = {(r.k, r._i): r.value for r in resample.by_phase(df, ["k"], "t", "v", "lo", "hi").collect()}
    assert len(got) == 404
    for j in range(4):
        t, v = (np.array([r[c] for r in rows if r[0] == f"k{j}"]) for c in (1, 2))
        want = np.interp(np.linspace(0.5, 4.5, 101), t, v, left=np.nan, right=np.nan)
        have = np.array([np.nan if got[f"k{j}", i] is None else got[f"k{j}", i] for i in range(101)])
        assert np.allclose(have, want, equal_nan=True)


def test_linear_signals_are_exact(spark):
    df = spark.createDataFrame([("a", float(t), 3.0 * t + 1) for t in (0, 0.3, 0.35, 2, 2.5, 4)], "k string, t double, v double").withColumn("lo", F.lit(0.0)).withColumn("hi", F.lit(4.0))
    got = resample.by_phase(df, ["k"], "t", "v", "lo", "hi").collect()
    assert all(r.value == pytest.approx(3 * r._at + 1) for r in got)


def test_distance_grid(spark):
    df = spark.createDataFrame([("a", float(t), float(10 * t)) for t in np.linspace(0, 4, 41)], "k string, t double, x double")
    got = resample.time_at_distance(df, ["k"], "t", "x").orderBy("distance").collect()
    assert len(got) == 157 and got[-1].distance == 39.0 and all(r.t_at == pytest.approx(r.distance / 10) for r in got)


def test_value_near(spark):
    df = spark.createDataFrame([("a", k, 2.0 * k) for k in range(10, 20)] + [("b", 1, 1.0)], "k string, i int, v double")
    at = spark.createDataFrame([("a", x) for x in (12.5, 8.0, 22.0, 4.0, 30.0)] + [("b", 1.0)], "k string, _at double")
    got = {(r.k, r._at): r.value for r in series.value_near(df, ["k"], "i", "v", at).collect()}
    assert got["a", 12.5] == pytest.approx(25) and got["a", 8.0] == pytest.approx(16) and got["a", 22.0] == pytest.approx(44)
    assert got["a", 4.0] is None and got["a", 30.0] is None and got["b", 1.0] is None


def test_hold_steps(spark):
    df = frame(spark, range(10))
    touches = spark.createDataFrame([("a", 2, 1.0), ("a", 5, 2.5), ("a", 7, 4.0)], "k string, i int, v double")
    got = series.hold_steps(df, touches, ["k"], "i", "v", 30.0)
    assert column(got, "step_freq_hz") == [None, None, 10, 10, 10, 15, 15, None, None, None] and column(got, "step_len_yd")[2:7] == [1.5] * 5
