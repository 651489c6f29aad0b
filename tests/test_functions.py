import math

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import geometry as G
from tidegrid.functions import nulls, vectors


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("value", [0.51234, 2.0, 0.025, 1234.5678, 12345678.0, 0.00001234, -3.14159, 100.0, 99.95, 0.0001, 1e-300, 1e300, 0.0])
def test_significant_digits(spark, value):
    want = f"{value:.3g}"
    if 1e-5 < abs(value) < 1e8 or value == 0:
        assert one(spark, nulls.significant(F.lit(value))) == want


def test_significant_of_missing(spark):
    assert one(spark, nulls.significant(F.lit(None).cast("double"))) == "nan" and one(spark, nulls.significant(F.lit(float("nan")))) == "nan"


def test_significant_digits_near_and_at_ties(spark):
    values = [106180.5 / 997.0, 106.5, 107.5, -106.5, 0.125, 1.125, 1.375, 2.675, 1.005, 0.00012345, 99950.0, 9.995, 9.9951, 1e-7, 1.235e22, 1.5e300, 1e-300, float("inf"), float("-inf")]
    values += [k / 100 / 997.0 for k in range(9_000_000, 10_800_000, 997)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", *(nulls.significant(F.col("v"), n).alias(f"d{n}") for n in (1, 3, 5))).collect()
    assert [(r.v, n, r[f"d{n}"]) for r in rows for n in (1, 3, 5) if r[f"d{n}"] != f"{r.v:.{n}g}"] == []


def test_significant_digits_of_prices_as_in_sql(spark, tmp_path):
    import duckdb

    from tidegrid import queries

    rows = [(1, 1, 106180.5), (1, 2, None), (1, 3, 0.0), (1, 4, float("nan")), (1, 5, float("inf")), (1, 6, -106180.5), (1, 7, 901.0), (1, 8, 1e-9)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_extendedprice double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries.QUERIES["flt10_significant_digits"](spark, str(tmp_path)).collect()
    want = duckdb.sql(f"WITH lineitem AS (SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet') " + queries.SQL["flt10_significant_digits"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and dict((r[1], r[2]) for r in got)[1] == "106"


def test_missing_values(spark):
    df = nulls.nan_to_null(spark.createDataFrame([(1, float("nan")), (2, 1.5)], "k int, v double"))
    assert [r.v for r in df.orderBy("k").collect()] == [None, 1.5]
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "a"), (None, None)], "a string, b string").select(nulls.differs(F.col("a"), F.col("b")).alias("d")).collect()
    assert [r.d for r in rows] == [False, True, True, True]
    assert one(spark, nulls.text_or(F.lit(None).cast("int"), "<NA>")) == "<NA>"
    assert [one(spark, nulls.lookup(F.lit(k), {"OT|G|C": "OL"}, F.lit(k))) for k in ("OT|G|C", "WR")] == ["OL", "WR"]
    assert one(spark, nulls.lookup(F.lit("x"), {"a": "b"})) is None


def test_half_even(spark):
    df = nulls.round_floats(spark.createDataFrame([(0.125, 0.375, 1)], "a double, b double, k int"), 2)
    assert tuple(df.first()) == (0.12, 0.38, 1)


def test_angles(spark):
    p = lambda x, y: (F.lit(float(x)), F.lit(float(y)))
    assert one(spark, G.joint_angle(p(1, 0), p(0, 0), p(0, 2))) == pytest.approx(90)
    assert one(spark, G.lean(p(1, -1), p(0, 0), p(1, 0))) == pytest.approx(45) and one(spark, G.lean(p(-1, -1), p(0, 0), p(1, 0))) == pytest.approx(-45)
    assert one(spark, G.lean(p(0, -1), p(0, 0), p(0, 0))) == 0
    assert one(spark, G.angular_distance(F.lit(179.0), F.lit(1.0))) == pytest.approx(2)
    x, y, _ = G.cross_line(p(0, 0), p(1, 1), p(4, 0), p(-1, 1))
    assert (one(spark, x), one(spark, y)) == (2.0, 2.0)
    assert one(spark, G.cross_line(p(0, 0), p(1, 1), p(4, 0), p(2, 2))[0]) is None
    assert one(spark, G.rung_angle(p(1, 0), p(0, -1))) == pytest.approx(90)


def test_projective_round_trip(spark):
    a, b, c = F.lit(40.0), F.lit(3.0), F.lit(0.01)
    assert one(spark, G.unproject(G.project(F.lit(7.25), a, b, c), a, b, c)) == pytest.approx(7.25)


def test_vectors(spark):
    v = lambda *x: F.array(*(F.lit(float(i)) for i in x))
    assert one(spark, vectors.correlation(v(1, 2, 3), v(2, 4, 6))) == pytest.approx(1) and one(spark, vectors.correlation(v(1, 1), v(2, 3))) == 0
    assert one(spark, vectors.histogram_distance(v(1, 1), v(2, 2))) == pytest.approx(0, abs=1e-7) and one(spark, vectors.histogram_distance(v(1, 0), v(0, 1))) == 1
    assert one(spark, vectors.norm(vectors.standard(v(1, 5, 9)))) == pytest.approx(1)
    assert one(spark, vectors.block_sum(v(*range(12)), 4, range(1, 3), range(2, 4))) == 6 + 7 + 10 + 11
    assert math.isclose(one(spark, vectors.squared_distance(v(1, 2), v(4, 6))), 25)
