import re

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import relational, resample, series


def exchanges(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"\bExchange ", plan[1]))


@pytest.fixture
def frame(spark):
    return spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").alias("i"), F.rand(1).alias("v"))


def test_a_chain_of_series_operators_shuffles_once(frame):
    out = series.gap_fill(frame, ["k"], "i", "v")
    out = series.despike(out, ["k"], "i", "filled", out="clean")
    out = series.savgol(out, ["k"], "i", "clean")
    out = series.gradient(out, ["k"], "i", "smooth")
    assert exchanges(out) == 1


def test_resampling_has_no_join(frame):
    df = frame.withColumn("lo", F.lit(0.0)).withColumn("hi", F.lit(900.0))
    plan = resample.by_phase(df, ["k"], "i", "v", "lo", "hi")
    assert exchanges(plan) == 1 and "Join" not in plan._jdf.queryExecution().executedPlan().toString()


def test_tolerance_and_window_joins_are_by_equality(frame):
    right = frame.select("k", F.col("i").alias("j"), F.col("v").alias("w"))
    near = relational.first_within(frame, right, ["k"], "i", "j", 3, ["j"], ["w"])
    inside = relational.within_windows(frame.select("k", F.col("i").alias("t")), frame.select("k", F.col("i").alias("a"), (F.col("i") + 5).alias("b")), ["k"], "t", "a", "b", 5)
    for df in (near, inside):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_scans_are_pruned(spark, tmp_path):
    spark.range(10).select("id", F.lit("x").alias("a"), F.rand().alias("b")).write.parquet(f"{tmp_path}/t.parquet")
    from tidegrid.sources import tables

    df = tables.read_table(spark, f"{tmp_path}/t.parquet", columns=["id"]).where("id > 3")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,3)" in text and "ReadSchema: struct<id:bigint>" in text
