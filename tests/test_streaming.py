from datetime import datetime, timedelta

import numpy as np

from tidegrid.operators import kernels
from tidegrid.streaming import detect


def source(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def drain(spark, df, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name)


def events(n=200):
    at = datetime(2024, 1, 1)
    out = []
    for i in range(n):
        at += timedelta(seconds=5 if i % 20 else 120)
        out.append((i % 3, at, float(i)))
    return out


SCHEMA = "k int, ts timestamp, v double"


def test_batch_equals_stream(spark, tmp_path):
    rows = events()
    stream = source(spark, str(tmp_path / "a"), [*rows, (9, datetime(2025, 1, 1), 0.0)], SCHEMA)
    batch = spark.createDataFrame(rows, SCHEMA)
    for name, op in (("tumbling", lambda d: detect.tumbling(d, "k", "ts", "v", "5 minutes")), ("sessions", lambda d: detect.sessions(d, "k", "ts", "60 seconds"))):
        got = sorted(map(tuple, drain(spark, op(stream), name).where("k <> 9").collect()))
        assert got == sorted(map(tuple, op(batch).collect()))


def test_repeats(spark, tmp_path):
    rows = events(50)
    stream = source(spark, str(tmp_path / "a"), rows + rows[:20], SCHEMA)
    assert drain(spark, detect.without_repeats(stream, ["k", "v"], "ts", "1 hour"), "repeats").count() == 50


def test_runs_in_a_stream(spark, tmp_path):
    t = np.arange(0, 12, 0.25)
    v = np.where(t < 2, 0, np.minimum(np.round(t - 2, 2), 4.41))
    start = datetime(2024, 1, 1)
    rows = [("a", 100, start + timedelta(seconds=float(x)), float(x), float(y)) for x, y in zip(t, v, strict=True)]
    schema = "video string, slot int, ts timestamp, t double, value double"
    path = str(tmp_path / "a")
    stream = source(spark, path, rows, schema)
    q = detect.detect(stream, ["video", "slot"], "ts", "t", "value").writeStream.outputMode("append").format("memory").queryName("runs").start()
    try:
        q.processAllAvailable()
        spark.createDataFrame([("z", 0, start + timedelta(hours=1), 0.0, 0.0)], schema).coalesce(1).write.mode("append").parquet(path)
        q.processAllAvailable()
        spark.createDataFrame([("z", 0, start + timedelta(hours=2), 0.0, 0.0)], schema).coalesce(1).write.mode("append").parquet(path)
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.table("runs").collect()
    want = kernels.streaks(t, v)[0]
    assert [(r.video, r.slot, r.final, r.t_origin) for r in got] == [("a", 100, want["final"], want["t_origin"])]
