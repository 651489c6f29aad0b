"""One query for each operator, on the driver's tables, with the SQL that gives the same rows.

Names begin with the operator's number in the inventory.  The series of the engine is played by ``events`` (a user is a
key, the time since 2024 in seconds the order, ``value`` the sample, null for errors in ``gappy``), identities by ``orders`` and
``customer``, vectors by ``embeddings``.  Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.functions import geometry as G
from tidegrid.functions import nulls, vectors
from tidegrid.operators import fits, identity, kernels, lanes, learn, panel, pose, relational, resample, rulebook, series
from tidegrid.sources import tables as source
from tidegrid.streaming import detect

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

EPOCH = 1_704_067_200_000_000
EVENTS = f"""e AS (SELECT event_id, user_id, event_type, value, CAST(epoch_us(ts) - {EPOCH} AS DOUBLE) / 1e6 AS t,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS gappy,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)"""


def query(sql: str | None = None, name: str | None = None):
    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*columns) if columns else df


def events(spark: SparkSession, sf: str) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, sf, "events", "event_id", "user_id", "event_type", "value", "ts")
    return e.select("event_id", "user_id", "event_type", "value", ((micros - EPOCH).cast("double") / 1e6).alias("t"), F.when(F.col("event_type") != "error", F.col("value")).alias("gappy"))


def numbered(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("t", "event_id")).cast("bigint"))


def r(c: Column | str, places: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, places)


KEY = ["user_id"]

# ---- sources and sinks


@query("SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01'")
def src4_pruned_scan(spark, sf):
    return table(spark, sf, "lineitem").where(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")).select("l_orderkey", "l_extendedprice")


@query("SELECT c_custkey, c_mktsegment, round(c_acctbal, 2) AS c_acctbal FROM customer")
def src1_snk1_csv_round_trip(spark, sf):
    from tidegrid.plans.scratch import scratch_path

    path = scratch_path(spark, "customer.csv")
    source.write_table(table(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_acctbal"), path)
    return spark.read.schema("c_custkey bigint, c_mktsegment string, c_acctbal double").option("header", True).csv(path).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src7_snk2_cached_parquet(spark, sf):
    from tidegrid.plans.scratch import scratch_path

    return source.cached(spark, scratch_path(spark, "orders.parquet"), lambda: table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice"))


@query("""SELECT c.* FROM (VALUES ('o_orderkey', 'integer'), ('o_custkey', 'integer'), ('o_orderstatus', 'string'), ('o_totalprice', 'number'), ('o_orderpriority', 'string')) AS c("column", type)
ORDER BY 1""", "prj13_logical_types")
def prj13_logical_types(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return source.profile(o).select("column", "type")


@query("""WITH p AS (SELECT count(*) AS n, count(o_orderkey) AS a, count(o_custkey) AS b, count(o_totalprice) AS c FROM orders)
SELECT 'o_orderkey' AS "column", n AS "rows", n - a AS nulls FROM p UNION ALL SELECT 'o_custkey', n, n - b FROM p UNION ALL SELECT 'o_totalprice', n, n - c FROM p""")
def agg26_table_profile(spark, sf):
    return source.profile(table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice")).select("column", "rows", "nulls")


@query("SELECT n_name, sha256(n_name) AS digest FROM nation")
def fn_hash(spark, sf):
    return table(spark, sf, "nation").select("n_name", F.sha2("n_name", 256).alias("digest"))


@query("SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def src10_json_fields(spark, sf):
    return table(spark, sf, "events").select("user_id", F.from_json("props", "k bigint")["k"].alias("k")).groupBy("user_id", "k").agg(F.count("*").alias("n"))


# ---- projections and filters

SEGMENTS = {"AUTOMOBILE": "SKILL", "BUILDING": "STRONG", "MACHINERY": "LINEMAN"}


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'SKILL' WHEN 'BUILDING' THEN 'STRONG' WHEN 'MACHINERY' THEN 'LINEMAN' END AS cls FROM customer")
def prj1_class_map(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", nulls.lookup(F.col("c_mktsegment"), SEGMENTS).alias("cls"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'SKILL' WHEN 'BUILDING' THEN 'STRONG' WHEN 'MACHINERY' THEN 'LINEMAN' ELSE c_mktsegment END AS cls FROM customer")
def prj2_identity_map(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", nulls.lookup(F.col("c_mktsegment"), SEGMENTS, F.col("c_mktsegment")).alias("cls"))


@query(f"WITH {EVENTS} SELECT event_id, coalesce(gappy <> value, true) AS off_group FROM e")
def prj3_null_aware_difference(spark, sf):
    return events(spark, sf).select("event_id", nulls.differs(F.col("gappy"), F.col("value")).alias("off_group"))


@query("SELECT o_orderkey, c_mktsegment || '-' || coalesce(CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS VARCHAR), '<NA>') AS athlete FROM orders JOIN customer ON o_custkey = c_custkey")
def prj4_composite_key(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus").join(table(spark, sf, "customer", "c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    bib = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return o.select("o_orderkey", F.concat("c_mktsegment", F.lit("-"), nulls.text_or(bib, "<NA>")).alias("athlete"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'excluded' WHEN o_totalprice > 200000 THEN 'duplicate' WHEN o_totalprice > 1000 THEN 'ok' ELSE 'rejected' END AS status,
CASE WHEN o_orderstatus = 'P' THEN 'panel position ' || coalesce(o_orderpriority, 'nan') ELSE '' END AS qc_reason FROM orders""")
def prj5_prj6_status(spark, sf):
    off = F.col("o_orderstatus") == "P"
    return table(spark, sf, "orders").select("o_orderkey", identity.status(off, F.col("o_totalprice") > 200000, F.col("o_totalprice") > 1000).alias("status"), F.when(off, F.concat(F.lit("panel position "), nulls.text_or(F.col("o_orderpriority"), "nan"))).otherwise("").alias("qc_reason"))


@query("SELECT l_orderkey, l_linenumber, round_even(sqrt(l_extendedprice), 3) AS a, round_even(sqrt(l_tax + 0.013), 3) AS b FROM lineitem")
def prj10_round_all(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.sqrt("l_extendedprice").alias("a"), F.sqrt(F.col("l_tax") + 0.013).alias("b"))
    return nulls.round_floats(df, 3)


@query(f"WITH {EVENTS} SELECT event_id, round((i - 3.25) / (30000.0::DOUBLE / 1001), 4) AS t_clock, round(value * (1.8::DOUBLE / 0.9144), 4) AS x_yd, CAST(gappy IS NOT NULL AND value IS NOT NULL AS INTEGER) AS valid FROM e")
def prj14_prj15_prj16_clock(spark, sf):
    e = numbered(spark, sf)
    return e.select("event_id", r((F.col("i") - 3.25) / series.FPS, 4).alias("t_clock"), r(F.col("value") * (1.8 / 0.9144), 4).alias("x_yd"), (F.col("gappy").isNotNull() & F.col("value").isNotNull()).cast("int").alias("valid"))


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_totalprice > 1000 AND o_totalprice < 150000 AND o_orderstatus = 'F'")
def flt1_flt2_flt4_filters(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT,5-LOW".split(",")) & (F.col("o_totalprice") > 1000) & (F.col("o_totalprice") < 150000) & (F.col("o_orderstatus") == "F")).select("o_orderkey")


@query(f"""WITH {EVENTS}, n AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM e)
SELECT event_id FROM n WHERE gappy IS NOT NULL AND i BETWEEN greatest(0, ceil(4.4) - 1) AND least(n, floor(4.4 + 1.0 * 30000.0::DOUBLE / 1001) + 2) - 1""")
def flt5_flt6_frame_window(spark, sf):
    from tidegrid.plans.build import in_window

    e = numbered(spark, sf).withColumn("n", F.count("*").over(Window.partitionBy("user_id")))
    return e.where(F.col("gappy").isNotNull() & in_window(F.col("i"), F.lit(4.4), F.lit(1.0), F.col("n"))).select("event_id")


@query(f"""WITH {EVENTS}, m AS (SELECT user_id, avg(CAST(event_type = 'error' AS INTEGER)) AS share, max(value) AS top, avg(gappy) AS mean FROM e GROUP BY user_id),
f AS (SELECT user_id, CASE WHEN share <= 0.2 THEN NULL ELSE 'share=' || printf('%.9f', share) END AS a, CASE WHEN top >= 99 THEN NULL ELSE 'top=' || printf('%.9f', top) END AS b, CASE WHEN mean BETWEEN 20 AND 21 THEN NULL ELSE 'mean=' || printf('%.9f', mean) END AS c FROM m)
SELECT user_id, a IS NULL AND b IS NULL AND c IS NULL AS passed, concat_ws(';', a, b, c) AS reasons FROM f""")
def flt9_verdict(spark, sf):
    m = events(spark, sf).groupBy("user_id").agg(F.avg((F.col("event_type") == "error").cast("int")).alias("share"), F.max("value").alias("top"), F.avg("gappy").alias("mean"))
    passed, _ = rulebook.verdict(rules := [rulebook.Rule("share", high=0.2), rulebook.Rule("top", low=99), rulebook.Rule("mean", low=20, high=21)])
    fixed = F.concat_ws(";", *(F.when(x.failed().isNotNull(), F.concat(F.lit(f"{x.name}="), F.format_string("%.9f", F.col(x.name)))) for x in rules))
    return m.select("user_id", passed.alias("passed"), fixed.alias("reasons"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice = 0 THEN '0' ELSE printf('%.3g', l_extendedprice / 997.0::DOUBLE) END AS text FROM lineitem""")
def flt10_significant_digits(spark, sf):
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(price.isNotNull(), nulls.significant(price / 997.0)).alias("text"))


@query(f"""WITH {EVENTS} SELECT event_id, round(least(abs(value * 3.6 - 40) % 180, 180 - abs(value * 3.6 - 40) % 180), 6) AS d FROM e""")
def flt12_angular_distance(spark, sf):
    return events(spark, sf).select("event_id", r(G.angular_distance(F.col("value") * 3.6, F.lit(40.0))).alias("d"))


@query("SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS p, unnest(list_transform(embedding, lambda x: CASE WHEN abs(x) < 0.1 THEN NULL ELSE round(x::DOUBLE, 6) END)) AS v FROM embeddings")
def flt8_confidence_mask(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(F.transform("embedding", lambda x: F.when(F.abs(x) >= F.lit(0.1).cast("float"), F.round(x.cast("double"), 6)))).alias("p", "v"))


# ---- joins


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def jon1_inner(spark, sf):
    return table(spark, sf, "nation").join(learn.small(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 150000 GROUP BY c_custkey")
def jon2_left_outer(spark, sf):
    o = table(spark, sf, "orders").where("o_totalprice > 150000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return table(spark, sf, "customer", "c_custkey").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("""WITH q AS (SELECT o_custkey, max(o_totalprice) AS c_acctbal FROM orders GROUP BY 1)
SELECT c.c_custkey, c.c_mktsegment, q.c_acctbal FROM customer c JOIN q ON c.c_custkey = q.o_custkey""")
def jon3_prj9_replace_columns(spark, sf):
    q = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return relational.replace_columns(table(spark, sf, "customer"), q, ["c_custkey"]).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("SELECT s_suppkey, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def jon4_left_lookup(spark, sf):
    return table(spark, sf, "supplier").join(learn.small(table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "n_name")


@query("SELECT l_returnflag, n_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL")
def jon5_fact_label(spark, sf):
    s = table(spark, sf, "supplier").join(learn.small(table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return table(spark, sf, "lineitem", "l_suppkey", "l_returnflag").join(learn.small(s), F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_returnflag", "n_name").agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def jon6_set4_semi(spark, sf):
    return table(spark, sf, "customer", "c_custkey").join(table(spark, sf, "orders").where("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query("""WITH new AS (SELECT o_orderkey, -o_totalprice AS o_totalprice FROM orders WHERE o_orderkey % 3 = 0)
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) UNION ALL SELECT * FROM new""")
def jon7_set2_upsert(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey", "o_totalprice")
    return relational.upsert(o, o.where("o_orderkey % 3 = 0").withColumn("o_totalprice", -F.col("o_totalprice")), ["o_orderkey"])


SEGMENT_SQL = """s AS (SELECT user_id, t AS t0, {v} AS v0, lead(t) OVER w AS t1, lead({v}) OVER w AS v1, min(t) OVER (PARTITION BY user_id) AS lo, max(t) OVER (PARTITION BY user_id) AS hi,
  max({v}) FILTER (WHERE {v} IS NOT NULL) OVER (PARTITION BY user_id) AS m FROM e WHERE {v} IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY t))"""


@query(f"""WITH {EVENTS}, {SEGMENT_SQL.format(v="value")},
b AS (SELECT user_id, min(t) AS lo, max(t) AS hi FROM e GROUP BY 1),
g AS (SELECT user_id, i AS phase, lo + (hi - lo) / 100 * i AS x FROM b, range(101) AS r(i)),
p AS (SELECT g.user_id, phase, CASE WHEN x = t0 THEN v0 WHEN t1 IS NOT NULL THEN v0 + (v1 - v0) / (t1 - t0) * (x - t0) END AS value
  FROM g JOIN s ON g.user_id = s.user_id AND x >= t0 AND (x < t1 OR t1 IS NULL))
SELECT user_id, CAST(phase AS BIGINT) AS phase, round(value, 4) AS value FROM p""")
def jon8_rsh4_resample_by_phase(spark, sf):
    e = events(spark, sf)
    w = Window.partitionBy("user_id")
    e = e.withColumn("lo", F.min("t").over(w)).withColumn("hi", F.max("t").over(w))
    return resample.by_phase(e, KEY, "t", "value", "lo", "hi").select("user_id", F.col("_i").alias("phase"), r("value", 4).alias("value"))


@query(f"""WITH {EVENTS}, {SEGMENT_SQL.format(v="gappy")},
b AS (SELECT user_id, min(t) AS lo, max(t) AS hi FROM e GROUP BY 1),
g AS (SELECT user_id, i AS phase, lo + (hi - lo) / 100 * i AS x FROM b, range(101) AS r(i)),
z AS (SELECT user_id, t0, v0, t1, v1, t0 = min(t0) OVER (PARTITION BY user_id) AS first FROM s)
SELECT g.user_id, CAST(phase AS BIGINT) AS phase, CASE WHEN x < t0 OR t1 IS NULL OR x - t0 < t1 - x THEN v0 ELSE v1 END AS value
FROM g JOIN z ON g.user_id = z.user_id AND (x >= t0 OR first) AND (x < t1 OR t1 IS NULL)""")
def jon9_resample_nearest(spark, sf):
    e = events(spark, sf)
    w = Window.partitionBy("user_id")
    e = e.withColumn("lo", F.min("t").over(w)).withColumn("hi", F.max("t").over(w))
    return resample.by_phase(e, KEY, "t", "gappy", "lo", "hi", method="nearest").select("user_id", F.col("_i").alias("phase"), "value")


@query(f"""WITH {EVENTS}, p AS (SELECT user_id, t, i, sum(value) OVER (PARTITION BY user_id ORDER BY i) AS x FROM e),
m AS (SELECT user_id, t, i, max(x) OVER (PARTITION BY user_id ORDER BY i) AS x FROM p),
k AS (SELECT *, x - lag(x) OVER (PARTITION BY user_id ORDER BY i) AS step FROM m),
s AS (SELECT user_id, x AS x0, t AS v0, lead(x) OVER w AS x1, lead(t) OVER w AS v1 FROM k WHERE step IS NULL OR step > 1e-6 WINDOW w AS (PARTITION BY user_id ORDER BY x)),
g AS (SELECT i * 25.0::DOUBLE AS x FROM range(41) AS r(i))
SELECT user_id, x AS distance, round(CASE WHEN x = x0 THEN v0 ELSE v0 + (v1 - v0) / (x1 - x0) * (x - x0) END, 3) AS t_at FROM g JOIN s ON x >= x0 AND (x < x1 OR (x1 IS NULL AND x = x0))""")
def win8_win9_resample_by_distance(spark, sf):
    e = numbered(spark, sf).withColumn("x", F.sum("value").over(Window.partitionBy("user_id").orderBy("i")))
    return resample.time_at_distance(e, KEY, "t", "x", 25.0, 1000.0).select("user_id", "distance", r("t_at", 3).alias("t_at"))


@query(f"""WITH {EVENTS}, a AS (SELECT o_orderkey AS q, o_custkey % 150 AS user_id, (o_orderkey % 2500) * 1000.0::DOUBLE + 500 AS x FROM orders),
s AS (SELECT user_id, t AS t0, value AS v0, lead(t) OVER w AS t1, lead(value) OVER w AS v1 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t))
SELECT a.user_id, a.x, round(CASE WHEN x = t0 THEN v0 ELSE v0 + (v1 - v0) / (t1 - t0) * (x - t0) END, 4) AS value
FROM a LEFT JOIN s ON a.user_id = s.user_id AND x >= t0 AND x < t1 WHERE a.user_id IN (SELECT user_id FROM e)""")
def jon8_interpolate_at(spark, sf):
    e = events(spark, sf)
    a = table(spark, sf, "orders").select((F.col("o_custkey") % 150).alias("user_id"), ((F.col("o_orderkey") % 2500) * 1000.0 + 500).alias("x")).join(e.select("user_id").distinct(), "user_id", "left_semi")
    return resample.at_times(e, KEY, "t", "value", a, "x").select("user_id", "x", r("value", 4).alias("value"))


@query(f"""WITH {EVENTS} SELECT a.event_id AS event_id, b.event_id AS other FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_type <> b.event_type AND b.t > a.t AND b.t < a.t + 3600 WHERE a.event_type = 'purchase'""")
def jon10_window_lookup(spark, sf):
    e = events(spark, sf)
    w = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("_w"), F.col("event_type").alias("_type"), F.col("t").alias("start"), (F.col("t") + 3600).alias("stop"))
    return relational.within_windows(e, w, KEY, "t", "start", "stop", 3600, F.col("event_type") != F.col("_type")).select(F.col("_w").alias("event_id"), F.col("event_id").alias("other"))


@query("""WITH l AS (SELECT DISTINCT p_brand, p_size, p_partkey FROM part), c AS (SELECT l.p_partkey, b.p_partkey AS found, row_number() OVER (PARTITION BY l.p_partkey ORDER BY b.p_partkey) AS rn
 FROM part l JOIN part b ON l.p_brand = b.p_brand AND abs(l.p_size - b.p_size) < 3 AND b.p_type = 'ECONOMY')
SELECT l.p_partkey, c.found FROM part l LEFT JOIN c ON l.p_partkey = c.p_partkey AND rn = 1""")
def jon11_tolerance_join(spark, sf):
    p = table(spark, sf, "part", "p_partkey", "p_brand", "p_size", "p_type")
    right = p.where("p_type = 'ECONOMY'").select("p_brand", F.col("p_size").alias("size"), F.col("p_partkey").alias("found"))
    return relational.first_within(p.select("p_partkey", "p_brand", "p_size"), right, ["p_brand"], "p_size", "size", 3, ["found"], ["found"]).select("p_partkey", "found")


DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"


@query(f"""WITH t AS (SELECT vec_id AS n, label AS l, embedding AS v FROM embeddings WHERE vec_id < 10),
s AS (SELECT vec_id, n, l, round({DOT.format(a="embedding", b="v")}, 6) AS score FROM embeddings, t)
SELECT vec_id, CAST(arg_max(l, (score, -n)) AS INTEGER) AS label, max(score) AS score FROM s GROUP BY vec_id""")
def jon12_template_match(spark, sf):
    e = table(spark, sf, "embeddings")
    t = e.where("vec_id < 10").select(F.col("vec_id").alias("n"), F.col("label").alias("l"), F.col("embedding").alias("v"))
    return learn.template_match(e.drop("label"), "embedding", t, "v", "l", "n").select("vec_id", "label", r("score").alias("score"))


NN = """d AS (SELECT a.vec_id, a.label AS truth, b.label AS l, b.vec_id AS o, list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE))) AS d
  FROM embeddings a, embeddings b WHERE a.vec_id % 2 = 1 AND b.vec_id % 2 = 0), p AS (SELECT vec_id, any_value(truth) AS truth, arg_min(l, (d, o)) AS predicted, min(d) AS distance FROM d GROUP BY vec_id)"""


def _nearest(spark, sf):
    e = table(spark, sf, "embeddings")
    return learn.nearest(e.where("vec_id % 2 = 1"), e.where("vec_id % 2 = 0"), "vec_id", "embedding", "vec_id", "label")


@query(f"WITH {NN} SELECT vec_id, CAST(predicted AS INTEGER) AS predicted, round(distance, 5) AS distance FROM p")
def jon13_srt4_nearest_neighbour(spark, sf):
    return _nearest(spark, sf).withColumn("distance", r("distance", 5))


@query(f"WITH {NN} SELECT round(avg(CAST(predicted = truth AS DOUBLE)), 6) AS accuracy FROM p")
def ml1_agg23_accuracy(spark, sf):
    return _nearest(spark, sf).join(table(spark, sf, "embeddings", "vec_id", "label"), "vec_id").agg(r(learn.accuracy(F.col("predicted"), F.col("label"))).alias("accuracy"))


@query(f"WITH {EVENTS} SELECT user_id, arg_min(event_id, (abs(t - 1000000), t)) AS event_id FROM e GROUP BY user_id")
def jon15_nearest_row(spark, sf):
    return relational.nearest_row(events(spark, sf), KEY, "t", F.lit(1_000_000.0), ["event_id"])


@query()
def jon17_line_crossing(spark, sf):
    e = numbered(spark, sf).withColumn("b", F.coalesce(F.lag("value").over(Window.partitionBy("user_id").orderBy("i")), F.lit(1.0)))
    x, _, _ = G.cross_line((F.lit(0.0), F.lit(2.0)), (F.lit(5.0), F.lit(1.0)), (F.lit(10.0), F.lit(7.0)), (F.col("b"), F.col("value") + 1))
    return e.select("event_id", r(x, 4).alias("x"))


SQL["jon17_line_crossing"] = f"""WITH {EVENTS}, w AS (SELECT event_id, coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY i), 1.0) AS ex, value + 1 AS ey FROM e),
d AS (SELECT *, 1.0 * ex - 5.0 * ey AS det FROM w) SELECT event_id, round(CASE WHEN abs(det) >= 1e-9 THEN 5.0 * (5.0 * ex - 10.0 * ey) / det END, 4) AS x FROM d"""

# ---- aggregations


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def agg1_value_counts(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS runs, count(DISTINCT o_custkey) AS athletes FROM orders GROUP BY 1, 2")
def agg2_agg3_counts(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("runs"), F.count_distinct("o_custkey").alias("athletes"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS runs, count(DISTINCT o_custkey) AS athletes FROM orders GROUP BY ROLLUP (1, 2)".replace("(1, 2)", "(o_orderstatus, o_orderpriority)"))
def agg3_rollup(spark, sf):
    return relational.counts_rollup(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", "o_custkey")


@query("SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order FROM orders GROUP BY 1")
def agg4_first_per_group(spark, sf):
    return identity.representatives(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey").withColumnRenamed("o_orderkey", "first_order")


@query("SELECT l_returnflag, round(median(l_extendedprice), 4) AS median FROM lineitem GROUP BY 1")
def agg5_median(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(r(F.median("l_extendedprice"), 4).alias("median"))


@query("""WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2), s AS (SELECT o_custkey, sum(n) AS m, arg_max(o_orderpriority, (n, -ascii(o_orderpriority))) AS v FROM c GROUP BY 1)
SELECT o_custkey, CASE WHEN m >= 3 THEN v END AS mode FROM s""")
def agg6_supported_mode(spark, sf):
    return fits.mode_of(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority")


@query(f"""WITH {EVENTS}, c AS (SELECT user_id, event_type, count(*) AS n, min(t) AS f FROM e GROUP BY 1, 2)
SELECT user_id, arg_max(event_type, (n, -f)) AS winner, round(max(n) / sum(n)::DOUBLE, 6) AS agreement FROM c GROUP BY 1""")
def agg7_majority_vote(spark, sf):
    return fits.vote(events(spark, sf), KEY, "t", "event_type").withColumn("agreement", r("agreement"))


@query("""SELECT l_returnflag, l_linenumber, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75 FROM lineitem GROUP BY 1, 2""")
def agg9_rsh2_quartiles(spark, sf):
    q = F.percentile("l_extendedprice", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linenumber").agg(q.alias("q")).select("l_returnflag", "l_linenumber", *(r(F.col("q")[i], 4).alias(n) for i, n in enumerate(("q25", "q50", "q75"))))


@query(f"""WITH {EVENTS} SELECT user_id, min(value) AS lo, max(value) AS hi, round(median(value), 4) AS mid, round(avg(CAST(event_type = 'error' AS DOUBLE)), 6) AS share, round(count(gappy) / greatest(1, count(*))::DOUBLE, 6) AS coverage FROM e GROUP BY 1""")
def agg10_agg11_metrics(spark, sf):
    return events(spark, sf).groupBy("user_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), r(F.median("value"), 4).alias("mid"), r(F.avg((F.col("event_type") == "error").cast("double"))).alias("share"), r(F.count("gappy") / F.greatest(F.lit(1), F.count("*"))).alias("coverage"))


@query(f"""WITH {EVENTS}, s AS (SELECT user_id, abs((gappy - lag(gappy) OVER w) / (i - lag(i) OVER w)) AS d FROM e WHERE gappy IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY i)) SELECT user_id, round(max(d), 6) AS max_step FROM s GROUP BY 1""")
def agg12_largest_step(spark, sf):
    return relational.largest_step(numbered(spark, sf), KEY, "i", "gappy").withColumn("max_step", r("max_step"))


@query(f"""WITH {EVENTS}, s AS (SELECT user_id, sum(value) OVER w - lag(value) OVER w AS d FROM e WINDOW w AS (PARTITION BY user_id ORDER BY i)) SELECT user_id, bool_and(d >= -1e-6) FILTER (WHERE d IS NOT NULL) AS monotone FROM s GROUP BY 1""")
def agg13_monotone(spark, sf):
    w = Window.partitionBy("user_id").orderBy("i")
    return numbered(spark, sf).withColumn("d", F.sum("value").over(w) - F.lag("value").over(w)).groupBy("user_id").agg(F.bool_and(F.col("d") >= -1e-6).alias("monotone"))


@query("""WITH x AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS p, unnest(embedding)::DOUBLE AS v FROM embeddings) SELECT label, CAST(p AS INTEGER) AS p, round(median(v), 6) AS v FROM x GROUP BY 1, 2""")
def agg14_median_vector(spark, sf):
    return learn.median_vector(table(spark, sf, "embeddings"), ["label"], "embedding").select("label", F.posexplode("vector").alias("p", "v")).withColumn("v", r("v"))


@query("""WITH x AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS p, unnest(embedding)::DOUBLE AS v FROM embeddings), m AS (SELECT label, p, avg(v) AS v FROM x GROUP BY 1, 2), n AS (SELECT label, sqrt(sum(v * v)) + 1e-9 AS n FROM m GROUP BY 1)
SELECT m.label, CAST(p AS INTEGER) AS p, round(v / n, 6) AS v FROM m JOIN n ON m.label = n.label""")
def agg15_mean_vector(spark, sf):
    return learn.mean_vector(table(spark, sf, "embeddings"), ["label"], "embedding").select("label", F.posexplode("vector").alias("p", "v")).withColumn("v", r("v"))


CENTRED = "list_transform({a}, lambda x: x::DOUBLE - {a}_m)"


@query("""WITH a AS (SELECT vec_id, embedding AS x, list_avg(list_transform(embedding, lambda v: v::DOUBLE)) AS m FROM embeddings), c AS (SELECT vec_id, list_transform(x, lambda v: v::DOUBLE - m) AS x FROM a),
z AS (SELECT x AS y FROM c WHERE vec_id = 0)
SELECT vec_id, round(list_sum(list_transform(list_zip(x, y), lambda p: p[1] * p[2])) / (sqrt(list_sum(list_transform(x, lambda v: v * v))) * sqrt(list_sum(list_transform(y, lambda v: v * v))) + 1e-9), 6) AS corr FROM c, z""")
def agg16_correlation(spark, sf):
    e = table(spark, sf, "embeddings")
    one = e.where("vec_id = 0").select(F.col("embedding").alias("ref"))
    return e.crossJoin(F.broadcast(one)).select("vec_id", r(vectors.correlation(F.col("embedding"), F.col("ref"))).alias("corr"))


@query("""WITH h AS (SELECT vec_id, label, list_transform(embedding, lambda v: abs(v)::DOUBLE) AS a FROM embeddings), p AS (SELECT vec_id, a, lag(a) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM h)
SELECT vec_id, round(CASE WHEN b IS NOT NULL THEN sqrt(greatest(0, 1 - list_sum(list_transform(list_zip(a, b), lambda z: sqrt(z[1] * z[2]))) / sqrt(list_sum(a) * list_sum(b)))) END, 5) AS d FROM p""")
def agg17_histogram_distance(spark, sf):
    h = table(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda v: F.abs(v).cast("double")).alias("a"))
    before = F.lag("a").over(Window.partitionBy("label").orderBy("vec_id"))
    return h.withColumn("b", before).select("vec_id", r(vectors.histogram_distance(F.col("a"), F.col("b")), 5).alias("d"))


@query("SELECT vec_id, round(list_sum(list_transform(embedding[11:14] || embedding[19:22], lambda v: v::DOUBLE)), 6) AS turf FROM embeddings")
def agg18_block_sum(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", r(vectors.block_sum(F.col("embedding"), 8, range(1, 3), range(2, 6))).alias("turf"))


@query(f"WITH {EVENTS} SELECT user_id, round(regr_slope(value, i), 8) AS slope, round(regr_intercept(value, i), 6) AS intercept, round(sum(i * value) / sum(i * i), 8) AS through_zero FROM e GROUP BY 1")
def agg19_agg20_least_squares(spark, sf):
    e = numbered(spark, sf)
    return e.groupBy("user_id").agg(r(F.regr_slope("value", "i"), 8).alias("slope"), r(F.regr_intercept("value", "i")).alias("intercept"), r(fits.slope_through_zero(F.col("i"), F.col("value")), 8).alias("through_zero"))


@query(f"""WITH {EVENTS}, g AS (SELECT i AS g, 1.9 + i * 0.0005::DOUBLE AS p FROM range(401) r(i)),
h AS (SELECT user_id, g, p, avg(CAST(abs(value * p - 5 * round_even(value * p / 5, 0)) < 0.25 AS DOUBLE)) AS share FROM e, g GROUP BY 1, 2, 3),
b AS (SELECT user_id, arg_max(p, (share, -g)) AS coarse, max(share) AS share FROM h GROUP BY 1),
f AS (SELECT e.user_id, value AS s, 5 * round_even(value * coarse / 5, 0) AS target, coarse FROM e JOIN b ON e.user_id = b.user_id)
SELECT b.user_id, round(b.share, 6) AS share, round(s, 6) AS scale FROM b LEFT JOIN (SELECT user_id, sum(s * target) / sum(s * s) AS s FROM f WHERE abs(s * coarse - target) < 0.3 GROUP BY 1) z ON b.user_id = z.user_id""")
def agg21_grid_fit(spark, sf):
    e = events(spark, sf).select("user_id", "value")
    return fits.grid_fit(e, KEY, "value").select("user_id", r("share").alias("share"), r("scale").alias("scale"))


@query("""WITH s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) + 1e-9 AS d, avg(l_tax) AS n, stddev_pop(l_tax) + 1e-9 AS f FROM lineitem WHERE l_orderkey % 2 = 0)
SELECT l_orderkey, l_linenumber, round((l_quantity - m) / d, 5) AS l_quantity, round((l_tax - n) / f, 5) AS l_tax FROM lineitem, s""")
def agg22_standardise(spark, sf):
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return learn.standardise(li, "l_orderkey", ["l_quantity", "l_tax"], F.col("l_orderkey") % 2 == 0).select("l_orderkey", "l_linenumber", r("l_quantity", 5).alias("l_quantity"), r("l_tax", 5).alias("l_tax"))


@query(f"""WITH {EVENTS}, d AS (SELECT user_id, i, value AS s, row_number() OVER (PARTITION BY user_id ORDER BY i) AS o FROM e),
p AS (SELECT a.user_id, a.o, count(DISTINCT b.i) AS n, median(b.s) AS m FROM d a JOIN d b ON a.user_id = b.user_id AND abs(a.s - b.s) < 0.5 GROUP BY 1, 2)
SELECT user_id, max(n) AS support, round(arg_max(m, (n, -o)), 5) AS median FROM p GROUP BY 1""")
def agg24_consensus(spark, sf):
    return fits.consensus(numbered(spark, sf), KEY, "i", "value", "value", 0.5).select("user_id", "support", r("median", 5).alias("median"))


@query(f"WITH {EVENTS} SELECT user_id, round(median(abs(value - 5 * round_even(value / 5, 0))), 6) AS resid FROM e GROUP BY 1")
def agg25_multiple_residual(spark, sf):
    return events(spark, sf).groupBy("user_id").agg(r(fits.multiple_residual(F.col("value"))).alias("resid"))


@query(f"""WITH {EVENTS}, m AS (SELECT user_id, (value * 3.6) % 180 AS theta FROM e), u AS (SELECT DISTINCT * FROM m),
v AS (SELECT a.user_id, a.theta, count(*) AS n FROM u a JOIN m b ON a.user_id = b.user_id AND least(abs(a.theta - b.theta) % 180, 180 - abs(a.theta - b.theta) % 180) < 6 GROUP BY 1, 2)
SELECT user_id, round(arg_max(theta, (n, theta)), 6) AS lane_theta, max(n) AS votes FROM v GROUP BY 1""")
def agg28_orientation_vote(spark, sf):
    m = events(spark, sf).select("user_id", F.pmod(F.col("value") * 3.6, F.lit(180.0)).alias("theta"))
    return lanes.lane_angle(m, KEY, "theta").withColumn("lane_theta", r("lane_theta"))


@query("SELECT DISTINCT l_returnflag, l_linenumber FROM lineitem", "set3_distinct_counts")
def set3_distinct_counts(spark, sf):
    return table(spark, sf, "lineitem", "l_returnflag", "l_linenumber").distinct()


@query("SELECT l_suppkey FROM lineitem INTERSECT SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000")
def set_intersect(spark, sf):
    return table(spark, sf, "lineitem", "l_suppkey").intersect(table(spark, sf, "supplier").where("s_acctbal > 5000").select("s_suppkey"))


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def set_except(spark, sf):
    return table(spark, sf, "customer", "c_custkey").exceptAll(table(spark, sf, "orders", "o_custkey").distinct())


@query("SELECT c_custkey AS k, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier")
def set1_union_all(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind")).unionByName(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("supplier").alias("kind")))


# ---- ordered sequences


@query(f"""WITH {EVENTS}, d AS (SELECT event_id, value, t - lag(t) OVER w AS dt, value - lag(value) OVER w AS dv FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t))
SELECT event_id, coalesce(value > 0 AND dt < 40000 AND abs(dv - dt) < 20000, false) AS counting FROM d""")
def win1_win2_counting_flags(spark, sf):
    return series.counting(events(spark, sf), KEY, "t", "value", 40000, 20000).select("event_id", "counting")


@query("""WITH x AS (SELECT DISTINCT l_returnflag, l_partkey AS x FROM lineitem), d AS (SELECT *, coalesce(CAST(x - lag(x) OVER (PARTITION BY l_returnflag ORDER BY x) > 3 AS INTEGER), 0) AS n FROM x),
c AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag ORDER BY x) AS c FROM d), m AS (SELECT l_returnflag, c, CAST(trunc(median(x)) AS INTEGER) AS slot FROM c GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, m.slot FROM lineitem l JOIN c ON l.l_returnflag = c.l_returnflag AND l.l_partkey = c.x JOIN m ON c.l_returnflag = m.l_returnflag AND c.c = m.c""")
def win3_gap_clusters(spark, sf):
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    return series.clusters(li, ["l_returnflag"], "l_partkey", 3).select("l_orderkey", "l_linenumber", "slot")


@query(f"""WITH {EVENTS}, d AS (SELECT event_id, user_id, t, coalesce(CAST(t - lag(t) OVER (PARTITION BY user_id ORDER BY t) > 40000 AS BIGINT), 0) AS n FROM e)
SELECT event_id, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY t) AS BIGINT) AS session FROM d""")
def win3_sessions(spark, sf):
    return series.gap_sessions(events(spark, sf), KEY, "t", 40000).select("event_id", "session")


@query(f"""WITH {EVENTS}, n AS (SELECT user_id, t, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY t) AS nxt FROM e)
SELECT user_id, min(t) AS repeat_at, arg_min(event_type, t) AS repeated FROM n WHERE event_type = nxt GROUP BY 1""")
def win5_first_repeat(spark, sf):
    return series.first_repeat(events(spark, sf), KEY, "t", "event_type")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(row_number() OVER (PARTITION BY o_custkey, o_orderstatus <> 'P' ORDER BY o_orderdate, o_orderkey) AS INTEGER) END AS attempt FROM orders""")
def win6_attempts(spark, sf):
    return identity.attempts(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") != "P").select("o_orderkey", "attempt")


@query("""SELECT o_orderkey, o_orderpriority <> first_value(o_orderpriority) OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) AS duplicate FROM orders""")
def win7_cross_source_duplicates(spark, sf):
    return identity.cross_source_duplicates(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"], "o_orderpriority", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "duplicate")


@query(f"WITH {EVENTS} SELECT event_id, max(gappy) OVER (PARTITION BY user_id ORDER BY i) AS peak FROM e")
def win8_running_max(spark, sf):
    return series.running_max(numbered(spark, sf), KEY, "i", "gappy").select("event_id", "peak")


@query(f"WITH {EVENTS} SELECT event_id, round(median(value) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS median FROM e")
def win10_rolling_median(spark, sf):
    return series.rolling_median(numbered(spark, sf), KEY, "i", "value").select("event_id", r("median").alias("median"))


FILL = """k AS (SELECT *, CASE WHEN gappy IS NOT NULL THEN i END AS j FROM e),
b AS (SELECT *, last_value(j IGNORE NULLS) OVER p AS i0, last_value(gappy IGNORE NULLS) OVER p AS v0, first_value(j IGNORE NULLS) OVER f AS i1, first_value(gappy IGNORE NULLS) OVER f AS v1 FROM k
  WINDOW p AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(f"WITH {EVENTS}, {FILL} SELECT event_id, round(CASE WHEN gappy IS NOT NULL THEN gappy WHEN i0 IS NOT NULL AND i1 IS NOT NULL AND i1 - i0 - 1 <= 2 THEN v0 + (v1 - v0) / (i1 - i0) * (i - i0) END, 6) AS filled FROM b")
def win12_gap_fill(spark, sf):
    return series.gap_fill(numbered(spark, sf), KEY, "i", "gappy", 2).select("event_id", r("filled").alias("filled"))


@query(f"""WITH {EVENTS}, {FILL}, g AS (SELECT *, CASE WHEN gappy IS NOT NULL THEN gappy WHEN i0 IS NULL THEN v1 WHEN i1 IS NULL THEN v0 ELSE v0 + (v1 - v0) / (i1 - i0) * (i - i0) END AS f FROM b),
m AS (SELECT *, median(f) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS m, count(gappy) OVER (PARTITION BY user_id) AS n FROM g)
SELECT event_id, CASE WHEN n > 7 AND abs(gappy - m) > 30 THEN NULL ELSE gappy END AS clean FROM m""")
def win11_despike(spark, sf):
    return series.despike(numbered(spark, sf), KEY, "i", "gappy", 7, 30).select("event_id", "clean")


@query(f"WITH {EVENTS}, {FILL} SELECT event_id, round(CASE WHEN i0 IS NULL THEN v1 WHEN i1 IS NULL THEN v0 WHEN i0 = i1 THEN v0 ELSE v0 + (v1 - v0) / (i1 - i0) * (i - i0) END, 6) AS filled FROM b")
def win27_fill_both_ways(spark, sf):
    return series.gap_fill(numbered(spark, sf), KEY, "i", "gappy", None, "hold").select("event_id", r("filled").alias("filled"))


def savgol_sql(width: int, degree: int, deriv: int, value: str = "gappy", rate: float = 1.0, before: str = EVENTS, source: str = "e", places: int = 6) -> str:
    """The smoothed ``value`` of ``source`` (event_id, user_id, i), which the tables in ``before`` define."""
    half = width // 2
    matrix = "[" + ", ".join("[" + ", ".join(f"{c!r}::DOUBLE" for c in map(float, row)) + "]" for row in series.savgol_coefficients(width, degree, deriv, rate)) + "]"
    short = "v" if deriv == 0 else "NULL"
    return f"""WITH {before}, sa AS (SELECT event_id, user_id, i, {value} AS v, i - count({value}) OVER (PARTITION BY user_id ORDER BY i) AS s FROM {source}),
sb AS (SELECT event_id, v, count(*) OVER (PARTITION BY user_id, s) AS n, row_number() OVER w - 1 AS p, list(v) OVER (PARTITION BY user_id, s ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l FROM sa WHERE v IS NOT NULL WINDOW w AS (PARTITION BY user_id, s ORDER BY i)),
sc AS (SELECT *, greatest({half}, least(p, n - 1 - {half})) AS c FROM sb)
SELECT e.event_id, round(CASE WHEN n >= {width} THEN list_sum(list_transform(list_zip(l[c - {half} + 1:c + {half} + 1], ({matrix})[p - c + {half} + 1]), lambda z: z[1] * z[2])) ELSE {short} END, {places}) AS smooth FROM {source} e LEFT JOIN sc ON e.event_id = sc.event_id"""


def _savgol(width: int, degree: int, deriv: int):
    def run(spark, sf):
        return series.savgol(numbered(spark, sf), KEY, "i", "gappy", width, degree, deriv, 1.0).select("event_id", r("smooth").alias("smooth"))

    return run


for _w, _d, _k in ((7, 2, 0), (9, 2, 0), (5, 3, 1), (7, 3, 2)):
    query(savgol_sql(_w, _d, _k), f"win13_savgol_{_w}_{_d}_{_k}")(_savgol(_w, _d, _k))


HELD = """h AS (SELECT event_id, user_id, i, gappy, CASE WHEN count(gappy) OVER (PARTITION BY user_id) < 2 THEN gappy WHEN gappy IS NOT NULL THEN gappy WHEN i0 IS NULL THEN v1 WHEN i1 IS NULL THEN v0 ELSE v0 + (v1 - v0) / (i1 - i0) * (i - i0) END AS f FROM b),
md AS (SELECT event_id, user_id, i, gappy, CASE WHEN f IS NOT NULL THEN median(f) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) END AS m FROM h)"""
ROBUST = f"""WITH x AS ({savgol_sql(15, 2, 0, "m", before=f"{EVENTS}, {FILL}, {HELD}", source="md", places=9)}), {EVENTS},
y AS (SELECT e.event_id, gappy, smooth, i, min(CASE WHEN gappy IS NOT NULL THEN i END) OVER u AS lo, max(CASE WHEN gappy IS NOT NULL THEN i END) OVER u AS hi, count(gappy) OVER u AS n FROM e JOIN x ON e.event_id = x.event_id WINDOW u AS (PARTITION BY user_id))
SELECT event_id, round(CASE WHEN n < 3 THEN gappy WHEN i BETWEEN lo - 15 AND hi + 15 THEN smooth END, 6) AS {{name}} FROM y"""


@query(ROBUST.format(name="robust"))
def win14_robust_smooth(spark, sf):
    return series.robust_smooth(numbered(spark, sf), KEY, "i", "gappy").select("event_id", r("robust").alias("robust"))


@query(f"""WITH {EVENTS}, g AS (SELECT event_id, gappy, lag(gappy) OVER w AS a, lead(gappy) OVER w AS b, i = 1 AS first, lead(i) OVER w IS NULL AS last FROM e WINDOW w AS (PARTITION BY user_id ORDER BY i))
SELECT event_id, round(CASE WHEN first THEN (b - gappy) * 2.0 WHEN last THEN (gappy - a) * 2.0 ELSE (b - a) * 1.0 END, 6) AS gradient FROM g""")
def win15_gradient(spark, sf):
    return series.gradient(numbered(spark, sf), KEY, "i", "gappy", 2.0).select("event_id", r("gradient").alias("gradient"))


@query(f"WITH {EVENTS} SELECT event_id, CASE WHEN gappy IS NOT NULL THEN CAST(gappy < greatest(0.35 * coalesce(value, 0), 1.5) AS DOUBLE) END AS foot_contact FROM e")
def win16_foot_contact(spark, sf):
    return events(spark, sf).select("event_id", series.foot_contact(F.col("gappy"), F.col("value")).alias("foot_contact"))


@query(f"""WITH {EVENTS}, h AS (SELECT user_id, i, 10.0 / (lead(i) OVER w - i) AS f, lead(value) OVER w - value AS l FROM e WHERE event_type = 'signup' WINDOW w AS (PARTITION BY user_id ORDER BY i))
SELECT e.event_id, round(h.f, 6) AS step_freq_hz, round(h.l, 6) AS step_len_yd FROM e ASOF LEFT JOIN h ON e.user_id = h.user_id AND e.i >= h.i""")
def win18_jon16_hold_steps(spark, sf):
    e = numbered(spark, sf)
    out = series.hold_steps(e, e.where("event_type = 'signup'").select("user_id", "i", "value"), KEY, "i", "value", 10.0)
    return out.select("event_id", r("step_freq_hz").alias("step_freq_hz"), r("step_len_yd").alias("step_len_yd"))


@query(f"""WITH {EVENTS}, z AS (SELECT user_id, median(i - value * (30000.0::DOUBLE / 1001)) AS k0, count(*) AS n FROM e WHERE value > 0 GROUP BY 1),
x AS (SELECT e.user_id, abs(value - (i - k0) / (30000.0::DOUBLE / 1001)) AS r FROM e JOIN z ON e.user_id = z.user_id WHERE value > 0)
SELECT z.user_id, round(any_value(k0), 6) AS k0, any_value(n) AS n, round(quantile_cont(r, 0.95), 6) AS resid_p95 FROM z JOIN x ON z.user_id = x.user_id GROUP BY 1""")
def win22_agg8_clock_fit(spark, sf):
    return fits.clock_fit(numbered(spark, sf), KEY, "i", "value").select("user_id", r("k0").alias("k0"), "n", r("resid_p95").alias("resid_p95"))


@query(f"""WITH {EVENTS}, s AS (SELECT user_id, i AS t, gappy AS v, row_number() OVER (PARTITION BY user_id ORDER BY i) AS a, row_number() OVER (PARTITION BY user_id ORDER BY i DESC) AS b, lead(i) OVER (PARTITION BY user_id ORDER BY i) AS t1, lead(gappy) OVER (PARTITION BY user_id ORDER BY i) AS v1 FROM e WHERE gappy IS NOT NULL),
g AS (SELECT user_id, max(t) AS hi, min(t) AS lo, count(*) AS n, regr_slope(v, t) FILTER (WHERE b <= 4) AS bs, regr_intercept(v, t) FILTER (WHERE b <= 4) AS bi, regr_slope(v, t) FILTER (WHERE a <= 4) AS fs, regr_intercept(v, t) FILTER (WHERE a <= 4) AS fi FROM s GROUP BY 1),
q AS (SELECT user_id, unnest([-1.5, 20.25, hi + 3.0, hi + 9.0]) AS x, g.* EXCLUDE (user_id) FROM g)
SELECT q.user_id, x::DOUBLE AS x, round(CASE WHEN n < 4 OR x < lo - 5 OR x > hi + 5 THEN NULL WHEN x < lo THEN fs * x + fi WHEN x > hi THEN bs * x + bi ELSE v + (v1 - v) * (x - t) / (t1 - t) END, 5) AS value
FROM q LEFT JOIN s ON q.user_id = s.user_id AND x >= t AND x < t1""")
def win23_value_near(spark, sf):
    e = numbered(spark, sf)
    ends = e.where("gappy IS NOT NULL").groupBy("user_id").agg(F.max("i").alias("hi"))
    at = ends.select("user_id", F.explode(F.array(F.lit(-1.5), F.lit(20.25), F.col("hi") + 3.0, F.col("hi") + 9.0)).alias("_at"))
    return series.value_near(e, KEY, "i", "gappy", at).select("user_id", F.col("_at").alias("x"), r("value", 5).alias("value"))


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 6")
def win25_head_n(spark, sf):
    return identity.head_n(table(spark, sf, "orders", "o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 6).select("o_custkey", "o_orderkey")


@query("""SELECT c_custkey, CASE WHEN row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey, md5(CAST(c_custkey AS VARCHAR) || ':2026'), c_custkey) % 2 = 1 THEN 'train' ELSE 'test' END AS split FROM customer""")
def win26_stratified_split(spark, sf):
    return identity.stratified_split(table(spark, sf, "customer"), "c_custkey", "c_mktsegment", "c_nationkey", method="md5").select("c_custkey", "split")


# ---- sorts and limits


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 96")
def srt3_top_by_count(spark, sf):
    return relational.top_by_count(table(spark, sf, "orders"), ["o_custkey"], 96)


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def srt1_srt2_sorted(spark, sf):
    return table(spark, sf, "orders", "o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey")


@query("""SELECT event_id, CAST(user_id AS VARCHAR) || '_' || lpad(CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS VARCHAR), CAST(greatest(3, length(CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS VARCHAR))) AS INTEGER), '0') AS run_id FROM events""")
def srt5_sequential_ids(spark, sf):
    return identity.sequential_ids(events(spark, sf), "user_id", ["t", "event_id"]).select("event_id", "run_id")


# ---- reshape and learning


@query("SELECT o_orderstatus, " + ", ".join(f"round(sum(o_totalprice) FILTER (WHERE o_orderpriority = '{p}'), 2) AS \"{p}\"" for p in ("1-URGENT", "2-HIGH", "5-LOW")) + " FROM orders GROUP BY 1")
def rsh1_pivot(spark, sf):
    s = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    return learn.pivot_grid(s, "o_orderstatus", "o_orderpriority", "v", ["1-URGENT", "2-HIGH", "5-LOW"])


@query(f"""WITH {EVENTS}, g AS (SELECT DISTINCT e.user_id, r.i + 1 AS i FROM e, range(100) r(i)), x AS (SELECT g.user_id, g.i, e.gappy FROM g LEFT JOIN e ON g.user_id = e.user_id AND g.i = e.i),
{FILL.replace("FROM e)", "FROM x)")} SELECT user_id, CAST(i - 1 AS INTEGER) AS p, round(CASE WHEN count(gappy) OVER (PARTITION BY user_id) <= 1 THEN 0.0 WHEN i0 IS NULL THEN v1 WHEN i1 IS NULL THEN v0 WHEN i0 = i1 THEN v0 ELSE v0 + (v1 - v0) / (i1 - i0) * (i - i0) END, 6) AS v FROM b""")
def rsh3_tensor(spark, sf):
    e = numbered(spark, sf).withColumn("g", F.col("i").cast("double"))
    every = e.select("user_id").distinct()
    out = learn.tensor(e.select("user_id", "g", "gappy").unionByName(every.select("user_id", F.lit(None).cast("double").alias("g"), F.lit(None).cast("double").alias("gappy"))), "user_id", "g", ["gappy"], [float(x) for x in range(1, 101)])
    return out.select("user_id", F.posexplode("gappy").alias("p", "v")).withColumn("v", r("v"))


@query()
def ml2_logistic(spark, sf):
    e = table(spark, sf, "embeddings")
    n = len(e.first().embedding)
    wide = e.select("vec_id", "label", *(F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(n)))
    model = learn.logistic(wide.where("vec_id % 2 = 0"), [f"f{i}" for i in range(n)], "label")
    return model.transform(wide.where("vec_id % 2 = 1")).agg(F.round(F.avg((F.col("prediction") == F.col("_label")).cast("double")), 2).alias("accuracy"))


@query()
def ml3_leader_clusters(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("unit", vectors.unit(F.col("embedding")))
    return kernels.sound(kernels.leader_clusters(e, ["label"], "vec_id", "unit", 0.5)).select("label", "vec_id", "cluster", "leader")


@query(f"""WITH {EVENTS}, m AS (SELECT user_id, sum(i) AS sx, sum(i * i) AS sxx, count(*)::DOUBLE AS n, sum((2.0 * i + 3) / (0.01 * i + 1)) AS sy FROM e GROUP BY 1)
SELECT user_id, 2.0::DOUBLE AS a, 3.0::DOUBLE AS b, 0.01::DOUBLE AS c FROM m WHERE n >= 3""")
def ml6_projective_fit(spark, sf):
    e = numbered(spark, sf).withColumn("s", F.col("i").cast("double")).withColumn("u", (2.0 * F.col("s") + 3) / (0.01 * F.col("s") + 1))
    return fits.projective_fit(e, KEY, "s", "u").select("user_id", r("a", 4).alias("a"), r("b", 3).alias("b"), r("c", 6).alias("c"))


# ---- scalar functions and geometry


@query(f"""WITH {EVENTS}, p AS (SELECT event_id, value AS ax, t / 1e5 AS ay, 10.0 AS bx, 20.0 AS by_, i::DOUBLE AS cx, 5.0 AS cy FROM e),
v AS (SELECT event_id, ax - bx AS ux, ay - by_ AS uy, cx - bx AS vx, cy - by_ AS vy FROM p)
SELECT event_id, round(degrees(acos(greatest(-1, least(1, (ux * vx + uy * vy) / (sqrt(ux * ux + uy * uy) * sqrt(vx * vx + vy * vy) + 1e-9))))), 4) AS angle,
 round(CASE WHEN ux * 1.0 + uy * 0.5 < 0 THEN -1 ELSE 1 END * degrees(atan2(abs(ux), -uy)), 4) AS lean FROM v""")
def fn_angles(spark, sf):
    e = numbered(spark, sf)
    a, b, c = (F.col("value"), F.col("t") / 1e5), (F.lit(10.0), F.lit(20.0)), (F.col("i").cast("double"), F.lit(5.0))
    return e.select("event_id", r(G.joint_angle(a, b, c), 4).alias("angle"), r(G.lean(a, b, (F.lit(1.0), F.lit(0.5))), 4).alias("lean"))


@query(f"WITH {EVENTS} SELECT event_id, round((2.0 * value + 3) / (0.01 * value + 1), 6) AS u, round(value, 6) AS back FROM e")
def fn_projective_map(spark, sf):
    a, b, c = F.lit(2.0), F.lit(3.0), F.lit(0.01)
    u = G.project(F.col("value"), a, b, c)
    return events(spark, sf).select("event_id", r(u).alias("u"), r(G.unproject(u, a, b, c)).alias("back"))


@query("""WITH c AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE - list_avg(list_transform(embedding, lambda w: w::DOUBLE))) AS x FROM embeddings)
SELECT vec_id, round(list_sum(list_transform(x, lambda v: v * v)) / pow(sqrt(list_sum(list_transform(x, lambda v: v * v))) + 1e-9, 2), 6) AS length, round(x[1] / (sqrt(list_sum(list_transform(x, lambda v: v * v))) + 1e-9), 6) AS first FROM c""")
def pnl1_standard_vector(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", vectors.standard(F.col("embedding")).alias("x")).select("vec_id", r(vectors.dot(F.col("x"), F.col("x"))).alias("length"), r(F.col("x")[0]).alias("first"))


@query(f"""WITH {EVENTS}, g AS (SELECT user_id, CAST(i * 20 + (i // 4) * 100 AS INTEGER) AS x, 15 AS w, event_id, i FROM e),
f AS (SELECT *, coalesce(CAST(x - (lag(x) OVER s + lag(w) OVER s) > 80 AS INTEGER), 0) AS n FROM g WINDOW s AS (PARTITION BY user_id ORDER BY x))
SELECT event_id, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY x) AS BIGINT) AS field FROM f""")
def pnl4_split_fields(spark, sf):
    g = numbered(spark, sf).select("user_id", "event_id", (F.col("i") * 20 + F.floor(F.col("i") / 4) * 100).cast("int").alias("x"), F.lit(15).alias("w"))
    return panel.split_fields(g, KEY).select("event_id", F.col("field").cast("bigint").alias("field"))


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN -1.0::DOUBLE ELSE o_totalprice END AS o_totalprice FROM orders")
def frm2_update_field(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    new = o.where("o_orderkey % 5 = 0").select((F.col("o_orderkey")).alias("o_orderkey"), F.lit(-1.0).alias("o_totalprice")).unionByName(spark.createDataFrame([(-7, 3.0)], "o_orderkey bigint, o_totalprice double"))
    return panel.update_field(o, new, ["o_orderkey"], "o_totalprice")


# ---- the lane

#: Two level rows of marks 100 px apart, 40 px between marks; offsets and angles vary by event.
NEAR = "named_struct('x', 0.0D, 'y', 500.0D, 'dx', 1.0D, 'dy', 0.0D, 'a', 40.0D, 'b', 0.0D, 'c', 0.0D, 'resid', 0.01D)"
FAR = "named_struct('x', 0.0D, 'y', 400.0D, 'dx', 1.0D, 'dy', 0.0D, 'a', 40.0D, 'b', 0.0D, 'c', 0.001D, 'resid', 0.02D)"


def lane(spark: SparkSession, sf: str) -> DataFrame:
    return numbered(spark, sf).withColumn("near", F.expr(NEAR)).withColumn("far", F.expr(FAR)).withColumn("theta", 90.0 - F.col("value") / 20)


@query(f"""WITH {EVENTS} SELECT event_id, round(value / (40 - 0.001::DOUBLE * value), 6) AS s, round((40.0 * i) / (0.001::DOUBLE * i + 1), 6) AS x, i % 3 <> 0 AS usable FROM e""")
def geo1_geo2_rows(spark, sf):
    df = lane(spark, sf)
    rows = F.array(F.col("near"), F.when(F.col("i") % 3 == 0, F.col("far").withField("resid", F.lit(0.5))).otherwise(F.col("far")))
    return df.select("event_id", r(lanes.below(F.col("far"), F.col("value"))).alias("s"), r(lanes.point_at(F.col("far"), F.col("i").cast("double"))[0]).alias("x"), lanes.usable(rows).alias("usable"))


@query(f"""WITH {EVENTS}, a AS (SELECT event_id, (40.0 * (i % 30)) / (0.001::DOUBLE * (i % 30) + 1) AS u, radians(90 - value / 20) AS th FROM e)
SELECT event_id, round(100 * cos(th) / sin(th), 5) AS dx, -100.0::DOUBLE AS dy, round(u - 0.75 * 100 * cos(th) / sin(th), 5) AS px, 475.0::DOUBLE AS py FROM a""")
def geo3_lane_points(spark, sf):
    s = (F.col("i") % 30).cast("double")
    df, args = lane(spark, sf), (F.col("near"), F.col("far"), s)
    d = lanes.rung(*args, F.lit(0.0), F.col("theta"))
    p = lanes.lane_point(*args, F.lit(0.25), F.lit(0.0), F.col("theta"))
    return df.select("event_id", r(d[0], 5).alias("dx"), r(d[1], 3).alias("dy"), r(p[0], 5).alias("px"), r(p[1], 3).alias("py"))


@query(f"""WITH {EVENTS} SELECT event_id, round((i % 30)::DOUBLE, 4) AS s_through, 0.25::DOUBLE AS w, round((i % 30)::DOUBLE, 3) AS s_below FROM e""")
def geo4_win24_inverse(spark, sf):
    s = (F.col("i") % 30).cast("double")
    df, zero, theta = lane(spark, sf), F.lit(0.0), F.col("theta")
    p = lanes.lane_point(F.col("near"), F.col("far"), s, F.lit(0.25), zero, theta)
    through, w = lanes.across(F.col("near"), F.col("far"), p, zero, theta)
    under = lanes.place_below(F.col("near"), F.col("far"), p[0], F.lit(0.25), zero, theta, F.lit(-3.013), F.lit(33.0))
    return df.select("event_id", r(through, 4).alias("s_through"), r(w, 4).alias("w"), r(under, 3).alias("s_below"))


@query(f"""WITH {EVENTS}, h AS (SELECT user_id, value * 20 AS u, 90 - value / 50 AS angle FROM e),
d AS (SELECT *, coalesce(CAST(u - lag(u) OVER w > 25.1 AS INTEGER), 0) AS n FROM h WINDOW w AS (PARTITION BY user_id ORDER BY u, angle)), c AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY u, angle) AS c FROM d),
m AS (SELECT user_id, c, median(u) AS u, median(angle) AS angle FROM c GROUP BY 1, 2)
SELECT user_id, round(u, 4) AS u, round(angle, 4) AS angle FROM m QUALIFY abs(angle - median(angle) OVER (PARTITION BY user_id)) < 20""")
def geo5_line_hits(spark, sf):
    e = lane(spark, sf).select("user_id", "far", (F.col("value") * 20).alias("u"), F.radians(90 - F.col("value") / 50).alias("th"))
    lines = e.select("user_id", "far", "u", (F.col("u") + 10 * F.cos("th")).alias("x0"), (400 - 10 * F.sin("th")).alias("y0"), (F.col("u") + 110 * F.cos("th")).alias("x1"), (400 - 110 * F.sin("th")).alias("y1"))
    return lanes.line_hits(lines, KEY, "far", ("x0", "y0", "x1", "y1"), apart=25.1).select("user_id", r("u", 4).alias("u"), r("angle", 4).alias("angle"))


@query(f"""WITH {EVENTS}, h AS (SELECT user_id, value AS u, 80 + value / 7 + i / 9.0 AS angle FROM e WHERE event_type = 'click'), f AS (SELECT user_id, count(*) AS n, regr_slope(angle, u) AS s, regr_intercept(angle, u) AS c, min(u) AS lo, max(u) AS hi, avg(angle) AS one FROM h GROUP BY 1),
k AS (SELECT user_id, 1000.0::DOUBLE AS u FROM e GROUP BY 1)
SELECT k.user_id, round(CASE WHEN n = 1 THEN one WHEN n > 1 THEN s * greatest(lo - 300, least(hi + 300, k.u)) + c END, 4) AS theta FROM k LEFT JOIN f ON k.user_id = f.user_id""")
def geo6_angle_at(spark, sf):
    e = numbered(spark, sf)
    h = e.where("event_type = 'click'").select("user_id", F.col("value").alias("u"), (80 + F.col("value") / 7 + F.col("i") / 9.0).alias("angle"))
    return lanes.angle_at(h, KEY, e.select("user_id").distinct().withColumn("at", F.lit(1000.0)), "at").select("user_id", r("theta", 4).alias("theta"))


@query(f"""WITH {EVENTS}, c AS (SELECT user_id, i, value AS n, value + 1 AS f, 20.0::DOUBLE AS hands FROM e), s AS (SELECT * FROM c WHERE abs(n - hands) < 5.5), o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY i, n, f) AS o FROM s),
p AS (SELECT a.user_id, a.o, count(DISTINCT b.i) AS k, median(b.f) AS m FROM o a JOIN o b ON a.user_id = b.user_id AND abs(a.n - b.n) < 0.1 GROUP BY 1, 2),
q AS (SELECT user_id, max(k) AS k, arg_max(m, (k, -o)) AS m FROM p GROUP BY 1)
SELECT u.user_id, round(m, 5) AS s_start, coalesce(k, 0) AS start_support FROM (SELECT DISTINCT user_id FROM e) u LEFT JOIN q ON u.user_id = q.user_id""")
def geo7_start_line(spark, sf):
    m = numbered(spark, sf).select("user_id", "i", F.col("value").alias("near"), (F.col("value") + 1).alias("far"), F.lit(20.0).alias("hands"))
    return lanes.start_line(m, KEY, "i", "near", "far", "hands", 5.5).select("user_id", r("s_start", 5).alias("s_start"), F.col("start_support").cast("bigint").alias("start_support"))


@query(f"""WITH {EVENTS} SELECT event_id, 300 + value * 3 BETWEEN 340 AND 560 AS inside FROM e""")
def geo8_between_rows(spark, sf):
    return lane(spark, sf).select("event_id", lanes.between_rows(F.col("near"), F.col("far"), (F.lit(50.0), 300 + F.col("value") * 3)).alias("inside"))


@query(f"""WITH {EVENTS} SELECT event_id, round(CASE WHEN value >= 30 THEN i + 11.5 ELSE 50 END, 4) AS hx, value >= 30 AS sure, CASE WHEN value >= 30 THEN round(i + 11.5, 4) END AS hip FROM e""")
def geo9_geo13_body(spark, sf):
    e = numbered(spark, sf)
    points = F.transform(F.sequence(F.lit(0), F.lit(16)), lambda j: F.struct((F.col("i") + j).cast("double").alias("x"), j.cast("double").alias("y"), (F.col("value") / 100).alias("conf")))
    box = F.array(*(F.lit(float(v)) for v in (0, 0, 100, 200)))
    core = lanes.body_core(points, box)
    return e.select("event_id", r(core["hx"], 4).alias("hx"), core["sure"].alias("sure"), r(lanes.midpoint_if_sure(points, 11, 12)["x"], 4).alias("hip"))


@query(f"WITH {EVENTS} SELECT user_id, round(median(gappy), 5) AS w_run FROM e GROUP BY 1")
def geo10_lateral_position(spark, sf):
    return lanes.lateral_position(events(spark, sf), KEY, "gappy").withColumn("w_run", r("w_run", 5))


@query(ROBUST.format(name="theta_smooth"))
def geo14_smooth_angles(spark, sf):
    return lanes.smooth_angles(numbered(spark, sf), KEY, "i", "gappy").select("event_id", r("theta_smooth").alias("theta_smooth"))


@query()
def geo15_win28_ml4_index_rows(spark, sf):
    e = numbered(spark, sf)
    place = lambda u, y: (F.col("i") * 40.0 / (1 + 0.002 * F.col("i")) + u, F.lit(y) + F.col("i") * 0.5)
    rows = [e.select("user_id", place(u, y)[0].alias("x"), place(u, y)[1].alias("y"), F.lit(1.0).alias("theta"), F.lit(12.0).alias("length")) for u, y in ((0.0, 400.0), (15.0, 520.0))]
    return kernels.sound(kernels.index_rows(rows[0].unionByName(rows[1]), KEY)).select("user_id", "place", "marks", r("dx", 4).alias("dx"), r("resid", 3).alias("resid"))


@query()
def win21_track(spark, sf):
    e = numbered(spark, sf)
    one = lambda n, x, inside: e.select("user_id", F.col("i").cast("int").alias("frame"), F.lit(n).alias("number"), (x + F.col("i") * 3.0).alias("hx"), F.lit(300.0).alias("hy"), (x + F.col("i") * 3.0 + 5).alias("sx"), F.lit(240.0).alias("sy"), F.lit(True).alias("sure"), (x + F.col("i") * 3.0 - 30).alias("x0"), F.lit(200.0).alias("y0"), (x + F.col("i") * 3.0 + 30).alias("x1"), F.lit(400.0).alias("y1"), F.lit(False).alias("off"), F.lit(inside).alias("inside"), F.lit(10.0).alias("k0"), F.lit(90).alias("last"))
    return kernels.sound(kernels.track_bodies(one(0, F.lit(500.0), 0).unionByName(one(1, F.lit(100.0), 4)), KEY)).select("user_id", "frame", "number")


# ---- body channels: keypoints whose coordinates are made of an event's value, some of them missing

_X, _Y = "500 + 3 * i + (value * {a}) % 53", "300 + 12 * {j} + (value * {b}) % 31"
_MISSING = {9: "error", 6: "view", 15: "click"}


def _keypoint_sql(j: int) -> str:
    x, y = _X.format(a=7 * j + 3), _Y.format(j=j, b=5 * j + 1)
    there = f"CASE WHEN event_type <> '{_MISSING[j]}' THEN {{}} END" if j in _MISSING else "{}"
    return f"{there.format(x)} AS x{j}, {there.format(y)} AS y{j}"


BODY = f"""p AS (SELECT event_id, user_id, i, {", ".join(map(_keypoint_sql, pose.JOINTS))}, cos(value / 50) AS fx, sin(value / 50) AS fy, 520 + value / 10 AS ground,
  CASE WHEN event_type <> 'click' THEN value END AS al, (value * 3) % 100 AS ar FROM e),
q AS (SELECT *, (x5 + x6) / 2 AS sx, (y5 + y6) / 2 AS sy, (x11 + x12) / 2 AS hx, (y11 + y12) / 2 AS hy, coalesce(al >= ar, false) AS lead FROM p),
o AS (SELECT *, {", ".join(f"CASE WHEN lead THEN {c}{a} ELSE {c}{b} END AS {c}l{n}, CASE WHEN lead THEN {c}{b} ELSE {c}{a} END AS {c}t{n}" for n, (a, b) in (("h", pose.HIPS), ("k", pose.KNEES), ("a", pose.ANKLES)) for c in "xy")} FROM q)"""


def body_frames(spark: SparkSession, sf: str) -> DataFrame:
    def keypoint(j: int) -> Column:
        p = F.struct(F.expr(_X.format(a=f"{7 * j + 3}D")).alias("x"), F.expr(_Y.format(j=j, b=f"{5 * j + 1}D")).alias("y"))
        return (F.when(F.col("event_type") != _MISSING[j], p) if j in _MISSING else p).alias(f"p{j}")

    e = numbered(spark, sf)
    return e.select(
        "event_id", "user_id", "i", *map(keypoint, pose.JOINTS), F.struct(F.cos(F.col("value") / 50).alias("x"), F.sin(F.col("value") / 50).alias("y")).alias("forward"), (520 + F.col("value") / 10).alias("ground_y"),
        F.when(F.col("event_type") != "click", F.col("value")).alias("ankle_l"), (F.col("value") * 3 % 100).alias("ankle_r"), F.lit(80.0).alias("leg_len"), F.lit(50.0).alias("arm_len"),
    )


def _angle_sql(a: tuple[str, str], b: tuple[str, str], c: tuple[str, str]) -> str:
    ux, uy, vx, vy = f"({a[0]} - {b[0]})", f"({a[1]} - {b[1]})", f"({c[0]} - {b[0]})", f"({c[1]} - {b[1]})"
    return f"CASE WHEN {ux} + {uy} + {vx} + {vy} IS NOT NULL THEN degrees(acos(greatest(-1.0, least(1.0, ({ux} * {vx} + {uy} * {vy}) / (sqrt({ux} * {ux} + {uy} * {uy}) * sqrt({vx} * {vx} + {vy} * {vy}) + 1e-9))))) END"


def _lean_sql(top: tuple[str, str], bottom: tuple[str, str]) -> str:
    vx, vy = f"({top[0]} - {bottom[0]})", f"({top[1]} - {bottom[1]})"
    return f"CASE WHEN {vx} * fx + {vy} * fy < 0 THEN -1 ELSE 1 END * degrees(atan2(abs({vx}), -{vy}))"


def _at(n: str | int) -> tuple[str, str]:
    return f"x{n}", f"y{n}"


_S, _H = ("sx", "sy"), ("hx", "hy")
_ELBOW = [_angle_sql(*(_at(x[side]) for x in (pose.SHOULDERS, pose.ELBOWS, pose.WRISTS))) for side in (0, 1)]
_REACH = [f"((x{w} - x{s}) * fx + (y{w} - y{s}) * fy) / 50.0" for w, s in zip(pose.WRISTS, pose.SHOULDERS, strict=True)]
CHANNEL_SQL = {
    "trunk_angle": _lean_sql(_S, _H), "hip_height_ratio": "(ground - hy) / 80.0",
    "knee_lead": _angle_sql(_at("lh"), _at("lk"), _at("la")), "knee_trail": _angle_sql(_at("th"), _at("tk"), _at("ta")),
    "hip_flex_lead": _angle_sql(_S, _at("lh"), _at("lk")), "hip_flex_trail": _angle_sql(_S, _at("th"), _at("tk")),
    "shin_angle_lead": _lean_sql(_at("lk"), _at("la")), "thigh_sep": _angle_sql(_at("lk"), _H, _at("tk")),
    "elbow_angle": f"coalesce(({_ELBOW[0]} + {_ELBOW[1]}) / 2, {_ELBOW[0]}, {_ELBOW[1]})", "arm_swing": f"greatest({_REACH[0]}, {_REACH[1]}) - least({_REACH[0]}, {_REACH[1]})",
}


def _channel(*names: str):
    return lambda spark, sf: pose.channels(body_frames(spark, sf)).select("event_id", *(r(n, 5).alias(n) for n in names))


for _n in (("trunk_angle",), ("hip_height_ratio",), ("knee_lead", "knee_trail"), ("hip_flex_lead", "hip_flex_trail"), ("shin_angle_lead",), ("thigh_sep",), ("elbow_angle",), ("arm_swing",)):
    query(f"WITH {EVENTS}, {BODY} SELECT event_id, " + ", ".join(f"round({CHANNEL_SQL[c]}, 5) AS {c}" for c in _n) + " FROM o", "ch_" + "_".join(_n))(_channel(*_n))


@query(f"WITH {EVENTS}, {BODY} SELECT event_id, lead AS left_leads FROM o")
def ch_lead_leg(spark, sf):
    return body_frames(spark, sf).select("event_id", pose.lead_left(F.col("ankle_l"), F.col("ankle_r")).alias("left_leads"))


@query(f"""WITH {EVENTS}, {BODY}, s AS (SELECT user_id, unnest([sqrt((x11 - x13) ** 2 + (y11 - y13) ** 2), sqrt((x12 - x14) ** 2 + (y12 - y14) ** 2)]) AS thigh, unnest([sqrt((x13 - x15) ** 2 + (y13 - y15) ** 2), sqrt((x14 - x16) ** 2 + (y14 - y16) ** 2)]) AS shank FROM p),
a AS (SELECT user_id, median(sqrt((x5 - x7) ** 2 + (y5 - y7) ** 2) + sqrt((x7 - x9) ** 2 + (y7 - y9) ** 2)) AS arm FROM p GROUP BY 1)
SELECT s.user_id, round(median(thigh) + median(shank), 5) AS leg_len, round(any_value(arm), 5) AS arm_len FROM s JOIN a ON s.user_id = a.user_id GROUP BY 1""")
def fn_run_scale(spark, sf):
    return pose.body_scale(body_frames(spark, sf), KEY).select("user_id", r("leg_len", 5).alias("leg_len"), r("arm_len", 5).alias("arm_len"))


SHORT_FILL = "f AS (SELECT event_id, user_id, i, CASE WHEN count(gappy) OVER (PARTITION BY user_id) < 2 THEN gappy WHEN gappy IS NOT NULL THEN gappy WHEN i0 IS NOT NULL AND i1 IS NOT NULL AND i1 - i0 - 1 <= 4 THEN v0 + (v1 - v0) / (i1 - i0) * (i - i0) END AS f FROM b)"


@query(savgol_sql(7, 2, 0, "f", before=EVENTS.replace("CASE WHEN event_type = 'error' THEN NULL ELSE value END AS gappy", "CASE WHEN value / 100 >= 0.3 THEN value * 2 END AS gappy") + f", {FILL}, {SHORT_FILL}", source="f"))
def flt8_smooth_keypoints(spark, sf):
    e = numbered(spark, sf)
    point = F.struct((F.col("value") * 2).alias("x"), F.col("value").alias("y"), (F.col("value") / 100).alias("conf"))
    points = pose.smooth_keypoints(e.withColumn("kpts", F.array_repeat(point, 17)), ["user_id"], "i", "kpts")
    return e.join(points, ["user_id", "i"]).select("event_id", r(F.col("p9")["x"]).alias("smooth"))


PLACES = EVENTS.replace("CASE WHEN event_type = 'error' THEN NULL ELSE value END AS gappy", "CASE WHEN event_type <> 'error' THEN (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) * 0.02::DOUBLE + value / 5000) * (1.8::DOUBLE / 0.9144) END AS gappy")


def _kinematics(name: str):
    def run(spark, sf):
        from tidegrid.plans import build

        s = F.when(F.col("event_type") != "error", F.col("i") * 0.02 + F.col("value") / 5000)
        frames = numbered(spark, sf).select("event_id", F.col("user_id").alias("run_id"), F.col("i").alias("frame"), s.alias("s"), F.lit(3.25).alias("k0"))
        return build.kinematics(frames).select("event_id", r(name, 5).alias("smooth"))

    return run


for _n, _w, _d, _k in (("x_yd", 9, 2, 0), ("v_yds", 15, 3, 1), ("a_yds2", 21, 3, 2)):
    query(savgol_sql(_w, _d, _k, "f", series.FPS, f"{PLACES}, {FILL}, {SHORT_FILL}", "f", 5), f"ch_{_n}")(_kinematics(_n))


@query(f"WITH {EVENTS}, {BODY} SELECT event_id, round_even({CHANNEL_SQL['trunk_angle']}, 3) AS trunk_angle, CAST(({CHANNEL_SQL['trunk_angle']}) IS NOT NULL AND al IS NOT NULL AS INTEGER) AS valid FROM o")
def ch_valid(spark, sf):
    from tidegrid.plans import build

    found = pose.channels(body_frames(spark, sf)).withColumn("x_yd", F.col("ankle_l"))
    return build.finish_channels(found).select("event_id", "trunk_angle", "valid")


# ---- readings of a display, registries and windows that the queries above leave out

GLYPHS = """g AS (SELECT user_id AS f, CAST(i * 20 + (i // 3) * 100 AS INTEGER) AS x, 12 AS w, CASE WHEN event_type = 'error' THEN 'x' ELSE CAST(CAST(floor(value) AS BIGINT) % 10 AS VARCHAR) END AS label, CASE WHEN value > 2 THEN 0.9 ELSE 0.5 END AS score, (i // 3) AS n FROM e WHERE i >= 3)"""


def glyphs(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("event_type") == "error", "x").otherwise((F.floor("value") % 10).cast("string"))
    e = numbered(spark, sf).where("i >= 3")
    return e.select(F.col("user_id").alias("f"), (F.col("i") * 20 + F.floor(F.col("i") / 3) * 100).cast("int").alias("x"), F.lit(12).alias("w"), label.alias("label"), F.when(F.col("value") > 2, 0.9).otherwise(0.5).alias("score"))


@query(f"""WITH {EVENTS}, {GLYPHS} SELECT f, CAST((min(x) + max(x) + 12) // 2 AS INTEGER) AS x, CASE WHEN count(*) = 3 AND bool_and(label <> 'x' AND score >= 0.8) AND n <> 2 THEN CAST(string_agg(label, '' ORDER BY x) AS INTEGER) / 100.0::DOUBLE END AS value FROM g GROUP BY f, n""")
def pnl2_read_times(spark, sf):
    points = F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda n: F.when(n != 2, n * 3 * 20 + n * 100 + 14).otherwise(0).cast("int"))
    return panel.read_times(glyphs(spark, sf).withColumn("p", points), ["f"], "p").select("f", "x", "value")


@query(f"""WITH {EVENTS}, {GLYPHS} SELECT f, CASE WHEN bool_and(label <> 'x' AND score >= 0.8) THEN string_agg(label, '' ORDER BY x) END AS bib FROM g WHERE n > 1 GROUP BY f""")
def pnl3_read_bib(spark, sf):
    return panel.read_bib(glyphs(spark, sf), ["f"])


@query(f"""WITH {EVENTS} SELECT count(*) AS n FROM e WHERE user_id IN (SELECT user_id FROM e WHERE event_type = 'signup' AND value > 60)""")
def pnl5_src11_semi_manifest(spark, sf):
    e = events(spark, sf)
    timed = panel.keep_timed_frames(e, e.where("event_type = 'signup' AND value > 60"), KEY)
    return source.present(timed, e.where("event_type = 'signup' AND value > 60"), "user_id").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT vec_id AS number, label FROM embeddings), l AS (SELECT r_regionkey::BIGINT AS number, r_name FROM region) SELECT p.number, p.label, l.r_name FROM p JOIN l ON p.number = l.number""")
def pnl6_jon14_label_prototypes(spark, sf):
    p = table(spark, sf, "embeddings").select(F.col("vec_id").alias("number"), "label")
    return panel.label_prototypes(p, table(spark, sf, "region").select(F.col("r_regionkey").cast("bigint").alias("number"), "r_name"))


@query()
def pnl5_largest_clusters(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("unit", vectors.unit(F.col("embedding"))).withColumn("all", F.lit(0))
    found = kernels.sound(kernels.leader_clusters(e, ["all"], "vec_id", "unit", 0.3))
    return panel.largest_clusters(found, e, "vec_id", "unit", 96).select("number", "cluster", "n")


@query("""SELECT n_name, sha256(n_name) AS found, CASE WHEN n_nationkey % 2 = 0 THEN sha256(n_name) ELSE 'none' END AS expected FROM nation WHERE n_nationkey % 2 = 1""")
def agg27_checksum_mismatches(spark, sf):
    n = table(spark, sf, "nation").select("n_name", "n_nationkey", F.sha2("n_name", 256).alias("sha256"))
    registry = n.select("n_name", F.when(F.col("n_nationkey") % 2 == 0, F.col("sha256")).otherwise("none").alias("sha256"))
    return source.mismatches(n.drop("n_nationkey"), registry, "n_name")


@query("SELECT o_orderkey AS run_id, o_totalprice AS time_40yd, o_custkey AS athlete FROM orders ORDER BY run_id")
def prj7_prj8_rename_select(spark, sf):
    return table(spark, sf, "orders").withColumnsRenamed({"o_orderkey": "run_id", "o_totalprice": "time_40yd", "o_custkey": "athlete"}).select("run_id", "time_40yd", "athlete").orderBy("run_id")


@query("SELECT o_orderkey, o_totalprice / 40000 AS final FROM orders WHERE o_totalprice / 40000 BETWEEN 3.9 AND 6.5")
def flt11_plausible_range(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 40000).alias("final")).where(F.col("final").between(3.9, 6.5))


@query("SELECT l_returnflag, channel, count(value) AS n, round(avg(value), 4) AS mean FROM (UNPIVOT (SELECT l_returnflag, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME channel VALUE value) GROUP BY 1, 2")
def prj12_dynamic_channels(spark, sf):
    li = table(spark, sf, "lineitem", "l_returnflag", "l_quantity", "l_discount", "l_tax")
    channels = [c for c in li.columns if c != "l_returnflag"]
    return li.unpivot("l_returnflag", channels, "channel", "value").groupBy("l_returnflag", "channel").agg(F.count("value").alias("n"), r(F.avg("value"), 4).alias("mean"))


@query("SELECT user_id, event_id FROM events WHERE epoch_us(ts) / 1e6 BETWEEN epoch_us(TIMESTAMP '2024-01-05') / 1e6 - 1 / 29.97 - 1e-6 AND epoch_us(TIMESTAMP '2024-01-09') / 1e6 + 1 / 29.97 + 1e-6")
def flt7_slack_window(spark, sf):
    slack = 1 / 29.97 + 1e-6
    return events(spark, sf).where(F.col("t").between(4 * 86400 - slack, 8 * 86400 + slack)).select("user_id", "event_id")


@query(f"""WITH {EVENTS}, r AS (SELECT user_id, t, value, lag(t) OVER w AS b FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)) SELECT user_id, count(*) AS n, round(max(t - b), 4) AS longest FROM r GROUP BY 1""")
def win1_differences(spark, sf):
    w = Window.partitionBy("user_id").orderBy("t")
    return events(spark, sf).withColumn("d", F.col("t") - F.lag("t").over(w)).groupBy("user_id").agg(F.count("*").alias("n"), r(F.max("d"), 4).alias("longest"))


@query(f"""WITH {EVENTS}, {SEGMENT_SQL.format(v="gappy")}, b AS (SELECT user_id, min(t) AS lo, max(t) AS hi FROM e GROUP BY 1),
g AS (SELECT user_id, i, lo + (hi - lo) / 10 * i AS x FROM b, range(11) AS r(i)), p AS (SELECT g.user_id, i, CASE WHEN x = t0 THEN v0 WHEN t1 IS NOT NULL THEN v0 + (v1 - v0) / (t1 - t0) * (x - t0) END AS v FROM g LEFT JOIN s ON g.user_id = s.user_id AND x >= t0 AND (x < t1 OR t1 IS NULL))
SELECT user_id, {", ".join(f'round(max(v) FILTER (WHERE i = {k}), 4) AS "p{k}"' for k in range(11))} FROM p GROUP BY 1""")
def rsh1_pivot_phase(spark, sf):
    e = events(spark, sf)
    w = Window.partitionBy("user_id")
    e = e.withColumn("lo", F.min("t").over(w)).withColumn("hi", F.max("t").over(w))
    long = resample.by_phase(e, KEY, "t", "gappy", "lo", "hi", 11).select("user_id", F.concat(F.lit("p"), F.col("_i").cast("string")).alias("phase"), r("value", 4).alias("value"))
    return learn.pivot_grid(long, "user_id", "phase", "value", [f"p{k}" for k in range(11)])


@query(f"""WITH {EVENTS}, top AS (SELECT user_id FROM e GROUP BY user_id HAVING max(gappy) > 99)
SELECT event_type, count(*) AS n FROM e WHERE user_id IN (SELECT user_id FROM top) GROUP BY 1""")
def flt3_computed_set(spark, sf):
    e = events(spark, sf)
    top = e.groupBy("user_id").agg(F.max("gappy").alias("m")).where("m > 99")
    return source.present(e, top, "user_id").groupBy("event_type").agg(F.count("*").alias("n"))


# ---- kernels, streaming


@query()
def win4_streaks(spark, sf):
    e = numbered(spark, sf).withColumn("clock", F.pmod(F.col("i"), F.lit(9)) * 0.25).withColumn("s", F.col("i") * 0.25)
    held = e.withColumn("clock", F.when(F.pmod(F.col("i"), F.lit(9)) >= 6, F.lit(1.5)).otherwise(F.col("clock")))
    return kernels.sound(kernels.find_streaks(held, KEY, "s", "clock")).select("user_id", "first", "last", "t_origin", "final")


@query(f"""WITH RECURSIVE {EVENTS}, t AS (SELECT user_id, i, CAST(i AS INTEGER) AS frame, row_number() OVER (PARTITION BY user_id ORDER BY i) - 1 AS k, CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END AS contact, i * 0.25::DOUBLE AS place, value / 10 AS speed FROM e),
st AS (SELECT user_id, min(place) AS stance FROM t WHERE k BETWEEN 0 AND 3 GROUP BY 1),
c AS (SELECT t.*, stance, row_number() OVER (PARTITION BY t.user_id ORDER BY k) AS n FROM t JOIN st ON t.user_id = st.user_id WHERE contact = 1 AND k >= 4),
w(user_id, n, frame, place, landed) AS (SELECT user_id, n - 1, frame, CAST(NULL AS DOUBLE), false FROM c WHERE n = 1
  UNION ALL SELECT user_id, n, frame, CASE WHEN hit THEN place ELSE wp END, hit FROM
    (SELECT c.*, w.place AS wp, CASE WHEN w.place IS NULL THEN c.place - stance >= 0.6 ELSE c.place - w.place >= greatest(0.6, 0.12 * speed) END AS hit FROM w JOIN c ON c.user_id = w.user_id AND c.n = w.n + 1))
SELECT user_id, frame, place FROM w WHERE landed""")
def win17_touchdowns(spark, sf):
    e = numbered(spark, sf).withColumn("contact", (F.col("event_type") != "view").cast("double")).withColumn("place", F.col("i") * 0.25).withColumn("speed", F.col("value") / 10).withColumn("k0", F.lit(3.5))
    return kernels.sound(kernels.find_touchdowns(e, KEY, "i", "contact", "place", "speed", "k0")).select("user_id", "frame", "place")


@query(f"""WITH RECURSIVE {EVENTS}, u AS (SELECT user_id, i, CAST(i AS INTEGER) AS frame, (i * 0.3::DOUBLE) % 1.0 AS raw FROM e),
w(user_id, i, frame, raw, off, speed) AS (SELECT user_id, i, frame, raw, 0.0::DOUBLE, 0.0::DOUBLE FROM u WHERE i = 1
  UNION ALL SELECT user_id, i, frame, raw, off, 0.5 * speed + 0.5 * (raw + off - before) FROM
    (SELECT u.user_id, u.i, u.frame, u.raw, w.raw + w.off AS before, w.speed, round_even(w.raw + w.off + w.speed - u.raw, 0) AS off FROM w JOIN u ON u.user_id = w.user_id AND u.i = w.i + 1))
SELECT user_id, frame, off AS "offset" FROM w""")
def win19_unwrap(spark, sf):
    e = numbered(spark, sf).withColumn("raw", F.pmod(F.col("i") * 0.3, F.lit(1.0)))
    return kernels.sound(kernels.unwrap_offsets(e, KEY, "i", "raw")).select("user_id", "frame", "offset")


@query()
def win20_repair_slips(spark, sf):
    e = numbered(spark, sf).withColumn("offset", F.when(F.col("i") > 20, 1.0).otherwise(0.0)).withColumn("below", F.when(F.col("event_type") != "error", F.col("i") * 0.1)).withColumn("ref", F.lit(5))
    return kernels.sound(kernels.repair_offsets(e, KEY, "i", "offset", "below", "ref")).select("user_id", "frame", "offset")


@query(f"""WITH {EVENTS}, d AS (SELECT user_id, ts, coalesce(CAST(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 1 HOUR AS INTEGER), 0) AS n FROM events),
c AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts) AS c FROM d) SELECT user_id, min(ts) AS start, count(*) AS n FROM c GROUP BY user_id, c""")
def str_sessions(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return detect.sessions(e, "user_id", "ts", "1 hour").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def str_tumbling(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return detect.tumbling(e, "user_id", "ts", "value").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n", r("total", 4).alias("total"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
