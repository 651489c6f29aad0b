"""Vectors: templates, prototypes, nearest neighbours, and a logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions import vectors
from tidegrid.operators import ship
from tidegrid.operators.series import gap_fill

#: The side that is sent to all tasks is checked against this before it is broadcast.
BROADCAST_ROWS = 50_000


def small(df: DataFrame) -> DataFrame:
    """``df`` as a broadcast side, after a check of its size; else as it is, and Spark chooses."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def as_one_row(df: DataFrame, columns: list[str], order: str, out: str = "_all") -> DataFrame:
    """A library of templates as one row with an ordered array, for scoring without a cross join."""
    return df.agg(F.sort_array(F.collect_list(F.struct(order, *columns))).alias(out))


def template_match(df: DataFrame, vector: str, library: DataFrame, template: str, label: str, order: str) -> DataFrame:
    """The label and score of the template with the largest dot product (the first of equals).

    The library is broadcast as arrays and scored in the row, in blocks of at most ``BROADCAST_ROWS`` templates; each row keeps the best of a block."""
    known = library.select(F.col(order).alias("_o"), F.col(label).alias("_l"), F.col(template).alias("_v"))
    blocks = -(-max(1, known.count()) // BROADCAST_ROWS)
    out = df.withColumn("_best", F.lit(None).cast(f"struct<score:double,o:{known.schema['_o'].dataType.simpleString()},label:{known.schema['_l'].dataType.simpleString()}>"))
    scored = F.transform("_all", lambda t: F.struct(vectors.dot(F.col(vector), t["_v"]).alias("score"), (-t["_o"]).alias("o"), t["_l"].alias("label")))
    for k in range(blocks):
        all_ = as_one_row(known.where(F.pmod(F.xxhash64("_o"), F.lit(blocks)) == k), ["_l", "_v"], "_o")
        out = out.crossJoin(F.broadcast(all_)).withColumn("_best", F.greatest("_best", F.array_max(scored))).drop("_all")
    return out.withColumn("label", F.col("_best.label")).withColumn("score", F.col("_best.score")).drop("_best")


#: Training vectors of at most so many bytes are sent to all tasks as one matrix.
BROADCAST_BYTES = 64 << 20
#: Rows of a block of vectors, otherwise.
BLOCK_ROWS = 2048


def closest(x: np.ndarray, train: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest training row (the first by ``order`` of equals) and the squared distance.

    A matrix product finds what is near; the few that come as close as its rounding are compared by their exact distances."""
    best, found = np.empty(len(x)), np.empty(len(x), np.int64)
    own, far = (x * x).sum(1), (train * train).sum(1)
    for i in range(0, len(x), 256):
        rough = own[i : i + 256, None] + far - 2 * (x[i : i + 256] @ train.T)
        near = rough <= rough.min(1, keepdims=True) + 1e-9 * (own[i : i + 256, None] + far.max())
        row, candidate = np.nonzero(near)
        exact = ((x[i + row] - train[candidate]) ** 2).sum(1)
        ranked = np.lexsort((order[candidate], exact, row))
        first = ranked[np.searchsorted(row[ranked], np.arange(len(rough)))]
        best[i : i + 256], found[i : i + 256] = exact[first], candidate[first]
    return found, best


def nearest(test: DataFrame, train: DataFrame, key: str, vector: str, order: str, label: str, out: str = "predicted") -> DataFrame:
    """The label of the training row with the smallest squared distance (the first by ``order`` of equals).

    Each test row meets each training row, as the method asks for, by matrix products.  Training vectors of up to ``BROADCAST_BYTES`` go to all
    tasks, and nothing is shuffled.  More of them are dealt into blocks by their hash, as test rows are; blocks meet blocks, and each row's best of
    a block is kept: minima combine before the shuffle."""
    ship.by_value(__name__)
    spark = test.sparkSession
    t = train.select(F.col(order).cast("bigint").alias("_o"), F.col(label).alias("_l"), F.col(vector).cast("array<double>").alias("_v"))
    rows, width = t.agg(F.count("*"), F.max(F.size("_v"))).first()
    x = test.select(F.col(key).alias("_k"), F.col(vector).cast("array<double>").alias("_x"))
    kind, label_kind = x.schema["_k"].dataType.simpleString(), t.schema["_l"].dataType.simpleString()
    schema = f"_k {kind}, d double, o bigint, l {label_kind}"
    matrix = lambda lists, n: lists.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)

    if not rows:
        return x.select(F.col("_k").alias(key), F.lit(None).cast(label_kind).alias(out), F.lit(None).cast("double").alias("distance"))
    if rows * width * 8 <= BROADCAST_BYTES:
        known = t.toArrow().combine_chunks()
        sent = spark.sparkContext.broadcast((matrix(known["_v"].combine_chunks(), rows), known["_o"].to_numpy(), known["_l"].to_pylist()))

        def run(batches):
            import pyarrow as pa

            vectors_, orders, labels = sent.value
            for batch in batches:
                if batch.num_rows:
                    at, d = closest(matrix(batch.column(1), batch.num_rows), vectors_, orders)
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(d), pa.array(orders[at]), pa.array([labels[i] for i in at], known_type)], names=["_k", "d", "o", "l"])

        known_type = known.schema.field("_l").type
        best = x.mapInArrow(run, schema).select("_k", F.struct("d", "o", "l").alias("_m"))
    else:
        dealt = lambda df, c, n: df.groupBy(F.pmod(F.xxhash64(c), F.lit(n))).agg(F.collect_list(F.struct(*df.columns)).alias("_b")).select("_b")
        tests = dealt(x, "_k", -(-max(1, x.count()) // BLOCK_ROWS)).withColumnRenamed("_b", "_a")

        def meet(batches):
            import pyarrow as pa

            for batch in batches:
                for i in range(batch.num_rows):
                    a, b = (batch.column(c).slice(i, 1).flatten() for c in (0, 1))
                    at, d = closest(matrix(a.field("_x"), len(a)), matrix(b.field("_v"), len(b)), b.field("_o").to_numpy())
                    rows_ = pa.array(at)
                    yield pa.RecordBatch.from_arrays([a.field("_k"), pa.array(d), b.field("_o").take(rows_), b.field("_l").take(rows_)], names=["_k", "d", "o", "l"])

        pairs = tests.crossJoin(dealt(t, "_o", -(-rows // BLOCK_ROWS)))
        best = pairs.mapInArrow(meet, schema).groupBy("_k").agg(F.min(F.struct("d", "o", "l")).alias("_m"))
    return best.select(F.col("_k").alias(key), F.col("_m.l").alias(out), F.col("_m.d").alias("distance"))


def accuracy(predicted: Column, truth: Column) -> Column:
    return F.avg((predicted == truth).cast("double"))


def standardise(df: DataFrame, key: str, values: list[str], train: Column) -> DataFrame:
    """Each channel less the training rows' mean, over their population deviation plus 1e-9.  One row of statistics is broadcast."""
    stats = df.where(train).agg(*(F.avg(c).alias(f"_m_{c}") for c in values), *((F.stddev_pop(c) + F.lit(1e-9)).alias(f"_s_{c}") for c in values))
    own = [c for c in df.columns if c not in values]
    return df.crossJoin(F.broadcast(stats)).select(*own, *(((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).alias(c) for c in values))


def mean_vector(df: DataFrame, key: list[str], vector: str, out: str = "vector") -> DataFrame:
    """Each key's mean vector at unit length; keys without vectors have no row."""
    each = df.where(F.col(vector).isNotNull()).select(*key, F.posexplode(vector).alias("_p", "_v")).groupBy(*key, "_p").agg(F.avg(F.col("_v").cast("double")).alias("_v"))
    return each.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_p", "_v"))).alias("_a")).select(*key, vectors.unit(F.transform("_a", lambda s: s["_v"])).alias(out))


def median_vector(df: DataFrame, key: list[str], vector: str, out: str = "vector") -> DataFrame:
    """Each key's element-wise median."""
    each = df.where(F.col(vector).isNotNull()).select(*key, F.posexplode(vector).alias("_p", "_v")).groupBy(*key, "_p").agg(F.median(F.col("_v").cast("double")).alias("_v"))
    return each.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_p", "_v"))).alias("_a")).select(*key, F.transform("_a", lambda s: s["_v"]).alias(out))


def tensor(df: DataFrame, key: str, grid: str, channels: list[str], points: list[float]) -> DataFrame:
    """Long rows to one array per channel, in grid order; gaps are filled along the grid both ways, 0.0 with at most one value."""
    keys = df.select(key).distinct()
    whole = keys.select(key, F.posexplode(F.array(*(F.lit(float(p)) for p in points))).alias("_g", grid))
    out = whole.join(df.select(key, grid, *channels), [key, grid], "left")
    for c in channels:
        out = gap_fill(out, [key], "_g", c, None, "hold", f"_f_{c}")
    many = lambda c: F.count(c).over(Window.partitionBy(key)) > 1
    out = out.select(key, "_g", *(F.when(many(c), F.col(f"_f_{c}")).otherwise(F.lit(0.0)).alias(c) for c in channels))
    rows = out.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_g", *channels))).alias("_a"))
    return rows.select(key, *(_channel(c) for c in channels))


def _channel(name: str) -> Column:
    return F.transform("_a", lambda s: s[name]).alias(name)


def pivot_grid(df: DataFrame, key: str, grid: str, value: str, points: list) -> DataFrame:
    """Long to wide; the points are given, so that no pass looks for them."""
    return df.groupBy(key).pivot(grid, points).agg(F.first(value, ignorenulls=True))


def logistic(train: DataFrame, features: list[str], label: str, c: float = 0.1, max_iter: int = 2000):
    """Standardised multinomial logistic regression; ``c`` is the inverse strength of the penalty summed over rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler

    n = train.count()
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"),
            VectorAssembler(inputCols=features, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True),
            LogisticRegression(featuresCol="_features", labelCol="_label", regParam=1.0 / (c * max(1, n)), maxIter=max_iter, standardization=False, family="multinomial"),
        ]
    ).fit(train)
