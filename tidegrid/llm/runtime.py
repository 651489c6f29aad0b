"""Session helpers that the corpus operators share."""

from __future__ import annotations

import sys
import tempfile
import uuid
import zlib

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows and bytes of an Arrow batch, in place of Spark's defaults: texts are long rows, and a batch is held several times over.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def prepare(df: DataFrame, *modules: str) -> None:
    """Before Python functions run on texts: smaller Arrow batches, unless the session has a setting of its own, and the
    modules' functions go to executors by value, so that executors need not have the package installed."""
    conf = df.sparkSession.conf
    for key, (default, ours) in BATCH.items():
        if conf.get(key, default) == default:
            conf.set(key, ours)
    for name in modules:
        cloudpickle.register_pickle_by_value(sys.modules[name])


def _checkpoints(spark: SparkSession) -> str:
    """The folder for checkpoints: the one in ``spark.checkpoint.dir``, which all executors share.

    Only where that setting is absent on one machine (tests) a temporary folder is set; on a cluster without it this is an error."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint"))
    return context._jsc.sc().getCheckpointDir().get()


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint."""
    _checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    return f"{_checkpoints(spark)}/tables-{uuid.uuid4().hex}"


def pick(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns: other columns, whatever their names, can't clash with an operator's own."""
    return df.select(*(F.col(f"`{c}`") for c in columns))


BLOCK = 1 << 16


def pack(counts: np.ndarray) -> list[tuple[int, bytes]]:
    """A fixed-size array as compressed blocks."""
    return [(at // BLOCK, zlib.compress(counts[at : at + BLOCK].tobytes(), 1)) for at in range(0, len(counts), BLOCK)]


def add_arrays(parts: DataFrame, size: int, dtype: str) -> np.ndarray:
    """The element-wise sum of arrays of ``size`` elements, given as (block int, salt int, payload binary) rows of ``pack``.

    Two levels of streaming sums: a task holds one running block for each key it has, however many partitions sent one.
    The result has a fixed size, so that it may come to the driver.
    """

    def total(keys):
        def run(batches):
            import pyarrow as pa

            sums = {}
            for batch in batches:
                columns = [batch.column(i).to_pylist() for i in range(3)]
                for block, salt, payload in zip(*columns, strict=True):
                    part = np.frombuffer(zlib.decompress(payload), dtype)
                    key = (block, salt if keys == 2 else 0)
                    if key in sums:
                        sums[key] += part
                    else:
                        sums[key] = part.copy()
            for (block, salt), values in sums.items():
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "salt": pa.array([salt], pa.int32()), "payload": pa.array([zlib.compress(values.tobytes(), 1)], pa.binary())})

        return run

    schema = "block int, salt int, payload binary"
    blocks = (size + BLOCK - 1) // BLOCK
    first = parts.repartition(min(64, 4 * blocks), "block", "salt").mapInArrow(total(2), schema)
    last = first.repartition(blocks, "block").mapInArrow(total(1), schema)
    out = np.zeros(size, dtype)
    for row in last.collect():
        out[row.block * BLOCK : row.block * BLOCK + BLOCK] += np.frombuffer(zlib.decompress(bytes(row.payload)), dtype)
    return out
