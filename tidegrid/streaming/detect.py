"""The same operators over streams: sessions, duplicates at seams, and run detection with state.

All take a streaming (or batch) DataFrame and an event-time column; state is bounded by the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidegrid.operators import kernels, ship
from tidegrid.operators.kernels import streaks


def sessions(events: DataFrame, key: str, ts: str, gap: str = "30 seconds", late: str = "1 minute") -> DataFrame:
    """Stretches of events without a gap, with their size: the coarse run detector."""
    marked = events.withWatermark(ts, late) if events.isStreaming else events
    out = marked.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def tumbling(events: DataFrame, key: str, ts: str, value: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    marked = events.withWatermark(ts, late) if events.isStreaming else events
    out = marked.groupBy(F.window(ts, width).alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(key, F.col("w.start").alias("start"), "n", "total")


def without_repeats(events: DataFrame, keys: list[str], ts: str, late: str = "10 minutes") -> DataFrame:
    """The first of repeated events within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def detect(readings: DataFrame, keys: list[str], ts: str, t: str, value: str, late: str = "5 seconds", quiet_ms: int = 5000) -> DataFrame:
    """Runs in a stream of clock readings: a key's readings are kept until it has been quiet, then scanned as the batch operator does.

    State is one stretch of readings per key, which the quiet period bounds."""
    ship.by_value(__name__, kernels.__name__)
    names = [*keys, "t_origin", "final", "t_last"]
    schema = ", ".join(f"{k} {readings.schema[k].dataType.simpleString()}" for k in keys) + ", t_origin double, final double, t_last double"

    def scan(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = [list(x) for x in state.get] if state.exists else [[], []]
        if not state.hasTimedOut:
            for rows in parts:
                rows = rows[rows[value].notna()]
                kept[0] += rows[t].tolist()
                kept[1] += rows[value].tolist()
            state.update((kept[0], kept[1]))
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), 0) + quiet_ms)
            return
        order = np.argsort(kept[0], kind="stable")
        found = streaks(np.array(kept[0], float)[order], np.array(kept[1], float)[order])
        state.remove()
        if found:
            out = pd.DataFrame(found)[["t_origin", "final", "t_last"]]
            for k, v in reversed(list(zip(keys, key, strict=True))):
                out.insert(0, k, v)
            yield out[names]

    marked = readings.withWatermark(ts, late)
    return marked.groupBy(*keys).applyInPandasWithState(scan, schema, "t array<double>, v array<double>", "append", GroupStateTimeout.EventTimeTimeout)
