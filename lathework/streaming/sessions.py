"""Streams of session events: sessions by the half-hour gap, repeats, latest run, open sessions.

All take a streaming or a batch DataFrame with an event time and give the same rows for either, up to late events.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

GAP = "30 minutes"


def timed(events: DataFrame, ts: str, late: str) -> DataFrame:
    """events with a watermark; streams need an event time with a zone."""
    if events.isStreaming and isinstance(events.schema[ts].dataType, T.TimestampNTZType):
        events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return events.withWatermark(ts, late)


def sessionized(events: DataFrame, by: str = "user_id", ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """(by, start, end, n): sessions that a gap over half an hour ends."""
    windowed = timed(events, ts, late).groupBy(F.col(by), F.session_window(ts, GAP).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return windowed.select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def hourly_errors(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """(hour, event_type, n): tumbling counts."""
    windowed = timed(events, "ts", late).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return windowed.select(F.col("w.start").alias("hour"), "event_type", "n")


def without_repeats(events: DataFrame, key: str = "event_id", ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """The first row of every key within the watermark."""
    return timed(events, ts, late).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])


def upsert_latest(path: str, key: str, order: str):
    """For foreachBatch: keeps the row of the largest order for every key in a table of generations at `path`."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if number > 0:
            rows = rows.unionByName(spark.read.parquet(f"{path}/generation={number - 1}"))
        rest = [c for c in batch.columns if c not in (key, order)]
        newest = rows.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("r")).select(key, "r.*")
        newest.write.mode("overwrite").parquet(f"{path}/generation={number}")

    return run


def _count_tools(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        n, errors = state.get
        state.remove()
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "errors": [errors]})
        return
    n, errors = state.get if state.exists else (0, 0)
    newest = None
    for b in batches:
        n += len(b)
        errors += int((b["event_type"] == "error").sum())
        newest = b["ts"].max() if newest is None else max(newest, b["ts"].max())
    state.update((n, errors))
    state.setTimeoutTimestamp(int(newest.timestamp() * 1000) + 30 * 60 * 1000)


def closed_sessions(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """(user_id, n, errors) when a user has been silent for half an hour of event time; state is two counters a user."""
    return timed(events, "ts", late).groupBy("user_id").applyInPandasWithState(_count_tools, "user_id long, n long, errors long", "n long, errors long", "append", GroupStateTimeout.EventTimeTimeout)
