"""Structured Streaming front end: first-seen flags, volumes by day, sessions of a feed's silence."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..plans.session import shared_folder


def distinct_items(items: DataFrame, ts: str, key: str, window: str = "30 days") -> DataFrame:
    """Items whose key did not occur within ``window``: repeats are dropped, state expires with the watermark."""
    return items.withWatermark(ts, window).dropDuplicatesWithinWatermark([key])


def flag_repeats(items: DataFrame, ts: str, key: str, id_col: str, days: int = 30) -> DataFrame:
    """Every item, with the day its key was first seen and whether that makes it a repeat: flagged, not dropped.

    State is one first time per key and is forgotten ``days`` after it by event time. Within a batch order is by time.
    """
    keep_us = days * 86_400_000_000
    key_type, id_type = items.schema[key].dataType.simpleString(), items.schema[id_col].dataType.simpleString()

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values([ts, id_col])
        first = state.get[0] if state.exists else None
        out = []
        for at, i in zip(rows[ts], rows[id_col], strict=True):
            now = at.value // 1000
            if first is not None and now - first > keep_us:
                first = None
            repeat = first is not None
            first = now if first is None else first
            out.append((k[0], i, pd.Timestamp(first, unit="us"), repeat))
        state.update((first,))
        end_ms = (first + keep_us) // 1000
        if end_ms > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(end_ms)
        yield pd.DataFrame(out, columns=[key, id_col, "first_seen", "is_repeat"])

    stamped = items.select(key, id_col, F.col(ts).cast("timestamp").alias(ts)).withWatermark(ts, "1 day")
    return stamped.groupBy(key).applyInPandasWithState(update, f"{key} {key_type}, {id_col} {id_type}, first_seen timestamp, is_repeat boolean", "first long", "append", GroupStateTimeout.EventTimeTimeout)


def daily_volume(items: DataFrame, ts: str, by: list[str], delay: str = "2 days") -> DataFrame:
    return items.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("day"), *by, "n")


def sliding_volume(items: DataFrame, ts: str, by: list[str], delay: str = "2 days") -> DataFrame:
    """Counts over seven days, every day."""
    return items.withWatermark(ts, delay).groupBy(F.window(ts, "7 days", "1 day").alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("from_day"), *by, "n")


def sessions(items: DataFrame, ts: str, by: list[str], gap: str = "6 hours", delay: str = "1 day") -> DataFrame:
    """Spells of activity that ``gap`` of silence ends."""
    return items.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("from_ts"), F.col("w.end").alias("to_ts"), *by, "n")


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a bounded stream to its end and read what it gave.

    Every batch is written by the executors to a folder of its own under ``spark.checkpoint.dir``, next to the query's own
    checkpoint; a batch that is run again replaces its folder. In complete mode the last batch counts.
    """
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/{'last' if mode == 'complete' else f'batch={number}'}")

    spark.createDataFrame([], stream.schema).write.parquet(f"{folder}/rows/none")  # so that a stream without rows can be read
    stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows/*")
