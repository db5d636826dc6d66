"""Duplicate removal: within a watermark on streams, exact on batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedup_stream(df: DataFrame, delay: str, key: str = "event_id", time: str = "event_time") -> DataFrame:
    """Keep the first arrival of each key; state is evicted once the watermark passes."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def _tie_break(df: DataFrame) -> Column:
    comparable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*comparable)


def dedup_batch(
    df: DataFrame, key: str = "event_id", order: tuple[str, ...] = ("ingest_time", "source_path")
) -> DataFrame:
    """Keep the earliest ingested row of each key.

    ``row_number() = 1`` lets Spark prune to one row per key inside every map task before the shuffle,
    so a key repeated without bound never gathers in one reducer.
    """
    earliest = Window.partitionBy(key).orderBy(*order, _tie_break(df))
    return df.withColumn("_copy", F.row_number().over(earliest)).filter("_copy = 1").drop("_copy")


def dedup(df: DataFrame, delay: str, time: str = "event_time") -> DataFrame:
    """The streaming form on a stream, the exact form on a batch."""
    return dedup_stream(df, delay, time=time) if df.isStreaming else dedup_batch(df)


def first_per_window(
    df: DataFrame, column: str = "device_address", seconds: int = 10, time: str = "event_time"
) -> DataFrame:
    """First advertisement of each address on a sensor within each scan window.

    On a stream, arrival order decides; on a batch, event time then event id.
    """
    scan = df.withColumns(
        {
            "_address": F.lower(column),
            "scan_start": F.window(time, f"{seconds} seconds")["start"],
        }
    )
    keys = ["sensor_id", "_address", "scan_start"]
    if df.isStreaming:
        first = scan.withWatermark(time, f"{seconds} seconds").dropDuplicatesWithinWatermark(keys)
        return first.drop("_address")
    order = Window.partitionBy(*keys).orderBy(time, "event_id")
    numbered = scan.withColumn("_seen", F.row_number().over(order))
    return numbered.filter("_seen = 1").drop("_seen", "_address")
