"""Landing rows to bronze: id, ingest stamps, age filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rfsight.config import Settings
from rfsight.contracts import conform
from rfsight.functions.identity import event_key
from rfsight.operators.expectations import BRONZE


def day_of(timestamp: str | Column) -> Column:
    """Partition key: the UTC day as text, whatever the session's time zone."""
    days = F.floor(F.unix_micros(timestamp) / F.lit(86_400_000_000)).cast("int")
    return F.date_from_unix_date(days).cast("string")


def with_event_id(df: DataFrame, protocol: str) -> DataFrame:
    return df.withColumn("event_id", event_key(protocol))


def with_ingest_metadata(df: DataFrame, settings: Settings, source: Column | None = None) -> DataFrame:
    """Stamp ingest time, event day, source file and run id. ``source`` defaults to the file path."""
    return df.withColumns(
        {
            "ingest_time": settings.now,
            "event_date": day_of("event_time"),
            "source_path": F.col("_metadata.file_path") if source is None else source,
            "pipeline_id": F.lit(settings.run_id),
        }
    )


def drop_late(df: DataFrame, settings: Settings) -> DataFrame:
    """Keep rows no older than the bronze horizon. Rows without an event time go too."""
    horizon = settings.now - F.expr(f"INTERVAL {settings.bronze_late_days} DAYS")
    return df.filter(F.col("event_time") >= horizon)


def to_bronze(stamped: DataFrame, protocol: str, settings: Settings, observation=None) -> DataFrame:
    """Age filter and bronze expectations over rows that already carry id and stamps."""
    kept = BRONZE[protocol].enforce(drop_late(stamped, settings), settings, observation)
    return conform(kept, f"{protocol}_bronze")


def to_quarantine(stamped: DataFrame, protocol: str, settings: Settings) -> DataFrame:
    """A copy (not a diversion) of every row with rescued data, dated by its ingest day."""
    bad = stamped.filter(F.col("_rescued_data").isNotNull()).withColumn(
        "event_date", day_of("ingest_time")
    )
    return conform(bad, f"{protocol}_quarantine")
