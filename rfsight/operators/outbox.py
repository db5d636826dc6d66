"""The upload queue of a sensor as a table (id, protocol, created_at, uploaded_at), and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rfsight.config import Settings

# --- fixed values: days a table is kept --------------------------------------------------------
RETENTION_DAYS = {
    "wifi_bronze": 90,
    "bt_bronze": 90,
    "wifi_silver": 365,
    "bt_silver": 365,
    "device_timeline": 365,
    "perimeter_alerts": 730,
}
# ----------------------------------------------------------------------------------------------


def backlog_stats(outbox: DataFrame) -> DataFrame:
    """Pending and uploaded records per protocol."""
    return outbox.groupBy("protocol").agg(
        F.count_if(F.col("uploaded_at").isNull()).alias("pending"),
        F.count_if(F.col("uploaded_at").isNotNull()).alias("uploaded"),
    )


def next_batch(outbox: DataFrame, k: int = 500) -> DataFrame:
    """The ``k`` oldest pending records of each protocol.

    Ranks up to ``k`` are pruned inside each task before the shuffle.
    """
    oldest = Window.partitionBy("protocol").orderBy("id")
    pending = outbox.filter(F.col("uploaded_at").isNull())
    return pending.withColumn("position", F.row_number().over(oldest)).filter(F.col("position") <= k)


def purge_uploaded(outbox: DataFrame, settings: Settings, retain_days: int = 3) -> DataFrame:
    """Records left after removing those uploaded and created before the horizon."""
    horizon = settings.now - F.expr(f"INTERVAL {retain_days} DAYS")
    gone = F.col("uploaded_at").isNotNull() & (F.col("created_at") < horizon)
    return outbox.filter(~F.coalesce(gone, F.lit(False)))


def retain_table(rows: DataFrame, name: str, settings: Settings) -> DataFrame:
    """Rows of a named table within its own retention."""
    return retain(rows, settings, RETENTION_DAYS[name])


def retain(table: DataFrame, settings: Settings, days: int) -> DataFrame:
    """Rows of the last ``days`` days. The bound is text on the partition column, so old days are
    pruned from the listing and never read."""
    first_day = F.date_sub(F.to_date(settings.now), days).cast("string")
    return table.filter(F.col("event_date") >= first_day)
