"""Data-quality and operations reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rfsight.config import Settings
from rfsight.operators.bronze import day_of
from rfsight.operators.expectations import ExpectationSet


def dq_failure_rate(
    checks: list[tuple[ExpectationSet, DataFrame]], settings: Settings
) -> DataFrame:
    """Failed, passed and failure percentage per table and expectation, worst first."""
    lines = reduce(DataFrame.unionByName, [rules.report(df, settings) for rules, df in checks])
    return failure_pct(lines)


def failure_pct(metrics: DataFrame) -> DataFrame:
    """Sum (table_name, expectation, action, failed, passed) lines, such as those logged by a stream."""
    totals = metrics.groupBy("table_name", "expectation", "action").agg(
        F.sum("failed").alias("failed_records"), F.sum("passed").alias("passed_records")
    )
    share = F.try_divide(
        F.col("failed_records") * F.lit(100.0), F.col("failed_records") + F.col("passed_records")
    )
    return totals.withColumn("failure_pct", F.round(share, 2)).orderBy(
        F.desc("failure_pct"), "table_name", "expectation"
    )


def quarantine_counts(quarantine: DataFrame, alert_above: int = 100) -> DataFrame:
    """Quarantined rows per ingest day and hour, flagged above ``alert_above`` an hour."""
    hourly = quarantine.groupBy("event_date", F.date_trunc("hour", "ingest_time").alias("ingest_hour"))
    return hourly.agg(F.count(F.lit(1)).alias("quarantine_count")).withColumn(
        "alert", F.col("quarantine_count") > alert_above
    )


def quarantine_ratio(
    quarantine: DataFrame, bronze: DataFrame, alert_pct: float = 1.0, slo_pct: float = 0.5
) -> DataFrame:
    """Quarantined share of bronze volume per ingest day."""
    held = quarantine.groupBy("event_date").agg(F.count(F.lit(1)).alias("quarantined"))
    total = bronze.groupBy(day_of("ingest_time").alias("event_date")).agg(F.count(F.lit(1)).alias("bronze_rows"))
    both = total.join(held, "event_date", "full")
    pct = F.try_divide(F.col("quarantined") * F.lit(100.0), F.col("bronze_rows"))
    return (
        both.select(
            "event_date",
            *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("bronze_rows", "quarantined")],
        )
        .withColumn("ratio_pct", F.round(pct, 3))
        .withColumns(
            {"alert": F.col("ratio_pct") > alert_pct, "within_slo": F.col("ratio_pct") < slo_pct}
        )
    )


def ingest_lag(bronze: DataFrame, alert_minutes: int = 15) -> DataFrame:
    """Event-to-ingest lag per sensor in whole seconds: rows, maximum, exact 95th percentile.

    Rows are first counted per (sensor, second of lag); the percentile is taken over that histogram,
    whose size follows the range of lags and not the number of rows.
    """
    lag = F.expr("(unix_micros(ingest_time) - unix_micros(event_time)) div 1000000")
    histogram = bronze.groupBy("sensor_id", lag.alias("lag")).agg(F.count(F.lit(1)).alias("n"))
    per_sensor = histogram.groupBy("sensor_id").agg(
        F.sum("n").alias("row_count"),
        F.max("lag").alias("max_lag_seconds"),
        F.round(F.percentile("lag", F.lit(0.95), F.col("n")), 3).alias("p95_lag_seconds"),
    )
    return per_sensor.withColumn("alert", F.col("max_lag_seconds") > alert_minutes * 60)


def row_count_drift(table: DataFrame, limit_pct: float = 20.0, by: str = "event_date") -> DataFrame:
    """Rows per day against the previous day present, flagged beyond ``limit_pct`` either way."""
    daily = table.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"))
    # One row per day: the single partition holds as many rows as there are days.
    before = F.lag("row_count").over(Window.orderBy(by))
    drift = (F.col("row_count") - F.col("previous_count")) * F.lit(100.0) / F.col("previous_count")
    return (
        daily.withColumn("previous_count", before)
        .withColumn("drift_pct", F.round(drift, 2))
        .withColumn("alert", F.abs("drift_pct") > limit_pct)
    )


def sensor_health(bronze: DataFrame) -> DataFrame:
    """Rows, last seen, missing-value shares and clock skew per sensor and day.

    Skew is the largest lead of event time over ingest time, in seconds; zero when no clock runs ahead.
    """
    rows = F.count(F.lit(1))

    def missing(column: str):
        share = F.count_if(F.col(column).isNull()) / rows
        return F.round(share, 4).alias(f"{column}_null_rate")

    lead = F.unix_micros("event_time") - F.unix_micros("ingest_time")
    return bronze.groupBy("sensor_id", "event_date").agg(
        rows.alias("row_count"),
        F.max("event_time").alias("last_seen"),
        missing("rssi_dbm"),
        missing("latitude"),
        missing("confidence"),
        (F.greatest(F.max(lead), F.lit(0)) / F.lit(1_000_000)).alias("clock_skew_seconds"),
    )


def dq_flag_histogram(timeline: DataFrame) -> DataFrame:
    """Rows per quality flag, protocol and day."""
    flags = timeline.select("protocol", "event_date", F.explode("dq_flags").alias("dq_flag"))
    return flags.groupBy("protocol", "event_date", "dq_flag").agg(F.count(F.lit(1)).alias("row_count"))
