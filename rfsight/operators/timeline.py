"""One device timeline over both protocols, and the alerts scored from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rfsight.config import Settings
from rfsight.contracts import conform, project
from rfsight.functions import tags
from rfsight.functions.identity import digest
from rfsight.operators.expectations import ALERTS, TIMELINE


def timeline_rows(wifi_silver: DataFrame, bt_silver: DataFrame) -> DataFrame:
    """UNION ALL of both silver tables, before any rule: no shuffle, and no deduplication across protocols."""
    nothing = F.lit(None).cast("string")
    wifi = project(
        wifi_silver,
        "device_timeline",
        {
            "protocol": F.lit("WIFI"),
            "device_id_hash": F.col("bssid_hash"),
            "device_name": nothing,
            "protocol_detail": F.concat_ws("/", "band", "encryption"),
        },
    )
    bt = project(
        bt_silver,
        "device_timeline",
        {
            "protocol": F.lit("BLUETOOTH"),
            "device_id_hash": F.col("device_address_hash"),
            "ssid": nothing,
            "protocol_detail": F.col("protocol_subtype"),
        },
    )
    return wifi.unionByName(bt)


def device_timeline(
    wifi_silver: DataFrame, bt_silver: DataFrame, settings: Settings, observation=None
) -> DataFrame:
    return TIMELINE.enforce(timeline_rows(wifi_silver, bt_silver), settings, observation)


def alert_candidates(timeline: DataFrame, settings: Settings) -> DataFrame:
    """Strong and confident rows. Plain column bounds, so they reach the Parquet scan."""
    near = timeline.filter(F.col("rssi_dbm") >= settings.alert_rssi_dbm).filter(
        F.col("confidence") >= settings.alert_min_confidence
    )
    if settings.proximity_m is not None:
        near = near.filter(F.col("distance_est_m") <= settings.proximity_m)
    return near


def threat_score(settings: Settings) -> Column:
    """Proximity x confidence x number of reasons, each capped at one."""
    above = (F.col("rssi_dbm") - settings.alert_rssi_dbm).cast("double")
    proximity = F.least(F.lit(1.0), F.lit(0.3) + above / F.lit(45.0) * F.lit(0.7))
    certainty = F.coalesce(F.col("confidence"), F.lit(0.5))
    weight = F.least(F.lit(1.0), F.lit(0.7) + F.size("alert_reasons") * F.lit(0.1))
    return F.round(proximity * certainty * weight, 3)


def alert_rows(timeline: DataFrame, settings: Settings) -> DataFrame:
    """Scored alerts before any rule."""
    reasoned = alert_candidates(timeline, settings).withColumn("alert_reasons", tags.alert_reasons())
    return reasoned.filter(F.size("alert_reasons") > 0).withColumns(
        {
            "threat_score": threat_score(settings),
            "alert_id": digest("event_id", F.lit("ALERT")),
            "ingest_time": settings.now,
        }
    )


def perimeter_alerts(timeline: DataFrame, settings: Settings, observation=None) -> DataFrame:
    return conform(ALERTS.enforce(alert_rows(timeline, settings), settings, observation), "perimeter_alerts")


def high_threat(alerts: DataFrame, above: float = 0.9) -> DataFrame:
    return alerts.filter(F.col("threat_score") > above)
