"""Ordered tag arrays: data-quality flags and alert reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_array(rules: list[tuple[str, Column]]) -> Column:
    """Names of the rules that hold, in the order given; a NULL condition does not hold."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules]))


def _outside(column: str, low: int, high: int) -> Column:
    return ~F.col(column).between(low, high)


def wifi_quality_flags(randomized: Column) -> Column:
    return tag_array(
        [
            ("MISSING_RSSI", F.isnull("rssi_dbm")),
            ("MISSING_BSSID", F.isnull("bssid")),
            ("MISSING_SSID", F.isnull("ssid")),
            ("MISSING_CHANNEL", F.isnull("channel")),
            ("NO_GEOLOCATION", F.isnull("latitude")),
            ("RSSI_OUT_OF_RANGE", _outside("rssi_dbm", -100, 0)),
            ("LOW_CONFIDENCE", F.col("confidence") < 0.5),
            ("RANDOMIZED_MAC", randomized),
        ]
    )


def bt_quality_flags(randomized: Column, subtype: Column) -> Column:
    return tag_array(
        [
            ("MISSING_RSSI", F.isnull("rssi_dbm")),
            ("MISSING_DEVICE_ADDRESS", F.isnull("device_address")),
            ("UNKNOWN_PROTOCOL", subtype == "UNKNOWN"),
            ("NO_GEOLOCATION", F.isnull("latitude")),
            ("RANDOMIZED_ADDRESS", randomized),
            ("RSSI_OUT_OF_RANGE", _outside("rssi_dbm", -110, 20)),
            ("LOW_CONFIDENCE", F.col("confidence") < 0.5),
        ]
    )


def is_randomized(flags: str = "dq_flags") -> Column:
    """Whether a quality-flag array marks the identifier as randomised, on either protocol."""
    return F.arrays_overlap(flags, F.array(F.lit("RANDOMIZED_MAC"), F.lit("RANDOMIZED_ADDRESS")))


def alert_reasons() -> Column:
    """Why a timeline row within alert range is worth attention."""
    rssi = F.col("rssi_dbm")
    return tag_array(
        [
            ("VERY_CLOSE_PROXIMITY", rssi >= -50),
            ("CLOSE_PROXIMITY", rssi.between(-65, -51)),
            ("RANDOMIZED_IDENTIFIER", is_randomized()),
            ("HIDDEN_NETWORK", F.array_contains("dq_flags", "MISSING_SSID")),
            ("WITHIN_10M", F.col("distance_est_m") < 10.0),
        ]
    )
