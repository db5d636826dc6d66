"""Named row expectations with three actions: warn keeps, drop removes, fail aborts.

A NULL verdict counts as violated. Enforcing adds no pass over the data: counts are observed metrics
collected while the rows flow to the sink.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rfsight.config import Settings

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str  # SQL; {now}, {future_minutes} and {late_drop_days} are filled from the settings
    action: str = WARN

    def predicate(self, settings: Settings) -> Column:
        """The condition as written; a filter on it drops NULL verdicts and can reach the scan."""
        return F.expr(
            self.condition.format(
                now=settings.now_sql,
                future_minutes=settings.future_minutes,
                late_drop_days=settings.late_drop_days,
            )
        )

    def holds(self, settings: Settings) -> Column:
        """The verdict with NULL counted as violated."""
        return F.coalesce(self.predicate(settings), F.lit(False))


@dataclass(frozen=True)
class ExpectationSet:
    table: str
    rules: tuple[Expectation, ...]

    @classmethod
    def of(cls, table: str, rules: Iterable[Expectation]) -> ExpectationSet:
        return cls(table, tuple(rules))

    def metrics(self, settings: Settings) -> list[Column]:
        """Rows seen, and violations per rule, as plain aggregates."""
        return [F.count(F.lit(1)).alias("rows_seen")] + [
            F.count_if(~rule.holds(settings)).alias(rule.name) for rule in self.rules
        ]

    def watch(
        self, df: DataFrame, settings: Settings, observation: Observation | str | None = None
    ) -> DataFrame:
        """Attach the metrics to ``df``; a string name reports through a streaming listener."""
        if observation is None:
            return df
        return df.observe(observation, *self.metrics(settings))

    def enforce(
        self, df: DataFrame, settings: Settings, observation: Observation | str | None = None
    ) -> DataFrame:
        """Observe all rules, then apply the drop and fail rules."""
        out = self.watch(df, settings, observation)
        stops = [r for r in self.rules if r.action == FAIL]
        drops = [r.predicate(settings) for r in self.rules if r.action == DROP]
        for rule in stops:
            message = F.lit(f"{self.table}: expectation {rule.name} violated")
            out = out.filter(
                F.when(rule.holds(settings), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
            )
        return out.filter(reduce(and_, drops)) if drops else out

    def violations(self, df: DataFrame, settings: Settings, column: str = "violations") -> DataFrame:
        """Every row with the names of the rules it breaks; nothing is dropped."""
        broken = [F.when(~r.holds(settings), F.lit(r.name)) for r in self.rules]
        return df.withColumn(column, F.array_compact(F.array(*broken)))

    def report(self, df: DataFrame, settings: Settings) -> DataFrame:
        """One row per rule with passed and failed counts, from a single aggregation pass."""
        totals = df.agg(*self.metrics(settings))
        lines = F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("expectation"),
                    F.lit(r.action).alias("action"),
                    F.col(r.name).alias("failed"),
                )
                for r in self.rules
            ]
        )
        return totals.select(
            F.lit(self.table).alias("table_name"), "rows_seen", F.inline(lines)
        ).select(
            "table_name",
            "expectation",
            "action",
            "failed",
            (F.col("rows_seen") - F.col("failed")).alias("passed"),
        )


# --- fixed values: rule names, thresholds and actions per table --------------------------------
_HAS_SENSOR = "length(sensor_id) > 0"
_HAS_TIME = "event_time IS NOT NULL"
_SILVER_DROPS = [
    Expectation("valid_event_id", "length(event_id) = 64", DROP),
    Expectation("valid_sensor_id", _HAS_SENSOR, DROP),
    Expectation("valid_event_time", _HAS_TIME, DROP),
    Expectation("event_not_ancient", "event_time >= {now} - INTERVAL {late_drop_days} DAYS", DROP),
]
_CONFIDENCE = Expectation("confidence_valid", "confidence IS NULL OR confidence BETWEEN 0 AND 1")
_PAIRED = Expectation("coordinates_paired", "(latitude IS NULL) = (longitude IS NULL)")

_BRONZE_RULES = [
    Expectation("valid_sensor_id", _HAS_SENSOR),
    Expectation("valid_event_time", _HAS_TIME),
    Expectation("event_not_future", "event_time <= {now} + INTERVAL {future_minutes} MINUTES", DROP),
]
BRONZE = {p: ExpectationSet.of(f"{p}_bronze", _BRONZE_RULES) for p in ("wifi", "bt")}
SILVER = {
    "wifi": ExpectationSet.of(
        "wifi_silver",
        [
            *_SILVER_DROPS,
            Expectation("rssi_plausible", "rssi_dbm IS NULL OR rssi_dbm BETWEEN -100 AND 0"),
            _CONFIDENCE,
            _PAIRED,
            Expectation("valid_latitude", "latitude IS NULL OR latitude BETWEEN -90 AND 90"),
            Expectation("valid_longitude", "longitude IS NULL OR longitude BETWEEN -180 AND 180"),
        ],
    ),
    "bt": ExpectationSet.of(
        "bt_silver",
        [
            *_SILVER_DROPS,
            Expectation("rssi_plausible", "rssi_dbm IS NULL OR rssi_dbm BETWEEN -110 AND 20"),
            _CONFIDENCE,
            _PAIRED,
            Expectation("valid_protocol_subtype", "protocol_subtype IN ('BLE', 'BT_CLASSIC', 'UNKNOWN')"),
        ],
    ),
}
TIMELINE = ExpectationSet.of(
    "device_timeline",
    [
        Expectation("valid_event_id", "event_id IS NOT NULL", DROP),
        Expectation("valid_protocol", "protocol IN ('WIFI', 'BLUETOOTH')", DROP),
        Expectation("valid_event_time", _HAS_TIME, DROP),
    ],
)
COPRESENCE = ExpectationSet.of(
    "copresence_events", [Expectation("valid_copresence_id", "copresence_id IS NOT NULL", DROP)]
)
ALERTS = ExpectationSet.of(
    "perimeter_alerts",
    [
        Expectation("valid_alert_id", "alert_id IS NOT NULL", DROP),
        Expectation("has_sensor", "sensor_id IS NOT NULL", DROP),
    ],
)
# ----------------------------------------------------------------------------------------------
