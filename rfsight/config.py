"""Run settings: one frozen object handed to every operator that needs a parameter."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

CONF_PREFIX = "rfsight."


@dataclass(frozen=True)
class Settings:
    """Parameters of a run.

    ``salt`` has no default on purpose: a guessable salt makes every identifier hash reversible.
    ``as_of`` replaces the wall clock (ISO-8601 with an offset) so that a batch run is repeatable;
    leave it unset on a live stream.
    """

    salt: str
    bt_salt: str | None = None
    as_of: str | None = None
    run_id: str = "unknown"
    wifi_watermark: str = "2 hours"
    bt_watermark: str = "1 hour"
    join_watermark: str = "2 hours"
    bronze_late_days: int = 7
    late_drop_days: int = 7
    future_minutes: int = 5
    copresence_seconds: int = 30
    alert_rssi_dbm: int = -65
    alert_min_confidence: float = 0.7
    proximity_m: float | None = None

    def __post_init__(self) -> None:
        if not self.salt:
            raise ValueError("Settings.salt is required: identifiers are never hashed without a salt")

    @classmethod
    def from_conf(cls, spark: SparkSession, **overrides) -> Settings:
        """Read ``rfsight.<field>`` from the session configuration; keyword arguments win."""
        values = {}
        for field in fields(cls):
            raw = spark.conf.get(CONF_PREFIX + field.name, None)
            if raw is not None:
                convert = {"int": int, "float": float, "float | None": float}.get(str(field.type), str)
                values[field.name] = convert(raw)
        values.update(overrides)
        values.setdefault("salt", "")
        return cls(**values)

    def salt_for(self, protocol: str) -> str:
        """A separate Bluetooth salt keeps one address from being linkable across protocols."""
        return self.bt_salt if protocol == "bt" and self.bt_salt else self.salt

    def watermark_for(self, protocol: str) -> str:
        return self.wifi_watermark if protocol == "wifi" else self.bt_watermark

    @property
    def now_sql(self) -> str:
        return f"TIMESTAMP '{self.as_of}'" if self.as_of else "current_timestamp()"

    @property
    def now(self) -> Column:
        return F.expr(self.now_sql)


def pin_session(spark: SparkSession) -> SparkSession:
    """Session options the results depend on (UTC dates) and the runtime re-planning we rely on.

    HotSpot never compiles a method over 8000 bytes of bytecode, and the wide projections here make such methods as one
    stage: these would be interpreted row by row, so they run as operators of their own, whose code Spark splits.
    """
    for key, value in {
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
