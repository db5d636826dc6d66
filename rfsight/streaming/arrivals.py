"""Landing files to bronze, quarantine and late rows, from one parse of each micro-batch.

A micro-batch is parsed once and kept while it is written to its sinks, each in a folder of the batch's number. A
folder that is complete is never written again, so a batch that is run again after a failure changes nothing.

Lateness is settled here, once: the latest event time before a batch is noted by batch number, and a row that is older
than this by the watermark's delay, or more, goes to the late table. What is not late carries ``released_at``, the
latest event time up to its batch. Batches come in that order whatever their rows are, so a deduplication that keeps
time by it drops no row, however its own micro-batches are cut, and keeps each id as long as a copy can still be in
time. So kept and late rows together are what has arrived.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rfsight.config import Settings
from rfsight.contracts import PARTITIONS, contract
from rfsight.operators import expectations
from rfsight.operators.bronze import day_of, to_bronze, to_quarantine
from rfsight.operators.silver import to_silver
from rfsight.sources.days import Days, Snapshot
from rfsight.sources.landing import read_landing
from rfsight.sources.tables import Layout, boundary, exists, stream_table
from rfsight.streaming.flows import recent_history, state_settings
from rfsight.streaming.metrics import append_log, finish

#: Where a late row is stopped: by age at bronze, by the watermark, or by age at silver.
AT_BRONZE, AT_WATERMARK, AT_SILVER = "bronze", "watermark", "silver"


def late_layer(settings: Settings, watermark: Column | None) -> Column:
    """The first policy that stops a row for its age; null for a row in time, and for one without a time."""
    when = F.col("event_time")
    layer = F.when(when < settings.now - F.expr(f"INTERVAL {settings.bronze_late_days} DAYS"), AT_BRONZE)
    if watermark is not None:
        layer = layer.when(when <= watermark, AT_WATERMARK)
    return layer.when(when < settings.now - F.expr(f"INTERVAL {settings.late_drop_days} DAYS"), AT_SILVER)


@dataclass(frozen=True)
class Arrivals:
    """The sinks of one protocol."""

    spark: SparkSession
    layout: Layout
    protocol: str
    settings: Settings

    @property
    def clock(self) -> Days:
        """The latest event time after each batch, as the cut of snapshots without days."""
        return Days(self.spark, f"{self.layout.base}/clock/{self.protocol}")

    def folder(self, kind: str, batch_id: int) -> str:
        return f"{self.layout.table(f'{self.protocol}_{kind}')}/batch_id={batch_id}"

    def _put(self, rows: DataFrame, kind: str, batch_id: int, *more: str) -> None:
        path = self.folder(kind, batch_id)
        if not exists(self.spark, f"{path}/_SUCCESS"):
            keys = [*more, *PARTITIONS[f"{self.protocol}_{kind}"]]
            rows.hint("rebalance", *[F.col(k) for k in keys]).write.mode("overwrite").partitionBy(*keys).parquet(path)

    def store(self, batch: DataFrame, batch_id: int) -> None:
        kinds = ("bronze", "quarantine", "late")
        if all(exists(self.spark, f"{self.folder(kind, batch_id)}/_SUCCESS") for kind in kinds):
            return
        name, before = f"{self.protocol}_bronze", self.clock.snapshot(before=batch_id)
        delay = F.expr(f"INTERVAL {self.settings.watermark_for(self.protocol)}")
        watermark = F.timestamp_micros(F.lit(before.cut)) - delay if before.versions else None
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = Observation(name)
            bronze = to_bronze(rows, self.protocol, self.settings, seen)
            latest = bronze.agg(F.max(F.unix_micros("event_time"))).first()[0]
            times = [t for t in (latest, before.cut if before.versions else None) if t is not None]
            if times:
                self.clock.publish(Snapshot(batch_id, {"latest": ()}, max(times)), "overwrite")
            released = F.timestamp_micros(F.lit(max(times))) if times else F.lit(None).cast("timestamp")
            layer = late_layer(self.settings, watermark)
            bronze = to_bronze(rows, self.protocol, self.settings).withColumn("released_at", released)
            self._put(bronze.withColumn("timely", ~layer.eqNullSafe(AT_WATERMARK)), "bronze", batch_id, "timely")
            self._put(to_quarantine(rows, self.protocol, self.settings), "quarantine", batch_id)
            late = rows.withColumn("event_date", day_of("event_time")).withColumn("layer", layer).filter("layer IS NOT NULL")
            self._put(late.select(*contract(f"{self.protocol}_late").fieldNames()), "late", batch_id)
            report = {"observedMetrics": {name: seen.get}, "runId": self.settings.run_id, "batchId": batch_id}
            append_log(self.spark, self.layout, [report], expectations.BRONZE[self.protocol], name)
        finally:
            rows.unpersist()


def run_arrivals(spark: SparkSession, layout: Layout, protocol: str, settings: Settings, **options) -> None:
    """Take the landing files that have arrived; in the place of ``flows.run_bronze``."""
    since = boundary(spark, layout).get(protocol)
    landed = read_landing(spark, layout.landing(protocol), protocol, settings, streaming=True, since=since, **options)
    name = f"{protocol}_arrivals"
    finish(
        landed.writeStream.queryName(name)
        .option("checkpointLocation", layout.checkpoint(name))
        .trigger(availableNow=True)
        .foreachBatch(Arrivals(spark, layout, protocol, settings).store)
        .start()
    )


def timely(spark: SparkSession, layout: Layout, protocol: str, **options) -> DataFrame:
    """Bronze rows that are in time, as a stream, with ``released_at``."""
    name = f"{protocol}_bronze"
    more = [T.StructField("released_at", T.TimestampType()), T.StructField("timely", T.BooleanType())]
    schema = T.StructType([*contract(name).fields, *more])
    rows = spark.readStream.options(**options).schema(schema).parquet(layout.table(name))
    return rows.filter("timely").select(*contract(name).fieldNames(), "released_at")


def run_timely_silver(
    spark: SparkSession, layout: Layout, protocol: str, settings: Settings, partitions: int | None = None, **options
) -> None:
    """Bronze rows in time to silver; in the place of ``flows.run_silver``. No row is dropped for its age but by the
    silver rule, which counts it. Ids that no copy in time can have any more stay until the next trigger's rows come:
    such a copy goes to the late table, so holding them changes no row, and a sweep would visit the whole state again."""
    name = f"{protocol}_silver"
    with state_settings(spark, partitions, sweep=False):
        rows = timely(spark, layout, protocol, **options)
        known = recent_history(spark, layout, f"{protocol}_bronze", settings)
        silver = to_silver(rows, protocol, settings, name, known, clock="released_at")
        reports = finish(stream_table(silver, layout, name))
    append_log(spark, layout, reports, expectations.SILVER[protocol], name)
