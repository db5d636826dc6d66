"""Parquet tables in one root folder: layout, readers, writers, compaction."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rfsight.contracts import PARTITIONS, contract
from rfsight.sources.days import HISTORY, Days, Snapshot


#: Ids and hashes are hex text, half of which the default codec leaves in place.
CODEC = "zstd"


@dataclass(frozen=True)
class Layout:
    """Where tables and checkpoints live below one root, in one of its generations."""

    root: str
    generation: str = ""

    @property
    def base(self) -> str:
        return f"{self.root}/generations/{self.generation}" if self.generation else self.root

    def fresh(self) -> Layout:
        """An unused generation over the same landing folders."""
        return Layout(self.root, uuid.uuid4().hex)

    def table(self, name: str) -> str:
        return f"{self.base}/tables/{name}"

    def days(self, name: str) -> str:
        """Compacted days of a table, beside the files that its stream has written."""
        return f"{self.base}/days/{name}"

    def history(self, name: str) -> str:
        """Rows that a batch has put in front of what a stream writes."""
        return f"{self.base}/history/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"

    def landing(self, protocol: str) -> str:
        return f"{self.root}/landing/{protocol}"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local session that names none, as in a test, gets a temporary folder; on a cluster every executor would
    write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not named:
        named = spark.sparkContext.getCheckpointDir()
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = named or tempfile.mkdtemp(prefix="rfsight-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_layout(spark: SparkSession, label: str) -> Layout:
    """A fresh layout in the shared folder, unique per call; it goes when the driver ends."""
    layout = Layout(f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}")
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH.append((spark, layout.root))
    return layout


_SCRATCH: list[tuple[SparkSession, str]] = []


def remove(spark: SparkSession, root: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _remove_scratch() -> None:
    for spark, root in _SCRATCH:
        with contextlib.suppress(Exception):  # the session may have ended before
            remove(spark, root)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def is_streamed(spark: SparkSession, layout: Layout, name: str) -> bool:
    """Whether a stream has written the table; batch writes would then be lost to readers, or destroy it."""
    return exists(spark, f"{layout.table(name)}/_spark_metadata")


def newest_file(spark: SparkSession, path: str, settle_seconds: int = 0) -> int:
    """Modification time (epoch microseconds) of the newest file that is older than ``settle_seconds``; 0 if none.
    Listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("modificationTime")
    settled = F.current_timestamp() - F.make_dt_interval(secs=F.lit(settle_seconds))
    newest = files.filter(F.col("modificationTime") <= settled).agg(F.max(F.unix_micros("modificationTime"))).first()[0]
    return newest or 0


_BOUNDARY = "protocol string, until bigint"


def write_boundary(spark: SparkSession, layout: Layout, until: dict[str, int]) -> None:
    """Note up to which landing files a generation was built as a batch, by protocol."""
    lines = spark.createDataFrame(list(until.items()), _BOUNDARY)
    lines.coalesce(1).write.mode("errorifexists").parquet(f"{layout.base}/boundary")


def boundary(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """The times of :func:`write_boundary`; empty where all was streamed."""
    if not exists(spark, f"{layout.base}/boundary"):
        return {}
    return {r["protocol"]: r["until"] for r in spark.read.schema(_BOUNDARY).parquet(f"{layout.base}/boundary").collect()}


def history(spark: SparkSession, layout: Layout, name: str, streaming: bool = False, **options) -> DataFrame:
    """What a batch has put in front of a table's stream."""
    reader = spark.readStream if streaming else spark.read
    rows = reader.options(**options).schema(contract(name)).parquet(layout.history(name))
    return rows.select(*contract(name).fieldNames())


_PUBLISHED = "generation string, published timestamp"


def publish(spark: SparkSession, layout: Layout) -> None:
    """Make a generation the current one. The list is only ever appended to, so readers see the old one or the new."""
    line = spark.createDataFrame([(layout.generation,)], "generation string")
    line = line.withColumn("published", F.current_timestamp())
    line.coalesce(1).write.mode("append").parquet(f"{layout.root}/published")


def current_layout(spark: SparkSession, root: str) -> Layout:
    """The layout of the generation published last, or of the root itself."""
    if not exists(spark, f"{root}/published"):
        return Layout(root)
    lines = spark.read.schema(_PUBLISHED).parquet(f"{root}/published")
    return Layout(root, lines.agg(F.max_by("generation", "published")).first()[0])


def _raw(spark: SparkSession, layout: Layout, name: str, streaming: bool = False, **options) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).schema(contract(name)).parquet(layout.table(name))


def _modified() -> Column:
    return F.unix_micros("_metadata.file_modification_time")


def _after(micros: int) -> Column:
    """Files modified after an instant. Compared as a time, which lets the scan leave whole files out."""
    return F.col("_metadata.file_modification_time") > F.timestamp_micros(F.lit(micros))


def _parts(raw: DataFrame, snapshot: Snapshot, until: int | None = None) -> list[DataFrame]:
    """What a snapshot leaves to a table's own files: days it does not name, and what came later to those it names.
    The two are scans of their own, as each leaves files out by folder or by time."""
    own = raw if until is None else raw.filter(~_after(until))
    named = F.col("event_date").isin(snapshot.days)
    return [own.filter(~named), own.filter(named & _after(snapshot.cut))]


def read_table(
    spark: SparkSession, layout: Layout, name: str, streaming: bool = False, **options
) -> DataFrame:
    """A table by name with its contract as schema, as batch or as an append-only stream.

    A batch takes compacted days in place of the files they stand for, and history before them. A stream reads what
    streams have written; :func:`stream_days` is for one that is to see all. Co-presence events that are stored by
    cells are put together from these and silver; a stream of them needs them stored as rows."""
    if name in _DERIVED and any(exists(spark, at(part)) for part in _STORED for at in (layout.table, layout.history)):
        if streaming:
            raise ValueError(f"{layout.base} holds co-presence by cells; a stream needs run_copresence(rows=True)")
        return _derived(spark, layout, name, **options)
    if streaming:
        return _raw(spark, layout, name, True, **options).select(*contract(name).fieldNames())
    return _batch_table(spark, layout, name, **options)


def _batch_table(spark: SparkSession, layout: Layout, name: str, **options) -> DataFrame:
    if not exists(spark, layout.history(name)):
        return _rows_of(spark, layout, name, Days(spark, layout.days(name)).snapshot(), **options)
    rows = history(spark, layout, name, **options)
    if exists(spark, layout.table(name)):
        rows = rows.unionByName(_rows_of(spark, layout, name, Days(spark, layout.days(name)).snapshot(), **options))
    return rows


#: Tables that are put together from what co-presence stores; a generation made earlier holds the last by itself.
_DERIVED, _STORED = ("copresence_events", "copresence_instants"), ("copresence_cells", "copresence_instants")


def _derived(spark: SparkSession, layout: Layout, name: str, **options) -> DataFrame:
    from rfsight.operators import copresence  # it stores tables itself

    def stored(part: str) -> bool:
        return any(exists(spark, at(part)) for at in (layout.table, layout.history))

    silver = [read_table(spark, layout, part, **options) for part in ("wifi_silver", "bt_silver")]
    if not stored("copresence_cells"):
        instants = _batch_table(spark, layout, "copresence_instants", **options)
        return instants if name == "copresence_instants" else copresence.events_of_instants(instants, *silver)
    cells = read_table(spark, layout, "copresence_cells", **options)
    if name == "copresence_instants":
        return copresence.instants_of_cells(cells, *silver)
    members = read_table(spark, layout, "copresence_members", **options) if stored("copresence_members") else None
    return copresence.events_of_cells(cells, *silver, members)


def _rows_of(
    spark: SparkSession, layout: Layout, name: str, snapshot: Snapshot, until: int | None = None, **options
) -> DataFrame:
    columns = contract(name).fieldNames()
    if not snapshot.versions:
        raw = _raw(spark, layout, name, **options)
        return (raw if until is None else raw.filter(~_after(until))).select(*columns)
    parts = [p.select(*columns) for p in _parts(_raw(spark, layout, name, **options), snapshot, until)]
    return reduce(DataFrame.unionByName, [Days(spark, layout.days(name)).read(snapshot, contract(name), **options), *parts])


def stream_days(spark: SparkSession, layout: Layout, name: str, consumer: str, **options) -> DataFrame:
    """The whole table as a stream for a new consumer: compacted days and history first, then the stream's files.

    The snapshot is pinned when the consumer first asks, beside its checkpoint: a day compacted later is still read
    from the files that the consumer has begun with, so no row comes twice.
    """
    days, pinned = Days(spark, layout.days(name)), Days(spark, f"{layout.checkpoint(consumer)}-days-{name}")
    snapshot = pinned.snapshot()
    if not snapshot.versions:
        snapshot = pinned.publish(days.snapshot())
    raw, columns = _raw(spark, layout, name, True, **options), contract(name).fieldNames()
    parts = [history(spark, layout, name, True, **options)] if exists(spark, layout.history(name)) else []
    if snapshot.versions:
        parts.append(days.read(snapshot, contract(name), streaming=True, **options))
        parts += [p.select(*columns) for p in _parts(raw, snapshot)]
    else:
        parts.append(raw.select(*columns))
    return reduce(DataFrame.unionByName, parts)


def write_table(df: DataFrame, layout: Layout, name: str, mode: str = "append") -> None:
    """Batch sink. Rebalancing by the partition columns avoids one small file per task and day,
    and splits a day that is far larger than the rest."""
    if is_streamed(df.sparkSession, layout, name):
        raise ValueError(f"{layout.table(name)} is written by a stream; replay into a new generation instead")
    _write(df, name, layout.table(name), mode)


def _write(df: DataFrame, name: str, path: str, mode: str) -> None:
    keys = PARTITIONS[name]
    df.hint("rebalance", *[F.col(k) for k in keys]).write.mode(mode).partitionBy(*keys).parquet(path, compression=CODEC)


def put_history(df: DataFrame, layout: Layout, name: str) -> None:
    """Store rows in front of what a stream will write to a table. They count once the generation is published."""
    _write(df, name, layout.history(name), "overwrite")


def stream_table(df: DataFrame, layout: Layout, name: str, **options) -> StreamingQuery:
    """Append sink with its own checkpoint; takes what is available, then stops."""
    return (
        df.writeStream.queryName(name)
        .format("parquet")
        .outputMode("append")
        .partitionBy(*PARTITIONS[name])
        .option("checkpointLocation", layout.checkpoint(name))
        .options(**{"compression": CODEC} | options)
        .trigger(availableNow=True)
        .start(layout.table(name))
    )


def compact(
    spark: SparkSession, layout: Layout, name: str, event_date: str, target: str, order: tuple[str, ...] = ()
) -> DataFrame:
    """Rewrite one day of a table as fewer files clustered by sensor, into a new folder.

    The source files stay untouched, so a lost executor or a failed run leaves the table as it was.
    """
    day = read_table(spark, layout, name).filter(F.col("event_date") == event_date)
    clustered = day.hint("rebalance", F.col("sensor_id")).sortWithinPartitions(
        *(order or ("sensor_id", "event_time"))
    )
    clustered.write.mode("errorifexists").partitionBy(*PARTITIONS[name]).parquet(target)
    return spark.read.schema(contract(name)).parquet(target)


def compact_days(
    spark: SparkSession, layout: Layout, name: str, before: str, order: tuple[str, ...] = ("sensor_id", "event_time")
) -> Snapshot:
    """Put the days before ``before`` into few files clustered by sensor, and let readers take these instead.

    Days whose files have not changed since the last run keep their version; a day that got more is written anew from
    its version and what came later. Data is written first and then named by a new snapshot, which readers follow from
    one moment to the next; the table's own files stay for streams that have begun with them. To be run between
    triggers, as files are told apart by the time they were written; :func:`uncovered` tells if one slipped through.
    """
    days = Days(spark, layout.days(name))
    snapshot = days.snapshot()
    raw = _raw(spark, layout, name).filter(F.col("event_date") < before)
    changed = reduce(DataFrame.unionByName, [p.select("event_date", _modified().alias("at")) for p in _parts(raw, snapshot)])
    changed = {r["event_date"]: r["at"] for r in changed.groupBy("event_date").agg(F.max("at").alias("at")).collect()}
    if not changed:
        return snapshot
    step = max(snapshot.step, HISTORY) + 1
    cut, version = max(snapshot.cut, *changed.values()), f"c{step}"
    rows = _rows_of(spark, layout, name, snapshot, until=cut).filter(F.col("event_date").isin(sorted(changed)))
    keys = PARTITIONS[name]
    placed = rows.hint("rebalance", *[F.col(k) for k in keys], F.col(order[0])).sortWithinPartitions(*keys, *order)
    days.write(placed, version, tuple(k for k in keys if k != "event_date"))
    # Days already named have no file between the old cut and the new one, or they would be among the changed.
    return days.publish(Snapshot(step, snapshot.versions | dict.fromkeys(changed, (version,)), cut))


def uncovered(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """Compacted days whose own files up to the cut have another number of rows than their version: none, unless a
    trigger ran into a compaction. Counts come from file footers."""
    days = Days(spark, layout.days(name))
    snapshot = days.snapshot()
    own = _raw(spark, layout, name).filter(F.col("event_date").isin(snapshot.days) & ~_after(snapshot.cut))
    own = own.groupBy("event_date").agg(F.count(F.lit(1)).alias("own_rows"))
    kept = days.read(snapshot, contract(name)).groupBy("event_date").agg(F.count(F.lit(1)).alias("stored_rows"))
    return own.join(kept, "event_date", "full").filter(~F.col("own_rows").eqNullSafe(F.col("stored_rows")))
