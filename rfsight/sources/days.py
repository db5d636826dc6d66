"""Days of a table in versions, and which versions of each day count.

Data lies in ``data/event_date=<day>/version=<name>``. A snapshot names the versions that make up each day; it is one
small file in ``pointers/step=<n>``, written after the data, so readers see the old state or the new one, and a job
that dies in between leaves data that nobody reads. The last snapshots stay, for readers on the way and for a step
that is run again; versions that none of them names are deleted. A snapshot has a row per day, as many as a table's
retention keeps.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Snapshots that stay, and the step of none. A history has step -1, so that micro-batches come after it.
KEPT, NONE, HISTORY = 2, -2, -1
_POINTERS = "event_date string, versions array<string>, cut bigint"


@dataclass(frozen=True)
class Snapshot:
    """Versions by day, and the modification time (epoch microseconds) up to which another folder's files are in
    them, where there is another folder."""

    step: int = NONE
    versions: dict[str, tuple[str, ...]] = field(default_factory=dict)
    cut: int = 0

    @property
    def days(self) -> list[str]:
        return sorted(self.versions)


@dataclass(frozen=True)
class Days:
    spark: SparkSession
    root: str

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _exists(self, path: str) -> bool:
        fs, at = self._fs(path)
        return fs.exists(at)

    def snapshot(self, before: int | None = None) -> Snapshot:
        """The last snapshot, or the last of a step below ``before``."""
        folder = f"{self.root}/pointers"
        if not self._exists(folder):
            return Snapshot()
        rows = self.spark.read.schema(f"{_POINTERS}, step bigint").parquet(folder)
        if before is not None:
            rows = rows.filter(F.col("step") < before)
        last = rows.agg(F.max("step")).first()[0]
        if last is None:
            return Snapshot()
        named = rows.filter(F.col("step") == last).collect()
        return Snapshot(last, {r["event_date"]: tuple(r["versions"]) for r in named}, named[0]["cut"])

    def publish(self, new: Snapshot, mode: str = "errorifexists") -> Snapshot:
        """Make a snapshot the last one, in one step, and delete what the last ones do not name."""
        rows = [(day, list(new.versions[day]), new.cut) for day in new.days]
        if rows:
            line = self.spark.createDataFrame(rows, _POINTERS).coalesce(1)
            line.write.mode(mode).parquet(f"{self.root}/pointers/step={new.step}")
            self._clean(new)
        return new

    def _clean(self, last: Snapshot) -> None:
        kept = [last]
        while len(kept) < KEPT and kept[-1].step > NONE:
            kept.append(self.snapshot(before=kept[-1].step))
        old = self.snapshot(before=kept[-1].step)
        while old.step > NONE:
            for day, versions in old.versions.items():
                named = {v for s in kept for v in s.versions.get(day, ())}
                for version in set(versions) - named:
                    self._drop(day, version)
            fs, at = self._fs(f"{self.root}/pointers/step={old.step}")
            fs.delete(at, True)
            old = self.snapshot(before=old.step)

    def write(self, rows: DataFrame, version: str, more: tuple[str, ...] = ()) -> None:
        """Store a version of the days in ``rows``. The same version written again replaces itself."""
        placed = rows.withColumn("version", F.lit(version))
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("event_date", "version", *more).parquet(self.data)

    def days_of(self, version: str) -> list[str]:
        """Days that a version has rows of."""
        stored = self.spark.read.schema("event_date string, version string").parquet(self.data)
        return sorted(r[0] for r in stored.filter(F.col("version") == version).select("event_date").distinct().collect())

    def begin(self, rows: DataFrame) -> Snapshot:
        """Store the state that micro-batches will add to."""
        self.write(rows, "history")
        return self.publish(Snapshot(HISTORY, dict.fromkeys(self.days_of("history"), ("history",))))

    def upsert(
        self, partial: DataFrame, batch_id: int, merge: Callable[[DataFrame], DataFrame], fold_after: int
    ) -> Snapshot:
        """Add a micro-batch's partial aggregate to the days it touches; ``merge`` makes one state of several.

        The state before is the snapshot of an earlier batch, whatever a first try of this batch has left.
        """
        before, schema = self.snapshot(before=batch_id), partial.schema
        own = f"b{batch_id}"
        self.write(partial, own)
        touched = self.days_of(own)
        versions = before.versions | {day: (*before.versions.get(day, ()), own) for day in touched}
        crowded = [day for day in touched if len(versions[day]) > fold_after]
        if crowded:
            folded = f"f{batch_id}"
            self.write(merge(self.read(Snapshot(batch_id, versions), schema, crowded)), folded)
            versions |= dict.fromkeys(crowded, (folded,))
        published = self.publish(Snapshot(batch_id, versions), "overwrite")
        for day in crowded:  # in the fold, and named by no snapshot
            self._drop(day, own)
        return published

    def replace(self, rows: DataFrame, batch_id: int, make: Callable[[DataFrame], DataFrame]) -> Snapshot:
        """Make the days that ``rows`` touch anew: ``make`` gets what is stored of them and ``rows``, in the columns
        of ``rows``. Other days are neither read nor written."""
        before, own, whole = self.snapshot(before=batch_id), f"b{batch_id}", f"r{batch_id}"
        arrived = Days(self.spark, f"{self.root}/arrived")
        arrived.write(rows, own)
        touched = arrived.days_of(own)
        parts = [arrived.read(Snapshot(batch_id, dict.fromkeys(touched, (own,))), rows.schema)]
        if known := {day: before.versions[day] for day in touched if day in before.versions}:
            parts.append(self.read(Snapshot(batch_id, known), rows.schema))
        self.write(make(reduce(DataFrame.unionByName, parts)), whole)
        published = self.publish(Snapshot(batch_id, before.versions | dict.fromkeys(touched, (whole,))), "overwrite")
        for day in touched:
            arrived._drop(day, own)
        return published

    def _drop(self, day: str, version: str) -> None:
        fs, at = self._fs(f"{self.data}/event_date={day}/version={version}")
        fs.delete(at, True)

    def counts(self, snapshot: Snapshot) -> Column:
        """Whether a stored row is of a version that counts; on folder names alone, so others are not read."""
        names = [f"{day}/{v}" for day in snapshot.days for v in snapshot.versions[day]]
        return F.concat_ws("/", "event_date", "version").isin(names)

    def read(
        self, snapshot: Snapshot, schema: T.StructType, days: list[str] | None = None, streaming: bool = False, **options
    ) -> DataFrame:
        """Rows of the versions that count, of all days or of some."""
        if days is not None:
            snapshot = Snapshot(snapshot.step, {d: v for d, v in snapshot.versions.items() if d in set(days)}, snapshot.cut)
        whole = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
        reader = self.spark.readStream if streaming else self.spark.read
        rows = reader.options(**options).schema(whole).parquet(self.data)
        return rows.filter(self.counts(snapshot)).select(*schema.fieldNames())
