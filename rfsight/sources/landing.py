"""Newline-delimited JSON landing files, read whole and with nothing lost.

Lines are read as text and parsed by ``from_json``, because the JSON file source drops unknown fields
without a trace. What does not fit the schema is kept in ``_rescued_data``:

* a malformed line: the line itself;
* otherwise a JSON object with the unknown fields and the fields whose value has the wrong type
  (the well-typed fields of that row are kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rfsight.config import Settings
from rfsight.contracts import contract
from rfsight.operators.bronze import to_bronze, to_quarantine, with_event_id, with_ingest_metadata

# --- fixed values: files taken per micro-batch -------------------------------------------------
FILES_PER_TRIGGER = {"wifi": 1000, "bt": 2000}
# ----------------------------------------------------------------------------------------------

_BROKEN = "_broken_line"


def read_lines(
    spark: SparkSession,
    path: str,
    protocol: str,
    streaming: bool = False,
    since: int | None = None,
    until: int | None = None,
    **options,
) -> DataFrame:
    """Lines of every file under ``path`` with their file path. Batch and stream share this reader.

    ``since`` and ``until`` are modification times in epoch microseconds, the first left out and the last taken; files
    outside are not opened.
    """
    if not streaming:
        reader = spark.read.options(**options)
    else:
        if "maxBytesPerTrigger" not in options:
            options.setdefault("maxFilesPerTrigger", FILES_PER_TRIGGER[protocol])
        reader = spark.readStream.options(**options)
    lines = reader.option("recursiveFileLookup", "true").text(path)
    modified = F.col("_metadata.file_modification_time")
    if since is not None:
        lines = lines.filter(modified > F.timestamp_micros(F.lit(since)))
    if until is not None:
        lines = lines.filter(modified <= F.timestamp_micros(F.lit(until)))
    return lines.select(F.col("value"), F.col("_metadata.file_path").alias("source_path"))


def parse_lines(df: DataFrame, protocol: str, column: str = "value") -> DataFrame:
    """Replace the text ``column`` by the payload columns and ``_rescued_data``.

    Clean lines cost one typed parse and one key scan; only suspicious ones are parsed a third time.
    The parsed row goes through a one-element ``inline``: filters on its fields stay above it, where
    they see plain columns, instead of being pushed below and parsing every line again.
    """
    payload = contract(f"{protocol}_payload")
    names = payload.fieldNames()
    typed = T.StructType([*payload.fields, T.StructField(_BROKEN, T.StringType())])
    known = F.array(*[F.lit(name) for name in names])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    once = F.struct(
        F.from_json(column, typed, options).alias("_row"), F.json_object_keys(column).alias("_keys")
    )
    parsed = df.select("*", F.inline(F.array(once)))

    cut = F.col("_keys").isNull() | F.col("_row").isNull()
    odd = F.col(f"_row.{_BROKEN}").isNotNull() | (F.size(F.array_except("_keys", known)) > 0)
    empty = F.array_compact(F.array(*[F.when(F.isnull(f"_row.{name}"), F.lit(name)) for name in names]))
    misfits = F.map_filter(
        F.from_json(column, "map<string,string>"),
        lambda name, value: ~F.array_contains(known, name)
        | (value.isNotNull() & F.array_contains(empty, name)),
    )
    told = F.when(odd & ~cut, F.to_json(misfits))
    rescued = F.when(cut, F.col(column)).when(told == "{}", F.col(column)).otherwise(told)
    rest = [name for name in df.columns if name != column]
    return parsed.select(*[f"_row.{name}" for name in names], rescued.alias("_rescued_data"), *rest)


def read_landing(
    spark: SparkSession, path: str, protocol: str, settings: Settings, streaming: bool = False, **options
) -> DataFrame:
    """Landing files as rows with payload, rescued data, event id and ingest stamps."""
    lines = read_lines(spark, path, protocol, streaming, **options)
    return stamp(parse_lines(lines, protocol), protocol, settings)


def stamp(rows: DataFrame, protocol: str, settings: Settings) -> DataFrame:
    """Event id and ingest stamps for parsed rows that carry their own ``source_path``."""
    return with_ingest_metadata(
        with_event_id(rows, protocol), settings, source=F.col("source_path")
    )


def ingest(
    spark: SparkSession,
    path: str,
    protocol: str,
    settings: Settings,
    streaming: bool = False,
    observation: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(bronze, quarantine) of a landing folder: two flows over one parsed source."""
    landed = read_landing(spark, path, protocol, settings, streaming, **options)
    bronze = to_bronze(landed, protocol, settings, observation)
    return bronze, to_quarantine(landed, protocol, settings)


def read_kafka(spark: SparkSession, servers: str, topic: str, protocol: str, **options) -> DataFrame:
    """Message-stream source for low latency. Needs Spark's Kafka connector on the class path."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return parse_messages(stream, protocol)


def parse_messages(df: DataFrame, protocol: str) -> DataFrame:
    """Kafka-shaped rows (binary ``value``, topic, partition, offset) to landing rows."""
    origin = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    lines = df.select(F.col("value").cast("string").alias("value"), origin.alias("source_path"))
    return parse_lines(lines, protocol)


def export_ndjson(
    df: DataFrame, path: str, by: str | None = "sensor_id", max_records: int = 0, mode: str = "errorifexists"
) -> None:
    """Write rows as compact NDJSON, one folder per ``by`` value, at most ``max_records`` per file.

    Records stay complete: the folder key is a copy of the column. The rebalance hint lets the runtime
    split a sensor that holds many rows over several tasks.
    """
    writer = df.write
    if by is not None:
        folder = f"by_{by}"
        placed = df.withColumn(folder, F.col(by)).hint("rebalance", F.col(folder))
        writer = placed.write.partitionBy(folder)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.mode(mode).option("ignoreNullFields", "false").json(path)
