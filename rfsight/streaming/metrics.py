"""Expectation counts of streaming runs, kept as a table.

Each micro-batch reports the observed metrics of its expectation set in its progress. They are a handful
of numbers per batch; the rows themselves never reach the driver.
"""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rfsight.operators.expectations import ExpectationSet
from rfsight.sources.tables import Layout

LOG = "expectation_log"
LOG_SCHEMA = (
    "table_name string, expectation string, action string, run_id string, batch_id bigint, "
    "failed bigint, passed bigint"
)
_POLL_SECONDS = 5
#: One append at a time: a writer that commits clears the folder's temporary files, those of others too.
_APPENDING = Lock()


def finish(*queries: StreamingQuery) -> list[dict]:
    """Wait for triggered queries, raise the first failure, and return every batch's progress.

    Spark keeps only the latest progress reports, so they are gathered while waiting.
    """
    reports: dict[tuple[str, int], dict] = {}
    for query in queries:
        done = False
        while not done:
            done = query.awaitTermination(_POLL_SECONDS)
            for progress in query.recentProgress:
                if progress["observedMetrics"]:
                    reports[(str(progress["runId"]), progress["batchId"])] = progress
    return list(reports.values())


def log_lines(reports: list[dict], rules: ExpectationSet, observation: str) -> list[tuple]:
    lines = []
    for progress in reports:
        metrics = progress["observedMetrics"].get(observation)
        if metrics is None or not metrics["rows_seen"]:
            continue
        for rule in rules.rules:
            failed = metrics[rule.name]
            lines.append(
                (
                    rules.table,
                    rule.name,
                    rule.action,
                    str(progress["runId"]),
                    progress["batchId"],
                    failed,
                    metrics["rows_seen"] - failed,
                )
            )
    return lines


def append_log(
    spark: SparkSession, layout: Layout, reports: list[dict], rules: ExpectationSet, observation: str
) -> None:
    lines = log_lines(reports, rules, observation)
    if not lines:
        return
    with _APPENDING:
        spark.createDataFrame(lines, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(layout.table(LOG))


def read_log(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(layout.table(LOG))
