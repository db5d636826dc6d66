"""Physical plans: what must and must not be in them."""

import pytest
from pyspark.sql import functions as F

from rfsight.operators.copresence import copresence_pairs
from rfsight.operators.dedup import dedup_batch
from rfsight.operators.timeline import device_timeline, perimeter_alerts
from rfsight.plans.catalogue import CATALOGUE, run
from rfsight.sources import tables
from rfsight.sources.tables import Layout

SF_DIR = "/root/testdata/sf0.001"
FILE_QUERIES = {
    "landing_scan", "landing_scan_bt", "silver_scan", "partitioned_sink", "ndjson_export", "backfill_batch",
    "compact_partition", "compact_partition_bt", "silver_scan_bt", "ndjson_export_bt",
    "compacted_days", "compacted_stream", "handover_alerts",
    "arrival_sinks", "late_rows", "timely_silver", "dedup_state", "copresence_triggers", "sighting_frequency_stream",
    "quarantine_alarms_stream",
    "handover_copresence", "device_features_daily", "novel_device_stream", "movement_history_stream",
    "entity_clusters_stream", "dq_failure_rate", "dedup_stream", "late_data", "copresence_stream", "sighting_windows_stream", "entity_clusters",
}


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "1000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(CATALOGUE) - FILE_QUERIES))
def test_no_python_workers_and_no_cross_joins(spark, name):
    text = plan(run(name, spark, SF_DIR))
    assert "Python" not in text and "InPandas" not in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from rfsight.plans import adapter
    from rfsight.plans.catalogue import Views

    layout = Layout(str(tmp_path_factory.mktemp("stored")))
    views = Views(spark, SF_DIR, adapter.settings())
    tables.write_table(views.bronze("wifi"), layout, "wifi_bronze")
    for protocol in ("wifi", "bt"):
        tables.write_table(views.silver(protocol), layout, f"{protocol}_silver")
    wifi, bt = (tables.read_table(spark, layout, f"{p}_silver") for p in ("wifi", "bt"))
    tables.write_table(device_timeline(wifi, bt, views.settings), layout, "device_timeline")
    return layout, views.settings


def test_alert_gate_reaches_the_scan_and_prunes_columns(spark, stored):
    layout, settings = stored
    timeline = tables.read_table(spark, layout, "device_timeline").filter("event_date = '2024-01-01'")
    text = plan(perimeter_alerts(timeline, settings))
    assert "GreaterThanOrEqual(rssi_dbm,-65)" in text and "GreaterThanOrEqual(confidence,0.7)" in text
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "Exchange" not in text
    read = text.split("ReadSchema:")[1]
    assert "device_name" not in read and "ssid" not in read


def test_timeline_does_not_shuffle(spark, stored):
    layout, settings = stored
    wifi, bt = (tables.read_table(spark, layout, f"{p}_silver") for p in ("wifi", "bt"))
    assert "Exchange" not in plan(device_timeline(wifi, bt, settings))


def test_dedup_prunes_before_its_only_shuffle(spark, stored):
    layout, _ = stored
    text = plan(dedup_batch(tables.read_table(spark, layout, "wifi_bronze")))
    assert text.count("Exchange") == 1 and text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_copresence_joins_on_sensor_and_bucket(spark, stored):
    layout, settings = stored
    wifi, bt = (tables.read_table(spark, layout, f"{p}_silver") for p in ("wifi", "bt"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(copresence_pairs(wifi, bt, settings))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [wifi_sensor_id" in text and "wifi_bucket" in text
    assert text.count("Exchange hashpartitioning") == 2


def test_top_k_is_pruned_before_the_shuffle(spark):
    text = plan(run("oldest_pending_topk", spark, SF_DIR))
    assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_one_scan_per_report(spark, stored):
    from rfsight.operators.expectations import SILVER

    layout, settings = stored
    report = SILVER["wifi"].report(tables.read_table(spark, layout, "wifi_silver"), settings)
    assert plan(report).count("FileScan") == 1
    assert report.agg(F.count("*")).first()[0] == len(SILVER["wifi"].rules)
