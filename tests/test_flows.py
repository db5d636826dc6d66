"""Files through the batch and streaming flows."""

import json

import pytest
from pyspark.sql import functions as F
from rows import at, bt, wifi, write_lines

from rfsight.config import Settings
from rfsight.operators import analytics, reports
from rfsight.operators.dedup import dedup_stream, first_per_window
from rfsight.plans.medallion import backfill
from rfsight.sources import landing, scan_dump, tables
from rfsight.sources.tables import Layout
from rfsight.streaming import flows, metrics

TABLES = [
    "wifi_bronze", "bt_bronze", "wifi_quarantine", "wifi_silver", "bt_silver", "device_timeline",
    "copresence_events", "perimeter_alerts",
]


def _rows(spark, layout, name):
    """Rows as JSON text, without the columns that name input files."""
    df = tables.read_table(spark, layout, name).drop("source_path")
    return sorted(r[0] for r in df.select(F.to_json(F.struct("*"))).collect())


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    """Several files per protocol: duplicates, out-of-order rows, and one row of every fault."""
    root = tmp_path_factory.mktemp("flow")
    folder = root / "landing" / "wifi"
    steady = [wifi(message_id=f"w{i}", event_time=at(i * 7), rssi_dbm=-40 - i % 50) for i in range(60)]
    write_lines(folder, "a", steady[:20] + steady[40:45])
    write_lines(folder, "b", steady[15:45])
    write_lines(
        folder,
        "c",
        steady[40:]
        + [
            wifi(message_id="null-sensor", sensor_id=None),
            wifi(message_id="future", event_time="2024-06-02T12:00:00Z"),
            wifi(message_id="ancient", event_time="2024-05-01T12:00:00Z"),
            wifi(message_id="no-time", event_time=None),
            wifi(message_id="loud", rssi_dbm=200),
            wifi(message_id="no-bssid", bssid=None),
            json.dumps(wifi(message_id="extra"))[:-1] + ', "firmware": {"v": 2}}',
            json.dumps(wifi(message_id="mistyped") | {"channel": "high"}),
            '{"sensor_id": "gate-1", "message_id": "cut',
        ],
    )
    other = root / "landing" / "bt"
    adverts = [bt(message_id=f"b{i}", event_time=at(i * 11 + 0.5)) for i in range(40)]
    write_lines(other, "a", adverts[:25])
    write_lines(other, "b", adverts[20:])
    return root


@pytest.fixture(scope="module")
def streamed(spark, landed):
    layout = Layout(str(landed))
    cfg = Settings(salt="pepper", as_of="2024-06-01T12:10:00Z", run_id="test")
    flows.run_pipeline(spark, layout, cfg, partitions=2, maxFilesPerTrigger=1)
    return layout, cfg


@pytest.mark.parametrize("name", TABLES)
def test_stream_equals_batch(spark, streamed, tmp_path_factory, name):
    layout, cfg = streamed
    batch = Layout(layout.root + "-batch")
    if not (tmp_path_factory.getbasetemp() / "done").exists():
        for protocol in ("wifi", "bt"):
            text = spark.read.text(layout.landing(protocol))
            text.write.mode("overwrite").text(batch.landing(protocol))
        backfill(spark, batch, cfg)
        (tmp_path_factory.getbasetemp() / "done").touch()
    assert _rows(spark, layout, name) == _rows(spark, batch, name)
    assert _rows(spark, layout, name)


def _ids(spark, layout, name):
    return {r[0] for r in tables.read_table(spark, layout, name).select("message_id").collect()}


def test_each_fault_ends_where_the_rules_send_it(spark, streamed):
    layout, _ = streamed
    bronze, silver = (_ids(spark, layout, f"wifi_{t}") for t in ("bronze", "silver"))
    assert "null-sensor" in bronze and "null-sensor" not in silver
    assert not {"future", "ancient", "no-time"} & bronze
    assert {"loud", "no-bssid", "extra", "mistyped"} <= silver
    flags = {
        r.message_id: r.dq_flags
        for r in tables.read_table(spark, layout, "wifi_silver").collect()
    }
    assert "RSSI_OUT_OF_RANGE" in flags["loud"] and "MISSING_BSSID" in flags["no-bssid"]
    held = {r._rescued_data for r in tables.read_table(spark, layout, "wifi_quarantine").collect()}
    assert held == {
        '{"firmware":"{\\"v\\":2}"}', '{"channel":"high"}', '{"sensor_id": "gate-1", "message_id": "cut'
    }


def test_streamed_sighting_windows_and_replay(spark, streamed):
    """Running the trigger again with nothing new, or one batch twice, changes nothing."""
    layout, _ = streamed
    timeline = tables.read_table(spark, layout, "device_timeline")
    expected = sorted(map(str, analytics.flatten_latest(analytics.sighting_windows(timeline)).collect()))
    for _ in range(2):
        stored = analytics.flatten_latest(flows.read_sighting_windows(spark, layout))
        assert sorted(map(str, stored.collect())) == expected
        flows.run_sighting_windows(spark, layout)


def test_streaming_expectation_log(spark, streamed):
    layout, _ = streamed
    log = reports.failure_pct(metrics.read_log(spark, layout))
    rates = {(r.table_name, r.expectation): (r.failed_records, r.passed_records) for r in log.collect()}
    assert rates[("wifi_silver", "valid_sensor_id")][0] == 1
    assert rates[("wifi_silver", "rssi_plausible")][0] == 1
    silver = tables.read_table(spark, layout, "wifi_silver").count()
    assert rates[("wifi_silver", "valid_sensor_id")][1] == silver


def test_copresence_over_six_hand_made_rows(spark, tmp_path, settings):
    root = tmp_path / "six"
    write_lines(root / "landing" / "wifi", "w", [
        wifi(message_id="1"),
        wifi(message_id="2", event_time=at(30), ssid=None, rssi_dbm=-72, confidence=None),
        wifi(message_id="3", sensor_id="gate-2", event_time=at(10), bssid="02:00:00:00:00:01"),
    ])
    write_lines(root / "landing" / "bt", "b", [
        bt(message_id="1", event_time=at(30)),
        bt(message_id="2", event_time=at(60.001)),
        bt(message_id="3", sensor_id="gate-2", event_time=at(3), confidence=0.65),
    ])
    layout = Layout(str(root))
    backfill(spark, layout, settings)
    events = tables.read_table(spark, layout, "copresence_events").collect()
    # noon and 12:00:30 are exactly 30 s apart and count; 12:00:30 and 12:01:00.001 do not
    assert sorted((r.sensor_id, r.copresence_score) for r in events) == [
        ("gate-1", 0.65), ("gate-1", 0.85), ("gate-2", 0.775)
    ]
    alerts = {
        (r.sensor_id, r.protocol): r for r in tables.read_table(spark, layout, "perimeter_alerts").collect()
    }
    # -48 dBm, confidence 0.9: (0.3 + 17/45 * 0.7) * 0.9 * (0.7 + 0.1 per reason, at most 1)
    near = alerts[("gate-1", "WIFI")]
    assert (near.alert_reasons, near.threat_score) == (["VERY_CLOSE_PROXIMITY", "WITHIN_10M"], 0.457)
    disguised = alerts[("gate-2", "WIFI")]
    assert disguised.alert_reasons == ["VERY_CLOSE_PROXIMITY", "RANDOMIZED_IDENTIFIER", "WITHIN_10M"]
    assert disguised.threat_score == 0.508


def test_late_rows_are_dropped_one_batch_after_the_watermark_passes(spark, tmp_path, settings):
    layout = Layout(str(tmp_path))

    def arrive(name, *seconds):
        write_lines(tmp_path / "landing" / "bt", name, [bt(message_id=f"{name}{s}", event_time=at(s)) for s in seconds])
        with flows.state_settings(spark, 1):
            rows = landing.read_landing(spark, layout.landing("bt"), "bt", settings, streaming=True)
            unique = dedup_stream(rows, "60 seconds")
            metrics.finish(
                unique.select("message_id").writeStream.format("parquet")
                .option("checkpointLocation", layout.checkpoint("d")).trigger(availableNow=True).start(layout.table("d"))
            )
        return {r[0] for r in spark.read.parquet(layout.table("d")).collect()}

    assert arrive("a", 0, 600) == {"a0", "a600"}
    assert arrive("b", 10, 590) == {"a0", "a600", "b590"}


def test_first_per_window_stream(spark, tmp_path, settings):
    write_lines(tmp_path / "landing" / "bt", "a", [
        bt(message_id="1", event_time=at(1)), bt(message_id="2", event_time=at(2), device_address="C0:11:22:33:44:55"),
        bt(message_id="3", event_time=at(12)),
    ])
    batch = landing.read_landing(spark, str(tmp_path / "landing" / "bt"), "bt", settings)
    assert sorted(r.message_id for r in first_per_window(batch).collect()) == ["1", "3"]
    with flows.state_settings(spark, 1):
        stream = landing.read_landing(spark, str(tmp_path / "landing" / "bt"), "bt", settings, streaming=True)
        metrics.finish(
            first_per_window(stream).select("message_id").writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "o"))
        )
    assert sorted(r.message_id for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["1", "3"]


def test_export_keeps_whole_records(spark, tmp_path, settings):
    df = spark.createDataFrame([("s1", 1), ("s1", 2), ("s1", 3), ("s2", 4)], "sensor_id string, v int")
    landing.export_ndjson(df, str(tmp_path / "x"), max_records=2)
    files = [p for p in (tmp_path / "x" / "by_sensor_id=s1").iterdir() if p.suffix == ".json"]
    lines = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    assert len(files) >= 2 and sorted(r["v"] for r in lines) == [1, 2, 3] and {r["sensor_id"] for r in lines} == {"s1"}


def test_compaction_reduces_files_and_keeps_rows(spark, tmp_path, settings):
    layout = Layout(str(tmp_path))
    write_lines(tmp_path / "landing" / "wifi", "a", [wifi(message_id=str(i), event_time=at(i)) for i in range(50)])
    bronze, _ = landing.ingest(spark, layout.landing("wifi"), "wifi", settings)
    for _ in range(3):
        bronze.repartition(6).write.mode("append").partitionBy("event_date").parquet(layout.table("wifi_bronze"))
    out = tables.compact(spark, layout, "wifi_bronze", "2024-06-01", layout.table("compacted"))
    assert out.count() == 150 and len(out.inputFiles()) < 18


def test_scan_dump_files(spark, tmp_path, settings):
    text = (
        "wlan0 Scan completed :\n Cell 01 - Address: AA:BB:CC:00:11:22\n Channel:6\n Frequency:2.437 GHz\n"
        ' Quality=35/70  Signal level=-60 dBm  Noise level=-90 dBm\n Encryption key:on\n ESSID:"home"\n'
        " IE: IEEE 802.11i/WPA2 Version 1\n Authentication Suites (1) : PSK\n"
        ' Cell 02 - Address: aa:bb:cc:00:11:23\n Encryption key:off\n ESSID:""\n Cell 03 - nothing\n'
    )
    (tmp_path / "scan.txt").write_text(text)
    dumps = scan_dump.read_dumps(spark, str(tmp_path)).select(
        F.lit("gate-1").alias("sensor_id"), settings.now.alias("event_time"),
        F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), "dump",
    )
    first, second = scan_dump.parse_scan_dump(dumps).orderBy("bssid").collect()
    assert (first.bssid, first.frequency_mhz, first.band, first.snr_db, first.confidence) == (
        "aa:bb:cc:00:11:22", 2437, "2.4", 30.0, 0.5
    )
    assert (first.encryption, first.auth_mode, first.ssid, first.vendor_oui) == ("WPA2", "PSK", "home", "aa:bb:cc")
    assert (second.encryption, second.auth_mode, second.ssid, second.rssi_dbm) == ("OPEN", None, None, None)


def test_replay_then_further_triggers(spark, tmp_path):
    """Stream, replay into a new generation, take one more file: as a batch over all files, and all readable."""
    cfg = Settings(salt="pepper", as_of="2024-06-01T12:10:00Z", run_id="test")
    layout = Layout(str(tmp_path / "live"))
    for name, span in (("a", range(0, 20)), ("b", range(10, 30))):
        for protocol, row in (("wifi", wifi), ("bt", bt)):
            rows = [row(message_id=f"{protocol}{i}", event_time=at(i * 9), rssi_dbm=-45) for i in span]
            write_lines(tmp_path / "live" / "landing" / protocol, name, rows)
    assert tables.current_layout(spark, layout.root) == layout
    flows.run_pipeline(spark, layout, cfg, partitions=2)
    with pytest.raises(ValueError, match="written by a stream"):
        backfill(spark, layout, cfg)
    fresh = flows.replay(spark, layout, cfg, partitions=2)
    assert tables.current_layout(spark, layout.root) == fresh != layout
    write_lines(tmp_path / "live" / "landing" / "wifi", "c", [wifi(message_id="new", event_time=at(100), rssi_dbm=-45)])
    flows.run_pipeline(spark, fresh, cfg, partitions=2)
    batch = Layout(str(tmp_path / "batch"))
    for protocol in ("wifi", "bt"):
        spark.read.text(layout.landing(protocol)).write.text(batch.landing(protocol))
    backfill(spark, batch, cfg)
    for name in ("wifi_bronze", "wifi_silver", "bt_silver", "device_timeline", "copresence_events", "perimeter_alerts"):
        assert _rows(spark, fresh, name) == _rows(spark, batch, name), name
    assert len(_rows(spark, layout, "wifi_silver")) == 30 and len(_rows(spark, fresh, "wifi_silver")) == 31
    log = metrics.read_log(spark, fresh).groupBy("table_name").agg(F.sum("passed").alias("n")).collect()
    assert {"device_timeline", "copresence_events", "perimeter_alerts"} <= {r["table_name"] for r in log}


def test_a_malformed_cell_costs_no_other(spark):
    cell = "Cell 0{} - Address: AA:BB:CC:DD:EE:0{}\n Channel:6\n Frequency:{} GHz\n Quality=50/70  Signal level=-40 dBm\n"
    dump = cell.format(1, 1, "2.4.37") + cell.format(2, 2, "2.437") + cell.format(3, 3, "9" * 400)
    dump += cell.format(4, 4, "5.18").replace("-40", "-99999999999999")
    rows = spark.createDataFrame([("s", dump)], "sensor_id string, dump string")
    rows = rows.selectExpr("sensor_id", "TIMESTAMP '2024-06-01T00:00:00Z' AS event_time", "1D AS latitude", "2D AS longitude", "dump")
    found = scan_dump.parse_scan_dump(rows).select("bssid", "frequency_mhz", "rssi_dbm").collect()
    assert [tuple(r) for r in found] == [("aa:bb:cc:dd:ee:02", 2437, -40)]


def test_days_are_utc_in_any_session_zone(spark):
    from rfsight.operators.bronze import day_of

    rows = spark.createDataFrame([("2024-06-01T02:00:00Z",), ("1969-12-31T23:00:00Z",)], "t string").selectExpr("to_timestamp(t) AS t")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert [r[0] for r in rows.select(day_of("t")).collect()] == ["2024-06-01", "1969-12-31"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
