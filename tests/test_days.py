"""Compacted days in use, history before a stream, and latest state per day."""

import pytest
from pyspark.sql import functions as F
from rows import at, bt, wifi, write_lines

from rfsight.config import Settings
from rfsight.operators import analytics, clusters, lookup
from rfsight.plans.medallion import backfill
from rfsight.sources import tables
from rfsight.sources.days import Days, Snapshot
from rfsight.sources.tables import Layout
from rfsight.streaming import flows, metrics


@pytest.fixture
def cfg():
    return Settings(salt="pepper", as_of="2024-06-04T12:10:00Z", run_id="test")


def _day(day, seconds):
    return at(seconds).replace("2024-06-01", f"2024-06-0{day}")


def _ids(df):
    return sorted(r[0] for r in df.select("message_id").collect())


def _files(df):
    return df.select(F.input_file_name()).distinct().count()


@pytest.mark.parametrize("protocol", ["wifi", "bt"])
def test_compacted_days_replace_their_files(spark, tmp_path, cfg, protocol):
    layout, row, name = Layout(str(tmp_path)), {"wifi": wifi, "bt": bt}[protocol], f"{protocol}_bronze"

    def arrive(label, days):
        rows = [row(message_id=f"{label}-{d}-{i}", event_time=_day(d, i)) for d in days for i in range(4)]
        write_lines(tmp_path / "landing" / protocol, label, rows)
        flows.run_bronze(spark, layout, protocol, cfg)
        return {r["message_id"] for r in rows}

    def read():
        return tables.read_table(spark, layout, name)

    arrived = set()
    for k in range(5):
        arrived |= arrive(f"a{k}", [1, 2, 3])
    assert set(_ids(read())) == arrived and _files(read()) >= 15
    days = Days(spark, layout.days(name))
    # data without a snapshot is not seen
    days.write(tables.read_table(spark, layout, name), "unfinished")
    assert set(_ids(read())) == arrived
    first = tables.compact_days(spark, layout, name, "2024-06-03")
    assert first.days == ["2024-06-01", "2024-06-02"] and set(_ids(read())) == arrived
    assert _files(read()) == 5 + 2 and _files(read().filter("event_date = '2024-06-01'")) == 1
    assert tables.compact_days(spark, layout, name, "2024-06-03") == first
    # a late file for a compacted day is seen beside it, then taken into it
    arrived |= arrive("late", [1, 4])
    assert _ids(read()) == sorted(arrived) and _files(read()) == 5 + 2 + 2
    second = tables.compact_days(spark, layout, name, "2024-06-04")
    assert second.versions == {"2024-06-01": ("c1",), "2024-06-02": ("c0",), "2024-06-03": ("c1",)}
    assert _ids(read()) == sorted(arrived) and _files(read()) == 3 + 1
    assert tables.uncovered(spark, layout, name).count() == 0

    # a new stream sees all once, and keeps to the files it began with
    def consume():
        rows = tables.stream_days(spark, layout, name, "reader").select("message_id")
        metrics.finish(
            rows.writeStream.format("parquet").option("checkpointLocation", layout.checkpoint("reader"))
            .trigger(availableNow=True).start(layout.table("seen"))
        )
        return _ids(spark.read.parquet(layout.table("seen")))

    assert consume() == sorted(arrived)
    arrived |= arrive("more", [3, 4])
    tables.compact_days(spark, layout, name, "2024-06-09")
    assert consume() == sorted(arrived) == _ids(read())
    # old versions go when no kept snapshot names them
    assert not (tmp_path / "days" / name / "data" / "event_date=2024-06-01" / "version=c0").exists()


def test_a_slipped_file_is_told(spark, tmp_path, cfg):
    layout = Layout(str(tmp_path))
    write_lines(tmp_path / "landing" / "bt", "a", [bt(message_id="1")])
    flows.run_bronze(spark, layout, "bt", cfg)
    snapshot = tables.compact_days(spark, layout, "bt_bronze", "2024-06-02")
    write_lines(tmp_path / "landing" / "bt", "b", [bt(message_id="2", event_time=at(9))])
    flows.run_bronze(spark, layout, "bt", cfg)
    Days(spark, layout.days("bt_bronze")).publish(Snapshot(snapshot.step + 1, snapshot.versions, 1 << 60))
    assert [tuple(r) for r in tables.uncovered(spark, layout, "bt_bronze").collect()] == [("2024-06-01", 2, 1)]


def _windows(df):
    return sorted(map(str, analytics.flatten_latest(df).collect()))


def test_sighting_windows_over_many_triggers(spark, tmp_path, cfg):
    """State equals one aggregation after every trigger; versions are bounded, and days not touched stay as they are."""
    layout = Layout(str(tmp_path))
    root = tmp_path / "days" / "sighting_windows"
    for k in range(7):
        day = 1 if k < 3 else 2
        rows = [wifi(message_id=f"{k}-{i}", event_time=_day(day, 60 * k + i), bssid=f"02:00:00:00:00:0{i % 3}") for i in range(6)]
        write_lines(tmp_path / "landing" / "wifi", f"f{k}", rows)
        write_lines(tmp_path / "landing" / "bt", f"f{k}", [bt(message_id=f"b{k}", event_time=_day(day, 60 * k))])
        for protocol in ("wifi", "bt"):
            flows.run_bronze(spark, layout, protocol, cfg)
            flows.run_silver(spark, layout, protocol, cfg, 2)
        flows.run_timeline(spark, layout, cfg)
        flows.run_sighting_windows(spark, layout, fold_after=2)
        timeline = tables.read_table(spark, layout, "device_timeline")
        assert _windows(flows.read_sighting_windows(spark, layout)) == _windows(analytics.sighting_windows(timeline))
        if k == 2:
            first_day = sorted(p.name for p in (root / "data" / "event_date=2024-06-01").iterdir())
    only = flows.read_sighting_windows(spark, layout, ["2024-06-02"])
    assert {r["event_date"] for r in only.collect()} == {"2024-06-02"}
    assert len(list((root / "data" / "event_date=2024-06-02").glob("version=*"))) <= 5
    assert len(list((root / "pointers").glob("step=*"))) == 2
    left = sorted(p.name for p in (root / "data" / "event_date=2024-06-01").iterdir())
    assert left and set(left) <= set(first_day)


def _json(spark, layout, name):
    df = tables.read_table(spark, layout, name).drop("source_path")
    return sorted(r[0] for r in df.select(F.to_json(F.struct("*"))).collect())


@pytest.fixture(scope="module")
def handed(spark, tmp_path_factory):
    """Two old files as history; copies of their rows, partners and new devices in three triggers behind them."""
    cfg = Settings(salt="pepper", as_of="2024-06-01T12:10:00Z", run_id="test")
    root = tmp_path_factory.mktemp("handed")
    layout = Layout(str(root))

    def arrive(name, span):
        for protocol, row in (("wifi", wifi), ("bt", bt)):
            rows = [row(message_id=f"{protocol}{i}", event_time=at(i * 9), rssi_dbm=-45) for i in span]
            write_lines(root / "landing" / protocol, name, rows)

    arrive("a", range(0, 20))
    arrive("b", range(15, 30))
    fresh = flows.hand_over(spark, layout, cfg, settle_seconds=0)
    for name, span in (("c", range(25, 40)), ("d", range(38, 44)), ("e", range(2, 50))):
        arrive(name, span)
        flows.run_pipeline(spark, fresh, cfg, partitions=2)
    batch = Layout(str(tmp_path_factory.mktemp("whole")))
    for protocol in ("wifi", "bt"):
        spark.read.text(layout.landing(protocol)).write.text(batch.landing(protocol))
    backfill(spark, batch, cfg)
    return fresh, batch


@pytest.mark.parametrize("name", ["wifi_bronze", "wifi_silver", "bt_silver", "device_timeline", "copresence_events", "perimeter_alerts"])
def test_history_and_streams_behind_it_are_one_batch(spark, handed, name):
    fresh, batch = handed
    assert tables.current_layout(spark, fresh.root) == fresh
    assert _json(spark, fresh, name) == _json(spark, batch, name)


def test_handed_over_windows_and_state(spark, handed):
    fresh, batch = handed
    timeline = tables.read_table(spark, batch, "device_timeline")
    assert _windows(flows.read_sighting_windows(spark, fresh)) == _windows(analytics.sighting_windows(timeline))
    # streams know nothing of the rows of history: neither in their tables nor in their state
    streamed = spark.read.parquet(fresh.table("wifi_silver"))
    assert set(_ids(streamed)) == {f"wifi{i}" for i in range(30, 50)}
    with flows.state_settings(spark, 2):
        state = spark.read.format("statestore").load(fresh.checkpoint("wifi_silver"))
        assert state.count() == 20


def test_history_of_an_empty_landing(spark, tmp_path, cfg):
    for protocol in ("wifi", "bt"):
        (tmp_path / "landing" / protocol).mkdir(parents=True)
    fresh = flows.hand_over(spark, Layout(str(tmp_path)), cfg)
    write_lines(tmp_path / "landing" / "wifi", "a", [wifi(message_id="1", event_time=_day(4, 0))])
    write_lines(tmp_path / "landing" / "bt", "a", [bt(message_id="1", event_time=_day(4, 3))])
    flows.run_pipeline(spark, fresh, cfg, partitions=2)
    assert tables.read_table(spark, fresh, "copresence_events").count() == 1


def test_a_batch_run_again_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([("d", "WIFI", f"2024-06-0{k}", k) for k in (1, 1, 2)], "device_id_hash string, protocol string, event_date string, n long")
    partial = rows.groupBy("device_id_hash", "protocol", "event_date").agg(F.sum("n").alias("n"))

    def merge(df):
        return df.groupBy("device_id_hash", "protocol", "event_date").agg(F.sum("n").alias("n"))

    days = Days(spark, str(tmp_path))
    for batch_id in (0, 1, 1, 2, 2):
        days.upsert(partial, batch_id, merge, fold_after=2)
    found = merge(days.read(days.snapshot(), partial.schema)).collect()
    assert sorted((r["event_date"], r["n"]) for r in found) == [("2024-06-01", 6), ("2024-06-02", 6)]


def _timeline(spark, rows):
    """(device, seconds, sensor, day) as timeline rows."""
    data = [(f"{d}-{s}-{day}", sensor, _day(day, s), f"2024-06-0{day}", "WIFI", d) for d, s, sensor, day in rows]
    df = spark.createDataFrame(data, "event_id string, sensor_id string, t string, event_date string, protocol string, device_id_hash string")
    df = df.withColumn("event_time", F.to_timestamp("t")).drop("t")
    empty = spark.createDataFrame([], tables.contract("device_timeline"))
    return empty.unionByName(df, allowMissingColumns=True)


def test_movement_in_batches_is_one_run(spark, tmp_path):
    layout = Layout(str(tmp_path))
    batches = [
        [("d", 0, "a", 1), ("d", 4000, "b", 1), ("e", 10, "a", 1), (None, 5, "a", 1)],
        [("d", 100, "b", 2), ("f", 1, "c", 2)],
        [("d", 2000, "c", 1), ("e", 5000, "b", 3)],  # one row in the middle of a day that is stored
        [("d", 7000, "a", 2), ("f", 2, "a", 2)],
    ]
    done = []
    for k, rows in enumerate(batches):
        tables.write_table(_timeline(spark, rows), layout, "device_timeline")
        flows.run_movement(spark, layout)
        done += rows
        whole = analytics.movement_history(_timeline(spark, done))
        assert sorted(map(str, flows.read_movement(spark, layout).collect())) == sorted(map(str, whole.collect())), k
    stored = tmp_path / "days" / "movement_history" / "data"
    assert len(list((stored / "event_date=2024-06-03").glob("version=*"))) == 1
    assert all(len(list(day.glob("version=*"))) <= 2 for day in stored.glob("event_date=*"))
    assert not list((tmp_path / "days" / "movement_history" / "arrived" / "data").glob("event_date=*/version=*"))


def _pairs(spark, rows):
    data = [(f"{w}-{b}-{k}", w, b, f"2024-06-0{1 + k % 3}") for k, (w, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "copresence_id string, wifi_device_hash string, bt_device_hash string, event_date string")
    return spark.createDataFrame([], tables.contract("copresence_events")).unionByName(df, allowMissingColumns=True)


def test_clusters_grow_with_their_links(spark, tmp_path):
    """Every prefix of the batches gives the clusters of a full run over it: chains join from both ends, links gather
    their pairs over batches, and a batch may bring nothing."""
    layout = Layout(str(tmp_path))
    batches = [
        [("w1", "b1"), ("w1", "b1"), ("w2", "b2"), ("w9", "b9")],
        [("w2", "b2"), ("w3", "b3"), ("w3", "b3"), (None, "b1")],
        [("w9", None)],
        [("w2", "b1"), ("w2", "b1"), ("w3", "b2"), ("w4", "b4")],
        [("w3", "b2"), ("w4", "b4"), ("w4", "b0"), ("w4", "b0"), ("w1", "b1")],
        [("w1", "b4"), ("w1", "b4")],
    ]
    done = []
    for k, rows in enumerate(batches):
        tables.write_table(_pairs(spark, rows), layout, "copresence_events")
        flows.run_clusters(spark, layout, min_pairs=2, fold_after=2)
        done += rows
        events = _pairs(spark, done).withColumn("copresence_score", F.lit(0.5))
        whole = clusters.entity_clusters(analytics.entity_links(events), min_pairs=2)
        found = flows.read_clusters(spark, layout)
        assert sorted(map(tuple, found.select("device_id_hash", "cluster_id").collect())) == sorted(map(tuple, whole.collect())), k
    assert {r["cluster_id"] for r in found.collect()} == {"b0"}


def test_novel_devices_in_any_order(spark, tmp_path):
    layout, done = Layout(str(tmp_path)), []
    batches = [
        [("d", 10, "a", 2), ("d", 11, "a", 2), ("e", 5, "a", 2), (None, 1, "a", 1)],
        [("d", 12, "b", 2), ("f", 1, "c", 2), ("f", 1, "d", 2)],
        [("d", 3, "c", 1), ("e", 5, "z", 2), ("g", 1, "a", 3)],  # an earlier one, and one at the same time
        [("d", 3, "x", 1), ("g", 0, "a", 3)],
    ]
    for k, rows in enumerate(batches):
        tables.write_table(_timeline(spark, [(d, s + k / 1000 if s == 1 and d == "f" else s, x, day) for d, s, x, day in rows]).withColumn("event_id", F.concat_ws("-", "event_id", F.lit(k), "sensor_id")), layout, "device_timeline")
        flows.run_novel_devices(spark, layout, fold_after=2)
        whole = lookup.novel_device(tables.read_table(spark, layout, "device_timeline"))
        found = flows.read_novel_devices(spark, layout)
        assert sorted(r["event_id"] for r in found.collect()) == sorted(r["event_id"] for r in whole.collect()), k
        done.append(found.count())
    assert done == [2, 4, 6, 7]


def test_the_filter_loses_no_device(spark):
    names = [f"dev{k}" for k in range(3000)]
    known, others = (spark.createDataFrame([(n,) for n in part], "device_id_hash string") for part in (names[:1500], names[1500:]))
    halves = [lookup.known_bits(known.filter(F.crc32("device_id_hash") % 2 == k)) for k in (0, 1)]
    bits = lookup.merge_bits(halves[0].unionByName(halves[1]))
    found = {r[0] for r in lookup.perhaps_known(known.unionByName(others), bits).collect()}
    assert found >= set(names[:1500]) and len(found) < 1550


def test_features_of_days_equal_the_scan(spark, tmp_path):
    """Pairs across midnight, a device on several sensors and days, a day without rows, and a day built again."""
    layout = Layout(str(tmp_path))
    midnight = 12 * 3600
    rows = [("d", midnight - 10, "a", 1), ("e", 100, "b", 1), ("d", 3000, "b", 1), ("d", 7, "a", 2), ("d", 9, "c", 4), ("f", 20, "a", 4)]
    wifi_rows = _timeline(spark, [r for r in rows if r[1] != midnight - 10])
    noon = "2024-06-0{}T{}Z"
    more = [("d", noon.format(1, "23:59:50"), "a", "WIFI"), ("x", noon.format(2, "00:00:05"), "a", "BLUETOOTH"), ("x", noon.format(2, "00:00:30"), "a", "BLUETOOTH"), ("y", noon.format(4, "12:00:30"), "a", "BLUETOOTH")]
    near = spark.createDataFrame([(f"n{k}", s, t, t[:10], p, d) for k, (d, t, s, p) in enumerate(more)], "event_id string, sensor_id string, t string, event_date string, protocol string, device_id_hash string")
    near = near.withColumn("event_time", F.to_timestamp("t")).drop("t")
    timeline = wifi_rows.unionByName(near, allowMissingColumns=True).withColumn("rssi_dbm", F.length("device_id_hash") - 50).withColumn("dq_flags", F.array().cast("array<string>"))
    tables.write_table(timeline.filter("NOT (device_id_hash = 'x' AND event_id = 'n1')"), layout, "device_timeline")

    def both(as_of):
        cfg = Settings(salt="pepper", as_of=as_of)
        stored = tables.read_table(spark, layout, "device_timeline")
        return [sorted(map(str, df.collect())) for df in (flows.read_device_features(spark, layout, cfg), analytics.device_features(stored, cfg))]

    cfg = Settings(salt="pepper", as_of="2024-06-05T00:00:00Z")
    assert flows.build_feature_days(spark, layout, cfg, "2024-06-04") == ["2024-06-01", "2024-06-02"]
    assert flows.build_feature_days(spark, layout, cfg, "2024-06-05") == ["2024-06-04"]
    assert flows.build_feature_days(spark, layout, cfg, "2024-06-05") == []
    for as_of in ("2024-06-01T18:00:00Z", "2024-06-02T00:00:06Z", "2024-06-02T13:00:00Z", "2024-06-03T10:00:00Z", "2024-06-04T12:00:30Z", "2024-06-09T00:00:00Z"):
        found, wanted = both(as_of)
        assert found == wanted, as_of
    tables.write_table(timeline.filter("device_id_hash = 'x' AND event_id = 'n1'"), layout, "device_timeline")
    assert flows.build_feature_days(spark, layout, cfg, "2024-06-05", ["2024-06-02"]) == ["2024-06-02"]
    found, wanted = both("2024-06-09T00:00:00Z")
    assert found == wanted
