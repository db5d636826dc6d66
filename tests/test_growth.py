"""Work that must follow the rows and not the pairs, and sources that must be built once."""

import random
import re
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from rfsight.config import Settings
from rfsight.operators import copresence
from rfsight.operators.expectations import COPRESENCE, DROP, Expectation, ExpectationSet
from rfsight.plans import adapter
from rfsight.plans.catalogue import run

SF_DIR = "/root/testdata/sf0.001"


def sides(spark, seed, seconds, n=150):
    rng = random.Random(seed)

    def rows(tag):
        return [
            (f"{tag}{i}", rng.choice(["busy"] * 5 + ["quiet", None]), f"{tag}-{rng.randrange(5)}",
             rng.randrange(-4 * seconds, 8 * seconds) * 1_000_000 + rng.choice([0, 0, 1, -1]))
            for i in range(n)
        ]

    def frame(tag, device):
        df = spark.createDataFrame(rows(tag), f"event_id string, sensor_id string, {device} string, us bigint")
        nothing = {c: F.lit(None).cast("double") for c in ("distance_est_m", "confidence", "latitude", "longitude")}
        return df.withColumns({"event_time": F.timestamp_micros("us"), "rssi_dbm": F.lit(-50), **nothing})

    return frame("w", "bssid_hash"), frame("b", "device_address_hash")


@pytest.mark.parametrize("seed, seconds, chunk", [(1, 30, 3600), (2, 30, 7), (3, 1, 1), (4, 90, 30)])
def test_number_of_pairs_equals_pairs(spark, seed, seconds, chunk):
    wifi, bt = sides(spark, seed, seconds)
    own = Settings(salt="x", copresence_seconds=seconds, as_of="2024-01-01T00:00:00Z")
    formed = copresence.copresence_pairs(wifi, bt, own).count()
    assert copresence.pair_count(wifi, bt, own, chunk).first()["pairs"] == formed > 0
    nobody = copresence.pair_count(wifi.limit(0), bt.limit(0), own)
    assert nobody.first()["pairs"] == 0


def test_report_forms_pairs_only_for_rules_that_need_them(spark):
    wifi, bt = sides(spark, 5, 30)
    own = Settings(salt="x", as_of="2024-01-01T00:00:00Z")
    formed = COPRESENCE.report(copresence.copresence_rows(wifi, bt, own), own)
    assert copresence.copresence_report(wifi, bt, own).select(formed.columns).collect() == formed.collect()
    other = ExpectationSet.of("copresence_events", [Expectation("early", "wifi_event_id < bt_event_id", DROP)])
    line = copresence.copresence_report(wifi, bt, own, other).first()
    assert line["failed"] == formed.first()["passed"] and line["passed"] == 0


def test_gold_rules_form_no_pairs(spark):
    """Silver is read as a table, and no join is left that makes pairs."""
    text = run("rules_gold", spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "wifi_bucket" not in text and "Join" not in text


def test_pieces_of_paths_hold_one_id_each(spark):
    from rfsight.operators import analytics

    assert analytics.PATH_PIECE.simpleString().count("event_id") == 1
    rows = [(f"e{i}", "d", "WIFI", f"s{i % 3}", i * 1_800_000_000) for i in range(6)]
    steps = spark.createDataFrame(rows, "event_id string, device_id_hash string, protocol string, sensor_id string, us bigint")
    steps = steps.withColumns({"event_time": F.timestamp_micros("us"), "event_date": F.lit("1970-01-01")})
    pieces = analytics.path_pieces(steps)
    assert pieces.select(*analytics.PATH_PIECE.fieldNames()).schema.simpleString() == analytics.PATH_PIECE.simpleString()
    path = sorted(analytics.stitched(pieces).collect(), key=lambda r: r.event_id)
    assert [r.previous_sensor_id for r in path] == [None, "s0", "s1", "s2", "s0", "s1"]
    assert [r.dwell_seconds for r in path] == [1800.0] * 5 + [None]


def test_rows_are_made_once_for_all_arrivals(spark):
    from rfsight.plans import adapter, catalogue

    views = catalogue.Views(spark, SF_DIR, adapter.settings())
    made = spark.sparkContext.accumulator(0)

    def note(row):
        made.add(1)
        return row

    steps = views.timeline.select("event_id", "event_time")
    counted = spark.createDataFrame(steps.rdd.map(note), steps.schema)
    parts = catalogue.dealt(views, counted, catalogue.third(), 3)
    found = [r.event_id for part in parts for r in part.collect()]
    assert len(found) == made.value > 0 and sorted(found) == sorted(r.event_id for r in steps.collect())
    assert parts[1].columns == steps.columns


def _readings(spark, side, device, confidences, copies):
    """Three devices on two sensors over some minutes, each reading ``copies`` times with confidences in turn."""
    rows = [
        (f"{side}{i}-{k}", f"s{i % 2}" if i % 11 else None, f"{side}-{i % 3}" if i % 7 else None, i * 17_000_000,
         confidences[(i + k) % len(confidences)])
        for i in range(24) for k in range(copies)
    ]
    df = spark.createDataFrame(rows, f"event_id string, sensor_id string, {device} string, us bigint, confidence double")
    nothing = {c: F.lit(None).cast("double") for c in ("distance_est_m", "latitude", "longitude")}
    return df.withColumns({"event_time": F.timestamp_micros("us"), "rssi_dbm": F.lit(-50), **nothing})


@pytest.mark.parametrize("wifi_odd, bt_odd", [(False, False), (True, False), (False, True), (True, True)])
def test_links_of_classes_equal_links_of_pairs(spark, wifi_odd, bt_odd):
    """Confidences finer than a five-hundredth round pair by pair, on either side or both."""
    from rfsight.operators import analytics

    plain, fine = [0.0, 0.29, None, 0.57, 1.5], [0.333, 0.1235, 0.0004]
    own = Settings(salt="x", as_of="2024-01-01T00:00:00Z")
    wifi = _readings(spark, "w", "bssid_hash", plain + fine * wifi_odd, 5)
    bt = _readings(spark, "b", "device_address_hash", plain[::-1] + fine[1:] * bt_odd, 4)
    formed = analytics.entity_links(copresence.copresence_events(wifi, bt, own))
    counted = analytics.class_links(wifi, bt, own)
    assert counted.columns == formed.columns
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, formed.collect())) != []


def test_copies_of_a_sighting_meet_once(spark):
    """However many copies there are, and whatever their confidences, the rows that meet are as many as without them."""
    own, met = Settings(salt="x", as_of="2024-01-01T00:00:00Z"), []
    for copies in (1, 40):
        sides = (_readings(spark, t, d, [k / 100 for k in range(30)], copies) for t, d in (("w", "bssid_hash"), ("b", "device_address_hash")))
        evidence = copresence.link_evidence(*copresence.stored_classes(*sides), own)
        met.append((evidence.count(), evidence.agg(F.sum("pair_count")).first()[0]))
    assert met[0][0] == met[1][0] == met[0][1] and met[1][1] == 1600 * met[0][1]


@pytest.mark.parametrize("name", ["entity_links", "entity_clusters", "entity_clusters_stream"])
def test_links_form_no_events(spark, name, monkeypatch):
    from rfsight.plans import medallion

    def no_events(*_):
        raise AssertionError("a row per pair")

    monkeypatch.setattr(medallion, "copresence_events", no_events)
    assert run(name, spark, SF_DIR) is not None


def _silver(spark, layout, copies):
    """Silver tables of both protocols with each sighting ``copies`` times, ids apart."""
    from rfsight.contracts import contract
    from rfsight.sources import tables

    sides = (("wifi", "bssid_hash"), ("bt", "device_address_hash"))
    for protocol, device in sides:
        rows = _readings(spark, protocol[0], device, [0.5, None, 0.25], copies).withColumn("event_date", F.lit("1970-01-01"))
        rows = spark.createDataFrame([], contract(f"{protocol}_silver")).unionByName(rows.drop("us"), allowMissingColumns=True)
        tables.write_table(rows, layout, f"{protocol}_silver")
    return [tables.read_table(spark, layout, f"{p}_silver") for p, _ in sides]


def test_stored_copresence_follows_instants(spark, tmp_path):
    """Copies of sightings add pairs, but no row to what the stream stores; readers and the log have every pair."""
    from rfsight.sources import tables
    from rfsight.sources.tables import Layout
    from rfsight.streaming import flows, metrics

    own, layout, stored = Settings(salt="x", as_of="1970-01-01T01:00:00Z"), Layout(str(tmp_path)), []
    for copies in (1, 9):  # the second trigger repeats all instants, with one known id each
        wifi, bt = _silver(spark, layout, copies)
        flows.run_copresence(spark, layout, own, 2)
        stored.append(tables.read_table(spark, layout, "copresence_instants").count())
        formed = copresence.copresence_events(wifi, bt, own)
        events = tables.read_table(spark, layout, "copresence_events")
        assert events.columns == formed.columns
        assert sorted(map(str, events.collect())) == sorted(map(str, formed.collect()))
        log = metrics.read_log(spark, layout).agg(F.sum("passed")).first()[0]
        assert log == formed.count() == (1 if copies == 1 else 100) * stored[0]
    assert stored[0] == stored[1] > 0
    assert not tables.exists(spark, layout.table("copresence_events"))
    with pytest.raises(ValueError, match="rows=True"):
        tables.read_table(spark, layout, "copresence_events", streaming=True)


def test_copresence_as_rows_for_streams(spark, tmp_path):
    from rfsight.sources import tables
    from rfsight.sources.tables import Layout
    from rfsight.streaming import flows

    own, layout = Settings(salt="x", as_of="1970-01-01T01:00:00Z"), Layout(str(tmp_path))
    formed = copresence.copresence_events(*_silver(spark, layout, 2), own)
    flows.run_copresence(spark, layout, own, 2, rows=True)
    events = tables.read_table(spark, layout, "copresence_events")
    assert sorted(map(str, events.collect())) == sorted(map(str, formed.collect())) != []
    assert tables.read_table(spark, layout, "copresence_events", streaming=True).isStreaming
    with pytest.raises(ValueError, match="by rows"):
        flows.run_copresence(spark, layout, own, 2)


def test_wide_rows_are_not_made_by_a_method_that_stays_interpreted(spark):
    """HotSpot compiles no method over 8000 bytes; the rows of a landing table would make one as a single stage."""
    rows = adapter.wifi_landing(spark, SF_DIR)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    text = rows._jdf.queryExecution().explainString(mode)
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) > 8000
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def _minutes(spark, side, device, n, gap):
    """``n`` sightings of one sensor, each at an instant of its own."""
    rows = [(f"{side}{i}", "s", f"{side}-{i % 3}", 7_000_000 + i * gap) for i in range(n)]
    df = spark.createDataFrame(rows, f"event_id string, sensor_id string, {device} string, us bigint")
    nothing = {c: F.lit(None).cast("double") for c in ("distance_est_m", "latitude", "longitude", "confidence")}
    return df.withColumns({"event_time": F.timestamp_micros("us"), "rssi_dbm": F.lit(-50), **nothing})


def test_cells_do_not_grow_with_instants(spark):
    """Ten times the sightings of some minutes, none at the time of another: 100 times the pairs, the same cells."""
    own, stored, formed = Settings(salt="x", as_of="2024-01-01T00:00:00Z"), [], []
    for n in (30, 300):
        wifi = _minutes(spark, "w", "bssid_hash", n, 120_000_000 // n)
        bt = _minutes(spark, "b", "device_address_hash", n, 119_000_000 // n)
        cells = copresence.copresence_cells(wifi, bt, own)
        events, pairs = copresence.events_of_cells(cells, wifi, bt), copresence.copresence_events(wifi, bt, own)
        assert sorted(map(str, events.collect())) == sorted(map(str, pairs.collect()))
        stored.append(cells.count())
        formed.append(pairs.count())
    assert stored[0] == stored[1] <= 5 and formed[1] > 90 * formed[0] > 0


def test_a_pair_is_as_old_as_its_younger_sighting(spark):
    own, wifi, bt = Settings(salt="x", as_of="2024-01-01T00:00:00Z"), *(
        _minutes(spark, s, d, 4, 5_000_000) for s, d in (("w", "bssid_hash"), ("b", "device_address_hash"))
    )
    cells = copresence.copresence_cells(wifi, bt, own)
    # the last Wi-Fi row came a day later, the first two Bluetooth rows are of a history that has no members
    later, at = F.expr("TIMESTAMP '2024-01-02T00:00:00Z'"), own.now
    came = [wifi.withColumns({"is_wifi": F.lit(True), "ingest_time": F.when(F.col("event_id") == "w3", later).otherwise(at)})]
    came.append(bt.filter("event_id > 'b1'").withColumns({"is_wifi": F.lit(False), "ingest_time": at}))
    members = came[0].select("sensor_id", "event_time", "is_wifi", "ingest_time").unionByName(
        came[1].select("sensor_id", "event_time", "is_wifi", "ingest_time")
    )
    events = copresence.events_of_cells(cells, wifi, bt, members).collect()
    assert len(events) == 16
    assert {r.wifi_event_id: r.ingest_time.day for r in events} == {"w0": 1, "w1": 1, "w2": 1, "w3": 2}


def test_a_batch_stores_copresence_by_cells(spark, tmp_path):
    from rfsight.plans import medallion
    from rfsight.sources import tables
    from rfsight.sources.tables import Layout

    layout, own, written = Layout(str(tmp_path)), Settings(salt="x", as_of="1970-01-01T01:00:00Z"), {}
    silver = dict(zip(("wifi_silver", "bt_silver"), _silver(spark, layout, 3)))
    empty = {p: spark.createDataFrame([], tables.contract(f"{p}_bronze")) for p in ("wifi", "bt")}

    def write(rows, name):
        if not name.endswith("silver"):
            tables.write_table(rows, layout, name)
            written[name] = rows.columns

    def read(name):
        if name in silver:
            return silver[name]
        return empty[name.removesuffix("_bronze")] if name.endswith("_bronze") else tables.read_table(spark, layout, name)

    medallion._build(own, read, write)
    assert "copresence_cells" in written and "copresence_instants" not in written
    formed = copresence.copresence_events(silver["wifi_silver"], silver["bt_silver"], own)
    events = tables.read_table(spark, layout, "copresence_events")
    assert sorted(map(str, events.collect())) == sorted(map(str, formed.collect())) != []


def test_flows_side_by_side(spark, tmp_path):
    """All run to their end, a failure comes out, and lines that are logged at once are all there."""
    from rfsight.sources.tables import Layout
    from rfsight.streaming import flows, metrics

    layout, gate, done = Layout(str(tmp_path)), Barrier(2, timeout=60), []

    def log(k):
        gate.wait()
        report = {"observedMetrics": {"copresence_events": {"rows_seen": k, "valid_copresence_id": 0}}, "runId": "r", "batchId": k}
        metrics.append_log(spark, layout, [report], COPRESENCE, "copresence_events")
        done.append(k)

    flows._side_by_side(lambda: log(1), lambda: log(2))
    assert sorted(done) == [1, 2]
    assert metrics.read_log(spark, layout).agg(F.sum("passed")).first()[0] == 3
    with pytest.raises(ZeroDivisionError):
        flows._side_by_side(lambda: 1 / 0, lambda: done.append(3))
    assert 3 in done


def test_links_are_counted_where_pairs_are_formed(spark, monkeypatch):
    """Many tiles, a few pairs at a time, and no exchange above the rows that two blocks make."""
    from rfsight.operators import analytics, tiles

    own = Settings(salt="x", as_of="2024-01-01T00:00:00Z")
    wifi = _readings(spark, "w", "bssid_hash", [0.0, 0.29, None, 0.333, 0.1235], 5).filter("event_id <> 'w1-0'")
    bt = _readings(spark, "b", "device_address_hash", [0.57, 0.0004, None, 1.5], 4)
    formed = sorted(map(tuple, analytics.entity_links(copresence.copresence_events(wifi, bt, own)).collect()))
    monkeypatch.setattr(tiles, "BLOCK_ROWS", 20)
    counted = analytics.class_links(wifi, bt, own)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "wifi_bucket" not in plan and plan.index("FlatMapCoGroupsInArrow") < plan.index("Repartition")
    assert "Aggregate" not in plan[: plan.index("FlatMapCoGroupsInArrow")]
    assert sorted(map(tuple, counted.collect())) == formed != []
    least = max(r[2] for r in formed)
    strong = analytics.class_links(wifi, bt, own, least).collect()
    assert sorted(map(tuple, strong)) == [r for r in formed if r[2] >= least] != formed


def test_a_tile_forms_its_pairs_in_parts(monkeypatch):
    import pyarrow as pa

    from rfsight.operators import tiles

    rng = random.Random(3)

    def side(tag):
        rows = [(rng.choice("st"), rng.randrange(200) * 1_000_000, f"{tag}{rng.randrange(4)}", rng.randrange(1, 4), rng.randrange(500))
                for _ in range(80)]
        return pa.table(list(map(list, zip(*rows))) + [[0.0] * 80, [tiles.WHOLE] * 80], names=["sensor", "us", "device", "n", "units", "confidence", "kind"])

    left, right = side("w"), side("b")
    whole = tiles._linked(30_000_000, 1)(left, right)
    monkeypatch.setattr(tiles, "PAIRS_AT_ONCE", 7)
    assert tiles._linked(30_000_000, 1)(left, right).to_pylist() == whole.to_pylist()
    met = [(w, b) for w in left.to_pylist() for b in right.to_pylist() if w["sensor"] == b["sensor"] and abs(w["us"] - b["us"]) <= 30_000_000]
    assert sum(whole["pair_count"].to_pylist()) == sum(w["n"] * b["n"] for w, b in met) > 0
    assert sum(whole["score_millis"].to_pylist()) == sum(w["units"] * b["n"] + b["units"] * w["n"] for w, b in met)
    assert len(whole) == len({(w["device"], b["device"]) for w, b in met})
    assert tiles._linked(30_000_000, 1)(left, right.slice(0, 0)).num_rows == 0


def test_scores_round_as_sql_does(spark):
    import numpy as np

    from rfsight.operators import tiles

    rng = random.Random(4)
    values = [k / 2000 for k in range(-7, 60)] + [0.0005, 0.0015, 1.0005, 2.6755, -0.4995] + [rng.uniform(-2, 2) for _ in range(40)]
    pairs = [(a, b) for a in values for b in rng.sample(values, 40)]
    rows = spark.createDataFrame(pairs, "wifi double, bt double")
    found = rows.select("wifi", "bt", F.round(copresence._score("wifi", "bt") * 1000).cast("bigint").alias("m")).toPandas()
    assert (tiles.rounded_millis(found["wifi"].to_numpy(), found["bt"].to_numpy()) == found["m"].to_numpy(dtype="int64")).all()
    assert np.array_equal(tiles.rounded_millis(np.array([1e12]), np.array([1e12])), [10**15])


def test_tables_hold_hex_in_half_its_size(spark, tmp_path):
    from rfsight.sources import tables
    from rfsight.sources.tables import Layout

    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("event_id"), F.lit("2024-01-01").alias("event_date"))
    rows = spark.createDataFrame([], tables.contract("bt_silver")).unionByName(rows, allowMissingColumns=True)
    layout = Layout(str(tmp_path))
    tables.write_table(rows, layout, "bt_silver")
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert size < 0.75 * 64 * 20_000
    assert tables.read_table(spark, layout, "bt_silver").exceptAll(rows).isEmpty()
