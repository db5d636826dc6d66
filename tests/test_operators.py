"""Operators on small frames, compared with brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rfsight.config import Settings
from rfsight.contracts import ContractError, conform
from rfsight.operators import analytics, expectations, lookup, outbox
from rfsight.operators.clusters import entity_clusters
from rfsight.operators.copresence import copresence_counts, copresence_pairs
from rfsight.operators.dedup import dedup_batch
from rfsight.operators.expectations import DROP, FAIL, WARN, Expectation, ExpectationSet

_WIFI_SIDE = (
    "event_id string, sensor_id string, us bigint, bssid_hash string, rssi_dbm int, distance_est_m double, "
    "confidence double, latitude double, longitude double"
)
_BT_SIDE = (
    "event_id string, sensor_id string, us bigint, device_address_hash string, rssi_dbm int, "
    "distance_est_m double, confidence double"
)


def _timed(df):
    return df.withColumn("event_time", F.timestamp_micros("us")).drop("us")


@pytest.mark.parametrize("seed, seconds, salts", [(1, 30, 1), (2, 30, 5), (3, 1, 1), (4, 60, 3), (5, 7, 2)])
def test_bucketed_interval_join_equals_brute_force(spark, seed, seconds, salts):
    """One sensor holds most rows; times include exact window edges and instants before 1970."""
    rng = random.Random(seed)

    def rows(n, tag):
        out = []
        for i in range(n):
            sensor = rng.choice(["busy"] * 6 + ["quiet", None])
            grid = rng.choice([seconds * 1_000_000, 1_000_000, 1])
            us = rng.randrange(-4 * seconds, 8 * seconds) * 1_000_000 // grid * grid + rng.choice([0, 0, 1, -1])
            out.append((f"{tag}{i}", sensor, us))
        return out

    left, right = rows(150, "w"), rows(120, "b")
    wifi = _timed(spark.createDataFrame([(*r, "h", -50, 1.0, 0.5, 1.0, 2.0) for r in left], _WIFI_SIDE))
    bt = _timed(spark.createDataFrame([(*r, "g", -50, 1.0, 0.5) for r in right], _BT_SIDE))
    expected = Counter(
        (w[0], b[0])
        for w in left
        for b in right
        if w[1] is not None and w[1] == b[1] and abs(w[2] - b[2]) <= seconds * 1_000_000
    )
    pairs = copresence_pairs(wifi, bt, Settings(salt="x", copresence_seconds=seconds), salts)
    found = Counter((r.wifi_event_id, r.bt_event_id) for r in pairs.collect())
    assert found == expected and max(found.values()) == 1


@pytest.mark.parametrize("seed, seconds, chunk", [(1, 30, 3600), (2, 30, 7), (3, 1, 1), (4, 90, 30)])
def test_counting_pairs_equals_forming_them(spark, seed, seconds, chunk):
    rng = random.Random(seed)
    rows = [
        (f"e{i}", rng.choice(["p", "q", "r", None]), rng.choice(["busy"] * 5 + ["quiet", None]),
         rng.choice(["WIFI", "BLUETOOTH"]), rng.randrange(-5 * seconds, 9 * seconds) * 1_000_000 + rng.choice([0, 0, 1, -1]))
        for i in range(250)
    ]
    expected = Counter()
    for _, device, sensor, protocol, us in rows:
        if device and sensor:
            expected[device] += sum(
                1 for r in rows if r[2] == sensor and r[3] != protocol and abs(r[4] - us) <= seconds * 1_000_000
            )
    schema = "event_id string, device_id_hash string, sensor_id string, protocol string, us bigint"
    timeline = _timed(spark.createDataFrame(rows, schema))
    counts = copresence_counts(timeline, Settings(salt="x", copresence_seconds=seconds), chunk)
    assert {r.device_id_hash: r.copresence_count for r in counts.collect()} == +expected


def test_dedup_keeps_earliest_and_is_stable(spark):
    rows = [("k", 2, "a", 9), ("k", 1, "b", 7), ("k", 1, "a", 8), ("j", 5, "z", 1)]
    df = spark.createDataFrame(rows, "event_id string, ingest_time int, source_path string, v int")
    for partitions in (1, 4):
        kept = dedup_batch(df.repartition(partitions)).collect()
        assert sorted((r.event_id, r.v) for r in kept) == [("j", 1), ("k", 8)]


def _timeline(spark, rows):
    """rows: (event_id, device, sensor, seconds, rssi)"""
    df = spark.createDataFrame(rows, "event_id string, device_id_hash string, sensor_id string, s double, rssi_dbm int")
    return df.select(
        "*",
        F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint")).alias("event_time"),
        F.lit("WIFI").alias("protocol"),
        F.lit(1.0).alias("latitude"),
        F.lit(2.0).alias("longitude"),
        F.array().cast("array<string>").alias("dq_flags"),
    ).withColumn("event_date", F.to_date("event_time").cast("string"))


@pytest.mark.parametrize("chunk_hours", [1, 24])
def test_movement_history_equals_one_window_per_device(spark, chunk_hours):
    rng = random.Random(7)
    rows = [
        (f"e{i:03d}", rng.choice(["hot"] * 5 + ["cold", None]), rng.choice("abc"), float(rng.randrange(0, 90_000, 10)), -50)
        for i in range(300)
    ]
    expected = {}
    for device in ("hot", "cold"):
        path = sorted((r for r in rows if r[1] == device), key=lambda r: (r[3], r[0]))
        for i, r in enumerate(path):
            before = path[i - 1] if i else None
            after = path[i + 1] if i + 1 < len(path) else None
            expected[r[0]] = (
                before and before[2],
                before and before[2] != r[2],
                after and after[3] - r[3],
            )
    history = analytics.movement_history(_timeline(spark, rows), chunk_hours).collect()
    assert {r.event_id: (r.previous_sensor_id, r.moved, r.dwell_seconds) for r in history} == expected


def test_directional_movement_counts_equal_readings(spark):
    rows = [("1", "d", "a", 1.0, -50), ("2", "d", "a", 2.0, -50), ("3", "d", "b", 3.0, -60), ("4", "d", "a", 31.0, -50)]
    (row,) = analytics.directional_movement(_timeline(spark, rows)).collect()
    assert (row.reading_count, row.sensor_count) == (3, 2)
    assert [(r.sensor_id, r.n) for r in row.sensor_readings] == [("a", 2), ("b", 1)]
    assert analytics.directional_movement(_timeline(spark, rows), min_sensors=3).count() == 0


def test_novel_and_unseen_devices(spark):
    old = _timeline(spark, [("0", "known", "a", 1.0, -50), ("z", None, "a", 1.0, -50)])
    new = _timeline(
        spark, [("1", "known", "a", 5.0, -50), ("2", "fresh", "a", 6.0, -50), ("3", "fresh", "b", 6.0, -50),
                ("4", "fresh", "a", 7.0, -50), ("5", None, "a", 1.0, -50)]
    )
    assert sorted(r.event_id for r in lookup.novel_device(new).collect()) == ["1", "2", "3"]
    assert sorted(r.event_id for r in lookup.unseen_in(new, old).collect()) == ["2", "3", "4"]


def _links(spark, edges):
    return spark.createDataFrame(
        [(a, b, n, 0.9) for a, b, n in edges],
        "wifi_device_hash string, bt_device_hash string, pair_count bigint, mean_score double",
    )


def _components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("shape", ["path", "sorted path", "star", "random"])
def test_clusters_equal_union_find(spark, shape):
    rng = random.Random(3)
    if shape.endswith("path"):
        order = list(range(100)) if shape == "sorted path" else rng.sample(range(100), 100)
        edges = [(f"n{order[i]:03d}", f"n{order[i + 1]:03d}") for i in range(99)]
    elif shape == "star":
        edges = [("hub", f"leaf{i}") for i in range(60)] + [("x", "y")]
    else:
        edges = [(f"w{rng.randrange(60)}", f"b{rng.randrange(60)}") for _ in range(45)]
    weak = [("n000", "hub", 1)]
    links = _links(spark, [(a, b, 5) for a, b in edges] + weak)
    found = {r.device_id_hash: r.cluster_id for r in entity_clusters(links, min_pairs=2).collect()}
    assert found == _components(edges)


def test_expectations_warn_drop_fail(spark, settings):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    rules = ExpectationSet.of("t", [Expectation("small", "x < 3", WARN), Expectation("there", "x IS NOT NULL", DROP)])
    assert sorted(r.x for r in rules.enforce(df, settings).collect()) == [1, 5]
    lines = {r.expectation: (r.failed, r.passed) for r in rules.report(df, settings).collect()}
    assert lines == {"small": (2, 1), "there": (1, 2)}
    broken = {r.x: r.violations for r in rules.violations(df, settings).collect()}
    assert broken == {1: [], 5: ["small"], None: ["small", "there"]}
    strict = ExpectationSet.of("t", [Expectation("small", "x < 3", FAIL)])
    with pytest.raises(Exception, match="expectation small violated"):
        strict.enforce(df, settings).collect()
    assert strict.enforce(df.filter("x = 1"), settings).count() == 1


def test_observed_metrics_need_no_second_pass(spark, settings):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    rules = ExpectationSet.of("t", [Expectation("there", "x IS NOT NULL", DROP)])
    seen = Observation("t")
    assert rules.enforce(df, settings, seen).count() == 2
    assert seen.get == {"rows_seen": 3, "there": 1}


def test_every_silver_rule_matches_its_declared_action():
    names = [r.name for r in expectations.SILVER["wifi"].rules if r.action == DROP]
    assert names == ["valid_event_id", "valid_sensor_id", "valid_event_time", "event_not_ancient"]
    assert len(expectations.SILVER["wifi"].rules) == 9 and len(expectations.SILVER["bt"].rules) == 8


def test_conform_refuses_drift(spark):
    good = spark.createDataFrame([], "event_time timestamp, sensor_id string, _rescued_data string")
    with pytest.raises(ContractError, match="ingest_time: expected timestamp, found nothing"):
        conform(good, "wifi_quarantine")
    with pytest.raises(ContractError, match="sensor_id: expected string, found int"):
        conform(good.withColumn("sensor_id", F.lit(1)), "quarantine")


def test_outbox_queue(spark):
    rows = [(i, "wifi" if i % 2 else "bt", None if i % 3 else "2024-01-01") for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, protocol string, uploaded_at string")
    batch = outbox.next_batch(df, 3).orderBy("protocol", "id").collect()
    assert [(r.protocol, r.id) for r in batch] == [("bt", 2), ("bt", 4), ("bt", 8), ("wifi", 1), ("wifi", 5), ("wifi", 7)]


def test_manufacturer_table_of_the_caller(spark):
    bt = spark.createDataFrame([(6, None), (1, None), (None, None)], "manufacturer_id int, manufacturer_name string")
    dim = spark.createDataFrame([(1, "Own")], "manufacturer_id int, name string")
    assert sorted(map(tuple, lookup.resolve_manufacturer(bt).collect()), key=str) == [(1, None), (6, "Microsoft"), (None, None)]
    assert (1, "Own") in set(map(tuple, lookup.resolve_manufacturer(bt, dim).collect()))
