"""One parse for all sinks of a micro-batch, late rows as a table, and what streams hold between triggers."""

import json

import pytest
from pyspark.sql import functions as F
from rows import at, bt, wifi, write_lines

from rfsight.config import Settings
from rfsight.sources import landing, tables
from rfsight.sources.tables import Layout
from rfsight.streaming import arrivals, flows, metrics


@pytest.fixture
def cfg():
    return Settings(salt="pepper", as_of="2024-06-01T22:00:00Z", run_id="test")


def _ids(df):
    return sorted(r[0] for r in df.select("message_id").collect())


@pytest.mark.parametrize("protocol", ["wifi", "bt"])
def test_kept_and_late_rows_are_what_has_arrived(spark, tmp_path, cfg, protocol):
    """Three triggers of two micro-batches each; delays are two hours (Wi-Fi) and one (Bluetooth)."""
    row, layout, hour = {"wifi": wifi, "bt": bt}[protocol], Layout(str(tmp_path)), 3600
    folder, sent, late = tmp_path / "landing" / protocol, [], set()

    def arrive(name, *hours):
        rows = [row(message_id=f"{name}-{h}", event_time=at(h * hour)) for h in hours]
        sent.extend(r["message_id"] for r in rows)
        faults = [json.dumps(row(message_id=f"{name}-odd"))[:-1] + ', "firmware": 3}', '{"cut']
        write_lines(folder, name, [*rows, rows[0], *(faults if name == "a1" else [])])

    for k, (first, second) in enumerate((((0, 0.5), (4,)), ((1.5, 3.5), (0.25, 4.5)), ((2.75, 6), (4.6, 3)))):
        arrive(f"a{k}", *first)
        arrive(f"b{k}", *second)
        arrivals.run_arrivals(spark, layout, protocol, cfg, maxFilesPerTrigger=1)
        arrivals.run_timely_silver(spark, layout, protocol, cfg, 2, maxFilesPerTrigger=1)
    stored = tables.read_table(spark, layout, f"{protocol}_late")
    late = set(_ids(stored))
    silver = _ids(tables.read_table(spark, layout, f"{protocol}_silver"))
    assert len(silver) == len(set(silver)) and not late & set(silver)
    assert sorted(late | set(silver)) == sorted({*sent, "a1-odd"})
    # latest times before the batches: none, 0.5, 4, 4, 4.5, 6
    by_hand = {"a1-1.5", "b1-0.25", "b2-3", "a1-odd"} if protocol == "wifi" else {"a1-1.5", "b1-0.25", "a2-2.75", "b2-4.6", "b2-3", "a1-odd"}
    assert late == by_hand and {r["layer"] for r in stored.collect()} == {"watermark"}
    held = tables.read_table(spark, layout, f"{protocol}_quarantine").select("_rescued_data").collect()
    assert sorted(r[0] for r in held) == ['{"cut', '{"firmware":"3"}']
    log = metrics.read_log(spark, layout).filter(f"table_name = '{protocol}_bronze' AND expectation = 'valid_event_time'")
    assert log.agg(F.sum("passed")).first()[0] == len(sent) + 6 + 1


def test_layers_of_age(spark, tmp_path):
    cfg = Settings(salt="pepper", as_of="2024-06-10T00:00:00Z", bronze_late_days=7, late_drop_days=3)
    times = {"old": "2024-06-02T00:00:00Z", "aged": "2024-06-05T00:00:00Z", "new": "2024-06-09T00:00:00Z", "none": None}
    write_lines(tmp_path / "landing" / "bt", "a", [bt(message_id=k, event_time=t) for k, t in times.items()])
    layout = Layout(str(tmp_path))
    arrivals.run_arrivals(spark, layout, "bt", cfg)
    arrivals.run_timely_silver(spark, layout, "bt", cfg, 2)
    late = tables.read_table(spark, layout, "bt_late")
    assert sorted((r["message_id"], r["layer"]) for r in late.collect()) == [("aged", "silver"), ("old", "bronze")]
    assert _ids(tables.read_table(spark, layout, "bt_silver")) == ["new"]


def test_a_batch_run_again_changes_nothing_and_is_parsed_once(spark, tmp_path, cfg):
    layout = Layout(str(tmp_path / "t"))
    write_lines(tmp_path / "in", "a", [wifi(message_id=str(k), event_time=at(k)) for k in range(5)])
    rows = landing.read_landing(spark, str(tmp_path / "in"), "wifi", cfg)
    # a value that is another one whenever the rows are computed
    rows = rows.withColumn("_rescued_data", F.expr("uuid()"))
    sinks = arrivals.Arrivals(spark, layout, "wifi", cfg)
    values = []
    for _ in range(3):
        sinks.store(rows, 0)
        pair = [tables.read_table(spark, layout, f"wifi_{kind}") for kind in ("bronze", "quarantine")]
        values.append([sorted(r[0] for r in df.select("_rescued_data").collect()) for df in pair])
    assert values[0][0] == values[0][1] and values == values[:1] * 3 and len(values[0][0]) == 5
    # a sink that was cut short is written again, the others are left
    (tmp_path / "t" / "tables" / "wifi_quarantine" / "batch_id=0" / "_SUCCESS").unlink()
    sinks.store(rows, 0)
    assert tables.read_table(spark, layout, "wifi_bronze").count() == tables.read_table(spark, layout, "wifi_quarantine").count() == 5


def test_join_state_falls_behind_the_watermark(spark, tmp_path, cfg):
    layout, seen = Layout(str(tmp_path)), []
    for name, start in (("a", 0), ("b", 3600), ("c", 6 * 3600)):
        for protocol, row in (("wifi", wifi), ("bt", bt)):
            rows = [row(message_id=f"{name}{k}", event_time=at(start + 60 * k)) for k in range(10)]
            write_lines(tmp_path / "landing" / protocol, name, rows)
            flows.run_bronze(spark, layout, protocol, cfg)
            flows.run_silver(spark, layout, protocol, cfg, 2)
        flows.run_copresence(spark, layout, cfg, 2)
        seen.append([flows.state_rows(spark, layout, "copresence_events", 2, joinSide=side).count() for side in ("left", "right")])
    # the last trigger's watermark is 16:09, past all rows of the first two; a Wi-Fi row stands in two or three buckets
    assert seen[0][1] == 10 and seen[1][1] == 20 and seen[2][1] == 10
    assert seen[0][0] < seen[1][0] and seen[2][0] == seen[0][0]
    assert tables.read_table(spark, layout, "copresence_events").count() == 30


def test_hours_come_out_once_when_closed(spark, tmp_path, cfg):
    layout = Layout(str(tmp_path))
    for k in range(4):
        rows = [(f"d{i % 2}", "WIFI", at(5400 * k + 60 * i), "2024-06-01") for i in range(6)]
        df = spark.createDataFrame(rows, "device_id_hash string, protocol string, t string, event_date string")
        df.selectExpr("*", "to_timestamp(t) AS event_time").drop("t").write.mode("append").partitionBy("event_date", "protocol").parquet(layout.table("device_timeline"))
        flows.run_sighting_frequency(spark, layout, cfg, 2)
    stream = spark.read.parquet(layout.table("sighting_frequency"))
    batch = flows.hourly_counts(tables.read_table(spark, layout, "device_timeline"), ["device_id_hash", "protocol"], "event_time", "0 seconds", "sighting_count")
    closed = batch.filter("hour_start < timestamp '2024-06-01T14:00:00Z'")
    assert sorted(map(str, stream.collect())) == sorted(map(str, closed.select(*stream.columns).collect())) and closed.count() == 4


def test_a_trigger_of_silver_visits_its_state_once(spark, tmp_path, cfg):
    layout = Layout(str(tmp_path))
    for k in range(3):
        sent = [wifi(message_id=f"{k}-{i}", event_time=at(18000 * k + 60 * i)) for i in range(5)]
        # copies of the last row of each trigger before: in time and held still, or late
        again = [wifi(message_id=f"{j}-4", event_time=at(18000 * j + 240)) for j in range(k)]
        write_lines(tmp_path / "landing" / "wifi", f"a{k}", [*sent, sent[0], *again])
        arrivals.run_arrivals(spark, layout, "wifi", cfg)
        arrivals.run_timely_silver(spark, layout, "wifi", cfg, 2)
        done = (tmp_path / "checkpoints" / "wifi_silver" / "commits").iterdir()
        assert len([f for f in done if f.name.isdigit()]) == k + 1
        # ids of the trigger before are dropped with this one's rows: the state does not grow
        held = flows.state_rows(spark, layout, "wifi_silver", 2).count()
        assert held == (5 if k == 0 else 10)
    assert _ids(tables.read_table(spark, layout, "wifi_silver")) == sorted(f"{k}-{i}" for k in range(3) for i in range(5))
    assert _ids(tables.read_table(spark, layout, "wifi_late")) == ["0-4"]
