"""Column functions on literal inputs."""

import hashlib

import pytest
from pyspark.sql import functions as F

from rfsight.config import Settings
from rfsight.functions import address, signal, tags, vocabulary
from rfsight.functions.identity import event_key, hash_identifier, vendor_oui


def values(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    "label, mhz, expected",
    [
        ("2.4", None, "2.4GHz"), (" 2 ", None, "2.4GHz"), ("2.4GHZ", 5180, "2.4GHz"),
        ("5GHz", None, "5GHz"), ("6", None, "6GHz"), (None, 2400, "2.4GHz"), (None, 2500, "2.4GHz"),
        (None, 2501, None), (None, 5170, "5GHz"), ("n/a", 5835, "5GHz"), (None, 5924, None),
        ("", 7125, "6GHz"), (None, None, None),
    ],
)
def test_band(spark, label, mhz, expected):
    assert values(spark, "band string, frequency_mhz int", [(label, mhz)], vocabulary.band()) == [expected]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("WPA2", "WPA2"), ("wpa2/psk", "WPA2"), ("WPA2-Enterprise", "WPA2"), ("WPA2/WPA3", "WPA3"),
        ("wpa", "WPA"), (" wep ", "WEP"), ("", "OPEN"), ("none", "OPEN"), ("Open", "OPEN"),
        ("TKIP", "UNKNOWN"), (None, "UNKNOWN"),
    ],
)
def test_encryption(spark, text, expected):
    assert values(spark, "encryption string", [(text,)], vocabulary.encryption()) == [expected]


@pytest.mark.parametrize(
    "rssi, metres", [(-40, 1.0), (-60, 10.0), (-100, 1000.0), (-101, None), (-110, None), (5, None), (None, None)]
)
def test_wifi_distance(spark, rssi, metres):
    (found,) = values(spark, "rssi_dbm int", [(rssi,)], signal.distance_wifi())
    assert found == pytest.approx(metres) if metres is not None else found is None


@pytest.mark.parametrize(
    "rssi, tx, metres",
    [(-59, -59, 1.0), (-59, None, 1.0), (-79, None, 10.0), (-65, 4, 2818.38), (1, 0, None), (-60, 21, None), (None, 4, None)],
)
def test_ble_distance(spark, rssi, tx, metres):
    assert values(spark, "rssi_dbm int, tx_power int", [(rssi, tx)], signal.distance_ble()) == [metres]


def test_path_loss(spark):
    rows = [(4, -67), (None, -67), (4, None), (2147483647, -1)]
    assert values(spark, "tx_power int, rssi_dbm int", rows, signal.path_loss()) == [71, None, None, None]


def test_confidence_rounds_like_the_scanner(spark):
    strengths = list(range(-140, 30))
    expected = [round(min(1.0, max(0.3, (r + 100) / 80)), 3) for r in strengths]
    assert values(spark, "rssi_dbm int", [(r,) for r in strengths], signal.ble_confidence()) == expected


def test_hash_ignores_notation_and_keeps_null(spark):
    rows = [("AA-BB-CC-DD-EE-FF",), ("aabb.ccdd.eeff",), ("aa:bb:cc:dd:ee:ff",), (None,)]
    expected = hashlib.sha256(b"aabbccddeeffpepper").hexdigest()
    assert values(spark, "m string", rows, hash_identifier("m", "wifi", "pepper")) == [expected] * 3 + [None]
    spaced = [("aa bb cc dd ee ff",)]
    assert values(spark, "m string", spaced, hash_identifier("m", "bt", "pepper")) == [expected]
    assert values(spark, "m string", spaced, hash_identifier("m", "wifi", "pepper")) != [expected]


@pytest.mark.parametrize(
    "mac, flag", [("02:ab", True), ("aa:bb", True), ("AE-01", True), ("11:22", False), ("zz:11", False), (None, None)]
)
def test_randomized_mac(spark, mac, flag):
    assert values(spark, "bssid string", [(mac,)], address.is_randomized_mac()) == [flag]


@pytest.mark.parametrize(
    "addr, reported, flag",
    [
        ("c0:11", None, True), ("f8:27", None, False), ("a4:00", None, True), ("f8:27", True, True),
        ("c0:11", False, False), (None, True, None), ("zz", None, False),
    ],
)
def test_randomized_address(spark, addr, reported, flag):
    schema = "device_address string, address_randomized boolean"
    assert values(spark, schema, [(addr, reported)], address.is_randomized_address()) == [flag]


def test_address_class_uses_the_top_bits(spark):
    rows = [("f8:27",), ("c0:11",), ("4a:00",), ("3f:00",), ("80:00",), ("zz",), (None,)]
    expected = [
        "STATIC_RANDOM", "STATIC_RANDOM", "RESOLVABLE_PRIVATE", "NON_RESOLVABLE_PRIVATE", "UNASSIGNED", None, None,
    ]
    assert values(spark, "a string", rows, address.address_class("a")) == expected


def test_subtype_adv_type_connectable(spark):
    rows = [(" btle", "connectable_undirected"), ("BR/EDR", "scan_response"), (None, None), ("x", "odd")]
    schema = "protocol_subtype string, adv_type string"
    assert values(spark, schema, rows, vocabulary.protocol_subtype()) == ["BLE", "BT_CLASSIC", "UNKNOWN", "UNKNOWN"]
    assert values(spark, schema, rows, vocabulary.adv_type()) == ["ADV_IND", "SCAN_RSP", None, "ODD"]
    flag = vocabulary.is_connectable(vocabulary.adv_type())
    assert values(spark, schema, rows, flag) == [True, False, None, False]


def test_event_key_skips_nulls_and_marks_missing_parts(spark):
    schema = "sensor_id string, event_time timestamp, bssid string, message_id string"
    rows = spark.createDataFrame([("s", None, None, None)], schema).withColumn(
        "event_time", F.timestamp_millis(F.lit(1717243200123))
    )
    text = "s|1717243200123|__no_bssid__|__no_msg__"
    assert rows.select(event_key("wifi")).first()[0] == hashlib.sha256(text.encode()).hexdigest()
    unnamed = rows.withColumn("sensor_id", F.lit(None).cast("string")).select(event_key("wifi")).first()[0]
    assert unnamed == hashlib.sha256(text[2:].encode()).hexdigest()


def test_vendor_oui(spark):
    rows = [("AA:BB:CC:DD",), ("aa-bb-cc",), ("aa:bb",), (None,)]
    assert values(spark, "m string", rows, vendor_oui("m")) == ["aa:bb:cc", None, None, None]


def test_tags_keep_rule_order_and_drop_nulls(spark):
    column = tags.tag_array([("a", F.col("x") > 1), ("b", F.col("x") > 0), ("c", F.lit(None).cast("boolean"))])
    assert values(spark, "x int", [(2,), (1,), (None,)], column) == [["a", "b"], ["b"], []]


def test_settings_refuse_to_run_without_salt(spark):
    with pytest.raises(ValueError):
        Settings(salt="")
    spark.conf.set("rfsight.salt", "from-conf")
    spark.conf.set("rfsight.copresence_seconds", "60")
    try:
        read = Settings.from_conf(spark, run_id="r")
        assert (read.salt, read.copresence_seconds, read.run_id) == ("from-conf", 60, "r")
    finally:
        spark.conf.unset("rfsight.salt")
        spark.conf.unset("rfsight.copresence_seconds")
