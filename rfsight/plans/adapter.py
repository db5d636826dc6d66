"""Observations derived from the driver's ``events`` table.

The given data holds no radio sightings, so every event becomes one: clicks, views and errors are heard
over Wi-Fi, purchases and signups over Bluetooth. Thirty days are compressed sixty-fold into twelve
hours, which makes co-presence within 30 s common. Values are picked from the lists below by event id,
so they include missing, padded, mixed-case and faulty entries; every twentieth event arrives twice.
One scan of four columns; everything else is arithmetic on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rfsight.config import Settings
from rfsight.contracts import contract

SALT = "bench-salt"
AS_OF = "2024-01-01T12:30:00Z"
AS_OF_MICROS = 1704112200000000
EPOCH_MS = 1704067200000  # 2024-01-01T00:00:00Z
RUN_ID = "run-1"

WIFI_EVENTS = ["click", "view", "error"]
BT_EVENTS = ["purchase", "signup"]

BANDS = ["2.4", "2.4GHz", " 2 ", "5", " 5GHZ ", "6", "6ghz", None, "", "n/a", "2.4"]
FREQUENCIES = [2437, 5180, 5955, 2412, 5745, None, 3000, 7125, 2500]
CHANNELS = [6, 36, 1, 149, None, 11, 44]
CIPHERS = ["WPA2", "wpa2/psk", "WPA3-SAE", "OPEN", "", None, "none", " wep ", "WPA", "TKIP", "wpa"]
AUTH_MODES = ["PSK", "SAE", None, "EAP"]
FRAME_TYPES = ["beacon", "probe_req", "data"]
SUBTYPES = ["BLE", "btle", "BT_LE", "low_energy ", "Classic", "BR/EDR", None, "zigbee", "BREDR"]
ADV_TYPES = [
    "ADV_IND", "connectable_undirected", "ADV_DIRECT_IND", "CONNECTABLE_DIRECTED", " scan_rsp ",
    "SCAN_RESPONSE", None, "ADV_NONCONN_IND", "non_connectable", "ADV_SCAN_IND", "custom",
]
TX_POWERS = [4, -8, None, -59, 30, 0, 12]
MANUFACTURER_IDS = [76, 6, 117, None, 9999, 1177, 224, 13249]
REPORTED_RANDOM = [True, False, None]


def settings(**overrides) -> Settings:
    return Settings(**{"salt": SALT, "as_of": AS_OF, "run_id": RUN_ID, **overrides})


def _text(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value + "'" if isinstance(value, str) else str(value).lower()


def pick(values: list, index: str = "e") -> str:
    """SQL for ``values[index % len(values)]``; the array is a constant."""
    options = ", ".join(map(_text, values))
    return f"element_at(array({options}), cast(({index}) % {len(values)} + 1 AS int))"


def _octets(digest: str, separator: str, width: int = 2) -> str:
    return f"regexp_replace(substr({digest}, 1, 12), '({'.' * width})(?=.)', '$1{separator}')"


def _address(prefix: str, spaced: str) -> str:
    """Six octets of the user's digest, in one of four notations; some missing, some malformed."""
    digest = f"digest_{prefix}"
    return f"""CASE WHEN e % 97 = 0 THEN NULL WHEN e % 89 = 0 THEN 'zz:not-an-address'
        WHEN e % 4 = 0 THEN {_octets(digest, ":")} WHEN e % 4 = 1 THEN upper({_octets(digest, "-")})
        WHEN e % 4 = 2 THEN {_octets(digest, ".", 4)} ELSE {_octets(digest, spaced)} END"""


def _rssi(low: int) -> str:
    return f"""cast(CASE WHEN e % 101 = 0 THEN 50 WHEN e % 103 = 0 THEN {low}
        WHEN e % 25 <> 0 THEN -30 - (e * 7) % 75 END AS int)"""


def base(spark: SparkSession, sf_dir: str, *digests: str) -> DataFrame:
    """One row per arrival: e (event id), u (user), is_wifi, ms, ingest_ms, sensor_id, idx, copy.

    ``digests`` adds a hex digest of the user per prefix, computed once per row.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id AS e", "user_id AS u", "event_type", "ts"
    )
    kinds = ", ".join(map(_text, WIFI_EVENTS))
    arrivals = events.selectExpr(
        "e",
        "u",
        f"event_type IN ({kinds}) AS is_wifi",
        f"""{EPOCH_MS} + (unix_micros(cast(ts AS timestamp)) - {EPOCH_MS}000) div 60000
          + CASE WHEN e % 59 = 0 THEN -864000000 WHEN e % 61 = 0 THEN 172800000 ELSE 0 END AS ms""",
        "(u + e % 3) % 8 AS idx",
        "explode(sequence(0, if(e % 20 = 0, 1, 0))) AS copy",
        *[f"sha2(concat('{p}', u), 256) AS digest_{p}" for p in digests],
    )
    return arrivals.selectExpr(
        "*",
        """CASE WHEN e % 211 = 0 THEN NULL WHEN e % 223 = 0 THEN '' ELSE concat('sensor-', idx) END
          AS sensor_id""",
        "ms + (e % 1200) * 1000 + copy * 7000 AS ingest_ms",
    )


_COMMON = {
    "sensor_id": "sensor_id",
    "event_time": "timestamp_millis(ms)",
    "message_id": "CASE WHEN e % 50 <> 0 THEN concat('m', e) END",
    "capture_file": "CASE WHEN e % 4 = 0 THEN concat('cap-', e % 10, '.pcap') END",
    "latitude": """CASE WHEN e % 401 = 0 THEN 95D
        WHEN e % 17 <> 0 THEN 37.7D + cast(idx AS double) * 0.001D END""",
    "longitude": "CASE WHEN e % 19 <> 0 THEN -122.4D - cast(idx AS double) * 0.002D END",
    "heading": "CASE WHEN e % 6 = 0 THEN cast(e % 360 AS double) END",
    "azimuth": "cast(NULL AS double)",
    "confidence": """CASE WHEN e % 307 = 0 THEN 1.5D
        WHEN e % 23 <> 0 THEN cast((e * 13) % 101 AS double) / 100D END""",
    "raw_payload": "cast(NULL AS string)",
    "metadata": "map('fw', concat('v', e % 5))",
}
_WIFI = _COMMON | {
    "bssid": _address("w", ":"),
    "ssid": "CASE WHEN e % 12 = 0 THEN NULL WHEN e % 12 = 1 THEN '' ELSE concat('net-', u % 20) END",
    "channel": pick(CHANNELS),
    "frequency_mhz": pick(FREQUENCIES),
    "band": pick(BANDS),
    "rssi_dbm": _rssi(-200),
    "snr_db": "CASE WHEN e % 10 <> 0 THEN cast(e % 40 AS double) / 2D END",
    "encryption": pick(CIPHERS, "e + u"),
    "auth_mode": pick(AUTH_MODES),
    "frame_type": pick(FRAME_TYPES),
    "vendor_oui": "cast(NULL AS string)",
    "client_mac": f"CASE WHEN e % 5 = 0 THEN {_address('c', ':')} END",
    "ap_mac": f"CASE WHEN e % 3 <> 0 THEN {_address('w', ':')} END",
    "transmitter_mac": _address("w", "-"),
}
_BT = _COMMON | {
    "device_address": _address("b", " "),
    "address_randomized": pick(REPORTED_RANDOM),
    "device_name": "CASE WHEN e % 3 = 0 THEN concat('dev-', u) WHEN e % 3 = 1 THEN '' END",
    "advertising_uuid": "CASE WHEN e % 4 >= 2 THEN '180F' END",
    "manufacturer_id": pick(MANUFACTURER_IDS),
    "manufacturer_data": "CASE WHEN e % 2 = 0 THEN lower(hex(e)) END",
    "service_uuids": """CASE WHEN e % 4 = 1 THEN cast(array() AS array<string>)
        WHEN e % 4 = 2 THEN array('180F') WHEN e % 4 = 3 THEN array('180F', 'FEAA') END""",
    "rssi_dbm": _rssi(-120),
    "tx_power": pick(TX_POWERS),
    "protocol_subtype": pick(SUBTYPES),
    "adv_type": pick(ADV_TYPES),
    "vendor_oui": "cast(NULL AS string)",
}


def _landed(rows: DataFrame, columns: dict[str, str], table: str) -> DataFrame:
    return rows.selectExpr(
        *[f"{columns[name]} AS {name}" for name in contract(table).fieldNames()],
        "timestamp_millis(ingest_ms) AS ingest_time",
        "concat('landing/part-', e % 16) AS source_path",
        "e",
    )


def wifi_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 payload columns plus ingest_time, source_path and e."""
    return _landed(base(spark, sf_dir, "w", "c").filter("is_wifi"), _WIFI, "wifi_payload")


def bt_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 23 payload columns plus ingest_time, source_path and e."""
    return _landed(base(spark, sf_dir, "b").filter("NOT is_wifi"), _BT, "bt_payload")


LANDINGS = {"wifi": wifi_landing, "bt": bt_landing}


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upload queue: id, protocol, created_at, uploaded_at."""
    return base(spark, sf_dir).filter("copy = 0").selectExpr(
        "e AS id",
        "if(is_wifi, 'wifi', 'bt') AS protocol",
        "timestamp_millis(ms) AS created_at",
        "CASE WHEN e % 7 <> 0 THEN timestamp_millis(ms + 60000) END AS uploaded_at",
    )


#: A numeric field of each protocol that some lines give as text.
MISTYPED = {"wifi": "channel", "bt": "manufacturer_id"}


def landing_lines(spark: SparkSession, sf_dir: str, protocol: str) -> DataFrame:
    """NDJSON text per event: mostly sound, some cut short, some with an unknown or a mistyped field."""
    own = "is_wifi" if protocol == "wifi" else "NOT is_wifi"
    return base(spark, sf_dir).filter(f"{own} AND copy = 0").selectExpr(
        f"""concat('{{"sensor_id":', coalesce(concat('"', sensor_id, '"'), 'null'), ',"event_time":"',
          date_format(timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), '","message_id":"m', e,
          '","rssi_dbm":', -30 - (e * 7) % 75, CASE e % 40 WHEN 0 THEN ''
          WHEN 1 THEN concat(',"firmware":"v', e % 5, '"}}') WHEN 2 THEN ',"{MISTYPED[protocol]}":"high"}}' ELSE '}}' END)
          AS value""",
        "concat('landing/part-', e % 16) AS source_path",
        "timestamp_millis(ms) AS sent",
        "timestamp_millis(ingest_ms) AS received",
        "e",
    )


SECURITY = [
    "Encryption key:off",
    r"Encryption key:on\n IE: IEEE 802.11i/WPA2 Version 1\n Authentication Suites (1) : PSK",
    r"Encryption key:on\n IE: IEEE 802.11i/WPA2 Version 1\n Authentication Suites (1) : 802.1x",
    r"Encryption key:on\n IE: WPA3\n Authentication Suites (1) : SAE",
    r"Encryption key:on\n IE: OWE transition",
    r"Encryption key:on\n IE: WPA Version 1",
    r"Encryption key:on\n IE: WEP-104",
    "Encryption key:on",
    "",
]
SCAN_GHZ = ["2.437", "5.18", "5.955", "5.832", "2.412", "7.2"]


def scan_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw scan dump per event, with a header and two access points (one without an address at times)."""
    first, second = (f"upper({_octets(f'digest_{p}', ':')})" for p in "wx")
    return base(spark, sf_dir, "w", "x").filter("is_wifi AND copy = 0").selectExpr(
        "sensor_id",
        "timestamp_millis(ms) AS event_time",
        "37.7D AS latitude",
        "-122.4D AS longitude",
        rf"""concat('wlan0  Scan completed :\n Cell 01 - Address: ', {first}, '\n Channel:', e % 13 + 1,
          '\n Frequency:', {pick(SCAN_GHZ)}, ' GHz (Channel 6)\n Quality=', e % 70, '/70  Signal level=',
          -(e % 90), ' dBm  Noise level=-95 dBm\n ', {pick(SECURITY)}, '\n ESSID:"',
          if(e % 8 = 0, '', concat('net-', u)), '"\n ', if(e % 9 = 0, 'Cell 02 - no address here\n',
          concat('Cell 02 - Address: ', {second}, '\n Encryption key:off\n'))) AS dump""",
        "e",
    )
