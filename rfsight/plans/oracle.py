"""Reference SQL for the catalogue, in DuckDB's dialect, over the driver's tables.

Each statement is a final SELECT; the common table expressions it names are put in front. They restate
the adapter and every layer independently of the DataFrame code. Times come out as epoch microseconds,
arrays as comma-joined text, distances to six decimals.
"""

from __future__ import annotations

import re

from rfsight.operators.lookup import MANUFACTURERS
from rfsight.plans import adapter as a


def _lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _pick(values: list, index: str) -> str:
    return f"list_extract([{', '.join(map(_lit, values))}], (({index}) % {len(values)} + 1)::INTEGER)"


def half_up(x: str, digits: int) -> str:
    """Round the shortest decimal text of a double half up."""
    return f"cast(round(cast(cast({x} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def _address(prefix: str, spaced: str) -> str:
    h = f"sha256('{prefix}' || u)"
    octets = ", ".join(f"substr({h}, {i}, 2)" for i in range(1, 13, 2))
    quads = ", ".join(f"substr({h}, {i}, 4)" for i in range(1, 13, 4))
    return f"""CASE WHEN e % 97 = 0 THEN NULL WHEN e % 89 = 0 THEN 'zz:not-an-address'
        WHEN e % 4 = 0 THEN concat_ws(':', {octets}) WHEN e % 4 = 1 THEN upper(concat_ws('-', {octets}))
        WHEN e % 4 = 2 THEN concat_ws('.', {quads}) ELSE concat_ws('{spaced}', {octets}) END"""


def _rssi(low: int) -> str:
    return f"""(CASE WHEN e % 101 = 0 THEN 50 WHEN e % 103 = 0 THEN {low}
        WHEN e % 25 <> 0 THEN -30 - (e * 7) % 75 END)::INTEGER"""


_COMMON = """sensor_id, ms * 1000 AS event_time,
    CASE WHEN e % 50 <> 0 THEN 'm' || e END AS message_id,
    CASE WHEN e % 4 = 0 THEN 'cap-' || (e % 10) || '.pcap' END AS capture_file,
    CASE WHEN e % 401 = 0 THEN 95e0 WHEN e % 17 <> 0 THEN 37.7e0 + idx::DOUBLE * 0.001e0 END AS latitude,
    CASE WHEN e % 19 <> 0 THEN -122.4e0 - idx::DOUBLE * 0.002e0 END AS longitude,
    CASE WHEN e % 6 = 0 THEN (e % 360)::DOUBLE END AS heading, NULL::DOUBLE AS azimuth,
    CASE WHEN e % 307 = 0 THEN 1.5e0 WHEN e % 23 <> 0 THEN ((e * 13) % 101)::DOUBLE / 100e0 END AS confidence,
    NULL::VARCHAR AS raw_payload, 'fw=v' || (e % 5) AS metadata,
    ingest_ms * 1000 AS ingest_time, 'landing/part-' || (e % 16) AS source_path, e"""

_NOW = a.AS_OF_MICROS
_DAY = 86_400_000_000


def _strip(column: str, pattern: str) -> str:
    return f"sha256(lower(regexp_replace({column}, '{pattern}', '', 'g')) || '{a.SALT}')"


def _mac(column: str) -> str:
    return _strip(column, r"[:\-.]")


def _addr(column: str) -> str:
    return _strip(column, r"[:\-. ]")


def _day(micros: str) -> str:
    return f"strftime(make_timestamp({micros}), '%Y-%m-%d')"


RANDOM_MAC = r"substr(regexp_extract(bssid, '^([0-9a-fA-F]{2})', 1), 2, 1) IN ('2','6','a','A','e','E')"
RANDOM_ADDR = r"""CASE WHEN device_address IS NOT NULL THEN coalesce(address_randomized,
    regexp_matches(substr(regexp_extract(device_address, '^([0-9a-fA-F]{2})', 1), 2, 1), '^[0-7c-fC-F]$')) END"""
BAND = """CASE WHEN lower(trim(band)) IN ('2.4', '2.4ghz', '2') THEN '2.4GHz'
    WHEN lower(trim(band)) IN ('5', '5ghz') THEN '5GHz' WHEN lower(trim(band)) IN ('6', '6ghz') THEN '6GHz'
    WHEN frequency_mhz BETWEEN 2400 AND 2500 THEN '2.4GHz'
    WHEN frequency_mhz BETWEEN 5170 AND 5835 THEN '5GHz'
    WHEN frequency_mhz BETWEEN 5925 AND 7125 THEN '6GHz' END"""
CIPHER = """CASE WHEN upper(trim(encryption)) IN ('OPEN', 'NONE', '') THEN 'OPEN'
    WHEN upper(encryption) LIKE '%WPA3%' THEN 'WPA3' WHEN upper(encryption) LIKE '%WPA2%' THEN 'WPA2'
    WHEN upper(encryption) LIKE '%WPA%' THEN 'WPA' WHEN upper(encryption) LIKE '%WEP%' THEN 'WEP'
    ELSE 'UNKNOWN' END"""
SUBTYPE = """CASE WHEN upper(trim(protocol_subtype)) IN ('BLE', 'BTLE', 'BT_LE', 'LOW_ENERGY') THEN 'BLE'
    WHEN upper(trim(protocol_subtype)) IN ('CLASSIC', 'BT_CLASSIC', 'BR/EDR', 'BREDR') THEN 'BT_CLASSIC'
    ELSE 'UNKNOWN' END"""
ADV = """CASE upper(trim(adv_type)) WHEN 'CONNECTABLE_UNDIRECTED' THEN 'ADV_IND'
    WHEN 'CONNECTABLE_DIRECTED' THEN 'ADV_DIRECT_IND' WHEN 'NON_CONNECTABLE' THEN 'ADV_NONCONN_IND'
    WHEN 'SCAN_RESPONSE' THEN 'SCAN_RSP' WHEN 'SCANNABLE_UNDIRECTED' THEN 'ADV_SCAN_IND'
    ELSE upper(trim(adv_type)) END"""
DIST_WIFI = "CASE WHEN rssi_dbm BETWEEN -100 AND -20 THEN pow(10e0, (-40e0 - rssi_dbm) / 20e0) END"
DIST_BLE = f"""CASE WHEN rssi_dbm BETWEEN -110 AND 0 AND coalesce(tx_power, -59) BETWEEN -100 AND 20
    THEN {half_up("pow(10e0, (coalesce(tx_power, -59)::DOUBLE - rssi_dbm) / 20e0)", 2)} END"""


def _tags(*rules: tuple[str, str]) -> str:
    items = ", ".join(f"CASE WHEN {condition} THEN '{name}' END" for name, condition in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


FLAGS_WIFI = _tags(
    ("MISSING_RSSI", "rssi_dbm IS NULL"),
    ("MISSING_BSSID", "bssid IS NULL"),
    ("MISSING_SSID", "ssid IS NULL"),
    ("MISSING_CHANNEL", "channel IS NULL"),
    ("NO_GEOLOCATION", "latitude IS NULL"),
    ("RSSI_OUT_OF_RANGE", "rssi_dbm < -100 OR rssi_dbm > 0"),
    ("LOW_CONFIDENCE", "confidence < 0.5e0"),
    ("RANDOMIZED_MAC", RANDOM_MAC),
)
FLAGS_BT = _tags(
    ("MISSING_RSSI", "rssi_dbm IS NULL"),
    ("MISSING_DEVICE_ADDRESS", "device_address IS NULL"),
    ("UNKNOWN_PROTOCOL", f"{SUBTYPE} = 'UNKNOWN'"),
    ("NO_GEOLOCATION", "latitude IS NULL"),
    ("RANDOMIZED_ADDRESS", RANDOM_ADDR),
    ("RSSI_OUT_OF_RANGE", "rssi_dbm < -110 OR rssi_dbm > 20"),
    ("LOW_CONFIDENCE", "confidence < 0.5e0"),
)
REASONS = _tags(
    ("VERY_CLOSE_PROXIMITY", "rssi_dbm >= -50"),
    ("CLOSE_PROXIMITY", "rssi_dbm BETWEEN -65 AND -51"),
    (
        "RANDOMIZED_IDENTIFIER",
        "list_contains(dq_flags, 'RANDOMIZED_MAC') OR list_contains(dq_flags, 'RANDOMIZED_ADDRESS')",
    ),
    ("HIDDEN_NETWORK", "list_contains(dq_flags, 'MISSING_SSID')"),
    ("WITHIN_10M", "distance_est_m < 10e0"),
)
SCORE = half_up(
    """least(1e0, 0.3e0 + (rssi_dbm + 65)::DOUBLE / 45e0 * 0.7e0) * coalesce(confidence, 0.5e0)
    * least(1e0, 0.7e0 + len(reasons) * 0.1e0)""",
    3,
)


def _silver(protocol: str, body: str) -> str:
    return f"""SELECT * FROM (SELECT {body} FROM (SELECT *, row_number() OVER (
        PARTITION BY event_id ORDER BY ingest_time, source_path) AS rn FROM {protocol}_bronze) WHERE rn = 1)
        WHERE length(event_id) = 64 AND length(sensor_id) > 0 AND event_time IS NOT NULL
          AND event_time >= {_NOW - 7 * _DAY}"""


def _unique(protocol: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingest_time, source_path) AS rn
        FROM {protocol}_bronze) WHERE rn = 1"""


def features(now: int) -> str:
    """Feature rows as of a time: nothing after it counts."""
    return f"""SELECT t.device_id_hash, count(*) FILTER (event_time > {now - _DAY}) AS sighting_count_24h,
        min(event_time) AS first_seen_ever, min(event_time) > {now - _DAY} AS is_new,
        max(rssi_dbm) FILTER (NOT list_contains(dq_flags, 'RSSI_OUT_OF_RANGE')) AS max_rssi_ever,
        coalesce(any_value(c.n), 0) AS copresence_count,
        bool_or(list_contains(dq_flags, 'RANDOMIZED_MAC') OR list_contains(dq_flags, 'RANDOMIZED_ADDRESS'))
          AS randomized_address, count(DISTINCT sensor_id) AS unique_sensor_count
        FROM timeline t LEFT JOIN (SELECT h, count(*) AS n FROM (
          SELECT wifi_device_hash AS h FROM pairs WHERE window_end <= {now}
          UNION ALL SELECT bt_device_hash FROM pairs WHERE window_end <= {now}) GROUP BY h) c ON t.device_id_hash = c.h
        WHERE t.device_id_hash IS NOT NULL AND event_time <= {now} GROUP BY t.device_id_hash"""


def bare(column: str, pattern: str) -> str:
    return f"lower(regexp_replace({column}, '{pattern}', '', 'g'))"


def _bronze(protocol: str, key: str) -> str:
    return f"""SELECT *, {key} AS event_id, {_day("event_time")} AS event_date, '{a.RUN_ID}' AS pipeline_id
        FROM {protocol}_landed
        WHERE event_time >= {_NOW - 7 * _DAY} AND event_time <= {_NOW + 300_000_000}"""


_HEAD = "event_id, sensor_id, event_time, ingest_time, event_date, message_id, capture_file"
_GEO = "latitude, longitude, heading, azimuth"
EVENT_ID_WIFI = """sha256(concat_ws('|', sensor_id, event_time // 1000, coalesce(bssid, '__no_bssid__'),
    coalesce(message_id, '__no_msg__')))"""
EVENT_ID_BT = """sha256(concat_ws('|', sensor_id, event_time // 1000, coalesce(device_address, '__no_addr__'),
    coalesce(adv_type, '__no_adv_type__'), coalesce(message_id, '__no_msg__')))"""

_IN_WIFI = ", ".join(map(_lit, a.WIFI_EVENTS))


def _dump_address(prefix: str) -> str:
    h = f"sha256('{prefix}' || u)"
    return "upper(concat_ws(':', " + ", ".join(f"substr({h}, {i}, 2)" for i in range(1, 13, 2)) + "))"


CTES: dict[str, str] = {
    "base": f"""SELECT *, CASE WHEN e % 211 = 0 THEN NULL WHEN e % 223 = 0 THEN '' ELSE 'sensor-' || idx END
            AS sensor_id, ms + (e % 1200) * 1000 + copy * 7000 AS ingest_ms
        FROM (SELECT event_id AS e, user_id AS u, event_type IN ({_IN_WIFI}) AS is_wifi,
            {a.EPOCH_MS} + (epoch_us(ts) - {a.EPOCH_MS}000) // 60000
              + CASE WHEN event_id % 59 = 0 THEN -864000000 WHEN event_id % 61 = 0 THEN 172800000 ELSE 0 END AS ms,
            (user_id + event_id % 3) % 8 AS idx,
            unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM events)""",
    "wifi_landed": f"""SELECT {_COMMON}, {_address("w", ":")} AS bssid,
        CASE WHEN e % 12 = 0 THEN NULL WHEN e % 12 = 1 THEN '' ELSE 'net-' || (u % 20) END AS ssid,
        {_pick(a.CHANNELS, "e")} AS channel, {_pick(a.FREQUENCIES, "e")} AS frequency_mhz,
        {_pick(a.BANDS, "e")} AS band, {_rssi(-200)} AS rssi_dbm,
        CASE WHEN e % 10 <> 0 THEN (e % 40)::DOUBLE / 2e0 END AS snr_db,
        {_pick(a.CIPHERS, "e + u")} AS encryption, {_pick(a.AUTH_MODES, "e")} AS auth_mode,
        {_pick(a.FRAME_TYPES, "e")} AS frame_type, NULL::VARCHAR AS vendor_oui,
        CASE WHEN e % 5 = 0 THEN {_address("c", ":")} END AS client_mac,
        CASE WHEN e % 3 <> 0 THEN {_address("w", ":")} END AS ap_mac,
        {_address("w", "-")} AS transmitter_mac FROM base WHERE is_wifi""",
    "bt_landed": f"""SELECT {_COMMON}, {_address("b", " ")} AS device_address,
        {_pick(a.REPORTED_RANDOM, "e")} AS address_randomized,
        CASE WHEN e % 3 = 0 THEN 'dev-' || u WHEN e % 3 = 1 THEN '' END AS device_name,
        CASE WHEN e % 4 >= 2 THEN '180F' END AS advertising_uuid,
        {_pick(a.MANUFACTURER_IDS, "e")} AS manufacturer_id,
        CASE WHEN e % 2 = 0 THEN lower(to_hex(e)) END AS manufacturer_data,
        CASE WHEN e % 4 = 1 THEN []::VARCHAR[] WHEN e % 4 = 2 THEN ['180F'] WHEN e % 4 = 3 THEN ['180F', 'FEAA']
          END AS service_uuids,
        {_rssi(-120)} AS rssi_dbm, {_pick(a.TX_POWERS, "e")} AS tx_power,
        {_pick(a.SUBTYPES, "e")} AS protocol_subtype, {_pick(a.ADV_TYPES, "e")} AS adv_type,
        NULL::VARCHAR AS vendor_oui FROM base WHERE NOT is_wifi""",
    "wifi_bronze": _bronze("wifi", EVENT_ID_WIFI),
    "bt_bronze": _bronze("bt", EVENT_ID_BT),
    "wifi_unique": _unique("wifi"),
    "bt_unique": _unique("bt"),
    "wifi_silver": _silver(
        "wifi",
        f"""{_HEAD}, {_mac("bssid")} AS bssid_hash, ssid, channel, frequency_mhz, {BAND} AS band, rssi_dbm, snr_db,
        {CIPHER} AS encryption, auth_mode, frame_type, vendor_oui, {_mac("client_mac")} AS client_mac_hash,
        {_mac("ap_mac")} AS ap_mac_hash, {_mac("transmitter_mac")} AS transmitter_mac_hash, {_GEO},
        {DIST_WIFI} AS distance_est_m, {RANDOM_MAC} AS is_randomized_mac,
        (ssid IS NULL OR ssid = '') AS is_hidden_ssid, confidence, {FLAGS_WIFI} AS dq_flags, pipeline_id,
        source_path""",
    ),
    "bt_silver": _silver(
        "bt",
        f"""{_HEAD}, {_addr("device_address")} AS device_address_hash, address_randomized, device_name,
        advertising_uuid, manufacturer_id, NULL::VARCHAR AS manufacturer_name, manufacturer_data, service_uuids,
        rssi_dbm, tx_power, tx_power - rssi_dbm AS path_loss_db, {SUBTYPE} AS protocol_subtype, {ADV} AS adv_type,
        vendor_oui, {_GEO}, {DIST_BLE} AS distance_est_m, {RANDOM_ADDR} AS is_randomized_address,
        {ADV} IN ('ADV_IND', 'ADV_DIRECT_IND') AS is_connectable, confidence, {FLAGS_BT} AS dq_flags, pipeline_id,
        source_path""",
    ),
    "timeline": """SELECT event_id, sensor_id, event_time, ingest_time, event_date, 'WIFI' AS protocol,
            bssid_hash AS device_id_hash, NULL::VARCHAR AS device_name, ssid, rssi_dbm, distance_est_m, latitude,
            longitude, confidence, concat_ws('/', band, encryption) AS protocol_detail, dq_flags FROM wifi_silver
        UNION ALL SELECT event_id, sensor_id, event_time, ingest_time, event_date, 'BLUETOOTH',
            device_address_hash, device_name, NULL, rssi_dbm, distance_est_m, latitude, longitude, confidence,
            protocol_subtype, dq_flags FROM bt_silver""",
    "alerts": f"""SELECT *, sha256(event_id || '|ALERT') AS alert_id, {SCORE} AS threat_score FROM (
        SELECT *, {REASONS} AS reasons FROM timeline WHERE rssi_dbm >= -65 AND confidence >= 0.7e0)
        WHERE len(reasons) > 0""",
    "pairs": f"""SELECT sha256(w.event_id || '|' || b.event_id) AS copresence_id, w.sensor_id,
        least(w.event_time, b.event_time) AS window_start, greatest(w.event_time, b.event_time) AS window_end,
        w.event_id AS wifi_event_id, b.event_id AS bt_event_id, w.bssid_hash AS wifi_device_hash,
        b.device_address_hash AS bt_device_hash, w.rssi_dbm AS wifi_rssi_dbm, b.rssi_dbm AS bt_rssi_dbm,
        w.distance_est_m AS wifi_distance_m, b.distance_est_m AS bt_distance_m, w.latitude, w.longitude,
        {half_up("(coalesce(w.confidence, 0.5e0) + coalesce(b.confidence, 0.5e0)) / 2e0", 3)} AS copresence_score
        FROM wifi_silver w JOIN bt_silver b ON w.sensor_id = b.sensor_id
          AND w.event_time BETWEEN b.event_time - 30000000 AND b.event_time + 30000000""",
    "links": f"""SELECT wifi_device_hash, bt_device_hash, count(*) AS pair_count,
        {half_up("sum(round(copresence_score * 1000)::BIGINT)::DOUBLE / count(*) / 1000e0", 6)} AS mean_score,
        count(DISTINCT sensor_id) AS sensor_count, min(window_start) AS first_seen, max(window_end) AS last_seen
        FROM pairs WHERE wifi_device_hash IS NOT NULL AND bt_device_hash IS NOT NULL GROUP BY ALL""",
    "features": features(_NOW),
    "book": f"""SELECT DISTINCT 'WIFI' AS protocol, {_mac("bssid")} AS h, {bare("bssid", "[:.-]")} AS raw
        FROM wifi_bronze WHERE bssid IS NOT NULL UNION ALL SELECT DISTINCT 'BLUETOOTH', {_addr("device_address")},
        {bare("device_address", "[:. -]")} FROM bt_bronze WHERE device_address IS NOT NULL""",
    "outbox": """SELECT e AS id, CASE WHEN is_wifi THEN 'wifi' ELSE 'bt' END AS protocol, ms * 1000 AS created_at,
        CASE WHEN e % 7 <> 0 THEN (ms + 60000) * 1000 END AS uploaded_at FROM base WHERE copy = 0""",
    "strong": """SELECT wifi_device_hash AS a, bt_device_hash AS b FROM links WHERE pair_count >= 3
        UNION SELECT bt_device_hash, wifi_device_hash FROM links WHERE pair_count >= 3""",
    "reach": """SELECT a, b FROM strong
        UNION SELECT reach.a, strong.b FROM reach JOIN strong ON reach.b = strong.a""",
}

for _p, _own in (("wifi", "is_wifi"), ("bt", "NOT is_wifi")):
    CTES[f"{_p}_lines"] = f"""SELECT e, sensor_id, ms, ingest_ms, 'landing/part-' || (e % 16) AS source_path,
        'm' || e AS message_id, (-30 - (e * 7) % 75)::INTEGER AS rssi_dbm, (e % 40) AS fault,
        '{{"sensor_id":' || coalesce('"' || sensor_id || '"', 'null') || ',"event_time":"'
          || strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') || '","message_id":"m' || e
          || '","rssi_dbm":' || (-30 - (e * 7) % 75) || CASE WHEN e % 40 = 0 THEN '' WHEN e % 40 = 1
            THEN ',"firmware":"v' || (e % 5) || '"}}' WHEN e % 40 = 2 THEN ',"{a.MISTYPED[_p]}":"high"}}' ELSE '}}' END
          AS line
        FROM base WHERE {_own} AND copy = 0"""
    CTES[f"{_p}_rescued"] = f"""SELECT *, CASE fault WHEN 0 THEN line WHEN 1 THEN '{{"firmware":"v' || (e % 5) || '"}}'
        WHEN 2 THEN '{{"{a.MISTYPED[_p]}":"high"}}' END AS _rescued_data FROM {_p}_lines"""


def sql(select: str) -> str:
    """Put the tables ``select`` needs, directly or through others, in front of it."""
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in seen and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                seen.add(name)
                visit(body)
                needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + select


MANUFACTURER_VALUES = ", ".join(f"({i}, {_lit(n)})" for i, n in MANUFACTURERS.items())
NOW, DAY, DAY_OF, MAC_HASH, ADDR_HASH, HALF_UP = _NOW, _DAY, _day, _mac, _addr, half_up
