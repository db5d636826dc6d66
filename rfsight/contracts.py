"""Table contracts: ordered column lists per table, and the check that a frame honours one."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

WIFI, BT = "wifi", "bt"

# --- fixed values: column names, order and types of the public tables -------------------------
_WHERE = "latitude double, longitude double, heading double, azimuth double"
_HEAD = "sensor_id string, event_time timestamp, message_id string, capture_file string"
_TAIL = "confidence double, raw_payload string, metadata map<string,string>"
_STAMPS = "event_id string, ingest_time timestamp, event_date string, source_path string, pipeline_id string"
_SILVER_HEAD = (
    "event_id string, sensor_id string, event_time timestamp, ingest_time timestamp, "
    "event_date string, message_id string, capture_file string"
)
_SILVER_TAIL = "confidence double, dq_flags array<string>, pipeline_id string, source_path string"

_DDL = {
    "wifi_payload": f"""{_HEAD}, bssid string, ssid string, channel int, frequency_mhz int, band string,
        rssi_dbm int, snr_db double, encryption string, auth_mode string, frame_type string,
        vendor_oui string, client_mac string, ap_mac string, transmitter_mac string, {_WHERE}, {_TAIL}""",
    "bt_payload": f"""{_HEAD}, device_address string, address_randomized boolean, device_name string,
        advertising_uuid string, manufacturer_id int, manufacturer_data string,
        service_uuids array<string>, rssi_dbm int, tx_power int, protocol_subtype string,
        adv_type string, vendor_oui string, {_WHERE}, {_TAIL}""",
    "wifi_silver": f"""{_SILVER_HEAD}, bssid_hash string, ssid string, channel int, frequency_mhz int,
        band string, rssi_dbm int, snr_db double, encryption string, auth_mode string,
        frame_type string, vendor_oui string, client_mac_hash string, ap_mac_hash string,
        transmitter_mac_hash string, {_WHERE}, distance_est_m double, is_randomized_mac boolean,
        is_hidden_ssid boolean, {_SILVER_TAIL}""",
    "bt_silver": f"""{_SILVER_HEAD}, device_address_hash string, address_randomized boolean,
        device_name string, advertising_uuid string, manufacturer_id int, manufacturer_name string,
        manufacturer_data string, service_uuids array<string>, rssi_dbm int, tx_power int,
        path_loss_db int, protocol_subtype string, adv_type string, vendor_oui string, {_WHERE},
        distance_est_m double, is_randomized_address boolean, is_connectable boolean, {_SILVER_TAIL}""",
    "quarantine": """_rescued_data string, sensor_id string, event_time timestamp,
        ingest_time timestamp, event_date string, source_path string""",
    "device_timeline": """event_id string, sensor_id string, event_time timestamp,
        ingest_time timestamp, event_date string, protocol string, device_id_hash string,
        device_name string, ssid string, rssi_dbm int, distance_est_m double, latitude double,
        longitude double, confidence double, protocol_detail string, dq_flags array<string>""",
    "copresence_events": """copresence_id string, sensor_id string, window_start timestamp,
        window_end timestamp, event_date string, wifi_event_id string, bt_event_id string,
        wifi_device_hash string, bt_device_hash string, wifi_rssi_dbm int, bt_rssi_dbm int,
        wifi_distance_m double, bt_distance_m double, latitude double, longitude double,
        copresence_score double, ingest_time timestamp""",
    # co-presence events by the sensors and buckets of time in which they meet: a row stands for all pairs of a cell
    "copresence_cells": """sensor_id string, cell timestamp, event_date string, reach_seconds int,
        ingest_time timestamp""",
    # the same by the instants of their two sides: a row stands for all pairs of sightings at these
    "copresence_instants": """sensor_id string, wifi_event_time timestamp, bt_event_time timestamp,
        event_date string, reach_seconds int, ingest_time timestamp""",
    # sightings that co-presence has counted
    "copresence_members": """sensor_id string, event_time timestamp, event_date string, is_wifi boolean,
        ingest_time timestamp""",
    # co-present classes of equal sightings: a row stands for pair_count events
    "copresence_classes": """wifi_device_hash string, bt_device_hash string, sensor_id string,
        window_start timestamp, window_end timestamp, event_date string, pair_count bigint""",
    "perimeter_alerts": """alert_id string, sensor_id string, event_time timestamp,
        event_date string, protocol string, device_id_hash string, rssi_dbm int,
        distance_est_m double, latitude double, longitude double, confidence double,
        alert_reasons array<string>, threat_score double, ingest_time timestamp""",
}
for _p in (WIFI, BT):
    _DDL[f"{_p}_bronze"] = f"{_DDL[f'{_p}_payload']}, _rescued_data string, {_STAMPS}"
    _DDL[f"{_p}_late"] = f"{_DDL[f'{_p}_bronze']}, layer string"

PARTITIONS = {
    "wifi_bronze": ["event_date"],
    "bt_bronze": ["event_date"],
    "wifi_quarantine": ["event_date"],
    "bt_quarantine": ["event_date"],
    "wifi_late": ["event_date"],
    "bt_late": ["event_date"],
    "wifi_silver": ["event_date"],
    "bt_silver": ["event_date"],
    "device_timeline": ["event_date", "protocol"],
    "copresence_events": ["event_date"],
    "copresence_cells": ["event_date"],
    "copresence_instants": ["event_date"],
    "copresence_members": ["event_date"],
    "copresence_classes": ["event_date"],
    "perimeter_alerts": ["event_date", "protocol"],
}
# ----------------------------------------------------------------------------------------------


# Parsed here because StructType.fromDDL needs a running session.
_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


class ContractError(ValueError):
    """A frame does not carry the columns or types its table promises."""


def contract(table: str) -> T.StructType:
    """The declared schema of ``table`` (all columns nullable; presence is enforced by expectations)."""
    if table.endswith("_quarantine"):
        table = "quarantine"
    columns = (column.split() for column in re.split(r",\s+", _DDL[table].strip()))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` to the contract's column order, refusing missing columns and changed types."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = [
        f"{f.name}: expected {f.dataType.simpleString()}, found {have.get(f.name, 'nothing')}"
        for f in contract(table).fields
        if have.get(f.name) != f.dataType.simpleString()
    ]
    if problems:
        raise ContractError(f"{table}: " + "; ".join(problems))
    return df.select(*contract(table).fieldNames())


def project(df: DataFrame, table: str, derived: dict[str, Column]) -> DataFrame:
    """One flat projection to ``table``: derived expressions where given, the input column otherwise."""
    columns = [
        derived[f.name].cast(f.dataType.simpleString()).alias(f.name) if f.name in derived else f.name
        for f in contract(table).fields
    ]
    return df.select(*columns)
