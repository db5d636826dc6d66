"""Small hand-made observations."""

import json

from rfsight.contracts import contract


def wifi(**fields) -> dict:
    row = dict.fromkeys(contract("wifi_payload").fieldNames())
    row |= {
        "sensor_id": "gate-1",
        "event_time": "2024-06-01T12:00:00.000Z",
        "message_id": "w1",
        "bssid": "11:22:33:44:55:66",
        "ssid": "lobby",
        "channel": 6,
        "frequency_mhz": 2437,
        "band": "2.4",
        "rssi_dbm": -48,
        "encryption": "WPA2",
        "latitude": 51.5,
        "longitude": -0.1,
        "confidence": 0.9,
        "metadata": {},
    }
    return row | fields


def bt(**fields) -> dict:
    row = dict.fromkeys(contract("bt_payload").fieldNames())
    row |= {
        "sensor_id": "gate-1",
        "event_time": "2024-06-01T12:00:00.000Z",
        "message_id": "b1",
        "device_address": "c0:11:22:33:44:55",
        "rssi_dbm": -60,
        "tx_power": 4,
        "protocol_subtype": "BLE",
        "adv_type": "ADV_IND",
        "latitude": 51.5,
        "longitude": -0.1,
        "confidence": 0.8,
        "service_uuids": [],
        "metadata": {},
    }
    return row | fields


def at(seconds: float) -> str:
    """Event time ``seconds`` after noon."""
    minutes, rest = divmod(seconds, 60)
    hours, minutes = divmod(int(minutes), 60)
    return f"2024-06-01T{12 + hours:02d}:{minutes:02d}:{rest:06.3f}Z"


def write_lines(folder, name: str, rows: list) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    lines = [row if isinstance(row, str) else json.dumps(row) for row in rows]
    (folder / f"{name}.json").write_text("\n".join(lines) + "\n")
