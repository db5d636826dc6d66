"""Raw wireless scan dumps (one text per scan) to landing rows, one per access point."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rfsight.contracts import project
from rfsight.functions import signal, vocabulary
from rfsight.functions.identity import digest, vendor_oui

# --- fixed values: text patterns of a scan dump ------------------------------------------------
CELL_START = r"Cell \d+ -"
PATTERNS = {
    "address": r"Address:\s+([0-9A-Fa-f:]{17})",
    "essid": r'ESSID:"(.*?)"',
    "channel": r"Channel:(\d+)",
    "ghz": r"Frequency:([\d.]+)\s*GHz",
    "signal": r"Signal level=(-?\d+)\s*dBm",
    "noise": r"Noise level=(-?\d+)\s*dBm",
    "quality": r"Quality=(\d+)/\d+",
    "quality_scale": r"Quality=\d+/(\d+)",
    "key": r"Encryption key:(on|off)",
}
CIPHER_PATTERNS = {
    "WPA3": r"(?i)WPA3|SAE|OWE",
    "WPA2": r"(?i)WPA2",
    "WPA": r"(?i)WPA[^23]",
    "WEP": r"(?i)WEP",
}
SAE_PATTERN = r"(?i)SAE"
EAP_PATTERN = r"(?i)802\.1x|EAP"
# ----------------------------------------------------------------------------------------------


def read_dumps(spark: SparkSession, path: str) -> DataFrame:
    """One row per dump file (a scan of one radio, so a few kilobytes)."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("value").alias("dump"), F.col("_metadata.file_path").alias("source_path"))


def _found(name: str) -> Column:
    return F.nullif(F.regexp_extract("cell", PATTERNS[name], 1), F.lit(""))


def scan_encryption(cell: str = "cell") -> tuple[Column, Column]:
    """(cipher, authentication) of a cell. No key line, or key off, means an open network."""
    text = F.col(cell)
    secured = F.regexp_extract(cell, PATTERNS["key"], 1) == "on"
    cipher = vocabulary.first_true(
        [(text.rlike(pattern), name) for name, pattern in CIPHER_PATTERNS.items()], F.lit("UNKNOWN")
    )
    cipher = F.when(secured, cipher).otherwise(F.lit("OPEN"))
    auth = (
        F.when(cipher == "WPA3", F.when(text.rlike(SAE_PATTERN), F.lit("SAE")).otherwise(F.lit("EAP")))
        .when(cipher == "WPA2", F.when(text.rlike(EAP_PATTERN), F.lit("EAP")).otherwise(F.lit("PSK")))
        .when(cipher == "WPA", F.lit("PSK"))
    )
    return cipher, auth


def scan_cells(dumps: DataFrame, column: str = "dump") -> DataFrame:
    """One row per ``Cell`` block; the header before the first block is not a cell."""
    blocks = F.split(column, CELL_START)
    cells = F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0)))
    others = [name for name in dumps.columns if name != column]
    return dumps.select(*others, F.posexplode(cells).alias("cell_no", "cell"))


def parse_scan_dump(dumps: DataFrame) -> DataFrame:
    """Payload rows from dumps with columns sensor_id, event_time, latitude, longitude, dump.

    The message id is a digest of scan and cell rather than a random one, so a task that is run
    again after a lost executor yields the same rows.
    """
    cells = scan_cells(dumps).withColumns({name: _found(name) for name in PATTERNS})
    numbers = {name: F.col(name).try_cast("int") for name in ("channel", "signal", "noise", "quality", "quality_scale")}
    ghz = F.col("ghz").try_cast("double")
    numbers["ghz"] = F.when(ghz.between(0, 1000), ghz)
    # a cell with a number that isn't one is skipped, and costs no other cell
    sound = [F.col(name).isNull() | value.isNotNull() for name, value in numbers.items()]
    cells = cells.filter(F.col("address").isNotNull() & reduce(and_, sound))
    named = cells.withColumns(numbers | {"bssid": F.lower("address")})
    ghz = F.when(F.col("ghz") != 0, F.col("ghz"))
    level, noise = F.col("signal"), F.col("noise")
    cipher, auth = scan_encryption()
    absent = F.lit(None)
    derived = {
        "message_id": digest(
            "sensor_id", F.unix_millis("event_time").cast("string"), F.col("cell_no").cast("string"), "bssid"
        ),
        "capture_file": absent,
        "ssid": F.col("essid"),
        "channel": F.col("channel"),
        "frequency_mhz": F.floor(ghz * 1000),
        "band": vocabulary.scanner_band(ghz),
        "rssi_dbm": level,
        "snr_db": signal.snr(level, noise),
        "encryption": cipher,
        "auth_mode": auth,
        "frame_type": F.lit("beacon"),
        "vendor_oui": vendor_oui("bssid"),
        "client_mac": absent,
        "ap_mac": F.col("bssid"),
        "transmitter_mac": F.col("bssid"),
        "heading": absent,
        "azimuth": absent,
        "confidence": signal.link_quality(F.col("quality"), F.col("quality_scale")),
        "raw_payload": absent,
        "metadata": F.create_map(F.lit("scanner"), F.lit("iwlist")),
    }
    return project(named, "wifi_payload", derived)
