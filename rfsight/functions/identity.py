"""Row identity and identifier privacy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: key parts with their NULL stand-ins, and separators removed before hashing --
KEY_PARTS = {
    "wifi": [("bssid", "__no_bssid__"), ("message_id", "__no_msg__")],
    "bt": [
        ("device_address", "__no_addr__"),
        ("adv_type", "__no_adv_type__"),
        ("message_id", "__no_msg__"),
    ],
}
SEPARATORS = {"wifi": r"[:\-.]", "bt": r"[:\-. ]"}
# ----------------------------------------------------------------------------------------------


def digest(*parts: Column | str) -> Column:
    """SHA-256 hex of the parts joined by ``|``; NULL parts are skipped, as ``concat_ws`` does.

    A joined text is never NULL, but ``sha2`` is declared nullable. Coalescing states the fact, so a
    later NOT NULL rule folds away instead of hashing every row a second time.
    """
    return F.coalesce(F.sha2(F.concat_ws("|", *parts), 256), F.lit(""))


def event_key(protocol: str) -> Column:
    """Deterministic id of a raw observation: equal for every replay of the same source line."""
    optional = [F.coalesce(F.col(name), F.lit(absent)) for name, absent in KEY_PARTS[protocol]]
    return digest("sensor_id", F.unix_millis("event_time").cast("string"), *optional)


def hash_identifier(column: str, protocol: str, salt: str) -> Column:
    """Salted SHA-256 of a hardware address, independent of its notation. NULL stays NULL."""
    return F.sha2(F.concat(bare_identifier(column, protocol), F.lit(salt)), 256)


def bare_identifier(column: str, protocol: str) -> Column:
    """A hardware address without separators, in lower case: one form for all notations."""
    return F.lower(F.regexp_replace(column, SEPARATORS[protocol], ""))


def vendor_oui(column: str) -> Column:
    """First three colon-separated octets in lower case; NULL for anything shorter."""
    has_three = F.size(F.split(column, ":")) >= 3
    return F.when(has_three, F.lower(F.substring_index(column, ":", 3)))
