"""Free-text fields mapped to controlled vocabularies, driven by spelling tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: canonical terms, accepted spellings, frequency ranges -----------------------
BAND_SPELLINGS = {
    "2.4GHz": ["2.4", "2.4ghz", "2"],
    "5GHz": ["5", "5ghz"],
    "6GHz": ["6", "6ghz"],
}
BAND_MHZ = {"2.4GHz": (2400, 2500), "5GHz": (5170, 5835), "6GHz": (5925, 7125)}
SCANNER_BAND_GHZ = {"2.4": (2.4, 2.5), "5": (5.17, 5.83), "6": (5.93, 7.13)}
OPEN_SPELLINGS = ["OPEN", "NONE", ""]
CIPHERS = ["WPA3", "WPA2", "WPA", "WEP"]  # first one contained in the text wins
SUBTYPE_SPELLINGS = {
    "BLE": ["BLE", "BTLE", "BT_LE", "LOW_ENERGY"],
    "BT_CLASSIC": ["CLASSIC", "BT_CLASSIC", "BR/EDR", "BREDR"],
}
ADV_SPELLINGS = {
    "ADV_IND": ["ADV_IND", "CONNECTABLE_UNDIRECTED"],
    "ADV_DIRECT_IND": ["ADV_DIRECT_IND", "CONNECTABLE_DIRECTED"],
    "ADV_NONCONN_IND": ["ADV_NONCONN_IND", "NON_CONNECTABLE"],
    "SCAN_RSP": ["SCAN_RSP", "SCAN_RESPONSE"],
    "ADV_SCAN_IND": ["ADV_SCAN_IND", "SCANNABLE_UNDIRECTED"],
}
CONNECTABLE = ["ADV_IND", "ADV_DIRECT_IND"]
# ----------------------------------------------------------------------------------------------


def first_true(cases: list[tuple[Column, str]], otherwise: Column) -> Column:
    """CASE over (condition, term) pairs in order."""
    (condition, term), *rest = cases
    chain = F.when(condition, F.lit(term))
    for condition, term in rest:
        chain = chain.when(condition, F.lit(term))
    return chain.otherwise(otherwise)


def _spelled(text: Column, table: dict[str, list[str]], otherwise: Column) -> Column:
    return first_true([(text.isin(spellings), term) for term, spellings in table.items()], otherwise)


def _within(value: Column, ranges: dict[str, tuple]) -> Column:
    return first_true(
        [(value.between(low, high), term) for term, (low, high) in ranges.items()],
        F.lit(None).cast("string"),
    )


def band(label: str = "band", frequency: str = "frequency_mhz") -> Column:
    """A recognised label decides; otherwise the frequency does."""
    return _spelled(F.lower(F.trim(label)), BAND_SPELLINGS, _within(F.col(frequency), BAND_MHZ))


def scanner_band(ghz: Column) -> Column:
    """Raw label a scanner reports; its ranges are narrower than those of :func:`band`."""
    return _within(ghz, SCANNER_BAND_GHZ)


def encryption(column: str = "encryption") -> Column:
    text = F.upper(F.trim(column))
    cases = [(text.isin(OPEN_SPELLINGS), "OPEN")]
    cases += [(text.contains(cipher), cipher) for cipher in CIPHERS]
    return first_true(cases, F.lit("UNKNOWN"))


def protocol_subtype(column: str = "protocol_subtype") -> Column:
    return _spelled(F.upper(F.trim(column)), SUBTYPE_SPELLINGS, F.lit("UNKNOWN"))


def adv_type(column: str = "adv_type") -> Column:
    """Unlisted types pass through trimmed and upper-cased; NULL stays NULL."""
    text = F.upper(F.trim(column))
    return _spelled(text, ADV_SPELLINGS, text)


def is_connectable(canonical_adv_type: Column) -> Column:
    return canonical_adv_type.isin(CONNECTABLE)


def infer_adv_type(name: str = "device_name", services: str = "service_uuids") -> Column:
    """A named device or one that offers services is taken as connectable."""
    named = F.coalesce(F.length(name) > 0, F.lit(False))
    serving = F.coalesce(F.size(services) > 0, F.lit(False))
    return F.when(named | serving, F.lit("ADV_IND")).otherwise(F.lit("ADV_NONCONN_IND"))
