"""Bronze to silver: one flat projection per protocol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rfsight.config import Settings
from rfsight.contracts import project
from rfsight.functions import address, signal, tags, vocabulary
from rfsight.functions.identity import hash_identifier
from rfsight.operators.dedup import dedup
from rfsight.operators.expectations import SILVER


def normalize_wifi(bronze: DataFrame, settings: Settings) -> DataFrame:
    salt = settings.salt_for("wifi")
    randomized = address.is_randomized_mac()
    derived = {
        f"{name}_hash": hash_identifier(name, "wifi", salt)
        for name in ("bssid", "client_mac", "ap_mac", "transmitter_mac")
    }
    derived |= {
        "band": vocabulary.band(),
        "encryption": vocabulary.encryption(),
        "distance_est_m": signal.distance_wifi(),
        "is_randomized_mac": randomized,
        "is_hidden_ssid": F.coalesce(F.length("ssid"), F.lit(0)) == 0,
        "dq_flags": tags.wifi_quality_flags(randomized),
        "pipeline_id": F.lit(settings.run_id),
    }
    return project(bronze, "wifi_silver", derived)


def normalize_bt(bronze: DataFrame, settings: Settings) -> DataFrame:
    """``manufacturer_name`` stays NULL here; see :func:`rfsight.operators.lookup.resolve_manufacturer`."""
    randomized = address.is_randomized_address()
    subtype = vocabulary.protocol_subtype()
    adv = vocabulary.adv_type()
    derived = {
        "device_address_hash": hash_identifier("device_address", "bt", settings.salt_for("bt")),
        "manufacturer_name": F.lit(None),
        "protocol_subtype": subtype,
        "adv_type": adv,
        "path_loss_db": signal.path_loss(),
        "distance_est_m": signal.distance_ble(),
        "is_randomized_address": randomized,
        "is_connectable": vocabulary.is_connectable(adv),
        "dq_flags": tags.bt_quality_flags(randomized, subtype),
        "pipeline_id": F.lit(settings.run_id),
    }
    return project(bronze, "bt_silver", derived)


NORMALIZERS = {"wifi": normalize_wifi, "bt": normalize_bt}


def to_silver(
    bronze: DataFrame,
    protocol: str,
    settings: Settings,
    observation=None,
    known: DataFrame | None = None,
    clock: str = "event_time",
) -> DataFrame:
    """Deduplicate, normalise, then enforce the silver expectations. ``known`` are bronze rows of a history that is
    built already: copies of them are duplicates too. An id tells its day, so the day is part of the key. ``clock`` is
    the time that a stream's watermark follows."""
    if known is not None:
        day_and_id = ["event_date", "event_id"]
        bronze = bronze.join(known.select(*day_and_id), day_and_id, "left_anti").select(bronze.columns)
    unique = dedup(bronze, settings.watermark_for(protocol), clock)
    normal = NORMALIZERS[protocol](unique, settings)
    return SILVER[protocol].enforce(normal, settings, observation)
