"""Signal strength arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: reference power at one metre, path-loss exponent, plausible ranges (dBm) ----
WIFI_REFERENCE_DBM = -40
BLE_REFERENCE_DBM = -59
PATH_LOSS_EXPONENT = 2.0
WIFI_DISTANCE_RSSI = (-100, -20)
BLE_DISTANCE_RSSI = (-110, 0)
BLE_DISTANCE_TX = (-100, 20)
# ----------------------------------------------------------------------------------------------


def _log_distance(reference: Column, rssi: Column) -> Column:
    return F.pow(F.lit(10.0), (reference - rssi) / F.lit(10.0 * PATH_LOSS_EXPONENT))


def distance_wifi(rssi: str = "rssi_dbm") -> Column:
    """Metres by log-distance path loss; NULL outside the plausible range."""
    dbm = F.col(rssi).cast("double")
    return F.when(dbm.between(*WIFI_DISTANCE_RSSI), _log_distance(F.lit(float(WIFI_REFERENCE_DBM)), dbm))


def distance_ble(rssi: str = "rssi_dbm", tx: str = "tx_power") -> Column:
    """As :func:`distance_wifi` with the advertised power as reference, to the centimetre."""
    dbm = F.col(rssi).cast("double")
    reference = F.coalesce(F.col(tx), F.lit(BLE_REFERENCE_DBM)).cast("double")
    plausible = dbm.between(*BLE_DISTANCE_RSSI) & reference.between(*BLE_DISTANCE_TX)
    return F.when(plausible, F.round(_log_distance(reference, dbm), 2))


def path_loss(tx: str = "tx_power", rssi: str = "rssi_dbm") -> Column:
    """Transmitted minus received power; NULL if either is missing or the difference overflows."""
    return F.try_subtract(F.col(tx), F.col(rssi)).cast("int")


def ble_confidence(rssi: str = "rssi_dbm") -> Column:
    """``(rssi + 100) / 80`` to three decimals, kept within 0.3 to 1.

    Every odd step is a decimal tie. It is settled by the binary value of the quotient, and to even
    where that is exact; multiplying by 64 and 16 is exact, so ``residue`` is its true distance.
    """
    steps = F.col(rssi).cast("double") + F.lit(100.0)
    quotient = steps / F.lit(80.0)
    residue = (quotient * F.lit(64.0) - steps) + quotient * F.lit(16.0)
    whole = F.floor(steps * F.lit(12.5))
    tie = steps * F.lit(12.5) > whole
    upward = tie & ((residue > 0) | ((residue == 0) & (whole % 2 != 0)))
    rounded = (whole + upward.cast("int")) / F.lit(1000.0)
    return F.when(F.col(rssi).isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.3), rounded)))


def snr(rssi: Column, noise: Column) -> Column:
    """Signal over noise; a zero reading counts as absent."""
    return F.when((rssi != 0) & (noise != 0), F.round((rssi - noise).cast("double"), 1))


def link_quality(part: Column, whole: Column) -> Column:
    """Quality ``part/whole`` as a confidence; NULL when the scale is missing or zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), 3)
