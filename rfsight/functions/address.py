"""What the leading octet of a hardware address says about it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: second hex digit of the first octet that marks a randomised address ---------
WIFI_RANDOM_DIGITS = "26aAeE"
BT_RANDOM_DIGITS = "01234567cCdDeEfF"
# Two most significant bits of a Bluetooth LE random address
BT_ADDRESS_CLASSES = {3: "STATIC_RANDOM", 1: "RESOLVABLE_PRIVATE", 0: "NON_RESOLVABLE_PRIVATE"}
# ----------------------------------------------------------------------------------------------

_OCTET = r"^([0-9a-fA-F]{2})"


def leading_octet(column: str) -> Column:
    """The first octet as hex text; empty when the address does not begin with one."""
    return F.regexp_extract(column, _OCTET, 1)


def is_randomized_mac(column: str = "bssid") -> Column:
    """Wi-Fi rule on the second digit. NULL for a NULL address, false for a malformed one."""
    return leading_octet(column).substr(2, 1).isin(*WIFI_RANDOM_DIGITS)


def is_randomized_address(column: str = "device_address", reported: str = "address_randomized") -> Column:
    """Bluetooth rule: the reported flag wins, the digit decides otherwise; NULL for no address."""
    guess = leading_octet(column).substr(2, 1).isin(*BT_RANDOM_DIGITS)
    return F.when(F.col(column).isNotNull(), F.coalesce(F.col(reported), guess))


def octet_value(column: str) -> Column:
    octet = leading_octet(column)
    return F.when(octet != "", F.conv(octet, 16, 10).cast("int"))


def address_class(column: str) -> Column:
    """Bit-accurate class from the top two bits of the first octet (`10` is unassigned)."""
    top = F.shiftright(octet_value(column), 6)
    named = F.when(top == 2, F.lit("UNASSIGNED"))
    for bits, name in BT_ADDRESS_CLASSES.items():
        named = named.when(top == bits, F.lit(name))
    return named


def is_locally_administered(column: str) -> Column:
    """IEEE 802 locally-administered bit of the first octet."""
    return octet_value(column).bitwiseAND(F.lit(2)) != 0
