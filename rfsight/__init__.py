"""rfsight: radio-frequency observation analytics as plain Spark DataFrame functions."""

from rfsight.config import Settings
from rfsight.contracts import BT, WIFI, ContractError, conform, contract

__all__ = ["BT", "WIFI", "ContractError", "Settings", "conform", "contract"]
