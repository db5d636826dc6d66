"""Joins to reference tables: manufacturer names, authorised re-identification, device history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rfsight.config import Settings
from rfsight.functions.identity import bare_identifier, hash_identifier

# --- fixed values: Bluetooth company ids -------------------------------------------------------
MANUFACTURERS = {
    6: "Microsoft",
    76: "Apple",
    89: "Nordic Semiconductor",
    107: "Polar",
    117: "Samsung",
    135: "Garmin",
    224: "Google",
    334: "Kontakt.io",
    742: "Fitbit",
    1177: "Ruuvi Innovations",
    1521: "Espressif",
    13249: "Tile",
}
# ----------------------------------------------------------------------------------------------


def manufacturer_dim(spark: SparkSession) -> DataFrame:
    """The built-in company table (twelve rows)."""
    return spark.createDataFrame(list(MANUFACTURERS.items()), "manufacturer_id int, name string")


def resolve_manufacturer(bt_silver: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Fill ``manufacturer_name``; unknown ids stay NULL and no row is lost.

    The built-in table is broadcast because its size is fixed. A caller's own table is not hinted:
    the optimiser broadcasts it only if its measured size allows.
    """
    names = F.broadcast(manufacturer_dim(bt_silver.sparkSession)) if dim is None else dim
    columns = bt_silver.columns
    named = bt_silver.drop("manufacturer_name").join(
        names.select("manufacturer_id", F.col("name").alias("manufacturer_name")),
        "manufacturer_id",
        "left",
    )
    return named.select(*columns)


def identifier_lookup(bronze: DataFrame, column: str, protocol: str, settings: Settings) -> DataFrame:
    """Distinct hash to raw address pairs. Restricted: run only in an authorised job."""
    pairs = bronze.filter(F.col(column).isNotNull()).select(
        hash_identifier(column, protocol, settings.salt_for(protocol)).alias("identifier_hash"),
        F.col(column).alias("raw_identifier"),
    )
    return pairs.distinct()


def address_book(wifi_bronze: DataFrame, bt_bronze: DataFrame, settings: Settings) -> DataFrame:
    """(protocol, identifier_hash, raw_identifier) of both protocols, one row per hash: the address in its bare
    form, which all its notations have in common. Restricted, as :func:`identifier_lookup`."""

    def of(bronze: DataFrame, column: str, protocol: str, name: str) -> DataFrame:
        hashed = hash_identifier(column, protocol, settings.salt_for(protocol)).alias("identifier_hash")
        bare = bare_identifier(column, protocol).alias("raw_identifier")
        return bronze.filter(F.col(column).isNotNull()).select(F.lit(name).alias("protocol"), hashed, bare).distinct()

    return of(wifi_bronze, "bssid", "wifi", "WIFI").unionByName(of(bt_bronze, "device_address", "bt", "BLUETOOTH"))


def reidentify(df: DataFrame, book: DataFrame, hash_column: str) -> DataFrame:
    """Attach the raw address to hashed rows that carry their protocol; as many rows come out as go in."""
    return df.join(book.withColumnRenamed("identifier_hash", hash_column), ["protocol", hash_column], "left")


def novel_device(timeline: DataFrame) -> DataFrame:
    """Sightings with no earlier sighting of the same device (ties on the first instant all count).

    The semi join runs on (device, time), so a device with a third of all rows spreads over tasks.
    Rows without a device id have no identity to be new and are not reported.
    """
    known = timeline.filter(F.col("device_id_hash").isNotNull())
    first = known.groupBy("device_id_hash").agg(F.min("event_time").alias("event_time"))
    return known.join(first, ["device_id_hash", "event_time"], "left_semi").select(timeline.columns)


def unseen_in(timeline: DataFrame, history: DataFrame) -> DataFrame:
    """Rows of a new batch whose device does not occur in an earlier history table."""
    devices = history.select("device_id_hash").filter(F.col("device_id_hash").isNotNull()).distinct()
    known = timeline.filter(F.col("device_id_hash").isNotNull())
    return known.join(devices, "device_id_hash", "left_anti").select(timeline.columns)


# ---- first sightings over batches -------------------------------------------------------------

#: Bits of the filter of known devices, and hashes per device. It lies in rows of 32768 bits each; a filter that fills
#: up lets more devices through to the join and loses none.
FILTER_BITS, FILTER_HASHES = 1 << 28, 3


def _marks(device: str = "device_id_hash") -> Column:
    """(bucket, bit) of each of a device's hashes."""
    places = [F.pmod(F.xxhash64(F.col(device), F.lit(k)), F.lit(FILTER_BITS)) for k in range(FILTER_HASHES)]
    return F.array(*[F.struct(F.bitmap_bucket_number(p).alias("bucket"), F.bitmap_bit_position(p).alias("bit")) for p in places])


def known_bits(devices: DataFrame) -> DataFrame:
    """(bucket, bits) of the filter with these devices in it."""
    marks = devices.select(F.inline(_marks()))
    return marks.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merge_bits(partials: DataFrame) -> DataFrame:
    return partials.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def perhaps_known(devices: DataFrame, bits: DataFrame) -> DataFrame:
    """Devices that the filter has, and a few that it only seems to have; never one less."""
    marks = devices.select("device_id_hash", F.inline(_marks()))
    byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("getbit", byte, (F.col("bit") % 8).cast("int")) == 1
    hits = marks.join(bits, "bucket").filter(is_set).groupBy("device_id_hash").agg(F.count(F.lit(1)).alias("hits"))
    return hits.filter(F.col("hits") == FILTER_HASHES).select("device_id_hash")


def first_seen(timeline: DataFrame) -> DataFrame:
    """(device_id_hash, first_seen) of identified devices."""
    known = timeline.filter(F.col("device_id_hash").isNotNull())
    return known.groupBy("device_id_hash").agg(F.min("event_time").alias("first_seen"))


def merge_first_seen(partials: DataFrame) -> DataFrame:
    return partials.groupBy("device_id_hash").agg(F.min("first_seen").alias("first_seen"))


def novel_candidates(timeline: DataFrame, before: DataFrame, perhaps: DataFrame) -> DataFrame:
    """Rows at their device's first time in a batch, unless ``before`` (partial first times) has an earlier one. Only
    devices that ``perhaps`` are known are looked up. Rows of a table are novel when they are candidates and no later batch has
    brought an earlier sighting."""
    first = first_seen(timeline).withColumnRenamed("first_seen", "event_time")
    old = merge_first_seen(before.join(perhaps, "device_id_hash", "left_semi"))
    old = old.withColumnRenamed("first_seen", "known_since")
    first = first.join(old, "device_id_hash", "left").filter("known_since IS NULL OR event_time <= known_since")
    return timeline.join(first.drop("known_since"), ["device_id_hash", "event_time"], "left_semi").select(timeline.columns)
