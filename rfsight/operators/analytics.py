"""Device analytics over the timeline and the co-presence pairs.

Groups are aggregated on the map side first, so a device with a third of all rows (or the rows without
a device id) never gathers in one task. Arrays are built only from already grouped values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rfsight.config import Settings
from rfsight.functions.tags import is_randomized
from rfsight.operators.copresence import copresence_counts, folded, stored_classes
from rfsight.operators.tiles import tiled_links

_HOUR_MICROS = 3_600_000_000


def _window_start(seconds: int, time: str = "event_time") -> Column:
    return F.window(time, f"{seconds} seconds")["start"]


def _identified(df: DataFrame) -> DataFrame:
    return df.filter(F.col("device_id_hash").isNotNull())


#: What :func:`sighting_windows` gives, as it is stored.
WINDOW_STATE = T.StructType([
    T.StructField("device_id_hash", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("last_seen", T.TimestampType()),
    T.StructField("sighting_count", T.LongType()),
    T.StructField("latest", T.StructType([
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("rssi_dbm", T.IntegerType()),
    ])),
])


def sighting_windows(timeline: DataFrame) -> DataFrame:
    """First and last sighting per device, protocol and day, with the latest sensor and signal."""
    moment = F.struct("event_time", "event_id", "sensor_id", "rssi_dbm")
    return timeline.groupBy("device_id_hash", "protocol", "event_date").agg(
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
        F.count(F.lit(1)).alias("sighting_count"),
        F.max(moment).alias("latest"),
    )


def merge_sighting_windows(partials: DataFrame) -> DataFrame:
    """Merge partial windows (one per micro-batch) into the latest state."""
    return partials.groupBy("device_id_hash", "protocol", "event_date").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("sighting_count").alias("sighting_count"),
        F.max("latest").alias("latest"),
    )


def flatten_latest(windows: DataFrame) -> DataFrame:
    """Sighting windows with the latest state as plain columns."""
    return windows.select(
        "device_id_hash",
        "protocol",
        "event_date",
        "first_seen",
        "last_seen",
        "sighting_count",
        F.col("latest.sensor_id").alias("last_sensor_id"),
        F.col("latest.rssi_dbm").alias("last_rssi_dbm"),
    )


def repeated_visitors(timeline: DataFrame, more_than: int = 5) -> DataFrame:
    """Devices seen more than ``more_than`` times on one sensor, most frequent first."""
    visits = timeline.groupBy("device_id_hash", "protocol", "sensor_id").agg(
        F.count(F.lit(1)).alias("sighting_count"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )
    span = F.datediff(F.to_date("last_seen"), F.to_date("first_seen"))
    return (
        visits.filter(F.col("sighting_count") > more_than)
        .withColumn("days_active", span)
        .orderBy(F.desc("sighting_count"), "device_id_hash", "protocol", "sensor_id")
    )


def plausible_signal() -> Column:
    """False for a reading outside its radio's range; one impossible value would outweigh all others."""
    return F.col("rssi_dbm").isNotNull() & ~F.array_contains("dq_flags", "RSSI_OUT_OF_RANGE")


def plausible_position() -> Column:
    return F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)


def directional_movement(
    timeline: DataFrame,
    seconds: int = 30,
    more_than: int = 1,
    min_sensors: int = 1,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Readings of one identified device within a short window, where there is more than one, between ``start``
    and ``end`` (both inclusive, times with an offset) if given.

    Equal readings are counted before they are gathered (field ``n``), so the array grows with the
    distinct (sensor, signal, position) values of a window and not with its rows; nothing is lost.
    """
    keys = ["device_id_hash", "window_start"]
    reading = ["sensor_id", "rssi_dbm", "latitude", "longitude"]
    seen = _identified(timeline)
    if start is not None:
        seen = seen.filter(F.col("event_time") >= F.expr(f"TIMESTAMP '{start}'"))
    if end is not None:
        seen = seen.filter(F.col("event_time") <= F.expr(f"TIMESTAMP '{end}'"))
    counted = (
        seen.withColumn("window_start", _window_start(seconds))
        .groupBy(*keys, *reading)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    gathered = counted.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*reading, "n"))).alias("sensor_readings"),
        F.sum("n").alias("reading_count"),
    )
    sensors = F.size(F.array_distinct("sensor_readings.sensor_id"))
    return (
        gathered.filter(F.col("reading_count") > more_than)
        .withColumn("sensor_count", sensors)
        .filter(F.col("sensor_count") >= min_sensors)
    )


def rssi_gradient(timeline: DataFrame, seconds: int = 30) -> DataFrame:
    """Per device and window: the sensor with the strongest signal, and the spread over sensors."""
    heard = _identified(timeline).filter(plausible_signal())
    per_sensor = (
        heard.withColumn("window_start", _window_start(seconds))
        .groupBy("device_id_hash", "window_start", "sensor_id")
        .agg(F.max("rssi_dbm").alias("best"), F.min("rssi_dbm").alias("worst"))
    )
    ranked = F.min(F.struct((-F.col("best")).alias("loss"), F.col("sensor_id")))
    return per_sensor.groupBy("device_id_hash", "window_start").agg(
        ranked["sensor_id"].alias("strongest_sensor"),
        F.max("best").alias("strongest_rssi_dbm"),
        (F.max("best") - F.min("worst")).alias("rssi_spread_db"),
        F.count(F.lit(1)).alias("sensor_count"),
    )


def device_features(timeline: DataFrame, settings: Settings) -> DataFrame:
    """Feature row per identified device as of ``settings.now``; nothing later is looked at."""
    day_ago = settings.now - F.expr("INTERVAL 24 HOURS")
    timeline = timeline.filter(F.col("event_time") <= settings.now)
    recent = F.col("event_time") > day_ago
    features = (
        _identified(timeline)
        .groupBy("device_id_hash")
        .agg(
            F.count_if(recent).alias("sighting_count_24h"),
            F.min("event_time").alias("first_seen_ever"),
            F.max(F.when(plausible_signal(), F.col("rssi_dbm"))).alias("max_rssi_ever"),
            F.max(is_randomized()).alias("randomized_address"),
            F.count_distinct("sensor_id").alias("unique_sensor_count"),
        )
    )
    counted = features.join(copresence_counts(timeline, settings), "device_id_hash", "left")
    return counted.select(
        "device_id_hash",
        "sighting_count_24h",
        "first_seen_ever",
        (F.col("first_seen_ever") > day_ago).alias("is_new"),
        "max_rssi_ever",
        F.coalesce("copresence_count", F.lit(0)).cast("bigint").alias("copresence_count"),
        "randomized_address",
        "unique_sensor_count",
    )


#: What a day adds to the features of a device on a sensor; co-presence pairs stand in rows without a sensor.
FEATURE_DAY = (
    "device_id_hash string, sensor_id string, event_date string, first_seen timestamp, max_rssi int, "
    "randomized boolean, copresence_count bigint"
)


def feature_day(name: str, day: DataFrame, before: DataFrame, settings: Settings) -> DataFrame:
    """Partial features of the rows of the day ``name``, or of its rows up to some time. ``before`` are the rows just before it, as
    far back as co-presence reaches: a pair belongs to the day of its later sighting, so the pairs among ``before``
    are counted and taken off."""
    keys = ["device_id_hash", "sensor_id", "event_date"]
    seen = _identified(day).groupBy(*keys).agg(
        F.min("event_time").alias("first_seen"),
        F.max(F.when(plausible_signal(), F.col("rssi_dbm"))).alias("max_rssi"),
        F.max(is_randomized()).alias("randomized"),
    )
    pairs = copresence_counts(before.unionByName(day), settings)
    earlier = copresence_counts(before, settings).withColumn("copresence_count", -F.col("copresence_count"))
    pairs = pairs.unionByName(earlier).groupBy("device_id_hash").agg(F.sum("copresence_count").alias("copresence_count"))
    pairs = pairs.filter("copresence_count <> 0").withColumn("event_date", F.lit(name))
    return seen.unionByName(pairs, allowMissingColumns=True)


def features_of_days(partials: DataFrame, recent: DataFrame, settings: Settings) -> DataFrame:
    """Device features as :func:`device_features` gives them, from partial features of days and the rows of the last
    24 hours. Sensors are counted by grouping twice, so a device's sensors are never gathered."""
    per_sensor = partials.groupBy("device_id_hash", "sensor_id").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("max_rssi").alias("max_rssi"),
        F.max("randomized").alias("randomized"),
        F.sum("copresence_count").alias("copresence_count"),
    )
    whole = per_sensor.groupBy("device_id_hash").agg(
        F.min("first_seen").alias("first_seen_ever"),
        F.max("max_rssi").alias("max_rssi_ever"),
        F.max("randomized").alias("randomized_address"),
        F.count("sensor_id").alias("unique_sensor_count"),
        F.coalesce(F.sum("copresence_count"), F.lit(0)).alias("copresence_count"),
    )
    day_ago = settings.now - F.expr("INTERVAL 24 HOURS")
    late = _identified(recent).filter((F.col("event_time") <= settings.now) & (F.col("event_time") > day_ago))
    counts = late.groupBy("device_id_hash").agg(F.count(F.lit(1)).alias("n"))
    return whole.join(counts, "device_id_hash", "left").select(
        "device_id_hash",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("sighting_count_24h"),
        "first_seen_ever",
        (F.col("first_seen_ever") > day_ago).alias("is_new"),
        "max_rssi_ever",
        "copresence_count",
        "randomized_address",
        "unique_sensor_count",
    )


def sighting_frequency(timeline: DataFrame) -> DataFrame:
    """Sightings per device, protocol and hour."""
    hourly = timeline.withColumn("hour_start", F.date_trunc("hour", "event_time"))
    return hourly.groupBy("device_id_hash", "protocol", "hour_start").agg(
        F.count(F.lit(1)).alias("sighting_count")
    )


#: A row of a path with its neighbours inside its chunk, as it is stored. Of a neighbour only what the path shows.
_STOP = T.StructType([T.StructField("event_time", T.TimestampType()), T.StructField("sensor_id", T.StringType())])
STEP = ["event_id", "device_id_hash", "protocol", "sensor_id", "event_time", "event_date"]
PATH_PIECE = T.StructType([
    *[T.StructField(c, T.TimestampType() if c == "event_time" else T.StringType()) for c in STEP],
    T.StructField("chunk", T.LongType()),
    T.StructField("before", _STOP),
    T.StructField("after", _STOP),
])


def path_pieces(steps: DataFrame, chunk_hours: int = 1) -> DataFrame:
    """Rows of paths (:data:`STEP`) with their neighbours inside their time chunk; chunk ends stay open."""
    width = F.lit(chunk_hours * _HOUR_MICROS)
    at = F.unix_micros("event_time")
    rows = steps.select(*STEP).withColumn("chunk", at - F.pmod(at, width))
    inside = Window.partitionBy("device_id_hash", "chunk").orderBy("event_time", "event_id")

    def neighbour(of: Callable[[str], Column]) -> Column:
        # field by field, so that rows are shuffled without a copy of themselves
        there = of("event_time").over(inside)
        return F.when(there.isNotNull(), F.struct(there.alias("event_time"), of("sensor_id").over(inside).alias("sensor_id")))

    return rows.withColumns({"before": neighbour(F.lag), "after": neighbour(F.lead)})


def stitched(pieces: DataFrame) -> DataFrame:
    """Whole paths: open ends of a chunk take their neighbours from a small table of the first and last row of each.
    Rows and chunk ends meet on (device, chunk)."""
    keys = ["device_id_hash", "chunk"]
    chunks = Window.partitionBy("device_id_hash").orderBy("chunk")
    stop = F.struct("event_time", "event_id", "sensor_id")

    def kept(end: Column) -> Column:
        return F.when(end.isNotNull(), F.struct(end["event_time"].alias("event_time"), end["sensor_id"].alias("sensor_id")))

    ends = (
        pieces.groupBy(*keys)
        .agg(F.min(stop).alias("first"), F.max(stop).alias("last"))
        .select(
            *keys,
            kept(F.lag("last").over(chunks)).alias("chunk_before"),
            kept(F.lead("first").over(chunks)).alias("chunk_after"),
        )
    )
    joined = pieces.join(ends, keys)
    previous = F.coalesce("before", "chunk_before")
    following = F.coalesce("after", "chunk_after")
    dwell = (F.unix_micros(following["event_time"]) - F.unix_micros("event_time")) / F.lit(1_000_000)
    return joined.select(
        "event_id",
        "device_id_hash",
        "protocol",
        "sensor_id",
        "event_time",
        previous["sensor_id"].alias("previous_sensor_id"),
        (F.col("sensor_id") != previous["sensor_id"]).alias("moved"),
        dwell.alias("dwell_seconds"),
    )


def movement_history(timeline: DataFrame, chunk_hours: int = 1) -> DataFrame:
    """Ordered path per device: previous sensor, whether it moved, seconds until its next sighting.

    A window over a whole device would sort a busy device in one task. The path is cut into time chunks, neighbours
    are found inside each chunk, and the chunks are stitched at their ends.
    """
    return stitched(path_pieces(_identified(timeline), chunk_hours))


def entity_links(copresence: DataFrame) -> DataFrame:
    """Edges between Wi-Fi and Bluetooth identifiers with their evidence.

    Scores have three decimals and are summed as whole thousandths, so the mean does not depend on
    the order in which partial sums arrive.
    """
    both = copresence.filter("wifi_device_hash IS NOT NULL AND bt_device_hash IS NOT NULL")
    millis = F.round(F.col("copresence_score") * 1000).cast("bigint")
    return _links(both.withColumns({"pair_count": F.lit(1).cast("bigint"), "score_millis": millis}))


def class_links(wifi_silver: DataFrame, bt_silver: DataFrame, settings: Settings, min_pairs: int = 1) -> DataFrame:
    """:func:`entity_links` of the co-presence events of two silver tables, of at least ``min_pairs`` events, without a
    row per event: sightings that make the same pairs meet as one, and all of two devices meet in one task."""
    sides = zip(stored_classes(wifi_silver, bt_silver), ("wifi", "bt"))
    wifi, bt = ((classes, folded(classes, prefix)) for classes, prefix in sides)
    return _scored(tiled_links(wifi, bt, settings.copresence_seconds, min_pairs))


def _links(evidence: DataFrame) -> DataFrame:
    """Edges from rows that stand for ``pair_count`` pairs each."""
    ends = ["wifi_device_hash", "bt_device_hash"]
    edges = evidence.groupBy(*ends).agg(
        F.sum("pair_count").alias("pair_count"),
        F.sum("score_millis").alias("score_millis"),
        F.count_distinct("sensor_id").alias("sensor_count"),
        F.min("window_start").alias("first_seen"),
        F.max("window_end").alias("last_seen"),
    )
    return _scored(edges)


def _scored(edges: DataFrame) -> DataFrame:
    mean = F.round(F.col("score_millis") / F.col("pair_count") / F.lit(1000.0), 6)
    return edges.withColumn("mean_score", mean).drop("score_millis")


def unknown_score() -> Column:
    """Suspicion of an unidentified device, 0 to 1: new, disguised, close, never seen with a partner."""
    points = [
        (F.col("is_new"), 40),
        (F.col("randomized_address"), 30),
        (F.col("max_rssi_ever") >= -50, 20),
        (F.col("copresence_count") == 0, 10),
    ]
    total = sum((F.when(condition, F.lit(p)).otherwise(F.lit(0)) for condition, p in points), F.lit(0))
    return total / F.lit(100.0)


def unknown_device_topk(timeline: DataFrame, features: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most suspicious devices per sensor. Ranking prunes to ``k`` per task before the shuffle."""
    seen = _identified(timeline).filter(F.col("sensor_id").isNotNull())
    local = seen.groupBy("sensor_id", "device_id_hash").agg(F.count(F.lit(1)).alias("sighting_count"))
    scored = local.join(
        features.select("device_id_hash", unknown_score().alias("unknown_score")), "device_id_hash"
    )
    order = Window.partitionBy("sensor_id").orderBy(
        F.desc("unknown_score"), F.desc("sighting_count"), "device_id_hash"
    )
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("sensor_id", "rank", "device_id_hash", "unknown_score", "sighting_count")


def sensor_fusion(timeline: DataFrame, seconds: int = 30) -> DataFrame:
    """Position of a device per window: sensor positions weighted by received amplitude."""
    usable = _identified(timeline).filter(plausible_signal() & plausible_position())
    weighted = usable.withColumns(
        {
            "window_start": _window_start(seconds),
            "amplitude": F.pow(F.lit(10.0), F.col("rssi_dbm") / F.lit(20.0)),
        }
    )
    total = F.sum("amplitude")
    return weighted.groupBy("device_id_hash", "window_start").agg(
        F.count_distinct("sensor_id").alias("sensor_count"),
        F.count(F.lit(1)).alias("reading_count"),
        F.max("rssi_dbm").alias("strongest_rssi_dbm"),
        F.round(F.sum(F.col("latitude") * F.col("amplitude")) / total, 6).alias("latitude"),
        F.round(F.sum(F.col("longitude") * F.col("amplitude")) / total, 6).alias("longitude"),
    )
