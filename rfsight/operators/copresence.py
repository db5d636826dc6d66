"""Wi-Fi and Bluetooth sightings on one sensor within a time window: an interval join.

The sensor alone is a poor join key: a few dozen values, and one busy sensor may hold a third of all
rows. Time is cut into buckets and (sensor, bucket) becomes the key. A Bluetooth row (the large side)
stays in its own bucket; a Wi-Fi row is copied to the buckets its window touches. Each pair meets in
exactly one bucket, the exact interval predicate decides, and it also bounds the state of a stream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rfsight.config import Settings
from rfsight.contracts import project
from rfsight.functions.identity import digest
from rfsight.operators.bronze import day_of
from rfsight.operators.expectations import COPRESENCE, ExpectationSet
from rfsight.sources.tables import scratch_layout

_MICROS = 1_000_000


def _bucket(micros: Column, width: int) -> Column:
    """Start of the bucket that holds ``micros``, in whole numbers throughout."""
    return micros - F.pmod(micros, F.lit(width))


def _width(seconds: int) -> int:
    """Microseconds of a bucket: a window touches two or three."""
    return max(2 * seconds * _MICROS, _MICROS)


def _touched(micros: Column, seconds: int) -> Column:
    """The buckets that a window around ``micros`` touches."""
    reach, width = seconds * _MICROS, _width(seconds)
    return F.sequence(_bucket(micros - reach, width), _bucket(micros + reach, width), F.lit(width))


def _side(silver: DataFrame, prefix: str, device: str, extra: list[str]) -> DataFrame:
    return silver.select(
        F.col("sensor_id").alias(f"{prefix}_sensor_id"),
        F.col("event_id").alias(f"{prefix}_event_id"),
        F.col("event_time").alias(f"{prefix}_event_time"),
        F.col(device).alias(f"{prefix}_device_hash"),
        F.col("rssi_dbm").alias(f"{prefix}_rssi_dbm"),
        F.col("distance_est_m").alias(f"{prefix}_distance_m"),
        F.col("confidence").alias(f"{prefix}_confidence"),
        *extra,
    )


def copresence_pairs(
    wifi_silver: DataFrame, bt_silver: DataFrame, settings: Settings, salts: int = 1
) -> DataFrame:
    """Every (Wi-Fi, Bluetooth) pair on one sensor at most the window apart, both ends included.

    ``salts`` > 1 splits each (sensor, bucket) cell further, for sites so dense that one cell
    outgrows a task: Bluetooth rows are spread by id and Wi-Fi rows copied once per salt.
    """
    wifi = _side(wifi_silver, "wifi", "bssid_hash", ["latitude", "longitude"])
    bt = _side(bt_silver, "bt", "device_address_hash", [])
    if wifi_silver.isStreaming and bt_silver.isStreaming:
        wifi = wifi.withWatermark("wifi_event_time", settings.join_watermark)
        bt = bt.withWatermark("bt_event_time", settings.join_watermark)
    return _met(wifi, bt, settings.copresence_seconds, salts)


def _met(
    wifi: DataFrame, bt: DataFrame, seconds: int, salts: int = 1, salt: str = "bt_event_id", cells: DataFrame | None = None
) -> DataFrame:
    """The interval join itself, on rows with a ``wifi_`` or ``bt_`` sensor and time; with ``cells`` in these alone, and
    with their other columns."""
    wifi = wifi.withColumn("wifi_bucket", F.explode(_touched(F.unix_micros("wifi_event_time"), seconds)))
    bt = bt.withColumn("bt_bucket", _bucket(F.unix_micros("bt_event_time"), _width(seconds)))
    if cells is not None:
        own = (F.col("bt_sensor_id") == F.col("cell_sensor_id")) & (F.col("bt_bucket") == F.col("cell_bucket"))
        bt = bt.join(cells, own).drop("cell_sensor_id", "cell_bucket")
    on = (F.col("wifi_sensor_id") == F.col("bt_sensor_id")) & (F.col("wifi_bucket") == F.col("bt_bucket"))
    if salts > 1:
        wifi = wifi.withColumn("wifi_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        bt = bt.withColumn("bt_salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
        on = on & (F.col("wifi_salt") == F.col("bt_salt"))

    window = F.expr(f"INTERVAL {seconds} SECONDS")
    near = F.col("wifi_event_time").between(
        F.col("bt_event_time") - window, F.col("bt_event_time") + window
    )
    helpers = ["wifi_bucket", "bt_bucket", "wifi_salt", "bt_salt", "bt_sensor_id"]
    return wifi.join(bt, on & near).withColumnRenamed("wifi_sensor_id", "sensor_id").drop(*helpers)


#: Where a reading has no confidence.
_UNSURE = 0.5


def _score(wifi: str, bt: str) -> Column:
    """Mean confidence of a pair, to three decimals."""
    sureness = [F.coalesce(F.col(c), F.lit(_UNSURE)) for c in (wifi, bt)]
    return F.round((sureness[0] + sureness[1]) / F.lit(2.0), 3)


def copresence_rows(
    wifi_silver: DataFrame, bt_silver: DataFrame, settings: Settings, salts: int = 1
) -> DataFrame:
    """Pairs with an id, their time window and the mean confidence as score, before any rule."""
    return _rows(copresence_pairs(wifi_silver, bt_silver, settings, salts), settings.now)


def _rows(pairs: DataFrame, now: Column) -> DataFrame:
    start = F.least("wifi_event_time", "bt_event_time")
    return project(
        pairs,
        "copresence_events",
        {
            "copresence_id": digest("wifi_event_id", "bt_event_id"),
            "window_start": start,
            "window_end": F.greatest("wifi_event_time", "bt_event_time"),
            "event_date": day_of(start),
            "copresence_score": _score("wifi_confidence", "bt_confidence"),
            "ingest_time": now,
        },
    )


def copresence_events(
    wifi_silver: DataFrame,
    bt_silver: DataFrame,
    settings: Settings,
    salts: int = 1,
    observation=None,
    before: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Pairs under their rules. ``before`` are Wi-Fi and Bluetooth rows of a history whose own pairs are built
    already: new rows meet those too, and history needs no state."""
    rows = copresence_rows(wifi_silver, bt_silver, settings, salts)
    if before is not None:
        for sides in ((wifi_silver, before[1]), (before[0], bt_silver)):
            rows = rows.unionByName(copresence_rows(*sides, settings, salts))
    return COPRESENCE.enforce(rows, settings, observation)


def copresence_counts(timeline: DataFrame, settings: Settings, chunk_seconds: int = 3600) -> DataFrame:
    """Co-presence pairs per device without forming a single pair.

    A sighting at ``t`` has as many partners as the other protocol has sightings up to ``t + w`` less
    those before ``t - w``. So each row becomes three marks: itself, and a question at either end of
    its window. Running counts along a sensor answer all questions in one sorted pass, linear in the
    rows where the pairs may be quadratic. A sensor's path is cut into time chunks; the totals of
    earlier chunks come from a small table, so a sensor with a third of all rows is many partitions.
    """
    reach = settings.copresence_seconds * _MICROS
    at = F.unix_micros("event_time")

    def mark(when: Column, sign: int) -> Column:
        return F.struct(when.alias("at"), F.lit(sign).alias("sign"))

    is_wifi = F.col("protocol") == "WIFI"
    marks = timeline.filter(F.col("sensor_id").isNotNull()).select(
        "sensor_id",
        "device_id_hash",
        is_wifi.alias("is_wifi"),
        F.inline(F.array(mark(at, 0), mark(at + reach, 1), mark(at - reach - 1, -1))),
    )
    here = F.col("sign") == 0
    marks = marks.filter(here | F.col("device_id_hash").isNotNull()).withColumns(
        {
            "chunk": _bucket(F.col("at"), chunk_seconds * _MICROS),
            "asks": (~here).cast("int"),
            "wifi": F.when(here & F.col("is_wifi"), 1).otherwise(0).cast("bigint"),
            "bt": F.when(here & ~F.col("is_wifi"), 1).otherwise(0).cast("bigint"),
        }
    )
    key = ["sensor_id", "chunk"]
    so_far = Window.partitionBy(*key).orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("sensor_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        marks.groupBy(*key)
        .agg(F.sum("wifi").alias("wifi"), F.sum("bt").alias("bt"))
        .select(
            *key,
            F.coalesce(F.sum("wifi").over(earlier), F.lit(0)).alias("wifi_before"),
            F.coalesce(F.sum("bt").over(earlier), F.lit(0)).alias("bt_before"),
        )
    )
    running = marks.withColumns(
        {"wifi_so_far": F.sum("wifi").over(so_far), "bt_so_far": F.sum("bt").over(so_far)}
    )
    answers = running.filter("sign <> 0").join(totals, key)
    partners = F.when(
        F.col("is_wifi"), F.col("bt_so_far") + F.col("bt_before")
    ).otherwise(F.col("wifi_so_far") + F.col("wifi_before"))
    counts = answers.groupBy("device_id_hash").agg(F.sum(partners * F.col("sign")).alias("copresence_count"))
    return counts.filter("copresence_count > 0")


def pair_count(
    wifi_silver: DataFrame, bt_silver: DataFrame, settings: Settings, chunk_seconds: int = 3600
) -> DataFrame:
    """The number of pairs, one row ``pairs``, without forming one.

    Running counts as in :func:`copresence_counts`, with Wi-Fi rows asking and Bluetooth rows answering: a row asks at
    both ends of its window how many have come by then. Linear in the rows, whatever the number of pairs.
    """
    reach = settings.copresence_seconds * _MICROS
    at = F.unix_micros("event_time")

    def mark(when: Column, sign: int) -> Column:
        return F.struct(when.alias("at"), F.lit(sign).alias("sign"))

    asked = F.inline(F.array(mark(at + reach, 1), mark(at - reach - 1, -1)))
    marks = wifi_silver.select("sensor_id", asked).unionByName(
        bt_silver.select("sensor_id", at.alias("at"), F.lit(0).alias("sign"))
    )
    here = (F.col("sign") == 0).cast("bigint")
    # the chunk as its number: a key of its own, and small
    chunk = F.floor(F.col("at") / F.lit(chunk_seconds * _MICROS))
    marks = marks.filter("sensor_id IS NOT NULL AND at IS NOT NULL").withColumns({"chunk": chunk, "bt": here})
    key = ["sensor_id", "chunk"]
    so_far = Window.partitionBy(*key).orderBy("at", F.col("bt").desc()).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("sensor_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # within a chunk by running counts; Bluetooth rows of earlier chunks count once per question still open
    inside = marks.withColumn("seen", F.sum("bt").over(so_far)).groupBy(*key).agg(
        F.sum("bt").alias("bt"), F.sum("sign").alias("open"), F.sum(F.col("seen") * F.col("sign")).alias("inside")
    )
    before = F.coalesce(F.sum("bt").over(earlier), F.lit(0))
    whole = inside.withColumn("before", before).agg(F.sum(F.col("inside") + F.col("before") * F.col("open")).alias("pairs"))
    return whole.select(F.coalesce("pairs", F.lit(0)).cast("bigint").alias("pairs"))


#: Conditions that no pair breaks: its id is a digest, and a digest is never NULL.
_ALWAYS_TRUE = {"copresence_id IS NOT NULL"}


def _never_broken(rules: ExpectationSet) -> bool:
    return all(rule.condition in _ALWAYS_TRUE for rule in rules.rules)


def copresence_report(
    wifi_silver: DataFrame, bt_silver: DataFrame, settings: Settings, rules: ExpectationSet = COPRESENCE
) -> DataFrame:
    """``rules.report`` over the pairs. Where no rule can be broken, the pairs need only be counted; for any other
    rule they are formed."""
    if not _never_broken(rules):
        return rules.report(copresence_rows(wifi_silver, bt_silver, settings), settings)
    lines = F.array(*[F.struct(F.lit(r.name).alias("expectation"), F.lit(r.action).alias("action")) for r in rules.rules])
    total = pair_count(wifi_silver, bt_silver, settings).select("pairs", F.inline(lines))
    return total.select(
        F.lit(rules.table).alias("table_name"),
        "expectation",
        "action",
        F.lit(0).cast("bigint").alias("failed"),
        F.col("pairs").alias("passed"),
    )


# ---- events by cells --------------------------------------------------------------------------


def _cells(silver: DataFrame, prefix: str, settings: Settings) -> DataFrame:
    """Sensors and buckets of sightings, named by their ends: a Bluetooth row has its own, a Wi-Fi row those its window
    touches. On a stream a cell comes once, and is held a bucket or two longer than a row of it would be."""
    seconds, at = settings.copresence_seconds, F.unix_micros("event_time")
    bucket = F.explode(_touched(at, seconds)) if prefix == "wifi" else _bucket(at, _width(seconds))
    key = [f"{prefix}_sensor_id", f"{prefix}_until"]
    known = silver.filter(F.col("sensor_id").isNotNull() & F.col("event_time").isNotNull())
    cells = known.select(F.col("sensor_id").alias(key[0]), bucket.alias("bucket"))
    cells = cells.select(key[0], F.timestamp_micros(F.col("bucket") + _width(seconds)).alias(key[1]))
    if silver.isStreaming:
        delay = f"{settings.join_watermark} {2 * _width(seconds) // _MICROS} seconds"
        return cells.withWatermark(key[1], delay).dropDuplicatesWithinWatermark(key)
    return cells.distinct()


def copresence_cells(
    wifi_silver: DataFrame,
    bt_silver: DataFrame,
    settings: Settings,
    before: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Co-presence events by the cells in which they meet: sensors and buckets of time that both protocols have reached,
    at most one row per cell whatever the number of pairs. With the silver tables they are the events, see
    :func:`events_of_cells`.

    ``before`` is as in :func:`copresence_events`. Rows that meet these are not told apart by state, so a cell may come
    again.
    """
    if not _never_broken(COPRESENCE):
        raise ValueError("rules that a pair can break are tried on rows, not on cells")

    def met(wifi: DataFrame, bt: DataFrame) -> DataFrame:
        on = (F.col("wifi_sensor_id") == F.col("bt_sensor_id")) & (F.col("wifi_until") == F.col("bt_until"))
        start = F.timestamp_micros(F.unix_micros("wifi_until") - _width(settings.copresence_seconds))
        return wifi.join(bt, on).select(F.col("wifi_sensor_id").alias("sensor_id"), start.alias("cell"))

    wifi, bt = _cells(wifi_silver, "wifi", settings), _cells(bt_silver, "bt", settings)
    rows = met(wifi, bt)
    if before is not None:
        old_wifi, old_bt = _cells(before[0], "wifi", settings), _cells(before[1], "bt", settings)
        rows = rows.unionByName(met(wifi, old_bt)).unionByName(met(old_wifi, bt))
    derived = {
        "event_date": day_of("cell"),
        "reach_seconds": F.lit(settings.copresence_seconds),
        "ingest_time": settings.now,
    }
    return project(rows, "copresence_cells", derived)


def _one_reach(stored: DataFrame) -> int:
    reaches = [r[0] for r in stored.select("reach_seconds").distinct().limit(2).collect()]
    if len(reaches) > 1:
        raise ValueError("co-presence was built with different windows; rebuild it with one")
    return reaches[0] if reaches else 0


def _first_met(cells: DataFrame) -> DataFrame:
    key = [F.col("sensor_id").alias("cell_sensor_id"), F.unix_micros("cell").alias("cell_bucket")]
    return cells.groupBy(*key).agg(F.min("ingest_time").alias("cell_met"))


def events_of_cells(
    cells: DataFrame, wifi_silver: DataFrame, bt_silver: DataFrame, members: DataFrame | None = None
) -> DataFrame:
    """The events of the cells of :func:`copresence_cells`, from the silver tables these were made of.

    A pair is as old as the younger of its sightings, but no older than its cell. ``members`` has the times at which a
    stream has taken sightings in; sightings of a history have none and are as old as their cell. Where all has one time,
    it is not looked up row by row.
    """
    seconds = _one_reach(cells)
    wifi = _side(wifi_silver, "wifi", "bssid_hash", ["latitude", "longitude"])
    bt = _side(bt_silver, "bt", "device_address_hash", [])
    times = cells.select("ingest_time") if members is None else cells.select("ingest_time").union(members.select("ingest_time"))
    if members is None or len(times.distinct().limit(2).collect()) < 2:
        return _rows(_met(wifi, bt, seconds, cells=_first_met(cells)), F.col("cell_met"))

    def taken(side: DataFrame, prefix: str) -> DataFrame:
        key = [f"{prefix}_sensor_id", f"{prefix}_event_time"]
        own = members.filter(F.col("is_wifi") == (prefix == "wifi"))
        first = own.groupBy(F.col("sensor_id").alias(key[0]), F.col("event_time").alias(key[1]))
        return side.join(first.agg(F.min("ingest_time").alias(f"{prefix}_taken")), key, "left")

    pairs = _met(taken(wifi, "wifi"), taken(bt, "bt"), seconds, cells=_first_met(cells))
    return _rows(pairs, F.greatest("cell_met", "wifi_taken", "bt_taken"))


def instants_of_cells(cells: DataFrame, wifi_silver: DataFrame, bt_silver: DataFrame) -> DataFrame:
    """The pairs of instants at which sightings of :func:`copresence_cells` are co-present, each once."""
    seconds = _one_reach(cells)

    def instants(silver: DataFrame, prefix: str) -> DataFrame:
        return silver.select(
            F.col("sensor_id").alias(f"{prefix}_sensor_id"), F.col("event_time").alias(f"{prefix}_event_time")
        ).distinct()

    rows = _met(instants(wifi_silver, "wifi"), instants(bt_silver, "bt"), seconds, cells=_first_met(cells))
    derived = {
        "event_date": day_of(F.least("wifi_event_time", "bt_event_time")),
        "reach_seconds": F.lit(seconds),
        "ingest_time": F.col("cell_met"),
    }
    return project(rows, "copresence_instants", derived)


def events_of_instants(instants: DataFrame, wifi_silver: DataFrame, bt_silver: DataFrame) -> DataFrame:
    """The events of a generation that holds co-presence by pairs of instants, from the silver tables they were made of.

    Only sightings at an instant that has met another take part. A pair is as old as the younger of its sightings, and
    none of these has met before it came: the later of the times at which its two instants first met is the pair's.
    """

    def taking_part(silver: DataFrame, prefix: str, device: str, extra: list[str]) -> DataFrame:
        key = [f"{prefix}_sensor_id", f"{prefix}_event_time"]
        met = instants.select(F.col("sensor_id").alias(key[0]), key[1], "ingest_time")
        met = met.groupBy(*key).agg(F.min("ingest_time").alias(f"{prefix}_met"))
        return _side(silver, prefix, device, extra).join(met, key)

    wifi = taking_part(wifi_silver, "wifi", "bssid_hash", ["latitude", "longitude"])
    bt = taking_part(bt_silver, "bt", "device_address_hash", [])
    return _rows(_met(wifi, bt, _one_reach(instants)), F.greatest("wifi_met", "bt_met"))


# ---- links without a row per pair -------------------------------------------------------------


def sighting_classes(silver: DataFrame, prefix: str, device: str) -> DataFrame:
    """Sightings that make the same pairs, as one row with their number: same sensor, instant, device and confidence.

    A confidence of whole five-hundredths adds whole thousandths to the score of any pair with another such one, so
    ``units`` has it in these; other confidences have none there.
    """
    known = silver.filter(F.col(device).isNotNull() & F.col("sensor_id").isNotNull() & F.col("event_time").isNotNull())
    sure = F.coalesce(F.col("confidence"), F.lit(_UNSURE))
    fold = known.groupBy(
        F.col("sensor_id").alias(f"{prefix}_sensor_id"),
        F.col("event_time").alias(f"{prefix}_event_time"),
        F.col(device).alias(f"{prefix}_device_hash"),
        sure.alias(f"{prefix}_confidence"),
    ).agg(F.count(F.lit(1)).alias(f"{prefix}_n"))
    parts = F.col(f"{prefix}_confidence") * 500
    whole = (F.abs(parts - F.round(parts)) < 1e-6) & (F.abs(parts) < 1e9)
    return fold.withColumn(f"{prefix}_units", F.when(whole, F.round(parts).cast("bigint")))


def folded(classes: DataFrame, prefix: str) -> DataFrame:
    """Classes with units, whatever these are, as one row per sensor, instant and device."""
    own = classes.filter(F.col(f"{prefix}_units").isNotNull())
    return own.groupBy(f"{prefix}_sensor_id", f"{prefix}_event_time", f"{prefix}_device_hash").agg(
        F.sum(F.col(f"{prefix}_n") * F.col(f"{prefix}_units")).alias(f"{prefix}_units"),
        F.sum(f"{prefix}_n").alias(f"{prefix}_n"),
    )


def link_evidence(wifi: DataFrame, bt: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of :func:`sighting_classes` that are co-present, with how many pairs each stands for and the sum of their
    scores in thousandths. Copies of a sighting, however many, meet as one row."""
    whole = _met(folded(wifi, "wifi"), folded(bt, "bt"), settings.copresence_seconds)
    millis = F.col("wifi_units") * F.col("bt_n") + F.col("bt_units") * F.col("wifi_n")
    parts = [whole.withColumn("score_millis", millis)]
    # the sum of rounded scores does not fall apart where a confidence is finer: these meet one by one
    wifi_odd, bt_odd = (df.filter(F.col(f"{p}_units").isNull()) for df, p in ((wifi, "wifi"), (bt, "bt")))
    alone = F.round(_score("wifi_confidence", "bt_confidence") * 1000).cast("bigint") * F.col("wifi_n") * F.col("bt_n")
    if not wifi_odd.isEmpty():
        parts.append(_met(wifi_odd, bt, settings.copresence_seconds).withColumn("score_millis", alone))
    if not bt_odd.isEmpty():
        parts.append(_met(wifi.filter("wifi_units IS NOT NULL"), bt_odd, settings.copresence_seconds).withColumn("score_millis", alone))
    shown = [
        "wifi_device_hash",
        "bt_device_hash",
        "sensor_id",
        (F.col("wifi_n") * F.col("bt_n")).alias("pair_count"),
        "score_millis",
        F.least("wifi_event_time", "bt_event_time").alias("window_start"),
        F.greatest("wifi_event_time", "bt_event_time").alias("window_end"),
    ]
    return reduce(DataFrame.unionByName, [part.select(*shown) for part in parts])


def stored_classes(wifi_silver: DataFrame, bt_silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classes of both sides as tables in the shared folder: each silver table is made once."""
    spark, layout, out = wifi_silver.sparkSession, scratch_layout(wifi_silver.sparkSession, "classes"), []
    for silver, prefix, device in ((wifi_silver, "wifi", "bssid_hash"), (bt_silver, "bt", "device_address_hash")):
        classes = sighting_classes(silver, prefix, device)
        classes.write.parquet(layout.table(prefix))
        out.append(spark.read.schema(classes.schema).parquet(layout.table(prefix)))
    return tuple(out)


def copresence_classes(wifi_silver: DataFrame, bt_silver: DataFrame, settings: Settings) -> DataFrame:
    """Co-present classes of equal sightings: ``pair_count`` adds up to the number of events between two devices."""
    rows = link_evidence(*stored_classes(wifi_silver, bt_silver), settings)
    return project(rows, "copresence_classes", {"event_date": day_of("window_start")})
