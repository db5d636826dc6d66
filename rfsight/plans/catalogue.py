"""The query catalogue: every operator as a query over the driver's tables, with its reference SQL.

A query is a function of :class:`Views`. Where plain SQL says the same, the statement stands next to it.
Queries that exercise files or streams write the adapter's rows to the shared folder first, whole.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rfsight.config import Settings, pin_session
from rfsight.contracts import BT, WIFI, conform, contract
from rfsight.functions import address, signal, tags, vocabulary
from rfsight.functions.identity import event_key, hash_identifier, vendor_oui
from rfsight.operators import analytics, bronze, clusters, expectations, lookup, outbox, reports
from rfsight.operators.copresence import copresence_classes, copresence_counts, copresence_pairs, copresence_report
from rfsight.operators.dedup import dedup_batch, dedup_stream, first_per_window
from rfsight.operators.silver import NORMALIZERS, to_silver
from rfsight.operators.timeline import alert_candidates, alert_rows, device_timeline, high_threat, timeline_rows
from rfsight.plans import adapter
from rfsight.plans import oracle as o
from rfsight.plans.medallion import Medallion, backfill, with_stamps
from rfsight.sources import landing, scan_dump, tables
from rfsight.streaming import arrivals as landed
from rfsight.streaming import flows, metrics


@dataclass(frozen=True)
class Views:
    """Adapter rows and medallion tables for one scale folder."""

    spark: SparkSession
    sf_dir: str
    settings: Settings

    @cached_property
    def medallion(self) -> Medallion:
        wifi, bt = (with_stamps(self.landed(p), p, self.settings) for p in (WIFI, BT))
        return Medallion(wifi, bt, self.settings)

    def landed(self, protocol: str) -> DataFrame:
        return adapter.LANDINGS[protocol](self.spark, self.sf_dir)

    def bronze(self, protocol: str) -> DataFrame:
        return self.medallion.bronze(protocol)

    def silver(self, protocol: str) -> DataFrame:
        return self.medallion.silver(protocol)

    @property
    def timeline(self) -> DataFrame:
        return self.medallion.timeline()

    @property
    def alerts(self) -> DataFrame:
        return self.medallion.alerts()

    @property
    def copresence(self) -> DataFrame:
        return self.medallion.copresence()

    @property
    def pairs(self) -> DataFrame:
        return copresence_pairs(self.silver(WIFI), self.silver(BT), self.settings)

    @property
    def links(self) -> DataFrame:
        return self.links_from(1)

    def links_from(self, min_pairs: int) -> DataFrame:
        return analytics.class_links(self.silver(WIFI), self.silver(BT), self.settings, min_pairs)

    @cached_property
    def stored_timeline(self) -> DataFrame:
        """The timeline as a table, for queries that read it more than once."""
        layout = self.scratch("timeline")
        tables.write_table(self.timeline, layout, "device_timeline")
        return tables.read_table(self.spark, layout, "device_timeline")

    @property
    def features(self) -> DataFrame:
        return analytics.device_features(self.stored_timeline, self.settings)

    def lines(self, protocol: str) -> DataFrame:
        return adapter.landing_lines(self.spark, self.sf_dir, protocol)

    def quarantine(self, protocol: str) -> DataFrame:
        """Rescued rows stamped with the time the adapter received them."""
        return bronze.to_quarantine(self._parsed_lines(protocol), protocol, self.settings)

    def parsed_bronze(self, protocol: str) -> DataFrame:
        """Bronze rows of the same lines."""
        rows = landing.stamp(self._parsed_lines(protocol), protocol, self.settings)
        return bronze.to_bronze(rows.withColumn("ingest_time", F.col("received")), protocol, self.settings)

    def _parsed_lines(self, protocol: str) -> DataFrame:
        rows = landing.parse_lines(self.lines(protocol), protocol).withColumn("ingest_time", F.col("received"))
        return rows.withColumn("event_date", bronze.day_of("event_time"))

    @property
    def outbox(self) -> DataFrame:
        return adapter.outbox(self.spark, self.sf_dir)

    def scratch(self, label: str) -> tables.Layout:
        return tables.scratch_layout(self.spark, label)


@dataclass(frozen=True)
class Query:
    build: Callable[[Views], DataFrame]
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(name: str, select: str | None = None):
    """Register a query; ``select`` is the final SELECT of its reference SQL."""

    def register(build: Callable[[Views], DataFrame]):
        CATALOGUE[name] = Query(build, o.sql(select) if select else None)
        return build

    return register


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    views = Views(pin_session(spark), sf_dir, adapter.settings())
    return plain(CATALOGUE[name].build(views))


def plain(df: DataFrame) -> DataFrame:
    """Comparable columns: times as epoch microseconds, arrays and maps as text, metres to 1e-6."""

    def show(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        elif isinstance(field.dataType, T.MapType):
            entry = F.transform(F.map_entries(column), lambda kv: F.concat(kv["key"], F.lit("="), kv["value"]))
            column = F.array_join(F.array_sort(entry), ",")
        elif "distance" in field.name:
            column = F.round(column, 6)
        return column.alias(field.name)

    return df.select(*[show(f) for f in df.schema.fields])


def each_sql(template: str) -> str:
    """SQL of a query over both protocols: ``@`` stands for the protocol, which comes out as a column too."""
    return " UNION ALL ".join(f"SELECT '{p}' AS protocol, * FROM ({template.replace('@', p)})" for p in (WIFI, BT))


def each(build: Callable[[str], DataFrame]) -> DataFrame:
    """Rows of both protocols, with the protocol as first column."""
    wifi, bt = (build(p).select(F.lit(p).alias("protocol"), "*") for p in (WIFI, BT))
    return wifi.unionByName(bt)


def _shown(table: str, rename: dict[str, str] | None = None, skip: tuple[str, ...] = ()) -> str:
    """SQL select list for a contract, in the form :func:`plain` gives."""
    parts = []
    for f in contract(table).fields:
        if f.name in skip:
            continue
        text = (rename or {}).get(f.name, f.name)
        if isinstance(f.dataType, T.ArrayType):
            text = f"array_to_string({text}, ',')"
        elif "distance" in f.name:
            text = o.HALF_UP(text, 6)
        parts.append(f"{text} AS {f.name}")
    return ", ".join(parts)


# ---- sources and sinks ------------------------------------------------------------------------


def _landing_scan(views: Views, protocol: str) -> DataFrame:
    layout = views.scratch("landing")
    payload = views.landed(protocol).select(*contract(f"{protocol}_payload").fieldNames())
    landing.export_ndjson(payload, layout.landing(protocol), by=None)
    rows = landing.read_landing(views.spark, layout.landing(protocol), protocol, views.settings)
    return rows.select(*payload.columns, "event_id", "_rescued_data")


@query(
    "landing_scan",
    f"SELECT {_shown('wifi_payload')}, {o.EVENT_ID_WIFI} AS event_id, NULL::VARCHAR AS _rescued_data FROM wifi_landed",
)
def _(views):
    return _landing_scan(views, WIFI)


@query(
    "landing_scan_bt",
    f"SELECT {_shown('bt_payload')}, {o.EVENT_ID_BT} AS event_id, NULL::VARCHAR AS _rescued_data FROM bt_landed",
)
def _(views):
    return _landing_scan(views, BT)


@query(
    "ingest_metadata",
    each_sql(f"""SELECT e, {o.NOW} AS ingest_time, {o.DAY_OF("event_time")} AS event_date, source_path,
    '{adapter.RUN_ID}' AS pipeline_id FROM @_landed"""),
)
def _(views):
    def stamped(p: str) -> DataFrame:
        rows = bronze.with_ingest_metadata(views.landed(p), views.settings, F.col("source_path"))
        return rows.select("e", "ingest_time", "event_date", "source_path", "pipeline_id")

    return each(stamped)


_LINE_SQL = """CASE WHEN fault <> 0 THEN nullif(sensor_id, NULL) END AS sensor_id,
    CASE WHEN fault <> 0 THEN ms * 1000 END AS event_time, CASE WHEN fault <> 0 THEN message_id END AS message_id,
    CASE WHEN fault <> 0 THEN rssi_dbm END AS rssi_dbm, NULL::INTEGER AS mistyped, _rescued_data, source_path"""


def _line_columns(protocol: str) -> list:
    mistyped = F.col(adapter.MISTYPED[protocol]).alias("mistyped")
    return ["sensor_id", "event_time", "message_id", "rssi_dbm", mistyped, "_rescued_data", "source_path"]


@query("rescued_rows", each_sql(f"SELECT e, {_LINE_SQL} FROM @_rescued"))
def _(views):
    return each(lambda p: landing.parse_lines(views.lines(p), p).select("e", *_line_columns(p)))


@query(
    "quarantine",
    each_sql(f"""SELECT _rescued_data, CASE WHEN fault <> 0 THEN sensor_id END AS sensor_id,
    CASE WHEN fault <> 0 THEN ms * 1000 END AS event_time, {o.NOW} AS ingest_time,
    '2024-01-01' AS event_date, source_path FROM @_rescued WHERE _rescued_data IS NOT NULL"""),
)
def _(views):
    def held(p: str) -> DataFrame:
        landed = landing.stamp(landing.parse_lines(views.lines(p), p), p, views.settings)
        return bronze.to_quarantine(landed, p, views.settings)

    return each(held)


def _silver_scan(views: Views, protocol: str) -> DataFrame:
    layout, name = views.scratch("silver"), f"{protocol}_silver"
    tables.write_table(views.silver(protocol), layout, name)
    return tables.read_table(views.spark, layout, name).filter(F.col("event_date") == "2024-01-01")


@query("silver_scan", f"SELECT {_shown('wifi_silver')} FROM wifi_silver WHERE event_date = '2024-01-01'")
def _(views):
    return _silver_scan(views, WIFI)


@query("silver_scan_bt", f"SELECT {_shown('bt_silver')} FROM bt_silver WHERE event_date = '2024-01-01'")
def _(views):
    return _silver_scan(views, BT)


def _write_silver(views: Views) -> tables.Layout:
    layout = views.scratch("gold")
    for protocol in (WIFI, BT):
        tables.write_table(views.silver(protocol), layout, f"{protocol}_silver")
    return layout


@query("partitioned_sink", f"SELECT {_shown('device_timeline')} FROM timeline")
def _(views):
    layout = _write_silver(views)
    flows.run_timeline(views.spark, layout, views.settings)
    return tables.read_table(views.spark, layout, "device_timeline")


def _export(views: Views, protocol: str, shown: list[str]) -> DataFrame:
    layout, schema = views.scratch("export"), contract(f"{protocol}_payload")
    payload = views.landed(protocol).select(*schema.fieldNames())
    landing.export_ndjson(payload, layout.landing(protocol), by="sensor_id", max_records=1000)
    return views.spark.read.schema(schema).json(layout.landing(protocol)).select(*shown)


_EXPORTED = {
    WIFI: ["sensor_id", "event_time", "message_id", "bssid", "rssi_dbm", "confidence", "metadata"],
    BT: ["sensor_id", "event_time", "message_id", "device_address", "tx_power", "service_uuids", "confidence"],
}


@query("ndjson_export", f"SELECT {', '.join(_EXPORTED[WIFI])} FROM wifi_landed")
def _(views):
    return _export(views, WIFI, _EXPORTED[WIFI])


@query(
    "ndjson_export_bt",
    "SELECT sensor_id, event_time, message_id, device_address, tx_power, "
    "array_to_string(service_uuids, ',') AS service_uuids, confidence FROM bt_landed",
)
def _(views):
    return _export(views, BT, _EXPORTED[BT])


@query(
    "kafka_value_parse",
    each_sql(f"SELECT {_LINE_SQL.replace('source_path', 'topic_path AS source_path')} FROM "
             "(SELECT *, '@/' || (e % 4) || '/' || e AS topic_path FROM @_rescued)"),
)
def _(views):
    def parsed(p: str) -> DataFrame:
        messages = views.lines(p).select(
            F.col("value").cast("binary").alias("value"),
            F.lit(p).alias("topic"),
            (F.col("e") % 4).cast("int").alias("partition"),
            F.col("e").alias("offset"),
        )
        return landing.parse_messages(messages, p).select(*_line_columns(p))

    return each(parsed)


_ALERT_SQL = _shown("perimeter_alerts", {"alert_reasons": "reasons", "ingest_time": str(o.NOW)})


@query("backfill_batch", f"SELECT {_ALERT_SQL} FROM alerts")
def _(views):
    layout = views.scratch("backfill")
    for protocol in (WIFI, BT):
        payload = views.landed(protocol).select(*contract(f"{protocol}_payload").fieldNames())
        landing.export_ndjson(payload, layout.landing(protocol), by="sensor_id")
    wide = adapter.settings(bronze_late_days=30, late_drop_days=30)
    backfill(views.spark, layout, wide)
    return tables.read_table(views.spark, layout, "perimeter_alerts")


CATALOGUE["backfill_batch"] = Query(
    CATALOGUE["backfill_batch"].build,
    CATALOGUE["backfill_batch"].sql.replace(str(o.NOW - 7 * o.DAY), str(o.NOW - 30 * o.DAY)),
)

_BRONZE_SQL = {p: _shown(f"{p}_bronze", {"_rescued_data": "NULL::VARCHAR"}) for p in (WIFI, BT)}


def _compacted(views: Views, protocol: str) -> DataFrame:
    layout, name = views.scratch("compact"), f"{protocol}_bronze"
    tables.write_table(views.bronze(protocol), layout, name)
    target = layout.table(f"{name}_compacted")
    day = tables.compact(views.spark, layout, name, "2024-01-01", target)
    return day.select(*contract(name).fieldNames())


@query("compact_partition", f"SELECT {_BRONZE_SQL[WIFI]} FROM wifi_bronze WHERE event_date = '2024-01-01'")
def _(views):
    return _compacted(views, WIFI)


@query("compact_partition_bt", f"SELECT {_BRONZE_SQL[BT]} FROM bt_bronze WHERE event_date = '2024-01-01'")
def _(views):
    return _compacted(views, BT)


def hashed(parts: int, key: str = "event_id") -> Column:
    """One of several arrivals, by a hash of ``key``."""
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(parts))


def arrivals(df: DataFrame, parts: int, key: str = "event_id") -> list[DataFrame]:
    """The rows of a stored table in several arrivals."""
    return [df.filter(hashed(parts, key) == k) for k in range(parts)]


def dealt(views: Views, df: DataFrame, number: Column, parts: int) -> list[DataFrame]:
    """The rows in several arrivals, by ``number``: made once and stored, so each arrival reads its own share and makes
    no other."""
    folder = views.scratch("dealt").table("rows")
    df.withColumn("arrival", number.cast("int")).write.partitionBy("arrival").parquet(folder)
    stored = views.spark.read.schema(T.StructType([*df.schema.fields, T.StructField("arrival", T.IntegerType())])).parquet(folder)
    return [stored.filter(F.col("arrival") == k).drop("arrival") for k in range(parts)]


_BRONZE_READ = ["event_id", "event_date", "event_time", "ingest_time", "source_path", "message_id", "rssi_dbm"]


@query("compacted_days", each_sql(f"SELECT {', '.join(_BRONZE_READ)} FROM @_bronze"))
def _(views):
    """Bronze in several arrivals, compacted after the third and again after the fourth; the fifth comes later."""

    def compacted(p: str) -> DataFrame:
        layout, name = views.scratch("compacted"), f"{p}_bronze"
        for k, part in enumerate(dealt(views, views.bronze(p), hashed(5), 5)):
            tables.write_table(part, layout, name)
            if k in (2, 3):
                tables.compact_days(views.spark, layout, name, "2024-02-01")
        return tables.read_table(views.spark, layout, name).select(*_BRONZE_READ)

    return each(compacted)


@query("compacted_stream", each_sql(f"SELECT {', '.join(_BRONZE_READ)} FROM @_bronze"))
def _(views):
    """A new stream over a table with compacted days, in two triggers, with a compaction between them."""

    def streamed(p: str) -> DataFrame:
        layout, name = views.scratch("follow"), f"{p}_bronze"
        parts = dealt(views, views.bronze(p), hashed(4), 4)
        for arrived in (parts[:3], parts[3:]):
            for part in arrived:
                tables.write_table(part, layout, name)
            tables.compact_days(views.spark, layout, name, "2024-02-01")
            rows = tables.stream_days(views.spark, layout, name, "reader").select(*_BRONZE_READ)
            flows.finish(
                rows.writeStream.format("parquet")
                .option("checkpointLocation", layout.checkpoint("reader"))
                .trigger(availableNow=True)
                .start(layout.table("seen"))
            )
        return views.spark.read.schema(rows.schema).parquet(layout.table("seen"))

    return each(streamed)


# ---- projections ------------------------------------------------------------------------------


@query("event_id_wifi", f"SELECT e, {o.EVENT_ID_WIFI} AS event_id FROM wifi_landed")
def _(views):
    return views.landed(WIFI).select("e", event_key(WIFI).alias("event_id"))


@query("event_id_bt", f"SELECT e, {o.EVENT_ID_BT} AS event_id FROM bt_landed")
def _(views):
    return views.landed(BT).select("e", event_key(BT).alias("event_id"))


@query(
    "hash_mac",
    "SELECT e, "
    + ", ".join(f"{o.MAC_HASH(c)} AS {c}_hash" for c in ("bssid", "client_mac", "ap_mac", "transmitter_mac"))
    + " FROM wifi_landed",
)
def _(views):
    names = ("bssid", "client_mac", "ap_mac", "transmitter_mac")
    return views.landed(WIFI).select(
        "e", *[hash_identifier(c, WIFI, views.settings.salt).alias(f"{c}_hash") for c in names]
    )


@query("hash_address", f"SELECT e, {o.ADDR_HASH('device_address')} AS device_address_hash FROM bt_landed")
def _(views):
    hashed = hash_identifier("device_address", BT, views.settings.salt)
    return views.landed(BT).select("e", hashed.alias("device_address_hash"))


@query("randomized_mac", f"SELECT e, bssid, {o.RANDOM_MAC} AS is_randomized_mac FROM wifi_landed")
def _(views):
    return views.landed(WIFI).select("e", "bssid", address.is_randomized_mac().alias("is_randomized_mac"))


@query(
    "randomized_address",
    f"SELECT e, device_address, {o.RANDOM_ADDR} AS is_randomized_address FROM bt_landed",
)
def _(views):
    flag = address.is_randomized_address().alias("is_randomized_address")
    return views.landed(BT).select("e", "device_address", flag)


_OCTET_SQL = r"""CASE WHEN regexp_matches(a, '^[0-9a-fA-F]{2}')
    THEN ('0x' || substr(a, 1, 2))::INTEGER END"""


@query(
    "address_class",
    f"""SELECT e, address, octet, CASE octet // 64 WHEN 0 THEN 'NON_RESOLVABLE_PRIVATE'
    WHEN 1 THEN 'RESOLVABLE_PRIVATE' WHEN 2 THEN 'UNASSIGNED' WHEN 3 THEN 'STATIC_RANDOM' END AS address_class,
    (octet // 2) % 2 = 1 AS locally_administered FROM (SELECT e, a AS address, {_OCTET_SQL} AS octet FROM
    (SELECT e, bssid AS a FROM wifi_landed UNION ALL SELECT e, device_address FROM bt_landed))""",
)
def _(views):
    wifi = views.landed(WIFI).select("e", F.col("bssid").alias("address"))
    bt = views.landed(BT).select("e", F.col("device_address").alias("address"))
    return wifi.unionByName(bt).select(
        "e",
        "address",
        address.octet_value("address").alias("octet"),
        address.address_class("address").alias("address_class"),
        address.is_locally_administered("address").alias("locally_administered"),
    )


@query("hidden_ssid", "SELECT e, ssid, (ssid IS NULL OR ssid = '') AS is_hidden_ssid FROM wifi_landed")
def _(views):
    hidden = F.coalesce(F.length("ssid"), F.lit(0)) == 0
    return views.landed(WIFI).select("e", "ssid", hidden.alias("is_hidden_ssid"))


@query("normalize_band", f"SELECT e, {o.BAND} AS band FROM wifi_landed")
def _(views):
    return views.landed(WIFI).select("e", vocabulary.band().alias("band"))


@query("normalize_encryption", f"SELECT e, {o.CIPHER} AS encryption FROM wifi_landed")
def _(views):
    return views.landed(WIFI).select("e", vocabulary.encryption().alias("encryption"))


@query("distance_wifi", f"SELECT e, rssi_dbm, {o.HALF_UP(o.DIST_WIFI, 6)} AS distance_est_m FROM wifi_landed")
def _(views):
    return views.landed(WIFI).select("e", "rssi_dbm", signal.distance_wifi().alias("distance_est_m"))


@query("distance_ble", f"SELECT e, rssi_dbm, tx_power, {o.DIST_BLE} AS distance_est_m FROM bt_landed")
def _(views):
    return views.landed(BT).select("e", "rssi_dbm", "tx_power", signal.distance_ble().alias("distance_est_m"))


@query("path_loss", "SELECT e, tx_power - rssi_dbm AS path_loss_db FROM bt_landed")
def _(views):
    return views.landed(BT).select("e", signal.path_loss().alias("path_loss_db"))


@query("normalize_protocol", f"SELECT e, {o.SUBTYPE} AS protocol_subtype FROM bt_landed")
def _(views):
    return views.landed(BT).select("e", vocabulary.protocol_subtype().alias("protocol_subtype"))


@query("normalize_adv_type", f"SELECT e, {o.ADV} AS adv_type FROM bt_landed")
def _(views):
    return views.landed(BT).select("e", vocabulary.adv_type().alias("adv_type"))


@query("connectable", f"SELECT e, {o.ADV} IN ('ADV_IND', 'ADV_DIRECT_IND') AS is_connectable FROM bt_landed")
def _(views):
    flag = vocabulary.is_connectable(vocabulary.adv_type())
    return views.landed(BT).select("e", flag.alias("is_connectable"))


@query("dq_flags_wifi", f"SELECT e, array_to_string({o.FLAGS_WIFI}, ',') AS dq_flags FROM wifi_landed")
def _(views):
    flags = tags.wifi_quality_flags(address.is_randomized_mac())
    return views.landed(WIFI).select("e", flags.alias("dq_flags"))


@query("dq_flags_bt", f"SELECT e, array_to_string({o.FLAGS_BT}, ',') AS dq_flags FROM bt_landed")
def _(views):
    flags = tags.bt_quality_flags(address.is_randomized_address(), vocabulary.protocol_subtype())
    return views.landed(BT).select("e", flags.alias("dq_flags"))


@query("silver_wifi", f"SELECT {_shown('wifi_silver')} FROM wifi_silver")
def _(views):
    return views.silver(WIFI)


@query("silver_bt", f"SELECT {_shown('bt_silver')} FROM bt_silver")
def _(views):
    return views.silver(BT)


def _conformed(views: Views, protocol: str) -> DataFrame:
    shuffled = views.bronze(protocol).withColumn("extra", F.lit(1))
    return conform(shuffled.select(*sorted(shuffled.columns)), f"{protocol}_bronze")


@query("schema_conform", f"SELECT {_BRONZE_SQL[WIFI]} FROM wifi_bronze")
def _(views):
    return _conformed(views, WIFI)


@query("schema_conform_bt", f"SELECT {_BRONZE_SQL[BT]} FROM bt_bronze")
def _(views):
    return _conformed(views, BT)


@query(
    "vendor_oui",
    """SELECT e, bssid, CASE WHEN len(string_split(bssid, ':')) >= 3
    THEN lower(array_to_string(string_split(bssid, ':')[1:3], ':')) END AS vendor_oui FROM wifi_landed""",
)
def _(views):
    return views.landed(WIFI).select("e", "bssid", vendor_oui("bssid").alias("vendor_oui"))


@query(
    "ble_confidence",
    """SELECT e, rssi_dbm, CASE WHEN rssi_dbm IS NOT NULL THEN
    printf('%.3f', least(1e0, greatest(0.3e0, (rssi_dbm + 100) / 80e0)))::DOUBLE END AS confidence FROM bt_landed""",
)
def _(views):
    return views.landed(BT).select("e", "rssi_dbm", signal.ble_confidence().alias("confidence"))


@query(
    "infer_adv_type",
    """SELECT e, CASE WHEN coalesce(device_name, '') <> '' OR coalesce(len(service_uuids), 0) > 0
    THEN 'ADV_IND' ELSE 'ADV_NONCONN_IND' END AS adv_type FROM bt_landed""",
)
def _(views):
    return views.landed(BT).select("e", vocabulary.infer_adv_type().alias("adv_type"))


@query(
    "snr_and_quality",
    f"""SELECT e, CASE WHEN s <> 0 AND n <> 0 THEN (s - n)::DOUBLE END AS snr_db,
    CASE WHEN d <> 0 THEN {o.HALF_UP("q::DOUBLE / d::DOUBLE", 3)} END AS confidence
    FROM (SELECT e, -(e % 90) AS s, -(e % 7) * 10 AS n, e % 70 AS q, e % 3 * 35 AS d FROM base)""",
)
def _(views):
    e = F.col("e")
    return adapter.base(views.spark, views.sf_dir).select(
        "e",
        signal.snr(-(e % 90), -(e % 7) * 10).alias("snr_db"),
        signal.link_quality(e % 70, e % 3 * 35).alias("confidence"),
    )


_NO_MESSAGE_ID = [c for c in contract("wifi_payload").fieldNames() if c not in ("message_id", "metadata")]
_GHZ = "list_extract([2.437e0, 5.18e0, 5.955e0, 5.832e0, 2.412e0, 7.2e0], (e % 6 + 1)::INTEGER)"
_GHZ_BAND = """CASE WHEN g BETWEEN 2.4e0 AND 2.5e0 THEN '2.4' WHEN g BETWEEN 5.17e0 AND 5.83e0 THEN '5'
    WHEN g BETWEEN 5.93e0 AND 7.13e0 THEN '6' END"""
_CELL_COMMON = """sensor_id, ms * 1000 AS event_time, NULL::VARCHAR AS capture_file, 'beacon' AS frame_type,
    NULL::VARCHAR AS client_mac, 37.7e0 AS latitude, -122.4e0 AS longitude, NULL::DOUBLE AS heading,
    NULL::DOUBLE AS azimuth, NULL::VARCHAR AS raw_payload"""


def _cell_mac(prefix: str) -> str:
    h = f"sha256('{prefix}' || u)"
    return "concat_ws(':', " + ", ".join(f"substr({h}, {i}, 2)" for i in range(1, 13, 2)) + ")"


_CELLS_SQL = f"""SELECT e, 0 AS cell, {_CELL_COMMON}, {_cell_mac("w")} AS bssid,
    CASE WHEN e % 8 <> 0 THEN 'net-' || u END AS ssid, (e % 13 + 1)::INTEGER AS channel,
    trunc(g * 1000)::INTEGER AS frequency_mhz, {_GHZ_BAND} AS band, (-(e % 90))::INTEGER AS rssi_dbm,
    CASE WHEN e % 90 <> 0 THEN (95 - e % 90)::DOUBLE END AS snr_db,
    list_extract(['OPEN', 'WPA2', 'WPA2', 'WPA3', 'WPA3', 'WPA', 'WEP', 'UNKNOWN', 'OPEN'], (e % 9 + 1)::INTEGER)
      AS encryption,
    list_extract([NULL, 'PSK', 'EAP', 'SAE', 'EAP', 'PSK', NULL, NULL, NULL], (e % 9 + 1)::INTEGER) AS auth_mode,
    {o.HALF_UP("(e % 70)::DOUBLE / 70e0", 3)} AS confidence
    FROM (SELECT *, {_GHZ} AS g FROM base WHERE is_wifi AND copy = 0)
  UNION ALL SELECT e, 1, {_CELL_COMMON}, {_cell_mac("x")}, NULL, NULL, NULL, NULL, NULL, NULL, 'OPEN', NULL, NULL
    FROM base WHERE is_wifi AND copy = 0 AND e % 9 <> 0"""


@query(
    "parse_scan_dump",
    "SELECT " + ", ".join(
        {"vendor_oui": "substr(bssid, 1, 8) AS vendor_oui", "ap_mac": "bssid AS ap_mac",
         "transmitter_mac": "bssid AS transmitter_mac"}.get(c, c) for c in _NO_MESSAGE_ID
    )
    + ", sha256(concat_ws('|', sensor_id, event_time // 1000, cell, bssid)) AS message_id"
    + f" FROM ({_CELLS_SQL})",
)
def _(views):
    rows = scan_dump.parse_scan_dump(adapter.scan_dumps(views.spark, views.sf_dir))
    return rows.select(*_NO_MESSAGE_ID, "message_id")


@query("scan_encryption", f"SELECT e, cell AS cell_no, encryption, auth_mode FROM ({_CELLS_SQL}) UNION ALL "
       "SELECT e, 1, 'OPEN', NULL FROM base WHERE is_wifi AND copy = 0 AND e % 9 = 0")
def _(views):
    cells = scan_dump.scan_cells(adapter.scan_dumps(views.spark, views.sf_dir))
    cipher, auth = scan_dump.scan_encryption()
    return cells.select("e", "cell_no", cipher.alias("encryption"), auth.alias("auth_mode"))


@query("band_from_ghz", f"SELECT e, {_GHZ_BAND} AS band FROM (SELECT e, (2000 + e % 6000) / 1000e0 AS g FROM base)")
def _(views):
    ghz = (F.lit(2000) + F.col("e") % 6000) / F.lit(1000.0)
    return adapter.base(views.spark, views.sf_dir).select("e", vocabulary.scanner_band(ghz).alias("band"))


# ---- filters and expectations -----------------------------------------------------------------


@query("late_filter", f"SELECT e, event_time FROM wifi_landed WHERE event_time >= {o.NOW - 7 * o.DAY}")
def _(views):
    return bronze.drop_late(views.landed(WIFI), views.settings).select("e", "event_time")


@query("future_filter", each_sql(f"SELECT e, event_time FROM @_landed WHERE event_time <= {o.NOW + 300_000_000}"))
def _(views):
    return each(lambda p: expectations.BRONZE[p].enforce(views.landed(p), views.settings).select("e", "event_time"))


def _broken_sql(rules: list[tuple[str, str]]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN NOT ({ok}) THEN '{name}' END" for name, ok in rules) + ")"


_BOTH_WARN = [
    ("confidence_valid", "confidence IS NULL OR confidence BETWEEN 0 AND 1"),
    ("coordinates_paired", "(latitude IS NULL) = (longitude IS NULL)"),
]
_WARN_SQL = {
    WIFI: [
        ("rssi_plausible", "rssi_dbm IS NULL OR rssi_dbm BETWEEN -100 AND 0"), *_BOTH_WARN,
        ("valid_latitude", "latitude IS NULL OR latitude BETWEEN -90 AND 90"),
    ],
    BT: [("rssi_plausible", "rssi_dbm IS NULL OR rssi_dbm BETWEEN -110 AND 20"), *_BOTH_WARN],
}


@query(
    "expect_warn",
    " UNION ALL ".join(
        f"SELECT '{p}' AS protocol, event_id, {_broken_sql(_WARN_SQL[p])} AS violations FROM {p}_silver" for p in (WIFI, BT)
    ),
)
def _(views):
    def violations(p: str) -> DataFrame:
        return expectations.SILVER[p].violations(views.silver(p), views.settings).select("event_id", "violations")

    return each(violations)


@query(
    "expect_drop",
    each_sql(f"""SELECT event_id, sensor_id FROM @_bronze WHERE length(event_id) = 64 AND length(sensor_id) > 0
    AND event_time IS NOT NULL AND event_time >= {o.NOW - 7 * o.DAY}"""),
)
def _(views):
    def kept(p: str) -> DataFrame:
        drops = [r for r in expectations.SILVER[p].rules if r.action == expectations.DROP]
        rules = expectations.ExpectationSet.of(f"{p}_bronze", drops)
        return rules.enforce(views.bronze(p), views.settings).select("event_id", "sensor_id")

    return each(kept)


@query("expect_fail", "SELECT event_id, protocol FROM timeline")
def _(views):
    rules = expectations.ExpectationSet.of(
        "device_timeline",
        [expectations.Expectation("id_is_a_digest", "length(event_id) = 64", expectations.FAIL)],
    )
    return rules.enforce(views.timeline, views.settings).select("event_id", "protocol")


def _rules_sql(table: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{name}' AS expectation, '{action}' AS action,
        count(*) FILTER (NOT coalesce({ok}, false)) AS failed, count(*) FILTER ({ok}) AS passed FROM {source}"""
        for name, action, ok in rules
    )


_DROPS_SQL = [
    ("valid_event_id", "drop", "length(event_id) = 64"),
    ("valid_sensor_id", "drop", "length(sensor_id) > 0"),
    ("valid_event_time", "drop", "event_time IS NOT NULL"),
    ("event_not_ancient", "drop", f"event_time >= {o.NOW - 7 * o.DAY}"),
]
_CONF_SQL = ("confidence_valid", "warn", "(confidence IS NULL OR confidence BETWEEN 0 AND 1)")
_PAIR_SQL = ("coordinates_paired", "warn", "((latitude IS NULL) = (longitude IS NULL))")
_RULES_SQL = {
    "bronze": " UNION ALL ".join(
        _rules_sql(f"{p}_bronze", f"(SELECT * FROM {p}_landed WHERE event_time >= {o.NOW - 7 * o.DAY})", [
            ("valid_sensor_id", "warn", "length(sensor_id) > 0"),
            ("valid_event_time", "warn", "event_time IS NOT NULL"),
            ("event_not_future", "drop", f"event_time <= {o.NOW + 300_000_000}"),
        ])
        for p in (WIFI, BT)
    ),
    WIFI: _rules_sql("wifi_silver", "wifi_unique", [
        *_DROPS_SQL,
        ("rssi_plausible", "warn", "(rssi_dbm IS NULL OR rssi_dbm BETWEEN -100 AND 0)"),
        _CONF_SQL,
        _PAIR_SQL,
        ("valid_latitude", "warn", "(latitude IS NULL OR latitude BETWEEN -90 AND 90)"),
        ("valid_longitude", "warn", "(longitude IS NULL OR longitude BETWEEN -180 AND 180)"),
    ]),
    BT: _rules_sql("bt_silver", "bt_unique", [
        *_DROPS_SQL,
        ("rssi_plausible", "warn", "(rssi_dbm IS NULL OR rssi_dbm BETWEEN -110 AND 20)"),
        _CONF_SQL,
        _PAIR_SQL,
        ("valid_protocol_subtype", "warn", f"{o.SUBTYPE} IN ('BLE', 'BT_CLASSIC', 'UNKNOWN')"),
    ]),
    "timeline": _rules_sql("device_timeline", "timeline", [
        ("valid_event_id", "drop", "event_id IS NOT NULL"),
        ("valid_protocol", "drop", "protocol IN ('WIFI', 'BLUETOOTH')"),
        ("valid_event_time", "drop", "event_time IS NOT NULL"),
    ]),
    "alerts": _rules_sql("perimeter_alerts", "alerts", [
        ("valid_alert_id", "drop", "alert_id IS NOT NULL"),
        ("has_sensor", "drop", "sensor_id IS NOT NULL"),
    ]),
    "pairs": _rules_sql("copresence_events", "pairs", [("valid_copresence_id", "drop", "copresence_id IS NOT NULL")]),
}


def _checks(views: Views, *tables_named: str) -> list[tuple[expectations.ExpectationSet, DataFrame]]:
    """Each table's rules with the rows that its flow runs them over: what is not late, and what is unique."""
    own = views.settings
    checks = {}
    for p in (WIFI, BT):
        checks[f"{p}_bronze"] = (expectations.BRONZE[p], bronze.drop_late(views.medallion.landed(p), own))
        checks[f"{p}_silver"] = (expectations.SILVER[p], NORMALIZERS[p](dedup_batch(views.bronze(p)), own))
    return [checks[name] for name in (tables_named or checks)]


def _report(views: Views, *tables_named: str) -> DataFrame:
    lines = [rules.report(rows, views.settings) for rules, rows in _checks(views, *tables_named)]
    return reduce(DataFrame.unionByName, lines)


#: Silver columns that the number of gold rows, or a gold rule, depends on.
_COUNTED = ["event_id", "sensor_id", "event_time", "event_date", "rssi_dbm", "confidence"]
_DEVICE = {WIFI: ["bssid_hash"], BT: ["device_address_hash"]}


def _counted_silver(views: Views, observed: bool) -> tuple[tables.Layout, list[tuple]]:
    """Silver tables of both protocols, in the columns that count, and the lines of the rules on the way to them."""
    layout, own, landed_rows = views.scratch("counted"), views.settings, views.medallion

    def built(p: str) -> list[tuple]:
        seen = {name: Observation(name) if observed else None for name in (f"{p}_bronze", f"{p}_silver")}
        rows = bronze.to_bronze(landed_rows.landed(p), p, own, seen[f"{p}_bronze"])
        silver = to_silver(rows, p, own, seen[f"{p}_silver"])
        tables.write_table(silver.select(*_COUNTED, *_DEVICE[p]), layout, f"{p}_silver")
        if not observed:
            return []
        rules = [(r.table, rule, seen[r.table].get) for r in (expectations.BRONZE[p], expectations.SILVER[p]) for rule in r.rules]
        return [(table, rule.name, rule.action, n[rule.name], n["rows_seen"] - n[rule.name]) for table, rule, n in rules]

    with ThreadPoolExecutor(2) as pool:  # the two jobs share the cluster
        return layout, [line for part in pool.map(built, (WIFI, BT)) for line in part]


def _gold_lines(views: Views, layout: tables.Layout) -> DataFrame:
    """Lines of the gold rules from silver tables, over gold rows before their own drops. Pairs are counted, not formed."""
    own = views.settings
    wifi, bt = (tables.read_table(views.spark, layout, f"{p}_silver") for p in (WIFI, BT))
    lines = [
        expectations.TIMELINE.report(timeline_rows(wifi, bt), own),
        copresence_report(wifi, bt, own),
        expectations.ALERTS.report(alert_rows(device_timeline(wifi, bt, own), own), own),
    ]
    return reduce(DataFrame.unionByName, [part.select(*_LINE) for part in lines])


_LINE = ["table_name", "expectation", "action", "failed", "passed"]


def _counted(views: Views) -> DataFrame:
    """Lines of all rules with each table built once: bronze and silver counts are taken while silver is written, gold
    counts from the silver tables."""
    layout, lines = _counted_silver(views, observed=True)
    schema = "table_name string, expectation string, action string, failed long, passed long"
    return views.spark.createDataFrame(lines, schema).unionByName(_gold_lines(views, layout))


@query("rules_bronze", _RULES_SQL["bronze"])
def _(views):
    return _report(views, "wifi_bronze", "bt_bronze")


@query("rules_silver_wifi", _RULES_SQL[WIFI])
def _(views):
    return _report(views, "wifi_silver")


@query("rules_silver_bt", _RULES_SQL[BT])
def _(views):
    return _report(views, "bt_silver")


@query("rules_gold", " UNION ALL ".join(_RULES_SQL[k] for k in ("timeline", "pairs", "alerts")))
def _(views):
    layout, _ = _counted_silver(views, observed=False)
    return _gold_lines(views, layout)


def _streamed(views: Views) -> tables.Layout:
    """One trigger of the streaming medallion over landing files of both protocols."""
    layout = views.scratch("medallion")
    for protocol in (WIFI, BT):
        payload = views.landed(protocol).select(*contract(f"{protocol}_payload").fieldNames())
        landing.export_ndjson(payload, layout.landing(protocol), by=None)
    flows.run_pipeline(views.spark, layout, views.settings)
    return layout


@query("pipeline_stream", f"SELECT {_ALERT_SQL} FROM alerts")
def _(views):
    return tables.read_table(views.spark, _streamed(views), "perimeter_alerts")


@query("expectation_log", " UNION ALL ".join(_RULES_SQL.values()))
def _(views):
    log = metrics.read_log(views.spark, _streamed(views))
    return log.groupBy("table_name", "expectation", "action").agg(F.sum("failed").alias("failed"), F.sum("passed").alias("passed"))


_RUNS: dict[tuple[str, str, str], tables.Layout] = {}


def shared_run(views: Views, label: str, run: Callable[[], tables.Layout]) -> tables.Layout:
    """The tables of a run of several triggers, made once per application for all queries that look at them."""
    key = (views.spark.sparkContext.applicationId, views.sf_dir, label)
    if key not in _RUNS:
        _RUNS[key] = run()
    return _RUNS[key]


def _handed_over(views: Views) -> tables.Layout:
    """History as a batch, then two triggers of the streams behind it. Each delivery repeats the end of the last."""
    return shared_run(views, "handover", lambda: _hand_over(views))


def _hand_over(views: Views) -> tables.Layout:
    layout, hour = views.scratch("handover"), 3_600_000_000
    start = adapter.EPOCH_MS * 1000
    for k, (first, last) in enumerate(((-1000, 4), (3, 8), (7.5, 1000))):
        at = F.unix_micros("event_time")
        for protocol in (WIFI, BT):
            payload = views.landed(protocol).select(*contract(f"{protocol}_payload").fieldNames())
            delivered = payload.filter((at >= start + int(first * hour)) & (at < start + int(last * hour)))
            landing.export_ndjson(delivered, f"{layout.landing(protocol)}/{k}", by=None)
        if k == 0:
            layout = flows.hand_over(views.spark, layout, views.settings, settle_seconds=0)
        else:
            flows.run_pipeline(views.spark, layout, views.settings)
    return layout


@query("handover_alerts", f"SELECT {_ALERT_SQL} FROM alerts")
def _(views):
    return tables.read_table(views.spark, _handed_over(views), "perimeter_alerts")


@query(
    "handover_copresence",
    f"""SELECT {_shown("copresence_events", {"ingest_time": str(o.NOW), "event_date": o.DAY_OF("window_start")})}
    FROM pairs""",
)
def _(views):
    return tables.read_table(views.spark, _handed_over(views), "copresence_events")


@query(
    "alert_gate",
    "SELECT event_id, rssi_dbm, confidence FROM timeline WHERE rssi_dbm >= -65 AND confidence >= 0.7e0",
)
def _(views):
    gated = alert_candidates(views.timeline, views.settings)
    return gated.select("event_id", "rssi_dbm", "confidence")


# ---- duplicates and late data -----------------------------------------------------------------

_DEDUP_SQL = """SELECT event_id, ingest_time, source_path, message_id FROM (SELECT *, row_number() OVER (
    PARTITION BY event_id ORDER BY ingest_time, source_path) AS rn FROM @_bronze) WHERE rn = 1"""


@query("dedup_events", each_sql(_DEDUP_SQL))
def _(views):
    shown = ["event_id", "ingest_time", "source_path", "message_id"]
    return each(lambda p: dedup_batch(views.bronze(p)).select(*shown))


def _dedup_trigger(views: Views, layout: tables.Layout, name: str, delay: str) -> None:
    """Deduplicate what has arrived in a table as a stream, appending to the table ``unique``."""
    with flows.state_settings(views.spark):
        stream = tables.read_table(views.spark, layout, name, streaming=True)
        flows.finish(
            dedup_stream(stream, delay)
            .writeStream.format("parquet")
            .option("checkpointLocation", layout.checkpoint("unique"))
            .trigger(availableNow=True)
            .start(layout.table("unique"))
        )


def _unique(views: Views, layout: tables.Layout, protocol: str) -> DataFrame:
    return views.spark.read.schema(contract(f"{protocol}_bronze")).parquet(layout.table("unique"))


@query("dedup_stream", each_sql("SELECT DISTINCT event_id, event_time, message_id, rssi_dbm FROM @_bronze"))
def _(views):
    def unique(p: str) -> DataFrame:
        layout = views.scratch("dedup")
        tables.write_table(views.bronze(p), layout, f"{p}_bronze")
        _dedup_trigger(views, layout, f"{p}_bronze", views.settings.watermark_for(p))
        return _unique(views, layout, p).select("event_id", "event_time", "message_id", "rssi_dbm")

    return each(unique)


@query(
    "late_data",
    " UNION ALL ".join(
        f"""SELECT DISTINCT '{p}' AS protocol, {event_id} AS event_id, event_time FROM {p}_landed
        WHERE event_time >= {o.NOW - 7 * o.DAY} AND event_time <= {o.NOW + 300_000_000}"""
        for p, event_id in ((WIFI, o.EVENT_ID_WIFI), (BT, o.EVENT_ID_BT))
    ),
)
def _(views):
    """Two triggers on one checkpoint: rows in time, then the late ones and a replay of the first."""

    def kept(p: str) -> DataFrame:
        rows = expectations.BRONZE[p].enforce(views.medallion.landed(p), views.settings)
        fresh = bronze.drop_late(rows, views.settings)
        layout = views.scratch("late")
        for arrival in (fresh, rows):
            tables.write_table(conform(arrival, f"{p}_bronze"), layout, f"{p}_bronze")
            _dedup_trigger(views, layout, f"{p}_bronze", views.settings.watermark_for(p))
        return _unique(views, layout, p).select("event_id", "event_time")

    return each(kept)


_ARRIVAL_SQL = f"""greatest(0, least(2, CASE WHEN e % 9 = 0 THEN 2 ELSE (ms - {adapter.EPOCH_MS}) // 14400000 END))"""
_DELAYS = {WIFI: 7_200_000_000, BT: 3_600_000_000}
_ARRIVED_SQL = {
    p: f"""(SELECT *, max(CASE WHEN eligible THEN event_time END) OVER (ORDER BY arrival
        RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM (SELECT *, ms * 1000 AS event_time,
        fault <> 0 AND ms * 1000 BETWEEN {o.NOW - 7 * o.DAY} AND {o.NOW + 300_000_000} AS eligible,
        {_ARRIVAL_SQL} AS arrival FROM {p}_rescued))"""
    for p in (WIFI, BT)
}


def _arrived(views: Views, protocol: str) -> tables.Layout:
    """Three triggers over lines with faults: a third of the time each, with one row in nine only at the end."""
    return shared_run(views, f"arrivals-{protocol}", lambda: _arrive(views, protocol))


def _arrive(views: Views, protocol: str) -> tables.Layout:
    layout = views.scratch("arrivals")
    lines = views.lines(protocol).withColumn("ms", F.unix_millis("sent"))
    for k in range(3):
        delivered = lines.filter(F.expr(_ARRIVAL_SQL.replace("//", "div")) == k).select("value")
        delivered.write.text(f"{layout.landing(protocol)}/{k}")
        landed.run_arrivals(views.spark, layout, protocol, views.settings)
        landed.run_timely_silver(views.spark, layout, protocol, views.settings)
    return layout


@query(
    "arrival_sinks",
    each_sql(f"""SELECT 'bronze' AS sink, message_id, nullif(sensor_id, NULL) AS sensor_id, ms * 1000 AS event_time, _rescued_data
    FROM @_rescued WHERE fault <> 0 AND ms * 1000 BETWEEN {o.NOW - 7 * o.DAY} AND {o.NOW + 300_000_000}
    UNION ALL SELECT 'quarantine', NULL, CASE WHEN fault <> 0 THEN sensor_id END, CASE WHEN fault <> 0 THEN ms * 1000 END,
    _rescued_data FROM @_rescued WHERE _rescued_data IS NOT NULL"""),
)
def _(views):
    def sinks(p: str) -> DataFrame:
        layout = _arrived(views, p)
        shown = ["sensor_id", "event_time", "_rescued_data"]
        kept = tables.read_table(views.spark, layout, f"{p}_bronze").select(F.lit("bronze").alias("sink"), "message_id", *shown)
        held = tables.read_table(views.spark, layout, f"{p}_quarantine")
        return kept.unionByName(held.select(F.lit("quarantine").alias("sink"), F.lit(None).cast("string").alias("message_id"), *shown))

    return each(sinks)


@query(
    "late_rows",
    " UNION ALL ".join(
        f"""SELECT '{p}' AS protocol, message_id, event_time, layer FROM (SELECT *, CASE WHEN fault = 0 THEN NULL
        WHEN event_time < {o.NOW - 7 * o.DAY} THEN 'bronze' WHEN event_time <= reached - {_DELAYS[p]} THEN 'watermark' END
        AS layer FROM {_ARRIVED_SQL[p]}) WHERE layer IS NOT NULL"""
        for p in (WIFI, BT)
    ),
)
def _(views):
    def late(p: str) -> DataFrame:
        stored = tables.read_table(views.spark, _arrived(views, p), f"{p}_late")
        return stored.select("message_id", "event_time", "layer")

    return each(late)


@query(
    "timely_silver",
    " UNION ALL ".join(
        f"""SELECT '{p}' AS protocol, message_id, sensor_id, event_time FROM {_ARRIVED_SQL[p]}
        WHERE eligible AND length(sensor_id) > 0 AND NOT coalesce(event_time <= reached - {_DELAYS[p]}, false)"""
        for p in (WIFI, BT)
    ),
)
def _(views):
    """What is not late, all of it: kept and late rows are what has arrived."""

    def silver(p: str) -> DataFrame:
        stored = tables.read_table(views.spark, _arrived(views, p), f"{p}_silver")
        return stored.select("message_id", "sensor_id", "event_time")

    return each(silver)


_SLICE_SQL = f"greatest(0, least(2, (event_time - {adapter.EPOCH_MS}000) // 14400000000))"


def third(time: str = "event_time") -> Column:
    """Which third of the time, of three in order."""
    micros = F.unix_micros(time) - F.lit(adapter.EPOCH_MS * 1000)
    return F.greatest(F.lit(0), F.least(F.lit(2), F.floor(micros / F.lit(14_400_000_000))))


def in_time(df: DataFrame, k: int) -> DataFrame:
    """A third of a stored table."""
    return df.filter(third() == k)


def _is_late() -> Column:
    return F.pmod(F.xxhash64("event_id", F.lit(1)), F.lit(8)) == 0


def _with_late_share(timeline: DataFrame) -> list[DataFrame]:
    """Three arrivals in order of time, and a fourth with an eighth of the rows of all times."""
    late = _is_late()
    return [*(in_time(timeline, k).filter(~late) for k in range(3)), timeline.filter(late)]


@query(
    "dedup_state",
    " UNION ALL ".join(
        f"""SELECT '{p}' AS protocol, arrival, count(DISTINCT event_id) FILTER (slice <= arrival
          AND event_time > reached - 2 * {_DELAYS[p]}) AS state_rows FROM (SELECT *, {_SLICE_SQL} AS slice FROM {p}_bronze),
        (SELECT unnest(range(0, 3)) AS arrival), (SELECT s, max(m) OVER (ORDER BY s) AS reached FROM
          (SELECT {_SLICE_SQL} AS s, max(event_time) AS m FROM {p}_bronze GROUP BY 1)) WHERE s = arrival GROUP BY arrival"""
        for p in (WIFI, BT)
    ),
)
def _(views):
    """Ids that the deduplication still holds after each of three triggers, read from its state: those that the
    watermark has not passed."""

    def held(p: str) -> DataFrame:
        layout, out = views.scratch("state"), []
        for k, part in enumerate(dealt(views, views.bronze(p), third(), 3)):
            tables.write_table(part, layout, f"{p}_bronze")
            _dedup_trigger(views, layout, f"{p}_bronze", views.settings.watermark_for(p))
            rows = flows.state_rows(views.spark, layout, "unique").agg(F.count(F.lit(1)).alias("state_rows")).first()[0]
            out.append((k, rows))
        return views.spark.createDataFrame(out, "arrival long, state_rows long")

    return each(held)


@query("copresence_triggers", "SELECT wifi_event_id, bt_event_id, sensor_id FROM pairs")
def _(views):
    """Co-presence over three triggers: pairs meet through the state of the join."""
    layout = views.scratch("triggers")
    silver = {p: dealt(views, views.silver(p), third(), 3) for p in (WIFI, BT)}
    for k in range(3):
        for protocol in (WIFI, BT):
            tables.write_table(silver[protocol][k], layout, f"{protocol}_silver")
        flows.run_copresence(views.spark, layout, views.settings)
    events = tables.read_table(views.spark, layout, "copresence_events")
    return events.select("wifi_event_id", "bt_event_id", "sensor_id")


@query(
    "sighting_frequency_stream",
    """SELECT device_id_hash, protocol, event_time - event_time % 3600000000 AS hour_start, count(*) AS sighting_count
    FROM timeline WHERE event_time - event_time % 3600000000 + 3600000000 <= (SELECT max(event_time) FROM timeline) - 7200000000
    GROUP BY ALL""",
)
def _(views):
    """Hours that three triggers have closed."""
    layout = views.scratch("frequency")
    for k in range(3):
        tables.write_table(in_time(views.stored_timeline, k), layout, "device_timeline")
        flows.run_sighting_frequency(views.spark, layout, views.settings)
    schema = "device_id_hash string, protocol string, hour_start timestamp, sighting_count long"
    return views.spark.read.schema(schema).parquet(layout.table("sighting_frequency"))


@query(
    "quarantine_alarms_stream",
    each_sql("""SELECT (ingest_ms - ingest_ms % 3600000) * 1000 AS hour_start, count(*) AS quarantine_count, count(*) > 10 AS alert
    FROM @_rescued WHERE _rescued_data IS NOT NULL AND ingest_ms - ingest_ms % 3600000 + 3600000
      <= (SELECT max(ingest_ms) FROM @_rescued WHERE _rescued_data IS NOT NULL) GROUP BY 1"""),
)
def _(views):
    """Alarms of the closed hours, over three triggers in the order of receipt."""

    def alarms(p: str) -> DataFrame:
        layout, held = views.scratch("alarms"), views.quarantine(p)
        for k in range(3):
            tables.write_table(held.filter(third("ingest_time") == k), layout, f"{p}_quarantine")
            flows.run_quarantine_counts(views.spark, layout, p, alert_above=10)
        schema = "hour_start timestamp, quarantine_count long, alert boolean"
        return views.spark.read.schema(schema).parquet(layout.table(f"{p}_quarantine_counts"))

    return each(alarms)


@query(
    "first_per_window",
    """SELECT event_id, sensor_id, device_address, event_time, scan_start FROM (SELECT *, row_number() OVER (
    PARTITION BY sensor_id, lower(device_address), scan_start ORDER BY event_time, event_id) AS rn FROM
    (SELECT *, event_time - event_time % 600000000 AS scan_start FROM bt_bronze)) WHERE rn = 1""",
)
def _(views):
    first = first_per_window(views.bronze(BT), seconds=600)
    return first.select("event_id", "sensor_id", "device_address", "event_time", "scan_start")


# ---- joins ------------------------------------------------------------------------------------

_PAIR_LIST = "wifi_event_id, bt_event_id, sensor_id"
_COPRESENCE_SQL = f"""SELECT {_shown("copresence_events", {"ingest_time": str(o.NOW),
    "event_date": o.DAY_OF("window_start")})} FROM pairs"""


@query("copresence_pairs", f"SELECT {_PAIR_LIST} FROM pairs")
def _(views):
    return views.pairs.select("wifi_event_id", "bt_event_id", "sensor_id")


@query("copresence_salted", f"SELECT {_PAIR_LIST} FROM pairs")
def _(views):
    salted = copresence_pairs(views.silver(WIFI), views.silver(BT), views.settings, salts=4)
    return salted.select("wifi_event_id", "bt_event_id", "sensor_id")


@query("copresence_events", _COPRESENCE_SQL)
def _(views):
    return views.copresence


@query("copresence_stream", _COPRESENCE_SQL)
def _(views):
    layout = _write_silver(views)
    flows.run_copresence(views.spark, layout, views.settings)
    return tables.read_table(views.spark, layout, "copresence_events")


@query(
    "copresence_counts",
    """SELECT device_id_hash, count(*) AS copresence_count FROM (SELECT wifi_device_hash AS device_id_hash FROM pairs
    UNION ALL SELECT bt_device_hash FROM pairs) WHERE device_id_hash IS NOT NULL GROUP BY device_id_hash""",
)
def _(views):
    return copresence_counts(views.stored_timeline, views.settings)


@query(
    "manufacturer_lookup",
    f"""SELECT event_id, s.manufacturer_id, m.name AS manufacturer_name FROM bt_silver s
    LEFT JOIN (VALUES {o.MANUFACTURER_VALUES}) m(id, name) ON s.manufacturer_id = m.id""",
)
def _(views):
    named = lookup.resolve_manufacturer(views.silver(BT))
    return named.select("event_id", "manufacturer_id", "manufacturer_name")


@query(
    "identifier_lookup",
    f"""SELECT DISTINCT 'wifi' AS protocol, {o.MAC_HASH("bssid")} AS identifier_hash, bssid AS raw_identifier
    FROM wifi_bronze WHERE bssid IS NOT NULL UNION ALL SELECT DISTINCT 'bt', {o.ADDR_HASH("device_address")},
    device_address FROM bt_bronze WHERE device_address IS NOT NULL""",
)
def _(views):
    columns = {WIFI: "bssid", BT: "device_address"}
    return each(lambda p: lookup.identifier_lookup(views.bronze(p), columns[p], p, views.settings))


@query(
    "reidentified_alerts",
    """SELECT alert_id, a.protocol, device_id_hash, raw AS raw_identifier FROM alerts a
    LEFT JOIN book ON device_id_hash = h AND a.protocol = book.protocol""",
)
def _(views):
    book = lookup.address_book(views.bronze(WIFI), views.bronze(BT), views.settings)
    named = lookup.reidentify(views.alerts, book, "device_id_hash")
    return named.select("alert_id", "protocol", "device_id_hash", "raw_identifier")


_NOVEL_SQL = """SELECT event_id, device_id_hash, event_time FROM (SELECT *, min(event_time) OVER
    (PARTITION BY device_id_hash) AS first FROM timeline WHERE device_id_hash IS NOT NULL)
    WHERE event_time = first"""


@query("novel_device", _NOVEL_SQL)
def _(views):
    return lookup.novel_device(views.stored_timeline).select("event_id", "device_id_hash", "event_time")


@query("novel_device_stream", _NOVEL_SQL)
def _(views):
    """Four triggers; the last one brings a share of the rows of the first three."""
    layout = views.scratch("novel")
    for part in _with_late_share(views.stored_timeline):
        tables.write_table(part, layout, "device_timeline")
        flows.run_novel_devices(views.spark, layout)
    novel = flows.read_novel_devices(views.spark, layout)
    return novel.select("event_id", "device_id_hash", "event_time")


# ---- gold -------------------------------------------------------------------------------------


@query("device_timeline", f"SELECT {_shown('device_timeline')} FROM timeline")
def _(views):
    return device_timeline(views.silver(WIFI), views.silver(BT), views.settings)


@query("alert_reasons", f"SELECT event_id, array_to_string({o.REASONS}, ',') AS alert_reasons FROM timeline")
def _(views):
    return views.timeline.select("event_id", tags.alert_reasons().alias("alert_reasons"))


@query("threat_score", "SELECT alert_id, threat_score FROM alerts")
def _(views):
    return views.alerts.select("alert_id", "threat_score")


@query("perimeter_alerts", f"SELECT {_ALERT_SQL} FROM alerts")
def _(views):
    return views.alerts


# ---- analytics --------------------------------------------------------------------------------

_WINDOWS_SQL = """SELECT device_id_hash, protocol, event_date, min(event_time) AS first_seen,
    max(event_time) AS last_seen, count(*) AS sighting_count,
    arg_max(coalesce(sensor_id, ''), event_time::VARCHAR || event_id) AS last_sensor_id,
    nullif(arg_max(coalesce(rssi_dbm, 99999), event_time::VARCHAR || event_id), 99999) AS last_rssi_dbm
    FROM timeline GROUP BY device_id_hash, protocol, event_date"""


@query("sighting_windows", _WINDOWS_SQL)
def _(views):
    return analytics.flatten_latest(analytics.sighting_windows(views.timeline))


@query("sighting_windows_stream", _WINDOWS_SQL)
def _(views):
    """Six triggers, so that days are folded on the way."""
    layout = views.scratch("windows")
    for part in arrivals(views.stored_timeline, 6):
        tables.write_table(part, layout, "device_timeline")
        flows.run_sighting_windows(views.spark, layout)
    return analytics.flatten_latest(flows.read_sighting_windows(views.spark, layout))


@query(
    "repeated_visitors",
    """SELECT device_id_hash, protocol, sensor_id, count(*) AS sighting_count, min(event_time) AS first_seen,
    max(event_time) AS last_seen, date_diff('day', min(event_date)::DATE, max(event_date)::DATE)::INTEGER AS days_active
    FROM timeline GROUP BY device_id_hash, protocol, sensor_id HAVING count(*) > 5
    ORDER BY sighting_count DESC, device_id_hash, protocol, sensor_id""",
)
def _(views):
    return analytics.repeated_visitors(views.timeline)


@query(
    "directional_movement",
    """SELECT device_id_hash, window_start, array_to_string(list_sort(list(reading)), ';') AS sensor_readings,
    sum(n)::BIGINT AS reading_count, count(DISTINCT sensor_id)::INTEGER AS sensor_count FROM (
      SELECT device_id_hash, event_time - event_time % 30000000 AS window_start, sensor_id, count(*) AS n,
        concat_ws('/', sensor_id, rssi_dbm, latitude, longitude, count(*)) AS reading
      FROM timeline WHERE device_id_hash IS NOT NULL
      GROUP BY device_id_hash, event_time - event_time % 30000000, sensor_id, rssi_dbm, latitude, longitude)
    GROUP BY device_id_hash, window_start HAVING sum(n) > 1""",
)
def _(views):
    moves = analytics.directional_movement(views.timeline)
    fields = ["sensor_id", "rssi_dbm", "latitude", "longitude", "n"]
    text = F.transform("sensor_readings", lambda r: F.concat_ws("/", *[r[f].cast("string") for f in fields]))
    return moves.withColumn("sensor_readings", F.array_join(F.array_sort(text), ";"))


@query(
    "rssi_gradient",
    """SELECT device_id_hash, window_start, arg_min(sensor_id, lpad((1000 - best)::VARCHAR, 6, '0') || sensor_id)
      AS strongest_sensor, max(best) AS strongest_rssi_dbm, max(best) - min(worst) AS rssi_spread_db,
      count(*) AS sensor_count FROM (SELECT device_id_hash, event_time - event_time % 30000000 AS window_start,
        sensor_id, max(rssi_dbm) AS best, min(rssi_dbm) AS worst FROM timeline
        WHERE device_id_hash IS NOT NULL AND rssi_dbm IS NOT NULL
          AND NOT list_contains(dq_flags, 'RSSI_OUT_OF_RANGE') GROUP BY ALL)
    GROUP BY device_id_hash, window_start""",
)
def _(views):
    return analytics.rssi_gradient(views.timeline)


@query("device_features", "SELECT * FROM features")
def _(views):
    return views.features


@query("device_features_early", o.features(1_704_078_000_000_000))
def _(views):
    """As of three o'clock, inside the data."""
    early = replace(views.settings, as_of="2024-01-01T03:00:00Z")
    return analytics.device_features(views.stored_timeline, early)


@query("device_features_daily", o.features(1_704_175_200_000_000))
def _(views):
    """As of six o'clock of the next day, from partial features of the day before."""
    layout, later = views.scratch("features"), replace(views.settings, as_of="2024-01-02T06:00:00Z")
    tables.write_table(views.timeline, layout, "device_timeline")
    flows.build_feature_days(views.spark, layout, later, "2024-01-02")
    return flows.read_device_features(views.spark, layout, later)


@query(
    "sighting_frequency",
    """SELECT device_id_hash, protocol, event_time - event_time % 3600000000 AS hour_start,
    count(*) AS sighting_count FROM timeline GROUP BY ALL""",
)
def _(views):
    return analytics.sighting_frequency(views.timeline)


_MOVEMENT_SQL = """SELECT event_id, device_id_hash, protocol, sensor_id, event_time, lag(sensor_id) OVER p AS previous_sensor_id,
    sensor_id <> lag(sensor_id) OVER p AS moved, (lead(event_time) OVER p - event_time) / 1000000e0 AS dwell_seconds
    FROM timeline WHERE device_id_hash IS NOT NULL
    WINDOW p AS (PARTITION BY device_id_hash ORDER BY event_time, event_id)"""


@query("movement_history", _MOVEMENT_SQL)
def _(views):
    return analytics.movement_history(views.stored_timeline)


@query("movement_history_stream", _MOVEMENT_SQL)
def _(views):
    """Four triggers; the last one brings a share of the rows of the first three."""
    layout, steps = views.scratch("movement"), views.timeline.select(*analytics.STEP)
    for part in dealt(views, steps, F.when(_is_late(), 3).otherwise(third()), 4):
        tables.write_table(part, layout, "device_timeline")
        flows.run_movement(views.spark, layout)
    return flows.read_movement(views.spark, layout)


@query("entity_links", "SELECT * FROM links")
def _(views):
    return views.links


@query(
    "entity_clusters",
    "SELECT a AS device_id_hash, least(a, min(b)) AS cluster_id FROM reach GROUP BY a",
)
def _(views):
    return clusters.entity_clusters(views.links_from(3), min_pairs=3)


@query(
    "entity_clusters_stream",
    "SELECT a AS device_id_hash, least(a, min(b)) AS cluster_id FROM reach GROUP BY a",
)
def _(views):
    """Three triggers; links gather their pairs over them, and clusters merge."""
    layout, met = views.scratch("merged"), copresence_classes(views.silver(WIFI), views.silver(BT), views.settings)
    number = F.pmod(F.xxhash64("wifi_device_hash", "bt_device_hash", "window_start", "window_end", "sensor_id"), F.lit(3))
    for part in dealt(views, met, number, 3):
        tables.write_table(part, layout, "copresence_classes")
        flows.run_clusters(views.spark, layout, min_pairs=3, source="copresence_classes")
    return flows.read_clusters(views.spark, layout)


@query(
    "unknown_device_topk",
    """SELECT sensor_id, rank, device_id_hash, unknown_score, sighting_count FROM (
      SELECT t.sensor_id, t.device_id_hash, score / 100e0 AS unknown_score, n AS sighting_count,
        row_number() OVER (PARTITION BY t.sensor_id ORDER BY score DESC, n DESC, t.device_id_hash)::INTEGER AS rank
      FROM (SELECT sensor_id, device_id_hash, count(*) AS n FROM timeline
            WHERE device_id_hash IS NOT NULL AND sensor_id IS NOT NULL GROUP BY ALL) t
      JOIN (SELECT device_id_hash, CASE WHEN is_new THEN 40 ELSE 0 END + CASE WHEN randomized_address THEN 30 ELSE 0 END
              + CASE WHEN max_rssi_ever >= -50 THEN 20 ELSE 0 END + CASE WHEN copresence_count = 0 THEN 10 ELSE 0 END
              AS score FROM features) f USING (device_id_hash)) WHERE rank <= 10""",
)
def _(views):
    return analytics.unknown_device_topk(views.stored_timeline, views.features)


_AMPLITUDE = "pow(10e0, rssi_dbm / 20e0)"


@query(
    "sensor_fusion",
    f"""SELECT device_id_hash, event_time - event_time % 30000000 AS window_start,
    count(DISTINCT sensor_id) AS sensor_count, count(*) AS reading_count, max(rssi_dbm) AS strongest_rssi_dbm,
    {o.HALF_UP(f"sum(latitude * {_AMPLITUDE}) / sum({_AMPLITUDE})", 6)} AS latitude,
    {o.HALF_UP(f"sum(longitude * {_AMPLITUDE}) / sum({_AMPLITUDE})", 6)} AS longitude
    FROM timeline WHERE device_id_hash IS NOT NULL AND rssi_dbm IS NOT NULL AND latitude BETWEEN -90 AND 90
      AND longitude BETWEEN -180 AND 180 AND NOT list_contains(dq_flags, 'RSSI_OUT_OF_RANGE') GROUP BY device_id_hash, event_time - event_time % 30000000""",
)
def _(views):
    return analytics.sensor_fusion(views.timeline)


# ---- reports ----------------------------------------------------------------------------------


@query(
    "dq_failure_rate",
    f"""SELECT table_name, expectation, action, failed AS failed_records, passed AS passed_records,
    {o.HALF_UP("failed * 100e0 / (failed + passed)", 2)} AS failure_pct
    FROM ({" UNION ALL ".join(_RULES_SQL.values())})
    ORDER BY failure_pct DESC, table_name, expectation""",
)
def _(views):
    return reports.failure_pct(_counted(views))


_INGEST_DAY = o.DAY_OF("ingest_ms * 1000")


@query(
    "quarantine_counts",
    each_sql(f"""SELECT {_INGEST_DAY} AS event_date, (ingest_ms - ingest_ms % 3600000) * 1000 AS ingest_hour,
    count(*) AS quarantine_count, count(*) > 10 AS alert FROM @_rescued WHERE _rescued_data IS NOT NULL GROUP BY ALL"""),
)
def _(views):
    return each(lambda p: reports.quarantine_counts(views.quarantine(p), alert_above=10))


@query(
    "quarantine_ratio",
    each_sql(f"""SELECT event_date, bronze_rows, quarantined, ratio_pct, ratio_pct > 1 AS alert, ratio_pct < 0.5 AS within_slo
    FROM (SELECT *, CASE WHEN bronze_rows > 0 THEN {o.HALF_UP("quarantined * 100e0 / bronze_rows", 3)} END AS ratio_pct
      FROM (SELECT event_date, coalesce(b, 0) AS bronze_rows, coalesce(q, 0) AS quarantined FROM
        (SELECT {_INGEST_DAY} AS event_date, count(*) AS b FROM @_rescued WHERE fault <> 0
          AND ms * 1000 BETWEEN {o.NOW - 7 * o.DAY} AND {o.NOW + 300_000_000} GROUP BY 1)
        FULL JOIN (SELECT {_INGEST_DAY} AS event_date, count(*) AS q FROM @_rescued WHERE _rescued_data IS NOT NULL
          GROUP BY 1) USING (event_date)))"""),
)
def _(views):
    return each(lambda p: reports.quarantine_ratio(views.quarantine(p), views.parsed_bronze(p)))


@query(
    "ingest_lag",
    each_sql(f"""SELECT sensor_id, count(*) AS row_count, max(lag) AS max_lag_seconds,
    {o.HALF_UP("quantile_cont(lag::DOUBLE, 0.95)", 3)} AS p95_lag_seconds, max(lag) > 900 AS alert
    FROM (SELECT sensor_id, (ingest_time - event_time) // 1000000 AS lag FROM @_bronze) GROUP BY sensor_id"""),
)
def _(views):
    return each(lambda p: reports.ingest_lag(views.bronze(p)))


@query(
    "row_count_drift",
    f"""SELECT event_date, row_count, previous_count, drift_pct, abs(drift_pct) > 20 AS alert FROM (
    SELECT *, {o.HALF_UP("(row_count - previous_count) * 100e0 / previous_count", 2)} AS drift_pct FROM (
      SELECT event_date, count(*) AS row_count, lag(count(*)) OVER (ORDER BY event_date) AS previous_count
      FROM (SELECT strftime(ts, '%Y-%m-%d') AS event_date FROM events) GROUP BY event_date))""",
)
def _(views):
    events = views.spark.read.parquet(f"{views.sf_dir}/events.parquet")
    return reports.row_count_drift(events.select(F.to_date("ts").cast("string").alias("event_date")))


@query(
    "sensor_health",
    each_sql(f"""SELECT sensor_id, event_date, count(*) AS row_count, max(event_time) AS last_seen,
    {", ".join(o.HALF_UP(f"count(*) FILTER ({c} IS NULL)::DOUBLE / count(*)", 4) + f" AS {c}_null_rate"
               for c in ("rssi_dbm", "latitude", "confidence"))},
    greatest(max(event_time - ingest_time), 0) / 1000000e0 AS clock_skew_seconds
    FROM @_bronze GROUP BY sensor_id, event_date"""),
)
def _(views):
    return each(lambda p: reports.sensor_health(views.bronze(p)))


@query(
    "dq_flag_histogram",
    """SELECT protocol, event_date, dq_flag, count(*) AS row_count FROM
    (SELECT protocol, event_date, unnest(dq_flags) AS dq_flag FROM timeline) GROUP BY ALL""",
)
def _(views):
    return reports.dq_flag_histogram(views.timeline)


@query("high_threat", "SELECT alert_id, device_id_hash, threat_score FROM alerts WHERE threat_score > 0.9e0")
def _(views):
    return high_threat(views.alerts).select("alert_id", "device_id_hash", "threat_score")


@query(
    "backlog_stats",
    """SELECT protocol, count(*) FILTER (uploaded_at IS NULL) AS pending,
    count(*) FILTER (uploaded_at IS NOT NULL) AS uploaded FROM outbox GROUP BY protocol""",
)
def _(views):
    return outbox.backlog_stats(views.outbox)


@query(
    "oldest_pending_topk",
    """SELECT id, protocol, created_at, position FROM (SELECT *, row_number() OVER (PARTITION BY protocol
    ORDER BY id)::INTEGER AS position FROM outbox WHERE uploaded_at IS NULL) WHERE position <= 500""",
)
def _(views):
    return outbox.next_batch(views.outbox).select("id", "protocol", "created_at", "position")


@query(
    "purge_uploaded",
    f"""SELECT id, protocol, created_at, uploaded_at FROM outbox
    WHERE uploaded_at IS NULL OR created_at >= {o.NOW - 3 * o.DAY}""",
)
def _(views):
    return outbox.purge_uploaded(views.outbox, views.settings)


@query(
    "retention_filter",
    each_sql(f"""SELECT e, event_date FROM (SELECT e, {o.DAY_OF("event_time")} AS event_date FROM @_landed)
    WHERE event_date >= '2023-12-27'"""),
)
def _(views):
    return each(lambda p: outbox.retain(views.medallion.landed(p), views.settings, days=5).select("e", "event_date"))


@query(
    "table_retention",
    " UNION ALL ".join(f"""SELECT '{table}' AS table_name, event_date, count(*) AS row_count FROM {source}
    WHERE event_date >= strftime(make_timestamp({o.NOW - days * o.DAY}), '%Y-%m-%d') GROUP BY event_date"""
    for table, source, days in (
        ("wifi_bronze", "wifi_bronze", 90), ("bt_bronze", "bt_bronze", 90), ("wifi_silver", "wifi_silver", 365),
        ("bt_silver", "bt_silver", 365), ("device_timeline", "timeline", 365), ("perimeter_alerts", "alerts", 730),
    )),
)
def _(views):
    """Rows per table and day that each table's own retention keeps."""
    held = {f"{p}_{layer}": getattr(views, layer)(p) for p in (WIFI, BT) for layer in ("bronze", "silver")}
    held |= {"device_timeline": views.timeline, "perimeter_alerts": views.alerts}

    def kept(name: str) -> DataFrame:
        days = outbox.retain_table(held[name], name, views.settings).groupBy("event_date")
        return days.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [kept(name) for name in outbox.RETENTION_DAYS])
