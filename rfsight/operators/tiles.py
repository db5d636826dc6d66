"""Links between devices from tiles: blocks of Wi-Fi devices against blocks of Bluetooth devices.

All sightings of two devices meet in one tile, so their pairs are counted where they are formed and no row per pair is
shuffled. What is shuffled are sightings, once per block of the other side; blocks are of bounded size, so what a task
holds is two blocks, some pairs at a time, and the links of a tile.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sightings in a block, and pairs that a task forms at a time.
BLOCK_ROWS, PAIRS_AT_ONCE = 80_000, 2_000_000
#: A sighting folded over its confidences; one confidence of those, for partners that need it; a confidence too fine.
WHOLE, PART, FINE = 0, 1, 2
#: Which kinds meet, so that each pair of sightings counts once.
_MEET = ((WHOLE, WHOLE), (FINE, PART), (FINE, FINE), (PART, FINE))
_LINKS = """wifi_device_hash string, bt_device_hash string, pair_count bigint, score_millis bigint, sensor_count bigint,
    first_us bigint, last_us bigint"""
_NAMES = ["wifi_device_hash", "bt_device_hash", "pair_count", "score_millis", "sensor_count", "first_us", "last_us"]


def rounded_millis(wifi: np.ndarray, bt: np.ndarray) -> np.ndarray:
    """Thousandths of the mean confidence, halves away from zero as SQL rounds the decimal that a double shows."""
    mean = (wifi + bt) / 2.0
    scaled = mean * 1000.0
    out = np.floor(scaled + 0.5)
    near = np.abs(scaled - np.floor(scaled) - 0.5) < 1e-6
    unsure = ~(np.abs(scaled) < 1e9) | near
    if unsure.any():
        values, back = np.unique(mean[unsure], return_inverse=True)
        exact = [int((Decimal(repr(float(v))) * 1000).quantize(Decimal(1), ROUND_HALF_UP)) for v in values]
        out[unsure] = np.array(exact, dtype="float64")[back]
    return out.astype("int64")


def _summed(key: np.ndarray, sums: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> tuple:
    """One row per key: sums, the least first and the greatest last."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, "int64")
    if not len(at):
        return key, sums, first, last
    return (
        key[at],
        [np.add.reduceat(s[order], at) for s in sums],
        np.minimum.reduceat(first[order], at),
        np.maximum.reduceat(last[order], at),
    )


def _side(rows: pa.Table, sensors: pa.Array) -> dict:
    device = pc.dictionary_encode(rows["device"].combine_chunks())
    plain = {c: rows[c].to_numpy() for c in ("us", "n", "units", "confidence", "kind")}
    sensor = pc.index_in(rows["sensor"].combine_chunks(), value_set=sensors).to_numpy(zero_copy_only=False)
    return plain | {"names": device.dictionary, "device": device.indices.to_numpy().astype("int64"), "sensor": sensor.astype("int64")}


def _picked(side: dict, kind: int, by_time: bool) -> dict:
    own = np.flatnonzero(side["kind"] == kind)
    keys = (side["us"][own], side["sensor"][own]) if by_time else (side["us"][own], side["device"][own])
    own = own[np.lexsort(keys)]
    return {c: side[c][own] for c in ("us", "n", "units", "confidence", "device", "sensor")}


def _pairs(wifi: dict, bt: dict, reach: int, whole: bool, devices: int, sensors: int):
    """Sums per (Wi-Fi device, Bluetooth device, sensor), some pairs at a time."""
    if not len(wifi["us"]) or not len(bt["us"]):
        return
    begin = np.searchsorted(bt["sensor"], np.arange(sensors + 1))
    low, high = (np.zeros(len(wifi["us"]), "int64") for _ in range(2))
    for s in range(sensors):
        own = np.flatnonzero(wifi["sensor"] == s)
        times = bt["us"][begin[s] : begin[s + 1]]
        low[own] = begin[s] + np.searchsorted(times, wifi["us"][own] - reach, "left")
        high[own] = begin[s] + np.searchsorted(times, wifi["us"][own] + reach, "right")
    done = np.r_[0, np.cumsum(high - low)]
    total = int(done[-1])
    for start in range(0, total, PAIRS_AT_ONCE):
        number = np.arange(start, min(start + PAIRS_AT_ONCE, total))
        w = np.searchsorted(done, number, "right") - 1
        b = low[w] + number - done[w]
        count = wifi["n"][w] * bt["n"][b]
        if whole:
            millis = wifi["units"][w] * bt["n"][b] + bt["units"][b] * wifi["n"][w]
        else:
            millis = rounded_millis(wifi["confidence"][w], bt["confidence"][b]) * count
        key = (wifi["device"][w] * devices + bt["device"][b]) * sensors + wifi["sensor"][w]
        at = wifi["us"][w], bt["us"][b]
        yield _summed(key, [count, millis], np.minimum(*at), np.maximum(*at))


def _linked(reach: int, min_pairs: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def links(left: pa.Table, right: pa.Table) -> pa.Table:
        sensors = pc.unique(pa.chunked_array([*left["sensor"].chunks, *right["sensor"].chunks], pa.string()))
        wifi, bt = _side(left, sensors), _side(right, sensors)
        devices, parts = max(len(bt["names"]), 1), []
        for kinds in _MEET:
            sides = _picked(wifi, kinds[0], False), _picked(bt, kinds[1], True)
            parts += _pairs(*sides, reach, kinds == (WHOLE, WHOLE), devices, max(len(sensors), 1))
        if not parts:
            parts = [(np.zeros(0, "int64"), [np.zeros(0, "int64")] * 2, np.zeros(0, "int64"), np.zeros(0, "int64"))]

        def joined(pick: Callable) -> np.ndarray:
            return np.concatenate([pick(p) for p in parts])

        sums = [joined(lambda p: p[1][0]), joined(lambda p: p[1][1])]
        key, sums, first, last = _summed(joined(lambda p: p[0]), sums, joined(lambda p: p[2]), joined(lambda p: p[3]))
        key, (count, millis, heard), first, last = _summed(key // max(len(sensors), 1), [*sums, np.ones_like(key)], first, last)
        kept = count >= min_pairs
        ends = wifi["names"].take(pa.array(key[kept] // devices)), bt["names"].take(pa.array(key[kept] % devices))
        return pa.table([*ends, *(pa.array(v[kept]) for v in (count, millis, heard, first, last))], names=_NAMES)

    return links


def _rows(classes: DataFrame, folded: DataFrame, prefix: str, part: bool, fine: bool) -> DataFrame:
    """Rows of all kinds that are needed, in order of devices: names next to one another take little room."""
    named = [f"{prefix}_{c}" for c in ("sensor_id", "event_time", "device_hash", "n", "units", "confidence")]

    def of(rows: DataFrame, kind: int) -> DataFrame:
        columns = [
            F.col(named[0]).alias("sensor"),
            F.unix_micros(named[1]).alias("us"),
            F.col(named[2]).alias("device"),
            F.col(named[3]).alias("n"),
            F.coalesce(named[4], F.lit(0)).alias("units"),
        ]
        sure = F.lit(0.0) if kind == WHOLE else F.col(named[5])
        return rows.select(*columns, sure.alias("confidence"), F.lit(kind).alias("kind"))

    rows = of(folded, WHOLE)
    if part:
        rows = rows.unionByName(of(classes.filter(f"{prefix}_units IS NOT NULL"), PART))
    if fine:
        rows = rows.unionByName(of(classes.filter(f"{prefix}_units IS NULL"), FINE))
    return rows.repartition(F.col("device")).sortWithinPartitions("device")


def tiled_links(
    wifi: tuple[DataFrame, DataFrame], bt: tuple[DataFrame, DataFrame], reach_seconds: int, min_pairs: int = 1
) -> DataFrame:
    """Links of at least ``min_pairs`` pairs, from stored sighting classes of both sides and the same folded over
    confidences, with the sum of scores in thousandths."""
    fine = [not classes.filter(f"{p}_units IS NULL").isEmpty() for p, (classes, _) in (("wifi", wifi), ("bt", bt))]
    blocks = [max(1, -(-classes.count() // BLOCK_ROWS)) for classes, _ in (wifi, bt)]
    sides = []
    for k, (prefix, side) in enumerate((("wifi", wifi), ("bt", bt))):
        rows = _rows(*side, prefix, part=fine[1 - k], fine=fine[k])
        own = F.pmod(F.xxhash64("device"), F.lit(blocks[k]))
        other = F.sequence(F.lit(0), F.lit(blocks[1 - k] - 1))
        step = (blocks[1], 1) if k == 0 else (1, blocks[1])
        rows = rows.withColumns({"own": own, "other": F.explode(other)})
        sides.append(rows.withColumn("tile", F.col("own") * step[0] + F.col("other") * step[1]).groupBy("tile"))
    found = sides[0].cogroup(sides[1]).applyInArrow(_linked(reach_seconds * 1_000_000, min_pairs), _LINKS)
    times = {"first_seen": F.timestamp_micros("first_us"), "last_seen": F.timestamp_micros("last_us")}
    return found.withColumns(times).drop("first_us", "last_us")
