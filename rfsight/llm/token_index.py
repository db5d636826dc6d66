"""Binary token shards with a minimal perfect hash index.

A shard is one row of a Parquet table: the raw ids of a run of documents in ascending order of their ids, the
keys in that order, and an index that takes a key to its place in the payload in constant time. Each bucket of
keys has a displacement that sends its keys to slots of their own; a slot holds a fingerprint, which turns away
unknown keys (all but one in 2**32), and the place of the ids. Spark commits the files, so a lost executor costs
a task.

The key of the k-th row with an id is (id, k). An id that many rows share spreads over tasks and shards like others: a
shard numbers the rows of an id from 0, and how many of its first id lie in shards before it (:func:`head_turns`)
is counted from the shards' ends, a few numbers each.

Defined results: a null text is empty and yields its end id; null ids sort first; rows with equal ids are in
order of digests of their texts, and equal rows in any order; an empty table gives no shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rfsight.llm.arrow import BASE, mix, slices
from rfsight.llm.encode import encoder

SHARD = """part int, chunk int, n_docs long, n_tokens long, id_bytes int, first_key long, last_key long,
    head_key long, n_head long, tail_key long, n_tail long, keys binary, seeds binary, fingerprints binary, places binary, payload binary"""
KEYS_PER_BUCKET = 3
_BEFORE = (Window.unboundedPreceding, -1)
NULL_KEY = np.uint64(0x5851F42D4C957F2D)


def key_hashes(ids: np.ndarray, known: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """64-bit hash of each key (document id or null, number among equal ids)."""
    return mix(np.where(known, mix(ids.view(np.uint64)), NULL_KEY) + turn.astype(np.uint64) * BASE)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _slot(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    return (mix(hashes + seeds.astype(np.uint64) * BASE) % np.uint64(n)).astype(np.int64)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ NULL_KEY) >> np.uint64(32)).astype(np.uint32)


def displacements(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seed of each bucket, slot of each key): the n distinct keys fill the slots 0 to n - 1.

    Large buckets choose first. A bucket of one key takes a free slot outright, written as minus slot minus one.
    """
    n = len(hashes)
    buckets = max(1, n // KEYS_PER_BUCKET)
    of = _bucket(hashes, buckets)
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(buckets + 1))
    seeds, slots, taken = np.zeros(buckets, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    tries = np.arange(32, dtype=np.int64)
    single = []
    for b in np.argsort(bounds[:-1] - bounds[1:], kind="stable"):
        keys = order[bounds[b] : bounds[b + 1]]
        if len(keys) == 1:
            single.append((b, keys[0]))
        if len(keys) < 2:
            continue
        first = 0
        while True:
            places = _slot(hashes[keys][None, :], (first + tries)[:, None], n)
            ranked = np.sort(places, axis=1)
            good = np.flatnonzero(~taken[places].any(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1))
            if len(good):
                seeds[b], slots[keys] = first + good[0], places[good[0]]
                taken[places[good[0]]] = True
                break
            first += len(tries)
    for (b, key), slot in zip(single, np.flatnonzero(~taken), strict=True):
        seeds[b], slots[key] = -slot - 1, slot
    return seeds, slots


@dataclass(frozen=True)
class Shard:
    """A shard as read back from its row."""

    seeds: np.ndarray
    fingerprints: np.ndarray
    places: np.ndarray
    ids: np.ndarray

    @staticmethod
    def of(row: dict) -> Shard:
        kind = f"<u{row['id_bytes']}"
        return Shard(
            np.frombuffer(row["seeds"], "<i8"),
            np.frombuffer(row["fingerprints"], "<u4"),
            np.frombuffer(row["places"], "<i8").reshape(-1, 2),
            np.frombuffer(row["payload"], kind),
        )

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """(start, length) of each key, (-1, 0) for one that the shard doesn't hold."""
        n = len(self.fingerprints)
        seeds = self.seeds[_bucket(hashes, len(self.seeds))]
        slots = np.where(seeds < 0, -seeds - 1, _slot(hashes, np.maximum(seeds, 0), n))
        return np.where((self.fingerprints[slots] == fingerprint(hashes))[:, None], self.places[slots], [[-1, 0]])


def _turns(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Number of each row among the rows before it with the same id; equal ids are neighbours."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (known[1:] != known[:-1])
    at = np.arange(len(ids))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def shard_row(part: int, chunk: int, keys: list[int | None], ids: list[np.ndarray], id_bytes: int) -> dict:
    known = np.array([k is not None for k in keys])
    numbers = np.array([k or 0 for k in keys], np.int64)
    hashes = key_hashes(numbers, known, _turns(numbers, known))
    seeds, slots = displacements(hashes)
    lengths = np.array([len(x) for x in ids], np.int64)
    places = np.empty((len(keys), 2), np.int64)
    places[slots] = np.stack([np.cumsum(lengths) - lengths, lengths], axis=1)
    prints = np.empty(len(keys), np.uint32)
    prints[slots] = fingerprint(hashes)
    real = numbers[known]
    ends = np.flatnonzero((numbers[1:] != numbers[:-1]) | (known[1:] != known[:-1]))
    return {
        "part": part, "chunk": chunk, "n_docs": len(keys), "n_tokens": int(lengths.sum()), "id_bytes": id_bytes,
        "first_key": int(real.min()) if len(real) else None, "last_key": int(real.max()) if len(real) else None,
        "head_key": keys[0], "n_head": int(ends[0]) + 1 if len(ends) else len(keys),
        "tail_key": keys[-1], "n_tail": len(keys) - 1 - int(ends[-1]) if len(ends) else len(keys),
        "keys": np.packbits(known).tobytes() + numbers.astype("<i8").tobytes(),
        "seeds": seeds.astype("<i8").tobytes(), "fingerprints": prints.astype("<u4").tobytes(),
        "places": places.astype("<i8").tobytes(),
        "payload": np.concatenate(ids).astype(f"<u{id_bytes}").tobytes(),
    }


def keys_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(ids, known) of a shard's documents in order."""
    n = row["n_docs"]
    bits = np.frombuffer(row["keys"][: -(-n // 8)], np.uint8)
    return np.frombuffer(row["keys"][-(-n // 8) :], "<i8"), np.unpackbits(bits, count=n).astype(bool)


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, chunk_tokens: int = 1 << 21) -> None:
    """Encode every text and write the ids in ascending order of doc_id, a shard for about ``chunk_tokens`` each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, keys, ids, held = TaskContext.get().partitionId(), 0, [], [], 0
        encode = encoder(tokenizer, end_id)
        schema = pa.schema(
            [(n, pa.int32()) for n in ("part", "chunk")]
            + [(n, pa.int64()) for n in ("n_docs", "n_tokens")]
            + [("id_bytes", pa.int32()), ("first_key", pa.int64()), ("last_key", pa.int64())]
            + [(n, pa.int64()) for n in ("head_key", "n_head", "tail_key", "n_tail")]
            + [(n, pa.binary()) for n in ("keys", "seeds", "fingerprints", "places", "payload")]
        )
        for batch in slices(batches, "text", 2 << 20):
            found, offsets = encode.encode(batch.column("text"))
            for key, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                if held >= chunk_tokens:
                    yield pa.RecordBatch.from_pylist([shard_row(part, chunk, keys, ids, encode.id_bytes)], schema)
                    chunk, keys, ids, held = chunk + 1, [], [], 0
                keys.append(key)
                ids.append(found[a:b])
                held += int(b - a)
        if keys:
            yield pa.RecordBatch.from_pylist([shard_row(part, chunk, keys, ids, encode.id_bytes)], schema)

    # rows of one id are told apart by their texts, equal rows by their places in the input
    digest, number = F.xxhash64(F.coalesce("text", F.lit(""))), F.monotonically_increasing_id()
    ordered = docs.select(F.col("doc_id").cast("long"), "text", digest.alias("digest"), number.alias("number"))
    ordered = ordered.repartitionByRange("doc_id", "digest", "number").sortWithinPartitions("doc_id", "digest", "number")
    ordered.select("doc_id", "text").mapInArrow(rows, SHARD).write.option("compression", "zstd").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(folder)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, chunk, shard_start): ids in all shards before. Sums by part first, so no window holds all shards
    but one row per part."""
    sizes = shards.select("part", "chunk", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("of_part"))
    parts = parts.select("part", F.coalesce(F.sum("of_part").over(Window.orderBy("part").rowsBetween(*_BEFORE)), F.lit(0)).alias("part_start"))
    within = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("chunk").rowsBetween(*_BEFORE)), F.lit(0))
    placed = sizes.withColumn("within", within).join(parts, "part")
    return placed.select("part", "chunk", (F.col("part_start") + F.col("within")).alias("shard_start"))


def documents(shards: DataFrame) -> DataFrame:
    """One row per stored document, found by its key through the index: doc_id, start, n_tokens, ids_crc32."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                shard, (ids, known) = Shard.of(row), keys_of(row)
                found = shard.find(key_hashes(ids, known, _turns(ids, known)))
                sums = [crc32(shard.ids[a : a + n].astype("<u4").tobytes()) for a, n in found]
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["chunk"], np.int32)),
                        pa.array(ids, mask=~known), pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(sums, pa.int64()),
                    ],
                    ["part", "chunk", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    found = shards.mapInArrow(rows, "part int, chunk int, doc_id long, place long, n_tokens long, ids_crc32 long")
    placed = found.join(shard_starts(shards), ["part", "chunk"])
    return placed.select("doc_id", (F.col("shard_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def head_turns(shards: DataFrame) -> DataFrame:
    """(part, chunk, head_turn): rows of a shard's first id in the shards before it. Only ends of shards are read, and a
    window holds the shards that one id lies in."""
    ends = F.array(
        F.struct(F.col("head_key").alias("key"), F.col("n_head").alias("n"), F.lit(True).alias("head")),
        F.struct(F.col("tail_key").alias("key"), F.col("n_tail").alias("n"), F.lit(False).alias("head")),
    )
    ends = F.filter(ends, lambda e: e["head"] | ~e["key"].eqNullSafe(F.col("head_key")))
    rows = shards.select("part", "chunk", F.inline(ends))
    before = F.sum("n").over(Window.partitionBy("key").orderBy("part", "chunk").rowsBetween(*_BEFORE))
    return rows.select("part", "chunk", "head", F.coalesce(before, F.lit(0)).alias("head_turn")).filter("head").drop("head")


def lookup(shards: DataFrame, keys: list[int], turn: int = 0) -> DataFrame:
    """(doc_id, ids) of the ``turn``-th row (from 0) of each of the given ids, where there is one; only shards whose
    range of ids holds one of them are read."""
    wanted = np.array(sorted(set(keys)), np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                shard, turns = Shard.of(row), np.full(len(wanted), turn, np.int64)
                if row["head_key"] is not None:
                    turns[wanted == row["head_key"]] -= row["head_turn"]
                here = wanted[turns >= 0]
                hashes = key_hashes(here, np.ones(len(here), bool), turns[turns >= 0])
                found = [(int(key), shard.ids[a : a + n].tolist()) for key, (a, n) in zip(here, shard.find(hashes), strict=True) if a >= 0]
                ids = pa.array([x[1] for x in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), ids], ["doc_id", "ids"])

    near = F.exists(F.array(*[F.lit(int(k)) for k in wanted]), lambda k: k.between(F.col("first_key"), F.col("last_key")))
    return shards.filter(near).join(head_turns(shards), ["part", "chunk"]).mapInArrow(rows, "doc_id long, ids array<long>")
