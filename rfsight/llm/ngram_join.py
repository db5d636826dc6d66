"""Jaccard join of word five-gram sets, exact.

Texts of equal sets are one class. Shingles that occur in one class only cannot be shared, so a class with fewer
shared shingles than a link takes drops out; nearly all do, after one count of all shingles (as packed arrays, a
bucket of the hash space per group). What is left is compared in tiles: classes that share one of their rarest
shingles and lie in the same or neighbouring band of set sizes. A link of 0.75 takes both: some common shingle is
among the rarest quarter of either set, and sizes differ by a third at most.

Many shingles bring the same sets together, so sets that any of them brings together, by way of one leader each,
are a cluster, and each set is sent to a tile once: a band of a cluster. Within a tile, bitmaps of hashed shingles
bound each overlap from above by bit counts, and only pairs within the bound have their sorted arrays intersected.
Pairs that links connect already are passed over, and no table holds all pairs of a group.

A tile of more than ``BLOCK`` sets is dealt in two rounds. First each block of it meets itself and a few leaders,
the same in all blocks, so near copies of one text are connected after that. Then sets are dealt anew by what
connects them: a component large enough has blocks of its own, and two blocks of one component do not meet. Only
sets that are still apart from it do, so a tile of n near copies takes about n rows rather than n times its blocks.

Defined results: words are runs of other than ASCII white space, A-Z as a-z; fewer than five words make one
shingle; a null, empty or blank text has an empty set and is linked with nothing; repeated rows are linked with
each other; a null id never names a component that has another id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rfsight.llm.arrow import BYTE_VALUES, mix, prefix_sums, slice_hashes, slices, utf8, word_bounds
from rfsight.llm.components import components
from rfsight.llm.scratch import stored

WORDS = 5
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Shingles in a bucket of the count, about, and members of a block of a tile.
BUCKET, BLOCK = 4_000_000, 1024
#: Sets of a large tile that all its blocks meet first.
LEADERS = 32
#: Bytes of a hash that travel; six bits more, or as many as there are buckets, follow from the bucket.
TRAVEL = 7

_CODES = np.arange(256)
IS_WORD = ~np.isin(_CODES, [9, 10, 11, 12, 13, 32])
LOWER = _CODES.astype(np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, stops, rows = word_bounds(data, offsets, IS_WORD)
    sums = prefix_sums(slice_hashes(prefix_sums(BYTE_VALUES[data]), starts, stops))
    at = np.arange(max(0, len(starts) - WORDS + 1))
    grams = mix(slice_hashes(sums, at, at + WORDS) + np.uint64(WORDS))
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(grams[a : b - WORDS + 1]))
        elif b > a:
            out.append(mix(slice_hashes(sums, np.array([a]), np.array([b])) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(shingles: np.ndarray, turn: int) -> tuple[bytes, int]:
    """(digest of a set, 64-bit number of it)."""
    digest = hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()
    number = hashlib.blake2b(digest, digest_size=8, salt=turn.to_bytes(4, "little")).digest()
    return digest, int.from_bytes(number, "little", signed=True)


def least_overlap(n: np.ndarray | int, m: np.ndarray | int = 0) -> np.ndarray | int:
    """Least intersection of a link between sets of n and m shingles; of n and any other set without m."""
    return -(-PERCENT * (n + m) // (100 + PERCENT)) if not (isinstance(m, int) and m == 0) else -(-PERCENT * n // 100)


def text_key() -> Column:
    """Key of a row's text; null and empty texts have the same."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def document_sets(docs: DataFrame, turn: int = 0) -> DataFrame:
    """doc_id, text_key, digest, set_id and n_shingles of each document; a narrow pass."""
    kinds = {"doc_id": pa.int64(), "text_key": pa.binary(), "digest": pa.binary(), "set_id": pa.int64(), "n_shingles": pa.int64()}
    schema = pa.schema(list(kinds.items()))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            keys = [set_key(s, turn) for s in sets]
            made = [[k[0] for k in keys], [k[1] for k in keys], [len(s) for s in sets]]
            made = [pa.array(c, f.type) for c, f in zip(made, list(schema)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *made], schema=schema)

    keyed = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text")
    return keyed.mapInArrow(rows, "doc_id long, text_key binary, digest binary, set_id long, n_shingles long")


def _bucket_rows(docs: DataFrame, buckets: int, turn: int) -> DataFrame:
    """All shingles, dealt to buckets by their hash: for a batch of texts and a bucket, the sets' numbers and sizes,
    how many shingles each has there, and those shingles."""
    names = ["ids", "sizes", "counts", "shingles"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = {}
            for s in shingle_sets(batch.column("text")):
                if len(s):
                    own[set_key(s, turn)[1]] = s
            if not own:
                continue
            ids, sizes = np.array(list(own), "<i8"), np.array([len(s) for s in own.values()], "<u4")
            tokens = np.concatenate(list(own.values()))
            at = (tokens & np.uint64(buckets - 1)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            of = np.repeat(np.arange(len(ids)), sizes)
            tokens = (tokens[order] >> np.uint64(buckets.bit_length() - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TRAVEL]
            # runs of one set in one bucket; they are as many as there are, whatever the number of buckets
            at, of = at[order], of[order]
            run = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (of[1:] != of[:-1])))
            counts = np.diff(np.append(run, len(at))).astype("<u4")
            first = np.append(np.flatnonzero(np.append(True, at[run][1:] != at[run][:-1])), len(run))
            ends = np.append(run, len(at))
            out = []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                here = of[run[a:b]]
                shown = (x.tobytes() for x in (ids[here], sizes[here], counts[a:b], tokens[ends[a] : ends[b]]))
                out.append((int(at[run[a]]), *shown))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["bucket", *names])

    return docs.select("text").mapInArrow(rows, "bucket int, ids binary, sizes binary, counts binary, shingles binary")


_SHARED = "set_id long, n int, shared int, shingles binary, spread binary"


def _travelled(raw: bytes, bucket: int) -> np.ndarray:
    """Shingle hashes of a bucket as they were before, but for their highest bits."""
    padded = np.zeros((len(raw) // TRAVEL, 8), np.uint8)
    padded[:, :TRAVEL] = np.frombuffer(raw, np.uint8).reshape(-1, TRAVEL)
    return padded.view("<u8").ravel() * np.uint64(64) + np.uint64(bucket % 64)


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over bucket rows in order of buckets: of each set, the shingles that other sets have too, with in how many."""

    def solve(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        ids, sizes, tokens = (np.concatenate(x) for x in held)
        order = np.argsort(tokens, kind="stable")
        tokens, ids, sizes = tokens[order], ids[order], sizes[order]
        tied = np.zeros(len(tokens) + 1, bool)
        tied[1:-1] = tokens[1:] == tokens[:-1]
        keep = tied[1:] | tied[:-1]
        tokens, ids, sizes = tokens[keep], ids[keep], sizes[keep]
        order = np.lexsort((ids, tokens))
        tokens, ids, sizes = tokens[order], ids[order], sizes[order]
        new = np.ones(len(tokens), bool)  # not a copy of the same set from another batch
        new[1:] = (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1])
        tokens, ids, sizes = tokens[new], ids[new], sizes[new]
        _, back, count = np.unique(tokens, return_inverse=True, return_counts=True)
        spread = count[back]
        more = spread > 1
        tokens, ids, sizes, spread = tokens[more], ids[more], sizes[more], spread[more]
        order = np.argsort(ids, kind="stable")
        tokens, ids, sizes, spread = tokens[order].astype("<u8"), ids[order], sizes[order], spread[order].astype("<u4")
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)
        ends = np.append(first, len(ids))[1:].astype(np.int64)
        raw, often = tokens.tobytes(), spread.tobytes()
        spans = list(zip(first.tolist(), ends.tolist(), strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[first], pa.int64()), pa.array(sizes[first], pa.int32()), pa.array(ends - first, pa.int32()),
                pa.array([raw[8 * a : 8 * b] for a, b in spans], pa.binary()), pa.array([often[4 * a : 4 * b] for a, b in spans], pa.binary()),
            ],
            ["set_id", "n", "shared", "shingles", "spread"],
        )

    bucket, held = None, [[], [], []]
    for batch in batches:
        for k, ids, sizes, counts, shingles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != bucket:
                if held[0]:
                    yield solve(held)
                bucket, held = k, [[], [], []]
            counts = np.frombuffer(counts, "<u4")
            held[0].append(np.repeat(np.frombuffer(ids, "<i8"), counts))
            held[1].append(np.repeat(np.frombuffer(sizes, "<u4"), counts))
            held[2].append(_travelled(shingles, k))
    if held[0]:
        yield solve(held)


_SET = "set_id long, n int, band int, shingles binary, rarest array<long>"


def _candidate_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared shingles of each set, sorted, and those among its rarest that a link must have one of."""
    for batch in batches:
        out = []
        for set_id, n, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            tokens = np.frombuffer(b"".join(p["shingles"] for p in parts), "<u8")
            spread = np.frombuffer(b"".join(p["spread"] for p in parts), "<u4")
            order = np.lexsort((tokens, spread))
            # shingles of this set alone are the rarest of all, and come first
            length = n - least_overlap(n) + 1 - (n - len(tokens))
            rarest = tokens[order[:length]].view(np.int64).tolist()
            out.append((set_id, n, int(log(n) / log(100 / PERCENT) + 1e-9), np.sort(tokens).tobytes(), rarest))
        columns = zip(*out, strict=True) if out else [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["set_id", "n", "band", "shingles", "rarest"]
        )


def candidates(docs: DataFrame, total: int, turn: int) -> DataFrame:
    """Sets of which enough shingles occur elsewhere for a link, as a stored table."""
    buckets = 64 << max(0, (total // (64 * BUCKET)).bit_length())
    dealt = _bucket_rows(docs, buckets, turn).repartition("bucket").sortWithinPartitions("bucket")
    shared = stored(dealt.mapInArrow(_shared_rows, _SHARED), "shared-shingles")
    enough = shared.groupBy("set_id", "n").agg(F.sum("shared").alias("in_all"))
    enough = enough.filter(F.col("in_all") * 100 >= F.col("n") * PERCENT).select("set_id")
    parts = F.collect_list(F.struct("shingles", "spread")).alias("parts")
    sets = shared.join(enough, "set_id", "left_semi").groupBy("set_id", "n").agg(parts)
    return stored(sets.mapInArrow(_candidate_sets, _SET), "candidate-sets")


# ---- tiles ------------------------------------------------------------------------------------


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """A row of 64-bit words per set: bit h mod ``bits`` for each of its shingles."""
    out = np.zeros((len(sets), bits), bool)
    for i, s in enumerate(sets):
        out[i, (s % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def within_bound(one: np.ndarray, n: int, many: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether bit counts leave room for a link between a set and each of many.

    A shingle whose bit the other bitmap lacks is not in the other set, so a set's size less the number of such bits
    is an upper bound of the overlap. Sizes are of whole sets; bitmaps only need to hold what may be shared.
    """
    alone = np.bitwise_count(one & ~many).sum(axis=1, dtype=np.int64)
    theirs = np.bitwise_count(~one & many).sum(axis=1, dtype=np.int64)
    return np.minimum(n - alone, sizes - theirs) >= least_overlap(sizes, n)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _bits(n: int) -> int:
    return 1 << max(6, int(2 * n - 1).bit_length())


_MEETING = ["root", "tile", "low", "high"]


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (tile, pair of blocks): links that connect what links connect, fewer than members.

    Each set in turn meets those after it that are in another component by then; sets may be connected to begin with.
    Where two blocks meet, pairs within one are passed over.
    """

    def solve(members: list[tuple], two_blocks: bool) -> list[tuple[int, int]]:
        ids, sizes, blocks, known, sets = map(list, zip(*members, strict=True))
        comp = np.unique(np.array(known, np.int64), return_inverse=True)[1]
        maps, sizes, blocks, links = bitmaps(sets, _bits(max(sizes))), np.array(sizes), np.array(blocks), []
        for i in range(len(ids) - 1):
            others = np.arange(i + 1, len(ids))
            others = others[(comp[i + 1 :] != comp[i]) & ((blocks[i + 1 :] != blocks[i]) | (not two_blocks))]
            if not len(others):
                continue
            for k in others[within_bound(maps[i], int(sizes[i]), maps[others], sizes[others])]:
                if comp[k] != comp[i] and overlap(sets[i], sets[k]) >= least_overlap(int(sizes[k]), int(sizes[i])):
                    links.append((ids[i], ids[k]))
                    comp[comp == comp[k]] = comp[i]
        return links

    def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [[], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    tile, members = None, []
    for batch in batches:
        found = []
        for *key, set_id, n, block, known, shingles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != tile:
                found += solve(members, tile[2] != tile[3]) if members else []
                tile, members = key, []
            members.append((set_id, n, block, known, np.frombuffer(shingles, "<u8")))
        yield batch_of(found)
    yield batch_of(solve(members, tile[2] != tile[3]) if members else [])


def clusters(places: DataFrame) -> DataFrame:
    """(node, root): candidates connected by common rare shingles, by way of one leader per shingle and band."""
    rank = F.struct(F.xxhash64("set_id").alias("rank"), F.col("set_id").alias("id"))
    heads = places.groupBy("token", "tile").agg(F.min(rank).alias("leader"), F.count(F.lit(1)).alias("members"))
    heads = heads.filter("members > 1").select("token", "tile", F.col("leader.id").alias("leader"))
    met = places.join(heads, ["token", "tile"]).filter("set_id <> leader")
    return components(met.select(F.col("set_id").alias("a"), F.col("leader").alias("b")))


def _meetings(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among sets that meet; ``rows`` are root, tile, low, high, turn, set_id, block and known, a number that
    connected sets share."""
    rows = rows.join(sets.select("set_id", "n", "shingles"), "set_id")
    rows = rows.repartition(*_MEETING).sortWithinPartitions(*_MEETING, "turn", "set_id")
    return rows.select(*_MEETING, "set_id", "n", "block", "known", "shingles").mapInArrow(_tile_links, "a long, b long")


def first_meetings(members: DataFrame) -> DataFrame:
    """Each block of a large tile with itself, behind the leaders of the tile."""
    place = F.row_number().over(Window.partitionBy("root", "tile").orderBy(F.xxhash64("set_id", F.lit(5)), "set_id"))
    leaders = members.withColumn("place", place).filter(F.col("place") <= LEADERS)
    leaders = leaders.select("root", "tile", "set_id", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("turn"))
    block = F.pmod(F.xxhash64("set_id", F.lit(3)), F.col("blocks")).cast("int").alias("block")
    rows = members.select("root", "tile", "set_id", block, F.lit(1).alias("turn")).unionByName(leaders)
    rows = rows.groupBy("root", "tile", "block", "set_id").agg(F.min("turn").alias("turn"))
    return rows.select("root", "tile", F.col("block").alias("low"), F.col("block").alias("high"), "turn", "set_id", "block", F.col("set_id").alias("known"))


def second_meetings(members: DataFrame, connected: DataFrame) -> DataFrame:
    """Pairs of blocks of a large tile, dealt by component, but for pairs of blocks of one component."""
    members = members.join(connected.select(F.col("node").alias("set_id"), F.col("root").alias("known")), "set_id", "left")
    members = stored(members.withColumn("known", F.coalesce("known", "set_id")), "known-members")
    sizes = members.groupBy("root", "tile", "known").agg(F.count(F.lit(1)).alias("size"))
    own = F.when(F.col("size") >= BLOCK, F.col("known"))  # null: small components, dealt together
    units = sizes.withColumn("unit", own).groupBy("root", "tile", "unit").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks"))
    of_tile = Window.partitionBy("root", "tile")
    before = F.sum("blocks").over(of_tile.orderBy("unit").rowsBetween(Window.unboundedPreceding, 0)) - F.col("blocks")
    units = units.select("*", before.cast("int").alias("first"), F.sum("blocks").over(of_tile).cast("int").alias("total"))
    dealt = sizes.select("root", "tile", "known", own.alias("unit")).alias("s").join(
        units.alias("u"), F.expr("s.root = u.root AND s.tile = u.tile AND s.unit <=> u.unit")
    )
    dealt = dealt.select("s.root", "s.tile", "s.known", "s.unit", "blocks", "first", "total")
    rows = members.select("root", "tile", "known", "set_id").join(dealt, ["root", "tile", "known"])
    spread = F.when(F.col("unit").isNull(), F.xxhash64("known", F.lit(7))).otherwise(F.xxhash64("set_id", F.lit(7)))
    rows = rows.withColumn("block", F.col("first") + F.pmod(spread, F.col("blocks")).cast("int"))
    none = F.array().cast("array<int>")
    below = F.when(F.col("first") > 0, F.sequence(F.lit(0), F.col("first") - 1)).otherwise(none)
    last = F.col("first") + F.col("blocks")
    above = F.when(last < F.col("total"), F.sequence(last, F.col("total") - 1)).otherwise(none)
    inside = F.when(F.col("unit").isNull(), F.sequence(F.col("first"), last - 1)).otherwise(none)
    rows = rows.select("root", "tile", "known", "set_id", "block", F.explode(F.concat(below, inside, above)).alias("other"))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    return rows.select("root", "tile", low, high, F.lit(0).alias("turn"), "set_id", "block", "known")


def tile_links(sets: DataFrame, places: DataFrame, roots: DataFrame) -> DataFrame:
    """Links within each cluster, enough of them to connect what links connect, as a stored table.

    A tile is a band of a cluster with its own sets and those of the band below.
    """
    members = places.select("set_id", "tile", "home").distinct().join(roots.withColumnRenamed("node", "set_id"), "set_id")
    tiles = members.groupBy("root", "tile").agg(F.count(F.lit(1)).alias("members"), F.max("home").alias("any_home"))
    tiles = tiles.filter("members > 1 AND any_home").select("root", "tile", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    members = stored(members.select("set_id", "tile", "root").join(tiles, ["root", "tile"]), "members")
    zero, large = F.lit(0), members.filter("blocks > 1")
    small = members.filter("blocks = 1").select(
        "root", "tile", zero.alias("low"), zero.alias("high"), zero.alias("turn"), "set_id", zero.alias("block"), F.col("set_id").alias("known")
    )
    if large.isEmpty():
        return stored(_meetings(small, sets), "links")
    first = stored(_meetings(small.unionByName(first_meetings(large)), sets), "first-links")
    second = _meetings(second_meetings(large, components(first)), sets)
    return stored(first.unionByName(second), "links")


def similar_sets(docs: DataFrame, total: int, turn: int) -> DataFrame:
    """(node, root): sets that are connected by links, and the least number among them."""
    sets = candidates(docs, total, turn)
    own, above = ((F.col("band") + k).alias("tile") for k in (0, 1))
    tiles = F.array(F.struct(own, F.lit(True).alias("home")), F.struct(above, F.lit(False).alias("home")))
    places = sets.select("set_id", "band", F.explode("rarest").alias("token")).select("set_id", "token", F.inline(tiles))
    return components(tile_links(sets, places, clusters(places)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles and component_id of each row: the smallest doc_id that links lead to, itself
    included."""
    turn = 0
    while True:
        own = stored(document_sets(docs, turn), "sets")
        seen = own.agg(
            F.count_distinct("digest").alias("digests"), F.count_distinct("set_id").alias("numbers"),
            F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("total"),
        ).first()
        if seen["digests"] == seen["numbers"]:
            break
        turn += 1  # two sets got the same number: number them anew
    classes = own.filter("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    roots = similar_sets(docs, seen["total"], turn).withColumnRenamed("node", "set_id")
    classes = classes.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    heads = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(heads, "root").select("set_id", "component_id")
    out = own.join(classes, "set_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, less those that links lead from to a smaller doc_id, and less repetitions
    of a row's id and text."""
    found = stored(near_duplicates(docs).select("doc_id", "text_key", "component_id"), "components")
    out = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text_key().alias("key"))
    gone = found.filter("NOT (doc_id <=> component_id)").select("doc_id", "text_key").distinct()
    kept = out.join(gone, out["id"].eqNullSafe(gone["doc_id"]) & (out["key"] == gone["text_key"]), "left_anti")
    repeated = found.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["id", "key"])
    return kept.select("row.*")
