"""Removal of repeated strings, of bytes or of words, by suffix sorting.

Every string of ``span`` bytes holds an anchor: the least of its 32-byte hashes, of equal ones the first. Equal
strings have equal anchors at equal places, so only anchors that occur twice matter, and they are a small part of
the text. The bytes after each such anchor, and those before it read backwards, are suffix-sorted within the group
of the anchor: multikey quicksort to a shallow depth, then blind tries for what is still tied. The tree of common
prefixes gives, for each occurrence, how far its best partners agree with it on both sides; where that makes
``span`` bytes, they are marked.

Equal texts are one text with a count; if it has ``span`` bytes all of it goes. The group of an anchor is sorted in
one task while it has at most ``most_members`` occurrences. A larger one is partitioned by the bytes next to the
anchor first, as a multikey quicksort does, but as rows of a table: of two occurrences that agree on r bytes to the
right, and so on ``span`` - r to the left at least, r lies between two of a few cuts, lo <= r < hi, and both have the
same lo bytes on the right and the same ``span`` - hi + 1 on the left. Occurrences with such bytes in common are a
part, only parts of two or more go on, and a part that is still too large is cut again between lo and hi. Where hi is
lo + 1 the bytes in common are a whole string, so all of the part match and nothing is left to sort.

Strings of words are strings of bytes too: each word stands as a hash of eight bytes, so white space and the length of
words do not matter, and runs found are cut down to whole words.

Defined results: a null text is empty; texts below ``span`` bytes stay as they are; matches never cross documents; strings are judged on the input, so all copies go; null ids and repeated
rows are documents like any other. Where text is wanted again, characters cut in two are dropped.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rfsight.llm.arrow import BYTE_VALUES, prefix_sums, slice_hashes, slices, utf8, word_bounds
from rfsight.llm.scratch import drop, stored

SPAN, GRAM = 400, 32
#: Low bits of a hash that give way to its position, so that of equal hashes the first is the least.
PLACE_BITS = 24
SEGMENT = 1 << 21
#: Occurrences of an anchor, or of a part of its group, that one task sorts at most.
MOST_MEMBERS = 20_000
#: A passage that a pipeline takes out, in words.
PASSAGE = 51

_IS_WORD = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Units:
    """What strings are made of: bytes of the text, or words as hashes of ``width`` bytes."""

    width: int

    def coded(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the strings that stand for the rows of a text column."""
        data, offsets = utf8(column)
        if self.width == 1:
            return data, offsets
        starts, stops, rows = word_bounds(data, offsets, _IS_WORD)
        return slice_hashes(prefix_sums(BYTE_VALUES[data]), starts, stops).astype("<u8").view(np.uint8), rows * self.width

    def inside(self, start: int, stop: int) -> tuple[int, int]:
        """The whole units of a run."""
        return -(-start // self.width) * self.width, stop // self.width * self.width

    def cut(self, text: str | None, spans: list[dict]) -> bytes:
        """A text without runs of its string; a word goes with the white space behind it."""
        raw, pieces, at = (text or "").encode(), [], 0
        ends = [] if self.width == 1 else [*(m.start() for m in _WORD.finditer(raw)), len(raw)]
        for run in spans:
            start, stop = (run[k] if self.width == 1 else ends[run[k] // self.width] for k in ("start", "stop"))
            pieces.append(raw[at:start])
            at = stop
        return b"".join([*pieces, raw[at:]])


BYTES, WORDS = Units(1), Units(8)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``, by prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of all ``span``-byte strings within rows."""
    found, marks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for base in range(0, len(data), SEGMENT):
        part = data[base : base + SEGMENT + span]
        if len(part) < span:
            break
        sums = prefix_sums(BYTE_VALUES[part])
        at = np.arange(len(part) - GRAM + 1)
        hashes = slice_hashes(sums, at, at + GRAM)
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = window_minima((hashes & ~low) | at.astype(np.uint64), span - GRAM + 1)
        starts = np.arange(base, base + len(least))
        rows = np.searchsorted(offsets, starts, side="right") - 1
        within = starts + span <= offsets[rows + 1]
        places = np.unique((least[within] & low).astype(np.int64))
        found.append(places + base)
        marks.append(hashes[places])
    places, first = np.unique(np.concatenate(found), return_index=True)
    return places, np.concatenate(marks)[first]


# ---- suffix sorting ---------------------------------------------------------------------------

SHALLOW = 64
STEP = 8


def _common(a: int, b: int, width: int) -> int:
    """Leading bytes that two numbers of ``width`` bytes share."""
    return width - ((a ^ b).bit_length() + 7) // 8


class Suffixes:
    """Byte strings in order. Each is held as a number of ``width`` bytes, zeros behind its end."""

    def __init__(self, texts: list[bytes], width: int) -> None:
        self.texts, self.width = texts, width
        self.numbers = [int.from_bytes(t.ljust(width, b"\0"), "big") for t in texts]
        self.order: list[int] = []
        self._shallow(list(range(len(texts))), 0)

    def common(self, i: int, j: int) -> int:
        """Length of the common prefix of two strings."""
        shared = _common(self.numbers[i], self.numbers[j], self.width)
        return min(shared, len(self.texts[i]), len(self.texts[j]))

    def _shallow(self, group: list[int], depth: int) -> None:
        """Multikey quicksort: three-way partition by the next bytes, deeper only into the middle."""
        todo = [(group, depth, False)]
        while todo:
            group, depth, settled = todo.pop()
            if settled or len(group) < 2:
                self.order += group
                continue
            if depth >= SHALLOW:
                self._deep(group)
                continue
            keys = [self.texts[i][depth : depth + STEP] for i in group]
            pivot = keys[len(keys) // 2]
            parts: tuple[list[int], list[int], list[int]] = ([], [], [])
            for i, key in zip(group, keys, strict=True):
                parts[(key >= pivot) + (key > pivot)].append(i)
            # strings that end within this step are equal
            todo += [(parts[2], depth, False), (parts[1], depth + STEP, len(pivot) < STEP), (parts[0], depth, False)]

    def _deep(self, group: list[int]) -> None:
        """Blind trie: inner nodes hold only the place of the first difference, and its bytes lead on. A string
        goes down blindly to some leaf; one comparison with that leaf tells where it branches off."""
        root: list | int = group[0]
        for i in group[1:]:
            node = root
            while isinstance(node, list):
                node = node[1].get(self._byte(i, node[0]), next(iter(node[1].values())))
            place = self.common(i, node)
            if place == len(self.texts[i]) == len(self.texts[node]):
                place = self.width  # equal strings part behind all bytes, by their number
            parent, node = None, root
            while isinstance(node, list) and node[0] < place:
                parent, node = node, node[1][self._byte(i, node[0])]
            if isinstance(node, list) and node[0] == place:
                node[1][self._byte(i, place)] = i
                continue
            other = node
            while isinstance(other, list):
                other = next(iter(other[1].values()))
            branch = [place, {self._byte(other, place): node, self._byte(i, place): i}]
            if parent is None:
                root = branch
            else:
                parent[1][self._byte(i, parent[0])] = branch
        todo = [root]
        while todo:
            node = todo.pop()
            if isinstance(node, list):
                todo += [node[1][k] for k in sorted(node[1], reverse=True)]
            else:
                self.order.append(node)

    def _byte(self, i: int, place: int) -> int:
        text = self.texts[i]
        return text[place] if place < len(text) else (-1 if place < self.width else i)


def best_matches(lefts: list[bytes], rights: list[bytes], span: int = SPAN) -> list[list[tuple[int, int]]]:
    """For each occurrence of an anchor, (bytes before, bytes from the anchor on) that it shares with some other
    occurrence, as far as they make ``span`` together and none is within another of the list.

    ``lefts`` are read backwards; occurrences differ in one side at least. Sets of occurrences grow together along
    the tree of common prefixes on the right, deepest first, each in the order of its left sides: whoever joins
    finds its best partner on the left beside it. The smaller set joins the larger.
    """
    n = len(rights)
    right, left = Suffixes(rights, span), Suffixes(lefts, span)
    rank = [0] * n
    for r, i in enumerate(left.order):
        rank[i] = r
    members = [[rank[i]] for i in range(n)]
    owner = list(range(n))
    best, out = [-1] * n, [[] for _ in range(n)]

    def root(i: int) -> int:
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    def meet(i: int, j: int, shared: int) -> None:
        before = left.common(i, j)
        for k in (i, j):
            if before > best[k]:
                best[k] = before
                if before + shared >= span:
                    out[k].append((before, shared))

    pairs = sorted(
        ((right.common(i, j), i, j) for i, j in zip(right.order, right.order[1:], strict=False)), key=lambda x: -x[0]
    )
    for shared, i, j in pairs:
        if shared < GRAM:
            break
        a, b = root(i), root(j)
        if len(members[a]) > len(members[b]):
            a, b = b, a
        large = members[b]
        for r in members[a]:
            at = bisect_left(large, r)
            if at:
                meet(left.order[r], left.order[large[at - 1]], shared)
            if at < len(large):
                meet(left.order[r], left.order[large[at]], shared)
            large.insert(at, r)
        owner[a], members[a] = b, []
    return out


# ---- distributed ------------------------------------------------------------------------------


def text_key(text: str = "text") -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _arrow_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_MARK = pa.struct([("mark", pa.int64()), ("places", pa.list_(pa.int32()))])


def text_marks(docs: DataFrame, span: int, units: Units = BYTES) -> DataFrame:
    """key, id_key, n_bytes and anchors of each document; a narrow pass."""
    schema = pa.schema([("key", pa.binary()), ("id_key", pa.string()), ("n_bytes", pa.int64()), ("marks", pa.list_(_MARK))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = units.coded(batch.column("text"))
            places, hashes = anchors(data, offsets, span)
            bounds = np.searchsorted(places, offsets)
            out = []
            for i, (key, id_key) in enumerate(zip(batch.column("key").to_pylist(), batch.column("id_key").to_pylist(), strict=True)):
                own: dict[int, list[int]] = defaultdict(list)
                a, b = bounds[i], bounds[i + 1]
                for mark, place in zip(hashes[a:b].view(np.int64).tolist(), (places[a:b] - offsets[i]).tolist(), strict=True):
                    own[mark].append(place)
                out.append((key, id_key, int(offsets[i + 1] - offsets[i]), [{"mark": m, "places": p} for m, p in own.items()]))
            yield _arrow_rows(out, schema)

    keyed = docs.select(text_key().alias("key"), _id_key().alias("id_key"), "text")
    return keyed.mapInArrow(rows, "key binary, id_key string, n_bytes long, marks array<struct<mark:long,places:array<int>>>")


def _id_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


_MATCH = "key binary, start int, stop int"
_MATCHES = pa.schema([("key", pa.binary()), ("start", pa.int32()), ("stop", pa.int32())])


_SIDES = pa.schema(
    [("mark", pa.int64()), ("left", pa.binary()), ("right", pa.binary()), ("key", pa.binary()), ("places", pa.list_(pa.int32()))]
)


def _surroundings(span: int, units: Units) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: what stands around each shared anchor; the bytes before it are read backwards."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            out: list[tuple] = []
            data, offsets = units.coded(batch.column("text"))
            for i, (key, marks) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "marks")), strict=True)):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                for m in marks:
                    same: dict[tuple[bytes, bytes], list[int]] = defaultdict(list)
                    for p in m["places"]:
                        same[raw[max(0, p + GRAM - span) : p][::-1], raw[p : p + span]].append(p)
                    out += [(m["mark"], a, b, key, places) for (a, b), places in same.items()]
                if len(out) > 8000:
                    yield _arrow_rows(out, _SIDES)
                    out = []
            yield _arrow_rows(out, _SIDES)

    return rows


def _group_matches(span: int, units: Units) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function over surroundings sorted by anchor, or by part: marked (key, start, stop)."""

    def solve(group: dict[tuple[bytes, bytes], list[tuple[bytes, list[int]]]]) -> Iterator[tuple[bytes, int, int]]:
        sides = list(group)
        found = best_matches([a for a, _ in sides], [b for _, b in sides], span) if len(sides) > 1 else [[] for _ in sides]
        for (left, right), matches in zip(sides, found, strict=True):
            occurrences = {(key, p) for key, places in group[left, right] for p in places}
            if len(occurrences) > 1 and len(left) + len(right) >= span:
                matches = [(len(left), len(right))]
            for before, after in matches:
                for key, p in occurrences:
                    start, stop = units.inside(p - before, p + after)
                    if stop - start >= span:
                        yield key, start, stop

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, group, out = None, defaultdict(list), []
        for batch in batches:
            for m, left, right, key, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if m != mark:
                    out += solve(group)
                    mark, group = m, defaultdict(list)
                    if len(out) > 50_000:
                        yield _arrow_rows(out, _MATCHES)
                        out = []
                group[left, right].append((key, places))
        out += solve(group)
        yield _arrow_rows(out, _MATCHES)

    return rows


#: Parts that an interval between two cuts is cut into.
CUTS = 8


def _cuts(lo: int, hi: int) -> list[tuple[int, int]]:
    """Intervals that make up lo <= r < hi."""
    step = -(-(hi - lo) // CUTS)
    return [(a, min(a + step, hi)) for a in range(lo, hi, step)]


_PART = "part binary, lo int, hi int, left binary, right binary, key binary, places array<int>"


def _parts(span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function over parts: the smaller part that an occurrence is in for each interval of bytes on the right.

    All of a part have the same ``lo`` bytes on the right and ``span`` - ``hi`` + 1 on the left. Its rows hold only the
    bytes behind these, up to those that a string with lo <= r < hi bytes on the right can reach.
    """
    kinds = [("part", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), *list(_SIDES)[1:]]
    schema = pa.schema(kinds)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part, lo, hi, left, right, key, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                known = span - hi + 1
                for low, high in _cuts(lo, hi):
                    before = span - high + 1
                    same, more = (left[: before - known], right[: low - lo]), (left[before - known : span - low - known], right[low - lo : high - 1 - lo])
                    if len(same[0]) < before - known or len(same[1]) < low - lo or len(more[0]) + len(more[1]) < high - low - 1:
                        continue  # no string of the interval fits into the text
                    name = hashlib.blake2b(b"%b %d %d " % (part, low, high) + same[0] + same[1], digest_size=16).digest()
                    out.append((name, low, high, *more, key, places))
                if len(out) > 20_000:
                    yield _arrow_rows(out, schema)
                    out = []
            yield _arrow_rows(out, schema)

    return rows


def _part_matches(span: int, units: Units) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function over rows sorted by part: matches. What all of a part have in common stands as zeros."""
    sort = _group_matches(span, units)

    def padded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, lo, hi, left, right, key, places = (c.to_pylist() for c in batch.columns)
            left = [bytes(span - h + 1) + x for h, x in zip(hi, left, strict=True)]
            right = [bytes(n) + x for n, x in zip(lo, right, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary()), pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(key, pa.binary()), pa.array(places, pa.list_(pa.int32()))],
                ["mark", "left", "right", "key", "places"],
            )

    return lambda batches: sort(padded(batches))


def _crowded_matches(around: DataFrame, span: int, most_members: int, units: Units) -> list[DataFrame]:
    """Matches of the groups in ``around``, whatever their size, as stored tables of (key, start, stop).

    Surroundings that occur twice match as far as they reach; one row of each different surroundings stands for it
    in the parts."""
    side = F.unhex(F.md5(F.concat(F.md5("left"), F.md5("right")).cast("binary")))
    around = stored(around.withColumn("side", side), "crowded-sides")
    seen = around.groupBy("mark", "side").agg(F.sum(F.size("places")).alias("n"))
    again = around.select("mark", "side", "key", "places", F.length("left").alias("before"), F.length("right").alias("after"))
    again = again.join(seen.filter("n > 1").select("mark", "side"), ["mark", "side"], "left_semi").withColumn("at", F.explode("places"))
    again = again.select("key", (F.col("at") - F.col("before")).alias("start"), (F.col("at") + F.col("after")).alias("stop"))
    found = [stored(_whole(again, span, units), "crowded-equal")]
    different = around.dropDuplicates(["mark", "side"])
    group = F.unhex(F.lpad(F.hex("mark"), 16, "0")).alias("part")
    start = F.substring("right", GRAM + 1, span).alias("right")
    rows = different.select(group, F.lit(GRAM).alias("lo"), F.lit(span + 1).alias("hi"), "left", start, "key", "places")
    held = [around]
    while True:
        parts = stored(rows.mapInArrow(_parts(span), _PART), "parts")
        drop(*held)
        counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = stored(parts.join(counts, "part"), "shared-parts")
        drop(parts)
        single = F.col("hi") - F.col("lo") == 1
        settled = shared.filter(single).select("key", "lo", F.explode("places").alias("at"))
        settled = settled.select("key", (F.col("at") + F.col("lo") - span).alias("start"), (F.col("at") + F.col("lo")).alias("stop"))
        columns = ["part", "lo", "hi", "left", "right", "key", "places"]
        small = shared.filter(~single & (F.col("n") <= most_members)).select(*columns)
        small = small.repartition("part").sortWithinPartitions("part").mapInArrow(_part_matches(span, units), _MATCH)
        found.append(stored(_whole(settled, span, units).unionByName(small), "crowded-matches"))
        rows = shared.filter(~single & (F.col("n") > most_members)).select(*columns)
        if rows.isEmpty():
            drop(shared)
            return found
        held = [shared]


def _whole(matches: DataFrame, span: int, units: Units) -> DataFrame:
    """Matches cut down to whole units, if these still make ``span`` bytes."""
    start = (F.ceil(F.col("start") / units.width) * units.width).cast("int")
    stop = (F.floor(F.col("stop") / units.width) * units.width).cast("int")
    return matches.select("key", start.alias("start"), stop.alias("stop")).filter(F.col("stop") - F.col("start") >= span)


def merged_runs(matches: DataFrame) -> DataFrame:
    """key and spans: runs of overlapping or touching matches, in order. One sorted pass over a text's matches."""
    longest = matches.groupBy("key", "start").agg(F.max("stop").alias("stop"))
    order = Window.partitionBy("key").orderBy("start")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = longest.withColumn("apart", F.when(reached >= F.col("start"), 0).otherwise(1))
    numbered = marked.withColumn("run", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("key", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def repeated_spans(docs: DataFrame, span: int = SPAN, most_members: int = MOST_MEMBERS, units: Units = BYTES) -> DataFrame:
    """(key, id_key, n_bytes, spans) of each different (text, id): the maximal runs that repeat, as bytes of the
    string that stands for the text."""
    marks = stored(text_marks(docs, span, units), "anchors")
    texts = marks.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("id_key").alias("first"), F.first("n_bytes").alias("n_bytes"))
    # one document of each text speaks for it
    chosen = marks.join(texts.select("key", F.col("first").alias("id_key")), ["key", "id_key"], "left_semi").dropDuplicates(["key"])
    places = stored(chosen.select("key", "id_key", F.inline("marks")), "places")
    counts = places.groupBy("mark").agg(F.sum(F.size("places")).alias("n")).filter("n > 1")
    shared = places.join(counts, "mark").withColumn("crowded", F.col("n") > most_members)
    per_text = shared.groupBy("key", "id_key", "crowded").agg(F.collect_list(F.struct("mark", "places")).alias("marks"))
    per_text = stored(per_text, "shared-anchors")
    keyed = docs.select(text_key().alias("key"), _id_key().alias("id_key"), "text")

    def around(crowded: bool) -> DataFrame:
        wanted = keyed.join(per_text.filter(F.col("crowded") == crowded).drop("crowded"), ["key", "id_key"])
        kind = "mark long, left binary, right binary, key binary, places array<int>"
        return wanted.select("key", "text", "marks").mapInArrow(_surroundings(span, units), kind)

    groups = around(False).repartition("mark").sortWithinPartitions("mark")
    matches = groups.mapInArrow(_group_matches(span, units), _MATCH)
    if not per_text.filter("crowded").isEmpty():
        for found in _crowded_matches(around(True), span, most_members, units):
            matches = matches.unionByName(found)
    runs = merged_runs(matches)
    none = F.array().cast("array<struct<start:int,stop:int>>")
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop")))
    of_text = texts.join(runs, "key", "left")
    spans = F.when((F.col("copies") > 1) & (F.col("n_bytes") >= span), everything).otherwise(F.coalesce("spans", none))
    of_text = of_text.select("key", spans.alias("spans"))
    return marks.select("key", "id_key", "n_bytes").distinct().join(of_text, "key")


def _with_spans(docs: DataFrame, span: int, most_members: int, units: Units = BYTES) -> DataFrame:
    """row (a struct of all columns of ``docs``), text, n_bytes and the spans to remove, null if there are none."""
    spans = stored(repeated_spans(docs, span, most_members, units), "spans").filter(F.size("spans") > 0)
    keyed = docs.select(F.struct("*").alias("row"), F.col("text"), text_key().alias("key"), _id_key().alias("id_key"))
    joined = keyed.join(spans.select("key", "id_key", "spans"), ["key", "id_key"], "left")
    return joined.select("row", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "spans")


def without_repeats(docs: DataFrame, span: int = SPAN, most_members: int = MOST_MEMBERS) -> DataFrame:
    """row (a struct of all columns of ``docs``), kept (binary), n_bytes, n_removed and n_spans of each row."""

    @F.arrow_udf("binary")
    def cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
        return pa.array([BYTES.cut(t.as_py(), own.as_py() or []) for t, own in zip(texts, runs, strict=True)], pa.binary())

    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return _with_spans(docs, span, most_members).select(
        "row",
        cut(F.col("text"), F.col("spans")).alias("kept"),
        "n_bytes",
        F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        F.when(F.col("spans").isNull(), 0).otherwise(F.size("spans")).cast("long").alias("n_spans"),
    )


def shortened(docs: DataFrame, span: int = SPAN, most_members: int = MOST_MEMBERS, units: Units = BYTES) -> DataFrame:
    """``docs`` with what repeats taken out of the text and n_chars counted anew; other columns stay. A null text
    stays null; a character that loses some of its bytes goes altogether."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
        rows = zip(texts, runs, strict=True)
        return pa.array([units.cut(t.as_py(), own.as_py()).decode(errors="ignore") if own.is_valid else t.as_py() for t, own in rows], pa.string())

    rows = _with_spans(docs, span, most_members, units).select("row", cut(F.col("text"), F.col("spans")).alias("text"))
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[own.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def without_passages(docs: DataFrame, words: int = PASSAGE) -> DataFrame:
    """``docs`` without passages of at least so many words that occur more than once, whatever their white space."""
    return shortened(docs, span=words * WORDS.width, units=WORDS)
