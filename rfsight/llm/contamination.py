"""Benchmark decontamination by winnowing.

Of every window of six consecutive five-word hashes the least is kept, so any shared run of ten words has a kept
hash in common, whatever surrounds it. Training fingerprints join test fingerprints; each hit is then extended to
the ten-word windows around it, which are compared exactly with those of the benchmark.

Words: ASCII letters and digits, and everything beyond ASCII; A-Z count as a-z. An item of fewer words than a
window is one window, its own fingerprint. Defined results: a null or empty text has no words and is clean; an
item without words is found nowhere; repeated items are reported once, repeated documents each; items of a null id
hit words but aren't listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rfsight.llm.arrow import BYTE_VALUES, mix, prefix_sums, slice_hashes, slices, utf8, word_bounds
from rfsight.llm.scratch import stored

WINDOW, GRAM = 10, 5
#: Bits of the filter that tasks get: one megabyte, whatever the benchmark. It only spares rows; the join decides.
FILTER_BITS = 23

_CODES = np.arange(256)
IS_WORD = (
    ((_CODES >= ord("0")) & (_CODES <= ord("9")))
    | (((_CODES | 32) >= ord("a")) & ((_CODES | 32) <= ord("z")) & (_CODES < 128))
    | (_CODES >= 128)
)
LOWER = _CODES.astype(np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Words:
    """Words of a batch of texts, lower-cased, with their hashes and the offsets of each row's words."""

    def __init__(self, texts: pa.Array) -> None:
        data, offsets = utf8(texts)
        self.data = LOWER[data]
        self.starts, self.stops, self.rows = word_bounds(self.data, offsets, IS_WORD)
        hashes = slice_hashes(prefix_sums(BYTE_VALUES[self.data]), self.starts, self.stops)
        self.sums = prefix_sums(hashes)

    def grams(self, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each word on; meaningless where a row has fewer left."""
        at = np.arange(max(0, len(self.starts) - length + 1))
        return mix(slice_hashes(self.sums, at, at + length) + np.uint64(length))

    def row(self, i: int) -> tuple[int, int]:
        return int(self.rows[i]), int(self.rows[i + 1])

    def digest(self, start: int, length: int) -> bytes:
        """Digest of a window's words, by which windows are the same."""
        words = [self.data[self.starts[k] : self.stops[k]].tobytes() for k in range(start, start + length)]
        return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def winnow(hashes: np.ndarray, width: int = WINDOW - GRAM + 1) -> np.ndarray:
    """Positions of the least hash of each run of ``width``; of equal ones the last."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = hashes[:n].copy(), np.arange(n)
    for k in range(1, width):
        less = hashes[k : k + n] <= best
        np.copyto(best, hashes[k : k + n], where=less)
        np.copyto(at, np.arange(k, k + n), where=less)
    return np.unique(at)


def text_key() -> Column:
    """Key of a row's text; null and empty texts have the same."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


_ITEM = "item_id string, fingerprint long, digest binary, length int"


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of every item, one row each: item_id, digest, length; and fingerprints: length 0 and no digest."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            out = []
            for i, item in enumerate(batch.column("item_id").to_pylist()):
                a, b = words.row(i)
                size = min(WINDOW, b - a)
                if not size:
                    continue
                out += [(item, None, words.digest(k, size), size) for k in range(a, b - size + 1)]
                if size < WINDOW:
                    marks = words.grams(size)[a : a + 1]
                else:
                    grams = words.grams(GRAM)[a : b - GRAM + 1]
                    marks = grams[winnow(grams)]
                out += [(item, int(x), None, size) for x in np.unique(marks).view(np.int64)]
            columns = zip(*out, strict=True) if out else [[]] * 4
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.int32()]
            names = ["item_id", "fingerprint", "digest", "length"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(rows, _ITEM)


def _filter(marks: DataFrame) -> np.ndarray:
    """Bit table of the test fingerprints' low bits, packed on the executors; never more than its fixed size."""
    low = F.col("fingerprint").bitwiseAND((1 << FILTER_BITS) - 1)
    bit = F.expr("shiftleft(1, CAST(fingerprint & 7 AS int))")
    bits = marks.select(F.shiftrightunsigned(low, 3).alias("byte"), bit.alias("bit"))
    table = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    found = bits.groupBy("byte").agg(F.bit_or("bit").cast("short").alias("bits")).toArrow()
    table[found["byte"].to_numpy()] = found["bits"].to_numpy()
    return table


_DOC = "doc_id long, text_key binary, row long, n_words long, hits array<struct<fingerprint:long,windows:array<struct<start:int,length:int,digest:binary>>>>"
_HIT = pa.list_(
    pa.struct(
        [
            ("fingerprint", pa.int64()),
            ("windows", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("digest", pa.binary())]))),
        ]
    )
)


def document_hits(docs: DataFrame, filter_bits: np.ndarray, short: list[int]) -> DataFrame:
    """Per document its number of words and the fingerprints that may be in the test set, each with the windows
    around it. ``short``: lengths of the items that are shorter than a window."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_bits)
    mask = np.uint64((1 << FILTER_BITS) - 1)

    def maybe(hashes: np.ndarray) -> np.ndarray:
        low = hashes & mask
        return (shared.value[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            n = np.diff(words.rows)
            found: list[list[dict]] = [[] for _ in n]
            for length in short:
                grams = words.grams(length)
                for k in np.flatnonzero(maybe(grams)):
                    i = int(np.searchsorted(words.rows, k, side="right")) - 1
                    if k + length <= words.rows[i + 1]:
                        window = {"start": k - words.rows[i], "length": length, "digest": words.digest(k, length)}
                        found[i].append({"fingerprint": grams[k].view(np.int64), "windows": [window]})
            grams = words.grams(GRAM)
            # winnowing over the whole batch keeps all that winnowing each row keeps, and some more at the seams
            for k in (at := winnow(grams))[maybe(grams[at])]:
                i = int(np.searchsorted(words.rows, k, side="right")) - 1
                a, b = words.row(i)
                first, last = max(a, k + GRAM - WINDOW), min(k, b - WINDOW)
                windows = [{"start": s - a, "length": WINDOW, "digest": words.digest(s, WINDOW)} for s in range(first, last + 1)]
                if windows:
                    found[i].append({"fingerprint": grams[k].view(np.int64), "windows": windows})
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "text_key", "row")), pa.array(n, pa.int64()), pa.array(found, _HIT)],
                ["doc_id", "text_key", "row", "n_words", "hits"],
            )

    row = F.monotonically_increasing_id().alias("row")
    numbered = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), row, "text")
    return numbered.mapInArrow(rows, _DOC)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, text_key, n_words, n_hit, n_items, items (ids in order, as strings), contaminated."""
    windows = stored(item_windows(benchmark), "item-windows")
    marks = windows.filter("digest IS NULL").select("fingerprint", "length").distinct()
    short = [r["length"] for r in marks.filter(F.col("length") < WINDOW).select("length").distinct().collect()]
    found = stored(document_hits(docs, _filter(marks), sorted(short)), "hits")

    hits = found.filter(F.size("hits") > 0).select("row", F.explode("hits").alias("h"))
    hits = hits.select("row", "h.fingerprint", "h.windows").join(marks.select("fingerprint").distinct(), "fingerprint", "left_semi")
    around = hits.select("row", F.explode("windows").alias("w")).select("row", "w.*").distinct()
    tests = windows.filter("digest IS NOT NULL").groupBy("length", "digest").agg(F.collect_set("item_id").alias("items"))
    same = around.join(tests, ["length", "digest"])
    ends = F.array_sort(F.collect_set(F.struct("start", F.col("length").alias("n"))))
    per_row = same.groupBy("row").agg(ends.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    # covered words: each window adds what lies beyond the end of those before it
    seen = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, w: F.struct(
            F.greatest(s["end"], w["start"] + w["n"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), w["start"] + w["n"] - F.greatest(s["end"], w["start"]))).alias("n"),
        ),
        lambda s: s["n"].cast("long"),
    )
    per_row = per_row.select("row", seen.alias("n_hit"), "items")
    out = found.select("doc_id", "text_key", "row", "n_words").join(per_row, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that no benchmark window occurs in."""
    found = contamination(docs, benchmark).filter("contaminated").select("doc_id", "text_key").distinct()
    found = stored(found, "contaminated")
    out = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text_key().alias("key"))
    same = out["id"].eqNullSafe(found["doc_id"]) & (out["key"] == found["text_key"])
    return out.join(found, same, "left_anti").select("row.*")
