"""Best-fit packing of token ids into sequences of a fixed length.

Bounded-space online best-fit: pieces arrive longest first, a bitset keyed by free space finds the open sequence
that they fill best, and when too many are open the fullest closes. Partitions hold a fixed number of tokens
each, so their number grows with the corpus and what a task keeps does not; each leaves one sequence part empty. The
default of ``open_bins`` is above the sequences of a partition: no sequence closes early, and the bound is a safeguard.

Pieces are dealt to partitions by a number of their own, so rows that are repeated, however often, and a text of any
length spread like others.

Defined results: a null text is an empty one, which is its end id alone; repeated rows and null ids are packed
like any other row; an empty table packs into nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rfsight.llm.arrow import slices
from rfsight.llm.encode import encoder
from rfsight.llm.scratch import stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
NUMBERED = f"{PIECES}, number long"
NUMBERED_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "number"]
#: Sequences that a partition fills, about.
SEQUENCES_PER_TASK = 4096


def cut(n_ids: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than ``most``."""
    first = n_ids % most or min(n_ids, most)
    return [(0, first), *((a, most) for a in range(first, n_ids, most))] if n_ids else []


def pieces(docs: DataFrame, tokenizer: str, most: int = 1024, end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, number) of every document; a narrow pass over the texts.

    ``number`` tells all pieces apart: the task and the place among its pieces. Store the table before it is dealt by
    the number, so that a task that runs again finds the numbers that the others have seen.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = encoder(tokenizer, end_id).encode, TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text", 2 << 20):
            ids, offsets = encode(batch.column("text"))
            out = []
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                for k, (start, length) in enumerate(cut(int(b - a), most)):
                    out.append((doc_id, k, start, length, crc32(ids[a + start : a + start + length].tobytes()), number))
                    number += 1
            columns = zip(*out, strict=True) if out else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NUMBERED_NAMES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, NUMBERED)


class Bins:
    """Open sequences by their free space. ``free`` has bit f set if one with f free places is open."""

    def __init__(self, most: int, open_bins: int) -> None:
        self.most, self.open_bins = most, open_bins
        self.free, self.stacks, self.count, self.next = 0, defaultdict(list), 0, 0

    def _take(self, space: int) -> int:
        stack = self.stacks[space]
        number = stack.pop()
        if not stack:
            self.free ^= 1 << space
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece: the open sequence with the least space that suffices, else a new one."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.count >= self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            space, number = self.most, self.next
            self.next += 1
        left = space - length
        if left:
            self.stacks[left].append(number)
            self.free |= 1 << left
            self.count += 1
        return number, self.most - space


def pack(found: DataFrame, most: int = 1024, open_bins: int = 16_384) -> DataFrame:
    """The pieces plus sequence_id and offset. Reads ``found`` twice, so give it a stored table."""
    tokens = found.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, round(tokens / (most * SEQUENCES_PER_TASK)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = Bins(most, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            places = np.array(placed, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(places[:, 0] + base), pa.array(places[:, 1])],
                [*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    dealt = found.select(*NUMBERED_NAMES).repartition(parts, "number")
    ordered = dealt.sortWithinPartitions(F.desc("length"), "number")
    return ordered.mapInArrow(rows, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, most: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(stored(pieces(docs, tokenizer, most, end_id), "pieces"), most)
