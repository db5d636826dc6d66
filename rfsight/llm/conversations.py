"""Repair of conversation structure, by bidirectional Dijkstra over the edit lattice.

A repaired conversation has roles ``(s?(ua)+)?`` by their initials: perhaps a system turn, then user and assistant in
turn. A node of the lattice is (rows used up, state of that pattern); an edge is an edit of the next row, or an insert.
One heap runs forward from the first node, one backward from the ends. Where they meet, the search goes on until no
crossing of equal cost can be missed; of all crossings the least concatenated audit is taken.

Rows of a conversation are streamed in order. After every ``BLOCK`` rows the cheapest way into each of the four states
is kept (cost, audit and the running digest of the repaired text), so a long conversation needs no more memory than a
block and its audit. Costs follow from the letters, and an insert is never free, so of two ways of one cost into one
node neither audit begins with the other: the least one stays the least, whatever comes after. The digest is one over
all rows in order, so rows of one conversation pass one task; what is known without order (the first row of each role
and text) is counted by key before.

Defined results: rows are taken by turn, nulls first, rows of one turn by role and digest of the text; a null role or
text is one space; a null conv_id is a conversation; an empty role has no initial, so keeping it changes no state; rows
marked absent only make their conversation appear; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rfsight.llm.arrow import give_back

#: Rows between two points at which the ways into all states are compared.
BLOCK = 64
# --- fixed values: costs of edits, of what is left truncated, and the pattern ----------------------
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Next state by state and initial: 0 nothing yet, 1 after the system turn, 2 after a user, 3 after an assistant.
STEPS = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ENDS = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
# ---------------------------------------------------------------------------------------------------

_SPACE = r"[\x20\x09-\x0D]"
_FULL_STOPS = "[.!?]"


# ---- faults and damage ------------------------------------------------------------------------


def is_blank(text: str | Column) -> Column:
    return ~F.rlike(text, F.lit(r"[^\x20\x09-\x0D]"))


def is_truncated(text: str | Column) -> Column:
    return ~F.rlike(text, F.lit(rf"{_FULL_STOPS}{_SPACE}*\z"))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``present`` of the rows after damage by a checksum of conversation and turn.

    Of twenty: 0 drops the row (it stays as absent), 1 empties its text, 2 takes its full stops away, 3 repeats it,
    4 makes it the user's.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind < 2, "").when(kind == 2, F.regexp_replace(text, _FULL_STOPS, "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


# ---- edit lattice -----------------------------------------------------------------------------

#: A row as the lattice sees it: initial, whether it must go, whether it is truncated.
Row = tuple[str, bool, bool]
Label = tuple[int, str]


def _edges(rows: list[Row], i: int, state: int) -> list[tuple[int, int, int, str]]:
    """(rows used, state, cost, letter) of the edits at a node."""
    out = [(i, to, INSERT, "I") for initial, to in STEPS[state].items() if initial != "s"]
    if i < len(rows):
        initial, must_go, truncated = rows[i]
        out.append((i + 1, state, DELETE, "D"))
        if not must_go:
            more = TRUNCATED * truncated
            if not initial or initial in STEPS[state]:
                out.append((i + 1, STEPS[state][initial] if initial else state, KEEP + more, "K"))
            out += [(i + 1, to, REROLE + more, "R") for other, to in STEPS[state].items() if other != "s"]
    return out


def cheapest(rows: list[Row], start: int, ends: tuple[int, ...]) -> Label | None:
    """(cost, audit) of the cheapest edits that lead from a state to one of ``ends``, the least audit of several."""
    n = len(rows)
    out_edges = {(i, s): _edges(rows, i, s) for i in range(n + 1) for s in range(4)}
    in_edges: dict[tuple[int, int], list[tuple[int, int, int, str]]] = {node: [] for node in out_edges}
    for (i, s), edges in out_edges.items():
        for to, state, cost, letter in edges:
            in_edges[to, state].append((i, s, cost, letter))
    # within one cost, nodes in the order of free edges: labels are final when they leave the heap
    sides = [
        ({(0, start): (0, "")}, {}, [(0, 0, (0, start))], out_edges, 1),
        ({(n, s): (0, "") for s in ends}, {}, [(0, -n, (n, s)) for s in ends], in_edges, -1),
    ]
    least = inf
    while True:
        tops = []
        for labels, done, heap, _, _ in sides:
            while heap and (heap[0][2] in done or labels[heap[0][2]][0] < heap[0][0]):
                heappop(heap)
            tops.append(heap[0][0] if heap else inf)
        if tops[0] + tops[1] > least or min(tops) == inf:
            break
        side = 0 if tops[0] <= tops[1] else 1
        labels, done, heap, edges, way = sides[side]
        others = sides[1 - side][1]
        cost, _, node = heappop(heap)
        done[node] = labels[node]
        if node in others:
            least = min(least, cost + others[node][0])
        audit = labels[node][1]
        for i, state, more, letter in edges[node]:
            to = (i, state)
            if to in others:
                least = min(least, cost + more + others[to][0])
            if to in done:
                continue
            label = (cost + more, audit + letter if way == 1 else letter + audit)
            if to not in labels or label < labels[to]:
                if to not in labels or label[0] < labels[to][0]:
                    heappush(heap, (label[0], way * i, to))
                labels[to] = label
    if least == inf:
        return None
    forward, backward = sides[0][1], sides[1][1]
    audits = [label[1] + backward[node][1] for node, label in forward.items() if node in backward and label[0] + backward[node][0] == least]
    for node, (cost, audit) in forward.items():
        for i, state, more, letter in out_edges[node]:
            if (i, state) in backward and cost + more + backward[i, state][0] == least:
                audits.append(audit + letter + backward[i, state][1])
    return int(least), min(audits)


class Ways:
    """The cheapest way into each state: cost, audit, and digest of the repaired rows so far."""

    def __init__(self) -> None:
        self.held = {0: (0, "", hashlib.sha256(), True)}

    def take(self, rows: list[tuple[str, str, bool, bool]], last: bool) -> None:
        """Go on over a block of (role, text, must go, truncated)."""
        lattice = [(role[:1], must_go, truncated) for role, _, must_go, truncated in rows]
        found: dict[int, tuple[int, str, int, str]] = {}
        for start, (cost, audit, _, _) in self.held.items():
            for ends in [ENDS] if last else [(s,) for s in range(4)]:
                if (more := cheapest(lattice, start, ends)) is not None:
                    label = (cost + more[0], audit + more[1], start, more[1])
                    found[ends[0]] = min(found.get(ends[0], label), label)
        before = self.held
        self.held = {
            end: (cost, audit, *self._written(rows, start, letters, *before[start][2:]))
            for end, (cost, audit, start, letters) in found.items()
        }

    @staticmethod
    def _written(rows: list[tuple[str, str, bool, bool]], state: int, letters: str, digest, first: bool):
        """Digest and whether nothing is written yet, after the edits that ``letters`` stand for."""
        digest, left = digest.copy(), iter(rows)
        for letter in letters:
            role, text = "", ""
            if letter != "I":
                role, text, *_ = next(left)
            if letter == "D":
                continue
            if letter == "K":
                state = STEPS[state][role[:1]] if role else state
            else:  # the pattern leaves one of user and assistant
                (initial,) = (c for c in STEPS[state] if c != "s")
                role, state = NAMES[initial], STEPS[state][initial]
            digest.update(f"{'' if first else '\n'}{role}:{text}".encode())
            first = False
        return digest, first

    def end(self) -> tuple[int, str, str]:
        cost, audit, digest, _ = min((self.held[s] for s in ENDS if s in self.held), key=lambda x: x[:2])
        return cost, audit, digest.hexdigest()


# ---- distributed ------------------------------------------------------------------------------

_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_RESULT = f"conv_id long, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string"
_SCHEMA = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
_LEGAL = {"su", "ua", "au"}


class _Conversation:
    """Counts and repair of one conversation, row by row."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.ways, self.block, self.counts = conv_id, Ways(), [], dict.fromkeys(_COUNTS, 0)
        self.low = self.high = self.initial = self.before = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, digest: bytes, blank: bool, repeats: bool, truncated: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        # copies within a turn stand side by side
        repeats = repeats or self.before == (turn, digest)
        self.before = (turn, digest)
        fault = "blank" if blank else "duplicate" if repeats else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.counts["illegal"] += 1
        self.initial = role[:1]
        if len(self.block) == BLOCK:
            self.ways.take(self.block, last=False)
            self.block = []
        self.block.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))

    def result(self) -> tuple:
        self.ways.take(self.block, last=True)
        self.counts["cost"], audit, digest = self.ways.end()
        if self.turns:
            self.counts["gaps"] = self.high - self.low + 1 - self.turns
        return (self.conv_id, *self.counts.values(), audit, digest)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows in order of conversations: a row for each."""

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [[]] * len(_SCHEMA)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)

    now, key = None, None
    for batch in batches:
        found = []
        for k, conv_id, present, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != key or now is None:
                if now is not None:
                    found.append(now.result())
                now, key = _Conversation(conv_id), k
            if present:
                now.add(*row)
        yield batch_of(found)
    yield batch_of([now.result()] if now is not None else [])
    give_back()


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the repaired text of each conversation. ``rows`` are conv_id, turn, role,
    text and ``present``."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    own = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        F.col("conv_id").cast("long").alias("conv_id"), "present", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
    )
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    own = own.withColumn("digest", digest).withColumn("at", F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    first = own.filter("present").groupBy("key", "digest").agg(F.min("at").alias("first"))
    told = own.join(first, ["key", "digest"], "left").select(
        "key", "conv_id", "present", "turn", "role", "text", "digest", is_blank("text").alias("blank"),
        F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("repeats"), is_truncated("text").alias("truncated"),
    )
    order = ["key", F.col("turn").asc_nulls_first(), "role", "digest"]
    return told.repartition("key").sortWithinPartitions(*order).mapInArrow(_repaired, _RESULT)
