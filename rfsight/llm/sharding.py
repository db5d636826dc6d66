"""Sharding by balanced label propagation.

Equal texts are linked. Linked documents start in shards dealt by hash and move, round by round, to the shard that
holds most of their group: into free room, and where there is none by changing places with rows that ask the other
way, directly or around a cycle of shards. No shard goes beyond its quota. When hardly a row can move, the groups
still cut are dealt anew, whole, into the room that their rows leave. So of the groups that fit into a shard, fewer
are cut than there are shards, however many rows are linked; with enough single documents to shift, none. A group
beyond a quota fills shards of its own first, and its rest is a group like any other.

Single documents have no link to cut and fill the shards up, so row counts end at most one apart (law ``rows``).
Groups are represented by counts per shard, so a group of any size is at most one row per shard.

Defined results: a null text has size 1 and checksum 0, is equal to the empty text and to other nulls; repeated
rows and null ids are rows like any other; an empty table gives no row.
"""

from __future__ import annotations

from itertools import accumulate, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rfsight.llm.ranks import buckets_for, numbered
from rfsight.llm.scratch import drop, stored

SHARDS = 16
#: Rounds end when less than one in so many of the rows that ask may move.
STEADY = 20


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def start(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the group of each row, with a number of its own among equal rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    group = F.unhex(F.md5(text.cast("binary")))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        group.alias("group"),
    )
    return rows.withColumn("row", F.monotonically_increasing_id())


def _loads(counts: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _ahead(df: DataFrame, keys: list[str], spread: Column, order: list[str], buckets: int) -> DataFrame:
    """``df`` plus ``ahead``: the sum of ``n`` over the rows before, by buckets of the hash ``spread`` first."""
    placed = df.withColumn("bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    before = Window.unboundedPreceding
    sums = placed.groupBy(*keys, "bucket").agg(F.sum("n").alias("m"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(before, -1)
    sums = sums.withColumn("earlier", F.coalesce(F.sum("m").over(earlier), F.lit(0))).drop("m")
    inner = Window.partitionBy(*keys, "bucket").orderBy(*order).rowsBetween(before, -1)
    rows = placed.withColumn("inner", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(sums, [*keys, "bucket"])
    return rows.withColumn("ahead", F.col("earlier") + F.col("inner")).drop("bucket", "earlier", "inner")


def _shares(of: list[tuple[int, Column]]) -> Column:
    """Rows (shard, n) of the shards that get any."""
    shares = F.array(*[F.struct(F.lit(s).cast("int").alias("shard"), n.cast("long").alias("n")) for s, n in of])
    return F.inline(F.filter(shares, lambda x: x["n"] > 0))


def circulation(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the rows that ask to go from one shard to another may go, so that no shard gains more rows than it
    has room for: rows pass along cycles of shards, shortest first, and along paths that end in free room. What isn't
    granted has neither a cycle nor a path left."""
    left, room, granted = {k: n for k, n in asked.items() if n > 0}, list(room), {}

    def way(start: int, end: int) -> list[int] | None:
        """Shards from ``start`` to ``end``, or to one with room."""
        before, queue = {start: start}, [start]
        for at in queue:
            if at == end or room[at] > 0:
                path = [at]
                while path[-1] != start:
                    path.append(before[path[-1]])
                return path[::-1]
            for a, b in left:
                if a == at and b not in before:
                    before[b] = at
                    queue.append(b)
        return None

    moved = True
    while moved:
        moved = False
        for s, t in list(left):
            while (s, t) in left and (path := way(t, s)):
                edges = [(s, t), *zip(path[:-1], path[1:], strict=True)]
                k = min(left[e] for e in edges)
                if path[-1] != s:
                    k = min(k, room[path[-1]])
                    room[path[-1]] -= k
                    room[s] += k
                for e in edges:
                    granted[e] = granted.get(e, 0) + k
                    left[e] -= k
                    if not left[e]:
                        del left[e]
                moved = True
    return granted


def _changed(counts: DataFrame, change: DataFrame) -> DataFrame:
    return counts.unionByName(change).groupBy("group", "shard").agg(F.sum("n").alias("n")).filter("n > 0")


def propagate(groups: DataFrame, quota: list[int]) -> DataFrame:
    """(group, shard, n): how many rows of each group go to each shard; a stored table. ``groups`` has (group, n).

    A round: each group prefers the shard that holds most of its rows; its rows elsewhere ask to move there and move
    as far as :func:`circulation` grants, group by group in an order drawn anew. Every move makes the sum of squared
    shares larger, so the rounds come to an end.
    """
    shards = len(quota)
    buckets = buckets_for(groups.count())
    # groups of a quota and more, some two per shard at most: whole shards of their own
    own, free = [], [s for s in range(shards) if quota[s]]
    for r in groups.filter(F.col("n") >= max(1, min(quota))).orderBy(F.desc("n"), "group").collect():
        n = r["n"]
        while free and n >= quota[free[0]]:
            own.append((bytes(r["group"]), free[0], quota[free[0]]))
            n -= quota[free.pop(0)]
    filled = groups.sparkSession.createDataFrame(own, "group binary, shard int, n long")
    taken = filled.groupBy("group").agg((-F.sum("n")).alias("n"))
    rest = groups.unionByName(taken).groupBy("group").agg(F.sum("n").alias("n")).filter("n > 0") if own else groups
    # dealt in turn, so even the start keeps to the quotas
    if free:
        dealt = _ahead(rest, [], F.xxhash64("group"), ["group"], buckets)
        each, over = F.floor(F.col("n") / len(free)), F.col("n") % len(free)
        turns = [(s, each + (F.pmod(F.lit(k) - F.col("ahead"), F.lit(len(free))) < over).cast("long")) for k, s in enumerate(free)]
        rest = dealt.select("group", _shares(turns))
    else:
        rest = rest.select("group", F.lit(0).alias("shard"), "n")  # none is left
    counts = stored(rest, "shares")
    open_quota = [q if s in free else 0 for s, q in enumerate(quota)]
    room = [q - n for q, n in zip(open_quota, _loads(counts, shards), strict=True)]
    for turn in count():
        best = F.max(F.struct("n", F.xxhash64("group", "shard", F.lit(turn)).alias("tie"), "shard")).alias("best")
        wish = counts.groupBy("group").agg(best, F.count(F.lit(1)).alias("shares")).filter("shares > 1")
        asking = counts.join(wish.select("group", F.col("best.shard").alias("to")), "group").filter("shard <> `to`")
        asking = stored(asking.select("group", "shard", "to", "n"), "moves")
        pairs = asking.groupBy("shard", "to").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("m")).collect()
        asked = {(r["shard"], r["to"]): r["n"] for r in pairs}
        granted = circulation(asked, room)
        if not granted:
            drop(asking)
            break
        queue = _ahead(asking, ["shard", "to"], F.xxhash64("group", F.lit(turn)), ["group"], buckets_for(sum(r["m"] for r in pairs)))
        limits = F.array(*[F.lit(granted.get((s, t), 0)).cast("long") for s in range(shards) for t in range(shards)])
        limit = F.element_at(limits, F.col("shard") * shards + F.col("to") + 1)
        moves = queue.select("group", "shard", "to", F.least(F.col("n"), limit - F.col("ahead")).alias("k")).filter("k > 0")
        change = moves.select("group", F.inline(F.array(F.struct("shard", (-F.col("k")).alias("n")), F.struct(F.col("to").alias("shard"), F.col("k").alias("n")))))
        new = stored(_changed(counts, change), "shares")
        drop(counts, asking)
        counts = new
        for (s, t), k in granted.items():
            room[s] += k
            room[t] -= k
        if STEADY * sum(granted.values()) < sum(asked.values()):
            break
    whole = stored(_gathered(counts, open_quota).unionByName(filled), "shares")
    drop(counts)
    return whole


def _gathered(counts: DataFrame, quota: list[int]) -> DataFrame:
    """The counts with the cut groups dealt anew, one behind the other, into the room that their rows leave: each end
    of a shard's room cuts one group at most. These few move whole to wherever there is room for them."""
    shards = len(quota)
    groups = counts.groupBy("group").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("shares"), F.min("shard").alias("shard"))
    groups = stored(groups, "gathered")
    whole = groups.filter("shares = 1").select("group", "shard", "n")
    cut = groups.filter("shares > 1").select("group", "n")
    room = [q - n for q, n in zip(quota, _loads(whole, shards), strict=True)]
    ends = list(accumulate(room))
    queue = _ahead(cut, [], F.xxhash64("group"), ["group"], buckets_for(cut.count()))
    last = F.col("ahead") + F.col("n")
    parts = [(s, F.least(last, F.lit(e)) - F.greatest(F.col("ahead"), F.lit(e - r))) for s, (e, r) in enumerate(zip(ends, room, strict=True))]
    dealt = stored(queue.select("group", _shares(parts)), "dealt")
    room = [r - n for r, n in zip(room, _loads(dealt, shards), strict=True)]
    still = dealt.groupBy("group").agg(F.collect_list(F.struct("shard", "n")).alias("shares")).filter(F.size("shares") > 1).collect()
    change = []
    for r in sorted(still, key=lambda r: (-sum(x["n"] for x in r["shares"]), bytes(r["group"]))):
        here = {x["shard"]: x["n"] for x in r["shares"]}
        size = sum(here.values())
        fits = [s for s in range(shards) if room[s] + here.get(s, 0) >= size]
        if fits:
            to = min(fits, key=lambda s: (room[s] + here.get(s, 0), s))
            for s, n in [*((s, -n) for s, n in here.items()), (to, size)]:
                room[s] -= n
                change.append((bytes(r["group"]), s, n))
    change = counts.sparkSession.createDataFrame(change, "group binary, shard int, n long")
    return whole.unionByName(_changed(dealt, change))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row."""
    rows = stored(start(docs), "shard-rows")
    groups = stored(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "linked-groups")
    linked = stored(rows.join(groups, "group", "left_semi").select("group", "row"), "linked-rows")
    total = rows.count()
    counts = propagate(groups, quotas(total, shards))

    # rows of a group fill its shares in order of their numbers
    buckets = buckets_for(total)
    in_group = numbered(linked, ["group"], [F.col("row")], F.xxhash64("row"), buckets, "number")
    order = Window.partitionBy("group").orderBy(F.desc("n"), "shard")
    shares = counts.withColumn("until", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    shares = shares.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("until", "shard"))).alias("shares"))
    mine = F.filter("shares", lambda s: s["until"] > F.col("number"))[0]["shard"]
    placed = in_group.join(shares, "group").select("row", mine.alias("shard"))

    left = [q - n for q, n in zip(quotas(total, shards), _loads(counts, shards), strict=True)]
    bounds = list(accumulate(left))
    single = rows.join(groups, "group", "left_anti").select("row")
    single = numbered(single, [], [F.col("row")], F.xxhash64("row"), buckets, "number")
    ends = F.array(*[F.lit(b).cast("long") for b in bounds])
    fills = F.size(F.filter(ends, lambda b: b <= F.col("number")))
    everything = placed.unionByName(single.select("row", fills.cast("int").alias("shard")))
    everything = stored(rows.join(everything, "row"), "sharded")
    out = numbered(everything, ["shard"], [F.col("doc_id"), F.col("row")], F.xxhash64("row"), buckets, "slot")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
