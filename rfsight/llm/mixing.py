"""Mixing sources to target weights, by Efraimidis-Spirakis sampling. DataFrame functions only.

Each source has a weight; the mix is to be a multiple of all words, shared by weight. A source that would be repeated
more often than allowed stops there, and what it leaves is shared by the others, until none is above.

A source first gives all of its documents as often as they fit whole (complete epochs). The rest of its target is a
sample without replacement: every document draws an exponential of rate ``quality``, the documents are taken in order
of these keys, and a running sum of words ends at the budget. The document at the end is taken as far as the budget
goes, so a source misses its target by rounding alone. The quality of a document is the share of its words that are
different, no less than ``LEAST_QUALITY``; any other column can be given.

Equal rows are one row with a count until the end. Keys are cut into buckets in their own order; running sums are
made within (source, bucket), and those of the buckets before come from a small table, so a source with a third of
all rows is many partitions. The draw is a digest of id and text: runs agree, however the input is dealt.

Defined results: a null text has no words and is taken 0 times; null is a source of its own, the last one, and the
empty string another, the first; repeated rows are rows like any other; an empty table gives no rows, and a source
without words the target 0.
"""

from __future__ import annotations

from math import inf

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rfsight.llm.ranks import buckets_for
from rfsight.llm.scratch import drop, stored

#: Weights of sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a multiple of all words, and how often a source may be repeated.
SHARE, MOST = 1.5, 2
LEAST_QUALITY = 0.25
#: Copies of one row that a task writes out.
COPIES = 10_000
_BLANK = r"[\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), _BLANK), lambda w: w != "")


def distinct_share(own: Column) -> Column:
    """Share of different words, at least ``LEAST_QUALITY``; 1 where there are none."""
    share = F.size(F.array_distinct(own)) / F.greatest(F.size(own), F.lit(1))
    return F.when(F.size(own) == 0, 1.0).otherwise(F.greatest(share, F.lit(LEAST_QUALITY)))


def exponential(rate: str = "quality") -> Column:
    """Key of a row: an exponential variable of the given rate, drawn by a digest of id and text."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest")), 1, 12), 16, 10)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 48))) / F.col(rate)


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` plus ``place``: 0, 1, ... by code point, null last. Sorted by ranges, numbered within each."""
    at = F.monotonically_increasing_id()
    placed = stored(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", at), "ranges")
    part = F.shiftright("at", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per task of the sort
    starts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part", part).join(starts, "part").withColumn("place", place).drop("part", "start", "at")


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (source, source_size) plus ``target``: words that each gives to the mix.

    A round shares what the full sources leave; the level (words per weight) only rises and the rounds end when no
    source is newly full. A round is one aggregate of three numbers.
    """
    by_place = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    out = stored(ranked(sources).withColumn("weight", by_place), "sources")
    full = F.col("source_size") * most
    level, before = 0.0, -1.0
    while level > before:
        here = full <= F.col("weight") * F.lit(level)
        row = out.agg(
            F.sum("source_size").alias("words"), F.sum(F.when(here, full)).alias("full"), F.sum(F.when(~here, F.col("weight"))).alias("weight")
        ).first()
        before, total = level, min(share, most) * (row["words"] or 0)
        level = (total - (row["full"] or 0)) / row["weight"] if row["weight"] else inf
    return out.withColumn("target", F.least(full.cast("double"), F.col("weight") * F.lit(level)))


def mix(docs: DataFrame, quality: Column | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target and ``taken`` of each row of ``docs``."""
    # names of this module come first, whatever else the table has
    own = docs.select(
        F.col("doc_id"), F.col("source"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("digest"),
        words().alias("words"), *([quality.cast("double").alias("quality")] if quality is not None else []),
    )
    rate = F.col("quality") if quality is not None else distinct_share(F.col("words"))
    own = own.select("doc_id", "source", "digest", F.size("words").cast("long").alias("size"), rate.alias("quality"))
    rows = stored(own.groupBy(*own.columns).agg(F.count(F.lit(1)).alias("copies")), "mix-rows")
    totals = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    targets = with_targets(stored(totals, "source-sizes"), weights, share, most)
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    targets = targets.select(F.col("source").alias("of"), "source_size", "target", epochs.alias("epochs"), (budget - epochs * F.col("source_size")).alias("rest"))

    n = rows.agg(F.count(F.lit(1))).first()[0]
    key = exponential()
    bucket = F.floor(F.lit(2 * buckets_for(n)) * F.col("key") / (F.col("key") + 1)).cast("int")
    keyed = rows.withColumn("key", key).withColumn("bucket", bucket).withColumn("mass", F.col("size") * F.col("copies"))
    group = ["source", "bucket"]
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = keyed.groupBy(*group).agg(F.sum("mass").alias("sum"))
    sums = sums.select(F.col("source").alias("in_source"), F.col("bucket").alias("in_bucket"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy(*group).orderBy("key", "doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    summed = keyed.withColumn("before", F.coalesce(F.sum("mass").over(within), F.lit(0)))
    summed = summed.join(sums, F.col("source").eqNullSafe(F.col("in_source")) & (F.col("bucket") == F.col("in_bucket")))
    summed = summed.join(targets, F.col("source").eqNullSafe(F.col("of")))
    left = F.greatest(F.lit(0), F.col("rest") - F.col("start") - F.col("before"))
    groups = summed.select("doc_id", "source", "size", "source_size", "target", "epochs", "copies", left.alias("left"))
    groups = stored(groups, "mix-groups")

    def single(df: DataFrame, first: Column) -> DataFrame:
        """Rows of their own: of equal rows, one after the other has its share of what is left."""
        last = F.least(first + COPIES, F.col("copies")) - 1
        df = df.withColumn("copy", F.explode(F.sequence(first, last)))
        part = F.least(F.col("size"), F.greatest(F.lit(0), F.col("left") - F.col("copy") * F.col("size")))
        taken = (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")
        return df.select("doc_id", "source", "size", "source_size", "target", taken)

    few = groups.filter(F.col("copies") <= COPIES)
    many = groups.filter(F.col("copies") > COPIES)
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("chunk")
    many = many.select("*", chunks).repartition("doc_id", "chunk")
    drop(rows)
    return single(few, F.lit(0).cast("long")).unionByName(single(many, F.col("chunk")))
