"""Exact row numbers of large groups without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that one task numbers, about.
ROWS_PER_BUCKET = 50_000


def buckets_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_BUCKET))


def numbered(df: DataFrame, group: list[str], order: list[Column], spread: Column, buckets: int, name: str) -> DataFrame:
    """``df`` plus ``name``: 0, 1, ... within each ``group``, by buckets of the hash ``spread`` first.

    Rows are numbered within (group, bucket); the sums of the buckets before, a small table, are added.
    """
    placed = df.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*group, "_bucket").orderBy(*order)
    rows = placed.withColumn("_within", F.row_number().over(within) - 1)
    keys = [*group, "_bucket"]
    out = rows.join(starts, keys) if group or buckets > 1 else rows.join(F.broadcast(starts), keys)
    return out.withColumn(name, F.col("_start") + F.col("_within")).drop("_bucket", "_start", "_within")
