"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from rfsight.sources.tables import remove, scratch_layout

_ROOTS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table: written once, then read. This cuts the lineage, survives lost executors and
    gives true sizes to the planner. The table goes with :func:`drop`, or when the driver ends."""
    root = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(root)
    out = df.sparkSession.read.schema(df.schema).parquet(root)
    _ROOTS[out] = root
    return out


def new_folder(spark: SparkSession, label: str) -> str:
    """An unused shared folder for files that an operator writes itself."""
    return scratch_layout(spark, label).root


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        if root := _ROOTS.pop(df, None):
            remove(df.sparkSession, root)
