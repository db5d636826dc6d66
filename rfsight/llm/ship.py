"""Makes this package importable in Python workers, wherever the driver runs."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Hand the package to Spark's own file distribution, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp(prefix="rfsight-code-")
        archive = shutil.make_archive(f"{folder}/rfsight_code", "zip", root, "rfsight")
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark
