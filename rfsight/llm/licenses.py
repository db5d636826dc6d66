"""License scans, with column functions only.

Templates and overlapping windows of texts are sets of word five-grams. Windows of twice a template's size, rounded
up to a power of two, step by half their length, so every passage of a template's size lies whole in one of them.
MinHash bands of one row each retrieve templates: a window that contains 0.75 of a template's shingles is at least
0.17 like it, so 48 bands miss it once in 8,000 times. What is retrieved is verified by exact containment. Windows
that share no shingle with any template cannot contain one, and are left out before any MinHash; this loses nothing.

Defined results: a null, empty or short text matches nothing; a template of fewer than five words is an error;
repeated rows and null ids are scanned like any other row.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rfsight.llm.scratch import stored

WORDS, BANDS, LEAST = 5, 48, 0.75

#: Short public notices by which works are licensed.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or (at your option) any later version"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
]


def plain_words(text: str) -> list[str]:
    return [w for w in re.split("[^0-9a-z]+", text.lower()) if w]


def words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^0-9a-z]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though a lambda inside uses it for every element."""
    return F.transform(F.array(value), body)[0]


def shingles(of: Column) -> Column:
    """64-bit hash of each run of five words, in order."""

    def hashes(w: Column) -> Column:
        n = F.size(w) - WORDS + 1
        starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(WORDS)]))

    return bound(of, hashes)


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, license, own, size class) with ``own`` the distinct shingles; as many rows as templates."""
    if short := [t for _, t in templates if len(plain_words(t)) < WORDS]:
        raise ValueError(f"templates of fewer than {WORDS} words: {short}")
    rows = [(k, name, text) for k, (name, text) in enumerate(templates)]
    table = spark.createDataFrame(rows, "template int, license string, text string")
    table = table.withColumn("words", words(F.col("text"))).withColumn("own", F.array_distinct(shingles(F.col("words"))))
    half = F.pow(F.lit(2), F.ceil(F.log2(F.size("own").cast("double")) - 1e-9)).cast("int")
    return table.select("template", "license", "own", half.alias("half"))


def bands(of: Column) -> Column:
    """Least hash of a set under each of the hash functions, tagged with its number."""

    def least(k: int) -> Column:
        return F.array_min(F.transform(of, lambda h: F.xxhash64(h, F.lit(k))))

    return F.array(*[F.struct(F.lit(k).alias("band"), least(k).alias("value")) for k in range(BANDS)])


def windows_near(half: int, own: list[int]) -> Column:
    """Windows of twice ``half`` shingles of the column ``all`` that have one of ``own``."""
    starts = F.sequence(F.lit(0), F.size("all") - 1, F.lit(half))
    window = F.transform(starts, lambda s: F.array_distinct(F.slice("all", s + 1, 2 * half)))
    near = F.filter(window, lambda w: F.arrays_overlap(w, F.array(*[F.lit(h) for h in own])))
    return F.transform(near, lambda w: F.struct(F.lit(half).alias("half"), w.alias("window")))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, n_licenses, licenses (sorted) and containment (of the best match, 0 if none) of each row."""
    spark = docs.sparkSession
    known = template_table(spark, TEMPLATES if templates is None else templates)
    listed = known.collect()  # one row per template
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("doc_id", shingles(words(F.col("text"))).alias("all"))
    vocabulary = sorted({h for r in listed for h in r["own"]})
    marked = F.arrays_overlap("all", F.array(*[F.lit(h) for h in vocabulary]))
    rows = rows.select("doc_id", F.when(marked, F.col("all")).alias("all")).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "license-shingles")

    hits = rows.filter("all IS NOT NULL")
    halves = sorted({r["half"] for r in listed})
    windows = [windows_near(half, sorted({h for r in listed if r["half"] == half for h in r["own"]})) for half in halves]
    found = hits.select("row", F.inline(F.concat(*windows))).withColumn("number", F.monotonically_increasing_id())
    found = stored(found, "license-windows")

    signed = found.select("number", "half", F.inline(bands(F.col("window"))))
    offered = known.select("template", "half", F.inline(bands(F.col("own"))))
    met = signed.join(offered, ["half", "band", "value"]).select("number", "template").distinct()
    checked = met.join(found, "number").join(known.drop("half"), "template")
    share = F.size(F.array_intersect("own", "window")) / F.size("own")
    checked = checked.select("row", "license", share.alias("share")).filter(F.col("share") >= LEAST)
    per_row = checked.groupBy("row").agg(F.array_sort(F.collect_set("license")).alias("licenses"), F.max("share").alias("containment"))
    out = rows.select("doc_id", "row").join(per_row, "row", "left")
    licenses = F.coalesce("licenses", F.array().cast("array<string>"))
    return out.select("doc_id", F.size(licenses).cast("long").alias("n_licenses"), licenses.alias("licenses"), F.coalesce("containment", F.lit(0.0)).alias("containment"))
