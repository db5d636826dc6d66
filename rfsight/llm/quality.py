"""Nearest-neighbour quality classifier over latent-semantic vectors.

A bounded sample of labelled rows spans a latent space; its vectors are broadcast, and every document is scored
by the exact cosines to all of them, in blocks. Scoring is a narrow pass over the corpus: no shuffle.

Defined results: a null or empty text, and one of any length, has a vector like any other; equal texts have equal
scores; with no labelled row at all every score is 0.5. Labels of one document that disagree count as the higher.
Rows are kept as they come, repeated rows and null ids included.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rfsight.llm.arrow import BYTE_VALUES, prefix_sums, slice_hashes, slices, utf8, word_bounds

#: Terms: hashed letter trigrams, trigrams of byte classes, and measures of repetition.
LETTERS, CLASSES, REPEATS = 512, 512, 8
WIDTH = LETTERS + CLASSES + REPEATS
#: Weight of each kind of term in the vector of a document.
BLOCK_WEIGHTS = (0.5, 1.0, 1.0)


def _byte_classes() -> np.ndarray:
    classes = np.full(256, 6, np.uint16)
    classes[ord("a") : ord("z") + 1] = 0
    classes[ord("A") : ord("Z") + 1] = 1
    classes[ord("0") : ord("9") + 1] = 2
    classes[ord(" ")] = 3
    classes[[9, 10, 11, 12, 13]] = 4
    classes[[ord("."), ord(",")]] = 5
    classes[128:] = 7
    return classes


BYTE_CLASS = _byte_classes()
IS_WORD = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.arange(256, dtype=np.uint32)
LOWER[ord("A") : ord("Z") + 1] += 32


def _share(same: np.ndarray) -> float:
    return float(same.mean()) if len(same) else 0.0


def _repetition(words: np.ndarray, lines: np.ndarray) -> list[float]:
    """Shares of words, pairs and triples of words that recur within the last eight; of lines that recur."""
    pairs = words[1:] * np.uint64(3) + words[:-1]
    triples = pairs[1:] * np.uint64(5) + words[:-2]
    shares = []
    for grams in (words, pairs, triples):
        seen = np.zeros(len(grams), bool)
        for lag in range(1, 9):
            seen[lag:] |= grams[lag:] == grams[:-lag]
        shares += [_share(seen), _share(grams[1:] == grams[:-1])]
    return [*shares, 1 - len(np.unique(lines)) / max(1, len(lines)), 1.0]


def features(texts: pa.Array) -> np.ndarray:
    """A row of WIDTH term weights per text; each kind of term has length one. A null is an empty text."""
    data, offsets = utf8(texts)
    out = np.zeros((len(offsets) - 1, WIDTH), np.float32)
    lower, kind = LOWER[data], BYTE_CLASS[data]
    codes = (lower[:-2] << 16 | lower[1:-1] << 8 | lower[2:]) * np.uint32(2654435761) >> np.uint32(23)
    shapes = kind[:-2] << 6 | kind[1:-1] << 3 | kind[2:]
    starts, stops, rows = word_bounds(data, offsets, IS_WORD)
    sums = prefix_sums(BYTE_VALUES[lower])
    words = slice_hashes(sums, starts, stops)
    l_starts, l_stops, l_rows = word_bounds(data, offsets, np.arange(256) != 10)
    lines = slice_hashes(sums, l_starts, l_stops)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        if b - a >= 3:
            out[i, :LETTERS] = np.log1p(np.bincount(codes[a : b - 2], minlength=LETTERS))
            out[i, LETTERS : LETTERS + CLASSES] = np.sqrt(np.bincount(shapes[a : b - 2], minlength=CLASSES))
        own = words[rows[i] : rows[i + 1]]
        out[i, LETTERS + CLASSES :] = _repetition(own, lines[l_rows[i] : l_rows[i + 1]])
    edges = (0, LETTERS, LETTERS + CLASSES, WIDTH)
    for a, b, weight in zip(edges[:-1], edges[1:], BLOCK_WEIGHTS, strict=True):
        if b < WIDTH:
            out[:, a:b] /= np.maximum(np.linalg.norm(out[:, a:b], axis=1, keepdims=True), 1e-9)
        out[:, a:b] *= weight
    return out


@dataclass(frozen=True)
class Model:
    """What the tasks get: weights and axes of the terms, and the labelled vectors. Its size is bounded by
    the sample bound and the number of axes, whatever the corpus."""

    weights: np.ndarray
    axes: np.ndarray
    points: np.ndarray
    labels: np.ndarray


def fit_arrays(terms: np.ndarray, labels: np.ndarray, axes: int = 64) -> Model:
    """Latent axes of the labelled rows: leading right singular vectors of their weighted terms."""
    found = (terms > 0).sum(axis=0)
    weights = np.log1p(len(terms) / (1.0 + found)).astype(np.float32)
    weights[LETTERS + CLASSES :] = 1
    scaled = terms * weights
    values, columns = np.linalg.eigh((scaled.T @ scaled).astype(np.float64))
    top = np.ascontiguousarray(columns[:, np.argsort(values)[::-1][:axes]], dtype=np.float32)
    return Model(weights, top, _unit(scaled @ top), labels.astype(np.float32))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def vectors(terms: np.ndarray, model: Model) -> np.ndarray:
    return _unit((terms * model.weights) @ model.axes)


def vote(points: np.ndarray, model: Model, k: int, block: int = 512) -> np.ndarray:
    out = np.empty(len(points))
    k = min(k, len(model.points))
    for a in range(0, len(points), block):
        cosines = points[a : a + block] @ model.points.T
        near = np.argpartition(cosines, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6).astype(np.float64) ** 8
        out[a : a + block] = (weight * model.labels[near]).sum(axis=1) / weight.sum(axis=1)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """(doc_id, digest, text, quality) of at most ``max_labelled`` different texts of labelled documents, drawn by hash.

    The bound is that of the fit alone; it also bounds the broadcast sides of the joins. Ids are drawn first. Repeated
    rows count once; where the drawn ids have several texts, each keeps one before any has a second.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    drawn = known.agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = rows.withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    keys = rows.select("doc_id", "digest").distinct()
    first = keys.groupBy("doc_id").agg(F.min("digest").alias("first"))
    keys = keys.join(F.broadcast(first), "doc_id").orderBy(F.col("digest") != F.col("first"), F.xxhash64("doc_id", "digest"), "doc_id", "digest")
    kept = F.broadcast(keys.select("doc_id", "digest").limit(max_labelled))
    return rows.join(kept, ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"]).select("doc_id", "digest", "text", "quality")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 4096, axes: int = 64) -> Model:
    """Latent space and labelled vectors; the driver receives ``max_labelled`` rows of WIDTH numbers at most."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = features(batch.column("text"))
            packed = pa.array([row.tobytes() for row in rows], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), batch.column("quality").cast(pa.float64()), packed],
                ["doc_id", "digest", "quality", "terms"],
            )

    rows = training_rows(docs, labels, max_labelled)
    rows = rows.mapInArrow(terms, "doc_id long, digest string, quality double, terms binary").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("digest", "ascending")])
    found = np.frombuffer(b"".join(rows["terms"].to_pylist()), np.float32).reshape(-1, WIDTH)
    return fit_arrays(found, rows["quality"].to_numpy(), axes)


def quality_score(docs: DataFrame, model: Model, text: str = "text", neighbours: int = 11) -> Column:
    """Score of a text column of ``docs``, 0 to 1: the share of similar labelled vectors that are of quality 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model, out = shared.value, [np.zeros(0)]
        for part in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text"):
            if len(model.points):
                out.append(vote(vectors(features(part.column("text")), model), model, neighbours))
            else:
                out.append(np.full(part.num_rows, 0.5))
        return pa.array(np.concatenate(out))

    return score(F.col(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """Fold of a document: true for those whose labels are never learned from. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def classify(docs: DataFrame, labels: DataFrame, max_labelled: int = 4096, neighbours: int = 11) -> DataFrame:
    """All columns of ``docs`` plus held_out, score and predicted (which replace columns of these names)."""
    model = fit(docs, labels.filter(~held_out()), max_labelled)
    scored = docs.withColumn("held_out", held_out()).withColumn("score", quality_score(docs, model, "text", neighbours))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, max_labelled: int = 4096, neighbours: int = 11) -> DataFrame:
    """The rows of ``docs``, all columns, that score 0.5 or more."""
    model = fit(docs, labels.filter(~held_out()), max_labelled)
    return docs.filter(quality_score(docs, model, "text", neighbours) >= 0.5)
