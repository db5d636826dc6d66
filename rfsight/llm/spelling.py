"""Spelling variants: words one edit apart, by pivotal grams.

Words are counted over whole texts, combined on the map side. A word's grams are its bigrams with their places, in
order of how many words have them, rare ones first. Its prefix are the first three (and all that tie with the third);
its pivots are two of them that do not overlap, chosen by dynamic programming for the least total frequency. One edit
spoils one pivot at most. Of two words within one edit, take the one whose prefix ends first: its unspoilt pivot is a
gram of the other word, and within the other's prefix. So pivots are looked up among prefixes, and no pair is missed.

Position limits: the edit lies wholly before or wholly behind the unspoilt pivot. So the words agree either in all that
stands before the pivot, and its place, or in all that stands behind it, and its distance from the end. The pivot
with that side, and a few letters of the other side that one edit can't touch at both ends, are the key of the join.
This leaves few candidates; an exact distance verifies them.

Each word follows its much more frequent neighbour; such steps go up in frequency by the factor at least, so a chain
is short, and pointers are doubled along it.

Defined results: null and empty texts have no words; repeated rows count again; a null doc_id is the empty string in
the checksum; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import blake2b
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rfsight.llm.arrow import give_back
from rfsight.llm.scratch import drop, stored

#: Least length and count of a word, and how much more frequent a form must be.
LENGTH, COUNT, FACTOR = 6, 5, 5
#: One run in so many loses a code point.
DAMAGE = 199
RUN = "[A-Za-zÀ-ÿ]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GRAM, EDITS = 2, 1
#: Lengths of the rest for which 0, 1, ... of its letters are in the key: at least twice as many, and any two lengths
#: that one edit makes of each other have one in common.
RESTS = [(0, 2), (2, 5), (5, 8), (8, inf)]
#: Letters that stand in a key as they are.
SPELT = 32


# ---- words ------------------------------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n: runs of letters, A-Z in lower case, one code point of some of them deleted."""
    run = F.explode(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(RUN), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run)
    # the fast way wherever it gives the same
    plain = F.lower("run")
    runs = runs.withColumn("run", F.when(F.rlike("run", F.lit("[À-Þ]")), F.translate("run", _UPPER, _UPPER.lower())).otherwise(plain))
    mark = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", mark.alias("mark"))
    at = (F.col("mark") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("mark") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= COUNT)


# ---- pivotal grams ----------------------------------------------------------------------------


def prefix_grams(word: str, often: dict[str, int]) -> list[tuple[str, int]]:
    """(gram, place) of the rarest grams, as many as two edits could spoil and one more, with all ties of the last."""
    grams = sorted((often[word[i : i + GRAM]], word[i : i + GRAM], i) for i in range(len(word) - GRAM + 1))
    last = grams[min(GRAM * EDITS, len(grams) - 1)][:2]
    return [(gram, place) for n, gram, place in grams if (n, gram) <= last]


def pivots(prefix: list[tuple[str, int]], often: dict[str, int]) -> list[tuple[str, int]]:
    """EDITS + 1 grams of a prefix that do not overlap, of the least total frequency, by dynamic programming over
    their places: the best choice of k grams up to each place."""
    grams = sorted(prefix, key=lambda g: g[1])
    places = [place for _, place in grams]
    best: list[list[tuple[int, list[tuple[str, int]]] | None]] = [[(0, [])] + [None] * (EDITS + 1)]
    for j, (gram, place) in enumerate(grams):
        free = bisect_right(places, place - GRAM)  # grams that end before this one
        row = list(best[j])
        for k in range(1, EDITS + 2):
            if (before := best[free][k - 1]) is not None:
                chosen = (before[0] + often[gram], [*before[1], (gram, place)])
                row[k] = chosen if row[k] is None else min(row[k], chosen)
        best.append(row)
    return best[-1][EDITS + 1][1]


def _beginnings(text: str, lengths: list[int]) -> dict[int, str]:
    """The first so many letters, for each length; beyond ``SPELT`` a digest of them, all in one pass."""
    digest, done, out = blake2b(digest_size=8), 0, {}
    for length in sorted(lengths):
        if length <= SPELT:
            out[length] = text[:length]
        else:
            digest.update(text[done:length].encode())
            out[length], done = digest.hexdigest(), length
    return out


def keys(word: str, prefix: list[tuple[str, int]]) -> list[tuple[str, tuple[str, int]]]:
    """(join key, gram): the gram with all that stands before it, or with all behind it, and a few letters of the
    rest. The one edit is in the rest, so its first letters agree or its last ones do, where it is long enough."""
    n, out = len(word), []
    ahead = _beginnings(word, [at + GRAM for _, at in prefix])
    behind = _beginnings(word[::-1], [n - at for _, at in prefix])
    for g in prefix:
        at, end = g[1], g[1] + GRAM
        for side, low, high in ((f"<{ahead[end]}", end, n), (f">{behind[n - at]}", 0, at)):
            for letters, (least, most) in enumerate(RESTS):
                if least <= high - low <= most:
                    if letters:
                        out.append((f"{side}^{word[low : low + letters]}", g))
                    out.append((f"{side}${word[high - letters : high]}", g))
    return out


_INDEX = "word string, n long, key string, pivot boolean"


def _indexed(rows: list[tuple[str, int, list]]) -> pa.RecordBatch:
    out = []
    for word, n, grams in rows:
        often = {g["gram"]: g["often"] for g in grams}
        prefix = prefix_grams(word, often)
        chosen = set(pivots(prefix, often))
        out += [(word, n, key, gram in chosen) for key, gram in keys(word, prefix)]
    columns = zip(*out, strict=True) if out else [[]] * 4
    kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n", "key", "pivot"])


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _indexed(list(zip(*(c.to_pylist() for c in batch.columns), strict=True)))
    give_back()


def index(words: DataFrame) -> DataFrame:
    """Rows of word, n, key and whether it is a pivot's, for the grams of each prefix."""
    place = F.explode(F.sequence(F.lit(1), F.length("word") - GRAM + 1))
    grams = words.select("word", "n", place.alias("at")).withColumn("gram", F.substring("word", F.col("at"), F.lit(GRAM)))
    often = grams.groupBy("gram").agg(F.count_distinct("word").alias("often"))
    told = grams.join(often, "gram").groupBy("word", "n").agg(F.collect_set(F.struct("gram", "often")).alias("grams"))
    return told.mapInArrow(_index_rows, _INDEX)


# ---- neighbours and forms ---------------------------------------------------------------------


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other, other_n), both ways round: words that one edit makes of each other."""
    rows = stored(index(words), "gram-index")
    piv = rows.filter("pivot").select(F.col("word").alias("a"), F.col("n").alias("a_n"), "key")
    pre = rows.select(F.col("word").alias("b"), F.col("n").alias("b_n"), "key")
    fits = (F.col("a") != F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= EDITS)
    met = piv.join(pre, "key").filter(fits & (F.levenshtein("a", "b", EDITS) == EDITS))
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )
    return met.select(F.inline(both)).distinct()


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word."""
    words = stored(word_counts(docs), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("other")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    told = words.join(near, "word", "left")
    enough = -F.col("best.rank") >= F.col("n") * FACTOR
    told = told.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.rank")).alias("form_n"),
    )
    told = stored(told, "forms")
    steps = stored(told.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "steps")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        farther = stored(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
        drop(steps)
        steps = farther.drop("moved")
        if farther.filter("moved").isEmpty():
            break
    roots = told.join(steps, "word", "left")
    return roots.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
