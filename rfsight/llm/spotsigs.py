"""SpotSigs document fingerprints, with column functions only.

A spot is a common word; its signature is the chain of the next two content words, whatever common words stand
between. Common words are frequent in prose and rare in navigation, tables and code, so signatures follow the prose.
The fingerprint is the set of a text's signatures as sorted 32-bit hashes. Sets are compared by Jaccard likeness;
where only likenesses from some bound on are wanted, sets are partitioned by length, partitions further apart are
never compared, and sets must share one of their rarest signatures.

Defined results: a text without a spot, the empty and the null text among them, has one signature made of its content
words; equal texts have equal fingerprints. Documents are ordered by descending id, null ids last, equal
ids by descending digest of their texts; repeated rows have one place in this order and equal results; a document
alone is its own successor.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rfsight.llm.scratch import stored

#: Common words of English, French, German and Spanish that open a chain.
ANCHORS = (
    "a an and are at for in is of the to was with "
    "de des du en est et la le les par pour un une "
    "das der die ein eine ist mit und von zu "
    "con del el es las los para por que y"
).split()
#: A run of anchors. All of them open the same chain, so a run becomes one mark, which no normalised word holds.
RUN = "(?: (?:" + "|".join(map(re.escape, ANCHORS)) + ")(?= ))++"
MARK = " #"
#: A mark; ahead of it two content words, with a mark between them or not. No more than two words are looked at.
SPOT = f"{MARK}(?= ([^ #]++(?:{MARK})?+ [^ #]++) )"


def normalised(text: Column) -> Column:
    """Words in lower case, a blank before and behind each."""
    words = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^0-9a-z\x{80}-\x{10FFFF}]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def _hashed(text: Column) -> Column:
    return F.shiftright(F.xxhash64(text), 32).cast("int")


def signatures(text: Column) -> Column:
    """Sorted distinct hashes of the chains of a text. Linear in the text, also where common words run on."""

    def of(marked: Column) -> Column:
        # the text itself stands behind its chains, for when there are none
        chains = F.concat(F.regexp_extract_all(marked, F.lit(SPOT), F.lit(1)), F.array(marked))
        return F.transform(chains, lambda c: _hashed(F.replace(c, F.lit(MARK), F.lit(""))))

    def kept(hashes: Column) -> Column:
        return F.sort_array(F.array_distinct(F.slice(hashes, 1, F.greatest(F.lit(1), F.size(hashes) - 1))))

    return _bound(_bound(F.regexp_replace(normalised(text), RUN, MARK), of), kept)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it uses it."""
    return F.transform(F.array(value), body)[0]


def as_text(found: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits per signature."""
    return F.array_join(F.transform(found, lambda h: F.right(F.concat(F.lit("0000000"), F.hex(h)), F.lit(8))), "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two sets; 0 where sizes alone keep it below ``least``."""
    common = F.size(F.array_intersect(a, b))
    exact = common / (F.size(a) + F.size(b) - common)
    fits = F.least(F.size(a), F.size(b)) >= least * F.greatest(F.size(a), F.size(b))
    return F.when(fits, exact).otherwise(F.lit(0.0))


def _id_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))


def successors(docs: DataFrame) -> DataFrame:
    """(id_key, digest, next_id_key, next_digest, n_chars): each document and the next by descending id.

    Ids are range-partitioned and numbered by partition; only the first row of each partition, a table with a row
    per partition, is seen by the partition before it.
    """
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    n_chars = F.length(F.coalesce("text", F.lit("")))
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _id_key().alias("id_key"), digest.alias("digest"), n_chars.alias("n_chars"))
    order = [F.desc_nulls_last("doc_id"), F.desc("digest")]
    ranged = stored(keys.distinct().repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ordered-ids")
    key = F.struct("id_key", "digest")
    rows = ranged.withColumn("next", F.lead(key).over(Window.partitionBy("part").orderBy(*order)))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    firsts = ranged.withColumn("place", place).filter("place = 1").select("part", key.alias("first"))
    parts = Window.orderBy("part")
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("part", F.coalesce(F.lead("first").over(parts), F.first("first").over(whole)).alias("after"))
    rows = rows.join(firsts, "part").withColumn("next", F.coalesce("next", "after"))
    return rows.select("id_key", "digest", F.col("next.id_key").alias("next_id_key"), F.col("next.digest").alias("next_digest"), "n_chars")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited (text), signatures, edited_signatures and next_signatures of each row.

    The edited text has the last third of the text replaced by the first as many characters of the next document.
    Texts are shuffled once, by document; as heads they go to the document before theirs. Both joins ask for the
    same columns, so that one exchange serves them; doc_id comes back from its key.
    """
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    text = F.coalesce("text", F.lit("")).alias("text")
    prints = docs.select(_id_key().alias("id_key"), digest.alias("digest"), text, signatures(F.col("text")).alias("signatures"))
    after = stored(successors(docs), "successors")
    wanted = after.select(
        F.col("next_id_key").alias("id_key"), F.col("next_digest").alias("digest"), F.col("id_key").alias("to_id_key"),
        F.col("digest").alias("to_digest"), F.floor(F.col("n_chars") / 3).cast("int").alias("n"),
    )
    heads = prints.join(wanted, ["id_key", "digest"]).select(
        F.col("to_id_key").alias("id_key"), F.col("to_digest").alias("digest"), "n",
        F.substring("text", F.lit(1), F.col("n")).alias("head"), F.col("signatures").alias("next_signatures"),
    )
    heads = heads.dropDuplicates(["id_key", "digest"])
    n_chars = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - F.col("n")), "head")
    rows = prints.join(heads, ["id_key", "digest"]).withColumn("edited", edited)
    doc_id = F.expr("CAST(nullif(id_key, '') AS long)").alias("doc_id")
    rows = rows.select(doc_id, n_chars.cast("long").alias("n_chars"), "edited", "signatures", "next_signatures")
    return rows.withColumn("edited_signatures", signatures(F.col("edited")))


def similar(docs: DataFrame, least: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): doc_id and class of each row, a class for each fingerprint; pairs of classes of a likeness
    of ``least`` and more: a, b, likeness.

    Sets are partitioned by length, so that a set meets its own partition and the one below. Candidates share one of
    the rarest signatures of both: the shorter the prefix, the higher ``least``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), signatures(F.col("text")).alias("found"))
    rows = stored(rows.withColumn("class", F.unhex(F.md5(as_text(F.col("found")).cast("binary")))), "fingerprints")
    sets = rows.select("class", "found").dropDuplicates(["class"])
    spread = sets.select(F.explode("found").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    of_set = sets.select("class", F.explode("found").alias("s")).join(spread, "s").groupBy("class").agg(F.sort_array(F.collect_list(F.struct("n", "s"))).alias("ranked"))
    size = F.size("ranked")
    part = F.floor(F.log(size.cast("double")) / log(1 / least) + 1e-9).cast("int")
    prefix = F.slice("ranked", 1, size - F.ceil(size * least - 1e-9).cast("int") + 1)
    index = of_set.select("class", part.alias("part"), F.explode(prefix).alias("x")).select("class", "part", "x.s")
    own = index.select(F.col("class").alias("a"), F.col("part").alias("at"), F.col("part"), "s")
    below = F.explode(F.array("part", F.col("part") - 1)).alias("at")
    met = index.select(F.col("class").alias("b"), "part", "s").select("b", F.col("part").alias("part_b"), "s", below)
    pairs = own.join(met, ["at", "s"]).filter("part_b > part OR (part_b = part AND a < b)").select("a", "b").distinct()
    pairs = pairs.join(sets.select(F.col("class").alias("a"), F.col("found").alias("x")), "a").join(sets.select(F.col("class").alias("b"), F.col("found").alias("y")), "b")
    pairs = pairs.select("a", "b", likeness(F.col("x"), F.col("y"), least).alias("likeness"))
    return rows.select("doc_id", "class"), pairs.filter(F.col("likeness") >= least)
