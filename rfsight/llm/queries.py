"""Queries of the operators over the whole tables, with reference SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rfsight.llm import (
    contamination,
    conversations,
    licenses,
    mixing,
    ngram_join,
    packing,
    quality,
    reference,
    sharding,
    spelling,
    spotsigs,
    suffix_dedup,
    token_index,
    warc,
)
from rfsight.llm.scratch import new_folder, stored
from rfsight.llm.ship import ship

TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(ship(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query("op1_quality_knn")
def _(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality.classify(docs.select("doc_id", "text"), labels).select("doc_id", "held_out", "score", "predicted")


@query("op7_token_index")
def _(spark, sf_dir):
    folder = new_folder(spark, "token-shards")
    token_index.write_shards(table(spark, sf_dir, "documents"), folder, tokenizer_file())
    return token_index.documents(token_index.read_shards(spark, folder))


@query("op10_best_fit_packing")
def _(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


@query("op3_winnowing", reference.WINNOWING)
def _(spark, sf_dir):
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query("op8_arc_to_warc", reference.ARC_TO_WARC)
def _(spark, sf_dir):
    arc, archive = new_folder(spark, "arc"), new_folder(spark, "warc")
    warc.write_arc(table(spark, sf_dir, "pages"), arc)
    warc.convert(spark, arc, archive)
    found = stored(warc.read_warc(spark, archive).withColumn("page_id", warc.page_key()).drop("head"), "records")
    of = found.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("page"))
    shown = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    plain = found.filter("record_type = 'response'").select(*shown, F.lit(None).cast("long").alias("refers_to"))
    again = found.filter("record_type = 'revisit'").join(of, "refers_to", "left")
    return plain.unionByName(again.select(*shown, F.col("page").alias("refers_to")))


@query("op9_suffix_dedup", reference.SUFFIX_DEDUP)
def _(spark, sf_dir):
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_ngram_join", reference.NGRAM_JOIN)
def _(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


@query("op4_label_propagation")
def _(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op5_spotsigs")
def _(spark, sf_dir):
    found = spotsigs.fingerprints(table(spark, sf_dir, "documents"))
    own, edited, after = (F.col(c) for c in ("signatures", "edited_signatures", "next_signatures"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.as_text(own).alias("fingerprint"), spotsigs.as_text(edited).alias("edited_fingerprint"),
        spotsigs.likeness(own, edited).alias("near_edited"), spotsigs.likeness(own, after).alias("near_next"),
    )


@query("op6_license_scan")
def _(spark, sf_dir):
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("licenses", F.array_join("licenses", ","))


@query("op11_source_mix", reference.SOURCE_MIX)
def _(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op12_conversation_repair")
def _(spark, sf_dir):
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


@query("op13_spelling_variants")
def _(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))
