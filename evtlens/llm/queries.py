"""Registered queries of the training-data operators: f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (hard_negatives, language, line_dedup, merkle, mixing, packing, periodic_runs, quality, secret_scan,
               simhash, suffix_dedup, toxicity, warc)
from .common import shared_folder, table
from .oracle import ORACLE_SQL  # noqa: F401  (registered with the queries)


def _tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf, "documents"), _tokenizer(), window=2048, end_id=1)
    return pieces.select(F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op3_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.compared(table(spark, sf, "documents"))


def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held)
    dictionaries = language.train(docs.where("doc_id is not null and not held_out"))
    return language.classify(docs, dictionaries, carry=("doc_id", "held_out")).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return quality.judged(docs, carry=["doc_id"]).drop("class_distance", "word_distance")


def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_archives(warc.resolved(table(spark, sf, "pages")), path)
    heads = warc.joined(warc.read_archives(spark, path))

    def page(column):
        return F.regexp_extract(column, r"^<urn:record:(-?[0-9]*)>$", 1)

    def number(column):
        return F.when(page(column) != "", page(column)).cast("long")

    return heads.select(number("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                        "record_type", number("refers_to").alias("refers_to"))


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf, "documents"), window=50)


def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.groups(table(spark, sf, "documents"), shingle=3, distance=3, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(docs).select(
        "doc_id", "n_lines", "n_removed_lines", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = periodic_runs.looped(table(spark, sf, "documents"))
    return periodic_runs.digests(periodic_runs.detect(docs))


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf, "embeddings"), label=label)


def op13_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, marks = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.train(docs, marks.where(~held))
    return toxicity.score(docs.withColumn("held_out", F.coalesce(held, F.lit(False))), model, carry=("doc_id", "held_out"))


REGISTRY = {f.__name__: f for f in (
    op1_mixing, op2_packing, op3_fingerprints, op4_secret_scan, op5_language, op6_quality_rules, op7_warc,
    op8_suffix_dedup, op9_simhash, op10_line_dedup, op11_periodic_runs,
    op12_hard_negatives, op13_toxicity)}
