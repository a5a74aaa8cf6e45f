"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet below the shared folder and reads back as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evtlens.llm import line_dedup, mixing, packing, quality, simhash
from evtlens.llm.common import DOC_COLUMNS, table, written
from evtlens.llm.queries import _tokenizer
from evtlens.session import ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far from every language reference go."""
    ship_package(spark)
    return quality.judged(docs.select(DOC_COLUMNS)).where("kept").select(DOC_COLUMNS)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out of the texts."""
    ship_package(spark)
    text = F.col("kept_text")
    return line_dedup.deduplicated(docs.select(DOC_COLUMNS)).withColumns(
        {"text": text, "n_chars": F.when(F.col("n_removed_lines") > 0, F.char_length(text).cast("long"))
         .otherwise(F.col("n_chars"))}).select(DOC_COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship_package(spark)
    return simhash.keep_one(docs.select(DOC_COLUMNS), shingle=3, distance=3)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time the mix takes a document."""
    ship_package(spark)
    return mixing.repeated(mixing.mix(docs.select(DOC_COLUMNS))).select(DOC_COLUMNS)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    ship_package(spark)
    pieces = packing.packed(docs.select("doc_id", "text"), _tokenizer(), window=2048, end_id=1)
    return pieces.select(F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", source_mixing),
    ("packing", sequence_packing),
]

#: SQL can't express the SimHash and tokenizing stages; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
