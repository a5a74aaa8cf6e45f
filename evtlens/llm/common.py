"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evtlens.session import scratch_path

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed
#: and carriage return (the fixed definition of every contract of this subpackage).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder name below the session's ``spark.checkpoint.dir``."""
    return scratch_path(spark, f"llm-{tag}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder and read it back.

    A later job that loses an executor rereads the files instead of recomputing."""
    path = shared_folder(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of whole texts: fewer rows than Spark's default, unless the session has
    a setting of its own; their bytes are bounded by ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB unless set). The
    setting stays, as it is read when the result is computed, after the operator has returned."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, str(rows))
