"""Distinct visitors as state that can be stored and merged.

* Sketches (HyperLogLog): one per pane and key, a few kilobytes at most; their union is the sketch of the union, so
  panes make up windows of any length and micro-batches add to stored windows.
* Bitmaps: one bit per hashed visitor, kept as rows (window_end, bucket, bits) of 32,768 bits each, merged by OR. A
  window's rows are spread over tasks by bucket, whatever its size.
"""

from __future__ import annotations

from math import ceil, log2
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evtlens.functions.hashing import poly_hash
from evtlens.functions.time import duration_us
from evtlens.operators.windows import pane_start, window_ends


def sketch_size(rsd: float) -> int:
    """log2 of the registers that give a relative standard error of ``rsd`` (4 to 21)."""
    return min(max(ceil(2 * log2(1.04 / rsd)), 4), 21)


def _end_ms(ts: str, size) -> F.Column:
    S = duration_us(size)
    return ((pane_start(ts, S) + F.lit(S)) / 1000).cast("bigint")


def pane_sketches(df: DataFrame, value: str = "user_id", pane="5 minutes", keys: Sequence[str] = (), rsd: float = 0.01,
                  ts: str = "ts") -> DataFrame:
    """(keys..., pane_end ms, sketch): the distinct values of each pane. Partial sketches are merged
    before the shuffle, so a busy pane ships one per task."""
    return df.groupBy(*keys, _end_ms(ts, pane).alias("pane_end")).agg(F.hll_sketch_agg(value, sketch_size(rsd)).alias("sketch"))


def merge_sketches(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.hll_union_agg("sketch", False).alias("sketch"))


def windows_of_sketches(panes: DataFrame, size="1 hour", slide=None, pane="5 minutes", keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., window_end, cnt): the estimates of tumbling or sliding windows from pane sketches; size and
    slide are multiples of the pane."""
    P, S, L = duration_us(pane), duration_us(size), duration_us(slide or size)
    if S % L or L % P:
        raise ValueError("size must be a multiple of slide, and slide of the pane")
    start = F.timestamp_micros(F.col("pane_end") * 1000 - P)
    ends = F.transform(window_ends("_ts", size, slide or size), lambda e: (e / 1000).cast("bigint"))
    each = panes.withColumn("_ts", start).select(*keys, F.explode(ends).alias("window_end"), "sketch")
    return merge_sketches(each, [*keys, "window_end"]).select(
        *keys, "window_end", F.hll_sketch_estimate("sketch").cast("bigint").alias("cnt"))


def visitor_bitmaps(df: DataFrame, size="1 hour", seed: int = 61, bits: int = 29, ts: str = "ts") -> DataFrame:
    """(window_end, bucket, bits): the single-hash bitmap of each tumbling window, cut into buckets.
    Visitors are made distinct per window first, so the hash runs once for each."""
    seen = df.select(_end_ms(ts, size).alias("window_end"), "user_id").distinct().withColumn("bit", poly_hash("user_id", seed, bits))
    return (seen.groupBy("window_end", F.expr("bitmap_bucket_number(bit)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")))


def merge_bitmaps(rows: DataFrame) -> DataFrame:
    return rows.groupBy("window_end", "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))


def count_bitmaps(rows: DataFrame) -> DataFrame:
    """(window_end, cnt) of merged bitmaps."""
    return rows.groupBy("window_end").agg(F.sum(F.expr("bitmap_count(bits)")).cast("bigint").alias("cnt"))
