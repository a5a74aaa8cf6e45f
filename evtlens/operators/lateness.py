"""E4 / E1 in batch: rows in order of arrival, the watermark each of them meets, and the late ones.

The watermark at a row is the newest event time among all rows that arrived before it, less the
bound: a running maximum over the whole table. It is taken on two levels: inside buckets of arrival
time (a window over one bucket), and over the buckets' maxima (a row per bucket), so no task sees more
than a bucket's rows or the table of buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evtlens.functions.time import duration_us, epoch_us
from evtlens.operators.sequence import running_max
from evtlens.operators.windows import pane_start


def with_watermark_column(df: DataFrame, arrival: str, tie: str, ts: str = "ts", bound="1 second", bucket="10 minutes",
                          out: str = "watermark_us") -> DataFrame:
    """Add the watermark (us) that each row meets on arrival: null for the first row. ``arrival`` (us) and
    ``tie`` order the rows; rows with a null time move nothing."""
    df = df.withColumn("_u", epoch_us(ts))
    seen = running_max(df, [], [arrival, tie], "_u", "_seen", F.floor(F.col(arrival) / duration_us(bucket)), exclusive=True)
    return seen.withColumn(out, F.col("_seen") - F.lit(duration_us(bound))).drop("_u", "_seen")


def late_split(df: DataFrame, arrival: str, tie: str, ts: str = "ts", bound="1 second", size="10 minutes", slide="5 seconds",
               lateness="1 minute", bucket="10 minutes") -> DataFrame:
    """Add ``is_late``: the last window that holds the row ended (less 1 ms), with the allowed lateness
    added, at or before the watermark that the row meets."""
    S, L, late = duration_us(size), duration_us(slide), duration_us(lateness)
    x = with_watermark_column(df, arrival, tie, ts, bound, bucket, "_wm")
    closed = pane_start(ts, L) + F.lit(S - 1000 + late) <= F.col("_wm")
    return x.withColumn("is_late", F.coalesce(closed, F.lit(False))).drop("_wm")
