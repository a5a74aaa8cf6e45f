"""E1-E5 on Structured Streaming.

* E1/E2: ``with_event_time`` = cast to TIMESTAMP (``withWatermark`` rejects NTZ) +
  ``withWatermark(ts, bound)``; ascending extractors use a 0 s bound.
* E3: allowed lateness = watermark delay of bound + lateness with ``update`` output;
  the newest row per key wins in the sink (:func:`evtlens.streaming.sinks.keyed_upsert`).
* E4: ``split_late`` routes, inside ``foreachBatch``, the rows that every window
  holding them has already closed for (against the watermark the batch ran with;
  :func:`evtlens.streaming.sinks.late_writer` keeps it).
* E5: a bounded source in Spark does not end with a maximal watermark, so the last
  windows / timers stay open. A far-future sentinel row in a last micro-batch closes
  them and ``drop_sentinel`` removes what it produced.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evtlens.functions.time import duration_us
from evtlens.operators.windows import pane_start

SENTINEL_TS = _dt.datetime(2099, 1, 1)


def with_event_time(df: DataFrame, ts: str = "ts", bound="0 seconds") -> DataFrame:
    us = duration_us(bound)
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{us // 1000} milliseconds")


def drop_sentinel(df: DataFrame, end_ms_col: str = "window_end", cut=SENTINEL_TS) -> DataFrame:
    cut_ms = int(cut.replace(tzinfo=_dt.timezone.utc).timestamp() * 1000)
    return df.where(F.col(end_ms_col) <= F.lit(cut_ms))


def split_late(batch: DataFrame, watermark_us: int | None, ts: str = "ts", size="10 minutes",
               slide="5 seconds", lateness="1 minute") -> tuple[DataFrame, DataFrame]:
    """(on_time, late) split of one micro-batch: a row is late when the last window
    holding it ended (minus 1 ms) plus the allowed lateness is at or before the
    watermark (microseconds)."""
    if watermark_us is None:
        return batch, batch.limit(0)
    S, L, late = duration_us(size), duration_us(slide), duration_us(lateness)
    last_end = pane_start(ts, L) + F.lit(S)
    is_late = last_end - F.lit(1000) + F.lit(late) <= F.lit(watermark_us)
    return batch.where(~is_late), batch.where(is_late)
