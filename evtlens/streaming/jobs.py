"""Streaming counterparts of the reference jobs (readStream -> operators -> sink).

Windowed aggregates run in append mode behind a watermark; rankings, upserts and
side outputs are finished in ``foreachBatch`` with the batch operators, so every
micro-batch is planned by Catalyst like a batch query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evtlens.functions.hashing import poly_hash
from evtlens.functions.predicates import has_tx, is_behavior, is_method, not_behavior, not_static_asset
from evtlens.functions.time import duration_us
from evtlens.streaming.eventtime import with_event_time


def _window(ts: str, size, slide=None):
    S = duration_us(size)
    L = duration_us(slide or size)
    return F.window(F.col(ts), f"{S} microseconds", f"{L} microseconds")


def windowed_counts(df: DataFrame, keys, size, slide=None, ts: str = "ts",
                    end_col: str = "window_end") -> DataFrame:
    """(keys..., window_end ms, cnt) in append mode; needs a watermark on ``ts``."""
    return (df.groupBy(_window(ts, size, slide).alias("_w"), *keys)
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(*keys, F.unix_millis(F.col("_w.end")).alias(end_col), "cnt"))


def item_view_count_stream(ub: DataFrame, size="1 hour", slide="5 minutes", bound="0 seconds") -> DataFrame:
    """A1 stream; feed it to ``sinks.topn_writer`` for T1. Each row opens size / slide windows;
    :func:`item_view_pane_stream` does not."""
    pv = with_event_time(ub, "ts", bound).where(is_behavior("pv"))
    return windowed_counts(pv, ["item_id"], size, slide)


def item_view_pane_stream(ub: DataFrame, size="1 hour", slide="5 minutes", bound="0 seconds") -> DataFrame:
    """A1 stream on panes: one state row per (item, pane), kept until the watermark has passed the pane's last
    window. Run it in update mode into ``sinks.pane_topn_writer`` for T1. A row whose pane is still kept counts in
    all of its windows."""
    delay = duration_us(bound) + duration_us(size) - duration_us(slide)
    return pane_count_stream(ub.where(is_behavior("pv")), ["item_id"], slide, bound=f"{delay} microseconds")


def page_view_count_stream(logs: DataFrame, size="10 minutes", slide="5 seconds", bound="1 second",
                           lateness="0 seconds") -> DataFrame:
    """A3 stream; with ``lateness`` > 0 run it in update mode (E3) into
    ``sinks.topn_writer`` so a late row re-ranks its window (T3). Each row opens
    size / slide windows; :func:`page_view_pane_stream` does not."""
    delay = duration_us(bound) + duration_us(lateness)
    hits = with_event_time(logs, "ts", f"{delay} microseconds").where(is_method("GET") & not_static_asset("url"))
    return windowed_counts(hits, ["url"], size, slide)


def page_view_pane_stream(logs: DataFrame, slide="5 seconds", bound="1 second", lateness="1 minute") -> DataFrame:
    """A3 stream, stage 1 on panes: one state row per (url, pane). A row is counted while
    the watermark (delayed by bound + lateness) has not closed its pane. Feed it to
    :func:`sliding_rollup_writer`."""
    delay = duration_us(bound) + duration_us(lateness)
    hits = logs.where(is_method("GET") & not_static_asset("url"))
    return pane_count_stream(hits, ["url"], slide, bound=f"{delay} microseconds")


def pv_salted_stream(ub: DataFrame, size="1 hour", bound="0 seconds", salts: int = 16) -> DataFrame:
    """A5 stream: counts per (window, salt), then per window (chained aggregations, append
    mode), so that one busy window is spread over ``salts`` state rows."""
    pv = with_event_time(ub, "ts", bound).where(is_behavior("pv"))
    salt = F.pmod(F.xxhash64("user_id", "ts"), F.lit(salts)).alias("_salt")
    part = pv.groupBy(_window("ts", size).alias("_w"), salt).agg(F.count(F.lit(1)).alias("_n"))
    return (part.groupBy("_w").agg(F.sum("_n").alias("cnt"))
            .select(F.lit("pv").alias("url"), F.unix_millis(F.col("_w.end")).alias("window_end"), "cnt"))


def pv_stream(ub: DataFrame, size="1 hour", bound="0 seconds") -> DataFrame:
    """A4 stream."""
    pv = with_event_time(ub, "ts", bound).where(is_behavior("pv"))
    return windowed_counts(pv, [], size).select(F.lit("pv").alias("url"), "window_end", "cnt")


def uv_stream(ub: DataFrame, size="1 hour", bound="0 seconds", bitmap: bool = False) -> DataFrame:
    """A6 (or A7 with ``bitmap``) stream: dedup (window, user) then count per window
    (chained aggregation in append mode; streaming count_distinct is not supported)."""
    pv = with_event_time(ub, "ts", bound).where(is_behavior("pv"))
    ident = poly_hash("user_id") if bitmap else F.col("user_id")
    per_user = pv.groupBy(_window("ts", size).alias("_w"), ident.alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    return (per_user.groupBy(F.col("_w")).agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.lit("uv").alias("url"), F.unix_millis(F.col("_w.end")).alias("window_end"), "cnt"))


def visitors_stream(ub: DataFrame, bound="0 seconds") -> DataFrame:
    """A7, A8 stream: the page views, behind a watermark. Feed it to ``store.upsert`` with the sketches or
    bitmaps of :mod:`evtlens.operators.distinct` as rows, merged over the batches."""
    return with_event_time(ub, "ts", bound).where(is_behavior("pv"))


def marketing_pane_stream(mk: DataFrame, slide="5 seconds", bound="0 seconds",
                          keys=("channel", "behavior")) -> DataFrame:
    """A10/A11 stream (A11: ``keys=()``), stage 1 on panes; feed it to
    :func:`sliding_rollup_writer`."""
    return pane_count_stream(mk.where(not_behavior("UNINSTALL")), list(keys), slide, bound=bound)


def province_ad_count_stream(clicks: DataFrame, cap: int = 100, period="1 day", zone_offset="+08:00",
                             size="1 hour", slide="5 minutes", bound="0 seconds") -> DataFrame:
    """D1 then A12 as one stream: the clicks that pass the cap, counted per province in
    sliding windows (append mode)."""
    from evtlens.streaming import stateful
    passed = stateful.click_cap_stream(with_event_time(clicks, "ts", bound), cap, period, zone_offset)
    return windowed_counts(passed.where("route = 'main'"), ["province"], size, slide)


def tx_match_stream(pays: DataFrame, receipts: DataFrame, lower="-3 seconds", upper="5 seconds",
                    how: str = "inner", bound="0 seconds") -> DataFrame:
    """J1 (``inner``) / J2 (``full_outer`` + route) as a stream-stream join. Both sides
    carry a watermark; the range condition bounds the join state, and for the outer
    form Spark emits the unmatched side once the watermark passes its interval."""
    lo, hi = duration_us(lower), duration_us(upper)
    p = with_event_time(pays.where(has_tx("tx_id")), "ts", bound).select(
        F.col("tx_id").alias("p_tx"), "order_id", F.col("ts").alias("pay_ts"))
    r = with_event_time(receipts, "ts", bound).select(
        F.col("tx_id").alias("r_tx"), "pay_channel", F.col("ts").alias("receipt_ts"))
    cond = ((F.col("p_tx") == F.col("r_tx"))
            & (F.col("receipt_ts") >= F.col("pay_ts") + F.expr(f"INTERVAL {lo} MICROSECONDS"))
            & (F.col("receipt_ts") <= F.col("pay_ts") + F.expr(f"INTERVAL {hi} MICROSECONDS")))
    j = p.join(r, cond, how)
    out = j.select(F.coalesce("p_tx", "r_tx").alias("tx_id"), "order_id",
                   F.unix_millis("pay_ts").alias("pay_time"), "pay_channel",
                   F.unix_millis("receipt_ts").alias("receipt_time"))
    if how == "inner":
        return out
    return out.withColumn("route", F.when(F.col("pay_time").isNull(), "unmatched-receipts")
                          .when(F.col("receipt_time").isNull(), "unmatched-pays").otherwise("matched"))


def pane_count_stream(df: DataFrame, keys, slide="5 seconds", ts: str = "ts", bound="0 seconds") -> DataFrame:
    """W4/W5 stream, stage 1: tumbling pane counts in append mode (state = open panes
    only). Feed it to :func:`sliding_rollup_writer`."""
    L = duration_us(slide)
    rows = with_event_time(df, ts, bound)
    return (rows.groupBy(_window(ts, f"{L} microseconds").alias("_w"), *keys)
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(*keys, F.unix_micros(F.col("_w.start")).alias("_p"), "cnt"))


def sliding_rollup_writer(path: str, keys, size="1 hour", slide="5 seconds"):
    """W4/W5 stream, stage 2 (``foreachBatch``): append the closed panes to a pane table
    and emit every window end that became final - all ends up to the newest closed
    pane end (append mode has emitted every pane below the watermark) - with the
    runs plan over just the panes those windows need. Output goes to
    ``path/windows/batch=<id>`` (idempotent per batch). A window is emitted once a
    later pane has closed; to flush a bounded input send two sentinel rows in later
    micro-batches (the second closes the first one's pane) and drop the windows at
    the sentinel with :func:`evtlens.streaming.eventtime.drop_sentinel`."""
    from evtlens.operators.windows import runs_from_panes
    from evtlens.streaming.store import DAY_MS, DayStore, KeyedStore

    keys = list(keys)
    S, L = duration_us(size), duration_us(slide)
    marks = KeyedStore(f"{path}/marks", ["k"], {"p": F.max})
    pane_store = DayStore(f"{path}/panes", "_end", lambda rows: rows.drop("batch"))       # a pane comes once

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("_end", F.floor((F.col("_p") + L) / 1000)).persist()
        try:
            roll_up(batch, batch_id)
        finally:
            batch.unpersist()

    def roll_up(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        days = [r[0] for r in batch.select(F.floor(F.col("_end") / DAY_MS).cast("long")).distinct().collect()]
        pane_store.write(batch, batch_id, days)
        span = batch.agg(F.min("_p").alias("lo"), F.max("_p").alias("hi")).first()
        if span["hi"] is None:
            return
        known = marks.read(spark, "k int, p long", before=batch_id)
        prev = None if known is None else known.first()["p"]
        now_end = max(span["hi"], prev if prev is not None else span["hi"]) + L
        lo = -(1 << 62) if prev is None else prev + L
        if now_end > lo:
            # only the days of the panes that the windows in (lo, now_end] reach
            first = span["lo"] if prev is None else min(span["lo"], lo - S)
            days = range((first + L) // 1000 // DAY_MS, now_end // 1000 // DAY_MS + 1)
            panes = pane_store.read(spark, days, batch_id + 1, batch.schema)
            need = panes.where((F.col("_p") >= F.lit(lo - S)) & (F.col("_p") < F.lit(now_end)))
            need = need.groupBy(*keys, "_p").agg(F.sum("cnt").alias("cnt"))
            out = runs_from_panes(need, S, L, keys, ["cnt"], "cnt", end_range=(lo, now_end))
            out.write.mode("overwrite").parquet(f"{path}/windows/batch={batch_id}")
        marks.write(spark.createDataFrame([(0, now_end - L)], "k int, p long"), batch_id)
    return run


def cep_order_stream(events: DataFrame, within="15 minutes", bound="0 seconds") -> DataFrame:
    """C5 + C6 stream: creates left-outer-joined with pays of the same order in
    [create, create + within) (a stream-stream self join; the range bounds the join
    state). A match is 'payed' (route 'main'); a create still unmatched when the
    watermark passes its interval is emitted by Spark with a NULL pay and becomes
    'timeout <create + within ms>' (route 'order-timeout'). Several pays of one create
    are reduced to one result per create (first pay, like ``followedBy``)."""
    w = duration_us(within)
    ev = with_event_time(events, "ts", bound)
    c = ev.where(F.col("event_type") == "create").select(F.col("order_id").alias("c_oid"),
                                                         F.col("ts").alias("c_ts"))
    p = ev.where(F.col("event_type") == "pay").select(F.col("order_id").alias("p_oid"),
                                                      F.col("ts").alias("p_ts"))
    cond = ((F.col("c_oid") == F.col("p_oid")) & (F.col("p_ts") >= F.col("c_ts"))
            & (F.col("p_ts") < F.col("c_ts") + F.expr(f"INTERVAL {w} MICROSECONDS")))
    # keep one event-time column (the create's) so the per-create dedup is allowed
    j = (c.join(p, cond, "left_outer")
         .select("c_oid", "c_ts", F.unix_micros("p_ts").alias("p_us"))
         .dropDuplicatesWithinWatermark(["c_oid", "c_ts"]))
    payed = F.col("p_us").isNotNull()
    return j.select(
        F.col("c_oid").alias("order_id"),
        F.when(payed, F.lit("payed")).otherwise(F.concat(
            F.lit("timeout "), (F.unix_millis("c_ts") + F.lit(w // 1000)).cast("string"))).alias("result_state"),
        F.when(payed, F.lit("main")).otherwise(F.lit("order-timeout")).alias("route"))


def uv_running_stream(ub: DataFrame, size="1 hour", bound="0 seconds") -> DataFrame:
    """W8/A9 stream: run in ``update`` mode - every micro-batch emits the new running uv
    of each window it touched. Exact, on the bitmap's bits: first sightings of a (window,
    bit) pass a deduplication whose state the watermark frees with the window, and are
    counted. Feed it to ``sinks.keyed_upsert(path, ["window_end"])``."""
    pv = with_event_time(ub, "ts", bound).where(is_behavior("pv"))
    first = (pv.select(_window("ts", size).alias("_w"), poly_hash("user_id").alias("_bit"))
             .dropDuplicates(["_w", "_bit"]))
    return (first.groupBy("_w").agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.lit("uv").alias("url"), F.unix_millis(F.col("_w.end")).alias("window_end"), "cnt"))


def uv_first_seen_stream(ub: DataFrame, size="1 hour", bound="0 seconds") -> DataFrame:
    """A9/W8 stream, stage 1: each (window, bit) once, with the time it was first seen, in
    event-time order over the micro-batches -> (window_end, bit, ts). Feed it to
    ``store.numbered(path, "window_end", ["ts", "bit"])``, which gives every row its running uv."""
    from evtlens.streaming import stateful
    S = duration_us(size)
    pv = with_event_time(ub, "ts", bound).where(is_behavior("pv")).withColumn("bit", poly_hash("user_id"))
    return stateful.first_seen_stream(pv.select((F.floor(F.unix_micros("ts") / S) * (S // 1000) + S // 1000).alias("window_end"), "bit", "ts"))


def pv_in_order_stream(ub: DataFrame, size="1 hour", bound="0 seconds", salts: int = 1024) -> DataFrame:
    """W8 stream on every element, stage 1: the page views in event-time order over the micro-batches
    -> (window_end, seq, ts), for ``store.numbered(path, "window_end", ["ts", "seq"])``. Rows are spread over ``salts`` keys."""
    from evtlens.streaming import stateful
    S = duration_us(size)
    pv = with_event_time(ub, "ts", bound).where(is_behavior("pv"))
    return stateful.in_order_stream(pv.select((F.floor(F.unix_micros("ts") / S) * (S // 1000) + S // 1000).alias("window_end"),
                                              F.pmod(F.xxhash64("seq"), F.lit(salts)).cast("int").alias("salt"), "seq", "ts"))
