"""The windowed counters of the reference jobs.

Every reference UDAF is a plain counter; Catalyst's partial + final HashAggregate is
the incremental create/add/merge/getResult pair, so no custom aggregate is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evtlens.functions.hashing import poly_hash
from evtlens.functions.predicates import is_behavior, is_method, not_behavior, not_static_asset
from evtlens.operators.sequence import running_count
from evtlens.functions.time import duration_us
from evtlens.operators.distinct import pane_sketches, windows_of_sketches
from evtlens.operators.rank import top_n_segments
from evtlens.operators.windows import COUNT, count_segments, pane_start, sliding_agg, tumbling_agg


def item_view_count(ub: DataFrame, size="1 hour", slide="5 minutes", behavior="pv",
                    plan="auto") -> DataFrame:
    """A1: pv per item per sliding window -> (item_id, window_end, cnt)."""
    return sliding_agg(ub.where(is_behavior(behavior)), "ts", size, slide, ["item_id"], COUNT,
                       plan=plan)


def item_view_count_sql(spark, ub: DataFrame, size="1 hour", slide="5 minutes",
                        view="data_table") -> DataFrame:
    """A2: the same aggregate in Spark SQL; ``count(item_id)`` skips NULL items like the
    SQL original."""
    ub.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT item_id, unix_millis(window(ts, '{size}', '{slide}').end) AS window_end,
               CAST(count(item_id) AS BIGINT) AS cnt
        FROM {view} WHERE behavior = 'pv'
        GROUP BY item_id, window(ts, '{size}', '{slide}')""")


def page_view_count(logs: DataFrame, size="10 minutes", slide="5 seconds", plan="auto") -> DataFrame:
    """A3: GET requests for non-static urls per url per sliding window -> (url, window_end, cnt)."""
    hits = logs.where(is_method("GET") & not_static_asset("url"))
    return sliding_agg(hits, "ts", size, slide, ["url"], COUNT, plan=plan)


def hot_pages(logs: DataFrame, size="10 minutes", slide="5 seconds", n: int = 3) -> DataFrame:
    """T3 over A3: the n most requested pages per sliding window -> (url, window_end, cnt, row_num),
    ranked on runs, so no row per page and window is made."""
    hits = logs.where(is_method("GET") & not_static_asset("url"))
    return top_n_segments(count_segments(hits, "ts", size, slide, ["url"]), n, slide, "url")


def pv_total_simple(ub: DataFrame, size="1 hour", label="pv") -> DataFrame:
    """A4: pv per tumbling window -> (url=label, window_end, cnt)."""
    out = tumbling_agg(ub.where(is_behavior("pv")), "ts", size)
    return out.select(F.lit(label).alias("url"), "window_end", "cnt")


def pv_total_salted(ub: DataFrame, size="1 hour", salts: int = 10, label="pv") -> DataFrame:
    """A5: two-phase total: count per (window, salt) then sum per window.

    The salt is a deterministic hash of the row (a re-run after a lost executor
    assigns the same salt). Spark already combines map-side, so this only matters
    when a single window dominates a partition; it is kept as an option.
    """
    pv = ub.where(is_behavior("pv")).withColumn(
        "_salt", F.pmod(F.xxhash64("user_id", "item_id", "ts"), F.lit(salts)))
    part = tumbling_agg(pv, "ts", size, ["_salt"])
    return (part.groupBy("window_end").agg(F.sum("cnt").cast("bigint").alias("cnt"))
            .select(F.lit(label).alias("url"), "window_end", "cnt"))


def uv_exact(ub: DataFrame, size="1 hour", label="uv") -> DataFrame:
    """Distinct pv users per tumbling window -> (url='uv', window_end, cnt).
    Catalyst plans the distinct as (window, user) dedup then count, so a busy window is
    spread over tasks by user."""
    pv = ub.where(is_behavior("pv"))
    return (pv.groupBy(_hour_end(size).alias("window_end"))
            .agg(F.count_distinct("user_id").cast("bigint").alias("cnt"))
            .select(F.lit(label).alias("url"), "window_end", "cnt"))


def _hour_end(size):
    """End (epoch ms) of the tumbling window holding ``ts``."""
    S = duration_us(size)
    return ((pane_start("ts", S) + F.lit(S)) / 1000).cast("bigint")


def uv_bitmap(ub: DataFrame, size="1 hour", seed=61, bits=29, label="uv") -> DataFrame:
    """Distinct bitmap offsets (single polynomial hash, 2^bits bits) per window - the
    same count as setting bits and counting first-time sets; collisions undercount.
    Users are de-duplicated per window first (map-side), so the per-character hash
    runs once per distinct visitor and window, not once per page view."""
    pv = ub.where(is_behavior("pv"))
    visitors = pv.select(_hour_end(size).alias("window_end"), "user_id").distinct()
    return (visitors.groupBy("window_end")
            .agg(F.count_distinct(poly_hash("user_id", seed, bits)).cast("bigint").alias("cnt"))
            .select(F.lit(label).alias("url"), "window_end", "cnt"))


def uv_approx(ub: DataFrame, size="1 hour", slide=None, pane="5 minutes", rsd: float = 0.01, label="uv") -> DataFrame:
    """Distinct users per tumbling or sliding window from mergeable pane sketches
    (:mod:`evtlens.operators.distinct`) -> (url='uv', window_end, cnt)."""
    panes = pane_sketches(ub.where(is_behavior("pv")), "user_id", pane, (), rsd)
    return windows_of_sketches(panes, size, slide, pane).select(F.lit(label).alias("url"), "window_end", "cnt")


def uv_running(ub: DataFrame, size="1 hour", seed=61, bits=29, split="1 second") -> DataFrame:
    """The per-element trigger of the bitmap job - one output per new bitmap bit,
    carrying the running uv of its window -> (window_end, bit, first_ts ms, cnt).

    First occurrence per (window, bit) is an aggregate (min ts); the running number is
    a prefix count split into ``split`` buckets so a busy window is not one task."""
    pv = ub.where(is_behavior("pv"))
    # first visit per (window, user), then per (window, bit): the hash runs per visitor
    per_user = pv.groupBy(_hour_end(size).alias("window_end"), "user_id").agg(F.min("ts").alias("ts"))
    first = (per_user.withColumn("bit", poly_hash("user_id", seed, bits))
             .groupBy("window_end", "bit").agg(F.min("ts").alias("ts")))
    out = running_count(first, ["window_end"], ["ts", "bit"], "cnt", split=split)
    return out.select("window_end", "bit", F.unix_millis("ts").alias("first_ts"), "cnt")


def pv_running(ub: DataFrame, size="1 hour", split="1 second") -> DataFrame:
    """W8 on every element: running pv count of the window at each pv event
    -> (window_end, seq, ts ms, cnt)."""
    pv = ub.where(is_behavior("pv")).withColumn("window_end", _hour_end(size))
    out = running_count(pv, ["window_end"], ["ts", "seq"], "cnt", split=split)
    return out.select("window_end", "seq", F.unix_millis("ts").alias("ts"), "cnt")


def channel_behavior_count(mk: DataFrame, size="1 hour", slide="5 seconds", plan="auto") -> DataFrame:
    """A10: non-UNINSTALL rows per (channel, behavior) per sliding window."""
    rows = mk.where(not_behavior("UNINSTALL"))
    return sliding_agg(rows, "ts", size, slide, ["channel", "behavior"], COUNT, plan=plan)


def marketing_total(mk: DataFrame, size="1 hour", slide="5 seconds", plan="auto") -> DataFrame:
    """Non-UNINSTALL rows in total per sliding window -> ('total', 'total', end, cnt)."""
    rows = mk.where(not_behavior("UNINSTALL"))
    out = sliding_agg(rows, "ts", size, slide, [], COUNT, plan=plan)
    return out.select(F.lit("total").alias("channel"), F.lit("total").alias("behavior"),
                      "window_end", "cnt")


def province_ad_count(clicks: DataFrame, size="1 hour", slide="5 minutes", plan="auto") -> DataFrame:
    """(already capped) clicks per province per sliding window."""
    return sliding_agg(clicks, "ts", size, slide, ["province"], COUNT, plan=plan)
