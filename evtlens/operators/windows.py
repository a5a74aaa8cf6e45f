"""Tumbling and sliding event-time windows, epoch aligned, half open [start, end).

Two physical plans for sliding windows:

* ``window`` - Catalyst's ``F.window`` (an Expand of size/slide projections per row).
  Used for low fan-out (1 h / 5 min = 12 windows per row).
* ``pane`` - pre-aggregate per (key, slide-sized pane), then ``explode(sequence)`` each
  pane into the size/slide window ends it belongs to and merge. The expansion is per
  distinct pane instead of per event and stays inside whole-stage codegen, but it
  still costs panes x size/slide rows.
* ``runs`` - for additive aggregates (count / sum) and high fan-out (10 min / 5 s =
  120, 1 h / 5 s = 720): every pane becomes a +value delta at the first window end
  that holds it and a -value delta one slide after the last; a running sum of the
  deltas is the window value, constant between change points, so only the runs are
  expanded into output rows. Work is O(panes + output rows) instead of
  O(panes x fan-out). The running sum is computed per (key, block of one window
  size): a block's window ends only see panes of that block and the previous one,
  so every block is a bounded group (at most 4 x size/slide delta rows) however hot
  the key is, and the two shuffles move pane-sized data only.

Both give identical rows; the window end is reported as epoch milliseconds.
Only decomposable aggregates are offered (count / sum / min / max), which is what
the incremental aggregate functions of the reference compute.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evtlens.functions.time import duration_us, epoch_us

PANE_FANOUT_THRESHOLD = 24

Agg = tuple  # (out_name, kind, column-or-None)
COUNT = (("cnt", "count", None),)


def _partial(kind: str, col) -> Column:
    if kind == "count":
        return F.count(F.lit(1) if col is None else F.col(col))
    if kind == "sum":
        return F.sum(col)
    if kind == "min":
        return F.min(col)
    if kind == "max":
        return F.max(col)
    raise ValueError(f"aggregate {kind!r} is not decomposable over panes")


def _merge(kind: str, name: str) -> Column:
    return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[kind](name)


def _finish(df: DataFrame, aggs: Sequence[Agg]) -> DataFrame:
    for name, kind, _ in aggs:
        if kind == "count":
            df = df.withColumn(name, F.col(name).cast("bigint"))
    return df


def _ms(us: Column) -> Column:
    """Microseconds -> milliseconds for values that are whole milliseconds."""
    return (us / F.lit(1000)).cast("bigint")


def _ms_sequence(lo_us: Column, hi_us: Column, step_us: int) -> Column:
    """sequence(lo, hi, step) of window ends directly in ms (ends are whole ms), so no
    per-element lambda runs."""
    return F.sequence(_ms(lo_us), _ms(hi_us), F.lit(step_us // 1000).cast("bigint"))


def pane_start(ts, slide_us: int) -> Column:
    """Epoch-aligned start (us) of the slide-sized pane holding ``ts`` (floor, also before 1970)."""
    u = epoch_us(ts)
    return u - F.pmod(u, F.lit(slide_us))


def window_ends(ts, size, slide=None) -> Column:
    """Array of the ends (us) of every window [end-size, end) that contains ``ts``."""
    S, L = duration_us(size), duration_us(slide or size)
    start = pane_start(ts, L)
    n = -(-S // L)
    ends = F.sequence(start - F.lit((n - 1) * L) + F.lit(S), start + F.lit(S), F.lit(L))
    if S % L:
        u = epoch_us(ts)
        ends = F.filter(ends, lambda e: (e - F.lit(S) <= u) & (u < e))
    return ends


def assign_windows(df: DataFrame, ts: str = "ts", size="1 hour", slide=None,
                   end_col: str = "window_end") -> DataFrame:
    """One row per (row, window containing it), with the window end in epoch ms."""
    S, L = duration_us(size), duration_us(slide or size)
    if S % L == 0 and L % 1000 == 0:
        start = pane_start(ts, L)
        return df.withColumn(end_col, F.explode(_ms_sequence(start + F.lit(L), start + F.lit(S), L)))
    return df.withColumn(end_col, F.explode(F.transform(window_ends(ts, size, slide), _ms)))


def tumbling_agg(df: DataFrame, ts: str = "ts", size="1 hour", keys: Iterable = (),
                 aggs: Sequence[Agg] = COUNT, end_col: str = "window_end") -> DataFrame:
    """Tumbling window = one pane; the end is plain arithmetic (no Expand)."""
    S = duration_us(size)
    keys = list(keys)
    end = ((pane_start(ts, S) + F.lit(S)) / 1000).cast("bigint").alias(end_col)
    out = df.groupBy(*keys, end).agg(*[_partial(k, c).alias(n) for n, k, c in aggs])
    return _finish(out, aggs)


def sliding_agg(df: DataFrame, ts: str = "ts", size="1 hour", slide="5 minutes",
                keys: Iterable = (), aggs: Sequence[Agg] = COUNT, end_col: str = "window_end",
                plan: str = "auto") -> DataFrame:
    """Sliding window aggregate -> (keys..., window_end ms, aggs...)."""
    S, L = duration_us(size), duration_us(slide)
    keys = list(keys)
    if S == L:
        return tumbling_agg(df, ts, size, keys, aggs, end_col)
    if plan == "auto":
        additive = all(k in ("count", "sum") for _, k, _ in aggs)
        plan = ("window" if (S // L <= PANE_FANOUT_THRESHOLD or S % L)
                else "runs" if additive else "pane")
    if plan == "runs":
        return _runs_plan(df, ts, S, L, keys, aggs, end_col)
    if plan == "window":
        w = F.window(F.col(ts), f"{S} microseconds", f"{L} microseconds")
        out = (df.groupBy(w.alias("_w"), *keys)
               .agg(*[_partial(k, c).alias(n) for n, k, c in aggs])
               .select(*keys, F.unix_millis(F.col("_w.end")).alias(end_col),
                       *[n for n, _, _ in aggs]))
        return _finish(out, aggs)
    if S % L:
        raise ValueError("the pane plan needs size to be a multiple of slide")
    panes = (df.groupBy(*keys, pane_start(ts, L).alias("_pane"))
             .agg(*[_partial(k, c).alias(n) for n, k, c in aggs]))
    ends = _ms_sequence(F.col("_pane") + F.lit(L), F.col("_pane") + F.lit(S), L)
    exploded = panes.select(*keys, F.explode(ends).alias(end_col),
                            *[n for n, _, _ in aggs])
    out = exploded.groupBy(*keys, end_col).agg(*[_merge(k, n).alias(n) for n, k, _ in aggs])
    return _finish(out, aggs)


def _runs_plan(df: DataFrame, ts: str, S: int, L: int, keys: list, aggs: Sequence[Agg],
               end_col: str) -> DataFrame:
    if S % L:
        raise ValueError("the runs plan needs size to be a multiple of slide")
    user_aggs = list(aggs)
    cnt_name = next((n for n, k, c in aggs if k == "count" and c is None), None)
    if cnt_name is None:  # a window holds rows iff its row count is > 0 (a sum may be 0)
        cnt_name = "_rows"
        aggs = user_aggs + [(cnt_name, "count", None)]
    panes = (df.groupBy(*keys, pane_start(ts, L).alias("_p"))
             .agg(*[_partial(k, c).alias(n) for n, k, c in aggs]))
    out = runs_from_panes(panes, S, L, keys, [n for n, _, _ in aggs], cnt_name, end_col)
    return _finish(out.select(*keys, end_col, *[n for n, _, _ in user_aggs]), user_aggs)


def runs_from_panes(panes: DataFrame, S: int, L: int, keys: list, names: list, cnt_name: str,
                    end_col: str = "window_end", end_range: tuple | None = None) -> DataFrame:
    """Sliding sums from pane sums (columns keys, ``_p`` = pane start us, ``names``).
    ``end_range`` = (lo, hi] in us restricts the emitted window ends (stream roll-up)."""
    live = run_segments(panes, S, L, keys, names, cnt_name, end_range)
    return live.select(*keys, F.explode(_ms_sequence(F.col("_lo"), F.col("_hi") - F.lit(L), L)).alias(end_col), *names)


def run_segments(panes: DataFrame, S: int, L: int, keys: list, names: list, cnt_name: str,
                 end_range: tuple | None = None) -> DataFrame:
    """The runs themselves: keys, names, and the window ends they hold for, ``_lo`` <= end < ``_hi`` (us).
    Runs of a key don't overlap and each lies within one block of a window's size."""
    blk = ((F.col("_p") - F.pmod(F.col("_p"), F.lit(S))) / F.lit(S)).cast("bigint")
    # each pane feeds the window ends of its own block and of the next one
    copies = panes.select(*keys, "_p", *names, F.explode(F.array(blk, blk + 1)).alias("_b"))
    plus = F.struct((F.col("_p") + F.lit(L)).alias("_e"), *[F.col(n).alias(n) for n in names])
    minus = F.struct((F.col("_p") + F.lit(S + L)).alias("_e"), *[(-F.col(n)).alias(n) for n in names])
    deltas = (copies.select(*keys, "_b", F.explode(F.array(plus, minus)).alias("_d"))
              .select(*keys, "_b", "_d.*")
              .repartition(*keys, "_b"))
    at = deltas.groupBy(*keys, "_b", "_e").agg(*[F.sum(n).alias(n) for n in names])
    w = Window.partitionBy(*keys, "_b").orderBy("_e")
    runs = at.select(*keys, "_b", "_e", F.lead("_e").over(w).alias("_n"),
                     *[F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(n)
                       for n in names])
    lo = F.greatest(F.col("_e"), F.col("_b") * F.lit(S))
    hi = F.least(F.coalesce(F.col("_n"), (F.col("_b") + 1) * F.lit(S)), (F.col("_b") + 1) * F.lit(S))
    if end_range is not None:  # ends e with lo_r < e <= hi_r  <=>  lo_r + L <= e < hi_r + L
        lo = F.greatest(lo, F.lit(end_range[0] + L))
        hi = F.least(hi, F.lit(end_range[1] + L))
    live = runs.where((F.col(cnt_name) > 0) & (lo < hi))
    return live.select(*keys, *names, lo.alias("_lo"), hi.alias("_hi"))


def count_segments(df: DataFrame, ts: str, size, slide, keys: list) -> DataFrame:
    """Runs of the sliding row count, not yet expanded into windows: keys, cnt, ``_lo``, ``_hi``."""
    S, L = duration_us(size), duration_us(slide)
    if S % L:
        raise ValueError("the runs plan needs size to be a multiple of slide")
    panes = df.groupBy(*keys, pane_start(ts, L).alias("_p")).agg(F.count(F.lit(1)).alias("cnt"))
    return run_segments(panes, S, L, list(keys), ["cnt"], "cnt")


def sliding_sql(spark, view: str, ts: str, size: str, slide: str, keys: Sequence[str],
                where: str | None = None, count_col: str | None = None) -> DataFrame:
    """The same aggregate expressed in Spark SQL with ``window(ts, size, slide)``
    (Spark's spelling of a HOP group window; ``.end`` is HOP_END)."""
    k = ", ".join(keys)
    cnt = f"count({count_col})" if count_col else "count(*)"
    sql = (f"SELECT {k}{', ' if k else ''}unix_millis(window({ts}, '{size}', '{slide}').end) AS window_end, "
           f"CAST({cnt} AS BIGINT) AS cnt FROM {view} "
           + (f"WHERE {where} " if where else "")
           + f"GROUP BY {k}{', ' if k else ''}window({ts}, '{size}', '{slide}')")
    return spark.sql(sql)
