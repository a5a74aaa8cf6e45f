"""Per-key ordered-sequence building blocks that survive hot keys.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, so a key
holding a third of the data becomes a third of the job in one task. The helpers
here split each key into time (or sequence) buckets, do the ordered work inside
(key, bucket) partitions, and carry the little state a bucket needs from the
buckets before it through a small per-bucket summary table:

* :func:`lag_by_key`   - the k previous rows of each row (carry = last k rows of the
  k previous non-empty buckets, found with a partial top-k before any shuffle).
* :func:`lag_within`   - the k previous rows as far as they lie within a limit: rows near the
  end of a bucket are copied into the next one, so one shuffle does.
* :func:`running_count` - 1-based position of each row (carry = count of earlier buckets).
* :func:`running_max`  - running maximum of a value (carry = max of earlier buckets).

With ``split=None`` they fall back to a single per-key window (fine for keys known
to be small).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evtlens.functions.time import duration_us, epoch_us


def _order_cols(order: Sequence[str], desc: bool = False) -> list[Column]:
    return [F.col(c).desc() if desc else F.col(c).asc() for c in order]


def time_bucket(ts: str, split) -> Column:
    b = duration_us(split)
    u = epoch_us(ts)
    return ((u - F.pmod(u, F.lit(b))) / F.lit(b)).cast("bigint")


def lag_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
               k: int = 1, split="1 day", ts: str | None = None, suffix: str = "_lag") -> DataFrame:
    """Add ``<value><suffix><i>`` = value of the i-th previous row of the same key
    (ordered by ``order``) for i = 1..k; NULL when there is none.

    ``order`` must be a total order per key and start with the event-time column ``ts``
    (default ``order[0]``) used for bucketing.
    """
    keys, order, values = list(keys), list(order), list(values)
    payload = list(dict.fromkeys(order + values))
    if split is None:
        w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
        out = df
        for i in range(1, k + 1):
            for v in values:
                out = out.withColumn(f"{v}{suffix}{i}", F.lag(v, i).over(w))
        return out
    ts = ts or order[0]
    base = df.withColumn("_b", time_bucket(ts, split))
    # last k rows of every (key, bucket): row_number <= k plans as a partial
    # WindowGroupLimit before the shuffle, so a hot bucket ships at most k rows per task
    tails = (base.select(*keys, "_b", *payload)
             .withColumn("_r", F.row_number().over(
                 Window.partitionBy(*keys, "_b").orderBy(*_order_cols(order, desc=True))))
             .where(F.col("_r") <= k).drop("_r"))
    # carry each tail row into the next k non-empty buckets: over the tails table (at
    # most k rows per bucket) the next k distinct buckets are among the next k*k rows
    wt = Window.partitionBy(*keys).orderBy(F.col("_b"), *_order_cols(order))
    ahead = tails.select("*", *[F.lead("_b", j).over(wt).alias(f"_a{j}") for j in range(1, k * k + 1)])
    nxt = F.array(*[F.col(f"_a{j}") for j in range(1, k * k + 1)])
    targets = F.slice(F.array_distinct(F.filter(nxt, lambda x: x.isNotNull() & (x > F.col("_b")))), 1, k)
    carry = (ahead.withColumn("_t", targets).select(*keys, *payload, F.explode("_t").alias("_b"))
             .withColumn("_carry", F.lit(True)))
    rows = base.withColumn("_carry", F.lit(False))
    cols = rows.columns
    allrows = rows.unionByName(carry, allowMissingColumns=True).select(*cols)
    w = Window.partitionBy(*keys, "_b").orderBy(*_order_cols(order))
    out = allrows
    for i in range(1, k + 1):
        for v in values:
            out = out.withColumn(f"{v}{suffix}{i}", F.lag(v, i).over(w))
    return out.where(~F.col("_carry")).drop("_carry", "_b")


def lag_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
               limit, k: int = 1, factor: int = 4, ts: str | None = None, suffix: str = "_lag") -> DataFrame:
    """Like :func:`lag_by_key` for rows at most ``limit`` back; a lag further back is NULL
    or that row. Buckets are ``factor`` limits wide and the rows of a bucket's last ``limit``
    are copied into the next, so every row finds those before it in its own bucket: one
    scan, one shuffle, and a key with very many rows is spread over its buckets."""
    keys, order, values = list(keys), list(order), list(values)
    reach = max(duration_us(limit), 1)
    width = reach * factor
    u = epoch_us(ts or order[0])
    own = ((u - F.pmod(u, F.lit(width))) / F.lit(width)).cast("bigint")
    near_end = F.pmod(u, F.lit(width)) >= F.lit(width - reach)
    x = df.withColumn("_own", own).withColumn(
        "_b", F.explode(F.when(near_end, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array("_own"))))
    w = Window.partitionBy(*keys, "_b").orderBy(*_order_cols(order))
    for i in range(1, k + 1):
        for v in values:
            x = x.withColumn(f"{v}{suffix}{i}", F.lag(v, i).over(w))
    return x.where(F.col("_b") == F.col("_own")).drop("_b", "_own")


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "running",
                  split="1 minute", ts: str | None = None) -> DataFrame:
    """1-based position of each row inside its key, ordered by ``order`` (row_number)."""
    keys, order = list(keys), list(order)
    if split is None:
        return df.withColumn(out, F.row_number().over(
            Window.partitionBy(*keys).orderBy(*_order_cols(order))).cast("bigint"))
    ts = ts or order[0]
    base = df.withColumn("_b", time_bucket(ts, split))
    counts = base.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select(*keys, "_b", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    w = Window.partitionBy(*keys, "_b").orderBy(*_order_cols(order))
    return (base.join(offs, keys + ["_b"])
            .withColumn(out, (F.row_number().over(w) + F.col("_off")).cast("bigint"))
            .drop("_b", "_off"))


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                bucket: Column, exclusive: bool = False) -> DataFrame:
    """Running max of ``value`` over rows ordered by ``order`` inside each key (all keys
    together when ``keys`` is empty); ``exclusive`` leaves out the row itself.
    ``bucket`` is a monotone function of the order (a time or sequence bucket)."""
    keys, order = list(keys), list(order)
    base = df.withColumn("_b", bucket)
    summ = base.groupBy(*keys, "_b").agg(F.max(value).alias("_m"))
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    carry = summ.select(*keys, "_b", F.max("_m").over(
        wk.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_c"))
    w = Window.partitionBy(*keys, "_b").orderBy(*_order_cols(order))
    w = w.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    inside = F.max(value).over(w)
    return (base.join(carry, keys + ["_b"])
            .withColumn(out, F.greatest(inside, F.col("_c")))
            .drop("_b", "_c"))
