"""Interval joins of pays and receipts.

An equi-join on the transaction id alone would put every event of a busy id into
one task (and the full-outer sort-merge join buffers both sides of a key). The
joins here add a time bucket to the key: the probe side gets the single bucket of
its timestamp, the other side is copied into the (at most two, for the default
bucket width) buckets its interval can reach. The range condition then runs per
(id, bucket), AQE can still split skewed partitions, and no pair is lost or doubled
(each probe row sits in exactly one bucket).

Full matching (pairs and what is left over on either side) is one inner and two anti
joins of that kind, which adaptive execution can all split.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evtlens.functions.predicates import has_tx
from evtlens.functions.time import duration_us, epoch_us


def _fdiv(x: Column, b: int) -> Column:
    return ((x - F.pmod(x, F.lit(b))) / F.lit(b)).cast("bigint")


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str,
                  lower="-3 seconds", upper="5 seconds", how: str = "inner",
                  bucket=None) -> DataFrame:
    """Rows of ``left`` and ``right`` with equal ``on`` keys and
    ``left_ts + lower <= right_ts <= left_ts + upper`` (both bounds inclusive).

    ``how``: ``inner`` (all pairs; key columns once), ``left_semi`` or ``left_anti``.
    Non-key column names must differ between the sides.
    """
    on = list(on)
    lo, hi = duration_us(lower), duration_us(upper)
    if hi < lo:
        raise ValueError("upper bound below lower bound")
    width = duration_us(bucket) if bucket else max(hi - lo, 1_000_000)
    L = left.withColumn("_lu", epoch_us(left_ts)).withColumn("_jb", _fdiv(F.col("_lu"), width))
    ru = epoch_us(right_ts)
    R = (right.withColumn("_ru", ru)
         .withColumn("_jb", F.explode(F.sequence(_fdiv(F.col("_ru") - F.lit(hi), width),
                                                 _fdiv(F.col("_ru") - F.lit(lo), width)))))
    R = R.select(*[F.col(c).alias(f"_r_{c}") if c in on or c == "_jb" else F.col(c)
                   for c in R.columns])
    cond = [F.col(k) == F.col(f"_r_{k}") for k in on] + [
        F.col("_jb") == F.col("_r__jb"),
        F.col("_ru") >= F.col("_lu") + F.lit(lo),
        F.col("_ru") <= F.col("_lu") + F.lit(hi)]
    cond_all = cond[0]
    for c in cond[1:]:
        cond_all = cond_all & c
    j = L.join(R, cond_all, how)
    drop = ["_lu", "_jb", "_ru", "_r__jb"] + [f"_r_{k}" for k in on]
    return j.drop(*[c for c in drop if c in j.columns])


def _pay_cols(pays: DataFrame) -> DataFrame:
    return pays.where(has_tx("tx_id")).select(
        "tx_id", "order_id", F.col("ts").alias("pay_ts"))


def _receipt_cols(receipts: DataFrame) -> DataFrame:
    return receipts.select("tx_id", "pay_channel", F.col("ts").alias("receipt_ts"))


def tx_interval_join(pays: DataFrame, receipts: DataFrame, lower="-3 seconds",
                     upper="5 seconds", bucket=None) -> DataFrame:
    """Every (pay, receipt) with the same tx id and receipt time in
    [pay - 3 s, pay + 5 s] -> (tx_id, order_id, pay_time ms, pay_channel, receipt_time ms)."""
    j = interval_join(_pay_cols(pays), _receipt_cols(receipts), ["tx_id"], "pay_ts", "receipt_ts",
                      lower, upper, "inner", bucket)
    return j.select("tx_id", "order_id", F.unix_millis("pay_ts").alias("pay_time"), "pay_channel",
                    F.unix_millis("receipt_ts").alias("receipt_time"))


def tx_full_match(pays: DataFrame, receipts: DataFrame, lower="-3 seconds", upper="5 seconds",
                  bucket=None) -> DataFrame:
    """J2 + S12: matched pairs, pays without a receipt in the interval and receipts without
    a pay, as one DataFrame with a ``route`` column ('matched', 'unmatched-pays',
    'unmatched-receipts'); split it with ``filter(route = ...)``.

    One inner and two anti joins on (tx id, time bucket). Adaptive execution can split a
    skewed bucket in all three (it can't in a full outer join), the pairs and the unmatched
    pays read the same two shuffles, and the output isn't shuffled again."""
    lo, hi = duration_us(lower), duration_us(upper)
    p = _pay_cols(pays)
    r = _receipt_cols(receipts)
    args = (["tx_id"], "pay_ts", "receipt_ts", lower, upper)
    pairs = interval_join(p, r, *args, "inner", bucket)
    lone_pays = interval_join(p, r, *args, "left_anti", bucket)
    lone_receipts = interval_join(r, p, ["tx_id"], "receipt_ts", "pay_ts", f"{-hi} microseconds",
                                  f"{-lo} microseconds", "left_anti", bucket)

    def out(df, route):
        none = {"order_id": "bigint", "pay_ts": "timestamp", "pay_channel": "string", "receipt_ts": "timestamp"}
        df = df.withColumns({c: F.lit(None).cast(t) for c, t in none.items() if c not in df.columns})
        return df.select("tx_id", "order_id", F.unix_millis("pay_ts").alias("pay_time"), "pay_channel",
                         F.unix_millis("receipt_ts").alias("receipt_time"), F.lit(route).alias("route"))

    return (out(pairs, "matched").unionByName(out(lone_pays, "unmatched-pays"))
            .unionByName(out(lone_receipts, "unmatched-receipts")))
