"""Window plans against a brute-force reference on random data, and window edges."""

import random

import pytest
from pyspark.sql import functions as F

from evtlens.operators.windows import COUNT, assign_windows, sliding_agg, tumbling_agg

S_US, L_US = 60_000_000, 5_000_000  # 1 min / 5 s -> 12 windows per row


def brute(rows, S, L, with_sum=False):
    out = {}
    for key, u, v in rows:
        last = u - u % L
        start = last - S + L
        for st in range(start, last + 1, L):
            if st <= u < st + S:
                e = (st + S) // 1000
                c, s = out.get((key, e), (0, 0))
                out[(key, e)] = (c + 1, s + v)
    return {k: (v if with_sum else v[0]) for k, v in out.items()}


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    base = 1_700_000_000_000_000
    rows = []
    for _ in range(600):
        key = rnd.choice(["a", "a", "a", "b", "c"])  # a is hot
        u = base + rnd.randrange(0, 600_000_000)
        rows.append((key, u, rnd.randint(-3, 9)))
    df = spark.createDataFrame(rows, "k string, u bigint, v bigint").withColumn(
        "ts", F.timestamp_micros("u"))
    return rows, df


@pytest.mark.parametrize("plan", ["window", "pane", "runs"])
def test_sliding_plans_match_brute_force(data, plan):
    rows, df = data
    exp = brute(rows, S_US, L_US, with_sum=True)
    out = sliding_agg(df, "ts", "1 minute", "5 seconds", ["k"],
                      (("cnt", "count", None), ("total", "sum", "v")), plan=plan)
    got = {(r.k, r.window_end): (r.cnt, r.total) for r in out.collect()}
    assert got == exp


def test_runs_plan_sum_only_keeps_zero_sum_windows(spark):
    base = 1_700_000_000_000_000
    df = spark.createDataFrame([("x", base, 5), ("x", base + 1, -5)], "k string, u bigint, v bigint") \
        .withColumn("ts", F.timestamp_micros("u"))
    out = sliding_agg(df, "ts", "1 minute", "5 seconds", ["k"], (("total", "sum", "v"),), plan="runs")
    rs = out.collect()
    assert len(rs) == 12 and all(r.total == 0 for r in rs)


def test_window_edge_belongs_to_next_window(spark):
    # ts exactly at 10:05:00 is the start of [10:05, 11:05), not in the window ending 10:05
    df = spark.createDataFrame([("2017-11-26 10:05:00",)], "t string").select(
        F.to_timestamp("t").alias("ts"))
    ends = sorted(r.window_end for r in assign_windows(df, "ts", "1 hour", "5 minutes").collect())
    first = F.to_timestamp(F.lit("2017-11-26 10:10:00"))
    exp_first = df.sparkSession.range(1).select(F.unix_millis(first)).first()[0]
    assert ends[0] == exp_first and len(ends) == 12


def test_tumbling(spark):
    df = spark.createDataFrame([(0,), (3_599_999_999,), (3_600_000_000,)], "u bigint").withColumn(
        "ts", F.timestamp_micros("u"))
    got = sorted((r.window_end, r.cnt) for r in tumbling_agg(df, "ts", "1 hour").collect())
    assert got == [(3_600_000, 2), (7_200_000, 1)]
