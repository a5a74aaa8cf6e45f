"""Hot-key-safe helpers equal the plain per-key window results."""

import random

import pytest
from pyspark.sql import functions as F

from evtlens.operators.sequence import lag_by_key, lag_within, running_count, running_max, time_bucket


@pytest.fixture(scope="module")
def seq_df(spark):
    rnd = random.Random(3)
    base = 1_700_000_000_000_000
    rows = []
    for i in range(800):
        user = 1 if rnd.random() < 0.5 else rnd.randint(2, 9)  # user 1 holds half the rows
        u = base + rnd.randrange(0, 5 * 86_400_000_000)  # five days
        rows.append((user, u, i, rnd.choice(["fail", "success"]), rnd.randint(0, 100)))
    return spark.createDataFrame(rows, "user_id bigint, u bigint, seq bigint, s string, v bigint") \
        .withColumn("ts", F.timestamp_micros("u"))


def collect(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("split", ["1 day", "3 hours"])
def test_lag_by_key_split_equals_plain(seq_df, split):
    cols = ["seq", "s_lag1", "u_lag1", "s_lag2", "u_lag2"]
    a = lag_by_key(seq_df, ["user_id"], ["ts", "seq"], ["s", "u"], 2, split)
    b = lag_by_key(seq_df, ["user_id"], ["ts", "seq"], ["s", "u"], 2, None)
    assert collect(a, cols) == collect(b, cols)


@pytest.mark.parametrize("limit, k, factor", [("1 hour", 1, 4), ("3 hours", 2, 1), ("20 minutes", 3, 2)])
def test_lag_within_finds_all_rows_inside_the_limit(seq_df, limit, k, factor):
    """One user holds half the rows of each day, so its buckets are full."""
    from evtlens.functions.time import duration_us
    lim = duration_us(limit)
    got = {r.seq: r for r in lag_within(seq_df, ["user_id"], ["ts", "seq"], ["s", "u"], limit, k, factor).collect()}
    plain = lag_by_key(seq_df, ["user_id"], ["ts", "seq"], ["s", "u"], k, None).collect()
    assert len(got) == len(plain)
    for r in plain:
        for i in range(1, k + 1):
            if r[f"u_lag{i}"] is not None and r["u"] - r[f"u_lag{i}"] <= lim:
                assert (got[r.seq][f"u_lag{i}"], got[r.seq][f"s_lag{i}"]) == (r[f"u_lag{i}"], r[f"s_lag{i}"])
            else:
                x = got[r.seq][f"u_lag{i}"]
                assert x is None or r["u"] - x > lim


def test_running_count_split_equals_plain(seq_df):
    a = running_count(seq_df, ["user_id"], ["ts", "seq"], "n", split="2 hours")
    b = running_count(seq_df, ["user_id"], ["ts", "seq"], "n", split=None)
    assert collect(a, ["seq", "n"]) == collect(b, ["seq", "n"])


def test_running_max_global(seq_df):
    a = running_max(seq_df, [], ["seq"], "v", "m", F.floor(F.col("seq") / 37), exclusive=True)
    rows = sorted(seq_df.select("seq", "v").collect())
    exp, best = [], None
    for r in rows:
        exp.append((r.seq, best))
        best = r.v if best is None else max(best, r.v)
    assert collect(a, ["seq", "m"]) == exp


def test_time_bucket_floor(spark):
    df = spark.createDataFrame([(-1,), (0,), (86_400_000_000,)], "u bigint").withColumn(
        "ts", F.timestamp_micros("u"))
    assert [r.b for r in df.select(time_bucket("ts", "1 day").alias("b")).collect()] == [-1, 0, 1]
