"""State that is stored and merged: keyed store with compaction, sketches, bitmaps, running numbers,
watermarks over an order of arrival, rankings on runs."""

import random

import pytest
from pyspark.sql import functions as F

from evtlens.operators import distinct as D
from evtlens.operators import rank as T
from evtlens.operators.lateness import late_split, with_watermark_column
from evtlens.operators.windows import count_segments, sliding_agg
from evtlens.streaming import sinks, store
from tests.streaming_util import scratch

KV = "k bigint, v bigint"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ------------------------------------------------------------------ store

def test_store_reads_a_snapshot_and_a_short_tail(spark):
    s = store.KeyedStore(scratch(), ["k"], every=3)
    want = {}
    for b in range(11):
        batch = [(b % 4, b), (100 + b, b)]
        want.update(batch)
        s.write(spark.createDataFrame(batch, KV), b)
        assert rows(s.read(spark)) == sorted(want.items())
        assert len(s.tail(spark)) < 3                                  # whatever the stream's age
    assert s.snapshot(spark) == 8 and s._numbers(spark, "current") == [5, 8]
    assert s._numbers(spark, "snapshot") == [5, 8] and min(s._numbers(spark, "segment")) > 5 - 3


def test_store_as_of_a_batch(spark):
    s = store.KeyedStore(scratch(), ["k"], every=2)
    for b in range(6):
        s.write(spark.createDataFrame([(1, b), (b + 10, b)], KV), b)
    assert s.read(spark, before=5).where("k = 1").first()["v"] == 4
    assert s.read(spark, before=0) is None and store.KeyedStore(scratch(), ["k"]).read(spark) is None


@pytest.mark.parametrize("stop", ["segment", "snapshot", "pointer", "removal"])
def test_store_survives_a_stop_between_any_two_writes(spark, stop, monkeypatch):
    """The batch stops behind one of its writes and is tried again; what follows is as if it had not stopped."""
    def fill(s, upto):
        for b in range(upto):
            s.write(spark.createDataFrame([(b % 3, b), (50, b)], KV), b)

    whole, path = store.KeyedStore(scratch(), ["k"], every=2), scratch()
    fill(whole, 6)
    s = store.KeyedStore(path, ["k"], every=2)
    fill(s, 3)
    batch = spark.createDataFrame([(0, 3), (50, 3)], KV)
    with monkeypatch.context() as m:
        def halt(*a, **k):
            raise RuntimeError("stopped")
        if stop == "segment":
            m.setattr(s, "compact", halt)
        elif stop == "snapshot":
            real = s._fs
            m.setattr(s, "_fs", lambda spark, sub="": halt() if sub.startswith("current/") else real(spark, sub))
        elif stop == "pointer":
            real_numbers = s._numbers
            m.setattr(s, "_numbers", lambda spark, sub: halt() if sub == "segment" and real_numbers(spark, "current")[-1:] == [3] else real_numbers(spark, sub))
        else:
            m.setattr(s, "_drop", halt)
        try:
            s.write(batch, 3)
        except RuntimeError:
            pass
    assert rows(s.read(spark, before=3)) == [(0, 0), (1, 1), (2, 2), (50, 2)]
    s.write(batch, 3)
    for b in (4, 5):
        s.write(spark.createDataFrame([(b % 3, b), (50, b)], KV), b)
    assert rows(s.read(spark)) == rows(whole.read(spark))


def test_store_merges_and_versions(spark):
    s = store.KeyedStore(scratch(), ["k"], {"v": F.max}, every=2)
    for b, v in enumerate([5, 9, 3, 4]):
        s.write(s.newest_of(spark.createDataFrame([(1, v), (1, v - 1)], KV)), b)
    assert rows(s.read(spark)) == [(1, 9)]
    out = scratch()
    put = sinks.keyed_upsert(out, ["k"], "v", every=2)
    for b, v in enumerate([5, 9, 3, 4, 8]):
        put(spark.createDataFrame([(1, v)], KV), b)
    assert rows(sinks.read_upserted(spark, out, ["k"], "v")) == [(1, 9)]


def test_refire_logs_old_and_new(spark):
    path = scratch()
    put = store.refire(path, ["k"], "cnt", every=2)
    kind = "k bigint, cnt bigint"
    put(spark.createDataFrame([(1, 3), (2, 1)], kind), 0)
    put(spark.createDataFrame([(1, 5), (2, 1), (3, 1)], kind), 1)
    put(spark.createDataFrame([(1, 5), (2, 1), (3, 1)], kind), 1)       # tried again
    log = spark.read.parquet(f"{path}/log")
    assert rows(log.where("batch = 1").select("op", "k", "cnt")) == [("+", 1, 5), ("+", 3, 1), ("-", 1, 3)]
    assert rows(store.KeyedStore(f"{path}/state", ["k"]).read(spark)) == [(1, 5), (2, 1), (3, 1)]


def test_numbered_continues_over_batches(spark):
    path = scratch()
    put = store.numbered(path, "w", ["ts", "seq"], every=2)
    data = [(i % 2, i) for i in range(40)]
    for b in range(4):
        put(spark.createDataFrame(data[b * 10:b * 10 + 10], "w bigint, seq bigint").withColumn("ts", F.timestamp_seconds("seq")), b)
        if b == 2:                                                       # tried again
            put(spark.createDataFrame(data[20:30], "w bigint, seq bigint").withColumn("ts", F.timestamp_seconds("seq")), b)
    got = rows(spark.read.parquet(f"{path}/rows").select("w", "seq", "cnt"))
    assert got == sorted((w, s, s // 2 + 1) for w, s in data)


# ------------------------------------------------------------------ sketches and bitmaps

def visits(spark, n, users, hours=3, seed=1):
    return spark.range(n).select(
        F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(users)).alias("user_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id", F.lit(seed + 9)), F.lit(hours * 3600))).alias("ts"))


def test_sketches_stay_within_the_bound(spark):
    v = visits(spark, 400_000, 120_000)
    rsd = 0.01
    panes = D.pane_sketches(v, rsd=rsd)
    for size, slide in (("1 hour", None), ("1 hour", "5 minutes"), ("2 hours", "1 hour")):
        got = {r["window_end"]: r["cnt"] for r in D.windows_of_sketches(panes, size, slide).collect()}
        w = F.window("ts", size, slide) if slide else F.window("ts", size)
        exact = {r["e"]: r["n"] for r in v.groupBy(F.unix_millis(w.end).alias("e")).agg(F.count_distinct("user_id").alias("n")).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(got[e] - n) <= max(1, 4 * rsd * n) for e, n in exact.items())
    assert max(exact.values()) > 50_000


def test_sketches_are_exact_for_few_and_merge_like_one(spark):
    v = visits(spark, 3000, 150)
    parts = [D.pane_sketches(v.where(F.pmod(F.xxhash64("user_id", "ts"), F.lit(3)) == i)) for i in range(3)]
    merged = D.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["pane_end"])
    assert rows(D.windows_of_sketches(merged)) == rows(D.windows_of_sketches(D.pane_sketches(v))) == rows(
        v.groupBy(F.unix_millis(F.window("ts", "1 hour").end)).agg(F.count_distinct("user_id")))
    assert D.sketch_size(0.01) == 14 and D.windows_of_sketches(D.pane_sketches(v.limit(0))).count() == 0


def test_bitmaps_merge_by_or_and_collide_like_the_hash(spark):
    from evtlens.functions.hashing import poly_hash
    v = visits(spark, 5000, 900_000)
    parts = [D.visitor_bitmaps(v.where(F.col("user_id") % 3 == i), bits=16) for i in range(3)]        # few bits: collisions
    merged = D.merge_bitmaps(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    want = v.groupBy(F.unix_millis(F.window("ts", "1 hour").end)).agg(F.count_distinct(poly_hash("user_id", 61, 16)))
    assert rows(D.count_bitmaps(merged)) == rows(want) == rows(D.count_bitmaps(D.visitor_bitmaps(v, bits=16)))
    users = v.groupBy(F.window("ts", "1 hour")).agg(F.count_distinct("user_id").alias("n")).agg(F.sum("n")).first()[0]
    assert sum(n for _, n in rows(want)) < users                         # collisions undercount


# ------------------------------------------------------------------ lateness

def test_watermark_over_arrival_order_equals_a_plain_pass(spark):
    rng = random.Random(2)
    t = 1_700_000_000
    data = []
    for i in range(600):
        t += rng.choice([0, 1, 2, 40])
        data.append((i, t - (rng.randint(0, 900) if rng.random() < 0.2 else 0), t * 1_000_000))
    df = spark.createDataFrame(data, "seq bigint, s bigint, arrival bigint").withColumn("ts", F.timestamp_seconds("s")).repartition(4)
    newest, want, late = None, {}, {}
    for seq, s, _ in sorted(data, key=lambda x: (x[2], x[0])):
        wm = None if newest is None else newest * 1_000_000 - 1_000_000
        want[seq] = wm
        end = (s - s % 5 + 600) * 1_000_000
        late[seq] = wm is not None and end - 1000 + 60_000_000 <= wm
        newest = s if newest is None else max(newest, s)
    for bucket in ("1 minute", "1 hour", "100 days"):
        assert {r["seq"]: r["watermark_us"] for r in with_watermark_column(df, "arrival", "seq", bucket=bucket).collect()} == want
        assert {r["seq"]: r["is_late"] for r in late_split(df, "arrival", "seq", bucket=bucket).collect()} == late
    assert 5 < sum(late.values()) < 200


# ------------------------------------------------------------------ rankings on runs

@pytest.mark.parametrize("block", [1, 7, 24])
def test_top_n_on_runs_equals_top_n_on_rows(spark, block):
    rng = random.Random(block)
    hits = [(rng.choice("abcdefghij") if rng.random() < 0.9 else None, 1_700_000_000 + int(rng.expovariate(1 / 900)) % 5000) for _ in range(400)]
    df = spark.createDataFrame(hits, "url string, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    for n in (1, 3, 30):
        got = T.top_n_segments(count_segments(df, "ts", "10 minutes", "5 seconds", ["url"]), n, "5 seconds", "url", block=block)
        want = T.top_n(sliding_agg(df, "ts", "10 minutes", "5 seconds", ["url"], plan="pane"), n, id_col="url")
        key = lambda r: tuple((x is not None, x) for x in r)             # noqa: E731
        assert sorted(map(tuple, got.select("url", "window_end", "cnt", "row_num").collect()), key=key) == sorted(
            map(tuple, want.select("url", "window_end", "cnt", "row_num").collect()), key=key)


def test_top_n_on_runs_ranks_a_tenth_of_the_rows(spark):
    """500 pages with steady traffic, the hot ones far ahead: few runs are left to rank."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.pmod(F.xxhash64("id"), F.lit(5))).otherwise(F.pmod(F.xxhash64("id"), F.lit(500))).cast("string").alias("url"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") / 20).cast("long")).alias("ts"))
    segments = count_segments(df, "ts", "10 minutes", "5 seconds", ["url"])
    all_rows = segments.agg(F.sum((F.col("_hi") - F.col("_lo")) / 5_000_000)).first()[0]
    spans = T.ranked_spans(segments, 3, "5 seconds", "url")
    assert spans.count() * 10 < all_rows
