"""foreachBatch writers are plain functions: drive them batch by batch."""

from pyspark.sql import functions as F

from evtlens.streaming import sinks, store
from evtlens.streaming.eventtime import split_late
from tests.streaming_util import scratch


def test_topn_writer_changelog_retracts(spark):
    out = scratch()
    fn = sinks.topn_writer(out, 2, "item_id")
    b0 = spark.createDataFrame([(1000, 1, 5), (1000, 2, 4), (1000, 3, 1)], "window_end bigint, item_id bigint, cnt bigint")
    fn(b0, 0)
    # late update of item 3 (update mode): it overtakes item 2
    b1 = spark.createDataFrame([(1000, 3, 9)], "window_end bigint, item_id bigint, cnt bigint")
    fn(b1, 1)
    top = sorted((r.item_id, r.cnt, r.row_num) for r in sinks.read_top(spark, out).collect())
    assert top == [(1, 5, 2), (3, 9, 1)]
    log = spark.read.parquet(f"{out}/changelog").where("batch = 1")
    got = sorted((r.op, r.item_id, r.cnt, r.row_num) for r in log.collect())
    assert got == [("+", 1, 5, 2), ("+", 3, 9, 1), ("-", 1, 5, 1), ("-", 2, 4, 2)]


def test_keyed_upsert_newest_wins_and_replay_is_idempotent(spark):
    out = scratch()
    fn = sinks.keyed_upsert(out, ["window_end"], "cnt")
    fn(spark.createDataFrame([(1, 3), (1, 4), (2, 1)], "window_end bigint, cnt bigint"), 0)
    fn(spark.createDataFrame([(1, 7)], "window_end bigint, cnt bigint"), 1)
    fn(spark.createDataFrame([(1, 7)], "window_end bigint, cnt bigint"), 1)  # replay of batch 1
    got = sorted(tuple(r) for r in sinks.read_upserted(spark, out, ["window_end"], "cnt")
                 .select("window_end", "cnt").collect())
    assert got == [(1, 7), (2, 1)]


def test_route_writer(spark):
    out = scratch()
    fn = sinks.route_writer(out)
    fn(spark.createDataFrame([(1, "main"), (2, "late"), (3, "main")], "x bigint, route string"), 0)
    assert sorted(r.x for r in sinks.read_route(spark, out, "main").collect()) == [1, 3]
    assert [r.x for r in sinks.read_route(spark, out, "late").collect()] == [2]


def test_split_late(spark):
    # 10 min / 5 s windows, 1 min lateness: a row is late when its last window end
    # (pane start + 10 min) - 1 ms + 1 min <= watermark
    base = 1_700_000_000  # seconds, multiple of 5
    df = spark.createDataFrame([(base,), (base + 700,)], "s bigint").withColumn("ts", F.timestamp_seconds("s"))
    wm = (base + 600 + 60) * 1_000_000 - 1000
    on_time, late = split_late(df, wm, "ts")
    assert [r.s for r in late.collect()] == [base] and [r.s for r in on_time.collect()] == [base + 700]
    on_time, late = split_late(df, wm - 1, "ts")
    assert late.count() == 0


def test_console_sink_runs(spark):
    d = scratch()
    spark.createDataFrame([(1, "a")], "x bigint, y string").write.mode("overwrite").parquet(d)
    df = spark.readStream.schema("x bigint, y string").parquet(d)
    q = sinks.console(df.writeStream.option("checkpointLocation", scratch()).trigger(availableNow=True), "label")
    q.awaitTermination(120)
    assert q.exception() is None


COUNTS = "window_end bigint, item_id bigint, cnt bigint"
BATCHES = [[(1000, 1, 5), (1000, 2, 4), (1000, 3, 1)], [(1000, 3, 9), (90_000_000, 1, 2)], [(1000, 2, 11)]]


def _state(spark, out):
    top = sorted(tuple(r) for r in sinks.read_top(spark, out).select("window_end", "item_id", "cnt", "row_num").collect())
    log = sorted(tuple(r) for r in spark.read.parquet(f"{out}/changelog")
                 .select("batch", "window_end", "op", "item_id", "cnt", "row_num").collect())
    return top, log


def _run(spark, out, fail_at=None, every=10):
    """All batches, each tried twice; the first try of one stops before one of its writes."""
    fn = sinks.topn_writer(out, 2, "item_id", every=every)
    for i, rows in enumerate(BATCHES):
        df = spark.createDataFrame(rows, COUNTS)
        if fail_at and fail_at[0] == i:
            places, left = [(sinks, "_write"), (store.DayStore, "_put")], [fail_at[1]]
            kept = [getattr(x, n) for x, n in places]

            def stopping(f):
                def run(*args, **kw):
                    if not left[0]:
                        raise RuntimeError("stopped")
                    left[0] -= 1
                    return f(*args, **kw)
                return run

            for (x, n), f in zip(places, kept):
                setattr(x, n, stopping(f))
            try:
                fn(df, i)
            except RuntimeError:
                pass
            finally:
                for (x, n), f in zip(places, kept):
                    setattr(x, n, f)
        fn(df, i)
        fn(df, i)


def test_topn_writer_replays_give_the_same_store(spark):
    want = None
    for every, fails in ((10, [None, (1, 0), (1, 2)]), (1, [None, (1, 1), (1, 2), (1, 3), (2, 4)])):
        for fail_at in fails:
            out = scratch() + "/top"
            _run(spark, out, fail_at, every)
            got = _state(spark, out)
            want = want or got
            assert got == want
    assert [r for r in want[0] if r[0] == 1000] == [(1000, 2, 11, 1), (1000, 3, 9, 2)]
    assert not spark.sparkContext._jsc.sc().getRDDStorageInfo()      # nothing stays persisted


def test_day_store_reads_a_snapshot_and_a_short_tail(spark):
    out = scratch()
    s = store.DayStore(out, "t", lambda rows: rows.groupBy("t", "k").agg(F.max_by("v", "batch").alias("v")).select("t", "k", "v"), every=3)
    kind, want = "t bigint, k bigint, v bigint", {}
    for b in range(10):
        batch = [(1000, b % 4, b)] + ([(90_000_000, 7, b)] if b in (2, 6) else [])
        want.update({(t, k): v for t, k, v in batch})
        df = spark.createDataFrame(batch, kind)
        s.write(df, b, {t // 86_400_000 for t, *_ in batch})
        got = s.read(spark, [0, 1], b + 1, df.schema)
        assert {(r.t, r.k): r.v for r in got.collect()} == want
        assert all(len(s.parts(spark, d, b + 1)[1]) < 3 for d in (0, 1))
    assert s.parts(spark, 0, 100)[0] == 8 and s.parts(spark, 1, 100) == (None, [2, 6])
    assert {(r.t, r.k): r.v for r in s.read(spark, [0], 8, df.schema).collect()} == {(1000, 0): 4, (1000, 1): 5, (1000, 2): 6, (1000, 3): 7}
    assert len(s._list(spark, "current/0")) == 2 and s.read(spark, [5], 9, df.schema).count() == 0


def test_topn_writer_does_not_hide_read_errors(spark):
    out = scratch() + "/top"
    fn = sinks.topn_writer(out, 2, "item_id")
    fn(spark.createDataFrame(BATCHES[0], COUNTS), 0)
    bad = spark.createDataFrame([(1000, 3, 9, "x")], COUNTS + ", extra string")
    fn(bad, 1)         # the stored rows lack the column: read as null, none is dropped
    assert sorted((r.item_id, r.cnt) for r in sinks.read_top(spark, out).collect()) == [(1, 5), (3, 9)]


def test_topn_writer_reads_touched_days_only(spark):
    out = scratch() + "/top"
    fn = sinks.topn_writer(out, 2, "item_id")
    fn(spark.createDataFrame([(1000, 1, 5)], COUNTS), 0)
    import glob
    for f in glob.glob(f"{out}/counts/segment/day=0/batch=0/*.parquet"):
        with open(f, "w") as x:
            x.write("not parquet")
    fn(spark.createDataFrame([(90_000_000, 1, 5)], COUNTS), 1)      # another day
    import pytest
    with pytest.raises(Exception):
        fn(spark.createDataFrame([(1000, 1, 6)], COUNTS), 2)


def test_late_writer_keeps_the_watermark_of_the_run(spark):
    out = scratch() + "/late"
    fn = sinks.late_writer(out, "ts", "1 second", "10 minutes", "5 seconds", "1 minute")
    base = 1_700_000_000
    for i, secs in enumerate([[base], [base + 3000], [base + 2400, base + 2000]]):
        df = spark.createDataFrame([(s,) for s in secs], "s bigint").withColumn("ts", F.timestamp_seconds("s"))
        fn(df, i)
        fn(df, i)
    main = sorted(r.s for r in spark.read.parquet(f"{out}/main").collect())
    late = sorted(r.s for r in spark.read.parquet(f"{out}/late").collect())
    assert main == [base, base + 2400, base + 3000] and late == [base + 2000]


def test_pane_topn_writer_equals_the_ranking_of_all_views(spark):
    """Panes in three updates, the last tried twice: rankings, changelog and reports of the newest counts, from one stored
    row a pane (a row of every window before)."""
    import random

    from evtlens.operators import rank, windows
    rng, L, kinds = random.Random(3), 300_000_000, "item_id bigint, _p bigint, cnt bigint"
    out, newest, stored = scratch(), {}, 0
    fn = sinks.pane_topn_writer(out, 3, "item_id", "1 hour", "5 minutes", then=sinks.top_reports(f"{out}/report", "item_id"))
    for b in range(3):
        rows = {(rng.choice([None, 1, 2, 3, 4, 5, 6]), (280 + rng.randrange(20)) * L): rng.randint(1 + 5 * b, 5 + 5 * b) for _ in range(25)}
        newest |= rows
        stored += len(rows)
        for _ in range(1 + (b == 2)):
            fn(spark.createDataFrame([(i, p, n) for (i, p), n in rows.items()], kinds), b)
    views = spark.createDataFrame([(i, p // 1_000_000) for (i, p), n in newest.items() for _ in range(n)], "item_id bigint, s bigint")
    counts = windows.sliding_agg(views.withColumn("ts", F.timestamp_seconds("s")), "ts", "1 hour", "5 minutes", ["item_id"], plan="window")
    want = rank.top_n(counts, 3).select("window_end", "item_id", "cnt", "row_num").collect()
    key = lambda r: (r["window_end"], r["row_num"])
    got = sinks.read_top(spark, out).select("window_end", "item_id", "cnt", "row_num").collect()
    assert sorted(got, key=key) == sorted(want, key=key) and len({r["window_end"] // store.DAY_MS for r in got}) == 2
    net = (spark.read.parquet(f"{out}/changelog").groupBy("window_end", "item_id", "cnt", "row_num")
           .agg(F.sum(F.when(F.col("op") == "+", 1).otherwise(-1)).alias("net")).where("net <> 0"))
    assert {r["net"] for r in net.collect()} == {1} and net.count() == len(want)
    reports = rank.ranking_report(spark.createDataFrame(want)).collect()
    assert sorted(sinks.read_upserted(spark, f"{out}/report", ["window_end"]).collect()) == sorted(reports)
    assert spark.read.parquet(f"{out}/panes/segment").count() == stored
