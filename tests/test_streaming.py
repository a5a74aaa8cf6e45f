"""Streams equal the batch operators (after the sentinel flush)."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from evtlens.operators import patterns as C
from evtlens.sources import schemas as S
from evtlens.sources import tables
from evtlens.streaming import jobs, sinks, stateful
from evtlens.streaming.eventtime import with_event_time
from tests.conftest import fixture_path
from tests.streaming_util import run_foreach, run_to_parquet, scratch, stage_files, write_text

SENTINEL = 4070908800  # 2099-01-01 in epoch seconds


def csv_stream(spark, folder, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).csv(folder)
            .withColumn("ts", F.timestamp_seconds("ts_sec")))


def read_all(spark, path):
    try:
        return spark.read.parquet(path).drop("batch")
    except Exception:
        return None


def test_click_cap_stream(spark):
    d = stage_files([(fixture_path("AdClickLog.csv"), "a.csv")])
    write_text(d, "z.csv", f"0,0,none,none,{SENTINEL}\n", 5)
    src = with_event_time(csv_stream(spark, d, S.AD_CLICK_CSV), "ts").withColumn("seq", F.lit(0).cast("bigint"))
    out = read_all(spark, run_to_parquet(stateful.click_cap_stream(src, 100)))
    routes = Counter(r.route for r in out.where("user_id <> 0").collect())
    assert routes == {"main": 122, "blacklist": 1}
    bl = out.where("route = 'blacklist'").first()
    assert (bl.user_id, bl.ad_id, bl.ts_ms) == (937166, 1715, 1511661701000)


@pytest.mark.parametrize("fname,expected", [("LoginLog48.csv", 2), ("LoginLog.csv", 1)])
def test_login_fail_pairs_stream(spark, fname, expected):
    d = stage_files([(fixture_path(fname), "a.csv")])
    write_text(d, "z.csv", f"0,0.0.0.0,success,{SENTINEL}\n", 5)
    src = with_event_time(csv_stream(spark, d, S.LOGIN_CSV), "ts", "3 seconds")
    out = read_all(spark, run_to_parquet(stateful.login_fail_pairs_stream(src, "2 seconds")))
    assert out.count() == expected


def test_login_fail_timer_stream(spark, login_log48):
    d = stage_files([(fixture_path("LoginLog48.csv"), "a.csv")])
    write_text(d, "z.csv", f"0,0.0.0.0,success,{SENTINEL}\n", 5)
    src = with_event_time(csv_stream(spark, d, S.LOGIN_CSV), "ts", "3 seconds")
    out = read_all(spark, run_to_parquet(stateful.login_fail_timer_stream(src, "2 seconds", 2)))
    got = sorted(tuple(r) for r in out.select("user_id", "first_fail_time", "last_fail_time", "fail_count").collect())
    exp = sorted(tuple(r) for r in C.login_fail_timer(login_log48, "2 seconds", 2)
                 .select("user_id", "first_fail_time", "last_fail_time", "fail_count").collect())
    assert got == exp == [(1035, 1558430842000, 1558430843000, 2)]


def test_order_pay_stream(spark, order_log):
    d = stage_files([(fixture_path("OrderLog.csv"), "a.csv")])
    write_text(d, "z.csv", f"0,create,,{SENTINEL}\n", 5)
    src = with_event_time(csv_stream(spark, d, S.ORDER_EVENT_CSV), "ts")
    out = read_all(spark, run_to_parquet(stateful.order_pay_classify_stream(src, "15 minutes")))
    got = sorted((r.order_id, r.result_state) for r in out.where("order_id <> 0").collect())
    exp = sorted((r.order_id, r.result_state) for r in C.order_pay_classify(order_log, "15 minutes").collect())
    assert got == exp


def test_tx_join_streams(spark):
    dp = stage_files([(fixture_path("OrderLog.csv"), "a.csv")])
    write_text(dp, "z.csv", f"0,pay,zz,{SENTINEL}\n", 5)
    dr = stage_files([(fixture_path("ReceiptLog.csv"), "a.csv")])
    write_text(dr, "z.csv", f"yy,x,{SENTINEL}\n", 5)
    pays = csv_stream(spark, dp, S.ORDER_EVENT_CSV)
    recs = csv_stream(spark, dr, S.RECEIPT_CSV)
    inner = read_all(spark, run_to_parquet(jobs.tx_match_stream(pays, recs, "-3 seconds", "5 seconds")))
    assert sorted(r.tx_id for r in inner.collect()) == sorted(["sd76f87d6", "3hu3k2432", "3243hr9h9", "329d09f9f"])
    full = read_all(spark, run_to_parquet(jobs.tx_match_stream(
        csv_stream(spark, dp, S.ORDER_EVENT_CSV), csv_stream(spark, dr, S.RECEIPT_CSV),
        "-3 seconds", "5 seconds", how="full_outer")))
    c = Counter(r.route for r in full.where("tx_id NOT IN ('zz', 'yy')").collect())
    assert c == {"matched": 4, "unmatched-pays": 35, "unmatched-receipts": 36}


def _events_stream_dir(spark, sentinels=("2099-01-01 00:00:00",)):
    src = "/root/testdata/sf0.001/events.parquet"
    d = stage_files([(src, "a.parquet")])
    ev = spark.read.parquet(src)
    import shutil, time
    for i, when in enumerate(sentinels):
        sentinel = spark.createDataFrame(
            [(-1, when, -1, "view", 0.0, '{"k": 0}')],
            "event_id bigint, t string, user_id bigint, event_type string, value double, props string") \
            .select("event_id", F.to_timestamp_ntz("t").alias("ts"), "user_id", "event_type", "value", "props")
        tmp = scratch()
        sentinel.coalesce(1).write.mode("overwrite").parquet(tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
        name = f"z{i}.parquet"
        shutil.copy(os.path.join(tmp, part), os.path.join(d, name))
        t = time.time() + 10 + i
        os.utime(os.path.join(d, name), (t, t))
    return d, ev.schema


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_hot_items_stream_topn_equals_batch(spark):
    d, schema = _events_stream_dir(spark)
    ub = tables.user_behavior_from(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))
    counts = jobs.item_view_count_stream(ub)
    out = scratch()
    run_foreach(counts, sinks.topn_writer(out, 5, "item_id"))
    got = sorted(tuple(r) for r in sinks.read_top(spark, out).select("item_id", "window_end", "cnt", "row_num").collect())
    import __spark_entry__ as E
    exp = sorted(tuple(r) for r in E.queries()["hot_items_topn"](spark, "/root/testdata/sf0.001").collect())
    assert got == exp
    log = spark.read.parquet(f"{out}/changelog")
    assert log.where("op = '-'").count() == 0 and log.count() == len(exp)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_uv_stream_and_keyed_upsert(spark):
    d, schema = _events_stream_dir(spark)
    ub = tables.user_behavior_from(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))
    out = scratch()
    run_foreach(jobs.uv_stream(ub, bitmap=True), sinks.keyed_upsert(out, ["window_end"], "cnt"))
    got = sorted(tuple(r) for r in sinks.read_upserted(spark, out, ["window_end"], "cnt")
                 .select("window_end", "cnt").where("window_end < 4070908800000").collect())
    import __spark_entry__ as E
    exp = sorted((r.window_end, r.cnt) for r in E.queries()["uv_bitmap"](spark, "/root/testdata/sf0.001").collect())
    assert got == exp


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_pane_rollup_stream_equals_batch(spark):
    from evtlens.functions.predicates import not_behavior
    # the roll-up emits windows up to the newest closed pane: a second, later sentinel
    # closes the first sentinel's pane and so flushes every real window
    d, schema = _events_stream_dir(spark, ("2099-01-01 00:00:00", "2099-01-02 00:00:00"))
    mk = tables.marketing_from(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))
    panes = jobs.pane_count_stream(mk.where(not_behavior("UNINSTALL")), ["channel", "behavior"], "5 seconds")
    out = scratch()
    run_foreach(panes, jobs.sliding_rollup_writer(out, ["channel", "behavior"], "1 hour", "5 seconds"))
    got = spark.read.parquet(f"{out}/windows").where("window_end < 4070908800000").drop("batch")
    got = sorted(tuple(r) for r in got.select("channel", "behavior", "window_end", "cnt").collect())
    import __spark_entry__ as E
    exp = sorted(tuple(r) for r in E.queries()["channel_behavior_count"](spark, "/root/testdata/sf0.001")
                 .select("channel", "behavior", "window_end", "cnt").collect())
    assert got == exp


def test_cep_order_stream(spark, order_log):
    d = stage_files([(fixture_path("OrderLog.csv"), "a.csv")])
    write_text(d, "z.csv", f"0,create,,{SENTINEL}\n", 5)
    src = csv_stream(spark, d, S.ORDER_EVENT_CSV)
    out = read_all(spark, run_to_parquet(jobs.cep_order_stream(src, "15 minutes")))
    got = sorted((r.order_id, r.result_state) for r in out.where("order_id <> 0").collect())
    exp = sorted((r.order_id, r.result_state) for r in
                 C.cep_order_pay(order_log, "15 minutes").unionByName(
                     C.cep_order_timeout(order_log, "15 minutes")).collect())
    assert got == exp and len(got) == 39


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_uv_running_stream_update_mode(spark):
    d, schema = _events_stream_dir(spark)
    ub = tables.user_behavior_from(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))
    out = scratch()
    run_foreach(jobs.uv_running_stream(ub), sinks.keyed_upsert(out, ["window_end"]), mode="update")
    got = sorted(tuple(r) for r in sinks.read_upserted(spark, out, ["window_end"])
                 .select("window_end", "cnt").where("window_end < 4070908800000").collect())
    import __spark_entry__ as E
    exp = sorted((r.window_end, r.cnt) for r in E.queries()["uv_bitmap"](spark, "/root/testdata/sf0.001").collect())
    assert got == exp


def test_hot_pages_allowed_lateness_update_mode(spark):
    """E3 + T3 + T4: a row 40 s behind the newest one is still accepted (delay = 1 s
    bound + 1 min lateness), updates its windows in update mode, and the top-n
    writer retracts the old counts and inserts the new ones."""
    import datetime as dt
    t0 = dt.datetime(2015, 5, 17, 10, 0, 0)

    def line(sec, url):
        t = (t0 + dt.timedelta(seconds=sec)).strftime("%d/%m/%Y:%H:%M:%S")
        return f"1.1.1.1 - - {t} +0000 GET {url}\n"

    d = scratch()
    write_text(d, "a.log", line(0, "/page/1") + line(1, "/page/2") + line(2, "/page/2"), 1)
    write_text(d, "b.log", line(100, "/page/3"), 2)
    write_text(d, "c.log", line(60, "/page/1"), 3)
    from evtlens.sources.text import parse_apache_log
    logs = parse_apache_log(spark.readStream.option("maxFilesPerTrigger", 1).text(d))
    counts = jobs.page_view_count_stream(logs, "10 minutes", "5 seconds", "1 second", "1 minute")
    out = scratch()
    run_foreach(counts, sinks.topn_writer(out, 3, "url"), mode="update")
    top = sinks.read_top(spark, out, id_col="url")
    base = int(t0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    w = base + 65_000  # window (t0 - 535 s, t0 + 65 s] holds t0 and t0 + 60 s
    got = sorted((r.url, r.cnt, r.row_num) for r in top.where(F.col("window_end") == w).collect())
    assert got == [("/page/1", 2, 1), ("/page/2", 2, 2)]
    log = spark.read.parquet(f"{out}/changelog").where(F.col("window_end") == w)
    ops = sorted((r.op, r.url, r.cnt) for r in log.collect())
    assert ("+", "/page/1", 2) in ops and ("-", "/page/1", 1) in ops


def click_slices(spark, batches):
    """Runs the click cap over micro-batches of (user, ts seconds); the last is the sentinel."""
    from evtlens.plans import streams
    schema = "user_id bigint, ad_id bigint, province string, city string, ts timestamp, seq bigint"
    parts = [spark.createDataFrame([(u, 1, "p", "c", t, i) for i, (u, t) in enumerate(b)],
                                   schema.replace("ts timestamp", "t bigint"))
             .select("user_id", "ad_id", "province", "city", F.timestamp_seconds("t").alias("ts"), "seq")
             for b in [*batches, [(-1, SENTINEL)]]]
    out = streams.to_table(spark, parts, lambda x: stateful.click_cap_stream(
        with_event_time(x, "ts", "2 hours"), 2, "1 day", "+08:00"), "clicks")
    rows = [r for r in out.collect() if r.user_id >= 0]
    batch = parts[0]
    for p in parts[1:-1]:
        batch = batch.unionByName(p)
    exp = C.click_cap_routed(batch, 2, "1 day", "+08:00").collect()
    return (sorted((r.user_id, r.ts_ms, r.route) for r in rows),
            sorted((r.user_id, int(r.ts.timestamp() * 1000) if r.ts.tzinfo else int((r.ts - __import__("datetime").datetime(
                1970, 1, 1)).total_seconds() * 1000), r.route) for r in exp))


def test_click_cap_midnight_between_and_inside_micro_batches(spark):
    """A day ends at 16:00 UTC; clicks of both days in one batch, in several, and clicks of
    the day before that come after the new day has begun, inside the watermark's bound."""
    midnight = 1_600_012_800                       # 2020-09-13 16:00 UTC
    one = [(1, midnight - 60)]
    several = [[(1, midnight + 60 * i)] for i in range(1, 7)]
    got, exp = click_slices(spark, [one, *several])
    assert got == exp and [r[2] for r in got].count("blacklist") == 1
    got, exp = click_slices(spark, [[(2, midnight - 30), (2, midnight + 10), (2, midnight + 20)],
                                    [(2, midnight - 20), (2, midnight + 30)], [(2, midnight - 10), (2, midnight - 5)]])
    assert got == exp and len(got) == 6


def _order_slices(spark, batches, wait="1 hour"):
    from evtlens.plans import streams
    parts = [spark.createDataFrame([(o, e, t) for o, e, t in b], "order_id bigint, event_type string, t bigint")
             .select("order_id", "event_type", F.timestamp_seconds("t").alias("ts")) for b in [*batches, [(-1, "other", SENTINEL)]]]
    out = streams.folder(spark, "orders")
    progress = streams.run(spark, parts, lambda x: stateful.order_pay_classify_stream(
        with_event_time(x, "ts", "1 hour"), "15 minutes", wait),
        lambda w: w.outputMode("append").format("parquet").option("path", out).start())
    rows = sorted((r.order_id, r.result_state) for r in spark.read.parquet(out).collect())
    return rows, [p["stateOperators"][0]["numRowsTotal"] for p in progress]


def test_order_stream_frees_its_state(spark):
    t = 1_600_000_000
    pairs = [(i, e, t + (5 if e == "pay" else 0)) for i in range(50) for e in ("create", "pay")]
    rows, state = _order_slices(spark, [pairs])
    assert rows == [(i, "payed successfully") for i in range(50)]
    assert max(state) > 0 and state[-1] == 0


def test_order_stream_pay_before_create_across_micro_batches(spark):
    """The pay (later in event time) comes a micro-batch earlier than its create."""
    t = 1_600_000_000
    batches = [[(1, "pay", t + 60), (2, "pay", t), (3, "create", t), (3, "pay", t + 1200), (3, "pay", t + 1300)],
               [(1, "create", t), (2, "create", t + 30), (4, "create", t)]]
    rows, _ = _order_slices(spark, batches)
    ev = spark.createDataFrame([r for b in batches for r in b], "order_id bigint, event_type string, t bigint").select(
        "order_id", "event_type", F.timestamp_seconds("t").alias("ts"))
    exp = sorted((r.order_id, r.result_state) for r in C.order_pay_classify(ev, "15 minutes").collect())
    assert rows == exp == [(1, "payed successfully"), (2, "payed but not found created log"), (2, "timeout"),
                           (3, "payed but already timeout"), (4, "timeout")]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_stream_queries_read_tables_of_many_files(spark):
    """events as a folder of part files gives the same rows as one file."""
    import __spark_entry__ as E
    d = scratch()
    for t in ("events", "customer", "nation"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
        df.repartition(4 if t == "events" else 1).write.parquet(f"{d}/{t}.parquet")
    for name in ("final_flush", "stateful_apply"):
        got = sorted(map(str, E.queries()[name](spark, d).collect()))
        exp = sorted(map(str, E.queries()[name](spark, "/root/testdata/sf0.001").collect()))
        assert got == exp and got


def test_empty_stream_is_an_error(spark):
    from evtlens.plans import streams
    df = spark.createDataFrame([], "event_id bigint, ts timestamp")
    with pytest.raises((RuntimeError, ValueError)):
        streams.cut(df, F.lit(1).cast("long"))
    with pytest.raises(RuntimeError):
        streams.to_table(spark, [df], lambda x: x, "none")
