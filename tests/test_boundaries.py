"""Inclusive / exclusive limits of the pattern and join operators."""

from pyspark.sql import functions as F

from evtlens.operators import joins as J
from evtlens.operators import patterns as C
from evtlens.operators import rank as T

T0 = 1_600_000_000


def orders(spark, rows):
    return spark.createDataFrame(rows, "order_id bigint, event_type string, tx_id string, ts_sec bigint") \
        .withColumn("ts", F.timestamp_seconds("ts_sec"))


def receipts(spark, rows):
    return spark.createDataFrame(rows, "tx_id string, pay_channel string, ts_sec bigint") \
        .withColumn("ts", F.timestamp_seconds("ts_sec"))


def logins(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, login_state string, ts_sec bigint, seq bigint") \
        .withColumn("ts", F.timestamp_seconds("ts_sec"))


def test_interval_join_inclusive_bounds(spark):
    p = orders(spark, [(1, "pay", "a", T0), (2, "pay", "b", T0), (3, "pay", "c", T0), (4, "pay", "d", T0)])
    r = receipts(spark, [("a", "x", T0 - 3), ("b", "x", T0 + 5), ("c", "x", T0 - 4), ("d", "x", T0 + 6)])
    got = sorted(x.tx_id for x in J.tx_interval_join(p, r).collect())
    assert got == ["a", "b"]
    full = J.tx_full_match(p, r)
    assert sorted((x.route, x.tx_id) for x in full.collect()) == [
        ("matched", "a"), ("matched", "b"), ("unmatched-pays", "c"), ("unmatched-pays", "d"),
        ("unmatched-receipts", "c"), ("unmatched-receipts", "d")]


def test_interval_join_hot_key_across_buckets(spark):
    # many pays and receipts on one id spread over time: bucketing must neither lose
    # nor duplicate pairs
    pays = [(i, "pay", "hot", T0 + 7 * i) for i in range(60)]
    recs = [("hot", "w", T0 + 5 * j - 2) for j in range(90)]
    p, r = orders(spark, pays), receipts(spark, recs)
    got = sorted((x.order_id, x.receipt_time) for x in J.tx_interval_join(p, r).collect())
    exp = sorted((o, (t2) * 1000) for o, _, _, t1 in pays for _, _, t2 in recs if t1 - 3 <= t2 <= t1 + 5)
    assert got == exp


def test_order_timeout_exactly_15_minutes(spark):
    ev = orders(spark, [(1, "create", None, T0), (1, "pay", "t1", T0 + 900),
                        (2, "create", None, T0), (2, "pay", "t2", T0 + 899)])
    got = {r.order_id: r.result_state for r in C.order_pay_classify(ev, "15 minutes").collect()}
    assert got == {1: "payed but already timeout", 2: "payed successfully"}
    to = {r.order_id: r.result_state for r in C.cep_order_timeout(ev, "15 minutes").collect()}
    assert to == {1: f"timeout {(T0 + 900) * 1000}"}


def test_pay_before_create(spark):
    ev = orders(spark, [(7, "pay", "t", T0), (7, "create", None, T0 + 10)])
    got = sorted(r.result_state for r in C.order_pay_classify(ev, "15 minutes").collect())
    assert got == ["payed but not found created log", "timeout"]


def test_fail_pair_limits(spark):
    lg = logins(spark, [(1, "fail", T0, 1), (1, "fail", T0 + 2, 2),      # exactly 2 s: warn
                        (2, "fail", T0, 3), (2, "fail", T0 + 3, 4),      # 3 s: none
                        (3, "fail", T0, 5), (3, "success", T0 + 1, 6), (3, "fail", T0 + 2, 7)])
    assert [(r.user_id) for r in C.login_fail_pairs(lg, "2 seconds").collect()] == [1]


def test_third_fail_exactly_5s_no_match(spark):
    lg = logins(spark, [(1, "fail", T0, 1), (1, "fail", T0 + 1, 2), (1, "fail", T0 + 5, 3),
                        (2, "fail", T0, 4), (2, "fail", T0 + 1, 5), (2, "fail", T0 + 4, 6)])
    assert [r.user_id for r in C.cep_fail_times3(lg, "5 seconds").collect()] == [2]


def test_login_timer_success_cancels_within_limit(spark):
    lg = logins(spark, [(1, "fail", T0, 1), (1, "fail", T0 + 1, 2), (1, "success", T0 + 2, 3),
                        (2, "fail", T0, 4), (2, "fail", T0 + 1, 5), (2, "success", T0 + 3, 6),
                        (3, "fail", T0, 7), (3, "fail", T0 + 1, 8), (3, "fail", T0 + 2, 9),
                        (3, "fail", T0 + 3, 10), (3, "fail", T0 + 4, 11)])
    got = sorted((r.user_id, r.fail_count, r.first_fail_time // 1000)
                 for r in C.login_fail_timer(lg, "2 seconds", 2).collect())
    # user 3: segment [T0, T0+2] has 3 fails; T0+3 starts a new one with 2 fails
    assert got == [(2, 2, T0), (3, 2, T0 + 3), (3, 3, T0)]


def test_click_cap_100_101(spark):
    rows = [(1, 9, "p", "c", T0 + i) for i in range(102)]
    clicks = spark.createDataFrame(rows, "user_id bigint, ad_id bigint, province string, city string, ts_sec bigint") \
        .withColumn("ts", F.timestamp_seconds("ts_sec"))
    assert C.click_cap(clicks, 100).count() == 100
    bl = C.click_blacklist(clicks, 100).collect()
    assert len(bl) == 1 and bl[0].ts == (T0 + 100) * 1000


def test_topn_ties_by_id(spark):
    df = spark.createDataFrame([(1, 10, 5), (1, 11, 5), (1, 9, 5), (1, 12, 7)],
                               "window_end bigint, item_id bigint, cnt bigint")
    got = [(r.item_id, r.row_num) for r in T.top_n(df, 3).orderBy("row_num").collect()]
    assert got == [(12, 1), (9, 2), (10, 3)]


def _timer_row_by_row(rows, limit, least=2):
    """rows (user, state, us, seq): warnings (user, first, last, count) by one pass over each user's rows."""
    out = []
    for user in {r[0] for r in rows}:
        anchor, last, n = None, None, 0
        for _, state, u, _ in sorted((r for r in rows if r[0] == user), key=lambda r: r[2:]):
            if anchor is not None and u > anchor + limit:
                if n >= least:
                    out.append((user, anchor, last, n))
                anchor, n = None, 0
            if state != "fail":
                anchor, n = None, 0                      # a success within the span cancels it
            else:
                if anchor is None:
                    anchor = u
                last, n = u, n + 1
        if anchor is not None and n >= least:
            out.append((user, anchor, last, n))
    return sorted(out)


def _timer(spark, rows, limit_ms):
    df = spark.createDataFrame(rows, "user_id bigint, login_state string, u bigint, seq bigint").withColumn(
        "ts", F.timestamp_micros("u")).drop("u").repartition(3)
    return sorted((r.user_id, r.first_fail_time * 1000, r.last_fail_time * 1000, r.fail_count)
                  for r in C.login_fail_timer(df, f"{limit_ms} milliseconds", 2).collect())


def test_login_timer_equals_row_by_row_scan(spark):
    import random
    rng = random.Random(4)
    rows = []
    for user in range(150):
        t = 10_000 + rng.randint(0, 60)
        for seq in range(rng.randint(1, 60)):
            t += rng.choice([0, 0, 1, 2, 3, 5, 8, 9, 10, 30])
            rows.append((user, "success" if rng.random() < 0.12 else "fail", t * 1000, seq))
    want = _timer_row_by_row(rows, 9000)
    assert len(want) > 200 and _timer(spark, rows, 9) == want


def test_login_timer_one_user_in_one_endless_burst(spark):
    """Half of all rows are one burst of one user: a chain of 1,500 anchors, marked by doubling."""
    rows = [(7, "fail", (1_000_000 + 2 * i) * 1000, i) for i in range(6000)]
    rows += [(100 + i % 500, "fail" if i % 3 else "success", (1_000_000 + 3 * i) * 1000, i) for i in range(6000)]
    got = _timer(spark, rows, 7)
    assert got == _timer_row_by_row(rows, 7000)
    assert sum(g[0] == 7 for g in got) == 1500


def test_jump_pointers_follow_chains(spark):
    from evtlens.operators.jumps import reachable
    pointers = [(c, i, i + 1 + (i % 3 == 0)) for c in range(5) for i in range(c * 30)]
    df = spark.createDataFrame(pointers, "c int, i bigint, j bigint")
    heads = spark.createDataFrame([(c, 0) for c in range(5)], "c int, i bigint")
    want = set()
    step = {(c, i): j for c, i, j in pointers}
    for c in range(5):
        at = (c, 0)
        while at in step:
            at = (c, step[at])
            want.add(at)
    got = reachable(df, heads, ["c", "i"], ["c", "j"]).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert reachable(df.limit(0), heads, ["c", "i"], ["c", "j"]).count() == 0
