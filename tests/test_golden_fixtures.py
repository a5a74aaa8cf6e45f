"""Golden results on the reference's shipped sample files (expected values derived
independently from the CSVs, event-time semantics)."""

from collections import Counter

from evtlens.operators import aggregates as A
from evtlens.operators import joins as J
from evtlens.operators import patterns as C


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_order_pay_classify(order_log):
    out = C.order_pay_classify(order_log, "15 minutes")
    res = Counter(r.result_state for r in out.collect())
    assert res["payed successfully"] == 37
    by = {r.order_id: r.result_state for r in out.where("result_state <> 'payed successfully'").collect()}
    assert by == {34767: "payed but already timeout", 34756: "timeout",
                  34768: "payed but not found created log"}
    routes = Counter((r.route) for r in out.collect())
    assert routes == {"main": 37, "order-timeout": 3}


def test_cep_order_pay_and_timeout(order_log):
    payed = C.cep_order_pay(order_log, "15 minutes")
    assert payed.count() == 37
    assert rows(C.cep_order_timeout(order_log, "15 minutes"), "order_id", "result_state") == [
        (34756, "timeout 1558431813000"), (34767, "timeout 1558431849000")]


def test_tx_interval_join(order_log, receipt_log):
    out = J.tx_interval_join(order_log, receipt_log, "-3 seconds", "5 seconds")
    got = sorted((r.tx_id, (r.receipt_time - r.pay_time) // 1000) for r in out.collect())
    assert got == sorted([("sd76f87d6", 3), ("3hu3k2432", 3), ("3243hr9h9", -3), ("329d09f9f", 0)])


def test_tx_full_match(order_log, receipt_log):
    out = J.tx_full_match(order_log, receipt_log, "-3 seconds", "5 seconds")
    c = Counter(r.route for r in out.collect())
    assert c == {"matched": 4, "unmatched-pays": 35, "unmatched-receipts": 36}
    pays = {r.tx_id for r in out.where("route = 'unmatched-pays'").collect()}
    recs = {r.tx_id for r in out.where("route = 'unmatched-receipts'").collect()}
    # ids without any partner
    assert {"35jue34we", "88snrn932"} <= pays - recs
    assert {"ewr342as4", "8fdsfae83", "9032n4fd2"} <= recs - pays


def test_login_fail_pairs(login_log, login_log48):
    got = rows(C.login_fail_pairs(login_log, "2 seconds"), "user_id", "first_fail_time", "last_fail_time")
    assert got == [(1035, 1558430842000, 1558430843000)]
    got48 = rows(C.login_fail_pairs(login_log48, "2 seconds"), "user_id", "first_fail_time", "last_fail_time")
    assert got48 == [(1035, 1558430842000, 1558430843000), (1035, 1558430843000, 1558430845000)]


def test_cep_fail_times3(login_log, login_log48):
    assert C.cep_fail_times3(login_log, "5 seconds").count() == 0
    got = rows(C.cep_fail_times3(login_log48, "5 seconds"), "user_id", "first_fail_time", "last_fail_time",
               "warning_msg")
    assert got == [(1035, 1558430842000, 1558430845000, "login fail 3 times")]


def test_login_fail_timer(login_log, login_log48):
    assert C.login_fail_timer(login_log, "2 seconds", 2).count() == 0
    got = rows(C.login_fail_timer(login_log48, "2 seconds", 2), "user_id", "first_fail_time",
               "last_fail_time", "fail_count", "warning_msg")
    assert got == [(1035, 1558430842000, 1558430843000, 2, "login fail in 2s for2times")]


def test_click_cap_and_blacklist(ad_clicks):
    assert C.click_cap(ad_clicks, 100).count() == 122
    bl = C.click_blacklist(ad_clicks, 100).collect()
    assert [(r.user_id, r.ad_id, r.warning_msg, r.ts) for r in bl] == [
        (937166, 1715, "click over 100times.", 1511661701000)]


def test_province_ad_count(ad_clicks):
    out = A.province_ad_count(C.click_cap(ad_clicks, 100), "1 hour", "5 minutes")
    rs = out.collect()
    assert len(rs) == 99
    assert len({r.window_end for r in rs}) == 24
    assert sum(r.cnt for r in rs) == 1464
    bj = {r.window_end // 1000: r.cnt for r in rs if r.province == "beijing"}
    assert all(v == 2 for e, v in bj.items() if 1511658300 <= e <= 1511661600)
    assert all(v == 100 for e, v in bj.items() if 1511661900 <= e <= 1511665200)
