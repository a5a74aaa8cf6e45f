"""DuckDB oracle SQL for the registered queries (tables pre-registered as views).

The record mappings mirror :mod:`evtlens.sources.tables`; ``u`` is event time in
epoch microseconds. Sliding windows are ``unnest(generate_series(first_end,
last_end, slide))``. Greedy/iterative operators use a recursive CTE; the sketches
(``uv_approx``) are exact for as few visitors as the test tables have in an hour.
"""

from __future__ import annotations

from evtlens.functions.time import duration_us
from evtlens.operators.rank import ITEM_LABELS, REPORT_END_LABEL, REPORT_FOOTER, REPORT_HEADER
from evtlens.plans import params as P

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
IP = "'10.0.' || CAST(user_id % 256 AS VARCHAR) || '.1'"

UB = f"""ub AS (
  SELECT event_id AS seq, user_id, {K} AS item_id, CAST({K} % 10 AS INTEGER) AS category_id,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'cart' WHEN 'purchase' THEN 'buy'
                         WHEN 'signup' THEN 'fav' ELSE 'other' END AS behavior,
         epoch_us(ts) AS u
  FROM events)"""

URL = f"""CASE {K} % 10
    WHEN 0 THEN '/static/s' || CAST({K} AS VARCHAR) || '.css'
    WHEN 1 THEN '/js/app' || CAST({K} AS VARCHAR) || '.js'
    WHEN 2 THEN '/img/i' || CAST({K} AS VARCHAR) || '.png'
    WHEN 3 THEN '/favicon.ico'
    WHEN 4 THEN '/static/s' || CAST({K} AS VARCHAR) || '.css?v=1'
    ELSE '/page/' || CAST({K} AS VARCHAR) END"""

LOGS = f"""logs AS (
  SELECT event_id AS seq, {IP} AS ip, CAST(user_id AS VARCHAR) AS user_id,
         epoch_us(date_trunc('second', ts)) AS u,
         CASE WHEN event_type = 'signup' THEN 'POST' ELSE 'GET' END AS method, {URL} AS url
  FROM events)"""

LOGINS = f"""logins AS (
  SELECT event_id AS seq, user_id, {IP} AS ip,
         CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS login_state,
         epoch_us(ts) AS u
  FROM events)"""

CLICKS = f"""clicks AS (
  SELECT e.event_id AS seq, e.user_id, CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 3 AS ad_id,
         n.n_name AS province, c.c_mktsegment AS city, epoch_us(e.ts) AS u
  FROM events e
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  WHERE e.event_type = 'click')"""

MK = f"""mk AS (
  SELECT event_id AS seq, user_id,
         CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'DOWNLOAD'
                         WHEN 'purchase' THEN 'INSTALL' WHEN 'signup' THEN 'UNINSTALL'
                         ELSE 'CLICK' END AS behavior,
         (['app store', 'wechat', 'weibo'])[{K} % 3 + 1] AS channel,
         epoch_us(ts) AS u
  FROM events)"""

OE = """oe AS (
  SELECT o_orderkey AS order_id, 'create' AS event_type, CAST(NULL AS VARCHAR) AS tx_id,
         epoch_us(o_orderdate) AS u
  FROM orders
  UNION ALL
  SELECT l_orderkey, 'pay', 'tx' || CAST(l_orderkey AS VARCHAR), epoch_us(min(l_shipdate))
  FROM lineitem GROUP BY l_orderkey)"""

PAYS = """pays AS (
  SELECT event_id AS order_id, CAST(user_id AS VARCHAR) AS tx_id, epoch_us(ts) AS u
  FROM events WHERE event_type = 'purchase')"""

RC = f"""rc AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS tx_id,
         CASE WHEN {K} % 2 = 0 THEN 'alipay' ELSE 'wechat' END AS pay_channel, epoch_us(ts) AS u
  FROM events WHERE event_type = 'click')"""

HASH = ("list_reduce(list_transform(string_split(CAST({c} AS VARCHAR), ''), "
        "lambda ch: CAST(ascii(ch) AS BIGINT)), lambda a, b: (a * 61 + b) % 536870912)")


def us(spec) -> int:
    return duration_us(spec)


def sliding(src: str, keys: list[str], size, slide, where: str | None = None) -> str:
    """SELECT keys, window_end (ms), cnt for a sliding (or tumbling) window count."""
    S, L = us(size), us(slide)
    k = "".join(f"{c}, " for c in keys)
    w = f" WHERE {where}" if where else ""
    return (f"SELECT {k}we // 1000 AS window_end, count(*) AS cnt FROM ("
            f"SELECT {k}unnest(generate_series(u - u % {L} + {L}, u - u % {L} + {S}, {L})) AS we "
            f"FROM {src}{w}) GROUP BY {k}we")


def tumbling(src: str, keys: list[str], size, where: str | None = None) -> str:
    S = us(size)
    k = "".join(f"{c}, " for c in keys)
    w = f" WHERE {where}" if where else ""
    return (f"SELECT {k}(u - u % {S} + {S}) // 1000 AS window_end, count(*) AS cnt FROM {src}{w} "
            f"GROUP BY ALL")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _hot_items_top() -> str:
    h = P.HOT_ITEMS
    return (f"c AS ({sliding('ub', ['item_id'], h['size'], h['slide'], 'behavior = ' + chr(39) + 'pv' + chr(39))}),\n"
            f"top AS (SELECT item_id, window_end, cnt, row_num FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id ASC NULLS FIRST) "
            f"AS row_num FROM c) WHERE row_num <= {h['n']})")


DAY_US, ZONE_US = us(P.AD["period"]), 8 * 3_600_000_000      # calendar days at +08:00
CAPPED = (f"capped AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, (u + {ZONE_US}) // {DAY_US} "
          f"ORDER BY u, seq) AS n FROM clicks)")


def _province_counts() -> str:
    a = P.AD
    return f"pc AS ({sliding('capped', ['province'], a['size'], a['slide'], 'n <= ' + str(a['cap']))})"


def _page_counts(src: str = "logs", extra: str = "") -> str:
    h = P.HOT_PAGES
    where = "method = 'GET' AND NOT regexp_matches(url, '\\.(css|js|png|ico)$')" + extra
    return sliding(src, ["url"], h["size"], h["slide"], where)


def _uv_running() -> str:
    S = us(P.PV_WINDOW)
    return (f"pvb AS (SELECT (u - u % {S} + {S}) // 1000 AS window_end, {HASH.format(c='user_id')} AS bit, u "
            f"FROM ub WHERE behavior = 'pv'),\n"
            f"firsts AS (SELECT window_end, bit, min(u) AS u FROM pvb GROUP BY ALL),\n"
            f"runs AS (SELECT window_end, bit, u // 1000 AS first_ts, row_number() OVER "
            f"(PARTITION BY window_end ORDER BY u, bit) AS cnt FROM firsts)")


def _slices() -> str:
    """Events with the micro-batch they arrive in and the newest event time before it."""
    d, n = P.DELAY, P.SLICES
    return (f"arr AS (SELECT *, epoch_us(ts) AS u, epoch_us(ts) + CASE WHEN event_id % {d['every']} = 0 "
            f"THEN event_id * {d['factor']} % {d['hours']} ELSE 0 END * 3600000000 AS a FROM events),\n"
            f"sl AS (SELECT *, (a - (SELECT min(a) FROM arr)) * {n} // ((SELECT max(a) - min(a) + 1 FROM arr)) AS slice "
            f"FROM arr),\n"
            f"newest AS (SELECT s.slice, (SELECT max(u) FROM sl x WHERE x.slice < s.slice) AS seen FROM "
            f"(SELECT DISTINCT slice FROM sl) s)")


def _behind_watermark(bound) -> str:
    h = 3_600_000_000
    return (f"SELECT (u - u % {h} + {h}) // 1000 AS window_end, count(*) AS cnt FROM sl JOIN newest USING (slice) "
            f"WHERE seen IS NULL OR u - u % {h} + {h} > seen - {us(bound)} GROUP BY 1")


def _late() -> str:
    lt = P.LATE
    S, L, late, b = us(lt["size"]), us(lt["slide"]), us(lt["lateness"]), us(lt["bound"])
    return (f"late AS (SELECT l.*, COALESCE(l.u - l.u % {L} + {S} - 1000 + {late} <= seen_s - {b}, false) "
            f"AS is_late FROM logs l JOIN (SELECT event_id, seen - seen % 1000000 AS seen_s FROM sl "
            f"JOIN newest USING (slice)) x ON x.event_id = l.seq)")


def _login_timer() -> str:
    lim = us(P.LOGIN_TIMER["limit"])
    n = P.LOGIN_TIMER["min_fails"]
    return f"""RECURSIVE {LOGINS.replace('logins AS', 'lg AS', 1)},
ev AS (SELECT user_id, login_state AS s, u,
              row_number() OVER (PARTITION BY user_id ORDER BY u, seq) AS rn FROM lg),
st AS (
  SELECT user_id, rn,
         CASE WHEN s = 'fail' THEN u END AS a, CASE WHEN s = 'fail' THEN u END AS f,
         CASE WHEN s = 'fail' THEN u END AS l, CASE WHEN s = 'fail' THEN 1 ELSE 0 END AS n,
         CAST(NULL AS BIGINT) AS ef, CAST(NULL AS BIGINT) AS el, CAST(NULL AS BIGINT) AS en
  FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn,
         CASE WHEN e.s = 'fail' AND (st.a IS NULL OR e.u > st.a + {lim}) THEN e.u
              WHEN e.s = 'fail' THEN st.a END,
         CASE WHEN e.s = 'fail' AND (st.a IS NULL OR e.u > st.a + {lim}) THEN e.u
              WHEN e.s = 'fail' THEN st.f END,
         CASE WHEN e.s = 'fail' THEN e.u END,
         CASE WHEN e.s = 'fail' AND (st.a IS NULL OR e.u > st.a + {lim}) THEN 1
              WHEN e.s = 'fail' THEN st.n + 1 ELSE 0 END,
         CASE WHEN st.a IS NOT NULL AND e.u > st.a + {lim} AND st.n >= {n} THEN st.f END,
         CASE WHEN st.a IS NOT NULL AND e.u > st.a + {lim} AND st.n >= {n} THEN st.l END,
         CASE WHEN st.a IS NOT NULL AND e.u > st.a + {lim} AND st.n >= {n} THEN st.n END
  FROM st JOIN ev e ON e.user_id = st.user_id AND e.rn = st.rn + 1),
fin AS (SELECT st.* FROM st JOIN (SELECT user_id, max(rn) AS rn FROM ev GROUP BY user_id) m
        ON st.user_id = m.user_id AND st.rn = m.rn),
warn AS (SELECT user_id, ef AS f, el AS l, en AS n FROM st WHERE ef IS NOT NULL
         UNION ALL SELECT user_id, f, l, n FROM fin WHERE a IS NOT NULL AND n >= {n})
"""


def build() -> dict[str, str]:
    h, hp, a, mk, tx = P.HOT_ITEMS, P.HOT_PAGES, P.AD, P.MARKETING, P.TX
    pv = "behavior = 'pv'"
    S_pv = us(P.PV_WINDOW)
    q: dict[str, str] = {}

    # S
    sec = "u // 1000000 * 1000 AS ts"         # text records hold whole seconds
    q["read_user_behavior"] = with_(UB) + f"SELECT user_id, item_id, category_id, behavior, {sec} FROM ub"
    q["read_apache_log"] = with_(LOGS) + "SELECT seq, ip, user_id, u // 1000 AS ts, method, url FROM logs"
    q["read_ad_clicks"] = with_(CLICKS) + f"SELECT user_id, ad_id, province, city, {sec} FROM clicks"
    q["read_logins"] = with_(LOGINS) + f"SELECT user_id, ip, login_state, {sec} FROM logins"
    q["read_order_events"] = with_(OE) + f"SELECT order_id, event_type, tx_id, {sec} FROM oe"
    q["read_receipts"] = with_(RC) + f"SELECT tx_id, pay_channel, {sec} FROM rc"
    q["publish_lines_kafka"] = with_(UB) + (
        "SELECT CAST(user_id AS VARCHAR) || ',' || CAST(item_id AS VARCHAR) || ',' || "
        "CAST(category_id AS VARCHAR) || ',' || behavior || ',' || CAST(u // 1000000 AS VARCHAR) AS value FROM ub")
    q["read_kafka_lines"] = with_(UB) + (
        "SELECT user_id, item_id, category_id, behavior, u // 1000000 AS ts_sec FROM ub")
    q["sink_keyed_upsert"] = with_(UB, _uv_running()) + (
        "SELECT window_end, max(cnt) AS cnt FROM runs GROUP BY window_end")
    q["ranking_report"] = with_(UB, _hot_items_top()) + (
        f"SELECT window_end, '{REPORT_HEADER}' || chr(10) || '{REPORT_END_LABEL}' || "
        f"strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10) || "
        f"string_agg('NO ' || CAST(row_num AS VARCHAR) || ':' || '{ITEM_LABELS[0]}' || CAST(item_id AS VARCHAR) "
        f"|| '{ITEM_LABELS[1]}' || CAST(cnt AS VARCHAR) || chr(10), '' ORDER BY row_num) || "
        f"'{REPORT_FOOTER}' || chr(10) || chr(10) AS report FROM top GROUP BY window_end")
    q["route_side_outputs"] = with_(CLICKS, CAPPED) + (
        f"SELECT seq, user_id, ad_id, province, city, u // 1000 AS ts, "
        f"CASE WHEN n <= {a['cap']} THEN 'main' ELSE 'blacklist' END AS route, "
        f"CASE WHEN n > {a['cap']} THEN 'click over {a['cap']}times.' END AS warning_msg "
        f"FROM capped WHERE n <= {a['cap'] + 1}")

    # F / P
    q["filter_pv"] = with_(UB) + f"SELECT seq, user_id, item_id, u // 1000 AS ts FROM ub WHERE {pv}"
    q["filter_not_uninstall"] = with_(MK) + (
        "SELECT seq, user_id, behavior, channel, u // 1000 AS ts FROM mk "
        "WHERE behavior IS DISTINCT FROM 'UNINSTALL'")
    q["filter_get"] = with_(LOGS) + (
        "SELECT seq, ip, user_id, u // 1000 AS ts, method, url FROM logs WHERE method = 'GET'")
    q["filter_static_assets"] = with_(LOGS) + (
        "SELECT seq, ip, user_id, u // 1000 AS ts, method, url FROM logs "
        "WHERE NOT regexp_matches(COALESCE(url, ''), '\\.(css|js|png|ico)$')")
    q["filter_has_tx"] = with_(OE) + (
        "SELECT order_id, event_type, tx_id, u // 1000 AS ts FROM oe WHERE tx_id IS NOT NULL AND tx_id <> ''")
    q["filter_rank_le_n"] = with_(CLICKS, CAPPED, _province_counts()) + (
        f"SELECT * FROM (SELECT province, window_end, cnt, row_number() OVER (PARTITION BY window_end "
        f"ORDER BY cnt DESC, province ASC NULLS FIRST) AS row_num FROM pc) WHERE row_num <= {a['n']}")
    q["project_event_time"] = with_(UB) + (
        "SELECT seq, u // 1000000 AS ts_sec, (u // 1000000) * 1000 AS event_time_ms FROM ub")
    q["project_constant_key"] = with_(UB) + (
        f"SELECT seq, 'pv' AS key, CAST(1 AS BIGINT) AS one FROM ub WHERE {pv}")
    L5, S1 = us(h["slide"]), us(h["size"])
    q["project_window_end"] = with_(UB) + (
        f"SELECT seq, we // 1000 AS window_end FROM (SELECT seq, unnest(generate_series("
        f"u - u % {L5} + {L5}, u - u % {L5} + {S1}, {L5})) AS we FROM ub WHERE {pv})")
    q["format_window_end"] = with_(CLICKS, CAPPED, _province_counts()) + (
        "SELECT province, strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || '.0' "
        "AS window_end_text, cnt FROM pc")
    q["poly_hash"] = f"SELECT user_id, {HASH.format(c='user_id')} AS bit FROM (SELECT DISTINCT user_id FROM events)"

    # E
    q["watermark_ascending"] = with_(_slices()) + _behind_watermark(P.ASC_BOUND)
    q["watermark_bounded"] = with_(_slices()) + _behind_watermark(P.LATE_BOUND)
    q["late_events"] = with_(LOGS, _slices(), _late()) + "SELECT seq, u AS ts_us, is_late FROM late"
    q["allowed_lateness_update"] = with_(LOGS, _slices(), _late()) + _page_counts("late", " AND NOT is_late")

    lt = P.LATE
    before = "max(u) OVER (ORDER BY a, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    arrived = _slices().split(",\nsl AS")[0]
    q["watermark_batch"] = with_(arrived) + f"SELECT event_id, {before} - {us(P.LATE_BOUND)} AS watermark_us FROM arr"
    # the log's times are whole seconds, so what a row has seen is too
    q["late_events_batch"] = with_(LOGS, arrived) + (
        f"SELECT l.seq, l.u AS ts_us, COALESCE(l.u - l.u % {us(lt['slide'])} + {us(lt['size']) - 1000 + us(lt['lateness'])} <= "
        f"x.seen - x.seen % 1000000 - {us(lt['bound'])}, false) AS is_late FROM logs l JOIN "
        f"(SELECT event_id, {before} AS seen FROM arr) x ON x.event_id = l.seq")
    r = P.REFIRE
    S_r, L_r = us(r["size"]), us(r["slide"])
    q["late_refire"] = with_(LOGS, _slices()) + f""",
hits AS (SELECT slice, url, unnest(generate_series(l.u - l.u % {L_r} + {L_r}, l.u - l.u % {L_r} + {S_r}, {L_r})) // 1000 AS window_end
    FROM logs l JOIN sl ON sl.event_id = l.seq
    WHERE method = 'GET' AND NOT regexp_matches(url, '\\.(css|js|png|ico)$')),
per AS (SELECT slice, url, window_end, count(*) AS n FROM hits GROUP BY ALL),
run AS (SELECT *, sum(n) OVER (PARTITION BY url, window_end ORDER BY slice) AS cnt FROM per)
SELECT slice, '+' AS kind, url, window_end, cnt::BIGINT AS cnt FROM run
UNION ALL SELECT slice, '-', url, window_end, (cnt - n)::BIGINT FROM run WHERE cnt > n
UNION ALL SELECT NULL, 'state', url, window_end, sum(n)::BIGINT FROM per GROUP BY url, window_end"""
    q["late_refire"] = q["late_refire"].replace(")\n,\nhits AS", "),\nhits AS")

    # W
    q["tumbling_keyed"] = with_(UB) + tumbling("ub", ["behavior"], P.PV_WINDOW)
    q["tumbling_global"] = with_(UB) + tumbling("ub", [], P.PV_WINDOW)
    q["sliding_1h_5m"] = with_(UB) + sliding("ub", ["behavior"], "1 hour", "5 minutes")
    q["sliding_10m_5s"] = with_(LOGS) + sliding("logs", ["url"], "10 minutes", "5 seconds")
    q["sliding_1h_5s"] = with_(MK) + sliding("mk", ["channel"], "1 hour", "5 seconds")
    q["slide_table_api"] = with_(UB) + sliding("ub", ["item_id"], "1 hour", "5 minutes", pv)
    q["hop_sql"] = with_(UB) + sliding("ub", ["item_id"], "1 hour", "5 minutes", pv + " AND item_id IS NOT NULL")
    q["per_event_trigger"] = with_(UB) + (
        f"SELECT window_end, seq, u // 1000 AS ts, row_number() OVER (PARTITION BY window_end ORDER BY u, seq) "
        f"AS cnt FROM (SELECT seq, u, (u - u % {S_pv} + {S_pv}) // 1000 AS window_end FROM ub WHERE {pv})")

    # A
    q["item_view_count"] = with_(UB) + sliding("ub", ["item_id"], h["size"], h["slide"], pv)
    q["item_view_count_sql"] = with_(UB) + sliding("ub", ["item_id"], h["size"], h["slide"],
                                                  pv + " AND item_id IS NOT NULL")
    q["page_view_count"] = with_(LOGS) + _page_counts()
    q["pv_total_simple"] = with_(UB) + (
        f"SELECT 'pv' AS url, window_end, cnt FROM ({tumbling('ub', [], P.PV_WINDOW, pv)})")
    q["pv_total_salted"] = q["pv_total_simple"]
    q["uv_exact"] = with_(UB) + (
        f"SELECT 'uv' AS url, (u - u % {S_pv} + {S_pv}) // 1000 AS window_end, count(DISTINCT user_id) AS cnt "
        f"FROM ub WHERE {pv} GROUP BY 2")
    q["uv_bitmap"] = with_(UB) + (
        f"SELECT 'uv' AS url, (u - u % {S_pv} + {S_pv}) // 1000 AS window_end, "
        f"count(DISTINCT {HASH.format(c='user_id')}) AS cnt FROM ub WHERE {pv} GROUP BY 2")
    q["uv_approx"] = with_(UB) + (
        f"SELECT 'uv' AS url, (u - u % {S_pv} + {S_pv}) // 1000 AS window_end, count(DISTINCT user_id) AS cnt, "
        f"true AS within FROM ub WHERE {pv} GROUP BY 2")
    q["uv_approx_stream"] = q["uv_exact"]
    q["uv_bitmap_stream"] = q["uv_bitmap"]
    q["uv_bitmap_rows"] = with_(UB, _uv_running()) + (
        "SELECT window_end, CASE WHEN bit > 0 THEN 1 + (bit - 1) // 32768 ELSE 0 END AS bucket, count(*)::BIGINT AS n_bits "
        "FROM firsts2 GROUP BY ALL").replace("firsts2", "(SELECT DISTINCT window_end, bit FROM firsts)")
    q["uv_approx_sliding"] = with_(UB) + (
        f"SELECT 'uv' AS url, window_end, count(DISTINCT user_id) AS cnt FROM (SELECT user_id, unnest(generate_series("
        f"u - u % {L5} + {L5}, u - u % {L5} + {S1}, {L5})) // 1000 AS window_end FROM ub WHERE {pv}) GROUP BY ALL")
    q["uv_running"] = with_(UB, _uv_running()) + "SELECT window_end, bit, first_ts, cnt FROM runs"
    q["channel_behavior_count"] = with_(MK) + sliding(
        "mk", ["channel", "behavior"], mk["size"], mk["slide"], "behavior IS DISTINCT FROM 'UNINSTALL'")
    q["marketing_total"] = with_(MK) + (
        f"SELECT 'total' AS channel, 'total' AS behavior, window_end, cnt FROM ("
        f"{sliding('mk', [], mk['size'], mk['slide'], 'behavior IS DISTINCT FROM ' + chr(39) + 'UNINSTALL' + chr(39))})")
    q["province_ad_count"] = with_(CLICKS, CAPPED, _province_counts()) + "SELECT * FROM pc"

    # T
    q["hot_items_topn"] = with_(UB, _hot_items_top()) + "SELECT * FROM top"
    q["hot_items_topn_sql"] = q["hot_items_topn"]
    q["hot_pages_topn"] = with_(LOGS) + (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, "
        f"url ASC NULLS FIRST) AS row_num FROM ({_page_counts()})) WHERE row_num <= {hp['n']}")
    slide_ms = us(h["slide"]) // 1000
    q["topn_changelog"] = with_(UB, _hot_items_top()) + f""",
cur AS (SELECT window_end, item_id, cnt AS c1, row_num AS r1 FROM top),
prev AS (SELECT window_end + {slide_ms} AS window_end, item_id, cnt AS c0, row_num AS r0 FROM top),
j AS (SELECT COALESCE(cur.window_end, prev.window_end) AS window_end,
             COALESCE(cur.item_id, prev.item_id) AS item_id, c1, r1, c0, r0,
             (c1 IS NOT DISTINCT FROM c0 AND r1 IS NOT DISTINCT FROM r0) AS same
      FROM cur FULL OUTER JOIN prev ON cur.window_end = prev.window_end AND cur.item_id = prev.item_id)
SELECT window_end, '+' AS op, item_id, c1 AS cnt, r1 AS row_num FROM j WHERE c1 IS NOT NULL AND NOT same
UNION ALL
SELECT window_end, '-' AS op, item_id, c0 AS cnt, r0 AS row_num FROM j WHERE c0 IS NOT NULL AND NOT same"""
    q["topn_changelog"] = q["topn_changelog"].replace(")\n,\ncur AS", "),\ncur AS")

    # J
    lo, hi = us(tx["lower"]), us(tx["upper"])
    q["tx_interval_join"] = with_(PAYS, RC) + (
        f"SELECT p.tx_id, p.order_id, p.u // 1000 AS pay_time, r.pay_channel, r.u // 1000 AS receipt_time "
        f"FROM pays p JOIN rc r ON p.tx_id = r.tx_id AND r.u >= p.u + ({lo}) AND r.u <= p.u + ({hi})")
    q["tx_full_match"] = with_(PAYS, RC) + (
        f"SELECT p.tx_id, p.order_id, p.u // 1000 AS pay_time, r.pay_channel, r.u // 1000 AS receipt_time, "
        f"'matched' AS route FROM pays p JOIN rc r ON p.tx_id = r.tx_id AND r.u >= p.u + ({lo}) "
        f"AND r.u <= p.u + ({hi})\n"
        f"UNION ALL SELECT p.tx_id, p.order_id, p.u // 1000, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), "
        f"'unmatched-pays' FROM pays p WHERE NOT EXISTS (SELECT 1 FROM rc r WHERE r.tx_id = p.tx_id "
        f"AND r.u >= p.u + ({lo}) AND r.u <= p.u + ({hi}))\n"
        f"UNION ALL SELECT r.tx_id, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), r.pay_channel, r.u // 1000, "
        f"'unmatched-receipts' FROM rc r WHERE NOT EXISTS (SELECT 1 FROM pays p WHERE r.tx_id = p.tx_id "
        f"AND r.u >= p.u + ({lo}) AND r.u <= p.u + ({hi}))")

    # C / D
    lag1 = ("lx AS (SELECT *, lag(login_state, 1) OVER w AS s1, lag(u, 1) OVER w AS u1, "
            "lag(login_state, 2) OVER w AS s2, lag(u, 2) OVER w AS u2 FROM logins "
            "WINDOW w AS (PARTITION BY user_id ORDER BY u, seq))")
    q["login_fail_pairs"] = with_(LOGINS, lag1) + (
        f"SELECT user_id, u1 // 1000 AS first_fail_time, u // 1000 AS last_fail_time, "
        f"'login fail 2 times in 2s' AS warning_msg FROM lx WHERE login_state = 'fail' AND s1 = 'fail' "
        f"AND u - u1 <= {us(P.LOGIN_PAIR_LIMIT)}")
    q["cep_fail_next"] = with_(LOGINS, lag1) + (
        f"SELECT user_id, u1 // 1000 AS first_fail_time, u // 1000 AS last_fail_time, "
        f"'login fail 2 times' AS warning_msg FROM lx WHERE login_state = 'fail' AND s1 = 'fail' "
        f"AND u - u1 < {us(P.LOGIN_NEXT_WITHIN)}")
    q["cep_fail_times3"] = with_(LOGINS, lag1) + (
        f"SELECT user_id, u2 // 1000 AS first_fail_time, u // 1000 AS last_fail_time, "
        f"'login fail 3 times' AS warning_msg FROM lx WHERE login_state = 'fail' AND s1 = 'fail' "
        f"AND s2 = 'fail' AND u - u2 < {us(P.LOGIN_TIMES3_WITHIN)}")
    q["login_fail_timer"] = "WITH " + _login_timer() + (
        "SELECT user_id, f // 1000 AS first_fail_time, l // 1000 AS last_fail_time, CAST(n AS BIGINT) AS fail_count, "
        "'login fail in 2s for' || CAST(n AS VARCHAR) || 'times' AS warning_msg FROM warn")
    W = us(P.ORDER_WITHIN)
    cp = ("cr AS (SELECT order_id, u FROM oe WHERE event_type = 'create'), "
          "py AS (SELECT order_id, u FROM oe WHERE event_type = 'pay')")
    q["cep_order_pay"] = with_(OE, cp) + (
        f"SELECT c.order_id, 'payed' AS result_state FROM cr c WHERE EXISTS (SELECT 1 FROM py p "
        f"WHERE p.order_id = c.order_id AND p.u >= c.u AND p.u - c.u < {W})")
    q["cep_order_timeout"] = with_(OE, cp) + (
        f"SELECT c.order_id, 'timeout ' || CAST(c.u // 1000 + {W // 1000} AS VARCHAR) AS result_state FROM cr c "
        f"WHERE NOT EXISTS (SELECT 1 FROM py p WHERE p.order_id = c.order_id AND p.u >= c.u AND p.u - c.u < {W})")
    q["order_pay_classify"] = with_(OE) + f""",
c AS (SELECT order_id, min(u) AS cu FROM oe WHERE event_type = 'create' GROUP BY order_id),
p AS (SELECT order_id, u AS pu FROM oe WHERE event_type = 'pay'),
ps AS (SELECT p.order_id, min(CASE WHEN c.cu IS NOT NULL AND p.pu >= c.cu THEN p.pu END) AS pu,
              max(CASE WHEN c.cu IS NULL OR p.pu < c.cu THEN 1 END) AS orphan
       FROM p LEFT JOIN c ON p.order_id = c.order_id GROUP BY p.order_id),
j AS (SELECT COALESCE(c.order_id, ps.order_id) AS order_id, c.cu, ps.pu, ps.orphan
      FROM c FULL OUTER JOIN ps ON c.order_id = ps.order_id)
SELECT order_id, 'payed successfully' AS result_state, 'main' AS route FROM j
  WHERE cu IS NOT NULL AND pu IS NOT NULL AND pu - cu < {W}
UNION ALL SELECT order_id, 'payed but already timeout', 'order-timeout' FROM j
  WHERE cu IS NOT NULL AND pu IS NOT NULL AND pu - cu >= {W}
UNION ALL SELECT order_id, 'timeout', 'order-timeout' FROM j WHERE cu IS NOT NULL AND pu IS NULL
UNION ALL SELECT order_id, 'payed but not found created log', 'order-timeout' FROM j WHERE orphan = 1"""
    q["order_pay_classify"] = q["order_pay_classify"].replace(")\n,\nc AS", "),\nc AS")
    q["click_cap"] = with_(CLICKS, CAPPED) + (
        f"SELECT seq, user_id, ad_id, province, city, u // 1000 AS ts FROM capped WHERE n <= {a['cap']}")
    q["click_blacklist"] = with_(CLICKS, CAPPED) + (
        f"SELECT user_id, ad_id, 'click over {a['cap']}times.' AS warning_msg, u // 1000 AS ts "
        f"FROM capped WHERE n = {a['cap'] + 1}")
    q["stateful_apply"] = with_(CLICKS, CAPPED) + (
        f"SELECT user_id, ad_id, province, u // 1000 AS ts_ms, "
        f"CASE WHEN n <= {a['cap']} THEN 'main' ELSE 'blacklist' END AS route, "
        f"CASE WHEN n > {a['cap']} THEN 'click over {a['cap']}times.' END AS warning_msg "
        f"FROM capped WHERE n <= {a['cap'] + 1}")
    q["stateful_handover"] = q["stateful_apply"]
    q["final_flush"] = q["pv_total_simple"]
    q["sink_console"] = with_(UB) + f"SELECT 'pv' AS label, window_end, cnt FROM ({tumbling('ub', [], P.PV_WINDOW, pv)})"
    for name in ("province_ad_count", "login_fail_pairs", "cep_fail_next", "cep_fail_times3", "login_fail_timer",
                 "hot_pages_topn", "ranking_report", "tx_interval_join", "tx_full_match", "cep_order_pay", "cep_order_timeout",
                 "uv_running", "per_event_trigger"):
        q[f"{name}_stream"] = q[name]
    q["topn_changelog_stream"] = q["hot_items_topn"]
    # event by event: the state of an order is (create, decided, reported), carried from row to row
    q["order_pay_classify_stream"] = f"""WITH RECURSIVE oe AS (
  SELECT o_orderkey AS order_id, 0 AS kind, epoch_us(o_orderdate) AS u FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL SELECT l_orderkey, 1, epoch_us(l_shipdate) FROM lineitem),
ev AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY u, kind) AS rn FROM oe),
st AS (
  SELECT order_id, rn, CASE WHEN kind = 0 THEN u END AS created, false AS decided, kind = 1 AS reported,
         CASE WHEN kind = 1 THEN 'payed but not found created log' END AS said FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.order_id, e.rn, CASE WHEN e.kind = 0 AND st.created IS NULL THEN e.u ELSE st.created END,
         st.decided OR (e.kind = 1 AND st.created IS NOT NULL), st.reported OR (e.kind = 1 AND st.created IS NULL),
         CASE WHEN e.kind = 0 THEN NULL
              WHEN st.created IS NULL AND NOT st.reported THEN 'payed but not found created log'
              WHEN st.created IS NULL OR st.decided THEN NULL
              WHEN e.u - st.created < {W} THEN 'payed successfully' ELSE 'payed but already timeout' END
  FROM st JOIN ev e ON e.order_id = st.order_id AND e.rn = st.rn + 1),
fin AS (SELECT order_id, arg_max(created, rn) AS created, arg_max(decided, rn) AS decided FROM st GROUP BY order_id)
SELECT order_id, said AS result_state, CASE WHEN said = 'payed successfully' THEN 'main' ELSE 'order-timeout' END AS route
FROM st WHERE said IS NOT NULL
UNION ALL SELECT order_id, 'timeout', 'order-timeout' FROM fin WHERE created IS NOT NULL AND NOT decided"""
    return q


ORACLE_SQL = build()
