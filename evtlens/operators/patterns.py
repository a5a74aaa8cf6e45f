"""Sequence patterns over keyed event streams, batch form.

The keyed process functions and CEP patterns of the reference become window
functions over (key ORDER BY ts, seq), computed with the hot-key-safe helpers of
:mod:`evtlens.operators.sequence`, aggregates, bucketed interval joins and
partial top-k. Event-time order decides (CEP sorts by event time; for the
hand-written functions the reference's arrival order is replaced by (ts, seq)).
Output times are epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evtlens.functions.time import duration_us, epoch_us
from evtlens.operators.joins import interval_join
from evtlens.operators.jumps import reachable
from evtlens.operators.sequence import lag_within
from evtlens.session import cut_lineage

# Result texts of the reference jobs.
MSG_FAIL_PAIR = "login fail 2 times in 2s"
MSG_FAIL_TIMER = "login fail in 2s for{n}times"
MSG_CEP_FAILS = "login fail {n} times"
MSG_PAYED = "payed"
MSG_TIMEOUT = "timeout"
MSG_PAYED_OK = "payed successfully"
MSG_PAYED_LATE = "payed but already timeout"
MSG_NO_CREATE = "payed but not found created log"
MSG_BLACKLIST = "click over {cap}times."


def _order(df: DataFrame) -> list[str]:
    return ["ts", "seq"] if "seq" in df.columns else ["ts"]


def _us(c: str):
    return epoch_us(c)


# --------------------------------------------------------------------- logins

def login_fail_pairs(logins: DataFrame, limit="2 seconds", msg: str = MSG_FAIL_PAIR) -> DataFrame:
    """A fail whose previous event (same user) is a fail at most ``limit`` earlier
    -> (user_id, first_fail_time, last_fail_time, warning_msg). The newest fail is the
    next anchor, so overlapping pairs are all reported."""
    x = lag_within(logins, ["user_id"], _order(logins), ["login_state", "ts"], limit)
    hit = ((F.col("login_state") == "fail") & (F.col("login_state_lag1") == "fail")
           & (_us("ts") - _us("ts_lag1") <= F.lit(duration_us(limit))))
    return x.where(hit).select("user_id", F.unix_millis("ts_lag1").alias("first_fail_time"),
                               F.unix_millis("ts").alias("last_fail_time"),
                               F.lit(msg).alias("warning_msg"))


def cep_fail_times(logins: DataFrame, times: int = 3, within="5 seconds",
                   msg: str = MSG_CEP_FAILS) -> DataFrame:
    """``times`` strictly consecutive fails whose span is < ``within`` (CEP
    ``within`` is exclusive). Every overlapping match is reported (no skip strategy)."""
    k = times - 1
    x = lag_within(logins, ["user_id"], _order(logins), ["login_state", "ts"], within, k)
    hit = F.col("login_state") == "fail"
    for i in range(1, k + 1):
        hit = hit & (F.col(f"login_state_lag{i}") == "fail")
    hit = hit & (_us("ts") - _us(f"ts_lag{k}") < F.lit(duration_us(within)))
    return x.where(hit).select("user_id", F.unix_millis(f"ts_lag{k}").alias("first_fail_time"),
                               F.unix_millis("ts").alias("last_fail_time"),
                               F.lit(msg.format(n=times)).alias("warning_msg"))


def cep_fail_next(logins: DataFrame, within="3 seconds") -> DataFrame:
    """Fail strictly followed by a fail within 3 s (defined, not wired, in the reference)."""
    return cep_fail_times(logins, 2, within)


def cep_fail_times3(logins: DataFrame, within="5 seconds") -> DataFrame:
    """C4: three consecutive fails within 5 s."""
    return cep_fail_times(logins, 3, within)


def _fail_spans(logins: DataFrame, limit_us: int) -> DataFrame:
    """One row per fail of a burst: its key (user_id, u, q); ``head`` when it surely is an anchor
    (no fail within the limit right before it); ``dropped`` when a success comes within its span; and the
    first fail beyond its span (nu, nq) if that can be the next anchor.

    A burst is a stretch of fails each within the limit of the one before. One shuffle: time buckets
    of eight limits, with the rows two limits behind and one before copied in. A probe is put behind each fail's
    span, so that what follows the span is the last row seen by a window in falling order."""
    width = 8 * limit_us
    rows = logins.select(
        "user_id", _us("ts").alias("u"), (F.col("seq") if "seq" in logins.columns else F.monotonically_increasing_id()).alias("q"),
        (F.col("login_state") == "fail").alias("fail"))
    own = F.floor(F.col("u") / width)
    inside = F.pmod("u", F.lit(width))
    rows = rows.withColumn("own", own).withColumn("b", F.explode(F.array_compact(F.array(
        F.col("own"), F.when(inside <= 2 * limit_us, F.col("own") - 1), F.when(inside >= width - limit_us, F.col("own") + 1)))))
    up = Window.partitionBy("user_id", "b").orderBy("u", "q")
    good = F.count(F.when(~F.col("fail"), 1))
    rows = rows.withColumns({
        "after_fail": F.coalesce(F.lag("fail").over(up) & (F.col("u") - F.lag("u").over(up) <= limit_us), F.lit(False)),
        "before_fail": F.coalesce(F.lead("fail").over(up) & (F.lead("u").over(up) - F.col("u") <= limit_us), F.lit(False)),
        "s": good.over(up.rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.withColumn("head", F.col("fail") & ~F.col("after_fail"))
    probe = (F.col("b") == F.col("own")) & F.col("fail") & (F.col("after_fail") | F.col("before_fail"))
    both = rows.withColumn("t", F.explode(F.array_compact(F.array(F.col("u"), F.when(probe, F.col("u") + limit_us + 1)))))
    both = both.withColumn("is_row", F.col("t") == F.col("u"))
    along = Window.partitionBy("user_id", "b").orderBy("t", "is_row", "q").rowsBetween(Window.unboundedPreceding, 0)
    back = (Window.partitionBy("user_id", "b").orderBy(F.col("t").desc(), F.col("is_row").desc(), F.col("q").desc())
            .rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumns({
        "seen": F.count(F.when(F.col("is_row") & ~F.col("fail"), 1)).over(along),
        "next": F.last(F.when(F.col("is_row") & F.col("fail"), F.struct("u", "q", "head")), ignorenulls=True).over(back)})
    leads = (F.col("seen") == F.col("s")) & ~F.col("next.head") & (F.col("next.u") <= F.col("u") + 2 * limit_us)
    return both.where(~F.col("is_row")).select(
        "user_id", "u", "q", "head", (F.col("seen") > F.col("s")).alias("dropped"),
        F.when(leads, F.col("next.u")).alias("nu"), F.when(leads, F.col("next.q")).alias("nq"))


def login_fail_timer(logins: DataFrame, limit="2 seconds", min_fails: int = 2, msg: str = MSG_FAIL_TIMER) -> DataFrame:
    """Timer variant - anchor at a fail, ``limit`` later warn once with first, last
    and count if >= ``min_fails`` (two at least) fails came and no success did.

    Whatever came before, a fail is an anchor if no fail lies within the limit right before it. From
    such heads anchors follow one another: the next is the first fail beyond the span, unless a
    success comes before. :func:`evtlens.operators.jumps.reachable` marks them by doubling these pointers, so
    an endless burst of one user is no sequential work. Then each fail goes to the last anchor at or
    before it (time buckets again, anchors copied into the next one) and partial aggregates count the spans.
    A table without ``seq`` takes rows of one time in any order."""
    if min_fails < 2:
        raise ValueError("min_fails is two at least")
    lim = duration_us(limit)
    key = ["user_id", "u", "q"]
    fails = cut_lineage(_fail_spans(logins, lim), "fail-spans")
    pointers = fails.where("nu is not null").dropDuplicates(key)
    found = reachable(pointers, fails.where("head and nu is not null").dropDuplicates(key), key, ["user_id", "nu", "nq"])
    fails = fails.join(found.withColumn("found", F.lit(True)), key, "left")
    anchor = F.col("head") | F.coalesce("found", F.lit(False))
    width = 4 * lim
    own = F.floor(F.col("u") / width)
    rows = (fails.withColumns({"anchor": anchor, "own": own}).withColumn("b", F.explode(F.array_compact(F.array(
        F.col("own"), F.when(F.col("anchor") & (F.pmod("u", F.lit(width)) >= width - lim), F.col("own") + 1))))))
    up = Window.partitionBy("user_id", "b").orderBy("u", "q").rowsBetween(Window.unboundedPreceding, 0)
    rows = (rows.withColumn("of", F.last(F.when(F.col("anchor"), F.struct("u", "q")), ignorenulls=True).over(up))
            .where((F.col("b") == F.col("own")) & (F.col("u") <= F.col("of.u") + lim)))
    first = (F.col("u") == F.col("of.u")) & (F.col("q") == F.col("of.q"))
    spans = rows.groupBy("user_id", "of").agg(
        F.count(F.lit(1)).alias("fail_count"), F.max("u").alias("last"), F.max(F.when(first, F.col("dropped"))).alias("dropped"))
    return spans.where((F.col("fail_count") >= min_fails) & ~F.col("dropped")).select(
        "user_id", F.floor(F.col("of.u") / 1000).alias("first_fail_time"), F.floor(F.col("last") / 1000).alias("last_fail_time"),
        "fail_count", F.format_string(msg.format(n="%d"), "fail_count").alias("warning_msg"))


# --------------------------------------------------------------------- orders

def _creates(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "create").select("order_id", F.col("ts").alias("c_ts"))


def _pays(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "pay").select(
        F.col("order_id").alias("order_id"), F.col("ts").alias("p_ts"))


def cep_order_routed(events: DataFrame, within="15 minutes", bucket=None) -> DataFrame:
    """C5 + C6: every create followed by a pay of the same order with
    0 <= pay - create < ``within`` is 'payed'; every other create times out with
    'timeout <create + within, epoch ms>' -> (order_id, result_state, route)."""
    w = duration_us(within)
    c, p = _creates(events), _pays(events)
    payed = interval_join(c, p, ["order_id"], "c_ts", "p_ts", "0 seconds",
                          f"{w - 1} microseconds", "left_semi", bucket)
    timed = interval_join(c, p, ["order_id"], "c_ts", "p_ts", "0 seconds",
                          f"{w - 1} microseconds", "left_anti", bucket)
    return (payed.select("order_id", F.lit(MSG_PAYED).alias("result_state"), F.lit("main").alias("route"))
            .unionByName(timed.select(
                "order_id",
                F.concat(F.lit(MSG_TIMEOUT + " "), (F.unix_millis("c_ts") + F.lit(w // 1000)).cast("string"))
                .alias("result_state"), F.lit("order-timeout").alias("route"))))


def cep_order_pay(events: DataFrame, within="15 minutes") -> DataFrame:
    """The matched side."""
    return cep_order_routed(events, within).where("route = 'main'").drop("route")


def cep_order_timeout(events: DataFrame, within="15 minutes") -> DataFrame:
    """The timed-out side."""
    return cep_order_routed(events, within).where("route = 'order-timeout'").drop("route")


def order_pay_classify(events: DataFrame, within="15 minutes") -> DataFrame:
    """Per order, one or two of 'payed successfully' / 'payed but already timeout' /
    'timeout' / 'payed but not found created log' -> (order_id, result_state, route).

    The earliest create counts; the first pay at or after it decides (strictly less
    than ``within`` is in time); a pay before any create is reported as not found and
    the create then waits for a later pay. One join of the events with the earliest create
    per order (a partial aggregate; adaptive execution splits an order with very many
    events) and one aggregation on the same key."""
    w = duration_us(within)
    c = _creates(events).groupBy("order_id").agg(F.min("c_ts").alias("c_ts"))
    pay = F.col("event_type") == "pay"
    after = F.col("c_ts").isNotNull() & (F.col("ts") >= F.col("c_ts"))
    j = (events.where(F.col("event_type").isin("create", "pay")).select("order_id", "event_type", "ts")
         .join(c, "order_id", "left").groupBy("order_id")
         .agg(F.max("c_ts").alias("c_ts"), F.min(F.when(pay & after, F.col("ts"))).alias("p_ts"),
              F.max(F.when(pay & ~after, F.lit(1))).alias("orphan")))
    created = F.col("c_ts").isNotNull()
    main = (F.when(created & F.col("p_ts").isNotNull()
                   & (_us("p_ts") - _us("c_ts") < F.lit(w)), F.lit(MSG_PAYED_OK)))
    side = (F.when(created & F.col("p_ts").isNotNull()
                   & (_us("p_ts") - _us("c_ts") >= F.lit(w)), F.lit(MSG_PAYED_LATE))
            .when(created & F.col("p_ts").isNull(), F.lit(MSG_TIMEOUT)))
    orphan = F.when(F.col("orphan") == 1, F.lit(MSG_NO_CREATE))
    res = F.array(
        F.struct(main.alias("result_state"), F.lit("main").alias("route")),
        F.struct(side.alias("result_state"), F.lit("order-timeout").alias("route")),
        F.struct(orphan.alias("result_state"), F.lit("order-timeout").alias("route")))
    return (j.select("order_id", F.explode(res).alias("r"))
            .where(F.col("r.result_state").isNotNull())
            .select("order_id", "r.result_state", "r.route"))


# --------------------------------------------------------------------- clicks

def click_cap_routed(clicks: DataFrame, cap: int = 100, period="1 day",
                     zone_offset: str = "+08:00") -> DataFrame:
    """D1 + D2: per (user, ad, calendar period in ``zone_offset``) pass the first ``cap``
    clicks (route 'main'); click ``cap + 1`` raises one blacklist warning (route
    'blacklist'); later clicks are dropped. ``period=None`` never resets.

    ``row_number() <= cap + 1`` plans as a partial WindowGroupLimit before the shuffle,
    so a (user, ad) pair with millions of clicks ships at most cap + 1 rows per task."""
    if period is None:
        per = F.lit(0).cast("bigint")
    else:
        local = F.from_utc_timestamp(F.col("ts"), zone_offset)
        per = time_bucket_expr(local, period)
    order = [F.col(c).asc() for c in _order(clicks)]
    w = Window.partitionBy("user_id", "ad_id", "_period").orderBy(*order)
    x = (clicks.withColumn("_period", per)
         .withColumn("_n", F.row_number().over(w))
         .where(F.col("_n") <= cap + 1))
    return (x.withColumn("route", F.when(F.col("_n") <= cap, "main").otherwise("blacklist"))
            .withColumn("warning_msg", F.when(F.col("_n") > cap, F.lit(MSG_BLACKLIST.format(cap=cap))))
            .drop("_n", "_period"))


def time_bucket_expr(ts_col, period):
    b = duration_us(period)
    u = F.unix_micros(ts_col)
    return ((u - F.pmod(u, F.lit(b))) / F.lit(b)).cast("bigint")


def click_cap(clicks: DataFrame, cap: int = 100, period="1 day", zone_offset="+08:00") -> DataFrame:
    """The clicks that pass the cap (main output)."""
    return (click_cap_routed(clicks, cap, period, zone_offset).where("route = 'main'")
            .drop("route", "warning_msg"))


def click_blacklist(clicks: DataFrame, cap: int = 100, period="1 day", zone_offset="+08:00") -> DataFrame:
    """One warning per (user, ad, period) at click cap + 1 ->
    (user_id, ad_id, warning_msg, ts ms of the triggering click)."""
    x = click_cap_routed(clicks, cap, period, zone_offset).where("route = 'blacklist'")
    return x.select("user_id", "ad_id", "warning_msg", F.unix_millis("ts").alias("ts"))
