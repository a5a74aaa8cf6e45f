"""U1 + streaming C1-C4, C7, D1/D2: keyed state with event-time timers
(``transformWithState``, RocksDB state store; Row based, C7 on frames).

Shared shape (:class:`InOrderProcessor`): rows wait in the key's state until the watermark
has passed them; the key's one timer then hands all that are due to ``step`` in order of
event time, so the outcome does not depend on how rows fell into micro-batches or on
their order inside the watermark's bound. Deadlines that the key's own state sets (period
end, time-out) are met in order with the rows. The state is read and written once a
micro-batch: few waiting rows lie in the value itself, many in sorted runs of blocks that
are merged block by block. A key's state is what the watermark's bound holds plus a few values,
and the timer frees both. Rows behind the watermark are dropped by the operator itself, so
late-row routing (E4) must happen before it.

C7 has very many keys of few rows each, so the state of many orders is one key's
(:class:`OrderShardProcessor`): the same waiting rows and deadlines, a column at a time.

Batch forms live in :mod:`evtlens.operators.patterns`; after the final flush of
:mod:`evtlens.streaming.eventtime` the streams have emitted the same rows.
"""

from __future__ import annotations

import datetime as _dt
import heapq
import json
import sys
from typing import Iterator, Sequence

import numpy as np
import pandas as pd

from pyspark import cloudpickle

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues,
)
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from evtlens.functions.time import duration_us, epoch_us
from evtlens.operators import patterns as P


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


_EPOCH = _dt.datetime(1970, 1, 1)
_US = _dt.timedelta(microseconds=1)


def _us(ts) -> int:
    # Row values of TIMESTAMP columns are UTC datetimes, with or without a zone (session zone UTC)
    return (ts.replace(tzinfo=None) - _EPOCH) // _US


def _time(u: int) -> _dt.datetime:
    return _EPOCH + _dt.timedelta(microseconds=u)


def stateful_apply(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor,
                   output: StructType, mode: str = "Append", event_time: str = "", initial: DataFrame | None = None) -> DataFrame:
    """Group by ``keys`` and run ``processor`` with event-time timers. ``event_time``
    names the output column that carries event time on to later operators. ``initial`` is a batch
    table with the same keys whose rows the processor takes as its first state, so that a stream can go on
    where a batch job stopped."""
    from evtlens.session import ship_package
    ship_package(df.sparkSession)
    # the processor is also unpickled by a driver-side Python process that does not see
    # added py-files: ship this module's classes by value (they only use plain values)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    conf = df.sparkSession.conf
    if "RocksDB" not in (conf.get("spark.sql.streaming.stateStore.providerClass", "") or ""):
        # transformWithState needs the RocksDB state store provider
        conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = df.groupBy(*keys)
    apply = rows.transformWithStateInPandas if getattr(processor, "FRAMES", False) else rows.transformWithState
    return apply(processor, output, mode, "EventTime", None if initial is None else initial.groupBy(*keys), event_time)


class InOrderProcessor(StatefulProcessor):
    """Buffers rows until the watermark has passed them and steps through them in event
    time. Subclasses give ``record`` (what to keep of a row: a list that starts with its time
    in microseconds; None drops it), ``step``, which changes the key's own state (a dict that JSON
    can hold; empty: none), ``deadline`` (the millisecond at which that state wants ``on_time``;
    None: never) and ``on_time``, which must move the deadline on.

    A key has one value: its own state, up to ``TAIL`` waiting rows, the index of the runs and
    the time of its timer. More rows than that are sorted, ``RUN`` at a time, and put in
    blocks of ``BLOCK``, which are read one at a time when their rows are due."""

    TAIL, RUN, BLOCK = 500, 20_000, 500

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # {"own": ..., "tail": [rows], "runs": [[[first ms, block], ...], ...], "next": block, "timer": ms}
        self.value = handle.getValueState("value", "v string")
        self.blocks = handle.getMapState("blocks", "block long", "rows string")

    def record(self, r: Row, own: dict) -> list | None:
        raise NotImplementedError

    def step(self, key, own: dict, rec: list) -> Iterator[Row]:
        raise NotImplementedError

    def deadline(self, own: dict) -> int | None:
        return None

    def on_time(self, key, own: dict, t: int) -> Iterator[Row]:
        return iter(())

    # ---- the key's value
    def _load(self) -> dict:
        found = self.value.get()
        return json.loads(found[0]) if found else {"own": {}, "tail": [], "runs": [], "next": 0, "timer": None}

    def _save(self, st: dict) -> None:
        self.value.update((json.dumps(st, separators=(",", ":")),))

    def _alarm(self, st: dict, t: int | None) -> None:
        if t is not None and (st["timer"] is None or t < st["timer"]):
            self.handle.registerTimer(t)
            st["timer"] = t

    def _spill(self, st: dict) -> None:
        rows, run = sorted(st["tail"], key=_at), []
        for at in range(0, len(rows), self.BLOCK):
            part = rows[at:at + self.BLOCK]
            self.blocks.updateValue((st["next"],), (json.dumps(part, separators=(",", ":")),))
            run.append([part[0][0] // 1000, st["next"]])
            st["next"] += 1
        st["runs"].append(run)
        st["tail"] = []

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        st, least, came = self._load(), None, False
        for r in rows:
            rec = self.record(r, st["own"])
            if rec is None:
                continue
            came = True
            st["tail"].append(rec)
            if least is None or rec[0] < least:
                least = rec[0]
            if len(st["tail"]) >= self.RUN:
                self._spill(st)
        if came:
            if len(st["tail"]) > self.TAIL:
                self._spill(st)
            self._alarm(st, least // 1000 + 1)
            self._save(st)
        return iter(())

    def _due(self, run: list, now: int) -> Iterator[list]:
        """The run's rows before ``now``; ``run`` keeps the blocks that still have others."""
        while run and run[0][0] < now:
            block = run[0][1]
            rows = json.loads(self.blocks.getValue((block,))[0])
            n = next((i for i, rec in enumerate(rows) if rec[0] // 1000 >= now), len(rows))
            yield from rows[:n]
            if n < len(rows):
                self.blocks.updateValue((block,), (json.dumps(rows[n:], separators=(",", ":")),))
                run[0][0] = rows[n][0] // 1000
                return
            self.blocks.removeKey((block,))
            run.pop(0)

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        st = self._load()
        if st["timer"] is None or st["timer"] > now:
            return                     # an earlier one has been set since
        own = st["own"]
        tail = sorted((rec for rec in st["tail"] if rec[0] // 1000 < now), key=_at)
        st["tail"] = [rec for rec in st["tail"] if rec[0] // 1000 >= now]
        for rec in heapq.merge(*[self._due(run, now) for run in st["runs"]], tail, key=_at):
            while (t := self.deadline(own)) is not None and t <= rec[0] // 1000:
                yield from self.on_time(key, own, t)
            yield from self.step(key, own, rec)
        while (t := self.deadline(own)) is not None and t <= now:
            yield from self.on_time(key, own, t)
        st["runs"] = [run for run in st["runs"] if run]
        if not own and not st["tail"] and not st["runs"]:
            self.value.clear()
            return
        waiting = [rec[0] // 1000 + 1 for rec in st["tail"]] + [run[0][0] + 1 for run in st["runs"]]
        wanted, st["timer"] = [*waiting, *([t] if (t := self.deadline(own)) is not None else [])], None
        self._alarm(st, min(wanted, default=None))
        self._save(st)

    def close(self) -> None:
        pass


def _at(rec: list) -> list:
    return rec[:2]


def _seq(r: Row) -> int:
    return (r["seq"] if "seq" in r else 0) or 0


# ------------------------------------------------------------------ D1 / D2

CLICK_OUT = StructType([StructField("user_id", LongType()), StructField("ad_id", LongType()),
                        StructField("province", StringType()), StructField("city", StringType()),
                        StructField("seq", LongType()), StructField("ts", TimestampType()),
                        StructField("ts_ms", LongType()), StructField("route", StringType()),
                        StructField("warning_msg", StringType())])


class ClickCapProcessor(InOrderProcessor):
    """Count clicks per (user, ad) and calendar period; pass the first ``cap`` (route
    'main'), warn once at click cap + 1 (route 'blacklist'). Each period has a count of
    its own, which the deadline at the period's end removes."""

    def __init__(self, cap: int, period_us: int | None, offset_us: int, msg: str):
        self.cap = cap
        self.period = period_us
        self.offset = offset_us
        self.msg = msg

    def _period(self, u: int) -> int:
        return 0 if self.period is None else (u + self.offset) // self.period

    def handleInitialState(self, key, initialState: Row, timerValues: TimerValues) -> None:
        st = self._load()
        for p, n in json.loads(initialState["counts"]):
            st["own"][str(p)] = min(n, self.cap + 1)
        self._alarm(st, self.deadline(st["own"]))
        self._save(st)

    def _period_end(self, p: int) -> int:
        return -(-((p + 1) * self.period - self.offset) // 1000)

    def record(self, r: Row, own):
        u = _us(r["ts"])
        if own.get(str(self._period(u)), 0) > self.cap:
            return None            # warned already; later clicks have no effect
        return [u, _seq(r), r["province"], r["city"] if "city" in r else None]

    def step(self, key, own, rec):
        u, seq, province, city = rec
        p = str(self._period(u))
        n = own.get(p, 0)
        if n > self.cap:
            return
        own[p] = n + 1
        main = n < self.cap
        yield Row(user_id=key[0], ad_id=key[1], province=province, city=city, seq=seq, ts=_time(u),
                  ts_ms=u // 1000, route="main" if main else "blacklist",
                  warning_msg=None if main else self.msg)

    def deadline(self, own):
        return self._period_end(min(map(int, own))) if own and self.period is not None else None

    def on_time(self, key, own, t):
        del own[str(min(map(int, own)))]
        return iter(())


def _offset_us(zone_offset: str) -> int:
    sign = -1 if zone_offset.startswith("-") else 1
    hh, mm = zone_offset.lstrip("+-").split(":")
    return sign * (int(hh) * 3600 + int(mm) * 60) * 1_000_000


def click_cap_stream(clicks: DataFrame, cap: int = 100, period="1 day", zone_offset="+08:00",
                     initial: DataFrame | None = None) -> DataFrame:
    """D1/D2 as a stream; ``ts`` of the output carries event time, so windowed
    aggregates can follow. ``initial``: what a batch job has counted (:func:`click_cap_state`); a pair's
    periods are handed over in one row."""
    proc = ClickCapProcessor(cap, duration_us(period) if period else None, _offset_us(zone_offset),
                             P.MSG_BLACKLIST.format(cap=cap))
    if initial is not None:
        initial = initial.groupBy("user_id", "ad_id").agg(
            F.to_json(F.collect_list(F.array(F.col("period").cast("long"), F.col("n").cast("long")))).alias("counts"))
    return stateful_apply(clicks, ["user_id", "ad_id"], proc, CLICK_OUT, event_time="ts", initial=initial)


def click_cap_state(clicks: DataFrame, cap: int = 100, period="1 day", zone_offset="+08:00") -> DataFrame:
    """The state that :func:`click_cap_stream` has after these clicks: (user_id, ad_id, period, n), one
    row per pair and period, counted with partial aggregates."""
    at = F.lit(0).cast("long") if not period else F.floor((epoch_us("ts") + _offset_us(zone_offset)) / duration_us(period))
    return (clicks.groupBy("user_id", "ad_id", at.alias("period")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("n", F.least("n", F.lit(cap + 1).cast("long"))))


# ------------------------------------------------------------------ in order: A9, W8

FIRST_OUT = StructType([StructField("window_end", LongType()), StructField("bit", LongType()), StructField("ts", TimestampType())])
ORDER_ROW_OUT = StructType([StructField("window_end", LongType()), StructField("seq", LongType()), StructField("ts", TimestampType())])


#: Keys that the rows of all windows are spread over: a key's state serves many rows of a
#: micro-batch at once, and a busy window is many keys.
SALTS = 1024


class FirstSeenProcessor(InOrderProcessor):
    """The first row of a (window_end, bit) in event time; the marks go when the window is over."""

    def record(self, r: Row, own):
        if str(r["bit"]) in own.get(str(r["window_end"]), ()):
            return None
        return [_us(r["ts"]), r["window_end"], r["bit"]]

    def step(self, key, own, rec):
        u, end, bit = rec
        seen = own.setdefault(str(end), {})
        if str(bit) not in seen:
            seen[str(bit)] = 1
            yield Row(window_end=end, bit=bit, ts=_time(u))

    def deadline(self, own):
        return min(map(int, own)) + 1 if own else None

    def on_time(self, key, own, t):
        del own[str(min(map(int, own)))]
        return iter(())


class InOrderRowsProcessor(InOrderProcessor):
    """The rows themselves, when the watermark has passed them."""

    def record(self, r: Row, own):
        return [_us(r["ts"]), r["window_end"], r["seq"]]

    def step(self, key, own, rec):
        yield Row(window_end=rec[1], seq=rec[2], ts=_time(rec[0]))


def first_seen_stream(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("bit"), F.lit(salts)).cast("int"))
    return stateful_apply(salted, ["salt"], FirstSeenProcessor(), FIRST_OUT, event_time="ts")


def in_order_stream(rows: DataFrame) -> DataFrame:
    return stateful_apply(rows, ["salt"], InOrderRowsProcessor(), ORDER_ROW_OUT, event_time="ts")


# ------------------------------------------------------------------ C1, C3, C4

WARN_OUT = StructType([StructField("user_id", LongType()), StructField("first_fail_time", LongType()),
                       StructField("last_fail_time", LongType()), StructField("warning_msg", StringType())])


class ConsecutiveFailsProcessor(InOrderProcessor):
    """``times`` fails in a row whose first and last are at most ``limit_us`` apart. Only the
    times of the last fails in a row are kept; a success or the limit clears them."""

    def __init__(self, times: int, limit_us: int, msg: str):
        self.times = times
        self.limit = limit_us
        self.msg = msg

    def record(self, r: Row, own):
        return [_us(r["ts"]), _seq(r), r["login_state"] == "fail"]

    def step(self, key, own, rec):
        u, _, fail = rec
        if not fail:
            own.clear()
            return
        own["fails"] = known = [*own.get("fails", ()), u][-self.times:]
        if len(known) == self.times and u - known[0] <= self.limit:
            yield Row(user_id=key[0], first_fail_time=known[0] // 1000, last_fail_time=u // 1000,
                      warning_msg=self.msg)

    def deadline(self, own):
        return (own["fails"][-1] + self.limit) // 1000 + 1 if own else None

    def on_time(self, key, own, t):
        own.clear()
        return iter(())


def _columns(df: DataFrame, *names: str) -> DataFrame:
    """Those of the columns that there are: each one of a row is converted for Python."""
    return df.select(*[c for c in names if c in df.columns])


def _login_columns(logins: DataFrame) -> DataFrame:
    return _columns(logins, "user_id", "login_state", "ts", "seq")


def login_fail_pairs_stream(logins: DataFrame, limit="2 seconds") -> DataFrame:
    """The limit is inclusive."""
    return stateful_apply(_login_columns(logins), ["user_id"],
                          ConsecutiveFailsProcessor(2, duration_us(limit), P.MSG_FAIL_PAIR), WARN_OUT)


def cep_fail_times_stream(logins: DataFrame, times: int = 3, within="5 seconds") -> DataFrame:
    """C3 (``times=2``) / C4: ``within`` is exclusive."""
    return stateful_apply(_login_columns(logins), ["user_id"], ConsecutiveFailsProcessor(
        times, duration_us(within) - 1, P.MSG_CEP_FAILS.format(n=times)), WARN_OUT)


# ------------------------------------------------------------------ C2

TIMER_OUT = StructType([StructField("user_id", LongType()), StructField("first_fail_time", LongType()),
                        StructField("last_fail_time", LongType()), StructField("fail_count", LongType()),
                        StructField("warning_msg", StringType())])


class LoginFailTimerProcessor(InOrderProcessor):
    """Anchor at a fail and a timer ``limit`` later; a success inside the span cancels;
    at the timer warn if >= min_fails."""

    def __init__(self, limit_us: int, min_fails: int, msg: str):
        self.limit = limit_us
        self.min_fails = min_fails
        self.msg = msg

    def record(self, r: Row, own):
        return [_us(r["ts"]), _seq(r), r["login_state"] == "fail"]

    def deadline(self, own):
        return (own["seg"][0] + self.limit) // 1000 + 1 if own else None

    def on_time(self, key, own, t):
        first, last, n = own.pop("seg")
        if n >= self.min_fails:
            yield Row(user_id=key[0], first_fail_time=first // 1000, last_fail_time=last // 1000,
                      fail_count=n, warning_msg=self.msg.format(n=n))

    def step(self, key, own, rec):
        u, _, fail = rec
        if own and u > own["seg"][0] + self.limit:        # the rest of the span's last millisecond
            yield from self.on_time(key, own, u // 1000)
        if fail:
            own["seg"] = [own["seg"][0], u, own["seg"][2] + 1] if own else [u, u, 1]
        else:
            own.clear()


def login_fail_timer_stream(logins: DataFrame, limit="2 seconds", min_fails: int = 2) -> DataFrame:
    proc = LoginFailTimerProcessor(duration_us(limit), min_fails, P.MSG_FAIL_TIMER)
    return stateful_apply(_login_columns(logins), ["user_id"], proc, TIMER_OUT)


# ------------------------------------------------------------------ C7

ORDER_OUT = StructType([StructField("order_id", LongType()), StructField("result_state", StringType()),
                        StructField("route", StringType())])


class OrderPayProcessor(InOrderProcessor):
    """Per order: the first create opens the order; the first pay at or after it decides in
    time / late; pays with no create before them are reported once. ``wait`` after the
    deadline (create + within) an order without a pay times out, and the state, decided
    or not, is freed; so is the mark of a reported pay. A pay that comes still later finds
    no create any more."""

    def __init__(self, within_us: int, wait_us: int, msgs: dict):
        self.within = within_us
        self.keep = within_us + wait_us
        self.m = dict(msgs)

    def record(self, r: Row, own):
        kind = {"create": 0, "pay": 1}.get(r["event_type"])
        return None if kind is None else [_us(r["ts"]), kind]

    def step(self, key, own, rec):
        u, kind = rec
        created, decided, reported, until = own.get("order", (None, False, False, 0))
        if kind == 0:
            if created is None:
                created, until = u, u + self.keep
        elif created is None:
            until = u + self.keep
            if not reported:
                reported = True
                yield Row(order_id=key[0], result_state=self.m["no_create"], route="order-timeout")
        elif not decided:
            decided = True
            ok = u - created < self.within
            yield Row(order_id=key[0], result_state=self.m["ok"] if ok else self.m["late"],
                      route="main" if ok else "order-timeout")
        own["order"] = [created, decided, reported, until]

    def deadline(self, own):
        return own["order"][3] // 1000 + 1 if own else None

    def on_time(self, key, own, t):
        created, decided, _, _ = own.pop("order")
        if created is not None and not decided:
            yield Row(order_id=key[0], result_state=self.m["timeout"], route="order-timeout")


#: A waiting row and an order's own state; ``opened``: there was a create, at ``created``.
ORDER_ROW = np.dtype([("u", "<i8"), ("id", "<i8"), ("pay", "?")])
ORDER_STATE = np.dtype([("id", "<i8"), ("created", "<i8"), ("until", "<i8"), ("opened", "?"), ("decided", "?"), ("reported", "?")])
#: The shard of the orders without a number.
NO_ORDER = -1


class OrderShardProcessor(StatefulProcessor):
    """The rules of :class:`OrderPayProcessor` for all orders of a shard (the key).

    Rows wait as in :class:`InOrderProcessor`: few of them in the key's value, more in sorted runs of
    blocks. The orders' own states lie in buckets of about ``FILL`` by the hash of their number, twice as many when
    they are full; the value has each bucket's first deadline. So a micro-batch reads and writes the
    blocks and buckets that it has rows or deadlines for, not the shard. The shard's one timer
    hands on what is due, at most about ``DUE`` rows at once. Orders that a deadline divides between two of the
    rows go through the rules row by row, the others together."""

    FRAMES = True
    TAIL, RUN, BLOCK, DUE, FILL = 1_000, 200_000, 8_000, 1_000_000, 512

    def __init__(self, rules: OrderPayProcessor):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # {"runs": [[[first ms, block], ...], ...], "next": block, "timer": ms, "due": [ms or None of each bucket], "n": orders}
        self.value = handle.getValueState("value", "v string, tail binary")
        self.blocks = handle.getMapState("blocks", "block long", "rows binary")
        self.orders = handle.getMapState("orders", "bucket long", "states binary")

    # ---- the key's value
    def _load(self) -> dict:
        found = self.value.get()
        if not found:
            return {"runs": [], "next": 0, "timer": None, "due": [None], "n": 0, "tail": np.empty(0, ORDER_ROW)}
        return {**json.loads(found[0]), "tail": np.frombuffer(found[1], ORDER_ROW)}

    def _save(self, st: dict) -> None:
        plain = {k: v for k, v in st.items() if k != "tail"}
        self.value.update((json.dumps(plain, separators=(",", ":")), st["tail"].tobytes()))

    def _alarm(self, st: dict, t: int | None) -> None:
        if t is not None and (st["timer"] is None or t < st["timer"]):
            self.handle.registerTimer(t)
            st["timer"] = t

    # ---- waiting rows
    def _spill(self, st: dict) -> None:
        rows, run = st["tail"][np.argsort(st["tail"]["u"], kind="stable")], []
        for at in range(0, len(rows), self.BLOCK):
            part = rows[at:at + self.BLOCK]
            self.blocks.updateValue((st["next"],), (part.tobytes(),))
            run.append([int(part["u"][0]) // 1000, st["next"]])
            st["next"] += 1
        st["runs"].append(run)
        st["tail"] = rows[:0]

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        st, least, new, n = None, None, [], 0
        for frame in rows:
            kind = frame["kind"].to_numpy()
            if (kind < -1).any():
                raise ValueError("an order event without a time")
            part = np.empty(int((kind >= 0).sum()), ORDER_ROW)
            if not len(part):
                continue
            part["u"], part["id"], part["pay"] = (frame[c].to_numpy()[kind >= 0] for c in ("u", "order_id", "kind"))
            st = st or self._load()
            first = int(part["u"].min())
            least = first if least is None else min(first, least)
            new.append(part)
            n += len(part)
            if n >= self.RUN:
                st["tail"], new, n = np.concatenate([st["tail"], *new]), [], 0
                self._spill(st)
        if st is not None:
            st["tail"] = np.concatenate([st["tail"], *new])
            if len(st["tail"]) > self.TAIL:
                self._spill(st)
            self._alarm(st, least // 1000 + 1)
            self._save(st)
        return iter(())

    def _before(self, st: dict, now: int) -> np.ndarray:
        """The waiting rows before ``now``; the others stay."""
        early = st["tail"]["u"] < now * 1000
        found, st["tail"] = [st["tail"][early]], st["tail"][~early]
        for run in st["runs"]:
            while run and run[0][0] < now:
                block = run[0][1]
                rows = np.frombuffer(self.blocks.getValue((block,))[0], ORDER_ROW)
                n = int(np.searchsorted(rows["u"], now * 1000))
                found.append(rows[:n])
                if n < len(rows):
                    self.blocks.updateValue((block,), (rows[n:].tobytes(),))
                    run[0][0] = int(rows["u"][n]) // 1000
                    break
                self.blocks.removeKey((block,))
                run.pop(0)
        return np.concatenate(found)

    # ---- the orders' own states
    @staticmethod
    def _bucket(ids: np.ndarray, n: int) -> np.ndarray:
        return (ids.astype("u8") * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype("i8") & (n - 1)

    def _states(self, st: dict, buckets) -> np.ndarray:
        return np.concatenate([np.empty(0, ORDER_STATE), *[
            np.frombuffer(self.orders.getValue((b,))[0], ORDER_STATE) for b in buckets if st["due"][b] is not None]])

    def _keep(self, st: dict, buckets: set, was: int, left: np.ndarray) -> None:
        """``left`` in place of the ``was`` states that the buckets had."""
        st["n"] += len(left) - was
        n = m = len(st["due"])
        while st["n"] > 2 * self.FILL * m:
            m *= 2
        if not st["n"]:
            m = 1
        if m != n:
            others = [b for b in range(n) if b not in buckets]
            left, buckets = np.concatenate([left, self._states(st, others)]), set(range(n))
        had, st["due"] = st["due"], st["due"] if m == n else [None] * m
        gone = {b for b in buckets if had[b] is not None}
        for b in buckets if m == n else ():
            st["due"][b] = None
        at = self._bucket(left["id"], m)
        order = np.argsort(at, kind="stable")
        left, (found, first) = left[order], np.unique(at[order], return_index=True)
        for b, part in zip(found.tolist(), np.split(left, first[1:])):
            self.orders.updateValue((b,), (part.tobytes(),))
            st["due"][b] = int(part["until"].min()) // 1000 + 1
            gone.discard(b)
        for b in gone:
            self.orders.removeKey((b,))

    def _advance(self, key, st: dict, now: int) -> pd.DataFrame | None:
        """All rows and deadlines before ``now``."""
        rows, m, keep = self._before(st, now), self.rules.m, self.rules.keep
        buckets = set(np.unique(self._bucket(rows["id"], len(st["due"]))).tolist())
        buckets |= {b for b, t in enumerate(st["due"]) if t is not None and t <= now}
        if not buckets:
            return None
        old = self._states(st, buckets)
        ids = np.unique(np.concatenate([old["id"], rows["id"]]))
        own, known = np.zeros(len(ids), ORDER_STATE), np.zeros(len(ids), bool)
        at = np.searchsorted(ids, old["id"])
        own[at], own["id"], known[at] = old, ids, True
        said: list[tuple] = []           # (orders, what is said, route)

        rows = rows[np.lexsort((rows["pay"], rows["u"], rows["id"]))]
        u, pay, g, i = rows["u"].copy(), rows["pay"].copy(), np.searchsorted(ids, rows["id"]), np.arange(len(rows))
        first = np.ones(len(rows), bool)
        first[1:] = g[1:] != g[:-1]
        # the row that opens the order: before all of them, one of them, or none
        opens = np.where(own["opened"], -1, len(rows))
        creates = np.flatnonzero(~pay & ~own["opened"][g])
        by, one = np.unique(g[creates], return_index=True)
        opens[by] = creates[one]
        created = own["created"].copy()
        created[by] = u[opens[by]]
        # until when the state before each row is kept; an order is divided where a row comes after that
        inside = i > opens[g]
        until = np.where(inside, created[g] + keep, np.where(first, own["until"][g], np.roll(u, 1) + keep))
        over = (until // 1000 + 1 <= u // 1000) & (inside | ~first | known[g])
        odd = np.zeros(len(ids), bool)
        odd[g[over]] = True

        plain = ~odd[g]
        orphan = np.flatnonzero(pay & (i < opens[g]) & plain)
        by = np.unique(g[orphan])
        new = by[~own["reported"][by]]
        said.append((ids[new], m["no_create"], "order-timeout"))
        own["reported"][by] = True
        own["until"][g[orphan]] = u[orphan] + keep       # the last one's stays
        pays = np.flatnonzero(pay & inside & plain & ~own["decided"][g])
        by, one = np.unique(g[pays], return_index=True)
        ok = u[pays[one]] - created[by] < self.rules.within
        said += [(ids[by[ok]], m["ok"], "main"), (ids[by[~ok]], m["late"], "order-timeout")]
        own["decided"][by] = True
        by = np.flatnonzero(~odd & (opens >= 0) & (opens < len(rows)))
        own["created"][by], own["opened"][by], own["until"][by] = created[by], True, created[by] + keep
        known[g[plain]] = True

        each = np.flatnonzero(odd)
        begin, end = np.searchsorted(g, each), np.searchsorted(g, each, side="right")
        for k, a, b in zip(each.tolist(), begin.tolist(), end.tolist()):
            self._one_by_one(own, known, k, u[a:b].tolist(), pay[a:b].tolist(), said)

        over = known & (own["until"] // 1000 + 1 <= now)
        said.append((ids[over & own["opened"] & ~own["decided"]], m["timeout"], "order-timeout"))
        self._keep(st, buckets, len(old), own[known & ~over])
        return self._frame(key, said)

    def _one_by_one(self, own: np.ndarray, known: np.ndarray, k: int, u: list, pay: list, said: list) -> None:
        o, rules, out = own[k], self.rules, []
        state = {"order": [int(o["created"]) if o["opened"] else None, bool(o["decided"]), bool(o["reported"]),
                           int(o["until"])]} if known[k] else {}
        key = (int(o["id"]),)
        for rec in zip(u, map(int, pay)):
            while (t := rules.deadline(state)) is not None and t <= rec[0] // 1000:
                out += rules.on_time(key, state, t)
            out += rules.step(key, state, rec)
        said += [(own["id"][k:k + 1], r.result_state, r.route) for r in out]
        created, decided, reported, until = state["order"]
        own[k] = (key[0], created or 0, until, created is not None, decided, reported)
        known[k] = True

    @staticmethod
    def _frame(key, said: list) -> pd.DataFrame | None:
        n = [len(x) for x, _, _ in said]
        if not sum(n):
            return None
        ids = pd.Series(np.concatenate([x for x, _, _ in said]))
        if key[0] == NO_ORDER:
            ids = pd.Series([None] * len(ids), dtype="Int64")
        text = [np.repeat(np.array([x[c] for x in said], dtype=object), n) for c in (1, 2)]
        return pd.DataFrame({"order_id": ids, "result_state": text[0], "route": text[1]})

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        st = self._load()
        if st["timer"] is None or st["timer"] > now:
            return                     # an earlier one has been set since
        step = max(1, self.DUE // self.BLOCK)
        firsts = sorted(t for run in st["runs"] for t, _ in run if t < now)
        for until in [*firsts[step::step], now]:
            if (out := self._advance(key, st, until)) is not None:
                yield out
            st["runs"] = [run for run in st["runs"] if run]
        if not st["n"] and not len(st["tail"]) and not st["runs"]:
            self.value.clear()
            return
        wanted = [run[0][0] + 1 for run in st["runs"]] + [t for t in st["due"] if t is not None]
        if len(st["tail"]):
            wanted.append(int(st["tail"]["u"].min()) // 1000 + 1)
        st["timer"] = None
        self._alarm(st, min(wanted))
        self._save(st)

    def close(self) -> None:
        pass


def order_pay_classify_stream(events: DataFrame, within="15 minutes", wait="1 day", shards: int = SALTS) -> DataFrame:
    msgs = {"no_create": P.MSG_NO_CREATE, "ok": P.MSG_PAYED_OK, "late": P.MSG_PAYED_LATE,
            "timeout": P.MSG_TIMEOUT}
    rules = OrderPayProcessor(duration_us(within), duration_us(wait), msgs)
    order, kind, u = F.col("order_id"), F.col("event_type"), epoch_us("ts")
    kind = F.when(kind == "create", 0).when(kind == "pay", 1).otherwise(-1)
    rows = events.select(
        F.when(order.isNull(), NO_ORDER).otherwise(F.pmod(F.xxhash64(order), F.lit(shards))).cast("int").alias("shard"),
        F.coalesce(order.cast("long"), F.lit(0)).alias("order_id"),
        F.when((kind >= 0) & u.isNull(), -2).otherwise(kind).alias("kind"),
        # the event time goes to Python as a number; with the column's metadata it is still held against the watermark
        F.coalesce(u, F.lit(2 ** 63 - 1)).alias("u", metadata=events.schema["ts"].metadata))
    return stateful_apply(rows, ["shard"], OrderShardProcessor(rules), ORDER_OUT)
