"""Many orders in a shard's state: the same as order by order, in few calls."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from evtlens.streaming import stateful
from evtlens.streaming.eventtime import with_event_time
from tests.test_in_order import T0, Now, State, drive

MSGS = {"no_create": "none", "ok": "ok", "late": "late", "timeout": "timeout"}
SECOND = 1_000_000


class Shard(State):
    """A shard's value, timers and two maps."""

    def __init__(self):
        super().__init__()
        self.maps = []

    def getMapState(self, *names):
        self.maps.append(State())
        return self.maps[-1]

    def all_calls(self):
        return self.calls + sum(m.calls for m in self.maps)


def drive_shard(proc, batches, key=(0,)):
    state, out = Shard(), []
    proc.init(state)
    for rows, mark in batches:
        frames = [pd.DataFrame(rows[a:a + 100], columns=["order_id", "kind", "u"]) for a in range(0, len(rows), 100)]
        if frames:
            assert not list(proc.handleInputRows(key, iter(frames), Now(mark)))
        for t in sorted(t for t in state.timers if t < mark):
            out += list(proc.handleExpiredTimer(key, Now(mark), Now(mark)))
            state.timers.discard(t)
    return [r for f in out for r in f.itertuples(index=False, name=None)], state


def rules(within=60 * SECOND, wait=120 * SECOND):
    return stateful.OrderPayProcessor(within, wait, MSGS)


def some_batches(seed, orders, n):
    """Rows of four micro-batches and the watermark after each; none comes behind the watermark."""
    rng, marks, before = random.Random(seed), [T0 + 150_000, T0 + 333_333, T0 + 600_001, T0 + 10 ** 9], T0
    out = []
    for mark in marks:
        lo, hi = before * 1000, min(mark + 200_000, T0 + 900_000) * 1000
        out.append(([(rng.choice(orders), rng.choice([0, 1, 1, -1]), rng.randrange(lo, hi) // 250_000 * 250_000 + lo % 250_000) for _ in range(n)], mark))
        before = mark
    return out


@pytest.mark.parametrize("wait", [0, 30, 120, 10_000])
@pytest.mark.parametrize("seed, n", [(1, 40), (2, 700)])
def test_a_shard_says_what_its_orders_say_one_by_one(monkeypatch, seed, n, wait):
    orders = [*range(-20, 60), 2 ** 62 + 1, -2 ** 62]
    batches = some_batches(seed, orders, n)
    for name, v in dict(TAIL=20, RUN=300, BLOCK=16, DUE=64, FILL=2).items():
        monkeypatch.setattr(stateful.OrderShardProcessor, name, v)
    got, state = drive_shard(stateful.OrderShardProcessor(rules(wait=wait * SECOND)), batches)
    want, start = [], dt.datetime(1970, 1, 1)
    for o in orders:
        own = [([Row(event_type=["create", "pay", "other"][k], ts=start + dt.timedelta(microseconds=u)) for i, k, u in rows if i == o], mark)
               for rows, mark in batches]
        want += [tuple(r) for r in drive(rules(wait=wait * SECOND), own, (o,))[0]]
    assert sorted(got) == sorted(want) and len({r[1] for r in want}) > 2
    assert state.v is None and not any(m.m for m in state.maps) and not state.timers


def test_calls_follow_blocks_and_buckets_not_orders():
    rows = [(i, k, (T0 + 1000 * k) * 1000) for i in range(5000) for k in (0, 1)]
    out, state = drive_shard(stateful.OrderShardProcessor(rules(wait=10 ** 12)), [(rows, T0 + 20_000)])
    assert len(out) == 5000 and {r[1:] for r in out} == {("ok", "main")}
    assert state.all_calls() < 40 and len(state.maps[1].m) == 8
    before = state.all_calls()
    proc = stateful.OrderShardProcessor(rules(wait=10 ** 12))
    proc.init(state)
    state.maps = state.maps[:2]
    proc.blocks, proc.orders = state.maps
    list(proc.handleInputRows((0,), iter([pd.DataFrame([(7, 1, (T0 + 30_000) * 1000)], columns=["order_id", "kind", "u"])]), Now(T0 + 20_000)))
    list(proc.handleExpiredTimer((0,), Now(T0 + 40_000), Now(T0 + 40_000)))
    assert state.all_calls() - before < 10          # one bucket, not the shard


def test_the_shard_of_orders_without_a_number_and_rows_without_a_time():
    out, _ = drive_shard(stateful.OrderShardProcessor(rules()), [([(0, 1, T0 * 1000)], T0 + 10 ** 9)], (stateful.NO_ORDER,))
    assert len(out) == 1 and pd.isna(out[0][0]) and out[0][1:] == ("none", "order-timeout")
    with pytest.raises(ValueError):
        drive_shard(stateful.OrderShardProcessor(rules()), [([(0, -2, 2 ** 63 - 1)], T0)])


def _stream(spark, batches, bound="1 hour"):
    from evtlens.plans import streams
    parts = [spark.createDataFrame(b, "order_id bigint, event_type string, s bigint").select(
        "order_id", "event_type", F.timestamp_seconds("s").alias("ts")) for b in [*batches, [(-1, "other", 32_503_680_000)]]]
    out = streams.folder(spark, "order-shards")
    progress = streams.run(spark, parts, lambda x: stateful.order_pay_classify_stream(with_event_time(x, "ts", bound), "15 minutes", "1 hour"),
                           lambda w: w.outputMode("append").format("parquet").option("path", out).start())
    rows = [(r.order_id, r.result_state) for r in spark.read.parquet(out).collect()]
    return rows, [p["stateOperators"][0] for p in progress]


def test_order_stream_keeps_a_state_a_shard_not_an_order(spark):
    """20,000 open orders were as many keys, each with calls of its own in every micro-batch."""
    t = 1_600_000_000
    rows, ops = _stream(spark, [[(i, "create", t + i % 60) for i in range(20_000)], [(i, "pay", t + 100) for i in range(0, 20_000, 2)]])
    assert sorted(rows) == [(i, "timeout" if i % 2 else "payed successfully") for i in range(20_000)]
    assert 0 < max(o["numRowsTotal"] for o in ops) <= 4 * stateful.SALTS and ops[-1]["numRowsTotal"] == 0


def test_order_stream_drops_late_rows_and_takes_odd_ones(spark):
    """Late rows, orders without a number and times that pandas does not know."""
    t = 1_600_000_000
    rows, ops = _stream(spark, [[(1, "create", t), (2, "create", t), (9, "other", t + 36_000)],
                                [(1, "pay", t + 60), (None, "pay", t + 36_000), (None, "pay", t + 36_000), (3, None, t + 36_000),
                                 (5, "create", 10_413_792_000)]])
    assert sorted(rows, key=str) == [(1, "timeout"), (2, "timeout"), (5, "timeout"), (None, "payed but not found created log")]
    assert sum(o["numRowsDroppedByWatermark"] for o in ops) == 1
