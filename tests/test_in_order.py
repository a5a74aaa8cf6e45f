"""The in-order processor on a state of its own kind: few calls a key, runs and blocks like a plain sort."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row

from evtlens.streaming import stateful


class State:
    """Value, map and timers of one key in memory, with the number of calls."""

    def __init__(self):
        self.v, self.m, self.timers, self.calls = None, {}, set(), 0

    def getValueState(self, *names):
        return self

    getMapState = getValueState

    def get(self):
        self.calls += 1
        return self.v

    def update(self, v):
        self.calls += 1
        self.v = v

    def clear(self):
        self.calls += 1
        self.v = None

    def getValue(self, k):
        self.calls += 1
        return self.m[k]

    def updateValue(self, k, v):
        self.calls += 1
        self.m[k] = v

    def removeKey(self, k):
        self.calls += 1
        del self.m[k]

    def registerTimer(self, t):
        self.calls += 1
        self.timers.add(t)


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def drive(proc, batches, key=(1,)):
    """(rows, watermark) of micro-batches for one key -> what the processor emits."""
    state, out = State(), []
    proc.init(state)
    for rows, mark in batches:
        if rows:
            list(proc.handleInputRows(key, iter(rows), Now(mark)))
        for t in sorted(t for t in state.timers if t < mark):
            class At(Now):
                def getExpiryTimeInMs(self, t=t):
                    return t
            out += list(proc.handleExpiredTimer(key, Now(mark), At(mark)))
            state.timers.discard(t)
    return out, state


def logins(n, seed=1, span=1_000_000):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [Row(user_id=1, ts=start + dt.timedelta(milliseconds=rng.randrange(span)), login_state=rng.choice(["fail", "fail", "success"]), seq=i)
            for i in range(n)]


T0 = 1_704_067_200_000


def test_a_key_takes_few_state_calls_however_many_rows():
    proc = stateful.ConsecutiveFailsProcessor(2, 2_000_000, "m")
    out, state = drive(proc, [(logins(400), 0), ([], T0 + 10_000_000)])
    assert out and state.calls <= 8
    assert state.v is None and not state.m and not state.timers


@pytest.mark.parametrize("proc", [stateful.ConsecutiveFailsProcessor(2, 2_000_000, "m"), stateful.ConsecutiveFailsProcessor(3, 4_999_999, "m"),
                                  stateful.LoginFailTimerProcessor(3_000_000, 2, "{n}")])
def test_runs_of_blocks_equal_one_sorted_tail(proc, monkeypatch):
    rows = logins(3000)
    marks = [T0 + 200_000, T0 + 450_500, T0 + 700_001, T0 + 10_000_000]
    wait = [[r for r in rows if (stateful._us(r.ts) // 1000 >= (marks[i - 1] if i else 0)) and r.seq % 4 == i] for i in range(4)]
    batches = list(zip(wait, marks))
    monkeypatch.setattr(stateful.InOrderProcessor, "TAIL", 10 ** 9)
    monkeypatch.setattr(stateful.InOrderProcessor, "RUN", 10 ** 9)
    want, _ = drive(proc, batches)
    monkeypatch.setattr(stateful.InOrderProcessor, "TAIL", 5)
    monkeypatch.setattr(stateful.InOrderProcessor, "RUN", 130)
    monkeypatch.setattr(stateful.InOrderProcessor, "BLOCK", 17)
    got, state = drive(proc, batches)
    assert got == want and len(want) > 30
    assert state.v is None and not state.m


def test_marks_of_a_window_go_when_it_is_over():
    end = T0 + 3_600_000
    rows = [Row(salt=0, window_end=end + 3_600_000 * (i // 60), bit=i % 20, ts=dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(100)]
    out, state = drive(stateful.FirstSeenProcessor(), [(rows[::2] + rows[1::2], T0 + 3_700_000), ([], T0 + 20_000_000)], (0,))
    assert [(r.window_end, r.bit) for r in out] == list(dict.fromkeys((r.window_end, r.bit) for r in rows))
    assert state.v is None and not state.timers
