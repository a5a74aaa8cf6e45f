"""Hard negatives against a plain scan."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from evtlens.llm import hard_negatives as hn

from . import brute

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=700, dim=12, seed=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append((i, [x + rng.gauss(0, 0.8) for x in c], rng.randrange(4)))
    return out


def f32(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]


def as_rows(df):
    return sorted(map(tuple, df.collect()))


def test_equals_plain_scan(spark, monkeypatch):
    rows = f32(vectors())
    rows += [(1000 + i, rows[5][1], i % 3) for i in range(150)]          # one vector many times: ties by id
    rows += [(900, [0.0] * 12, 1), (901, [-x for x in rows[0][1]], 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute.hard_negatives(rows, every=50)
    assert len(want) > 50
    assert as_rows(hn.mine(df, every=50)) == want
    monkeypatch.setattr(hn, "STRIPE_ROWS", 200)
    assert as_rows(hn.mine(df, every=50, group=4)) == want             # several stripes and groups


def test_odd_rows(spark):
    rows = f32(vectors(120, 5))
    odd = [(None, [1.0] * 5, 1), (200, None, 1), (300, [1.0] * 5, None), (400, [1.0, None, 1.0, 1.0, 1.0], 0),
           (500, [math.nan] * 5, 0), (600, [math.inf] * 5, 0), (700, [1e30] * 5, 0), (800, [], 1), (801, [], 2), (900, [2.0, 2.0], 2)]
    rows = rows + odd + rows[:30]                                     # repeated rows, anchors among them
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("id", "uid", "v", "score", "rank", "cell", "n")})
    got, want = as_rows(hn.mine(df, every=20)), brute.hard_negatives(rows, every=20)
    assert got == want and len(want) > 10
    assert hn.mine(df.limit(0)).count() == 0
    assert hn.mine(df.where("vec_id is null or embedding is null")).count() == 0


def test_scan_prunes_and_stays_exact():
    rng = np.random.default_rng(0)
    columns = np.sort(rng.integers(-200, 200, (32, 2000)), axis=1).astype(float)     # rows of like vectors
    anchor = (rng.integers(-5, 5, 32) * np.where(np.arange(32) < 6, 60, 1)).astype(float)
    best = hn.Best(-(1 << 62), 1 << 62, 5)
    read = hn.vertical_scan(anchor, columns, columns.min(1), columns.max(1), np.arange(2000), np.arange(2000), [best])
    scores = anchor @ columns
    order = np.lexsort((np.arange(2000), -scores))[:5]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()
    window = hn.Best(int(scores.max()) // 2, int(scores.max()) // 2 + 50, 5)
    some = hn.vertical_scan(anchor, columns, columns.min(1), columns.max(1), np.arange(2000), np.arange(2000), [window])
    inside = [i for i in np.lexsort((np.arange(2000), -scores)) if window.lo <= scores[i] <= window.hi][:5]
    assert window.ids.tolist() == inside
    assert some < read <= 32 * 2000 and some < 32 * 2000


def test_large_components_stay_exact(spark):
    rows = [(i, [float((i * 7919 + j * 104729) % 60_000) for j in range(9)], i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert as_rows(hn.mine(df, every=10)) == brute.hard_negatives(rows, every=10)
