"""Periodic runs against a plain search of every diagonal."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from evtlens.llm import periodic_runs as pr
from evtlens.llm import queries

from . import brute


def words_like(rng, n):
    v = rng.choice([1, 2, 2, 3, 5])
    w = [rng.randrange(v) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // (3 + rng.randrange(8))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_online_runs_equal_plain_search():
    rng = random.Random(5)
    texts = [words_like(rng, rng.randint(0, 70)) for _ in range(2500)]
    for w, parts in zip(texts, pr.stretches(texts)):
        want = brute.periodic_runs(w)
        assert sorted(pr.online_runs(w)) == want
        assert pr.runs_of(w, parts, 6, 4) == want


def test_runs_at_the_limits():
    assert pr.runs_of([7] * 5, [(0, 5)], 6, 4) == []
    assert pr.runs_of([7] * 6, [(0, 6)], 6, 4) == [(0, 6, 1)]
    assert pr.runs_of([1, 2] * 4, [(0, 8)], 6, 4) == [(0, 8, 2)]
    assert pr.runs_of([1, 2] * 3 + [1], [(0, 7)], 6, 4) == []
    long = list(range(50)) * 4
    assert pr.runs_of(long, pr.stretches([long])[0], 6, 4) == [(0, 200, 50)]
    assert pr.runs_of(long[:-1], pr.stretches([long[:-1]])[0], 6, 4) == []
    two = [1, 2, 3] * 5 + [3, 3, 3, 3, 3, 3]                       # runs that share a word
    assert pr.runs_of(two, pr.stretches([two])[0], 6, 4) == brute.periodic_runs(two) == [(0, 15, 3), (14, 7, 1)]
    with pytest.raises(ValueError):
        pr.detect(None, min_periods=2)


def test_long_texts_stay_cheap():
    """One word 60,000 times; a period of 2,500 words; tables no larger than what a scale looks back."""
    one = [3] * 60_000
    assert pr.runs_of(one, pr.stretches([one])[0], 6, 4) == [(0, 60_000, 1)]
    rng = random.Random(1)
    unit = [rng.randrange(40) for _ in range(2500)]
    w = [rng.randrange(40) for _ in range(1000)] + unit * 6
    found = pr.runs_of(w, pr.stretches([w])[0], 6, 4)
    assert [r for r in found if r[2] == 2500] == [r for r in found if r[1] > 14_000] != []
    s = pr.Scale(4)
    assert s.now == s.before == {} and s.lag == 0


def test_query_equals_plain_version(spark, docs, rows, tmp_path):
    more = [(100 + i, "a b\tc\nd " * (2 + i) + "é x " * i, "en", "s", 1) for i in range(40)] + [
        (None, "x " * 9, None, None, None), (7, "x " * 9, None, None, None)]
    spark.createDataFrame(more, docs.schema).union(docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op11_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    want = sorted((brute.op11(d, t) for d, t, *_ in [*more, *rows]), key=repr)
    assert got == want
    assert sum(r[1] for r in got) > 30


def test_planted_loops(spark):
    texts = [(i, " ".join(f"w{j % 90}" for j in range(120 + i)), None) for i in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string, n_runs string")
    out = dict(map(tuple, pr.looped(df).collect()))
    changed = 0
    for d, t, _ in texts:
        assert out[d].split() == brute.looped(d, t.split())
        changed += out[d] != t
    assert changed >= 5
    assert all(zlib.crc32(str(d).encode()) % 10 == 0 for d, t, _ in texts if out[d] != t)


def test_odd_input(spark, odd_docs, no_docs):
    found = pr.detect(odd_docs)
    assert found.count() == odd_docs.count()
    same = found.where("doc_id is not null").groupBy("doc_id").agg(F.count_distinct("runs", "collapsed").alias("n"))
    assert same.where("n > 1").count() == 0
    assert pr.detect(no_docs).count() == 0 and pr.digests(pr.detect(no_docs)).count() == 0
    null = spark.createDataFrame([(None, None), (1, ""), (2, " \n\t ")], "doc_id long, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r)[1:] for r in pr.digests(pr.detect(null)).collect()} == {(0, None, None, None, None, empty, empty)}
