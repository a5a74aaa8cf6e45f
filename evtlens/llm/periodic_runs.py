"""Periodic runs of words: online sparse diagonal matching.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at
least ``min_length`` words and ``min_periods`` periods long, that no neighbouring word extends.

The words of a text pass once, left to right. Diagonal q of the table "word i against word
i - q" is active while these two are equal, and its match length grows by one with each
word. An earlier occurrence of a word makes it a candidate for one diagonal, and a frequent word
has many, so only diagonals that can end as a run are followed: for each scale k = 1, 2, 4, ... the
nearest earlier place of the last k words is looked up, and its distance, if it is above k / 2
and at most k, is the one active lag of that scale. Inside a run of period q its q words
recur at distance q and, since no shorter period fits, at none below, so no run is missed: a text of n words
has at most log2(n) active lags at any time. When the lag of a scale changes, its diagonal has ended;
a match long enough is emitted. A scale only looks back k words, so its table holds
2k places at most and a text of n words needs O(n) memory and O(n log n) steps, also where one
word fills it.

Before that, a text is thinned to the stretches that can hold runs at all: every four
consecutive words of a run stand in the text twice or more. This is one vectorised pass over
many texts.

The k words are looked up by a 61-bit rolling hash; a run found is compared word by word before it
is emitted.

A text is worked on within one task and nothing is shuffled, so hot words, many copies and
repeated rows cost no more than their own length.

Defined results: a null text has no words and an empty collapsed text; ids may be null or
repeat; other columns, whatever their names, are only carried when asked for.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, small_batches
from .packing import slabs

MODULUS = (1 << 61) - 1
BASE = 0x1F3B_5A77_9C2D_4E61 % MODULUS
GRAM = 4
AT_ONCE = 4096               # words of a block


class Scale:
    """The diagonal of one scale: places of the last k words (of this and the previous k
    words), the active lag and its match length."""

    __slots__ = ("k", "power", "now", "before", "lag", "matched")

    def __init__(self, k: int):
        self.k, self.power = k, pow(BASE, k, MODULUS)
        self.now, self.before = {}, {}
        self.lag = self.matched = 0


def online_runs(ids: Sequence[int], min_length: int = 6, min_periods: int = 4) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the runs of a word sequence. The words pass once, in blocks; a
    run is emitted with the block in which it ends. ``min_periods`` is 3 at least."""
    n = len(ids)
    longest = n // min_periods                       # period
    scales, k = [], 1
    while n >= min_length and k // 2 < longest:
        scales.append(Scale(k))
        k *= 2

    def ended(i: int, q: int, matched: int):
        length = matched + q
        start = i - length
        if length >= max(min_length, min_periods * q) and ids[start + q:i] == ids[start:i - q]:
            yield start, length, q

    prefix, at = [0], 0
    for word in ids if scales else ():
        at = (at * BASE + word + 1) % MODULUS
        prefix.append(at)
    for first in range(0, n, AT_ONCE):
        last = min(first + AT_ONCE, n)
        for s in scales:
            k, power, now, before, lag, matched = s.k, s.power, s.now, s.before, s.lag, s.matched
            lo = max(first, k - 1)                   # the first place with k words
            if lo >= last:
                break
            for i, (x, y) in enumerate(zip(prefix[lo + 1:last + 1], prefix[lo + 1 - k:last + 1 - k], strict=True), lo):
                if i % k == 0:
                    before, now = now, {}
                h = (x - y * power) % MODULUS
                at = now.get(h)
                if at is None:
                    at = before.get(h, i)
                now[h] = i
                if i - at == lag:                    # 0: none active, none found
                    matched += 1
                else:
                    if lag:
                        yield from ended(i, lag, matched)
                    lag = i - at
                    if not lag <= k < 2 * lag:
                        lag = 0
                    matched = k
            s.now, s.before, s.lag, s.matched = now, before, lag, matched
    for s in scales:
        if s.lag:
            yield from ended(n, s.lag, s.matched)


def stretches(texts: list[list]) -> list[list[tuple[int, int]]]:
    """For each text (its words) the stretches [start, end) whose every four words in a row
    stand twice or more in that text, by hash (equal hashes of others only make them longer)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    total = int(sizes.sum())
    out = [[] for _ in texts]
    if total < GRAM:
        return out
    words = np.fromiter(map(hash, chain.from_iterable(texts)), np.int64, total).view(np.uint64)
    of = np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
    mix = np.uint64(0x9E37_79B9_7F4A_7C15)
    h = (of + np.uint64(1)) * mix
    h = h[:total - GRAM + 1]
    for j in range(GRAM):
        h = (h ^ (words[j:total - GRAM + 1 + j] + np.uint64(j))) * mix
        h ^= h >> np.uint64(29)
    whole = of[:total - GRAM + 1] == of[GRAM - 1:]
    order = np.sort(h)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return out
    spot = np.searchsorted(twice, h).clip(max=len(twice) - 1)
    hit = (twice[spot] == h) & whole
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        while lo < hi:            # hits of neighbouring texts may touch
            t = int(of[lo])
            end = min(hi, int(starts[t] + sizes[t]) - GRAM + 1)
            out[t].append((lo - int(starts[t]), end - int(starts[t]) + GRAM - 1))
            lo = end
    return out


def runs_of(words: list, parts: list[tuple[int, int]], min_length: int, min_periods: int) -> list[tuple[int, int, int]]:
    out = []
    for lo, hi in parts:
        if hi - lo >= min_length:
            number = {}
            ids = [number.setdefault(w, len(number)) for w in words[lo:hi]]
            out += [(lo + start, length, period) for start, length, period in online_runs(ids, min_length, min_periods)]
    return sorted(out)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run holds behind its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), np.bool_)
    for start, length, period in runs:
        gone[start + period:start + length] = True
    return b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)


def detect(docs: DataFrame, *, text: str = "text", carry: tuple[str, ...] = ("doc_id",), min_length: int = 6,
           min_periods: int = 4) -> DataFrame:
    """carry columns, n_words, runs (array of start, length, period, in order of start, then
    length) and collapsed (the text with each run cut to one period)."""
    if min_periods < 3 or min_length < GRAM + 2:
        raise ValueError("runs of fewer than three periods or six words are not searched")
    kinds = dict((f.name, f.dataType) for f in docs.schema)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for first, texts in slabs(batch.column(len(carry))):
                words = [t.split() for t in texts]       # of bytes: splits at the six ASCII spaces alone
                found = [runs_of(w, parts, min_length, min_periods) if parts else []
                         for w, parts in zip(words, stretches(words), strict=True)]
                flat = list(chain.from_iterable(found))
                columns = [pa.array([r[j] for r in flat], pa.int64()) for j in range(3)]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(first, len(texts)) for i in range(len(carry))],
                     pa.array([len(w) for w in words], pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(run_type))),
                     pa.array([collapsed(w, f) for w, f in zip(words, found, strict=True)], pa.binary()).cast(pa.string())],
                    names=[*carry, "n_words", "runs", "collapsed"])

    small_batches(docs.sparkSession)
    schema = ", ".join([*[f"`{c}` {kinds[c].simpleString()}" for c in carry], "n_words long",
                        "runs array<struct<start:long,length:long,period:long>>", "collapsed string"])
    return docs.select(*carry, F.col(text).alias("text")).mapInArrow(run, schema)


def looped(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and text, changed as the contract of op11 says: with h the CRC-32 of the decimal key, every tenth
    h's words from number a on repeat with period p. Other texts, and those without a key, stay."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.when((h % 10 == 0) & F.regexp_like(text, F.lit(WORD)), F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)))
    # a column of its own, or it would be worked out for every word
    cut = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.floor(h / 10).alias("g"), words.alias("w"))
    n = F.size("w").cast("long")
    cut = cut.withColumn("a", F.col("g") % n).withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    a, p = F.col("a"), F.col("p")
    rest = F.slice("w", (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(rest, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    whole = F.array_join(F.concat(F.slice("w", F.lit(1), a.cast("int")), tail), " ")
    return cut.select(F.col("key").alias(key), F.when(F.col("w").isNotNull(), whole).otherwise(F.col("text")).alias(text))


def digests(found: DataFrame) -> DataFrame:
    """Of :func:`detect`: doc_id, n_runs, the longest run (ties: least start, then period) and
    the SHA-256 of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    ordered = F.array_sort(F.transform("runs", lambda r: F.struct(r["start"], r["period"], r["length"])))
    lines = F.array_join(F.transform(ordered, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    every = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    length = -F.col("best.less")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
        F.col("best.period").alias("period"), F.expr('-best.less * 1000 div best.period').cast("long").alias("exponent_milli"),
        F.sha2(every, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
