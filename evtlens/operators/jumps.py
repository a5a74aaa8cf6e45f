"""Chains followed by jump pointers (binary lifting).

A greedy segmentation (anchor at a row, skip its span, anchor at the next row, ...) is a
walk along pointers "the next anchor, if this row is one". Walking is sequential; here the
pointers are doubled instead. After round k a pointer jumps over 2^k anchors, and every row that is
less than 2^k jumps from a head is marked, so a chain of n anchors takes log2(n) rounds, each an
equi-join on unique row keys: a chain of any length is spread over all tasks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evtlens.session import cut_lineage


#: So many pointers (of three numbers) are joined by broadcast.
FEW = 100_000


def reachable(pointers: DataFrame, heads: DataFrame, key: Sequence[str], to: Sequence[str], rounds: int = 2) -> DataFrame:
    """The keys that chains from ``heads`` (rows of ``key`` columns) come to, heads left out.

    ``pointers`` has a row per key with a successor (columns ``key`` and ``to``, of the same
    types; each key at most once); no pointer leads to a head and chains don't meet.
    The rounds end when no pointer is left that jumps so far; every ``rounds`` rounds the state
    is written to the shared folder, so a lost executor costs these rounds at most."""
    key, to = list(key), list(to)
    away = [f"_to_{c}" for c in key]
    p = pointers.select(*key, *[F.col(t).alias(a) for t, a in zip(to, away)])
    marked = heads.select(*key).withColumn("_new", F.lit(False))
    n = p.count()
    few = F.broadcast if n <= FEW else (lambda x: x)        # pointers only get fewer
    while n:
        for _ in range(rounds):
            step = marked.join(few(p), key).select(*[F.col(a).alias(c) for c, a in zip(key, away)], F.lit(True).alias("_new"))
            marked = marked.unionByName(step)
            ahead = p.select(*[F.col(c).alias(f"_at_{c}") for c in key], *[F.col(a).alias(f"_2{a}") for a in away])
            on = [F.col(a) == F.col(f"_at_{c}") for c, a in zip(key, away)]
            p = p.join(few(ahead), on).select(*key, *[F.col(f"_2{a}").alias(a) for a in away])
        both = marked.select(*key, *[F.col(c).alias(a) for c, a in zip(key, away)], "_new").unionByName(
            p.withColumn("_new", F.lit(None).cast("boolean")))                                  # one table of marks and pointers
        both = cut_lineage(both, "jumps")
        marked, p = both.where("_new is not null").select(*key, "_new"), both.where("_new is null").drop("_new")
        n = p.count()
    return marked.where("_new").select(*key)
