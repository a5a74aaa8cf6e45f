"""Mixing sources to target weights (DataFrame functions only).

Every source gets a share of the budget in proportion to its weight. A share is clamped
at ``max_epochs`` times the size of the source; what a clamped source leaves over is
shared again among the others by weight, until no share is above its clamp (capped
water-filling). A source's share is then met by whole repetitions of all its documents
and one more, fractional repetition of some: those that come first in a seeded order
and fit in what is missing.

Both steps need only per-source sums, so no document is moved:

* the water level solves ``sum(min(clamp, level * weight)) = budget``. Each round keeps
  the sources clamped whose clamp lies below the level and computes the level of the
  rest; levels only rise, so it ends after at most as many rounds as there are sources.
* the fractional repetition of a source is a threshold on the seeded draw. Draws are
  summed by their first three hex digits (combined before the shuffle, so that a source
  with a third of all rows sends 4096 rows a task); only the one bucket in which the
  share is reached is then sorted. Further rounds fill what is left with documents that
  are small enough.

Defined results: a null text has size 0; null is a source of its own; a source of size 0
has target 0; an empty table gives an empty mix. Rows that agree in doc_id and text
share one draw and are taken or left together. Rows keep all their columns; the columns
added are ``size, source_size, target, copies, taken`` (existing ones of these names are
replaced).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, text_of, written

ADDED = ["size", "source_size", "target", "copies", "taken"]


def cyclic_weights(sources: DataFrame, weights=(3, 1, 2), column: str = "source") -> DataFrame:
    """Sources in code point order, null last, with the given weights in turn.

    ``sources`` has one row per source; the ordering window runs over that small table."""
    rank = F.row_number().over(Window.orderBy(F.col(column).asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (rank % len(weights) + 1).cast("int"))
    return sources.select(column, pick.alias("weight"))


def water_level(clamps: DataFrame, budget: float) -> float:
    """The level at which ``sum(least(clamp, level * weight))`` is the budget.

    ``clamps`` has columns clamp and weight; infinity when all are clamped."""
    level, clamped = 0.0, None
    while True:
        held = F.col("clamp") <= F.lit(level) * F.col("weight")
        row = clamps.agg(
            F.sum(F.when(held, F.col("clamp"))).alias("held"),
            F.count(F.when(held, 1)).alias("n"),
            F.sum(F.when(~held, F.col("weight"))).alias("rest")).first()
        if row["n"] == clamped:
            return level
        if not row["rest"]:
            return float("inf")
        clamped, level = row["n"], (budget - (row["held"] or 0.0)) / row["rest"]


def _first_over(keys: DataFrame, state: DataFrame) -> DataFrame:
    """For each source the draw of the first candidate that no longer fits (``cut``) and
    the size of those before it (``got``). keys: source, draw, size; state: source, need."""
    cand = (keys.join(state, keys["k"].eqNullSafe(state["sk"]))
            .where(F.col("size") <= F.col("need")))
    bucket = F.substring("draw", 1, 3)
    sums = cand.groupBy("sk", bucket.alias("b")).agg(F.sum("size").alias("s"))
    run = Window.partitionBy("sk").orderBy("b")
    sums = sums.withColumn("base", F.sum("s").over(run) - F.col("s"))
    edge = (sums.join(state.select(F.col("sk").alias("ek"), F.col("need").alias("limit")),
                      F.col("sk").eqNullSafe(F.col("ek")))
            .where(F.col("base") + F.col("s") > F.col("limit"))
            .groupBy("ek").agg(F.min(F.struct("b", "base")).alias("e")))
    inside = (cand.join(edge, F.col("sk").eqNullSafe(F.col("ek")) & (bucket == F.col("e.b")))
              .groupBy("sk", "draw", "need", F.col("e.base").alias("base"))
              .agg(F.sum("size").alias("s")))
    inside = inside.withColumn(
        "cum", F.sum("s").over(Window.partitionBy("sk").orderBy("draw")) + F.col("base"))
    cut = inside.groupBy("sk").agg(
        F.min(F.when(F.col("cum") > F.col("need"), F.col("draw"))).alias("cut"),
        F.coalesce(F.max(F.when(F.col("cum") <= F.col("need"), F.col("cum"))),
                   F.first("base")).alias("got"))
    total = sums.groupBy(F.col("sk").alias("tk")).agg(F.sum("s").alias("all"))
    return (total.join(cut, F.col("tk").eqNullSafe(F.col("sk")), "left")
            .select("tk", F.coalesce("cut", F.lit("g")).alias("cut"),   # after every hex digit
                    F.coalesce("got", "all").alias("got")))


def mix(docs: DataFrame, *, weights=cyclic_weights, budget_ratio: float = 1.5,
        max_epochs: int = 2, seed: int = 42, rounds: int = 3, source: str = "source",
        text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows of ``docs`` with how often the mix takes them (``copies``)."""
    docs = docs.drop(*ADDED)
    body = text_of(text)
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")),
                          F.lit(":"), F.md5(body)))
    keyed = docs.withColumns({"__mix_size": n_words(body), "__mix_draw": draw})
    keys = written(keyed.select(F.col(source).alias("k"), F.col("__mix_draw").alias("draw"),
                                F.col("__mix_size").alias("size")), "mix-keys")
    sizes = written(keys.groupBy(F.col("k").alias("sk"))
                    .agg(F.sum("size").alias("source_size")), "mix-sizes")
    weighted = weights(sizes.select("sk"), column="sk").withColumnRenamed("sk", "wk")
    clamps = written(
        sizes.join(weighted, F.col("sk").eqNullSafe(F.col("wk")), "left")
        .select("sk", "source_size",
                F.coalesce("weight", F.lit(0.0)).alias("weight"),
                (F.lit(float(max_epochs)) * F.col("source_size")).alias("clamp")), "mix-clamps")
    total = clamps.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(clamps.where("weight > 0 and source_size > 0"), budget_ratio * total)
    share = (F.col("clamp") if level == float("inf")
             else F.least(F.col("clamp"), F.lit(level) * F.col("weight")))
    target = F.when(F.col("weight") > 0, share).otherwise(F.lit(0.0))
    state = clamps.withColumn("target", target).withColumn(
        "whole", F.when(F.col("source_size") > 0,
                        F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    state = written(state.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")),
                    "mix-state")
    for r in range(rounds):
        open_keys = keys
        for i in range(r):     # those that an earlier round has taken are no candidates
            part = state.select(F.col("sk").alias(f"sk{i}"), f"cut{i}", f"most{i}")
            open_keys = (open_keys.join(part, F.col("k").eqNullSafe(F.col(f"sk{i}")))
                         .where(~((F.col("draw") < F.col(f"cut{i}")) & (F.col("size") <= F.col(f"most{i}"))))
                         .drop(f"sk{i}", f"cut{i}", f"most{i}"))
        found = _first_over(open_keys, state.select("sk", "need"))
        state = written(
            state.join(found, F.col("sk").eqNullSafe(F.col("tk")), "left")
            .withColumn(f"cut{r}", F.coalesce("cut", F.lit("")))
            .withColumn(f"most{r}", F.col("need"))
            .withColumn("need", F.col("need") - F.coalesce("got", F.lit(0)))
            .drop("tk", "cut", "got"), f"mix-round{r}")
    extra = F.lit(False)
    for i in range(rounds):
        extra = extra | ((F.col("__mix_draw") < F.col(f"__mix_cut{i}"))
                         & (F.col("__mix_size") <= F.col(f"__mix_most{i}")))
    state = state.select(*[F.col(c).alias(f"__mix_{c}") for c in state.columns])
    return (keyed.join(state, F.col(source).eqNullSafe(F.col("__mix_sk")))
            .withColumn("copies", F.col("__mix_whole") + extra.cast("int"))
            .select(*keyed.columns[:-2], F.col("__mix_size").alias("size"),
                    F.col("__mix_source_size").alias("source_size"),
                    F.col("__mix_target").alias("target"), "copies",
                    (F.col("copies") * F.col("__mix_size")).alias("taken")))


def repeated(mixed: DataFrame) -> DataFrame:
    """One row for each time the mix takes a document."""
    return (mixed.where("copies > 0")
            .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .drop("__mix_copy", *ADDED))
