"""Hard-negative mining by a vertical scan (BOND).

For every anchor row: its positives are the rows of its label with the largest inner
products, and the hard negatives of a positive are the rows of other labels with the largest scores
within a window below the positive's score (``window`` percent of it). Components are scaled and
rounded down to integers first, so that scores are exact.

Storage is vertical: vectors are packed into blocks, and a block holds one column per dimension
with its least and greatest value. An anchor reads a block's columns in the order of its own
components' size, largest first, a few columns at a time (4, 8, 16, ...), and keeps a partial
score for each row of its candidate bitmap. What the unread columns can still add lies between
the sums of their least and greatest contributions. A row leaves the bitmap when its upper bound
is below what every window still needs (its lower end, or the last of the best found so far) or its
lower bound is above every window; the rows left after the last column have exact scores.

All anchors meet all rows, in a grid: vectors are dealt into stripes, anchors into groups of
about ``group`` rows, and a cell (stripe, group) is one sorted run within a task that holds the
group's anchors and reads the stripe's blocks one after another. The task keeps the best few per
anchor and window, so a cell returns at most anchors x windows x few rows, whatever the number of
near or equal vectors; row numbers over these give the result. Work grows with anchors x rows, as
the question does; data shuffled is vectors x groups + anchors x stripes. Nothing is collected or
broadcast but counts.

Defined results: rows with a null key, label or vector, or with a null, NaN, infinite or too large
component (65,536 and more: sums might not fit 64 bits) take no part. Vectors of different lengths are
multiplied as far as both go, so an empty one scores 0 with all. Equal scores go by key. Repeated
rows are rows of their own: each counts as a positive or negative, and each anchor row has its
results; rows with the anchor's own key are never its positives. A negative positive_score has an empty
window. An empty table gives no rows.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

LIMIT = 65_536.0
BLOCK_ROWS, BLOCK_VALUES = 2048, 1 << 20
STRIPE_ROWS = 1 << 18
EXACT = float(1 << 53)

BLOCK = "block long, n int, width int, ids binary, labels binary, columns binary"


def usable(vectors: DataFrame, *, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """id, label (long), v (array of floor(scale x component))."""
    fine = F.forall(F.col(vector), lambda c: F.coalesce(F.abs(c.cast("double")) < LIMIT, F.lit(False)))   # NaN is the largest
    return (vectors.where(F.col(key).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & fine)
            .select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                    F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")))


def packed(rows: DataFrame) -> DataFrame:
    """Vertical blocks: ids and labels (int64) and one int32 column per dimension; shorter
    vectors are filled with 0."""

    def block(number, ids, labels, vectors):
        width = max(map(len, vectors))
        columns = np.zeros((width, len(ids)), "<i4")
        for i, v in enumerate(vectors):
            columns[:len(v), i] = v
        return (number, len(ids), width, np.array(ids, "<i8").tobytes(), np.array(labels, "<i8").tobytes(), columns.tobytes())

    def run(batches):
        number, ids, labels, vectors, values = TaskContext.get().partitionId() << 32, [], [], [], 0
        made = []

        def out():
            cols = list(zip(*made, strict=True))
            made.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), *[pa.array(c, pa.int32()) for c in cols[1:3]],
                 *[pa.array(c, pa.binary()) for c in cols[3:]]],
                names=["block", "n", "width", "ids", "labels", "columns"])

        for batch in batches:
            offsets, flat = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            for i, (d, lab) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                v = flat[offsets[i]:offsets[i + 1]]
                ids.append(d)
                labels.append(lab)
                vectors.append(v)
                values += len(v)
                if len(ids) >= BLOCK_ROWS or values >= BLOCK_VALUES:
                    made.append(block(number, ids, labels, vectors))
                    number, ids, labels, vectors, values = number + 1, [], [], [], 0
                    yield out()
        if ids:
            made.append(block(number, ids, labels, vectors))
            yield out()

    small_batches(rows.sparkSession)
    return rows.select("id", "label", "v").mapInArrow(run, BLOCK)


class Best:
    """The best few (score, id) within a window; ``need`` is what a row must reach."""

    __slots__ = ("lo", "hi", "few", "scores", "ids")

    def __init__(self, lo, hi, few: int):
        self.lo, self.hi, self.few = lo, hi, few
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def need(self):
        return max(self.lo, self.scores[-1]) if len(self.scores) == self.few else self.lo

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.need) & (scores <= self.hi)
        if fits.any():
            scores = np.concatenate([self.scores, scores[fits].astype(np.int64)])
            ids = np.concatenate([self.ids, ids[fits]])
            order = np.lexsort((ids, -scores))[:self.few]
            self.scores, self.ids = scores[order], ids[order]


def vertical_scan(anchor: np.ndarray, columns: np.ndarray, least: np.ndarray, greatest: np.ndarray,
                  candidates: np.ndarray, ids: np.ndarray, windows: list[Best], first: int = 4) -> int:
    """Puts the rows of one block that the windows want into them; returns the values read."""
    width = min(len(anchor), len(columns))
    a = anchor[:width]
    order = np.argsort(-np.abs(a), kind="stable")
    order = order[a[order] != 0]
    x, y = a[order] * least[order], a[order] * greatest[order]
    over = np.concatenate([[0], np.cumsum(np.maximum(x, y)[::-1])])[::-1]        # what the columns from j on add at most
    under = np.concatenate([[0], np.cumsum(np.minimum(x, y)[::-1])])[::-1]
    partial = np.zeros(len(candidates), columns.dtype)
    whole, done, step, read = len(candidates) == columns.shape[1], 0, first, 0
    while len(candidates) and done < len(order):
        some = order[done:done + step]
        part = columns[some] if whole else columns[np.ix_(some, candidates)]
        partial = partial + a[some] @ part
        read += part.size
        done += len(some)
        step *= 2
        keep = np.zeros(len(candidates), np.bool_)
        for w in windows:
            keep |= (partial + over[done] >= w.need) & (partial + under[done] <= w.hi)
        if not keep.all():
            candidates, partial, whole = candidates[keep], partial[keep], False
    for w in windows:
        w.take(partial, ids[candidates])
    return read


def _searched(cells: DataFrame, few: int, window: tuple[int, int] | None = None) -> DataFrame:
    """Of the sorted cells: uid, slot (number of the anchor's window), id, score. Without a window
    the best of the anchor's label, else the best of other labels within that many percent of each
    of its ``scores``."""

    def windows_of(scores):
        if window is None:
            return [Best(-(1 << 62), 1 << 62, few)]
        return [Best(-(-window[0] * p // 100), window[1] * p // 100, few) for p in scores]

    def flush(held):
        uid, slot, ids, scores = [], [], [], []
        for u, *_, windows in held:
            for j, w in enumerate(windows):
                uid += [u] * len(w.ids)
                slot += [j] * len(w.ids)
                ids += w.ids.tolist()
                scores += w.scores.tolist()
        return pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(slot, pa.int32()), pa.array(ids, pa.int64()),
                                           pa.array(scores, pa.int64())], names=["uid", "slot", "id", "score"])

    def run(batches):
        cell, held, top = None, [], 0
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                r = {c: batch.column(k)[i] for k, c in enumerate(names)}
                if r["cell"].as_py() != cell:
                    if held:
                        yield flush(held)
                    cell, held, top = r["cell"].as_py(), [], 0
                if r["kind"].as_py() == 0:
                    v = np.array(r["v"].as_py(), np.int64)
                    held.append((r["uid"].as_py(), r["id"].as_py(), r["label"].as_py(), v, windows_of(r["scores"].as_py())))
                    top = max(top, int(np.abs(v).max(initial=0)))
                    continue
                n, width = r["n"].as_py(), r["width"].as_py()
                columns = np.frombuffer(r["columns"].as_py(), "<i4").reshape(width, n)
                ids, labels = np.frombuffer(r["ids"].as_py(), "<i8"), np.frombuffer(r["labels"].as_py(), "<i8")
                least, greatest = columns.min(1, initial=1 << 30), columns.max(1, initial=-(1 << 30))
                largest = max(int(np.abs(least).max(initial=0)), int(np.abs(greatest).max(initial=0)))
                kind = np.float64 if width * top * largest < EXACT else np.int64      # exact either way
                columns, least, greatest = columns.astype(kind), least.astype(kind), greatest.astype(kind)
                for _, key, label, v, windows in held:
                    at = np.flatnonzero((labels == label) & (ids != key) if window is None else labels != label)
                    vertical_scan(v.astype(kind), columns, least, greatest, at, ids, windows)
        if held:
            yield flush(held)

    return cells.mapInArrow(run, "uid long, slot int, id long, score long")


def _cells(blocks: DataFrame, anchors: DataFrame, stripes: int, groups: int) -> DataFrame:
    """The grid: every cell has its anchors first, then its blocks."""
    def none(name, kind):
        return F.lit(None).cast(kind).alias(name)

    stripe = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))
    a = (anchors.withColumn("s", stripe)
         .select((F.col("s") * groups + F.pmod(F.xxhash64("uid"), F.lit(groups))).cast("int").alias("cell"), F.lit(0).alias("kind"),
                 "uid", "id", "label", "v", "scores", none("n", "int"), none("width", "int"),
                 none("ids", "binary"), none("labels", "binary"), none("columns", "binary")))
    b = (blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
         .select((F.pmod(F.xxhash64("block"), F.lit(stripes)) * groups + F.col("g")).cast("int").alias("cell"), F.lit(1).alias("kind"),
                 none("uid", "long"), none("id", "long"), none("label", "long"), none("v", "array<long>"),
                 none("scores", "array<long>"), "n", "width", "ids", "labels", "columns"))
    return a.unionByName(b).repartitionById(stripes * groups, "cell").sortWithinPartitions("cell", "kind")


def _first(found: DataFrame, few: int) -> DataFrame:
    order = Window.partitionBy("uid", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= few)


def mine(vectors: DataFrame, *, every: int = 100, key: str = "vec_id", vector: str = "embedding", label: Column | None = None,
         scale: int = 256, positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100),
         group: int = 1024) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Anchors are the rows
    whose key is divisible by ``every``; a negative's score is between ``window`` percent of the
    positive's."""
    spark = vectors.sparkSession
    rows = usable(vectors, key=key, vector=vector, label=F.col("label") if label is None else label, scale=scale)
    blocks = written(packed(rows), "bond-blocks")
    anchors = written(rows.where(F.col("id") % every == 0).withColumn("uid", F.monotonically_increasing_id()), "bond-anchors")
    n_anchors, n_rows = anchors.count(), blocks.agg(F.sum("n")).first()[0] or 0
    groups = max(1, ceil(n_anchors / group))
    stripes = max(1, ceil(n_rows / STRIPE_ROWS), ceil(2 * spark.sparkContext.defaultParallelism / groups))
    alone = anchors.withColumn("scores", F.lit(None).cast("array<long>"))
    near = written(_first(_searched(_cells(blocks, alone, stripes, groups), positives), positives)
                   .select("uid", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score")), "bond-positives")
    scores = near.groupBy("uid").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "positive_score"))),   # a few
                                                 lambda x: x["positive_score"]).alias("scores"))
    found = _first(_searched(_cells(blocks, anchors.join(scores, "uid"), stripes, groups), negatives, window), negatives)
    return (found.join(near, (found["uid"] == near["uid"]) & (F.col("slot") == F.col("place")))
            .join(anchors.select(F.col("uid").alias("of"), F.col("id").alias("anchor_id")), found["uid"] == F.col("of"))
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
