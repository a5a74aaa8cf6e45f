"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: 64 bits over word shingles; a bit is 1 where more than half of the shingle
hashes (XXH64, seed 42) have it. Two documents are linked when their fingerprints differ
in at most ``distance`` bits; groups are the connected components of these links.

Search. The 64 bits are split into m parts with thresholds t_1..t_m that sum to
``distance - m + 1``: two fingerprints within the distance then agree up to t_i bits in at
least one part i (the generalised pigeonhole principle; -1 leaves a part unused).

* Bits that vary together go to the same part: correlations come from the co-occurrence
  counts of all distinct fingerprints (64 x 64 numbers, summed on the executors).
* Part count and thresholds come from a dynamic program over the estimated number of
  candidates and of keys, from the bits' frequencies and the number of fingerprints.
* A fingerprint is put under one key per part and choice of t_i masked bits, so that two
  values within t_i of each other share a key; keys with one member are dropped.
* Members of a key are compared by XOR and bit count. A key with more members than
  ``block`` is cut into blocks, and each pair of blocks is a group of its own, so no task
  holds more than two blocks. Of the links found in a group a spanning forest is passed
  on, never all pairs: components need no more, and no link between groups is lost.

Exact copies share a fingerprint and are one vertex, however many there are.

Defined results: a null or wordless text has fingerprint 0 and is linked like any other;
with a null key a document is never the name of its component, unless all keys in it are
null (then the component is null); repeated rows get equal results; an empty table gives
an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written
from .components import components
from .packing import slabs

#: Lane table: byte -> its eight bits (most significant first) as the bytes of a uint64.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).copy().view(np.uint64).ravel()


def shingle_hashes(text: bytes, size: int, seed: int) -> list[int]:
    from xxhash import xxh64_intdigest as xx

    words = text.lower().split()          # bytes: A-Z only; space, \t \n \v \f \r
    if len(words) <= size:
        return [xx(b" ".join(words), seed)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [xx(joined[s:e], seed) for s, e in zip(starts[:len(words) - size + 1].tolist(),
                                                  ends[size - 1:].tolist(), strict=True)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints (uint64) of consecutive runs of ``counts`` hashes."""
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    if not full.any():
        return out
    n = counts[full]
    lanes = _LANES[np.ascontiguousarray(hashes.astype(">u8")).view(np.uint8).reshape(-1, 8)]
    blocks = -(-n // 255)                 # a lane holds up to 255
    starts = np.concatenate(([0], np.cumsum(n)[:-1]))
    first = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    at = np.repeat(starts, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    sums = np.add.reduceat(lanes, at, axis=0).view(np.uint8).reshape(-1, 64)
    total = np.add.reduceat(sums, first, axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > n[:, None], axis=1)
    out[full] = bits.view(">u8").ravel().astype(np.uint64)
    return out


def fingerprints(docs: DataFrame, *, shingle: int = 3, seed: int = 42, text: str = "text",
                 carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """carry columns and fp (the 64 bits as a signed long)."""
    kinds = dict((f.name, f.dataType) for f in docs.schema)

    def run(batches):
        for batch in batches:
            names = [*carry, "fp"]
            for first, texts in slabs(batch.column(len(carry)), 1_000_000):
                each = [shingle_hashes(t, shingle, seed) for t in texts]
                counts = np.array([len(e) for e in each], np.int64)
                flat = np.fromiter((h for e in each for h in e), np.uint64, int(counts.sum()))
                fp = majority(flat, counts).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(first, len(texts)) for i in range(len(carry))], pa.array(fp)],
                    names=names)

    small_batches(docs.sparkSession)
    schema = ", ".join([*[f"`{c}` {kinds[c].simpleString()}" for c in carry], "fp long"])
    return docs.select(*carry, F.col(text).alias("text")).mapInArrow(run, schema)


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 co-occurrence counts of their bits."""
    def run(batches):
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).astype(">i8")
            bits = np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
            total += bits.T @ bits
            n += len(x)
        i, j = np.divmod(np.arange(4096), 64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, -1)), pa.array(np.append(j, -1)), pa.array(np.append(total.ravel(), n).astype(np.int64))],
            names=["i", "j", "n"])

    rows = (fps.select("fp").mapInArrow(run, "i long, j long, n long")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())      # 4,097 rows
    counts, n = np.zeros((64, 64)), 0
    for r in rows:
        if r["i"] < 0:
            n = r["n"]
        else:
            counts[r["i"], r["j"]] = r["n"]
    return n, counts


def group_bits(correlation: np.ndarray, m: int) -> list[list[int]]:
    """m parts of nearly equal size; each grows by the bits most correlated with it."""
    left, parts = set(range(64)), []
    for k in range(m):
        size = len(left) // (m - k)
        part = [max(left, key=lambda b: (correlation[b, sorted(left)].sum(), -b))]
        left.discard(part[0])
        while len(part) < size:
            part.append(max(left, key=lambda b: (correlation[b, part].sum(), -b)))
            left.discard(part[-1])
        parts.append(sorted(part))
    return parts


def plan(n: int, counts: np.ndarray, distance: int, max_parts: int = 4,
         key_cost: float = 4.0) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part in use, of least estimated cost over all part counts."""
    from math import comb

    share = np.diag(counts) / max(n, 1)
    cov = counts / max(n, 1) - np.outer(share, share)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = np.abs(cov / np.outer(spread, spread))
    np.fill_diagonal(correlation, 0.0)
    differ = 2 * share * (1 - share)              # chance that two fingerprints differ in a bit
    best: tuple[float, list] | None = None
    for m in range(1, min(max_parts, distance + 1) + 1):
        parts = group_bits(correlation, m)

        def cost(bits, t):
            if t < 0:
                return 0.0
            if t >= len(bits):
                return float("inf")
            at = np.zeros(distance + 2)           # distribution of the part's distance
            at[0] = 1.0
            for b in bits:
                at[1:] = at[1:] * (1 - differ[b]) + at[:-1] * differ[b]
                at[0] *= 1 - differ[b]
            keys = n * comb(len(bits), t)
            return key_cost * keys + comb(len(bits), t) * at[:t + 1].sum() * n * n / 2

        need = distance - m + 1
        table = {0: (0.0, [])}                    # sum of thresholds (+1 each) so far -> cost, choice
        for bits in parts:
            step: dict[int, tuple[float, list]] = {}
            for s, (c, chosen) in table.items():
                for t in range(-1, distance + 1):
                    x = (c + cost(bits, t), [*chosen, t])
                    if s + t + 1 <= need + m and (s + t + 1 not in step or x[0] < step[s + t + 1][0]):
                        step[s + t + 1] = x
            table = step
        c, chosen = table[need + m]
        if best is None or c < best[0]:
            best = (c, [(bits, t) for bits, t in zip(parts, chosen, strict=True) if t >= 0])
    return best[1]


def _masks(parts: list[tuple[list[int], int]]) -> list[int]:
    """One mask per key of a fingerprint: a part's bits without t masked ones (bit 0 is the
    most significant)."""
    out = []
    for bits, t in parts:
        for wild in combinations(bits, t):
            out.append(sum(1 << (63 - b) for b in bits if b not in wild))
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each vertex's component under links a-b."""
    lab = np.arange(n)
    while True:
        m = np.minimum(lab[a], lab[b])
        old = lab.copy()
        np.minimum.at(lab, a, m)
        np.minimum.at(lab, b, m)
        np.minimum.at(lab, old[a], m)
        np.minimum.at(lab, old[b], m)
        lab = lab[lab]
        if np.array_equal(lab, old):
            return lab


def group_links(group: np.ndarray, fp: np.ndarray, distance: int, most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (row, row) of the links within runs of equal ``group``."""
    n = len(fp)
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(start, n))
    last = np.repeat(start + size - 1, size)
    ia, ib, held = [], [], 0
    rows = np.arange(n)
    for d in range(1, int(size.max(initial=1))):
        rows = rows[rows + d <= last[rows]]
        if not len(rows):
            break
        hit = rows[np.bitwise_count(fp[rows] ^ fp[rows + d]) <= distance]
        if len(hit):
            ia.append(hit)
            ib.append(hit + d)
            held += len(hit)
            if held > most:               # what is known so far shrinks to one link per row
                lab = forest(n, np.concatenate(ia), np.concatenate(ib))
                own = np.flatnonzero(lab != np.arange(n))
                ia, ib, held = [own], [lab[own]], len(own)
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lab = forest(n, np.concatenate(ia), np.concatenate(ib))
    own = np.flatnonzero(lab != np.arange(n))
    return own, lab[own]


def links(fps: DataFrame, *, distance: int = 3, block: int = 4096) -> DataFrame:
    """fps: distinct fp. Links (u, v) whose components are those of all pairs within the
    distance."""
    n, counts = bit_counts(fps)
    masks = np.array(_masks(plan(n, counts, distance)), np.uint64).view(np.int64)

    def keyed(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for slot, mask in enumerate(masks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), slot, np.int32)), pa.array(fp & mask), pa.array(fp)],
                    names=["slot", "key", "fp"])

    keys = fps.select("fp").mapInArrow(keyed, "slot int, key long, fp long")
    sizes = (keys.groupBy(F.col("slot").alias("s"), F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").withColumn("blocks", F.ceil(F.col("n") / block).cast("int")))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    members = (keys.join(sizes, (F.col("slot") == F.col("s")) & (F.col("key") == F.col("k")))
               .withColumn("own", own)
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select(F.xxhash64("slot", "key", F.least("own", "other"), F.greatest("own", "other")).alias("g"),
                       "slot", "key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "fp"))
    # rows of a group stand together; a chance collision of g only adds comparisons
    members = members.select("g", "fp").repartition("g").sortWithinPartitions("g", "fp")

    def compare(batches):
        def found(g, fp):
            a, b = group_links(g, fp.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["u", "v"])

        g0, f0 = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            g = np.concatenate((g0, batch.column(0).to_numpy(zero_copy_only=False)))
            f = np.concatenate((f0, batch.column(1).to_numpy(zero_copy_only=False)))
            if not len(g):
                continue
            cut = int(np.searchsorted(g, g[-1]))      # the last group may go on
            if cut:
                yield found(g[:cut], f[:cut])
            g0, f0 = g[cut:], f[cut:]
        if len(g0):
            yield found(g0, f0)

    return members.mapInArrow(compare, "u long, v long")


def groups(docs: DataFrame, *, shingle: int = 3, distance: int = 3, seed: int = 42, block: int = 4096,
           text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """key, carry columns, fp, root (a fingerprint that names the group) and component_id
    (the least key of the group)."""
    fps = written(fingerprints(docs, shingle=shingle, seed=seed, text=text, carry=(key, *carry)), "simhash-fp")
    distinct = written(fps.groupBy("fp").agg(F.min(key).alias("least")), "simhash-distinct")
    found = components(links(distinct, distance=distance, block=block))
    rooted = (distinct.join(found, F.col("fp") == F.col("vertex"), "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    to = rooted.select(F.col("fp").alias("to_fp"), "root").join(named, "root").select("to_fp", "root", "component_id")
    return fps.join(to, F.col("fp") == F.col("to_fp")).drop("to_fp")


def keep_one(docs: DataFrame, *, shingle: int = 3, distance: int = 3, text: str = "text",
             key: str = "doc_id") -> DataFrame:
    """One document of each group: that with the least key (of several rows with that key,
    the one with the least hash of all columns; of equal rows, one)."""
    own = docs.withColumn("__sh_row", F.xxhash64(*[F.col(c) for c in docs.columns]))
    found = groups(own, shingle=shingle, distance=distance, text=text, key=key, carry=("__sh_row",))
    order = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col("__sh_row").alias("r"))
    keep = found.groupBy("root").agg(F.min(order).alias("o")).select(
        F.col("o.k").alias("__sh_k"), F.col("o.r").alias("__sh_r"))
    return (own.join(keep, F.col(key).eqNullSafe(F.col("__sh_k")) & (F.col("__sh_row") == F.col("__sh_r")), "left_semi")
            .dropDuplicates([key, "__sh_row"]).drop("__sh_row"))
