"""Line dedup over line-ID sequences (DataFrame functions only).

A text is its sequence of lines with words; a line without words belongs to the one before it (is
kept or cut with it, and is not compared). A repeated run is a stretch of lines of one document that
also starts at an earlier place of the corpus; places are ordered by document key (null last),
then by text hash, then by line. A run is maximal if it can't be longer at either end. Of every maximal
repeated run with at least ``min_words`` words the later copy is cut; a single line may be a run.

All suffixes of the line sequences are named by prefix doubling: the name of the first 2k lines of a
suffix is made from the names of its first k lines and of the k lines behind them. Names are 128-bit
hashes of the pair, so equal runs get equal names on every executor without exchanging
them. Suffixes with a common prefix of m lines are an interval of the suffix array (its longest
common prefix is m or more), and they share the name of that prefix, put together from doubled names by the
binary digits of m. Which intervals are asked for follows from the words: a line lies in a repeated
run of enough words exactly if it lies in a repeated run that loses them when a line is taken off its
end (the shortest run with enough words from some line on) or off its start (the shortest up to some
line), as any longer run can be shortened around the line, and a part of a repeated run is
repeated. Each line starts one run of the first kind and ends one of the second, with
fewer than ``min_words`` lines, so doubling ends there; deeper names would repeat the same verdicts. The runs
cut are the unions of such windows, which are the maximal ones.

The named windows (no texts) are written to the shared folder once and read twice. One
partially combined aggregation finds the first place of each repeated name (the interval's least place); a join
finds the later ones (a run with very many copies is a skewed key, which adaptive execution
splits); the texts are shuffled once, to take out their lines.

Defined results: a null text stays null and has no lines; a text without words is kept; lines without words
at the start of a text are kept; rows equal in key and text are one document and keep the
same lines; a document whose lines are all repeated becomes empty and stays a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, written

ADDED = ["n_lines", "n_removed_lines", "n_runs", "kept_text"]

#: Between a line with its wordless followers and the next line with words.
BORDER = r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])"


def _doubled(names: Column, step: int) -> Column:
    """Names of runs twice as long, each from the names of its two halves."""
    n = F.greatest(F.size(names) - step, F.lit(0))
    return F.zip_with(F.slice(names, 1, n), F.slice(names, step + 1, n), lambda x, y: F.struct(
        F.xxhash64(x["a"], y["a"]).alias("a"), F.xxhash64(y["b"], x["b"], F.lit(7)).alias("b"), (x["w"] + y["w"]).alias("w")))


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _window(levels: Column, depth: int, at: Column, min_words: int, forward: bool) -> Column:
    """The shortest run with ``min_words`` words that starts (or ends) at a line: its name and words (a, b, w),
    lines (l) and the words without the last line taken (v); null where the text ends before. The longest
    run with too few words is put together from doubled names, largest first; then a line is added."""
    def longer(s, level, size, fits):
        spot = at + s["l"] if forward else at - s["l"] - (size - 1)
        return _bound(F.when(spot >= 0, F.get(F.get(levels, level), spot)), lambda x: F.when(
            fits(s["w"] + x["w"]), F.struct(
                F.xxhash64(s["a"], x["a"]).alias("a"), F.xxhash64(x["b"], s["b"]).alias("b"), (s["w"] + x["w"]).alias("w"),
                (s["l"] + size).alias("l"), s["w"].alias("v"))))

    none = F.struct(F.lit(3 if forward else 5).cast("long").alias("a"), F.lit(11).cast("long").alias("b"),
                    F.lit(0).alias("w"), F.lit(0).alias("l"), F.lit(0).alias("v"))
    steps = F.array(*[F.struct(F.lit(j).alias("level"), F.lit(1 << j).alias("size")) for j in reversed(range(depth))])
    short = F.aggregate(steps, none, lambda s, j: F.coalesce(longer(s, j["level"], j["size"], lambda w: w < min_words), s))
    return _bound(short, lambda s: longer(s, F.lit(0), F.lit(1), lambda w: w >= min_words))


def windows(docs: DataFrame, *, key: str, text: str, min_words: int) -> DataFrame:
    """One row per shortest run with enough words: name (a, b), place (n, k, r, q, p), lines (l)."""
    df = docs.where(F.regexp_like(text, F.lit(WORD))).select(
        F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.xxhash64(key, text).alias("r"),
        F.xxhash64(F.lit(7), text, key).alias("q"),
        F.transform(F.split(F.col(text), BORDER, -1), lambda x: _bound(F.substring_index(x, "\n", 1), lambda y: F.struct(
            F.xxhash64(y).alias("a"), F.xxhash64(F.lit(7), y).alias("b"), F.regexp_count(y, F.lit(WORD)).alias("w")))).alias("n0"))
    depth, names = 1, ["n0"]
    while 1 << depth < min_words:
        df = df.withColumn(f"n{depth}", _doubled(F.col(names[-1]), 1 << (depth - 1)))
        names.append(f"n{depth}")
        depth += 1
    df = df.withColumn("levels", F.array(*names)).drop(*names[1:])

    def both(x, i):
        start = _window(F.col("levels"), depth, i, min_words, True)
        end = _window(F.col("levels"), depth, i, min_words, False)
        alone = F.struct(x["a"].alias("a"), x["b"].alias("b"), i.alias("p"), F.lit(1).alias("l"))
        first = _bound(start, lambda s: F.when(s.isNotNull(), F.struct(s["a"].alias("a"), s["b"].alias("b"), i.alias("p"), s["l"].alias("l"))))
        # without its last line it has enough words too: another line's run of the first kind, unless so
        last = _bound(end, lambda e: F.struct(e["a"].alias("a"), e["b"].alias("b"), (i - e["l"] + 1).alias("p"), e["l"].alias("l"),
                                              (e["w"] - x["w"]).alias("v")))
        last = _bound(last, lambda e: F.when(e["v"] >= min_words, F.struct(e["a"].alias("a"), e["b"].alias("b"), e["p"].alias("p"), e["l"].alias("l"))))
        return F.when(x["w"] >= min_words, F.array(alone)).when(x["w"] > 0, F.array(first, last))

    df = df.select("n", "k", "r", "q", F.explode(F.flatten(F.filter(F.transform("n0", both), lambda x: x.isNotNull()))).alias("x"))
    return df.where("x is not null").select("n", "k", "r", "q", "x.p", "x.l", "x.a", "x.b")


def deduplicated(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = 12) -> DataFrame:
    """``docs`` with n_lines, n_removed_lines, n_runs (maximal stretches of deleted lines), kept_text."""
    docs = docs.drop(*[c for c in ADDED if c not in (key, text)])
    every = written(windows(docs, key=key, text=text, min_words=min_words), "line-windows")
    place = F.struct("n", "k", "r", "q", "p")
    first = (every.groupBy(F.col("a").alias("fa"), F.col("b").alias("fb"))
             .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
             .where("copies > 1").drop("copies"))
    later = (every.join(first, (F.col("a") == F.col("fa")) & (F.col("b") == F.col("fb")))
             .where(place > F.col("first"))
             .groupBy(F.col("r").alias("__l_r"), F.col("q").alias("__l_q"))
             .agg(F.collect_set(F.struct("p", "l")).alias("__l_p")))          # lines of one document at most
    own = docs.withColumns({"__l_r0": F.xxhash64(key, text), "__l_q0": F.xxhash64(F.lit(7), text, key)})
    df = own.join(later, (F.col("__l_r0") == F.col("__l_r")) & (F.col("__l_q0") == F.col("__l_q")), "left")
    df = df.withColumn("__l_cut", F.array_distinct(F.flatten(F.transform(
        "__l_p", lambda x: F.sequence(x["p"], x["p"] + x["l"] - 1)))))
    df = df.withColumn("__l_lines", F.when(F.col("__l_cut").isNotNull(), F.split(F.col(text), BORDER, -1)))
    left = F.array_except(F.sequence(F.lit(0), F.size("__l_lines") - 1), F.col("__l_cut"))
    kept = F.when(F.col("__l_cut").isNull(), F.col(text)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("__l_lines", i)), "\n"))
    cut = F.coalesce("__l_cut", F.array().cast("array<int>"))
    gone = F.aggregate(cut, F.lit(0), lambda s, i: s + 1 + F.regexp_count(F.get("__l_lines", i), F.lit("\n")))
    return df.select(
        *docs.columns, F.coalesce(F.regexp_count(text, F.lit("\n")) + 1, F.lit(0)).cast("long").alias("n_lines"),
        gone.cast("long").alias("n_removed_lines"),
        F.size(F.array_except(cut, F.transform(cut, lambda x: x + 1))).cast("long").alias("n_runs"),
        kept.alias("kept_text"))
