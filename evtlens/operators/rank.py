"""Per-window top-N and its text report.

Top-N is ``row_number() <= n`` over (window_end ORDER BY cnt DESC, id ASC); Catalyst
turns that into a partial WindowGroupLimit before the shuffle and a final one after
it, so a window with millions of candidates ships at most n rows per task.
Ties are broken by id ascending (the reference keeps arrival order, which is not
reproducible).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evtlens.functions.time import duration_us, format_window_end
from evtlens.session import cut_lineage

# Report layout of the ranking jobs.
REPORT_HEADER = "==================================="
REPORT_FOOTER = "==============================="
REPORT_END_LABEL = "窗口结束时间："
ITEM_LABELS = (" 商品ID = ", " 热门度 = ")
PAGE_LABELS = (" 页面URL = ", " 浏览量 = ")


def top_n(df: DataFrame, n: int = 5, partition: Sequence[str] = ("window_end",),
          score: str = "cnt", id_col: str = "item_id", rank_col: str = "row_num") -> DataFrame:
    """Keep the n best rows per partition, with their 1-based rank."""
    w = Window.partitionBy(*partition).orderBy(F.col(score).desc(), F.col(id_col).asc())
    return (df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
            .where(F.col(rank_col) <= n))


def top_n_segments(runs: DataFrame, n: int, slide, id_col: str = "item_id", score: str = "cnt", rank_col: str = "row_num",
                   block: int = 24, end_col: str = "window_end") -> DataFrame:
    """T1/T3 on runs of constant value (:func:`evtlens.operators.windows.count_segments`) instead of a row
    per id and window: the rows of :func:`top_n`, ties included.

    Runs are cut at blocks of ``block`` window ends. An id that is present all through a block has there at least its
    least value, so the n-th best of these (by value, then id) bounds the ranking of the block from below (a
    threshold as in the threshold algorithm) and worse runs are dropped unexpanded. Between two ends at which
    a run left starts or stops the ranking is constant, so it is made once for such a stretch and only its n
    rows are expanded. The bound comes from a partial top-n; what a block keeps of the change points is at most ``block`` + 1
    values, so no block with very many ids is one task before it is pruned."""
    L = duration_us(slide)
    runs = cut_lineage(runs, "runs")             # they are read for the bound and for the ranking
    top = top_n(ranked_spans(runs, n, slide, id_col, score, block), n, ["_x"], score, id_col, rank_col)
    ends = F.sequence((F.col("_x.s") / 1000).cast("bigint"), ((F.col("_x.e") - L) / 1000).cast("bigint"), F.lit(L // 1000).cast("bigint"))
    return top.select(id_col, F.explode(ends).alias(end_col), score, rank_col)


def ranked_spans(runs: DataFrame, n: int, slide, id_col: str, score: str = "cnt", block: int = 24) -> DataFrame:
    """What :func:`top_n_segments` ranks: (id, score, stretch of window ends ``_x``) that may be among the best n."""
    L = duration_us(slide)
    W = block * L
    first, last = F.floor(F.col("_lo") / W), F.floor((F.col("_hi") - 1) / W)
    pieces = (runs.withColumn("_k", F.explode(F.sequence(first, last)))
              .withColumns({"_lo": F.greatest("_lo", F.col("_k") * W), "_hi": F.least("_hi", (F.col("_k") + 1) * W)}))
    whole = (pieces.groupBy("_k", id_col).agg(F.min(score).alias("_m"), F.sum(F.col("_hi") - F.col("_lo")).alias("_w"))
             .where(F.col("_w") == W))
    order = Window.partitionBy("_k").orderBy(F.col("_m").desc(), F.col(id_col).asc())
    floor = (whole.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).where(F.col("_r") == n)
             .select(F.col("_k").alias("_fk"), "_m", F.col(id_col).alias("_u")))
    worse = (F.col(score) < F.col("_m")) | ((F.col(score) == F.col("_m")) & (F.col(id_col) > F.col("_u")))
    left = (pieces.join(floor, F.col("_k") == F.col("_fk"), "left").where(~F.coalesce(worse, F.lit(False)))
            .select("_k", id_col, score, "_lo", "_hi"))
    points = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array("_lo", "_hi")))))
    cuts = left.groupBy("_k").agg(points.alias("_p")).select(F.col("_k").alias("_ck"), F.arrays_zip(
        F.slice("_p", F.lit(1), F.size("_p") - 1).alias("s"), F.slice("_p", F.lit(2), F.size("_p") - 1).alias("e")).alias("_c"))
    return left.join(cuts, F.col("_k") == F.col("_ck")).select(id_col, score, F.explode(F.filter(
        "_c", lambda x: (x["s"] >= F.col("_lo")) & (x["e"] <= F.col("_hi")))).alias("_x"))


def top_n_sql(spark, view: str, n: int = 5, id_col: str = "item_id") -> DataFrame:
    """The SQL form - ROW_NUMBER in a subquery, filtered outside."""
    return spark.sql(f"""
        SELECT * FROM (
          SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY window_end
                         ORDER BY cnt DESC, {id_col} ASC) AS BIGINT) AS row_num
          FROM {view}) t
        WHERE row_num <= {n}""")


def ranking_report(top: DataFrame, id_col: str = "item_id", labels=ITEM_LABELS,
                   rank_col: str = "row_num", score: str = "cnt") -> DataFrame:
    """One text report per window from top-n rows -> (window_end, report).

    The list per window is bounded by n (input is already top-n)."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(rank_col).alias("r"),
                                                F.col(id_col).cast("string").alias("i"),
                                                F.col(score).alias("c"))))
    line = lambda x: F.concat(F.lit("NO "), x["r"].cast("string"), F.lit(":"), F.lit(labels[0]),
                              x["i"], F.lit(labels[1]), x["c"].cast("string"))
    g = top.groupBy("window_end").agg(rows.alias("_rows"))
    report = F.concat(
        F.lit(REPORT_HEADER + "\n" + REPORT_END_LABEL), format_window_end("window_end"), F.lit("\n"),
        F.concat_ws("", F.transform("_rows", lambda x: F.concat(line(x), F.lit("\n")))),
        F.lit(REPORT_FOOTER + "\n\n"))
    return g.select("window_end", report.alias("report"))


def topn_changelog(top: DataFrame, slide_ms: int, id_col: str = "item_id",
                   rank_col: str = "row_num") -> DataFrame:
    """T4 (batch form): how the ranking changes from one window end to the next.

    Compares the top-n of window ``e`` with the top-n of ``e - slide``: rows that are
    new or changed are ``+`` (insert), rows that left or changed are ``-`` (retract),
    like a retract stream replayed window by window -> (window_end, op, id, cnt, rank).
    Each row is sent to its own window end and to the next; one aggregation on
    (window_end, id) sets the two side by side.
    """
    at = F.array(F.struct(F.col("window_end").alias("e"), F.lit(True).alias("now")),
                 F.struct((F.col("window_end") + F.lit(slide_ms)).alias("e"), F.lit(False).alias("now")))
    row = F.struct("cnt", F.col(rank_col).alias("rank"))
    both = (top.withColumn("_at", F.explode(at)).groupBy(F.col("_at.e").alias("window_end"), id_col)
            .agg(F.max(F.when(F.col("_at.now"), row)).alias("cur"), F.max(F.when(~F.col("_at.now"), row)).alias("prev")))
    ops = F.array(F.struct(F.lit("+").alias("op"), F.col("cur").alias("row")),
                  F.struct(F.lit("-").alias("op"), F.col("prev").alias("row")))
    return (both.where(~F.col("cur").eqNullSafe(F.col("prev"))).withColumn("_op", F.explode(ops))
            .where(F.col("_op.row").isNotNull())
            .select("window_end", F.col("_op.op").alias("op"), id_col, F.col("_op.row.cnt").alias("cnt"),
                    F.col("_op.row.rank").alias(rank_col)))


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """T3 helper: newest row per key (a late update replaces the earlier count), as an
    aggregate (max_by of a struct) so it combines map-side."""
    others = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(version)).alias("_l"))
            .select(*keys, "_l.*"))
