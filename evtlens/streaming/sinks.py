"""S9, S10, S12, T1/T3/T4, E4 sinks for Structured Streaming.

All writers are ``foreachBatch`` functions. What a micro-batch writes lies in folders of
its own batch id and replaces what an earlier try of the same batch left there; what it
reads of the store is limited to smaller batch ids. So a batch that is tried again, after
a stop between any two writes, gives the same store. Paths must be on shared storage (e.g.
under ``spark.checkpoint.dir``); never a machine-local folder on a cluster.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evtlens.functions.time import duration_us, epoch_us
from evtlens.operators import rank as T
from evtlens.operators.windows import run_segments
from evtlens.session import batch_session
from evtlens.streaming.eventtime import split_late
from evtlens.streaming.store import DAY_MS, DayStore, KeyedStore, upsert


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there, asked of the file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def console(writer, label: str, mode: str = "append"):
    """Start a stream writer on the labelled print sink."""
    return writer.format("console").outputMode(mode).option("truncate", "false").queryName(label).start()


def printed(path: str, label: str, rows: int = 20) -> Callable[[DataFrame, int], None]:
    """S9 as a ``foreachBatch`` sink that also keeps what it was given: prints the first ``rows`` of a batch under
    the label, and writes all of them, labelled."""
    def run(batch: DataFrame, batch_id: int) -> None:
        labelled = batch.withColumn("label", F.lit(label)).persist()
        try:
            print(f"{label}, batch {batch_id}")
            labelled.show(rows, truncate=False)
            _write(labelled, path, batch_id)
        finally:
            labelled.unpersist()
    return run


def _write(batch: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    w = batch.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/batch={batch_id}")


def keyed_upsert(path: str, keys: Sequence[str], version: str | None = None, every: int = 10) -> Callable[[DataFrame, int], None]:
    """``store[key] = value``, newest ``version`` wins (``None``: the newest batch
    wins, as for update-mode output), in a :class:`evtlens.streaming.store.KeyedStore`."""
    return upsert(path, keys, every, version=version)


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """The newest row per key: a snapshot and at most ``every`` segments."""
    return KeyedStore(path, keys, version=version).read(spark)


def route_writer(path: str, route_col: str = "route") -> Callable[[DataFrame, int], None]:
    """One micro-batch, N named outputs (``route=<name>`` sub-folders), one pass."""
    def run(batch: DataFrame, batch_id: int) -> None:
        _write(batch, path, batch_id, [route_col])
    return run


def read_route(spark: SparkSession, path: str, route: str, route_col: str = "route") -> DataFrame:
    return spark.read.parquet(path).where(F.col(route_col) == route).drop("batch")


def top_stores(path: str, keys: Sequence[str], id_col: str, every: int = 10) -> tuple[DayStore, DayStore]:
    """The newest count per (window, id), and the newest ranking per window, by the day of the window's end."""
    keys = list(keys)

    def newest_ranking(rows: DataFrame) -> DataFrame:
        last = rows.groupBy(*keys).agg(F.max("batch").alias("batch"))
        return rows.join(last, keys + ["batch"]).drop("batch")

    counts = DayStore(f"{path}/counts", keys[0], lambda rows: T.latest_per_key(rows, keys + [id_col], "batch").drop("batch"), every)
    return counts, DayStore(f"{path}/top", keys[0], newest_ranking, every)


def topn_writer(path: str, n: int, id_col: str, keys: Sequence[str] = ("window_end",),
                version: str = "cnt", every: int = 10) -> Callable[[DataFrame, int], None]:
    """Per micro-batch of window counts (append or update mode), merge with
    the stored newest count per (window, id) of the touched windows, rank by ``version``
    (the count), and write the new top-n rows and the changelog ('+' new/changed, '-'
    left/changed) against the previous top-n of those windows. The first key is the window's
    end in milliseconds; the store is partitioned by its day and only the days of the
    batch are read."""
    keys = list(keys)
    counts_store, top_store = top_stores(path, keys, id_col, every)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        top = None
        try:
            days = [r[0] for r in batch.select(F.floor(F.col(keys[0]) / DAY_MS).cast("long")).distinct().collect()]
            touched = batch.select(*keys).distinct()
            old = counts_store.read(spark, days, batch_id, batch.schema).withColumn("batch", F.lit(-1).cast("long"))
            counts = batch.withColumn("batch", F.lit(batch_id).cast("long")).unionByName(
                old.join(touched, keys, "left_semi"))
            latest = T.latest_per_key(counts, keys + [id_col], "batch").drop("batch")
            top = T.top_n(latest, n, tuple(keys), score=version, id_col=id_col).persist()
            _write(_ranking_changes(top, top_store.read(spark, days, batch_id, top.schema), touched, keys, id_col, version),
                   f"{path}/changelog", batch_id)
            top_store.write(top, batch_id, days)
            counts_store.write(batch, batch_id, days)
        finally:
            if top is not None:
                top.unpersist()
            batch.unpersist()
    return run


def _ranking_changes(top: DataFrame, stored: DataFrame, touched: DataFrame, keys: Sequence[str], id_col: str, version: str) -> DataFrame:
    """The changelog from the stored rankings of the touched windows to ``top``."""
    prev = stored.join(touched, list(keys), "left_semi").select(
        *keys, id_col, F.col(version).alias("c0"), F.col("row_num").alias("r0"))
    cur = top.select(*keys, id_col, F.col(version).alias("c1"), F.col("row_num").alias("r1"))
    j = cur.join(prev, [*keys, id_col], "full_outer")
    same = F.col("c1").eqNullSafe(F.col("c0")) & F.col("r1").eqNullSafe(F.col("r0"))
    return (j.where(F.col("r1").isNotNull() & ~same)
            .select(*keys, F.lit("+").alias("op"), id_col, F.col("c1").alias(version), F.col("r1").alias("row_num"))
            .unionByName(j.where(F.col("r0").isNotNull() & ~same)
                         .select(*keys, F.lit("-").alias("op"), id_col, F.col("c0").alias(version), F.col("r0").alias("row_num"))))


def pane_topn_writer(path: str, n: int, id_col: str, size, slide, every: int = 10,
                     then: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """T1/T3/T4 on panes: per micro-batch of the newest counts of (pane start ``_p`` in us, id), in update mode, store the
    panes, rank the windows that hold one of them from runs of constant count (:func:`evtlens.operators.rank.top_n_segments`),
    and write the new top-n rows and the changelog where :func:`topn_writer` does. A view is one stored row of its
    pane, not one of every window; only the days that the touched windows reach are read. ``then`` gets the new top-n rows."""
    S, L = duration_us(size), duration_us(slide)
    end = ["window_end"]
    panes = DayStore(f"{path}/panes", "_at", lambda rows: T.latest_per_key(rows, ["_p", id_col], "batch").drop("batch"), every)
    _, top_store = top_stores(path, end, id_col, every)

    def days_of(df: DataFrame, *ms) -> list[int]:
        day = F.explode(F.sequence(*[F.floor(x / DAY_MS).cast("long") for x in ms]))
        return [r[0] for r in df.select(day.alias("d")).distinct().collect()]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch_session(batch.sparkSession)
        batch = batch.withColumn("_at", F.floor(F.col("_p") / 1000)).persist()
        try:
            own = days_of(batch, F.col("_at"), F.col("_at"))
            panes.write(batch, batch_id, own)
            schema = batch.schema
        finally:
            batch.unpersist()
        if not own:
            return
        new = spark.read.schema(schema).parquet(*[f"{path}/panes/segment/day={d}/batch={batch_id}" for d in own])
        ends = F.explode(F.sequence(F.col("_p") + L, F.col("_p") + S, F.lit(L)))
        touched = (new.select("_p").distinct().select(ends.alias("_e"))
                   .select((F.col("_e") / 1000).cast("long").alias("window_end")).distinct().persist())
        top = None
        try:
            near = days_of(touched, F.col("window_end") - S // 1000, F.col("window_end"))
            known = panes.read(spark, near, batch_id + 1, schema)
            runs = run_segments(known, S, L, [id_col], ["cnt"], "cnt")
            top = (T.top_n_segments(runs, n, slide, id_col).join(touched, end, "left_semi")
                   .select(id_col, *end, "cnt", "row_num").persist())
            days = days_of(touched, F.col("window_end"), F.col("window_end"))
            _write(_ranking_changes(top, top_store.read(spark, days, batch_id, top.schema), touched, end, id_col, "cnt"),
                   f"{path}/changelog", batch_id)
            top_store.write(top, batch_id, days)
            if then is not None:
                then(top, batch_id)
        finally:
            if top is not None:
                top.unpersist()
            touched.unpersist()
    return run


def top_reports(path: str, id_col: str, labels=T.ITEM_LABELS) -> Callable[[DataFrame, int], None]:
    """S11 as a sink of the top-n rows of whole windows, as :func:`pane_topn_writer` hands them on."""
    store = KeyedStore(path, ["window_end"])

    def run(top: DataFrame, batch_id: int) -> None:
        store.write(T.ranking_report(top, id_col, labels), batch_id)
    return run


def report_writer(path: str, top_path: str, id_col: str, labels=T.ITEM_LABELS) -> Callable[[DataFrame, int], None]:
    """S11 as a sink: after :func:`topn_writer` (on ``top_path``) has taken the batch, write
    the text report of every window it touched."""
    store = KeyedStore(path, ["window_end"])

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = batch.select("window_end").distinct().persist()
        try:
            days = [r[0] for r in touched.select(F.floor(F.col("window_end") / DAY_MS).cast("long")).distinct().collect()]
            top = read_top(spark, top_path, id_col=id_col, days=days).join(touched, "window_end", "left_semi")
            store.write(T.ranking_report(top, id_col, labels), batch_id)
        finally:
            touched.unpersist()
    return run


def late_writer(path: str, ts: str = "ts", bound="1 second", size="10 minutes", slide="5 seconds",
                lateness="1 minute") -> Callable[[DataFrame, int], None]:
    """Main and late rows of one run, in ``main`` and ``late`` folders. The watermark a
    batch runs with is the newest event time of the batches before it less ``bound``,
    kept in ``marks`` (one row, compacted)."""
    b = duration_us(bound)

    marks = KeyedStore(f"{path}/marks", ["k"], {"u": F.max})

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            known = marks.read(spark, "k int, u long", before=batch_id)
            newest = None if known is None else known.first()["u"]
            on_time, late = split_late(batch, None if newest is None else newest - b, ts, size, slide, lateness)
            _write(on_time, f"{path}/main", batch_id)
            _write(late, f"{path}/late", batch_id)
            marks.write(batch.agg(F.max(epoch_us(ts)).alias("u")).select(F.lit(0).alias("k"), "u"), batch_id)
        finally:
            batch.unpersist()
    return run


def read_top(spark: SparkSession, path: str, keys: Sequence[str] = ("window_end",),
             id_col: str = "item_id", days=None) -> DataFrame:
    """Newest top-n of every window (of those days) from a :func:`topn_writer` folder."""
    _, top = top_stores(path, keys, id_col)
    have = top._list(spark, "segment", "day=")
    written = spark.read.parquet(f"{path}/top/segment").drop("day", "batch").schema
    return top.read(spark, have if days is None else days, 1 << 62, written)
