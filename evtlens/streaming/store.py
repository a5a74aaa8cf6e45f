"""A keyed table that micro-batches update, with compaction.

A batch appends its newest rows per key as a segment. Every ``every`` batches the table as of that batch is
written whole as a snapshot and published by one pointer file named after the batch, so a read takes the newest
snapshot and the segments behind it: its cost depends on the number of keys, not on the stream's age.

Order of writes: segment, snapshot, pointer, removal of what the *previous* snapshot made needless. A batch that is
tried again after a stop between any two of these replaces its own files and reads only what lies before it, so the
store comes out the same. The last snapshot but one stays, for that and for readers that began before.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from evtlens.operators import rank as T

DAY_MS = 86_400_000
FILES_PER_DAY = 4             # that a batch writes


class KeyedStore:
    """``keys`` -> one row. With ``merge`` (aggregates by column name) a new row is combined with the
    stored one; otherwise the row with the greatest ``version`` stays, or without that the newest batch's.
    Columns are those of the batches."""

    def __init__(self, path: str, keys: Sequence[str], merge: dict | None = None, every: int = 10, version: str | None = None):
        self.path, self.keys, self.merge, self.every, self.version = path, list(keys), merge, every, version

    # ---- files
    def _fs(self, spark: SparkSession, sub: str = ""):
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{sub}" if sub else self.path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()), p

    def _numbers(self, spark: SparkSession, sub: str) -> list[int]:
        fs, p = self._fs(spark, sub)
        return sorted(int(x.getPath().getName()) for x in fs.listStatus(p)) if fs.exists(p) else []

    def _drop(self, spark: SparkSession, sub: str) -> None:
        fs, p = self._fs(spark, sub)
        fs.delete(p, True)

    def snapshot(self, spark: SparkSession, before: int | None = None) -> int | None:
        """Batch of the newest published snapshot (of those older than ``before``)."""
        found = [x for x in self._numbers(spark, "current") if before is None or x < before]
        return found[-1] if found else None

    def tail(self, spark: SparkSession, before: int | None = None) -> list[int]:
        """Batches whose segments a read must add to the snapshot."""
        base = self.snapshot(spark, before)
        return [x for x in self._numbers(spark, "segment") if (base is None or x > base) and (before is None or x < before)]

    # ---- rows
    def _newest(self, rows: DataFrame) -> DataFrame:
        if self.merge is None:
            rows = rows.withColumn("_v", F.struct(self.version, "_batch") if self.version else F.col("_batch"))
            return T.latest_per_key(rows, self.keys, "_v").drop("_batch", "_v")
        return rows.groupBy(*self.keys).agg(*[f(c).alias(c) for c, f in self.merge.items()])

    def read(self, spark: SparkSession, schema=None, before: int | None = None) -> DataFrame | None:
        """The table (as of the batches before ``before``); None when nothing is stored yet."""
        base, parts = self.snapshot(spark, before), []
        if base is not None:
            parts.append(self._load(spark, f"{self.path}/snapshot/{base}", schema).withColumn("_batch", F.lit(base).cast("long")))
        for x in self.tail(spark, before):           # at most ``every``
            parts.append(self._load(spark, f"{self.path}/segment/{x}", schema).withColumn("_batch", F.lit(x).cast("long")))
        if not parts:
            return None
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return rows.drop("_batch") if len(parts) == 1 else self._newest(rows)

    def _load(self, spark, path, schema):
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Append the batch's rows (one per key: :meth:`newest_of`) and compact when it is due."""
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{self.path}/segment/{batch_id}")
        if len([x for x in self.tail(spark, batch_id + 1) if x <= batch_id]) >= self.every:
            self.compact(spark, batch_id)

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        older = self.snapshot(spark, batch_id)
        self.read(spark, before=batch_id + 1).write.mode("overwrite").parquet(f"{self.path}/snapshot/{batch_id}")
        fs, p = self._fs(spark, f"current/{batch_id}")
        fs.create(p, True).close()                   # the pointer: readers see the snapshot from here on
        if older is None:
            return
        for x in self._numbers(spark, "segment"):
            if x <= older:
                self._drop(spark, f"segment/{x}")
        for x in self._numbers(spark, "current"):
            if x < older:
                self._drop(spark, f"current/{x}")
                self._drop(spark, f"snapshot/{x}")

    def newest_of(self, batch: DataFrame) -> DataFrame:
        """One row per key of a batch, combined map-side."""
        return self._newest(batch.withColumn("_batch", F.lit(0).cast("long")))


class DayStore:
    """Rows under the day of a time column, for stores of which a batch touches few days: segments
    ``segment/day=<d>/batch=<b>``, and when a day has ``every`` of them a snapshot ``snapshot/day=<d>/batch=<b>`` of
    that day alone, published by the pointer file ``current/<d>/<b>``. ``resolve`` makes the rows that count out of rows with their
    ``batch``. Reads list and read the wanted days only, a snapshot and fewer than ``every`` segments of each; the
    order of writes and what stays for a repeated batch are those of :class:`KeyedStore`."""

    def __init__(self, path: str, time_ms: str, resolve: Callable[[DataFrame], DataFrame], every: int = 10):
        self.path, self.time, self.resolve, self.every = path, time_ms, resolve, every

    def _list(self, spark: SparkSession, sub: str, prefix: str = "") -> list[int]:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{sub}")
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(x[len(prefix):]) for x in names if x.startswith(prefix) and x[len(prefix):].isdigit())

    def _drop(self, spark: SparkSession, sub: str) -> None:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{sub}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)

    def parts(self, spark: SparkSession, day: int, before: int) -> tuple[int | None, list[int]]:
        """The snapshot and the segments that a read of the day takes."""
        base = max((x for x in self._list(spark, f"current/{day}") if x < before), default=None)
        tail = [x for x in self._list(spark, f"segment/day={day}", "batch=") if (base is None or x > base) and x < before]
        return base, tail

    def read(self, spark: SparkSession, days, before: int, schema) -> DataFrame:
        """What batches before ``before`` stored for these days (any container of day numbers); ``schema`` is that
        of the rows written."""
        kind = StructType([*schema.fields, StructField("day", LongType()), StructField("batch", LongType())])
        found = None
        have = [d for d in self._list(spark, "segment", "day=") if d in days]
        chosen = {"snapshot": [], "segment": []}
        for d in have:
            base, tail = self.parts(spark, d, before)
            chosen["snapshot"] += [] if base is None else [f"{self.path}/snapshot/day={d}/batch={base}"]
            chosen["segment"] += [f"{self.path}/segment/day={d}/batch={x}" for x in tail]
        for sub, paths in chosen.items():
            if paths:
                part = spark.read.schema(kind).option("basePath", f"{self.path}/{sub}").parquet(*paths)
                found = part if found is None else found.unionByName(part)
        if found is None:
            return spark.createDataFrame([], schema)
        return self.resolve(found.drop("day")).select(*[f.name for f in schema.fields])

    def write(self, df: DataFrame, batch_id: int, days) -> None:
        """Store the batch's rows, which lie in ``days``."""
        spark, schema = df.sparkSession, df.schema
        self._put(df, "segment", batch_id)
        due = [d for d in days if len(self.parts(spark, d, batch_id + 1)[1]) >= self.every]
        if due:
            older = {d: max((x for x in self._list(spark, f"current/{d}") if x < batch_id), default=None) for d in due}
            self._put(self.read(spark, due, batch_id + 1, schema), "snapshot", batch_id)
            for d in due:
                p = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/current/{d}/{batch_id}")
                p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True).close()
            for d, last in older.items():
                if last is not None:
                    for x in self._list(spark, f"segment/day={d}", "batch="):
                        if x <= last:
                            self._drop(spark, f"segment/day={d}/batch={x}")
                    for x in self._list(spark, f"current/{d}"):
                        if x < last:
                            self._drop(spark, f"current/{d}/{x}")
                            self._drop(spark, f"snapshot/day={d}/batch={x}")

    def _put(self, df: DataFrame, sub: str, batch_id: int) -> None:
        # a few files a day, not one of every task for every day
        share = F.pmod(F.hash(*df.columns), F.lit(FILES_PER_DAY))
        (df.withColumns({"day": F.floor(F.col(self.time) / DAY_MS).cast("long"), "batch": F.lit(batch_id).cast("long")})
         .repartition("day", share).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(f"{self.path}/{sub}"))


def upsert(path: str, keys: Sequence[str], every: int = 10, merge: dict | None = None, version: str | None = None,
           prepare: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer into a :class:`KeyedStore`; ``prepare`` makes its rows from those of the batch."""
    store = KeyedStore(path, keys, merge, every, version)

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch if prepare is None else prepare(batch)
        store.write(store.newest_of(rows), batch_id)
    return run


def refire(path: str, keys: Sequence[str], value: str = "cnt", every: int = 10) -> Callable[[DataFrame, int], None]:
    """Update-mode output into a :class:`KeyedStore` (``path/state``), and a log (``path/log/batch=<id>``) of
    what each firing changed: '+' with the new value, and '-' with the one it replaces if there was one."""
    store = KeyedStore(f"{path}/state", keys, None, every)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = store.newest_of(batch).persist()
        try:
            old = store.read(spark, before=batch_id)
            new = batch.select(*keys, F.col(value).alias("_new"))
            both = (new.withColumn("_old", F.lit(None).cast("long")) if old is None else
                    new.join(old.select(*keys, F.col(value).alias("_old")), list(keys), "left"))
            both = both.where(~F.col("_new").eqNullSafe(F.col("_old")))
            ops = F.array(F.struct(F.lit("+").alias("op"), F.col("_new").alias(value)), F.struct(F.lit("-").alias("op"), F.col("_old").alias(value)))
            (both.select(*keys, F.explode(ops).alias("x")).select(*keys, "x.*").where(F.col(value).isNotNull())
             .write.mode("overwrite").parquet(f"{path}/log/batch={batch_id}"))
            store.write(batch, batch_id)
        finally:
            batch.unpersist()
    return run


def numbered(path: str, group: str, order: Sequence[str], every: int = 10, out: str = "cnt") -> Callable[[DataFrame, int], None]:
    """Rows that come in event-time order over the batches (those of a batch all later than
    those before) get their running number within ``group``: numbers inside the batch, split by second so that a busy
    group is many tasks, plus the group's count so far, a :class:`KeyedStore` (``path/counts``). Rows go
    to ``path/rows/batch=<id>``. ``order`` starts with the time column."""
    from evtlens.operators.sequence import running_count
    store = KeyedStore(f"{path}/counts", [group], None, every)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = running_count(batch, [group], list(order), "_n", split="1 second")
            known = store.read(batch.sparkSession, before=batch_id)
            if known is None:
                rows = rows.withColumn("_before", F.lit(0).cast("long"))
            else:
                rows = rows.join(known.select(group, F.col("n").alias("_before")), group, "left")
            done = rows.withColumn(out, F.col("_n") + F.coalesce("_before", F.lit(0))).drop("_n", "_before")
            done.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
            ends = batch.sparkSession.read.schema(done.schema).parquet(f"{path}/rows/batch={batch_id}")
            store.write(ends.groupBy(group).agg(F.max(out).alias("n")), batch_id)
        finally:
            batch.unpersist()
    return run
