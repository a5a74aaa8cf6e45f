"""Running the stream queries over the test tables.

The input is cut by arrival time into a few slices; each slice is appended to a folder of
the shared scratch and one ``availableNow`` run takes it as a micro-batch of the same query
(one checkpoint), then a far-future sentinel closes what is open. Arrival differs from
event time: every tenth event comes up to two days late, so slices hold late rows. The
table is read by Spark's reader, whatever files it consists of, and a run that reads no row
is an error.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evtlens.functions.time import epoch_us
from evtlens.plans import params as P
from evtlens.session import scratch_path
from evtlens.sources import tables
from evtlens.streaming.eventtime import SENTINEL_TS

HOUR_US = 3_600_000_000


def folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def late_arrival(key: str = "event_id", ts: str = "ts"):
    """Arrival time (us): every tenth key comes up to two days late."""
    d = P.DELAY
    hours = F.when(F.col(key) % d["every"] == 0, F.col(key) * d["factor"] % d["hours"]).otherwise(0)
    return epoch_us(ts) + hours.cast("long") * HOUR_US


def cut(df: DataFrame, arrival, n: int = P.SLICES) -> list[DataFrame]:
    """``df`` in n slices of equal arrival time."""
    df = df.withColumn("_arr", arrival)
    span = df.agg(F.min("_arr").alias("lo"), F.max("_arr").alias("hi")).first()
    if span["lo"] is None:
        raise ValueError("the stream's table is empty")
    at = F.expr(f"(_arr - {span['lo']}) * {n} div {span['hi'] - span['lo'] + 1}")
    return [df.where(at == i).drop("_arr") for i in range(n)]


def events(spark: SparkSession, sf: str, kind: str = "view", n: int = P.SLICES) -> list[DataFrame]:
    """``events`` in slices and a sentinel event of type ``kind``."""
    ev = tables.table(spark, sf, "events")
    return [*cut(ev, late_arrival(), n), sentinel(spark, ev, event_id=-1, user_id=-1, event_type=kind, value=0.0,
                                                  props='{"k": 0}')]


def sentinel(spark: SparkSession, like: DataFrame, ts: str = "ts", later: int = 0, **values) -> DataFrame:
    import datetime as dt
    row = {**values, ts: SENTINEL_TS + dt.timedelta(days=later)}
    kinds = ", ".join(f"`{f.name}` {'timestamp' if f.name == ts else f.dataType.simpleString()}" for f in like.schema)
    return spark.createDataFrame([tuple(row.get(c) for c in like.columns)], kinds).select(
        *[F.col(f.name).cast(f.dataType) for f in like.schema])


def run(spark: SparkSession, slices: list[DataFrame], build: Callable[[DataFrame], DataFrame], start) -> list:
    """One run per slice; ``start(writer)`` starts the query. Returns the progress of all
    micro-batches."""
    source, ckpt = folder(spark, "stream-in"), folder(spark, "stream-ckpt")
    progress = []
    for part in slices:
        part.write.mode("append").parquet(source)
        stream = build(spark.readStream.schema(part.schema).parquet(source))
        q = start(stream.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True))
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        progress += q.recentProgress
    if not sum(p["numInputRows"] for p in progress):
        raise RuntimeError(f"the stream read no row from {source}")
    return progress


def to_table(spark: SparkSession, slices, build, name: str) -> DataFrame:
    """The stream's append output, as a table."""
    out = folder(spark, name)
    schema = build(spark.readStream.schema(slices[0].schema).parquet(_empty(spark, slices[0]))).schema
    run(spark, slices, build, lambda w: w.outputMode("append").format("parquet").option("path", out).start())
    return spark.read.schema(schema).parquet(out)


def _empty(spark: SparkSession, like: DataFrame) -> str:
    path = folder(spark, "stream-schema")
    like.limit(0).write.parquet(path)
    return path


def each_batch(spark: SparkSession, slices, build, fn, mode: str = "append") -> list:
    return run(spark, slices, build, lambda w: w.outputMode(mode).foreachBatch(fn).start())
