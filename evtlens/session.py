"""Spark session defaults used by the library, the tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults every job relies on: UTC event time (windows are epoch aligned), AQE for
# runtime coalescing / skew splitting, and no UI server.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # broadcast only below a checked size (file statistics / AQE runtime size); beyond
    # it Catalyst keeps the shuffle join
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "evtlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` / ``shuffle_partitions`` are only applied when given, so a session
    created by a cluster launcher keeps its own settings.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    Read ``spark.checkpoint.dir`` from the session (a cluster names a shared
    folder there). In a local session without it (tests) a fresh scratch folder is
    made; on a cluster that is an error, as executors would not see it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
        d = tempfile.mkdtemp(prefix="evtlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (for written tables / stream state)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name)


def cut_lineage(df, name: str):
    """Write ``df`` as a table in the shared folder and read it back: a later job that
    loses an executor reads the files instead of working it out again."""
    import uuid
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batch_session(spark: SparkSession) -> SparkSession:
    """A session for batch work inside ``foreachBatch``: the stream's own has adaptive execution off, as the number of its
    state partitions is fixed."""
    new = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.checkpoint.dir"):
        value = spark.conf.get(name, None)
        if value != new.conf.get(name, None):
            new.conf.set(name, value)
    return new


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``evtlens`` importable in the Python workers (mapInPandas / transformWithState
    run library code there): zip the package once per application and ``addPyFile`` it,
    so Spark distributes it to every executor."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="evtlens-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, dirnames, files in os.walk(pkg):
            dirnames[:] = [d for d in dirnames if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)
