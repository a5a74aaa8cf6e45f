"""Drive a file-source stream to completion: data file(s) first, then a far-future
sentinel file in a later micro-batch so the watermark closes every window/timer."""

import os
import shutil
import tempfile
import time

from pyspark.sql import DataFrame


def scratch() -> str:
    return tempfile.mkdtemp(prefix="evtlens-stream-")


def stage_files(files: list[tuple[str, str]]) -> str:
    """Copy (src_path, name) files into a fresh folder, one by one with rising mtimes."""
    d = scratch()
    for i, (src, name) in enumerate(files):
        dst = os.path.join(d, name)
        shutil.copy(src, dst)
        t = time.time() + i
        os.utime(dst, (t, t))
    return d


def write_text(folder: str, name: str, text: str, order: int) -> None:
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write(text)
    t = time.time() + order
    os.utime(p, (t, t))


def run_foreach(df: DataFrame, fn, mode: str = "append") -> None:
    ck = scratch()
    q = (df.writeStream.outputMode(mode).option("checkpointLocation", ck)
         .foreachBatch(fn).trigger(availableNow=True).start())
    q.awaitTermination(600)
    if q.exception():
        raise q.exception()


def run_to_parquet(df: DataFrame, mode: str = "append") -> str:
    out = scratch()

    def fn(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_foreach(df, fn, mode)
    return out
