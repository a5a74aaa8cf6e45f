"""evtlens: user-behaviour and transaction analytics as Spark DataFrame operators.

Every operator is a plain function ``f(df, *, columns..., parameters...) -> DataFrame``
that works on batch DataFrames; the ``streaming`` package holds the Structured
Streaming counterparts (watermarks, stateful processors, foreachBatch sinks).
"""

from evtlens.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
