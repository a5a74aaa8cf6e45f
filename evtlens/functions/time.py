"""Event-time helpers.

All windows in the library are epoch aligned and computed on microseconds since
the epoch, so ``spark.sql.session.timeZone`` only matters for text rendering.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000,
}


def duration_us(spec) -> int:
    """'5 minutes' / '1 hour' / '2 seconds' / timedelta / number of seconds -> microseconds."""
    if isinstance(spec, _dt.timedelta):
        return int(round(spec.total_seconds() * 1_000_000))
    if isinstance(spec, (int, float)):
        return int(round(spec * 1_000_000))
    m = re.fullmatch(r"\s*(-?\d+(?:\.\d+)?)\s*([a-z]+?)s?\s*", str(spec).lower())
    if not m or m.group(2) not in _UNITS_US:
        raise ValueError(f"cannot parse duration {spec!r}")
    return int(round(float(m.group(1)) * _UNITS_US[m.group(2)]))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(ts) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column (NTZ read as UTC)."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def epoch_ms(ts) -> Column:
    return F.unix_millis(_col(ts).cast("timestamp"))


def event_time_from_seconds(col) -> Column:
    """Epoch seconds (the reference multiplies by 1000) -> TIMESTAMP."""
    return F.timestamp_seconds(_col(col))


def event_time_from_millis(col) -> Column:
    """Epoch milliseconds -> TIMESTAMP."""
    return F.timestamp_millis(_col(col))


def window_end_ms(window_col="window") -> Column:
    """Window struct -> end as epoch milliseconds (the canonical window_end)."""
    return F.unix_millis(_col(window_col).getField("end"))


def format_window_end(end_ms) -> Column:
    """Epoch-ms window end as java.sql.Timestamp text ('2017-11-26 09:05:00.0')."""
    return F.date_format(F.timestamp_millis(_col(end_ms)), "yyyy-MM-dd HH:mm:ss.S")
