"""Scalar column expressions (JVM-side built-ins only): time helpers, predicates, hashing."""

from evtlens.functions.time import (
    duration_us, epoch_ms, epoch_us, event_time_from_seconds, event_time_from_millis,
    format_window_end, window_end_ms,
)
from evtlens.functions.predicates import (
    is_behavior, not_behavior, is_method, not_static_asset, has_tx, STATIC_ASSET_PATTERN,
)
from evtlens.functions.hashing import poly_hash

__all__ = [
    "duration_us", "epoch_ms", "epoch_us", "event_time_from_seconds", "event_time_from_millis",
    "format_window_end", "window_end_ms", "is_behavior", "not_behavior", "is_method",
    "not_static_asset", "has_tx", "STATIC_ASSET_PATTERN", "poly_hash",
]
