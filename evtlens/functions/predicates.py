"""Row predicates of the reference jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: URLs ending in one of these static-asset extensions are not page views.
STATIC_ASSET_PATTERN = r"\.(css|js|png|ico)$"


def is_behavior(value: str = "pv", col: str = "behavior") -> Column:
    """behavior = 'pv' (null never matches)."""
    return F.col(col) == F.lit(value)


def not_behavior(value: str = "UNINSTALL", col: str = "behavior") -> Column:
    """behavior <> 'UNINSTALL' keeping nulls (Java ``!"X".equals(v)``)."""
    return ~F.col(col).eqNullSafe(F.lit(value))


def is_method(value: str = "GET", col: str = "method") -> Column:
    """method = 'GET'."""
    return F.col(col) == F.lit(value)


def not_static_asset(col: str = "url") -> Column:
    """keep URLs that do not end with .css/.js/.png/.ico (a query string keeps them)."""
    return ~F.coalesce(F.col(col), F.lit("")).rlike(STATIC_ASSET_PATTERN)


def has_tx(col: str = "tx_id") -> Column:
    """a pay event carries a transaction id (empty text and NULL both mean none)."""
    return F.col(col).isNotNull() & (F.col(col) != F.lit(""))
