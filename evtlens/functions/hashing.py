"""P5: the bitmap offset hash of the unique-visitor job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def poly_hash(col, seed: int = 61, bits: int = 29) -> Column:
    """h = h*seed + char over the decimal text of ``col``, keeping the low ``bits`` bits.

    Masking after every step keeps the same low bits as the wrapping 64-bit loop
    while never overflowing (ANSI mode raises on overflow).
    """
    c = F.col(col) if isinstance(col, str) else col
    s = c.cast("string")
    mask = (1 << bits) - 1
    return F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.ascii(F.substring(s, i, 1))),
        F.lit(0).cast("bigint"),
        lambda acc, ch: (acc * F.lit(seed) + ch.cast("bigint")).bitwiseAND(F.lit(mask)),
    )
