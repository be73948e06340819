"""F8: the UV bitmap's string hash as a JVM-side expression.

h = 0; for each char c: h = h * seed + code(c)  (32-bit wrap), result & (size - 1).
Only the low bits survive the final mask, and ``size`` is a power of two, so masking
after every step gives the same value and keeps every intermediate small.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def poly_hash_mask(s: str | Column, seed: int = 61, size: int = 1 << 29) -> Column:
    """Polynomial string hash masked to ``log2(size)`` bits (size must be a power of 2)."""
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    c = F.col(s) if isinstance(s, str) else s
    mask = size - 1
    codes = F.transform(F.split(c, ""), lambda ch: F.ascii(ch).cast("bigint"))
    h = F.aggregate(codes, F.lit(0).cast("bigint"),
                    lambda acc, x: (acc * F.lit(seed) + x).bitwiseAND(F.lit(mask)))
    return F.when(F.length(c) == 0, F.lit(0).cast("bigint")).otherwise(h)
