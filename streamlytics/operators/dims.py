"""Dimension joins with a checked broadcast.

A side is broadcast only after its rows and bytes have been checked against limits, in one
small job that reads no more than the limit's rows; above a limit the plan keeps the join
the planner picks, so a dimension that grows with the data never ends up copied to every
executor. AQE may still turn a shuffle join into a broadcast at run time from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS, DEFAULT_MAX_BYTES = 1_000_000, 64 << 20


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if it has at most ``max_rows`` rows of ``max_bytes`` together (as
    text, and 8 bytes a column), else ``df`` unchanged."""
    text = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c, t in df.dtypes
            if not t.startswith(("array", "map", "struct", "binary"))]
    nested = [F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)) for c, t in df.dtypes
              if t.startswith(("array", "map", "struct", "binary"))]
    size = sum([*text, *nested], F.lit(8 * len(df.columns)))
    n, total = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and total <= max_bytes else df
