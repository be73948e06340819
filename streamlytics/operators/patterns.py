"""Event-sequence patterns (C1 strict, C2 relaxed with timeout) without an NFA.

Both reference patterns are two-step, so they reduce to "the next row of the
key" (strict contiguity) and "the next row of a given type" (relaxed
contiguity), taken in event-time order with ``seq`` breaking ties. Both use the
skew-safe bucketed neighbour search of ``sequence.with_neighbor``; since a
match must lie less than ``within`` after its start, buckets at least ``within``
wide let the search run in one window pass (``reach``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_us
from .sequence import time_bucket, with_neighbor

# Messages of the reference's pattern outputs.
STRICT_FAIL_MSG = "login fail!"
PAYED_MSG = "payed successfully"
TIMEOUT_MSG = "timeout"


def _width(bucket_width, within_us: int) -> int:
    """Time-bucket width, by default the larger of 1 minute and 4 x ``within``: a match
    is in the same or the next bucket, a burst is split, and few rows are near an edge.
    A narrower one is widened to ``within``."""
    if bucket_width is None:
        return max(duration_us("1 minute"), 4 * within_us)
    return max(duration_us(bucket_width), within_us)


def _near_edge(ts_col: str, width: int, within_us: int):
    """Rows less than ``within`` after the start of their bucket: the only ones that can
    end a match begun in the bucket before."""
    return F.expr(f"pmod(`{ts_col}`, {width}L) < {within_us}L")


def strict_pair(df: DataFrame, key: str = "user_id", type_col: str = "event_type",
                first: str = "fail", second: str = "fail", within="2 seconds",
                ts_col: str = "ts_us", seq_col: str = "seq", bucket_width=None,
                msg: str = STRICT_FAIL_MSG) -> DataFrame:
    """``first`` immediately followed (next row of the key) by ``second`` with
    ``second.ts - first.ts < within`` (strict). Overlapping matches are all kept.

    Returns key, first_us, last_us, msg.
    """
    w = duration_us(within)
    bucket_width = _width(bucket_width, w)
    n = with_neighbor(df.select(key, type_col, ts_col, seq_col), [key], [ts_col, seq_col],
                      time_bucket(ts_col, bucket_width), [type_col, ts_col], "next",
                      reach=_near_edge(ts_col, bucket_width, w))
    hit = ((F.col(type_col) == first) & (F.col(f"next_{type_col}") == second)
           & (F.col(f"next_{ts_col}") - F.col(ts_col) < F.lit(w)))
    return n.filter(hit).select(key, F.col(ts_col).alias("first_us"),
                                F.col(f"next_{ts_col}").alias("last_us"), F.lit(msg).alias("msg"))


def followed_by_within(df: DataFrame, key: str = "order_id", type_col: str = "event_type",
                       start: str = "create", end: str = "pay", within="15 minutes",
                       ts_col: str = "ts_us", seq_col: str = "seq", bucket_width=None,
                       matched_msg: str = PAYED_MSG, timeout_msg: str = TIMEOUT_MSG) -> DataFrame:
    """Every ``start`` row paired with the first later ``end`` row of its key;
    matched when ``end.ts - start.ts < within`` (main output), else timed out
    (side output). Other event types are skipped; ``end`` rows without a start
    give nothing.

    Returns key, start_us, end_us (NULL on timeout), output ('matched'|'timeout'), msg.
    """
    w = duration_us(within)
    bucket_width = _width(bucket_width, w)
    n = with_neighbor(df.select(key, type_col, ts_col, seq_col), [key], [ts_col, seq_col],
                      time_bucket(ts_col, bucket_width), [ts_col], "next",
                      where=F.col(type_col) == end, reach=_near_edge(ts_col, bucket_width, w))
    ok = F.col(f"next_{ts_col}").isNotNull() & (F.col(f"next_{ts_col}") - F.col(ts_col) < F.lit(w))
    return (n.filter(F.col(type_col) == start)
            .select(key, F.col(ts_col).alias("start_us"),
                    F.when(ok, F.col(f"next_{ts_col}")).alias("end_us"),
                    F.when(ok, "matched").otherwise("timeout").alias("output"),
                    F.when(ok, F.lit(matched_msg)).otherwise(F.lit(timeout_msg)).alias("msg")))
