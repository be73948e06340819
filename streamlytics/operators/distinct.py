"""Unique visitors: exact per window (A6), running per row (A7), bitmap (A8), HLL.

All forms aggregate in two stages (first per (window, visitor) or per (window,
bitmap bucket), then per window), so no window's visitor set is ever gathered in
one task and every stage has map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_us
from .sequence import pack_order, running_sum, time_bucket, unpack_order
from .windows import explode_windows


def _tumble(ts_col: str, size_us: int) -> tuple[Column, Column]:
    start = f"(`{ts_col}` - pmod(`{ts_col}`, {size_us}L))"
    return F.expr(f"{start} div 1000"), F.expr(f"({start} + {size_us}L) div 1000")


def unique_visitors(df: DataFrame, user_col: str = "user_id", ts_col: str = "ts_us",
                    size="1 hour", out: str = "uv") -> DataFrame:
    """Exact distinct visitors per tumbling window (window_start, window_end, uv)."""
    size_us = duration_us(size)
    ws, we = _tumble(ts_col, size_us)
    per_user = df.select(ws.alias("window_start"), we.alias("window_end"), F.col(user_col)).distinct()
    return per_user.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias(out))


def running_unique_visitors(df: DataFrame, user_col: str = "user_id", ts_col: str = "ts_us",
                            seq_col: str = "seq", size="1 hour", bucket_width="1 second",
                            out: str = "uv") -> DataFrame:
    """For every input row, the distinct visitors of its window so far
    (the row included), in (ts, seq) order. Returns seq, window_end, uv.

    A visitor's first row in a window is found by aggregation (min of (ts, seq)
    per window and visitor); those first-seen markers are unioned with the rows,
    ordered just before the row they come from, and counted with a bucketed
    running sum (``sequence.running_sum``): a task group holds ``bucket_width`` of a
    window. The rows are scanned once for the markers, whose shuffle is shared, and twice
    for the sum (rows and bucket totals).
    """
    size_us = duration_us(size)
    _, we = _tumble(ts_col, size_us)
    rows = df.select(we.alias("window_end"), F.col(ts_col).alias("_t"), F.col(seq_col).alias("_q"),
                     F.col(user_col).alias("_u"))
    # first (ts, seq) per (window, visitor): packed into one decimal so that the
    # aggregate is a hash aggregate with map-side partial aggregation
    t, q = unpack_order("_f")
    firsts = (rows.groupBy("window_end", "_u").agg(F.min(pack_order("_t", "_q")).alias("_f"))
              .select("window_end", t.alias("_t"), q.alias("_q"),
                      F.lit(0).alias("_m"), F.lit(1).cast("bigint").alias("_flag")))
    marked = rows.select("window_end", "_t", "_q", F.lit(1).alias("_m"),
                         F.lit(0).cast("bigint").alias("_flag")).unionByName(firsts)
    run = running_sum(marked, ["window_end"], ["_t", "_q", "_m"],
                      time_bucket("_t", bucket_width), "_flag", out)
    return run.filter(F.col("_m") == 1).select(F.col("_q").alias(seq_col), "window_end", out)


def bitmap_distinct(df: DataFrame, keys, pos_col: str, out: str = "uv") -> DataFrame:
    """Distinct count of non-negative bit positions per group with Spark's
    bitmap aggregates: a 4 KiB bitmap per (group, 32768-position bucket), OR-merged
    by partial aggregation, then the set bits are summed per group."""
    k = [keys] if isinstance(keys, str) else list(keys)
    # distinct positions first, so that a sparse group's 4 KiB buffers are not made by every task
    per_bucket = (df.select(*k, pos_col).distinct().groupBy(*k, F.bitmap_bucket_number(pos_col).alias("_bk"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position(pos_col)).alias("_bm")))
    return per_bucket.groupBy(*k).agg(F.sum(F.bitmap_count("_bm")).alias(out))


def bitmap_unique_visitors(df: DataFrame, pos_col: str, ts_col: str = "ts_us", size="1 hour",
                           out: str = "uv") -> DataFrame:
    """A8 per tumbling window (window_start, window_end, uv)."""
    size_us = duration_us(size)
    ws, we = _tumble(ts_col, size_us)
    d = df.select(ws.alias("window_start"), we.alias("window_end"), F.col(pos_col))
    return bitmap_distinct(d, ["window_start", "window_end"], pos_col, out)


def linear_count(set_bits, bits: int):
    """Distinct values from the set bits of a bitmap of ``bits`` bits by a uniform hash, with
    collisions corrected: -m ln(1 - X / m), rounded; null when every bit is set."""
    x = F.col(set_bits) if isinstance(set_bits, str) else set_bits
    return F.when(x < bits, F.round(F.lit(-float(bits)) * F.log(1 - x / F.lit(float(bits)))).cast("bigint"))


def linear_count_error(n, bits: int):
    """Standard error of ``linear_count`` at n distinct values: sqrt(m (e^t - t - 1)), t = n / m."""
    t = (F.col(n) if isinstance(n, str) else n) / F.lit(float(bits))
    return F.sqrt(F.lit(float(bits)) * (F.exp(t) - t - 1))


def hll_error(n, lg_k: int):
    """Standard error of an HLL estimate at n distinct values."""
    return (F.col(n) if isinstance(n, str) else n) * F.lit(1.04 / 2 ** (lg_k / 2))


def approx_unique_visitors(df: DataFrame, user_col: str = "user_id", ts_col: str = "ts_us",
                           size="1 hour", slide=None, lg_k: int = 12, out: str = "uv") -> DataFrame:
    """Approximate distinct visitors per window with mergeable HLL sketches, so that
    sliding windows reuse the pane pre-aggregation (sketches are unioned, not rows)."""
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide else size_us
    from math import gcd
    pane_us = gcd(size_us, slide_us)
    panes = (df.groupBy(F.expr(f"`{ts_col}` - pmod(`{ts_col}`, {pane_us}L)").alias("_p"))
             .agg(F.hll_sketch_agg(F.col(user_col), lg_k).alias("_sk")))
    if size_us == slide_us:
        win = panes.select(F.col("_p").alias("_ws"), "_sk")
    else:
        win = (explode_windows(panes, F.col("_p"), pane_us, size_us, slide_us, ["_sk"])
               .groupBy("_ws").agg(F.hll_union_agg("_sk").alias("_sk")))
    return win.select(F.expr("_ws div 1000").alias("window_start"),
                      F.expr(f"(_ws + {size_us}L) div 1000").alias("window_end"),
                      F.hll_sketch_estimate("_sk").alias(out))
