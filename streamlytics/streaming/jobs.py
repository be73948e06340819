"""Streaming twins of the reference jobs (Structured Streaming, append mode).

* Sliding windows: pane counts, then a second windowed aggregate over the pane's
  ``window_time`` (chained stateful aggregates; only pane rows are expanded).
* Top-N: the windowed counts of a window are final and all arrive in the
  micro-batch in which the watermark passes the window end, so a batch top-N per
  micro-batch (``foreachBatch``) ranks complete windows; no per-window list state.
* Exact distinct: per (window, user) then per window (Spark refuses exact
  ``count(distinct)`` on streams).
* Joins: stream-stream interval join with watermarks on both sides.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import drop_static_resources
from ..functions.time import duration_us
from ..operators.joins import _signed_us as _signed
from ..operators.topn import top_n_by_count
from . import processors as PR
from .core import _duration_text, after_watermark, window_bounds_ms


def stream_window_count(df: DataFrame, keys, size="1 hour", slide=None, ts_col: str = "ts",
                        count_col: str = "cnt") -> DataFrame:
    """A1/A2 T3/T4 on a watermarked stream: keys..., window_start, window_end (ms), cnt.

    The second stage expands each closed pane with ``F.window`` into size/slide
    windows; beyond a few hundred windows per pane Spark's generated code for the
    expansion is too large and it falls back to interpreted evaluation (slower,
    still exact)."""
    k = [] if keys is None else ([keys] if isinstance(keys, str) else list(keys))
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide else size_us
    if size_us == slide_us:
        c = df.groupBy(F.window(ts_col, _duration_text(size_us)).alias("w"), *k).agg(
            F.count(F.lit(1)).alias(count_col))
    else:
        pane = _duration_text(gcd(size_us, slide_us))
        panes = df.groupBy(F.window(ts_col, pane).alias("p"), *k).agg(F.count(F.lit(1)).alias("_n"))
        c = (panes.groupBy(F.window(F.window_time("p"), _duration_text(size_us), _duration_text(slide_us)).alias("w"), *k)
             .agg(F.sum("_n").alias(count_col)))
    return c.select(*k, *window_bounds_ms("w"), count_col)


def stream_capped_stretches(clicks: DataFrame, by, keys=("user_id", "ad_id"), cap: int = 100, size="1 hour", slide="5 seconds",
                            reset: str = "day") -> DataFrame:
    """D1g in one streaming query: the clicks that pass the cap, counted per ``by`` in sliding
    windows (``stream_sliding_stretches``); the watermark is that of all clicks."""
    from .state import stream_click_cap
    return stream_sliding_stretches(stream_click_cap(clicks, keys, cap, reset).filter(F.col("output") == "pass"), by, size, slide)


def stream_sliding_stretches(df: DataFrame, keys, size="1 hour", slide="1 second", ts_col: str = "ts_us") -> DataFrame:
    """T4 for windows that overlap many times (size a multiple of slide): keys..., first_end,
    last_end (in slides), cnt: stretches of closed windows with an equal count, sent off as
    the watermark passes them; ``unfold_windows`` makes the windows of them. A pane's rows
    raise the count of the next size/slide windows, so what is kept is two changes a pane,
    counted within each Arrow batch before the shuffle. The timeline is cut into parts, so
    that a hot key is split. Windows that have closed take no late row."""
    k = [] if keys is None else ([keys] if isinstance(keys, str) else list(keys))
    size_us, slide_us = duration_us(size), duration_us(slide)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    n = size_us // slide_us
    part = 16 * n
    panes = df.select(*k, F.expr(f"(`{ts_col}` - pmod(`{ts_col}`, {slide_us}L)) div {slide_us}L").alias("_pane"), F.lit(1).cast("long").alias("_n"))
    panes = panes.mapInArrow(PR.summed(k), panes.schema)
    at = lambda e: f"({e} - pmod({e}, {part}L)) div {part}L"
    parts = F.explode(F.expr(f"sequence({at('(_pane + 1)')}, {at(f'(_pane + {n}L)')})")).alias("_part")
    rows = panes.select(*k, "_pane", "_n", parts).select(
        *k, "_part", F.expr(f"greatest(_pane + 1, _part * {part}L)").alias("_from"),
        F.expr(f"least(_pane + {n}L, _part * {part}L + {part - 1}L)").alias("_to"), "_n")
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in k] + ["first_end long, last_end long, cnt long"])
    return PR.run_processor(rows, [*k, "_part"], PR.SlidingStretches(k, slide_us), schema)


def unfold_windows(stretches: DataFrame, size="1 hour", slide="1 second", count_col: str = "cnt") -> DataFrame:
    """The windows of ``stream_sliding_stretches``, as ``stream_window_count`` gives them."""
    size_us, slide_us = duration_us(size), duration_us(slide)
    k = [c for c in stretches.columns if c not in ("first_end", "last_end", "cnt")]
    return stretches.select(*k, F.explode(F.expr("sequence(first_end, last_end)")).alias("_w"), F.col("cnt").alias(count_col)) \
        .select(*k, F.expr(f"(_w * {slide_us}L - {size_us}L) div 1000").alias("window_start"),
                F.expr(f"_w * {slide_us}L div 1000").alias("window_end"), count_col)


def page_views(behavior: DataFrame) -> DataFrame:
    """P1 on a stream; the watermark still follows every row."""
    return behavior.filter(after_watermark(F.col("behavior") == "pv"))


def stream_marketing_counts(events: DataFrame, keys, size="1 hour", slide="1 second",
                            drop_behavior: str = "UNINSTALL") -> DataFrame:
    """A4 (keys channel, behavior) / A5 (no keys) on a stream."""
    kept = events.filter(after_watermark(~F.col("behavior").eqNullSafe(drop_behavior)))
    return stream_window_count(kept, keys, size, slide)


def stream_marketing_stretches(events: DataFrame, keys, size="1 hour", slide="1 second", drop_behavior: str = "UNINSTALL") -> DataFrame:
    """``stream_marketing_counts`` as stretches, for the reference's slide of 1 s."""
    return stream_sliding_stretches(events.filter(after_watermark(~F.col("behavior").eqNullSafe(drop_behavior))), keys, size, slide)


def stream_hot_items(behavior: DataFrame, size="1 hour", slide="5 minutes", n: int = 3):
    """HotItems on a stream: returns (windowed counts stream, per-batch ranker)."""
    views = page_views(behavior)
    counts = stream_window_count(views, "item_id", size, slide)
    return counts, (lambda batch: top_n_by_count(batch, "item_id", n))


def stream_hot_urls(log: DataFrame, size="10 minutes", slide="5 seconds", n: int = 5):
    counts = stream_window_count(log.filter(after_watermark(drop_static_resources("url"))), "url", size, slide)
    return counts, (lambda batch: top_n_by_count(batch, "url", n))


def stream_unique_visitors(behavior: DataFrame, size="1 hour", ts_col: str = "ts") -> DataFrame:
    """UniqueVisitor on a stream: exact distinct users per tumbling window."""
    views = page_views(behavior)
    per_user = views.groupBy(F.window(ts_col, _duration_text(size)).alias("u"), "user_id").agg(
        F.count(F.lit(1)).alias("_n"))
    per_win = per_user.groupBy(F.window(F.window_time("u"), _duration_text(size)).alias("w")).agg(
        F.count(F.lit(1)).alias("uv"))
    return per_win.select(*window_bounds_ms("w"), "uv")


def stream_approx_unique_visitors(behavior: DataFrame, size="1 hour", ts_col: str = "ts") -> DataFrame:
    """UV with early firing (T7): an HLL estimate per window, re-emitted in update
    mode after every micro-batch that touches the window."""
    views = page_views(behavior)
    return (views.groupBy(F.window(ts_col, _duration_text(size)).alias("w"))
            .agg(F.approx_count_distinct("user_id").alias("uv")).select(*window_bounds_ms("w"), "uv"))


def stream_sketch_unique_visitors(behavior: DataFrame, size="1 hour", lg_k: int = 12, ts_col: str = "ts") -> DataFrame:
    """As ``stream_approx_unique_visitors`` with an HLL sketch, which is exact while a window
    holds few users."""
    return (page_views(behavior).groupBy(F.window(ts_col, _duration_text(size)).alias("w"))
            .agg(F.hll_sketch_estimate(F.hll_sketch_agg("user_id", F.lit(lg_k))).alias("uv"))
            .select(*window_bounds_ms("w"), "uv"))


def stream_interval_join(left: DataFrame, right: DataFrame, on, lower="-5 seconds", upper="5 seconds",
                         left_ts: str = "l_ts", right_ts: str = "r_ts", how: str = "inner") -> DataFrame:
    """J1 (``how='inner'``) / J2 (``'full_outer'``) between two watermarked streams;
    both bounds inclusive. Outer rows appear once the watermark has passed the
    interval of the unmatched row."""
    keys = [on] if isinstance(on, str) else list(on)
    lo, up = _signed(lower), _signed(upper)
    l, r = left.alias("_l"), right.alias("_r")
    cond = None
    for k in keys:
        c = F.col(f"_l.{k}") == F.col(f"_r.{k}")
        cond = c if cond is None else cond & c
    cond = (cond & (F.col(f"_r.{right_ts}") >= F.col(f"_l.{left_ts}") + F.expr(f"INTERVAL {lo} MICROSECONDS"))
            & (F.col(f"_r.{right_ts}") <= F.col(f"_l.{left_ts}") + F.expr(f"INTERVAL {up} MICROSECONDS")))
    j = l.join(r, cond, how)
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    key_cols = [F.coalesce(F.col(f"_l.{k}"), F.col(f"_r.{k}")).alias(k) for k in keys]
    out = j.select(*key_cols, *[F.col(f"_l.{c}").alias(c) for c in lcols],
                   *[F.col(f"_r.{c}").alias(c) for c in rcols],
                   F.col(f"_l.{left_ts}").isNotNull().alias("_hl"), F.col(f"_r.{right_ts}").isNotNull().alias("_hr"))
    tag = (F.when(F.col("_hl") & F.col("_hr"), "matched").when(F.col("_hl"), "unmatched_pay")
           .otherwise("unmatched_receipt"))
    return out.withColumn("output", tag).drop("_hl", "_hr")


def stream_bitmap_unique_visitors(behavior: DataFrame, size="1 hour", seed: int = 61, bits: int = 1 << 29,
                                  ts_col: str = "ts") -> DataFrame:
    """UVWithBloomFilter on a stream: per (window, 32768-bit bucket) a bitmap of the
    hashed users, then set bits summed per window (two chained aggregates)."""
    from ..functions.hashing import poly_hash_mask
    views = page_views(behavior).withColumn(
        "_pos", poly_hash_mask(F.col("user_id").cast("string"), seed, bits))
    per_bucket = (views.groupBy(F.window(ts_col, _duration_text(size)).alias("u"),
                                F.bitmap_bucket_number("_pos").alias("_bk"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_pos")).alias("_bm")))
    per_win = (per_bucket.groupBy(F.window(F.window_time("u"), _duration_text(size)).alias("w"))
               .agg(F.sum(F.bitmap_count("_bm")).alias("uv")))
    return per_win.select(*window_bounds_ms("w"), "uv")
