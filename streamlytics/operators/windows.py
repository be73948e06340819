"""Event-time windows (T3 T4 T5) and windowed aggregates (A1 A2 A4 A5).

Windows are ``[start, start + size)`` with ``start`` a multiple of ``slide`` from
the epoch (UTC), as in the reference framework and in ``F.window`` (when slide
divides size, the ends are multiples of slide too). Only non-empty windows give
rows.

Sliding windows use **pane pre-aggregation** instead of assigning every row to
size/slide windows: rows are first counted per (key, pane), where a pane is a
``gcd(size, slide)``-wide slice of time; only those partial counts are fanned out
to the windows that contain the pane and summed again. Both steps are ordinary
hash aggregates with map-side partial aggregation, so a hot key is spread over its
panes and windows instead of landing in one task, and the fan-out multiplies the
(much smaller) number of key-panes, not the rows. ``F.window`` expands every row
"""

from __future__ import annotations

from math import gcd
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_us


def _cols(keys: str | Sequence[str] | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def pane_partials(df: DataFrame, keys, ts_col: str, pane_us: int,
                  aggs: dict[str, Column]) -> DataFrame:
    """Aggregate rows per (keys, pane); ``pane`` = floor(ts / pane_us)."""
    k = _cols(keys)
    # Integer floor division that also holds before the epoch.
    pane = F.expr(f"(`{ts_col}` - pmod(`{ts_col}`, {pane_us}L)) div {pane_us}L")
    return df.groupBy(*k, pane.alias("_pane")).agg(*[a.alias(n) for n, a in aggs.items()])


def explode_windows(df: DataFrame, pane_start: Column, pane_us: int, size_us: int, slide_us: int,
                    keep: Sequence[str]) -> DataFrame:
    """One row per (input row, window containing its pane) with ``_ws`` = window start.

    The candidates are the latest window start at or before the pane minus
    0..ceil(size/slide)-1 slides (a constant array, exploded without building a
    per-row sequence); the ones that do not cover the whole pane are filtered out
    (only when slide does not divide size, or size < slide).
    """
    n = -(-size_us // slide_us)
    last = pane_start - F.pmod(pane_start, F.lit(slide_us))
    offs = F.array(*[F.lit(i * slide_us) for i in range(n)])
    out = (df.select(*keep, pane_start.alias("_ps"), last.alias("_last"), F.explode(offs).alias("_off"))
           .select(*keep, "_ps", (F.col("_last") - F.col("_off")).alias("_ws")))
    if size_us % slide_us or pane_us != slide_us:
        # keep windows with s + size >= pane end (s <= pane start holds by construction)
        out = out.filter(F.col("_ws") + F.lit(size_us) >= F.col("_ps") + F.lit(pane_us))
    return out.drop("_ps")


def window_agg(df: DataFrame, keys, ts_col: str, size: str | int, slide: str | int | None = None,
               aggs: dict[str, Column] | None = None,
               merge: dict[str, str] | None = None) -> DataFrame:
    """Windowed aggregate per key with the window bounds attached (windows start at
    multiples of ``slide``, as ``F.window`` and the reference framework do).

    ``aggs`` maps output names to *mergeable* aggregate columns (default
    ``cnt = count(*)``); ``merge`` says how partials combine (``sum`` by default;
    ``max``/``min`` also allowed). Returns ``keys..., window_start, window_end``
    (epoch ms, bigint) and the aggregate columns.
    """
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    if size_us <= 0 or slide_us <= 0:
        raise ValueError("size and slide must be positive")
    aggs = aggs or {"cnt": F.count(F.lit(1))}
    merge = merge or {}
    k = _cols(keys)
    pane_us = gcd(size_us, slide_us)
    parts = pane_partials(df, k, ts_col, pane_us, aggs)
    if size_us == slide_us:
        # Tumbling: one window per pane, no fan-out, a single aggregation.
        out = parts.select(*k, (F.col("_pane") * F.lit(size_us)).alias("_ws"), *aggs.keys())
    else:
        exploded = explode_windows(parts, F.col("_pane") * F.lit(pane_us), pane_us, size_us, slide_us,
                                   [*k, *aggs.keys()])
        fns = {"sum": F.sum, "max": F.max, "min": F.min}
        out = (exploded.groupBy(*k, "_ws")
               .agg(*[fns[merge.get(n, "sum")](n).alias(n) for n in aggs]))
    return out.select(*k, F.expr("_ws div 1000").alias("window_start"),
                      F.expr(f"(_ws + {size_us}L) div 1000").alias("window_end"),
                      *aggs.keys())


def sliding_count(df: DataFrame, keys, ts_col: str = "ts_us", size: str | int = "1 hour",
                  slide: str | int = "5 minutes", count_col: str = "cnt") -> DataFrame:
    """A1: count per key per sliding window (incremental count + window end)."""
    return window_agg(df, keys, ts_col, size, slide, {count_col: F.count(F.lit(1))})


def sliding_count_by_runs(df: DataFrame, keys, ts_col: str = "ts_us", size: str | int = "1 hour",
                          slide: str | int = "1 second", count_col: str = "cnt") -> DataFrame:
    """The rows of ``sliding_count`` for windows that overlap many times (size a multiple of
    slide): n rows of a pane raise the count of the next size/slide windows by n, so a key's
    count changes only where a pane enters or leaves. These changes, two a pane, are summed
    along the key's windows (bucketed, so that a hot key is split), and each stretch of equal
    counts is unfolded into its windows last: what is shuffled is panes, never windows."""
    from .sequence import running_sum, with_neighbor
    size_us, slide_us = duration_us(size), duration_us(slide)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    k = _cols(keys) or ["_all"]
    d = df if _cols(keys) else df.withColumn("_all", F.lit(0))
    n = size_us // slide_us
    panes = pane_partials(d, k, ts_col, slide_us, {"_n": F.count(F.lit(1))})
    change = F.explode(F.array(F.struct((F.col("_pane") + 1).alias("e"), F.col("_n").alias("d")),
                               F.struct((F.col("_pane") + 1 + n).alias("e"), (-F.col("_n")).alias("d"))))
    changes = panes.select(*k, change.alias("_x")).groupBy(*k, F.col("_x.e").alias("_e")).agg(F.sum("_x.d").alias("_d"))
    bucket = F.expr(f"(_e - pmod(_e, {16 * n}L)) div {16 * n}L")
    counts = running_sum(changes, k, ["_e"], bucket, "_d", count_col)
    # a stretch ends at the key's next change, at most n windows on
    runs = with_neighbor(counts, k, ["_e"], bucket, ["_e"], "next", reach=F.expr(f"pmod(_e, {16 * n}L) <= {n}L"))
    ends = runs.filter(F.col(count_col) > 0).withColumn("_w", F.explode(F.expr("sequence(_e, next__e - 1)")))
    return ends.select(*_cols(keys), F.expr(f"(_w * {slide_us}L - {size_us}L) div 1000").alias("window_start"),
                       F.expr(f"_w * {slide_us}L div 1000").alias("window_end"), count_col)


def tumbling_count(df: DataFrame, keys=None, ts_col: str = "ts_us", size: str | int = "1 hour",
                   count_col: str = "cnt") -> DataFrame:
    """A2 (sum of ones) / A5 (grand total) over tumbling windows; ``keys=None`` is
    the un-keyed (``timeWindowAll``) form, still partially aggregated per task."""
    return window_agg(df, keys, ts_col, size, None, {count_col: F.count(F.lit(1))})


def integer_average(df: DataFrame, keys, value_col: str, out_col: str = "avg") -> DataFrame:
    """A3: mean with a (sum, count) accumulator and integer division, widened to double."""
    k = _cols(keys)
    return (df.groupBy(*k)
            .agg(F.sum(value_col).alias("_s"), F.count(value_col).alias("_n"))
            .select(*k, F.expr("cast(_s div _n as double)").alias(out_col)))
