"""Order-dependent per-key primitives that stay balanced under key skew.

The reference processes each key's events one at a time in order (keyed state).
The direct DataFrame form, a window ``partitionBy(key).orderBy(ts)``, sorts all
rows of a key in one task: a key holding a third of the data would be one task.
Here every key's timeline is cut into **buckets** (a column that never decreases
along the order, e.g. ``ts div 1 hour`` or ``seq div 1M``):

1. the per-row result is computed inside each (key, bucket) with a window;
2. what a bucket needs from the others (the first matching row of a later bucket,
   the running total of earlier buckets) comes from a small table with one row
   per (key, bucket), ordered by a window over its buckets (bounded by the time
   span, not by the data volume), and is joined back on (key, bucket).

Raw rows are shuffled once (by (key, bucket), for the window of step 1); the
per-bucket table of step 2 is a partial aggregate (one row per key, bucket and
map task crosses the network), and the join-back reuses the window's partitioning
(or broadcasts the small table when the planner sees it is small).

When only neighbours in the same bucket or near its edge matter (a pattern whose
``within`` is at most the bucket width), ``with_neighbor(reach=...)`` lets the rows near
the edge also stand one bucket over and needs a single window pass instead.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.time import duration_us


def time_bucket(ts_col: str = "ts_us", width="1 hour") -> Column:
    """Bucket of an epoch-µs column (monotone with time)."""
    w = duration_us(width)
    return F.expr(f"(`{ts_col}` - pmod(`{ts_col}`, {w}L)) div {w}L")


def seq_bucket(seq_col: str = "seq", width: int = 1 << 20) -> Column:
    """Bucket of an arrival-sequence column (monotone with arrival)."""
    return F.expr(f"(`{seq_col}` - pmod(`{seq_col}`, {int(width)}L)) div {int(width)}L")


def choose_width(df: DataFrame, keys, ts_col: str = "ts_us", base="1 hour",
                 target_rows: int = 5_000_000, min_width="1 second") -> int:
    """Bucket width (µs) for the bucketed operators so that no (key, bucket) holds
    more than about ``target_rows`` rows: the largest (key, bucket) at ``base`` is
    measured with one aggregate (partial per task; a single number reaches the
    driver), and the width is halved accordingly, down to ``min_width``. Use it when
    a key may be bursty within one bucket (a hot key spread over time is already
    split by any width)."""
    k = _list(keys)
    w = duration_us(base)
    biggest = (df.groupBy(*k, time_bucket(ts_col, w).alias("_b")).count()
               .agg(F.max("count")).first()[0]) or 0
    lo = duration_us(min_width)
    while biggest > target_rows and w // 2 >= lo:
        w //= 2
        biggest //= 2   # assumes rows spread over the bucket; re-measured below
    if w != duration_us(base):
        biggest = (df.groupBy(*k, time_bucket(ts_col, w).alias("_b")).count()
                   .agg(F.max("count")).first()[0]) or 0
        if biggest > target_rows and w // 2 >= lo:
            return choose_width(df, keys, ts_col, w // 2, target_rows, min_width)
    return w


# (ts, seq) packed into one DECIMAL(38,0) with the same order: ts + 2^58 (any µs
# timestamp of years -7100..11100) times 2^64, plus seq + 2^63 (any bigint).
_TS_OFF, _SEQ_OFF, _SHIFT = 1 << 58, 1 << 63, 1 << 64


def pack_order(ts_col: str, seq_col: str) -> Column:
    """Order-preserving single value for (ts, seq); ``min``/``max`` over it run as
    hash aggregates (a struct would need a sort-based aggregate)."""
    return F.expr(f"(CAST(`{ts_col}` AS DECIMAL(38,0)) + {_TS_OFF}) * {_SHIFT} "
                  f"+ (CAST(`{seq_col}` AS DECIMAL(38,0)) + {_SEQ_OFF})")


def unpack_order(packed: str) -> tuple[Column, Column]:
    """Inverse of ``pack_order``: (ts, seq) as bigint columns."""
    ts = F.expr(f"CAST(`{packed}` div {_SHIFT} - {_TS_OFF} AS BIGINT)")
    seq = F.expr(f"CAST(pmod(`{packed}`, CAST({_SHIFT} AS DECIMAL(38,0))) - {_SEQ_OFF} AS BIGINT)")
    return ts, seq


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


_BLANK = {"string": "''", "boolean": "false", "date": "date'1970-01-01'"}


def without_nulls(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with two columns for each key, a value that is never NULL and whether it was;
    windows, aggregates and plain equi-joins over these keep NULL keys together, and a join
    can reuse the partitioning of a window on the same columns (a ``<=>`` join cannot)."""
    types = dict(df.dtypes)
    cols, names = [], []
    for i, k in enumerate(keys):
        t = types[k]
        blank = _BLANK.get(t, f"CAST(0 AS {t})" if t in _FIXED or t.startswith("decimal") else None)
        if t.startswith("timestamp"):
            blank = f"{t}'1970-01-01 00:00:00'"
        value = F.col(k) if blank else F.to_json(F.struct(k))
        cols += [F.coalesce(value, F.expr(blank or "''")).alias(f"_v{i}"), F.col(k).isNull().alias(f"_n{i}")]
        names += [f"_v{i}", f"_n{i}"]
    return df.select("*", *cols), names


def with_neighbor(df: DataFrame, keys, order: Sequence[str], bucket: Column, cols: Sequence[str],
                  direction: str = "next", where: Column | None = None,
                  prefix: str | None = None, reach: Column | None = None) -> DataFrame:
    """Attach, to every row, columns of the nearest row of the same key that comes
    after it (``direction='next'``) or before it (``'prev'``) in ``order``,
    considering only rows where ``where`` holds (all rows if ``None``).

    Adds ``<prefix><col>`` for each of ``cols`` (NULL when there is no such row).

    ``reach``: the caller needs a neighbour from the adjacent bucket only if that row
    fulfils this condition (e.g. lies less than a pattern's ``within`` from the edge
    between the buckets); farther neighbours come back as NULL. Such rows, and no others,
    also take part in the adjacent bucket, and one window pass answers every row: one
    scan, one shuffle, no per-bucket table, no join.
    """
    keys, order, cols = _list(keys), list(order), list(cols)
    if direction not in ("next", "prev"):
        raise ValueError("direction must be 'next' or 'prev'")
    prefix = prefix if prefix is not None else f"{direction}_"
    fwd = direction == "next"
    s = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                 *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)])
    if reach is not None:
        return _adjacent_neighbor(df, keys, order, bucket, cols, fwd, where, prefix, s, reach)
    d, keys = without_nulls(df, keys)
    d = d.withColumn("_b", bucket).withColumn("_s", s if where is None else F.when(where, s))
    asc = [F.col(c).asc() for c in order]
    desc = [F.col(c).desc() for c in order]
    inb = W.partitionBy(*keys, "_b")
    if where is None:
        spec = inb.orderBy(*asc)
        near = (F.lead if fwd else F.lag)("_s", 1).over(spec)
    else:
        # Nearest qualifying row strictly after (before) the current one: walk the
        # bucket in the opposite direction with a growing frame (linear, not quadratic).
        spec = inb.orderBy(*(desc if fwd else asc))
        near = F.last("_s", ignorenulls=True).over(spec.rowsBetween(W.unboundedPreceding, -1))
    # First (last) qualifying row of each bucket: a partial aggregate, so only one
    # row per (key, bucket, map task) is shuffled for it.
    per = d.groupBy(*keys, "_b").agg(_edge_agg(df, order, cols, fwd, where).alias("_edge"))
    d = d.withColumn("_in", near)
    # ... carried to the buckets before (after) it: one row per (key, bucket).
    carry = W.partitionBy(*keys).orderBy(F.col("_b").desc() if fwd else F.col("_b").asc()) \
        .rowsBetween(W.unboundedPreceding, -1)
    per = per.select(*keys, "_b", F.last("_edge", ignorenulls=True).over(carry).alias("_out"))
    d = d.join(per, [*keys, "_b"], "left")
    got = F.coalesce(F.col("_in"), F.col("_out"))
    return d.select(*[c for c in df.columns],
                    *[got[f"_c{i}"].alias(f"{prefix}{c}") for i, c in enumerate(cols)])


_FIXED = ("bigint", "int", "smallint", "tinyint", "boolean", "double", "float", "date", "timestamp")


def _edge_agg(df: DataFrame, order, cols, fwd: bool, where) -> Column:
    """min/max of the row struct per bucket. With one order column (unique within a
    key, like an arrival sequence) and fixed-width columns (and no filter) it is
    built from ``min_by``/``max_by``, which hash aggregation supports; a struct
    buffer would force a sort-based aggregate."""
    types = dict(df.dtypes)
    if where is None and len(order) == 1 and all(types[c] in _FIXED for c in [*order, *cols]):
        o = order[0]
        by = F.min_by if fwd else F.max_by
        return F.struct((F.min if fwd else F.max)(o).alias("_o0"),
                        *[by(c, o).alias(f"_c{i}") for i, c in enumerate(cols)])
    return (F.min if fwd else F.max)("_s")


def _adjacent_neighbor(df, keys, order, bucket, cols, fwd, where, prefix, s, reach) -> DataFrame:
    d = df.withColumn("_home", bucket).withColumn("_s", s if where is None else F.when(where, s))
    # candidates of bucket b+1 (b-1) also stand in b: they come after (before) all of b
    near = reach if where is None else reach & where
    there = F.col("_home") + F.lit(-1 if fwd else 1)
    u = d.withColumn("_b", F.explode(F.when(near, F.array("_home", there)).otherwise(F.array("_home")))) \
        .withColumn("_own", F.col("_b").eqNullSafe(F.col("_home")))
    asc = [F.col(c).asc() for c in order]
    desc = [F.col(c).desc() for c in order]
    inb = W.partitionBy(*keys, "_b")
    if where is None:
        near = (F.lead if fwd else F.lag)("_s", 1).over(inb.orderBy(*asc))
    else:
        near = F.last("_s", ignorenulls=True).over(
            inb.orderBy(*(desc if fwd else asc)).rowsBetween(W.unboundedPreceding, -1))
    out = u.withColumn("_in", near).filter(F.col("_own"))
    return out.select(*df.columns, *[F.col("_in")[f"_c{i}"].alias(f"{prefix}{c}") for i, c in enumerate(cols)])


def running_sum(df: DataFrame, keys, order: Sequence[str], bucket: Column, value: str,
                out: str) -> DataFrame:
    """Running (inclusive) sum of ``value`` per key along ``order``."""
    keys, order = _list(keys), list(order)
    d, keys = without_nulls(df, keys)
    d = d.withColumn("_b", bucket)
    inb = W.partitionBy(*keys, "_b").orderBy(*[F.col(c).asc() for c in order]) \
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    per = d.groupBy(*keys, "_b").agg(F.sum(value).alias("_tot"))   # partial aggregate
    d = d.withColumn("_run", F.sum(value).over(inb))
    before = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    per = per.select(*keys, "_b", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"))
    d = d.join(per, [*keys, "_b"], "left")
    return d.select(*df.columns, (F.col("_run") + F.col("_off")).alias(out))
