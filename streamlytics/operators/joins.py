"""Interval join (J1) and two-stream reconciliation.

A range condition next to the equi-key would make every pair of a hot key a
candidate. Both sides therefore also join on a **time bucket** as wide as the
interval: the left row has one bucket, the right row is fanned out to the (at
most two) left buckets that can hold a partner, and the exact bounds are then
checked. A (key, bucket) group holds one interval of one key, and each pair is
produced once.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_us


def _bucketed(left: DataFrame, right: DataFrame, lower_us: int, upper_us: int,
              lts: str, rts: str):
    width = max(upper_us - lower_us, 1)
    lb = F.expr(f"(`{lts}` - pmod(`{lts}`, {width}L)) div {width}L")
    l2 = left.withColumn("_bk", lb)
    # left.ts in [r.ts - upper, r.ts - lower]  ->  left buckets of both ends.
    lo = F.expr(f"(`{rts}` - {upper_us}L - pmod(`{rts}` - {upper_us}L, {width}L)) div {width}L")
    hi = F.expr(f"(`{rts}` - {lower_us}L - pmod(`{rts}` - {lower_us}L, {width}L)) div {width}L")
    r2 = right.withColumn("_bk", F.explode(F.sequence(lo, hi)))
    return l2, r2


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, lower="-5 seconds",
                  upper="5 seconds", left_ts: str = "l_ts_us", right_ts: str = "r_ts_us",
                  how: str = "inner") -> DataFrame:
    """Pairs with equal keys and ``left.ts + lower <= right.ts <= left.ts + upper``
    (both bounds inclusive). Column names of the two sides must be distinct apart
    from the keys. ``how`` may be 'inner', 'left', 'left_anti' or 'left_semi'."""
    keys = [on] if isinstance(on, str) else list(on)
    lo_us, up_us = _signed_us(lower), _signed_us(upper)
    l2, r2 = _bucketed(left, right, lo_us, up_us, left_ts, right_ts)
    l2, r2 = l2.alias("_l"), r2.alias("_r")
    L = lambda c: F.col(f"_l.`{c}`")
    R = lambda c: F.col(f"_r.`{c}`")
    cond = [L(k) == R(k) for k in keys] + [L("_bk") == R("_bk"),
            R(right_ts) >= L(left_ts) + F.lit(lo_us), R(right_ts) <= L(left_ts) + F.lit(up_us)]
    cond_all = cond[0]
    for c in cond[1:]:
        cond_all = cond_all & c
    j = l2.join(r2, cond_all, how)
    if how in ("left_anti", "left_semi"):
        return j.select(*[L(c).alias(c) for c in left.columns])
    return j.select(*[L(k).alias(k) for k in keys],
                    *[L(c).alias(c) for c in left.columns if c not in keys],
                    *[R(c).alias(c) for c in right.columns if c not in keys])


def _signed_us(d) -> int:
    if isinstance(d, int):
        return d
    d = d.strip()
    return -duration_us(d[1:]) if d.startswith("-") else duration_us(d)


def reconcile(left: DataFrame, right: DataFrame, on: Sequence[str] | str, lower="-5 seconds",
              upper="5 seconds", left_ts: str = "l_ts_us", right_ts: str = "r_ts_us",
              tags=("matched", "unmatched_pay", "unmatched_receipt")) -> DataFrame:
    """Full-outer interval join with an ``output`` tag: matched pairs, left rows
    with no partner, right rows with no partner (the reference's main output and
    two side outputs). A left row stands in one bucket, so a bucketed left outer join
    gives the pairs and the unmatched left rows; a bucketed anti-join gives the right
    ones, so the fan-out of the right side never creates spurious unmatched copies."""
    keys = [on] if isinstance(on, str) else list(on)
    lo_us, up_us = _signed_us(lower), _signed_us(upper)
    found = interval_join(left, right.withColumn("_hit", F.lit(True)), keys, lo_us, up_us, left_ts, right_ts, "left")
    found = found.withColumn("output", F.when(F.col("_hit"), tags[0]).otherwise(tags[1])).drop("_hit")
    # right rows without a left partner: the same join seen from the right side
    # (left.ts in [right.ts - upper, right.ts - lower]).
    ronly = interval_join(right, left, keys, -up_us, -lo_us, right_ts, left_ts, "left_anti")
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    lnull = [F.lit(None).cast(left.schema[c].dataType).alias(c) for c in lcols]
    return found.unionByName(ronly.select(*keys, *lnull, *rcols, F.lit(tags[2]).alias("output")))
