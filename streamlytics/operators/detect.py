"""Stateful per-key detectors of the reference as batch DataFrame plans.

D1  click cap with one-time warning (and daily reset, D1r)
D2  consecutive login failures in arrival order
D3  order / payment matching with four outcomes
The streaming forms (keyed state + timers) are in ``streamlytics.streaming.state``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.time import US_PER, duration_us
from .sequence import seq_bucket, time_bucket, with_neighbor

# Messages of the reference's detectors.
CLICK_CAP_MSG = "Click over {cap} times today."
LOGIN_FAIL_MSG = "login fail in 2 seconds."
PAY_OK = "payed successfully"
PAY_LATE = "payed but already timeout"
PAY_NO_CREATE = "already payed but not found create log"
CREATE_NO_PAY = "order timeout"


def click_cap(df: DataFrame, keys: Sequence[str] = ("user_id", "ad_id"), cap: int = 100,
              reset: str = "day", ts_col: str = "ts_us", seq_col: str = "seq",
              msg: str | None = None, bucket_width="1 hour") -> DataFrame:
    """D1/D1r: per key, the first ``cap`` rows in (ts, seq) order pass; the next row
    produces the single warning; later rows are dropped. ``reset='day'`` restarts
    the count every UTC day, ``'never'`` keeps one count.

    Returns the input columns plus ``output`` ('pass' | 'warn') and ``msg`` (NULL on
    pass rows). A row of rank cap + 1 or less of its key has that rank or less in its
    time bucket too, so each (key, bucket) is limited to its first cap + 1 rows first
    (below the planner's group-limit threshold also before the shuffle); the key's own
    ranking then sees at most cap + 1 rows a bucket, whatever the cap and however hot
    the key. NULL keys are a key like any other.
    """
    k = list(keys)
    part = [F.col(c) for c in k]
    if reset == "day":
        part.append(F.expr(f"(`{ts_col}` - pmod(`{ts_col}`, {US_PER['day']}L)) div {US_PER['day']}L"))
    elif reset != "never":
        raise ValueError("reset must be 'day' or 'never'")
    text = (msg or CLICK_CAP_MSG).format(cap=cap)
    order = [F.col(ts_col), F.col(seq_col)]
    within = W.partitionBy(*part, time_bucket(ts_col, bucket_width)).orderBy(*order)
    first = df.withColumn("_rb", F.row_number().over(within)).filter(F.col("_rb") <= cap + 1)
    ranked = first.withColumn("_rn", F.row_number().over(W.partitionBy(*part).orderBy(*order))) \
        .filter(F.col("_rn") <= cap + 1)
    return ranked.select(*df.columns,
                         F.when(F.col("_rn") <= cap, "pass").otherwise("warn").alias("output"),
                         F.when(F.col("_rn") > cap, F.lit(text)).alias("msg"))


def login_fail_arrival(df: DataFrame, key: str = "user_id", type_col: str = "event_type",
                       fail: str = "fail", within="2 seconds", ts_col: str = "ts_us",
                       seq_col: str = "seq", bucket_width: int = 1 << 20,
                       msg: str = LOGIN_FAIL_MSG) -> DataFrame:
    """In arrival order (``seq``), a fail whose previous row of the same key is a
    fail with ``ts < prev_ts + within`` warns (no lower bound; any other event type
    clears). Returns key, first_us, last_us, msg."""
    w = duration_us(within)
    # a boolean instead of the type text keeps the per-bucket edge a hash aggregate
    d = df.select(key, (F.col(type_col) == fail).alias("_fail"), ts_col, seq_col)
    n = with_neighbor(d, [key], [seq_col], seq_bucket(seq_col, bucket_width), ["_fail", ts_col], "prev")
    hit = (F.col("_fail") & F.col("prev__fail")
           & (F.col(ts_col) < F.col(f"prev_{ts_col}") + F.lit(w)))
    return n.filter(hit).select(key, F.col(f"prev_{ts_col}").alias("first_us"),
                                F.col(ts_col).alias("last_us"), F.lit(msg).alias("msg"))


def order_pay_outcomes(df: DataFrame, keys: Sequence[str] = ("order_id",), type_col: str = "event_type",
                       create: str = "create", pay: str = "pay", within="15 minutes",
                       ts_col: str = "ts_us") -> DataFrame:
    """D3: one row per key from its earliest create and earliest pay:
    pay < create + within -> 'payed successfully' (main output); pay later ->
    'payed but already timeout'; create only -> 'order timeout'; pay only ->
    'already payed but not found create log' (side outputs). Plain aggregation:
    partial per task, so a hot key never meets in one task.

    Returns keys..., create_us, pay_us, output ('payed'|'timeout'), msg.
    """
    w = duration_us(within)
    k = list(keys)
    agg = (df.filter(F.col(type_col).isin(create, pay))
           .groupBy(*k)
           .agg(F.min(F.when(F.col(type_col) == create, F.col(ts_col))).alias("create_us"),
                F.min(F.when(F.col(type_col) == pay, F.col(ts_col))).alias("pay_us")))
    c, p = F.col("create_us"), F.col("pay_us")
    m = (F.when(c.isNotNull() & p.isNotNull() & (p < c + F.lit(w)), PAY_OK)
         .when(c.isNotNull() & p.isNotNull(), PAY_LATE)
         .when(c.isNotNull(), CREATE_NO_PAY)
         .otherwise(PAY_NO_CREATE))
    return agg.select(*k, "create_us", "pay_us",
                      F.when(m == PAY_OK, "payed").otherwise("timeout").alias("output"), m.alias("msg"))
