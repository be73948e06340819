"""Keyed state machines for streams: D1, D3, J2, C2 and the running distinct count by
``transformWithState`` (``processors``), D2, C1 with ``applyInPandasWithState``.

Late rows. The reference's process functions (D1, D3, J2) handle every row, however late, and
so do these: their processors see all rows, and their timers fire once the watermark has
passed them. The patterns (C1, C2) drop late rows, as the reference's do, and use event-time
timers. D2 needs no timer.

State is removed when nothing can follow from it: some days after the day (D1), with the
outcome (D3, J2), with the window, after a row that is no fail (D2), when no row waits and no
match is open (C1, C2).

Memory per key and micro-batch is bounded by the micro-batch size (``maxFilesPerTrigger`` /
``maxOffsetsPerTrigger``); the click cap sends only the ``cap + 1`` earliest rows of a key
from each Arrow batch, D3 keeps only the earliest create and pay.

For D2, C1 and C2 Spark hands the watermark column (a TIMESTAMP) to the functions, and pandas
holds timestamps in nanoseconds (years 1677-2262): ``core.with_event_time(max_ts_us=...)``
keeps that column inside the range and no row is lost.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.hashing import poly_hash_mask
from ..functions.time import US_PER, duration_us
from ..operators import detect
from ..operators.patterns import PAYED_MSG, STRICT_FAIL_MSG, TIMEOUT_MSG
from . import processors as PR
from .core import after_watermark, with_event_time

BUCKETS = 64             # processors' groups of keys; more on a large cluster


def _out_schema(df: DataFrame, cols: Sequence[str], extra: str) -> str:
    parts = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols]
    return ", ".join(parts + [extra])


def _not_before_watermark(state, ts_ms: int) -> int:
    """A timer behind the watermark (late input) fires at the next batch."""
    try:
        wm = state.getCurrentWatermarkMs()
    except Exception:
        wm = -1
    return max(int(ts_ms), int(wm) + 1)


# ---------------------------------------------------------------- D1 click cap
def stream_click_cap(df: DataFrame, keys: Sequence[str] = ("user_id", "ad_id"), cap: int = 100,
                     reset: str = "day", ts_col: str = "ts_us", seq_col: str = "seq",
                     msg: str | None = None, keep="7 days", buckets: int = 8 * BUCKETS) -> DataFrame:
    """D1/D1r on a stream: rows of each key pass until ``cap``; the next one warns
    once; later rows are dropped. With ``reset='day'`` the count lives per UTC day, and a day
    that is over keeps its count until the watermark is ``keep`` past its end; a row of a day
    older than that counts in the oldest day kept, so late rows never pass the cap.
    Returns the input columns (but the watermark's) plus ``output`` and ``msg``."""
    if reset not in ("day", "never"):
        raise ValueError("reset must be 'day' or 'never'")
    cols = [c for c in df.columns if c != "ts"]
    day = [F.expr(f"(`{ts_col}` - pmod(`{ts_col}`, {US_PER['day']}L)) div {US_PER['day']}L").alias("_d")] if reset == "day" else []
    d = df.select(*cols, PR.packed(keys).alias("_key"), PR.bucket(keys, buckets), *day)
    d = d.mapInPandas(PR.earliest(["_key", *(["_d"] if day else [])], [ts_col, seq_col], cap + 1), d.schema)
    return PR.run_processor(d, ["_bucket"], PR.ClickCap(
        cols, cap, (msg or detect.CLICK_CAP_MSG).format(cap=cap), ts_col, seq_col, reset == "day", -(-duration_us(keep) // US_PER["day"])),
        _out_schema(df, cols, "output string, msg string"), timers=reset == "day")


# ---------------------------------------------------------------- D2 login failures
def stream_login_fail(df: DataFrame, key: str = "user_id", type_col: str = "event_type",
                      fail: str = "fail", within="2 seconds", ts_col: str = "ts_us",
                      seq_col: str = "seq", msg: str = detect.LOGIN_FAIL_MSG) -> DataFrame:
    """D2 on a stream: keep the last fail since the last other event per user; a
    fail less than ``within`` after it warns and replaces it."""
    w = duration_us(within)
    d = df.select(key, type_col, ts_col, seq_col, *(["ts"] if "ts" in df.columns else []))
    schema = _out_schema(d, [key], "first_us bigint, last_us bigint, msg string")

    def fn(k, batches, state):
        rows = pd.concat([b[[seq_col, type_col, ts_col]] for b in batches]).sort_values(seq_col)
        is_fail = (rows[type_col] == fail).to_numpy()
        ts = rows[ts_col].to_numpy()
        held = state.exists
        before = np.concatenate([[state.get[0] if held else 0], ts[:-1]])
        hit = is_fail & np.concatenate([[held], is_fail[:-1]]) & (ts < before + w)
        if is_fail[-1]:
            state.update((int(ts[-1]),))
        elif held:
            state.remove()
        if hit.any():
            yield pd.DataFrame({key: k[0], "first_us": before[hit], "last_us": ts[hit], "msg": msg})

    return d.groupBy(key).applyInPandasWithState(fn, schema, "last_us long", "append", GroupStateTimeout.NoTimeout)


# ---------------------------------------------------------------- D3 order / pay
def stream_order_outcomes(df: DataFrame, keys: Sequence[str] = ("order_id",), type_col: str = "event_type",
                          create: str = "create", pay: str = "pay", within="15 minutes",
                          ts_col: str = "ts_us", seq_col: str = "seq", buckets: int = BUCKETS) -> DataFrame:
    """D3 on a stream with timers: create waits ``within`` for its pay ('order
    timeout' when the watermark passes the deadline); a pay without create waits
    until the watermark passes its own time ('already payed but not found create
    log'); a late pay is 'payed but already timeout'. A pay that arrives behind the
    watermark but before its order's timer has fired is matched."""
    k = list(keys)
    d = df.filter(after_watermark(F.col(type_col).isin(create, pay)) if "ts" in df.columns else F.col(type_col).isin(create, pay)) \
        .select(PR.packed(k).alias("_key"), PR.bucket(k, buckets), type_col, ts_col)
    d = d.mapInPandas(PR.earliest(["_key", type_col], [ts_col], 1), d.schema)
    out = PR.run_processor(d, ["_bucket"], PR.OrderOutcomes(type_col, create, pay, duration_us(within), ts_col),
                           "_key string, create_us bigint, pay_us bigint, outcome string")
    text = F.when(F.col("outcome") == "in time", detect.PAY_OK).when(F.col("outcome") == "late", detect.PAY_LATE) \
        .when(F.col("outcome") == "no pay", detect.CREATE_NO_PAY).otherwise(detect.PAY_NO_CREATE)
    known = lambda c: F.when(F.col(c) != PR.NONE, F.col(c)).alias(c)
    return out.select(*PR.unpacked(out, "_key", df, k), known("create_us"), known("pay_us"),
                      F.when(F.col("outcome") == "in time", "payed").otherwise("timeout").alias("output"), text.alias("msg"))


# ---------------------------------------------------------------- J2 two inputs, one process function
def stream_tx_match(left: DataFrame, right: DataFrame, on: Sequence[str] | str, wait="5 seconds", left_ts: str = "l_ts_us",
                    right_ts: str = "r_ts_us", delay="0 seconds", max_ts_us: int | None = None, buckets: int = BUCKETS,
                    tags=("matched", "unmatched_pay", "unmatched_receipt")) -> DataFrame:
    """J2 as one process function over two inputs (streams without watermarks; theirs is
    set here, over the rows of both): of each key one row of a side waits. A row of the other
    side takes it, one to one; another row of its own side replaces it; a timer ``wait``
    after a row that waited sends off, unmatched, whatever waits then. A key's rows of a
    micro-batch come in event time, and a timer before a row whose time is past it.
    Late rows are handled like all others. Returns ``reconcile``'s columns."""
    keys = [on] if isinstance(on, str) else list(on)
    sides = [(left, left_ts, True), (right, right_ts, False)]
    both = None
    for df, ts, is_left in sides:
        one = df.select(PR.packed(keys).alias("_key"), PR.bucket(keys, buckets), PR.packed([c for c in df.columns if c not in keys]).alias("_row"),
                        F.lit(is_left).alias("_left"), F.col(ts).alias("ts_us"))
        both = one if both is None else both.unionByName(one)
    both = with_event_time(both, "ts_us", delay, max_ts_us=max_ts_us)
    out = PR.run_processor(both.drop("ts"), ["_bucket"], PR.TxMatch(duration_us(wait), "ts_us", "_row"),
                           "_key string, left string, right string")
    cols = [PR.unpacked(out, c, df, [x for x in df.columns if x not in keys]) for c, (df, _, _) in zip(("left", "right"), sides)]
    tag = F.when(F.col("right").isNull(), tags[1]).when(F.col("left").isNull(), tags[2]).otherwise(tags[0])
    return out.select(*PR.unpacked(out, "_key", left, keys), *cols[0], *cols[1], tag.alias("output"))


# ---------------------------------------------------------------- T7 / A7 / A8 one output a row
def stream_running_unique_visitors(df: DataFrame, size="1 hour", user_col: str = "user_id", seed: int = 61, bits: int = 1 << 29,
                                   ts_col: str = "ts_us", seq_col: str = "seq") -> DataFrame:
    """A8 with a firing for each row: (seq, window_end, uv), the set bits of the row's window's
    bitmap after it. Rows of a micro-batch come in event time; rows of a closed window are dropped."""
    size_us = duration_us(size)
    d = df.select(F.expr(f"(`{ts_col}` - pmod(`{ts_col}`, {size_us}L)) div {size_us}L").alias("_window"), ts_col, seq_col,
                  poly_hash_mask(F.col(user_col).cast("string"), seed, bits).alias("_pos"))
    return PR.run_processor(d, ["_window"], PR.RunningDistinct(size_us // 1000, ts_col, seq_col), "seq bigint, window_end bigint, uv bigint")


# ---------------------------------------------------------------- C1 / C2 patterns
# Pattern matching consumes a key's rows in event-time order: rows are buffered
# in state until the watermark passes them (then sorted by (ts, seq) and
# consumed); rows arriving behind what was already consumed are late and dropped.
# The buffer holds at most the watermark delay's worth of a key's rows.

_PENDING = "p_ts array<bigint>, p_seq array<bigint>, p_type array<string>"


def _ready(state, batches, ts_col, seq_col, type_col, last_ts):
    """Merge buffered and new rows; return (ready rows sorted, still pending rows)."""
    parts = [b[[ts_col, seq_col, type_col]] for b in batches]
    if state.exists:
        st = state.get
        if st[0]:
            parts.append(pd.DataFrame({ts_col: list(st[0]), seq_col: list(st[1]), type_col: list(st[2])}))
    rows = pd.concat(parts) if parts else pd.DataFrame(columns=[ts_col, seq_col, type_col])
    if last_ts is not None:
        rows = rows[rows[ts_col] >= last_ts]           # behind the consumed part: late
    wm_us = _watermark_us(state)
    rows = rows.sort_values([ts_col, seq_col])
    return rows[rows[ts_col] <= wm_us], rows[rows[ts_col] > wm_us], wm_us


def _watermark_us(state) -> int:
    try:
        wm = int(state.getCurrentWatermarkMs())
    except Exception:
        wm = 0
    return wm * 1000 if wm > 0 else -(1 << 62)


def _pending_tuple(pend, ts_col, seq_col, type_col):
    return ([int(x) for x in pend[ts_col]], [int(x) for x in pend[seq_col]], [str(x) for x in pend[type_col]])


def stream_strict_pair(df: DataFrame, key: str = "user_id", type_col: str = "event_type",
                       first: str = "fail", second: str = "fail", within="2 seconds",
                       ts_col: str = "ts_us", seq_col: str = "seq", msg: str = STRICT_FAIL_MSG) -> DataFrame:
    """C1 on a stream: ``first`` immediately followed by ``second`` (event-time order)
    with ``second.ts - first.ts < within``; emitted once the watermark passes the second."""
    w = duration_us(within)
    d = df.select(key, type_col, ts_col, seq_col, *(["ts"] if "ts" in df.columns else []))
    schema = _out_schema(d, [key], "first_us bigint, last_us bigint, msg string")

    def fn(k, batches, state):
        last_ts, last_type = (state.get[3], state.get[4]) if state.exists else (None, None)
        ready, pend, wm_us = _ready(state, [] if state.hasTimedOut else batches, ts_col, seq_col, type_col, last_ts)
        ts, kind = ready[ts_col].to_numpy(dtype="int64"), ready[type_col].to_numpy()
        if len(ts):
            before = np.concatenate([[ts[0] if last_ts is None else last_ts], ts[:-1]])
            opens = np.concatenate([[last_type == first], kind[:-1] == first]).astype(bool)
            hit = opens & (kind == second) & (ts - before < w)
            last_ts, last_type = int(ts[-1]), str(kind[-1])
            if hit.any():
                yield pd.DataFrame({key: k[0], "first_us": before[hit], "last_us": ts[hit], "msg": msg})
        # the last row can still open a match; older rows are behind the watermark and dropped
        open_ = last_type == first and last_ts + w > wm_us
        if not len(pend) and not open_:
            if state.exists:
                state.remove()
            return
        state.update((*_pending_tuple(pend, ts_col, seq_col, type_col), last_ts, last_type))
        next_us = int(pend[ts_col].min()) if len(pend) else last_ts + w
        state.setTimeoutTimestamp(_not_before_watermark(state, next_us // 1000 + 1))

    return d.groupBy(key).applyInPandasWithState(
        fn, schema, f"{_PENDING}, last_ts bigint, last_type string", "append",
        GroupStateTimeout.EventTimeTimeout)


def stream_followed_by_within(df: DataFrame, key: str = "order_id", type_col: str = "event_type",
                              start: str = "create", end: str = "pay", within="15 minutes",
                              ts_col: str = "ts_us", seq_col: str = "seq",
                              matched_msg: str = PAYED_MSG, timeout_msg: str = TIMEOUT_MSG, buckets: int = BUCKETS) -> DataFrame:
    """C2 on a stream: each ``start`` waits for the first later ``end`` of its key;
    matched when it comes less than ``within`` later, else a timeout row once the
    watermark reaches start + within (the reference's timeout side output)."""
    # with the watermark's column, so that Spark drops late rows
    d = df.select(PR.packed([key]).alias("_key"), PR.bucket([key], buckets), type_col, ts_col, seq_col, *(["ts"] if "ts" in df.columns else []))
    out = PR.run_processor(d, ["_bucket"], PR.FollowedBy(type_col, start, end, duration_us(within), ts_col, seq_col, matched_msg, timeout_msg),
                           "_key string, start_us bigint, end_us bigint, output string, msg string")
    return out.select(*PR.unpacked(out, "_key", df, [key]), "start_us", "end_us", "output", "msg")
