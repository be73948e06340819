"""Streaming twins registered as queries: each runs a Structured Streaming query
over the driver's ``events`` table (file-stream source, ``availableNow``), writes
its sink under the shared checkpoint folder and returns the sink as a table.

Oracles are the batch SQL restricted to what a stream may have emitted by the
end: windows closed by the final watermark (``window_end <= max event time``),
and for the timer-driven detector only keys whose timer has fired.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import testdata as td
from ..streaming import jobs as SJ
from ..streaming import state as ST
from ..streaming.core import after_watermark, run_available_now as _run, with_event_time
from ..functions.text import tx_present
from ..functions.time import format_window_time
from . import oracle as O
from .queries import CAP_RANKED, D, H, MIN, MKT, PV, S, _TX, _TXR, _by_hour, _hourly, register
from .queries import ORACLE as _BATCH_SQL


def run_available_now(df, name, **kw):
    """Registered streams use one state partition per core of the cluster."""
    kw.setdefault("state_partitions", df.sparkSession.sparkContext.defaultParallelism)
    return _run(df, name, **kw)


def _closed(sql: str, src: str) -> str:
    """Rows of ``sql`` whose window has been closed by the watermark of ``src``."""
    return f"SELECT * FROM ({sql}) q WHERE window_end <= (SELECT max(ts_us) // 1000 FROM ({src}) s)"


def _behavior_stream(spark, sf_dir):
    return with_event_time(td.user_behavior(spark, sf_dir, stream=True), "ts_us", "0 seconds")


@register("stream_page_views_hourly", _closed(_BATCH_SQL["page_views_hourly"], O.USER_BEHAVIOR))
def stream_page_views_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 T3 A2 on a stream: page views per tumbling hour (append mode)."""
    c = SJ.stream_window_count(SJ.page_views(_behavior_stream(spark, sf_dir)), None, "1 hour", count_col="pv")
    return run_available_now(c, "page_views")


@register("stream_hot_items_topn", O.topn(_closed(O.sliding(PV, ["item_id"], H, 5 * MIN), O.USER_BEHAVIOR), "item_id", 3))
def stream_hot_items_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HotItems on a stream: pane-chained sliding counts, top 3 per closed window."""
    counts, rank = SJ.stream_hot_items(_behavior_stream(spark, sf_dir), "1 hour", "5 minutes", 3)
    return run_available_now(counts, "hot_items", foreach=rank)


@register("stream_uv_exact_hourly", _closed(_BATCH_SQL["uv_exact_hourly"], O.USER_BEHAVIOR))
def stream_uv_exact_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 A6 on a stream: distinct users per hour in two chained aggregates."""
    return run_available_now(SJ.stream_unique_visitors(_behavior_stream(spark, sf_dir), "1 hour"), "uv_exact")


@register("stream_ad_clicks_by_region", _closed(_BATCH_SQL["ad_clicks_by_region"], O.AD_CLICKS))
def stream_ad_clicks_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad clicks per province on a stream (stream-static join to the customer geography)."""
    clicks = with_event_time(td.ad_clicks(spark, sf_dir, stream=True), "ts_us", "0 seconds")
    c = run_available_now(SJ.stream_sliding_stretches(clicks, "province", "1 hour", "5 seconds"), "ad_clicks")
    return SJ.unfold_windows(c, "1 hour", "5 seconds").select(
        "window_end", format_window_time("window_end").alias("window_end_str"), "province", "cnt")


def _pays_and_receipts(spark, sf_dir):
    """Both sides of the joins; each watermark follows all events, filtered after it."""
    def side(ts_col, event_type, rename):
        e = with_event_time(td.events(spark, sf_dir, None, True), "ts_us", "0 seconds", ts_col)
        return rename(e.filter(after_watermark(F.col("event_type") == event_type, ts_col)))
    return (side("pay_ts", "purchase", lambda e: td.as_pays(e, "pay_ts").withColumnRenamed("ts_us", "pay_us")),
            side("receipt_ts", "click", lambda e: td.as_receipts(e, "receipt_ts").withColumnRenamed("ts_us", "receipt_us")))


@register("stream_tx_interval_join", _BATCH_SQL["tx_interval_join"])
def stream_tx_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 between two watermarked streams (purchases, clicks), +-1 h, inclusive."""
    pays, recs = _pays_and_receipts(spark, sf_dir)
    j = SJ.stream_interval_join(pays, recs, "key", "-1 hour", "1 hour", "pay_ts", "receipt_ts")
    j = j.select("key", "pay_id", "pay_us", "receipt_id", "pay_channel", "receipt_us")
    return run_available_now(j, "tx_join")


def _cap_stream(spark, sf_dir):
    e = td.events(spark, sf_dir, stream=True).select("user_id", "event_type", "seq", "ts_us")
    e = with_event_time(e, "ts_us", "0 seconds")
    return run_available_now(ST.stream_click_cap(e, ("user_id", "event_type"), 2, "day"), "click_cap")


@register("stream_click_cap_pass", f"SELECT user_id, event_type, seq, ts_us FROM ({CAP_RANKED}) t WHERE rn <= 2")
def stream_click_cap_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 D1r on a stream (state by bucket, counts of finished days kept): rows that pass."""
    return _cap_stream(spark, sf_dir).filter(F.col("output") == "pass").select("user_id", "event_type", "seq", "ts_us")


@register("stream_click_cap_warn", _BATCH_SQL["click_cap_warn"])
def stream_click_cap_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on a stream: the one warning per key and day (side output)."""
    return (_cap_stream(spark, sf_dir).filter(F.col("output") == "warn")
            .select("user_id", "event_type", "seq", "ts_us", "msg"))


@register("stream_login_fail_arrival", _BATCH_SQL["login_fail_arrival"])
def stream_login_fail_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 on a stream (keyed state, arrival order)."""
    lg = with_event_time(td.login_events(spark, sf_dir, stream=True), "ts_us", "5 seconds")
    return run_available_now(ST.stream_login_fail(lg, within="1 hour"), "login_fail")


_OUTCOME_SRC = O.ORDERS


@register("stream_order_pay_outcomes", (
    f"SELECT order_id, day, create_us, pay_us, output, msg FROM ({_BATCH_SQL['order_pay_outcomes']}) q "
    f"WHERE (create_us IS NOT NULL AND pay_us IS NOT NULL) "
    f"OR (pay_us IS NULL AND (create_us + {4 * H}) // 1000 < (SELECT max(ts_us) // 1000 FROM ({_OUTCOME_SRC}) s)) "
    f"OR (create_us IS NULL AND pay_us // 1000 < (SELECT max(ts_us) // 1000 FROM ({_OUTCOME_SRC}) s))"))
def stream_order_pay_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 on a stream: keyed state with event-time timers (4 h deadline per user-day)."""
    o = td.order_events(spark, sf_dir, stream=True)
    o = with_event_time(o.withColumn("day", F.expr(f"ts_us div {D}L")), "ts_us", "0 seconds")
    return run_available_now(ST.stream_order_outcomes(o, ("order_id", "day"), within="4 hours"), "order_outcomes")


def _wm_us(src: str, delay_ms: int = 0) -> str:
    """The final watermark of a stream over ``src`` in µs (Spark keeps it in ms)."""
    return f"((SELECT max(ts_us) // 1000 FROM ({src}) s) - {delay_ms}) * 1000"


@register("stream_login_fail_strict", (
    f"SELECT * FROM ({_BATCH_SQL['login_fail_strict']}) q WHERE last_us <= {_wm_us(O.LOGIN, 5000)}"))
def stream_login_fail_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 on a stream: rows buffered until the watermark (5 s delay), matched in event-time order."""
    lg = with_event_time(td.login_events(spark, sf_dir, stream=True), "ts_us", "5 seconds")
    return run_available_now(ST.stream_strict_pair(lg, within="1 hour"), "login_strict")


@register("stream_order_pay_timeout", (
    f"SELECT * FROM ({_BATCH_SQL['order_pay_timeout']}) q WHERE (output = 'matched' AND end_us <= {_wm_us(O.ORDERS)}) "
    f"OR (output = 'timeout' AND start_us + {D} <= {_wm_us(O.ORDERS)})"))
def stream_order_pay_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 on a stream: create followed by pay within 1 day, timeouts by event-time timers."""
    o = with_event_time(td.order_events(spark, sf_dir, stream=True), "ts_us", "0 seconds")
    return run_available_now(ST.stream_followed_by_within(o, within="1 day"), "order_timeout")


@register("stream_uv_bitmap_hourly", _closed(_BATCH_SQL["uv_bitmap_hourly"], O.USER_BEHAVIOR))
def stream_uv_bitmap_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 on a stream: hashed users in per-window bitmaps (chained aggregates)."""
    return run_available_now(SJ.stream_bitmap_unique_visitors(_behavior_stream(spark, sf_dir)), "uv_bitmap")


@register("stream_hot_urls_topn", (
    f"SELECT * FROM ({_BATCH_SQL['hot_urls_topn']}) q "
    f"WHERE window_end <= (SELECT max(ts_ms) - 1000 FROM ({O.ACCESS_LOG}) s)"))
def stream_hot_urls_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NetworkFlow on a stream: parsed log lines, 1 s out-of-orderness watermark,
    10 min / 5 s pane-chained counts, top 5 per closed window."""
    from ..sources.access_log import parse_access_log
    log = with_event_time(parse_access_log(td.access_log_lines(spark, sf_dir, stream=True)), "ts_us", "1 second")
    counts, rank = SJ.stream_hot_urls(log, "10 minutes", "5 seconds", 5)
    return run_available_now(counts, "hot_urls", foreach=rank)


@register("stream_marketing_by_channel", _closed(_BATCH_SQL["marketing_by_channel"], O.MARKETING))
def stream_marketing_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 on a stream: counts per (channel, behaviour), 1 h windows sliding by 1 min."""
    m = with_event_time(td.marketing_events(spark, sf_dir, stream=True), "ts_us", "0 seconds")
    c = SJ.stream_marketing_counts(m, ["channel", "behavior"], "1 hour", "1 minute")
    c = c.select("window_start", "window_end", format_window_time("window_start").alias("window_start_str"),
                 format_window_time("window_end").alias("window_end_str"), "channel", "behavior", "cnt")
    return run_available_now(c, "marketing")


@register("stream_marketing_total", _closed(_BATCH_SQL["marketing_total"], O.MARKETING))
def stream_marketing_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 on a stream: grand total per 1 h window sliding by 1 min."""
    m = with_event_time(td.marketing_events(spark, sf_dir, stream=True), "ts_us", "0 seconds")
    c = SJ.stream_marketing_counts(m, None, "1 hour", "1 minute")
    c = c.select("window_start", "window_end", format_window_time("window_start").alias("window_start_str"),
                 format_window_time("window_end").alias("window_end_str"), F.lit("total").alias("channel"),
                 F.lit("total").alias("behavior"), "cnt")
    return run_available_now(c, "marketing_total")


@register("stream_marketing_by_channel_1s", _by_hour(_closed(O.sliding(MKT, ["channel", "behavior"], H, S), O.MARKETING), "channel, behavior"))
def stream_marketing_by_channel_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 on a stream with the reference's slide of 1 s: stretches of equal counts, unfolded
    into their windows and reported by hour as ``marketing_by_channel_1s``."""
    m = with_event_time(td.marketing_events(spark, sf_dir, stream=True), "ts_us", "0 seconds")
    c = run_available_now(SJ.stream_marketing_stretches(m, ["channel", "behavior"]), "marketing_1s")
    return _hourly(SJ.unfold_windows(c))


@register("stream_marketing_total_1s", _by_hour("SELECT 'total' AS channel, 'total' AS behavior, window_end, cnt FROM ("
                                                + _closed(O.sliding(MKT, [], H, S), O.MARKETING) + ") c", "channel, behavior"))
def stream_marketing_total_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 on a stream with the reference's slide of 1 s, reported as ``marketing_total_1s``."""
    m = with_event_time(td.marketing_events(spark, sf_dir, stream=True), "ts_us", "0 seconds")
    c = SJ.unfold_windows(run_available_now(SJ.stream_marketing_stretches(m, None), "marketing_total_1s"))
    return _hourly(c.withColumn("channel", F.lit("total")).withColumn("behavior", F.lit("total")))


_WM2 = f"((SELECT max(ts_us) // 1000 FROM ({O.EVENTS}) a) * 1000)"


@register("stream_tx_reconcile", (
    f"SELECT * FROM ({_BATCH_SQL['tx_reconcile']}) q WHERE output = 'matched' "
    f"OR (output = 'unmatched_pay' AND pay_us + {H} < {_WM2}) "
    f"OR (output = 'unmatched_receipt' AND receipt_us + {H} < {_WM2})"))
def stream_tx_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 on streams: full outer interval join (+-1 h) of purchases and clicks; an
    unmatched row is emitted once the watermark has passed its interval."""
    pays, recs = _pays_and_receipts(spark, sf_dir)
    j = SJ.stream_interval_join(pays, recs, "key", "-1 hour", "1 hour", "pay_ts", "receipt_ts", "full_outer")
    j = j.select("key", "pay_id", "pay_us", "receipt_id", "pay_channel", "receipt_us", "output")
    return run_available_now(j, "tx_reconcile")


# ------------------------------------------------------------------ many micro-batches, late rows
# The streams below deliver their rows in BATCHES micro-batches by event time, and a block
# of rows late. A row's batch, and the watermark when a batch begins, in SQL:
BATCHES = 8
_RANGE = f"(SELECT min(ts_us) AS lo, max(ts_us) AS hi FROM ({O.EVENTS}) e)"


def _delivered(src: str, late: str) -> str:
    return (f"SELECT s.*, least((ts_us - lo) * {BATCHES} // (hi - lo + 1) + ({late}), {BATCHES - 1}) AS batch "
            f"FROM ({src}) s, {_RANGE} r")


def _watermarks(src: str) -> str:
    """(batch, wm): milliseconds, from the rows of the batches before."""
    return (f"SELECT b AS batch, coalesce((SELECT max(ts_us) // 1000 FROM ({src}) w WHERE w.batch < b), 0) AS wm "
            f"FROM range(0, {BATCHES + 1}) r(b)")


_CAP_SRC = _delivered(f"SELECT user_id, event_type, seq, ts_us FROM ({O.EVENTS}) e", "CASE WHEN seq % 10 = 7 THEN 2 ELSE 0 END")
# rows in order of arrival: by micro-batch, in it by event time
_CAP_LATE = (f"SELECT s.*, row_number() OVER (PARTITION BY user_id, event_type, ts_us // {D} ORDER BY batch, ts_us, seq) AS rn "
             f"FROM ({_CAP_SRC}) s")


@register("stream_click_cap_late", (
    f"SELECT user_id, event_type, seq, ts_us, CASE WHEN rn <= 2 THEN 'pass' ELSE 'warn' END AS output "
    f"FROM ({_CAP_LATE}) t WHERE rn <= 3"))
def stream_click_cap_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 D1r T8 over many micro-batches: state carried across them, every tenth row two
    batches late, most of those after the watermark has passed their day: the day's count stands."""
    e = td.events(spark, sf_dir).select("user_id", "event_type", "seq", "ts_us")
    e = td.in_batches(spark, e, *td.time_range(spark, sf_dir), BATCHES, F.when(F.col("seq") % 10 == 7, 2).otherwise(0))
    capped = ST.stream_click_cap(with_event_time(e), ("user_id", "event_type"), 2, "day", keep="30 days")
    return run_available_now(capped, "click_cap_late").drop("msg")


_PAY_WITHIN = 4 * H
_ONE_SRC = (f"SELECT order_id, 'create' AS event_type, ts_us FROM (SELECT event_id AS order_id, ts_us FROM ({O.EVENTS}) e "
            f"WHERE event_type = 'signup') c UNION ALL SELECT order_id, 'pay', ts_us + (order_id * 7919) % 12 * {H} "
            f"FROM (SELECT event_id AS order_id, ts_us FROM ({O.EVENTS}) e WHERE event_type = 'signup') p WHERE order_id % 4 <> 0")
_ONE_LATE = _delivered(_ONE_SRC, "CASE WHEN event_type = 'pay' AND order_id % 10 = 7 THEN 1 ELSE 0 END")


@register("stream_order_outcomes_late", (
    f"WITH s AS ({_ONE_LATE}), w AS ({_watermarks('SELECT * FROM s')}), "
    f"o AS (SELECT c.order_id, c.ts_us AS c, c.batch AS cb, p.ts_us AS p, p.batch AS pb FROM s c LEFT JOIN s p "
    f"ON c.order_id = p.order_id AND p.event_type = 'pay' WHERE c.event_type = 'create'), "
    f"f AS (SELECT max(wm) AS fin FROM w), "
    f"x AS (SELECT o.*, fin, coalesce(pb > cb AND wm > (c + {_PAY_WITHIN}) // 1000, false) AS missed FROM o "
    f"LEFT JOIN w ON w.batch = o.pb, f) "
    f"SELECT order_id, c AS create_us, p AS pay_us, CASE WHEN p < c + {_PAY_WITHIN} THEN 'payed' ELSE 'timeout' END AS output, "
    f"CASE WHEN p < c + {_PAY_WITHIN} THEN 'payed successfully' ELSE 'payed but already timeout' END AS msg "
    f"FROM x WHERE p IS NOT NULL AND NOT missed "
    f"UNION ALL SELECT order_id, c, NULL, 'timeout', 'order timeout' FROM x "
    f"WHERE missed OR (p IS NULL AND fin > (c + {_PAY_WITHIN}) // 1000) "
    f"UNION ALL SELECT order_id, NULL, p, 'timeout', 'already payed but not found create log' FROM x "
    f"WHERE missed AND fin > p // 1000"))
def stream_order_outcomes_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 T6 T8 over many micro-batches: creates wait across them, one pay in ten comes a
    batch late: matched if its order's timer has not fired by then."""
    o = td.in_batches(spark, td.single_orders(spark, sf_dir), *td.time_range(spark, sf_dir), BATCHES,
                      F.when((F.col("event_type") == "pay") & (F.col("order_id") % 10 == 7), 1).otherwise(0))
    out = ST.stream_order_outcomes(with_event_time(o), ("order_id",), within="4 hours")
    return run_available_now(out, "order_outcomes_late")


_BEH_LATE = _delivered(O.USER_BEHAVIOR, "CASE WHEN seq % 10 = 7 THEN 1 ELSE 0 END")


@register("stream_page_views_late", (
    f"WITH s AS ({_BEH_LATE}), w AS ({_watermarks('SELECT * FROM s')}) "
    f"SELECT ts_us // {H} * {H // 1000} AS window_start, (ts_us // {H} + 1) * {H // 1000} AS window_end, "
    f"CAST(count(*) AS BIGINT) AS pv FROM s JOIN w ON w.batch = greatest(s.batch - 1, 0) WHERE behavior = 'pv' AND (ts_us // {H} + 1) * {H // 1000} > wm "
    f"AND (ts_us // {H} + 1) * {H // 1000} <= (SELECT max(wm) FROM w) GROUP BY ALL"))
def stream_page_views_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 T8 over many micro-batches: windows drop rows that come after they closed (Spark
    takes rows as late by the watermark that the batch before began with)."""
    b = td.in_batches(spark, td.user_behavior(spark, sf_dir), *td.time_range(spark, sf_dir), BATCHES,
                      F.when(F.col("seq") % 10 == 7, 1).otherwise(0))
    return run_available_now(SJ.stream_window_count(SJ.page_views(with_event_time(b)), None, "1 hour", count_col="pv"), "pv_late")


_D1G = (f"SELECT *, row_number() OVER (PARTITION BY user_id, ts_us // {D} ORDER BY ts_us, seq) AS rn FROM ({O.AD_CLICKS}) a")


@register("stream_click_cap_by_region", (
    f"SELECT window_end, strftime(epoch_ms(window_end), '%Y/%m/%d-%H:%M:%S') AS window_end_str, province, cnt FROM ("
    + O.sliding(f"SELECT * FROM ({_D1G}) b WHERE rn <= 1", ["province"], H, 5 * S)
    + f") t WHERE window_end <= (SELECT max(ts_us) // 1000 FROM ({O.AD_CLICKS}) m)"))
def stream_click_cap_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1g as one streaming query: capped clicks, then clicks per province in 1 h windows
    sliding by 5 s, a second state behind the first; the watermark follows every click."""
    clicks = with_event_time(td.ad_clicks(spark, sf_dir, stream=True))
    c = SJ.stream_capped_stretches(clicks, "province", ("user_id",), 1, "1 hour", "5 seconds")
    c = SJ.unfold_windows(run_available_now(c, "cap_region"), "1 hour", "5 seconds")
    return c.select("window_end", format_window_time("window_end").alias("window_end_str"), "province", "cnt")


@register("stream_uv_bitmap_running", _BATCH_SQL["uv_bitmap_running"])
def stream_uv_bitmap_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 A7 A8 on a stream, over many micro-batches: one output a page view, the set bits of
    its hour's bitmap so far."""
    b = td.in_batches(spark, td.user_behavior(spark, sf_dir), *td.time_range(spark, sf_dir), BATCHES)
    return run_available_now(ST.stream_running_unique_visitors(SJ.page_views(with_event_time(b))), "uv_running")


@register("stream_tx_match", (
    f"SELECT * FROM ({_BATCH_SQL['tx_reconcile_unique']}) q, (SELECT greatest((SELECT max(pay_us) FROM ({_TX}) a), "
    f"(SELECT max(receipt_us) FROM ({_TXR}) b)) // 1000 AS wm) w "
    f"WHERE output = 'matched' OR (coalesce(pay_us, receipt_us) + {5 * S}) // 1000 < wm").replace("SELECT * FROM", "SELECT q.* FROM", 1))
def stream_tx_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 T6 as one process function over two inputs, over many micro-batches: pays and
    receipts pair one to one within 5 s, what waits longer is sent off unmatched by a timer."""
    orders = td.order_events(spark, sf_dir)
    pays = orders.filter(tx_present("tx_id")).select("tx_id", F.col("seq").alias("order_id"), F.col("ts_us").alias("pay_us"))
    around = (spark, *td.time_range(spark, sf_dir), BATCHES)
    sides = [td.in_batches(around[0], x, *around[1:], ts_col=ts) for x, ts in ((pays, "pay_us"), (td.unique_receipts(spark, sf_dir), "receipt_us"))]
    return run_available_now(ST.stream_tx_match(*sides, "tx_id", "5 seconds", "pay_us", "receipt_us"), "tx_match")


@register("stream_uv_update_hourly", _BATCH_SQL["uv_exact_hourly"])
def stream_uv_update_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 A8 on a stream: an HLL estimate re-emitted after every micro-batch that touches its
    window (update mode); the last of each window (a few hundred users, which a sketch
    counts exactly)."""
    b = td.in_batches(spark, td.user_behavior(spark, sf_dir), *td.time_range(spark, sf_dir), BATCHES)
    out = run_available_now(SJ.stream_sketch_unique_visitors(with_event_time(b)), "uv_update", mode="update")
    return out.groupBy("window_start", "window_end").agg(F.max("uv").alias("uv"))
