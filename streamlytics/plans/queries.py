"""Registered queries: each reads the driver's tables at ``sf_dir`` and runs one
of the reference's jobs (or one operator of it) over the whole data.

``QUERIES[name] = fn(spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` is the
DuckDB SQL that must give the same rows (same column names; bigint / string /
double only; window bounds are epoch milliseconds, event times epoch µs).
Parameters follow the reference except where its constant would find nothing in
the test data (noted per query).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import testdata as td
from ..sources.access_log import parse_access_log
from . import jobs
from . import oracle as O

QUERIES: dict = {}
ORACLE: dict = {}

H, MIN, S, D = O.US["h"], O.US["min"], O.US["s"], O.US["d"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _views(spark, sf_dir):
    return td.user_behavior(spark, sf_dir, where=F.col("event_type") == "view")


PV = f"SELECT * FROM ({O.USER_BEHAVIOR}) WHERE behavior = 'pv'"

# ------------------------------------------------------------------ hot items
# The report texts (labels, rulers) and messages in the SQL below are those of
# the reference's jobs, as in operators.topn, operators.detect and operators.patterns.
HOT_ITEMS_SQL = O.topn(O.sliding(PV, ["item_id"], H, 5 * MIN), "item_id", 3)


@register("hot_items_topn", HOT_ITEMS_SQL)
def hot_items_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 viewed items per 1 h window sliding by 5 min."""
    return jobs.hot_items(_views(spark, sf_dir))


@register("hot_items_report", (
    f"SELECT window_end, '时间：' || strftime(epoch_ms(window_end), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10) "
    f"|| string_agg('No' || rank || ': 商品ID=' || item_id || ' 浏览量=' || cnt, chr(10) ORDER BY rank) "
    f"|| chr(10) || '================================' AS report FROM ({HOT_ITEMS_SQL}) t GROUP BY window_end"))
def hot_items_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the ranking of ``hot_items_topn`` rendered as one text block per window."""
    return jobs.hot_items_report(hot_items_topn(spark, sf_dir))


# ------------------------------------------------------------------ web log
@register("access_log_parse", f"SELECT ip, user_id, ts_ms * 1000 AS ts_us, method, url FROM ({O.ACCESS_LOG})")
def access_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines built from events, split and time-parsed."""
    return parse_access_log(td.access_log_lines(spark, sf_dir)).drop("seq")


PAGES = (f"SELECT url, ts_ms * 1000 AS ts_us FROM ({O.ACCESS_LOG}) "
         f"WHERE NOT regexp_matches(url, '\\.(css|js)$')")


HOT_URLS_SQL = O.topn(O.sliding(PAGES, ["url"], 10 * MIN, 5 * S), "url", 5)


@register("hot_urls_topn", HOT_URLS_SQL)
def hot_urls_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 URLs per 10 min window sliding by 5 s."""
    return jobs.hot_urls(parse_access_log(td.access_log_lines(spark, sf_dir)))


@register("hot_urls_report", (
    f"SELECT window_end, '=================================' || chr(10) || '时间：' "
    f"|| strftime(epoch_ms(window_end), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10) "
    f"|| string_agg('NO' || rank || ': URL=' || url || ' 流量=' || cnt, chr(10) ORDER BY rank) "
    f"|| chr(10) || '=============================' || chr(10) || chr(10) AS report "
    f"FROM ({HOT_URLS_SQL}) t GROUP BY window_end"))
def hot_urls_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the URL ranking rendered as the reference's text block per window."""
    return jobs.hot_urls_report(hot_urls_topn(spark, sf_dir))


# ------------------------------------------------------------------ page views / uv
@register("page_views_hourly", (
    f"SELECT (ts_us // {H}) * {H // 1000} AS window_start, (ts_us // {H} + 1) * {H // 1000} AS window_end, "
    f"CAST(count(*) AS BIGINT) AS pv FROM ({PV}) GROUP BY ALL"))
def page_views_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views per tumbling hour."""
    return jobs.page_views(_views(spark, sf_dir))


@register("uv_exact_hourly", (
    f"SELECT (ts_us // {H}) * {H // 1000} AS window_start, (ts_us // {H} + 1) * {H // 1000} AS window_end, "
    f"CAST(count(DISTINCT user_id) AS BIGINT) AS uv FROM ({PV}) GROUP BY ALL"))
def uv_exact_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct visitors per tumbling hour."""
    return jobs.unique_visitors(_views(spark, sf_dir))


@register("uv_running", (
    f"SELECT seq, window_end, CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY window_end "
    f"ORDER BY ts_us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS uv FROM ("
    f"SELECT seq, ts_us, (ts_us // {D} + 1) * {D // 1000} AS window_end, row_number() OVER "
    f"(PARTITION BY ts_us // {D}, user_id ORDER BY ts_us, seq) AS rn FROM ({PV})) t"))
def uv_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page view, distinct visitors of its day so far (fires per element)."""
    return jobs.unique_visitors_running(_views(spark, sf_dir), size="1 day")


HASH61 = ("list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), "
          "lambda a, x: (a * 61 + x) % 536870912, CAST(0 AS BIGINT))")


@register("uv_bitmap_hourly", (
    f"SELECT (ts_us // {H}) * {H // 1000} AS window_start, (ts_us // {H} + 1) * {H // 1000} AS window_end, "
    f"CAST(count(DISTINCT {HASH61}) AS BIGINT) AS uv FROM ({PV}) GROUP BY ALL"))
def uv_bitmap_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors per hour as set bits of a 2^29-bit bitmap (hash seed 61)."""
    return jobs.unique_visitors_bitmap(_views(spark, sf_dir))


@register("uv_bitmap_running", (
    f"SELECT seq, window_end, CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY window_end "
    f"ORDER BY ts_us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS uv FROM ("
    f"SELECT seq, ts_us, (ts_us // {H} + 1) * {H // 1000} AS window_end, row_number() OVER "
    f"(PARTITION BY ts_us // {H}, {HASH61} ORDER BY ts_us, seq) AS rn FROM ({PV})) t"))
def uv_bitmap_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page view, distinct hash bits (seed 61, 2^29) so far in its hour."""
    return jobs.unique_visitors_bitmap_running(_views(spark, sf_dir))


@register("uv_approx_hourly", ORACLE["uv_exact_hourly"] if "uv_exact_hourly" in ORACLE else None)
def uv_approx_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HLL sketch per hour (lg_k 12). The sketch keeps exact coupons while a window
    holds few distinct users (list/set modes, a few hundred here), so the exact
    distinct count is its oracle on the test data; larger windows are approximate."""
    from ..operators.distinct import approx_unique_visitors
    return approx_unique_visitors(_views(spark, sf_dir), "user_id", "ts_us", "1 hour")


# a bitmap so small that a day's visitors collide, by a uniform hash
_SMALL = 1024
_MD5_BITS = f"(CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % {_SMALL})"


@register("uv_bitmap_estimate", (
    f"SELECT window_start, window_end, set_bits, CAST(round(-{_SMALL}.0::DOUBLE * ln(1 - set_bits / {_SMALL}.0::DOUBLE)) AS BIGINT) AS uv_estimate, "
    f"true AS within FROM (SELECT (ts_us // {D}) * {D // 1000} AS window_start, (ts_us // {D} + 1) * {D // 1000} AS window_end, "
    f"CAST(count(DISTINCT {_MD5_BITS}) AS BIGINT) AS set_bits FROM ({PV}) GROUP BY ALL) t"))
def uv_bitmap_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 on full windows: a day's visitors in a bitmap of 1,024 bits, collisions corrected by
    linear counting; ``within``: four standard errors hold the exact count."""
    from ..operators.distinct import bitmap_unique_visitors, linear_count, linear_count_error, unique_visitors
    pv = _views(spark, sf_dir).filter(F.col("behavior") == "pv")
    pos = F.conv(F.substring(F.md5(F.col("user_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % _SMALL
    bits = bitmap_unique_visitors(pv.select("ts_us", pos.alias("_pos")), "_pos", "ts_us", "1 day", "set_bits")
    exact = unique_visitors(pv, "user_id", "ts_us", "1 day")
    out = bits.withColumn("uv_estimate", linear_count("set_bits", _SMALL)).join(exact, ["window_start", "window_end"])
    return out.select("window_start", "window_end", "set_bits", "uv_estimate",
                      (F.abs(F.col("uv_estimate") - F.col("uv")) <= 4 * linear_count_error("uv", _SMALL) + 1).alias("within"))


@register("uv_approx_bound", (
    f"SELECT (ts_us // {D}) * {D // 1000} AS window_start, (ts_us // {D} + 1) * {D // 1000} AS window_end, "
    f"CAST(count(DISTINCT user_id) AS BIGINT) AS uv, true AS within FROM ({PV}) GROUP BY ALL"))
def uv_approx_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 with a sketch too small to be exact (64 registers): ``within``: the HLL estimate of a
    day's visitors lies within four standard errors of the exact count."""
    from ..operators.distinct import approx_unique_visitors, hll_error, unique_visitors
    pv = _views(spark, sf_dir).filter(F.col("behavior") == "pv")
    exact = unique_visitors(pv, "user_id", "ts_us", "1 day")
    near = approx_unique_visitors(pv, "user_id", "ts_us", "1 day", lg_k=6, out="estimate")
    return exact.join(near, ["window_start", "window_end"]).select(
        "window_start", "window_end", "uv", (F.abs(F.col("estimate") - F.col("uv")) <= 4 * hll_error("uv", 6) + 1).alias("within"))


@register("avg_integer", (
    f"SELECT user_id, CAST(sum(ts_us // 1000000) // count(*) AS DOUBLE) AS avg_ts FROM ({O.USER_BEHAVIOR}) GROUP BY user_id"))
def avg_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: integer-division mean of epoch seconds per user."""
    return jobs.average_timestamp(td.user_behavior(spark, sf_dir))


# ------------------------------------------------------------------ ads
def _fmt(col: str) -> str:
    return f"strftime(epoch_ms({col}), '%Y/%m/%d-%H:%M:%S')"


@register("ad_clicks_by_region", (
    f"SELECT window_end, {_fmt('window_end')} AS window_end_str, province, cnt "
    f"FROM ({O.sliding(O.AD_CLICKS, ['province'], H, 5 * S)}) t"))
def ad_clicks_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks per province (region of the customer) per 1 h window sliding by 5 s."""
    return jobs.ad_count_by_province(td.ad_clicks(spark, sf_dir))


CAP_RANKED = (f"SELECT user_id, event_type, seq, ts_us, row_number() OVER (PARTITION BY user_id, event_type, "
              f"ts_us // {D} ORDER BY ts_us, seq) AS rn FROM ({O.EVENTS}) e")


def _cap_events(spark, sf_dir):
    return td.events(spark, sf_dir).select("user_id", "event_type", "seq", "ts_us")


@register("click_cap_pass", f"SELECT user_id, event_type, seq, ts_us FROM ({CAP_RANKED}) t WHERE rn <= 2")
def click_cap_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 D1r S5 (main output): per (user, event type, UTC day) the first 2 rows pass
    (the reference caps (user, ad) at 100; no key of the test data reaches it)."""
    return (jobs.blacklist_filter(_cap_events(spark, sf_dir), ("user_id", "event_type"), 2, "day")
            .filter(F.col("output") == "pass").select("user_id", "event_type", "seq", "ts_us"))


@register("click_cap_warn", (
    f"SELECT user_id, event_type, seq, ts_us, 'Click over 2 times today.' AS msg FROM ({CAP_RANKED}) t WHERE rn = 3"))
def click_cap_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 S5 (side output): one warning per key and day, at the first row over the cap."""
    return (jobs.blacklist_filter(_cap_events(spark, sf_dir), ("user_id", "event_type"), 2, "day")
            .filter(F.col("output") == "warn").select("user_id", "event_type", "seq", "ts_us", "msg"))


@register("click_cap_by_region", (
    f"SELECT window_end, {_fmt('window_end')} AS window_end_str, province, cnt FROM ("
    + O.sliding(f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts_us // {D} "
                f"ORDER BY ts_us, seq) AS rn FROM ({O.AD_CLICKS}) a) b WHERE rn <= 1", ["province"], H, 5 * S)
    + ") t"))
def click_cap_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1g: clicks that pass a cap of 1 per user and UTC day, counted per province per
    1 h window sliding by 5 s."""
    return jobs.capped_ad_count_by_province(td.ad_clicks(spark, sf_dir), ("user_id",), 1, "day")


MKT = f"SELECT * FROM ({O.MARKETING}) m WHERE behavior IS DISTINCT FROM 'UNINSTALL'"


@register("marketing_by_channel", (
    f"SELECT window_start, window_end, {_fmt('window_start')} AS window_start_str, "
    f"{_fmt('window_end')} AS window_end_str, channel, behavior, cnt "
    f"FROM ({O.sliding(MKT, ['channel', 'behavior'], H, MIN)}) t"))
def marketing_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per (channel, behaviour), 1 h window sliding by 1 min
    (the reference slides by 1 s)."""
    return jobs.marketing_by_channel(td.marketing_events(spark, sf_dir), "1 hour", "1 minute")


@register("marketing_total", (
    f"SELECT window_start, window_end, {_fmt('window_start')} AS window_start_str, "
    f"{_fmt('window_end')} AS window_end_str, 'total' AS channel, 'total' AS behavior, cnt "
    f"FROM ({O.sliding(MKT, [], H, MIN)}) t"))
def marketing_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grand total per 1 h window sliding by 1 min."""
    return jobs.marketing_total(td.marketing_events(spark, sf_dir), "1 hour", "1 minute")


def _by_hour(counts: str, keys: str) -> str:
    return (f"SELECT {keys}, window_end // {H // 1000} AS hour, count(*) AS windows, CAST(sum(cnt) AS BIGINT) AS total, "
            f"max(cnt) AS most, CAST(sum(cnt * (window_end // 1000 % 9973)) AS BIGINT) AS mark FROM ({counts}) t GROUP BY ALL")


def _hourly(df: DataFrame) -> DataFrame:
    return df.groupBy("channel", "behavior", F.expr(f"window_end div {H // 1000}").alias("hour")).agg(
        F.count("*").alias("windows"), F.sum("cnt").alias("total"), F.max("cnt").alias("most"),
        F.sum(F.expr("cnt * (window_end div 1000 % 9973)")).alias("mark"))


@register("marketing_by_channel_1s", _by_hour(O.sliding(MKT, ["channel", "behavior"], H, S), "channel, behavior"))
def marketing_by_channel_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 T4 A4 with the reference's slide, 1 h windows each second: every window is made,
    and those of an hour are reported together (how many, sum, largest, a checksum)."""
    return _hourly(jobs.marketing_by_channel(td.marketing_events(spark, sf_dir)))


@register("marketing_total_1s", _by_hour("SELECT 'total' AS channel, 'total' AS behavior, window_end, cnt FROM ("
                                         + O.sliding(MKT, [], H, S) + ") s", "channel, behavior"))
def marketing_total_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 T4 A5 with the reference's slide, reported as ``marketing_by_channel_1s``."""
    return _hourly(jobs.marketing_total(td.marketing_events(spark, sf_dir)))


# ------------------------------------------------------------------ csv records
@register("csv_records", (
    f"SELECT user_id, 'ip' || k AS ip, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type, "
    f"ts_us // 1000000 * 1000000 AS ts_us FROM ({O.EVENTS}) e"))
def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Login records as comma-separated text with blanks, split, trimmed, cast;
    seconds to microseconds."""
    from ..sources.records import decode_records
    e = td.events(spark, sf_dir)
    value = F.concat_ws(" , ", F.col("user_id").cast("string"), F.concat(F.lit("ip"), F.col("k").cast("string")),
                        F.when(F.col("event_type") == "error", "fail").otherwise("success"),
                        F.expr("ts_us div 1000000").cast("string"))
    return decode_records(e.select(value.alias("value")), "login").select("user_id", "ip", "event_type", "ts_us")


# ------------------------------------------------------------------ login
@register("login_fail_strict", (
    f"SELECT user_id, ts_us AS first_us, nts AS last_us, 'login fail!' AS msg FROM ("
    f"SELECT *, lead(event_type) OVER w AS nt, lead(ts_us) OVER w AS nts FROM ({O.LOGIN}) l "
    f"WINDOW w AS (PARTITION BY user_id ORDER BY ts_us, seq)) t "
    f"WHERE event_type = 'fail' AND nt = 'fail' AND nts - ts_us < {H}"))
def login_fail_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fail immediately followed by fail of the same user within 1 h (event time;
    the reference's 2 s finds nothing in the test data)."""
    return jobs.login_fail_cep(td.login_events(spark, sf_dir), "1 hour")


@register("login_fail_arrival", (
    f"SELECT user_id, pts AS first_us, ts_us AS last_us, 'login fail in 2 seconds.' AS msg FROM ("
    f"SELECT *, lag(event_type) OVER w AS pt, lag(ts_us) OVER w AS pts FROM ({O.LOGIN}) l "
    f"WINDOW w AS (PARTITION BY user_id ORDER BY seq)) t "
    f"WHERE event_type = 'fail' AND pt = 'fail' AND ts_us < pts + {H}"))
def login_fail_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous login of the user in arrival order was a fail less than 1 h earlier."""
    return jobs.login_fail_state(td.login_events(spark, sf_dir), "1 hour")


# ------------------------------------------------------------------ orders
@register("order_pay_timeout", (
    f"SELECT order_id, ts_us AS start_us, CASE WHEN np - ts_us < {D} THEN np END AS end_us, "
    f"CASE WHEN np - ts_us < {D} THEN 'matched' ELSE 'timeout' END AS output, "
    f"CASE WHEN np - ts_us < {D} THEN 'payed successfully' ELSE 'timeout' END AS msg FROM ("
    f"SELECT *, min(CASE WHEN event_type = 'pay' THEN ts_us END) OVER (PARTITION BY order_id "
    f"ORDER BY ts_us, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS np FROM ({O.ORDERS}) o) t "
    f"WHERE event_type = 'create'"))
def order_pay_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each create (signup) with the first later pay (purchase) of the user
    within 1 day -> matched, else timeout (the reference waits 15 min)."""
    return jobs.order_timeout_cep(td.order_events(spark, sf_dir), "1 day")


@register("order_pay_outcomes", (
    f"SELECT order_id, day, c AS create_us, p AS pay_us, "
    f"CASE WHEN c IS NOT NULL AND p IS NOT NULL AND p < c + {4 * H} THEN 'payed' ELSE 'timeout' END AS output, "
    f"CASE WHEN c IS NOT NULL AND p IS NOT NULL AND p < c + {4 * H} THEN 'payed successfully' "
    f"WHEN c IS NOT NULL AND p IS NOT NULL THEN 'payed but already timeout' "
    f"WHEN c IS NOT NULL THEN 'order timeout' ELSE 'already payed but not found create log' END AS msg FROM ("
    f"SELECT order_id, ts_us // {D} AS day, min(CASE WHEN event_type = 'create' THEN ts_us END) AS c, "
    f"min(CASE WHEN event_type = 'pay' THEN ts_us END) AS p FROM ({O.ORDERS}) o "
    f"WHERE event_type IN ('create', 'pay') GROUP BY ALL) t"))
def order_pay_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (user, UTC day) the first create and first pay -> one of four outcomes
    (deadline 4 h; the reference's 15 min)."""
    o = td.order_events(spark, sf_dir, where=F.col("event_type").isin("signup", "purchase"))
    o = o.withColumn("day", F.expr(f"ts_us div {D}L"))
    return jobs.order_timeout_state(o, ("order_id", "day"), "4 hours")


# ------------------------------------------------------------------ tx
PAYS = f"SELECT user_id AS key, event_id AS pay_id, ts_us AS pay_us FROM ({O.EVENTS}) e WHERE event_type = 'purchase'"
RECEIPTS = (f"SELECT user_id AS key, event_id AS receipt_id, (['wechat','alipay'])[k % 2 + 1] AS pay_channel, "
            f"ts_us AS receipt_us FROM ({O.EVENTS}) e WHERE event_type = 'click'")


def _pays(spark, sf_dir):
    return td.pay_events(spark, sf_dir).withColumnRenamed("ts_us", "pay_us")


def _receipts(spark, sf_dir):
    return td.receipt_events(spark, sf_dir).withColumnRenamed("ts_us", "receipt_us")


@register("tx_interval_join", (
    f"SELECT p.key, pay_id, pay_us, receipt_id, pay_channel, receipt_us FROM ({PAYS}) p JOIN ({RECEIPTS}) r "
    f"ON p.key = r.key AND r.receipt_us BETWEEN p.pay_us - {H} AND p.pay_us + {H}"))
def tx_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases x clicks of the same user with click time within purchase time
    +-1 h, both bounds inclusive (the reference: +-5 s on the transaction id)."""
    return jobs.tx_match_by_join(_pays(spark, sf_dir), _receipts(spark, sf_dir), "key", "-1 hour", "1 hour")


@register("tx_reconcile", (
    f"SELECT coalesce(p.key, r.key) AS key, pay_id, pay_us, receipt_id, pay_channel, receipt_us, "
    f"CASE WHEN p.key IS NOT NULL AND r.key IS NOT NULL THEN 'matched' WHEN p.key IS NOT NULL "
    f"THEN 'unmatched_pay' ELSE 'unmatched_receipt' END AS output FROM ({PAYS}) p FULL OUTER JOIN ({RECEIPTS}) r "
    f"ON p.key = r.key AND r.receipt_us BETWEEN p.pay_us - {H} AND p.pay_us + {H}"))
def tx_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched pairs plus unmatched purchases and clicks, tagged."""
    return jobs.tx_match(_pays(spark, sf_dir), _receipts(spark, sf_dir), "key", "-1 hour", "1 hour")


_TX = f"SELECT 'tx' || event_id AS tx_id, event_id AS order_id, ts_us AS pay_us FROM ({O.EVENTS}) e WHERE event_type = 'purchase'"
_TXR = (f"SELECT 'tx' || event_id AS tx_id, (['wechat','alipay'])[k % 2 + 1] AS pay_channel, "
        f"ts_us + (event_id % 13 - 6) * {S} AS receipt_us FROM ({O.EVENTS}) e WHERE event_type = 'purchase' AND event_id % 5 <> 0 "
        f"UNION ALL SELECT 'rx' || event_id, (['wechat','alipay'])[k % 2 + 1], ts_us FROM ({O.EVENTS}) e WHERE event_type = 'signup'")


@register("tx_reconcile_unique", (
    f"SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, order_id, pay_us, pay_channel, receipt_us, CASE WHEN p.tx_id IS NOT NULL "
    f"AND r.tx_id IS NOT NULL THEN 'matched' WHEN p.tx_id IS NOT NULL THEN 'unmatched_pay' ELSE 'unmatched_receipt' END AS output "
    f"FROM ({_TX}) p FULL OUTER JOIN ({_TXR}) r ON p.tx_id = r.tx_id AND r.receipt_us BETWEEN p.pay_us - {5 * S} AND p.pay_us + {5 * S}"))
def tx_reconcile_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 J2 with the reference's own shape: orders whose transaction id is present, one
    receipt an id at most, +-5 s; pairing is one to one."""
    from ..functions.text import tx_present
    orders = td.order_events(spark, sf_dir)
    pays = orders.filter(tx_present("tx_id")).select("tx_id", F.col("seq").alias("order_id"), F.col("ts_us").alias("pay_us"))
    return jobs.tx_match(pays, td.unique_receipts(spark, sf_dir))


# streaming twins register themselves into the same tables
from . import stream_queries  # noqa: E402,F401
