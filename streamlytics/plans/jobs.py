"""The reference's jobs as DataFrame compositions over record DataFrames (batch;
the streaming twins are in ``streamlytics.streaming.jobs``). Every job takes the
record DataFrame and parameters whose defaults are the reference's constants.
Time columns are epoch microseconds (``ts_us``); window bounds epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import poly_hash_mask
from ..functions.text import drop_static_resources
from ..functions.time import duration_us, format_window_time
from ..operators import detect, distinct, joins, patterns
from ..operators.topn import ITEM_REPORT, URL_REPORT, render_ranking, top_n_by_count
from ..operators.windows import integer_average, sliding_count, sliding_count_by_runs, tumbling_count


# -------------------------------------------------------------- hot items / urls
def hot_items(behavior: DataFrame, size="1 hour", slide="5 minutes", n: int = 3,
              behavior_value: str = "pv") -> DataFrame:
    """HotItems: page views -> count per item per sliding window -> top n per window end."""
    views = behavior.filter(F.col("behavior") == behavior_value)
    return top_n_by_count(sliding_count(views, "item_id", "ts_us", size, slide), "item_id", n)


def hot_items_report(ranked: DataFrame) -> DataFrame:
    return render_ranking(ranked, "item_id", ITEM_REPORT)


def hot_urls(log: DataFrame, size="10 minutes", slide="5 seconds", n: int = 5) -> DataFrame:
    """NetworkFlow: drop .css/.js, count per URL per sliding window, top n per window end."""
    pages = log.filter(drop_static_resources("url"))
    return top_n_by_count(sliding_count(pages, "url", "ts_us", size, slide), "url", n)


def hot_urls_report(ranked: DataFrame) -> DataFrame:
    return render_ranking(ranked, "url", URL_REPORT)


# -------------------------------------------------------------- page views / uv
def page_views(behavior: DataFrame, size="1 hour") -> DataFrame:
    """PageView: page views per tumbling hour."""
    views = behavior.filter(F.col("behavior") == "pv")
    return tumbling_count(views, None, "ts_us", size, "pv")


def unique_visitors(behavior: DataFrame, size="1 hour") -> DataFrame:
    """UniqueVisitor: exact distinct users per tumbling hour (un-keyed window)."""
    return distinct.unique_visitors(behavior.filter(F.col("behavior") == "pv"), "user_id", "ts_us", size)


def unique_visitors_running(behavior: DataFrame, size="1 hour", bucket_width="1 second") -> DataFrame:
    """UV with per-element firing: distinct users so far, one row per page view."""
    return distinct.running_unique_visitors(behavior.filter(F.col("behavior") == "pv"),
                                            "user_id", "ts_us", "seq", size, bucket_width)


def unique_visitors_bitmap(behavior: DataFrame, size="1 hour", seed: int = 61,
                           bits: int = 1 << 29) -> DataFrame:
    """UVWithBloomFilter: users hashed (seed 61) into a 2^29-bit bitmap per window;
    visitors = set bits (hash collisions undercount, as in the reference)."""
    views = behavior.filter(F.col("behavior") == "pv")
    pos = views.select("ts_us", poly_hash_mask(F.col("user_id").cast("string"), seed, bits).alias("_pos"))
    return distinct.bitmap_unique_visitors(pos, "_pos", "ts_us", size)


def unique_visitors_bitmap_running(behavior: DataFrame, size="1 hour", seed: int = 61,
                                   bits: int = 1 << 29, bucket_width="1 second") -> DataFrame:
    """UVWithBloomFilter as the reference emits it: one row per page view with the
    number of distinct hash bits set so far in its window (fires per element)."""
    views = behavior.filter(F.col("behavior") == "pv")
    hashed = views.withColumn("_pos", poly_hash_mask(F.col("user_id").cast("string"), seed, bits))
    return distinct.running_unique_visitors(hashed, "_pos", "ts_us", "seq", size, bucket_width)


def average_timestamp(behavior: DataFrame) -> DataFrame:
    """AverageAgg: integer mean of the epoch-second timestamps per user, as double, of all
    records (the accumulator has no filter of its own)."""
    secs = behavior.select("user_id", F.expr("ts_us div 1000000").alias("ts_s"))
    return integer_average(secs, "user_id", "ts_s", "avg_ts")


# -------------------------------------------------------------- ads / marketing
def _overlapping_count(df: DataFrame, keys, ts_col: str, size, slide) -> DataFrame:
    """Sliding counts: panes fanned out to few windows each, changes of the count for many."""
    many = duration_us(size) > 100 * duration_us(slide) and duration_us(size) % duration_us(slide) == 0
    return (sliding_count_by_runs if many else sliding_count)(df, keys, ts_col, size, slide)


def ad_count_by_province(clicks: DataFrame, size="1 hour", slide="5 seconds") -> DataFrame:
    """AdStatisticsByGeo: clicks per province per sliding window, end formatted."""
    c = _overlapping_count(clicks, "province", "ts_us", size, slide)
    return c.select("window_end", format_window_time("window_end").alias("window_end_str"), "province", "cnt")


def blacklist_filter(clicks: DataFrame, keys=("user_id", "ad_id"), cap: int = 100,
                     reset: str = "day") -> DataFrame:
    """BlackListWarning, first half: click cap with one warning per key (tagged rows)."""
    return detect.click_cap(clicks, keys, cap, reset)


def capped_ad_count_by_province(clicks: DataFrame, keys=("user_id", "ad_id"), cap: int = 100,
                                reset: str = "day", size="1 hour", slide="5 seconds") -> DataFrame:
    """BlackListWarning, main output: clicks that passed the cap -> counts per province."""
    passed = blacklist_filter(clicks, keys, cap, reset).filter(F.col("output") == "pass")
    return ad_count_by_province(passed, size, slide)


def marketing_by_channel(events: DataFrame, size="1 hour", slide="1 second",
                         drop_behavior: str = "UNINSTALL") -> DataFrame:
    """AppMarketingByChannel: counts per (channel, behaviour) per sliding window."""
    kept = events.filter(~F.col("behavior").eqNullSafe(drop_behavior))
    c = _overlapping_count(kept, ["channel", "behavior"], "ts_us", size, slide)
    return c.select("window_start", "window_end", format_window_time("window_start").alias("window_start_str"),
                    format_window_time("window_end").alias("window_end_str"), "channel", "behavior", "cnt")


def marketing_total(events: DataFrame, size="1 hour", slide="1 second",
                    drop_behavior: str = "UNINSTALL") -> DataFrame:
    """AppMarketingStatistics: grand total per sliding window, tagged total/total."""
    kept = events.filter(~F.col("behavior").eqNullSafe(drop_behavior))
    c = _overlapping_count(kept, None, "ts_us", size, slide)
    return c.select("window_start", "window_end", format_window_time("window_start").alias("window_start_str"),
                    format_window_time("window_end").alias("window_end_str"),
                    F.lit("total").alias("channel"), F.lit("total").alias("behavior"), "cnt")


# -------------------------------------------------------------- login / orders / tx
def login_fail_cep(logins: DataFrame, within="2 seconds", bucket_width=None) -> DataFrame:
    """LoginFailWithCEP: fail strictly followed by fail within 2 s (event-time order)."""
    return patterns.strict_pair(logins, "user_id", "event_type", "fail", "fail", within,
                                bucket_width=bucket_width)


def login_fail_state(logins: DataFrame, within="2 seconds", bucket_width: int = 1 << 20) -> DataFrame:
    """LoginFail: previous fail of the user (arrival order) within 2 s."""
    return detect.login_fail_arrival(logins, "user_id", "event_type", "fail", within,
                                     bucket_width=bucket_width)


def order_timeout_cep(orders: DataFrame, within="15 minutes", bucket_width=None) -> DataFrame:
    """OrderTimeout: create followed by pay within 15 min; else timeout (side output)."""
    return patterns.followed_by_within(orders, "order_id", "event_type", "create", "pay", within,
                                       bucket_width=bucket_width)


def order_timeout_state(orders: DataFrame, keys=("order_id",), within="15 minutes") -> DataFrame:
    """OrderTimeoutWithoutCEP: the four outcomes of create/pay matching."""
    return detect.order_pay_outcomes(orders, keys, "event_type", "create", "pay", within)


def tx_match_by_join(pays: DataFrame, receipts: DataFrame, on="tx_id", lower="-5 seconds",
                     upper="5 seconds") -> DataFrame:
    """TxMatchByJoin: pays x receipts, same key, receipt time within pay time -5 s..+5 s."""
    return joins.interval_join(pays, receipts, on, lower, upper, "pay_us", "receipt_us")


def tx_match(pays: DataFrame, receipts: DataFrame, on="tx_id", lower="-5 seconds",
             upper="5 seconds") -> DataFrame:
    """TxMatchDetect: matched pairs plus unmatched pays and receipts (tagged)."""
    return joins.reconcile(pays, receipts, on, lower, upper, "pay_us", "receipt_us")
