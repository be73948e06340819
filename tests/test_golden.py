"""Golden results on the reference's bundled CSV inputs (values computed from the
"""

from pyspark.sql import functions as F

import fixtures as FX
from helpers import rows
from streamlytics.plans import jobs
from streamlytics.sources.records import records_from_lines


def test_login_fail_strict_event_time(spark):
    logins = records_from_lines(spark, FX.LOGIN_LOG, "login")
    out = jobs.login_fail_cep(logins)
    assert rows(out) == [(1035, 1558430842_000000, 1558430843_000000, "login fail!")]


def test_login_fail_arrival_order(spark):
    # user 1035: fail 842, success 844, fail 843 in arrival order -> the success clears
    logins = records_from_lines(spark, FX.LOGIN_LOG, "login")
    assert jobs.login_fail_state(logins).count() == 0


def test_order_timeout_cep(spark):
    orders = records_from_lines(spark, FX.ORDER_LOG, "order")
    out = jobs.order_timeout_cep(orders)
    assert out.filter("output = 'matched'").count() == 36
    assert out.filter("msg = 'payed successfully'").count() == 36
    assert {r[0] for r in rows(out.filter("output = 'timeout'"), "order_id")} == {34730, 34756, 34767}


def test_order_timeout_state_four_outcomes(spark):
    orders = records_from_lines(spark, FX.ORDER_LOG, "order")
    out = jobs.order_timeout_state(orders)
    by = {}
    for oid, msg in rows(out, "order_id", "msg"):
        by.setdefault(msg, set()).add(oid)
    assert len(by["payed successfully"]) == 36
    assert by["payed but already timeout"] == {34756, 34767}
    assert by["order timeout"] == {34730}
    assert by["already payed but not found create log"] == {34768}


def _tx_inputs(spark):
    orders = records_from_lines(spark, FX.ORDER_LOG, "order")
    pays = (orders.filter(F.col("tx_id").isNotNull() & (F.col("tx_id") != ""))
            .select("tx_id", "order_id", "event_type", F.col("ts_us").alias("pay_us")))
    receipts = records_from_lines(spark, FX.RECEIPT_LOG, "receipt").select(
        "tx_id", "pay_channel", F.col("ts_us").alias("receipt_us"))
    return pays, receipts


def test_tx_interval_join(spark):
    pays, receipts = _tx_inputs(spark)
    out = jobs.tx_match_by_join(pays, receipts)
    assert sorted(r[0] for r in rows(out, "tx_id")) == sorted(
        ["sd76f87d6", "3hu3k2432", "435kjb45d", "329d09f9f", "3243hr9h9"])


def test_tx_reconcile(spark):
    pays, receipts = _tx_inputs(spark)
    out = jobs.tx_match(pays, receipts)
    counts = dict(rows(out.groupBy("output").count()))
    assert counts == {"matched": 5, "unmatched_pay": 35, "unmatched_receipt": 35}
    # matched rows are exactly the interval join
    assert rows(out.filter("output = 'matched'").drop("output")) == rows(jobs.tx_match_by_join(pays, receipts))


def test_click_cap(spark):
    clicks = records_from_lines(spark, FX.AD_CLICK_LOG, "ad_click")
    out = jobs.blacklist_filter(clicks)
    assert out.filter("output = 'pass'").count() == 122
    warn = rows(out.filter("output = 'warn'"), "user_id", "ad_id", "event_time", "msg")
    assert warn == [(937166, 1715, 1511661701, "Click over 100 times today.")]


def test_ad_count_by_province_sliding(spark):
    clicks = records_from_lines(spark, FX.AD_CLICK_LOG, "ad_click")
    out = jobs.ad_count_by_province(clicks)
    assert out.count() == 6706
    assert out.agg(F.sum("cnt")).first()[0] == 143 * 720
    at = dict(rows(out.filter(F.col("window_end") == 1511661720_000), "province", "cnt"))
    assert at == {"beijing": 122, "guangdong": 4, "hebei": 1, "henan": 1, "jiangsu": 4,
                  "shanghai": 2, "zhejiang": 5}
    s = out.filter(F.col("window_end") == 1511661720_000).select("window_end_str").first()[0]
    assert s == "2017/11/26-02:02:00"


def test_capped_ad_count(spark):
    clicks = records_from_lines(spark, FX.AD_CLICK_LOG, "ad_click")
    out = jobs.capped_ad_count_by_province(clicks)
    assert out.count() == 6703
    assert out.agg(F.sum("cnt")).first()[0] == 122 * 720
    at = dict(rows(out.filter(F.col("window_end") == 1511661720_000), "province", "cnt"))
    assert at["beijing"] == 101


def test_ad_count_without_outliers(spark):
    clicks = records_from_lines(spark, FX.AD_CLICK_LOG, "ad_click").filter(F.col("event_time") < 1_600_000_000)
    out = jobs.ad_count_by_province(clicks)
    assert out.count() == 5976
    assert out.agg(F.sum("cnt")).first()[0] == 141 * 720


def test_ranking_text_blocks(spark):
    # two items in the window ending 1511661720 s; the rendering follows the reference's text
    ranked = spark.createDataFrame([(1511661720_000, 1, 1715, 121), (1511661720_000, 2, 36156, 2)],
                                   "window_end BIGINT, rank BIGINT, item_id BIGINT, cnt BIGINT")
    (txt,) = jobs.hot_items_report(ranked).select("report").first()
    assert txt == ("时间：2017-11-26 02:02:00.0\nNo1: 商品ID=1715 浏览量=121\nNo2: 商品ID=36156 浏览量=2\n"
                   "================================")
    urls = ranked.withColumnRenamed("item_id", "url").withColumn("url", F.concat(F.lit("/p/"), F.col("url")))
    (txt,) = jobs.hot_urls_report(urls).select("report").first()
    assert txt == ("=================================\n时间：2017-11-26 02:02:00.0\nNO1: URL=/p/1715 流量=121\n"
                   "NO2: URL=/p/36156 流量=2\n=============================\n\n")
