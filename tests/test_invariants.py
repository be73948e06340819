
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from streamlytics.operators import detect, distinct
from streamlytics.operators.windows import sliding_count
from streamlytics.sources import testdata as td


def test_running_uv_ends_at_exact_uv(spark):
    views = td.user_behavior(spark, SF_SMALL).filter("behavior = 'pv'")
    run = distinct.running_unique_visitors(views, size="1 hour", bucket_width="7 minutes")
    last = (run.withColumn("_r", F.row_number().over(W.partitionBy("window_end").orderBy(F.col("seq").desc())))
            .filter("_r = 1").select("window_end", "uv"))
    exact = distinct.unique_visitors(views, size="1 hour").select("window_end", "uv")
    assert rows(last) == rows(exact)
    # one output row per input row
    assert run.count() == views.count()


def test_click_cap_pass_plus_dropped_is_input(spark):
    e = td.events(spark, SF_SMALL).select("user_id", "event_type", "seq", "ts_us")
    out = detect.click_cap(e, ("user_id", "event_type"), cap=2, reset="day")
    passed = out.filter("output = 'pass'").count()
    per_key = (e.groupBy("user_id", "event_type", F.expr("ts_us div 86400000000").alias("d")).count()
               .select(F.sum(F.least(F.col("count"), F.lit(2))).alias("p"),
                       F.sum(F.when(F.col("count") > 2, 1).otherwise(0)).alias("w")).first())
    assert passed == per_key["p"]
    assert out.filter("output = 'warn'").count() == per_key["w"]
    dropped = e.count() - passed
    assert passed + dropped == e.count() and dropped >= per_key["w"]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(size_s=st.integers(1, 40), slide_s=st.integers(1, 40),
       ts=st.lists(st.integers(-50, 200), min_size=1, max_size=30))
def test_sliding_count_brute_force(spark, size_s, slide_s, ts):
    df = spark.createDataFrame([(i % 3, t * 1_000_000) for i, t in enumerate(ts)], "k BIGINT, ts_us BIGINT")
    got = {(k, s, e): c for k, s, e, c in rows(sliding_count(df, "k", "ts_us", size_s * 1_000_000, slide_s * 1_000_000))}
    want = {}
    for i, t in enumerate(ts):
        first = -(-(t - size_s + 1) // slide_s) * slide_s     # smallest start > t - size, multiple of slide
        s = first
        while s <= t:
            key = (i % 3, s * 1000, (s + size_s) * 1000)
            want[key] = want.get(key, 0) + 1
            s += slide_s
    assert got == want


def test_hll_sliding_windows_match_exact_at_small_cardinality(spark):
    # sketches are exact while a window holds few distinct users; the sliding form
    # unions pane sketches, so this checks the pane fan-out of sketches
    views = td.user_behavior(spark, SF_SMALL).filter("behavior = 'pv'")
    approx = distinct.approx_unique_visitors(views, "user_id", "ts_us", "1 hour", "10 minutes")
    exploded = views.select("user_id", F.timestamp_micros("ts_us").alias("ts"))
    exact = (exploded.groupBy(F.window("ts", "1 hour", "10 minutes").alias("w"))
             .agg(F.countDistinct("user_id").alias("uv"))
             .select((F.unix_micros("w.end") / 1000).cast("bigint").alias("window_end"), "uv"))
    assert rows(approx, "window_end", "uv") == rows(exact)
