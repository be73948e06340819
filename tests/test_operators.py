"""Operator properties: the skew-safe forms equal the direct forms."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helpers import rows
from streamlytics.functions.hashing import poly_hash_mask
from streamlytics.operators import joins
from streamlytics.operators.sequence import running_sum, seq_bucket, time_bucket, with_neighbor
from streamlytics.operators.windows import sliding_count, window_agg


def _random_events(spark, n=3000, keys=5, hot_share=0.4, span_s=20000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        k = 0 if rnd.random() < hot_share else rnd.randrange(1, keys)
        ts = rnd.randrange(0, span_s) * 1_000_000 + rnd.choice([0, 0, 500_000])
        et = rnd.choice(["a", "b", "b", "c"])
        data.append((k, ts, i, et))
    return spark.createDataFrame(data, "key BIGINT, ts_us BIGINT, seq BIGINT, et STRING")


@pytest.mark.parametrize("width", ["7 seconds", "10 minutes", "3 hours"])
@pytest.mark.parametrize("direction", ["next", "prev"])
@pytest.mark.parametrize("only_b", [False, True])
def test_with_neighbor_equals_window(spark, width, direction, only_b):
    df = _random_events(spark)
    where = (F.col("et") == "b") if only_b else None
    got = with_neighbor(df, ["key"], ["ts_us", "seq"], time_bucket("ts_us", width), ["seq", "ts_us"],
                        direction, where)
    cand = F.when(F.col("et") == "b", F.struct("ts_us", "seq")) if only_b else F.struct("ts_us", "seq")
    if direction == "next":
        w = W.partitionBy("key").orderBy("ts_us", "seq").rowsBetween(1, W.unboundedFollowing)
        ref = df.withColumn("_n", F.min(cand).over(w))
    else:
        w = W.partitionBy("key").orderBy("ts_us", "seq").rowsBetween(W.unboundedPreceding, -1)
        ref = df.withColumn("_n", F.max(cand).over(w))
    ref = ref.select("seq", F.col("_n.seq").alias("n_seq"))
    assert rows(got, "seq", f"{direction}_seq") == rows(ref)


def test_with_neighbor_seq_bucket(spark):
    df = _random_events(spark)
    got = with_neighbor(df, ["key"], ["seq"], seq_bucket("seq", 37), ["seq"], "prev")
    ref = df.withColumn("p", F.lag("seq").over(W.partitionBy("key").orderBy("seq")))
    assert rows(got, "seq", "prev_seq") == rows(ref, "seq", "p")


@pytest.mark.parametrize("width", ["13 seconds", "2 hours"])
def test_running_sum_equals_window(spark, width):
    df = _random_events(spark).withColumn("v", (F.col("seq") % 3).cast("bigint"))
    got = running_sum(df, ["key"], ["ts_us", "seq"], time_bucket("ts_us", width), "v", "run")
    ref = df.withColumn("run", F.sum("v").over(
        W.partitionBy("key").orderBy("ts_us", "seq").rowsBetween(W.unboundedPreceding, 0)))
    assert rows(got, "seq", "run") == rows(ref, "seq", "run")


@pytest.mark.parametrize("size,slide", [("1 hour", "5 minutes"), ("10 minutes", "150 seconds"),
                                        ("1 hour", "1 hour"), ("50 seconds", "20 seconds")])
def test_panes_equal_builtin_window(spark, size, slide):
    df = _random_events(spark).withColumn("ts", F.timestamp_micros("ts_us"))
    got = sliding_count(df, "key", "ts_us", size, slide)
    ref = (df.groupBy("key", F.window("ts", size, slide).alias("w")).count()
           .select("key", (F.unix_micros("w.start") / 1000).cast("bigint").alias("window_start"),
                   (F.unix_micros("w.end") / 1000).cast("bigint").alias("window_end"),
                   F.col("count").alias("cnt")))
    assert rows(got) == rows(ref)


def test_sliding_sum_invariant(spark):
    df = _random_events(spark, n=500)
    out = sliding_count(df, None, "ts_us", "1 hour", "5 minutes")
    assert out.agg(F.sum("cnt")).first()[0] == 500 * 12


def test_window_agg_max_merge(spark):
    df = _random_events(spark, n=800)
    got = window_agg(df, "key", "ts_us", "30 minutes", "10 minutes", {"m": F.max("seq")}, {"m": "max"})
    df2 = df.withColumn("ts", F.timestamp_micros("ts_us"))
    ref = (df2.groupBy("key", F.window("ts", "30 minutes", "10 minutes").alias("w")).agg(F.max("seq").alias("m"))
           .select("key", (F.unix_micros("w.end") / 1000).cast("bigint").alias("window_end"), "m"))
    assert rows(got, "key", "window_end", "m") == rows(ref)


def _py_hash(s, seed=61, size=1 << 29):
    r = 0
    for ch in s:
        r = (r * seed + ord(ch)) & 0xFFFFFFFF
        if r >= 1 << 31:
            r -= 1 << 32
    return (size - 1) & r


def test_poly_hash_matches_int32_semantics(spark):
    vals = ["", "0", "7", "543462", "937166", "123456789012345", "abcXYZ", "hello world"]
    df = spark.createDataFrame([(v,) for v in vals], "s STRING")
    got = dict(rows(df.select("s", poly_hash_mask("s").alias("h"))))
    assert got == {v: _py_hash(v) for v in vals}


def test_interval_join_equals_naive(spark):
    rnd = random.Random(3)
    left = spark.createDataFrame([(rnd.randrange(3), i, rnd.randrange(0, 200) * 1_000_000) for i in range(300)],
                                 "k BIGINT, lid BIGINT, l_us BIGINT")
    right = spark.createDataFrame([(rnd.randrange(3), i, rnd.randrange(0, 200) * 1_000_000) for i in range(300)],
                                  "k BIGINT, rid BIGINT, r_us BIGINT")
    got = joins.interval_join(left, right, "k", "-5 seconds", "3 seconds", "l_us", "r_us")
    l, r = left.alias("l"), right.alias("r")
    ref = l.join(r, (F.col("l.k") == F.col("r.k")) & (F.col("r.r_us") >= F.col("l.l_us") - 5_000_000)
                 & (F.col("r.r_us") <= F.col("l.l_us") + 3_000_000)).select("lid", "rid")
    assert rows(got, "lid", "rid") == rows(ref)
    rec = joins.reconcile(left, right, "k", "-5 seconds", "3 seconds", "l_us", "r_us")
    matched_l = {r[0] for r in rows(ref, "lid")}
    matched_r = {r[0] for r in rows(ref.select("rid"))}
    assert {r[0] for r in rows(rec.filter("output = 'unmatched_pay'"), "lid")} == set(range(300)) - matched_l
    assert {r[0] for r in rows(rec.filter("output = 'unmatched_receipt'"), "rid")} == set(range(300)) - matched_r


def test_click_cap_large_cap_path_equals_row_number(spark):
    from streamlytics.operators.detect import click_cap
    df = _random_events(spark, n=2500, keys=4, hot_share=0.6).withColumnRenamed("key", "user_id")
    small = click_cap(df, ("user_id",), cap=300, reset="never")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        big = click_cap(df, ("user_id",), cap=300, reset="never", bucket_width="17 minutes")
        assert rows(big, "seq", "output") == rows(small, "seq", "output")
        assert big.filter("output = 'warn'").count() == 4
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


@pytest.mark.parametrize("direction", ["next", "prev"])
@pytest.mark.parametrize("only_b", [False, True])
def test_adjacent_neighbor_equals_general_within_one_bucket(spark, direction, only_b):
    df = _random_events(spark)
    where = (F.col("et") == "b") if only_b else None
    width = 600_000_000
    args = (["key"], ["ts_us", "seq"], time_bucket("ts_us", width), ["seq", "ts_us"], direction, where)
    full = with_neighbor(df, *args)
    adj = with_neighbor(df, *args, reach=F.lit(True))
    gap = (F.col(f"{direction}_ts_us") - F.col("ts_us")) if direction == "next" else (F.col("ts_us") - F.col(f"{direction}_ts_us"))
    near = lambda d: d.filter(gap < width).select("seq", f"{direction}_seq")
    assert rows(near(adj)) == rows(near(full))


def test_choose_width_narrows_for_a_burst(spark):
    from streamlytics.operators.sequence import choose_width
    # key 0 has a burst of 2000 rows within one minute; everything else is sparse
    data = [(0, 1_000_000_000 + i * 30_000, i) for i in range(2000)] + \
           [(k, k * 7_000_000_000, 10_000 + k) for k in range(1, 50)]
    df = spark.createDataFrame(data, "key BIGINT, ts_us BIGINT, seq BIGINT")
    w = choose_width(df, ["key"], "ts_us", "1 hour", target_rows=300)
    assert w < 3_600_000_000
    biggest = df.groupBy("key", time_bucket("ts_us", w).alias("b")).count().agg(F.max("count")).first()[0]
    assert biggest <= 300
    # and the bucketed operators stay exact with that width
    got = with_neighbor(df, ["key"], ["ts_us", "seq"], time_bucket("ts_us", w), ["seq"], "next")
    ref = df.withColumn("n", F.lead("seq").over(W.partitionBy("key").orderBy("ts_us", "seq")))
    assert rows(got, "seq", "next_seq") == rows(ref, "seq", "n")


@pytest.mark.parametrize("direction", ["next", "prev"])
def test_with_neighbor_single_order_column_hash_path(spark, direction):
    df = _random_events(spark).withColumn("flag", F.col("et") == "b")
    got = with_neighbor(df, ["key"], ["seq"], seq_bucket("seq", 53), ["flag", "ts_us"], direction)
    fn = F.lead if direction == "next" else F.lag
    w = W.partitionBy("key").orderBy("seq")
    ref = df.select("seq", fn("flag").over(w).alias("f"), fn("ts_us").over(w).alias("t"))
    assert rows(got, "seq", f"{direction}_flag", f"{direction}_ts_us") == rows(ref)


def test_pack_order_roundtrip_and_order(spark):
    from streamlytics.operators.sequence import pack_order, unpack_order
    vals = [(-(1 << 57), -(1 << 63)), (-1, 5), (0, 0), (0, (1 << 63) - 1), (1, -(1 << 63)),
            (1706658900_000000, 12), (1706658900_000000, 13), ((1 << 57), 7)]
    df = spark.createDataFrame(vals, "t BIGINT, q BIGINT").withColumn("p", pack_order("t", "q"))
    t, q = unpack_order("p")
    got = [tuple(r) for r in df.orderBy("p").select(t, q).collect()]
    assert got == sorted(vals)


def test_bounded_broadcast_checks_the_size(spark):
    from streamlytics.operators.dims import bounded_broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(0, 1000).withColumnRenamed("id", "k")
        dim = spark.range(0, 30).withColumnRenamed("id", "k")
        small_plan = big.join(bounded_broadcast(dim, max_rows=100), "k")._jdf.queryExecution().executedPlan().toString()
        large_plan = big.join(bounded_broadcast(dim, max_rows=10), "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in small_plan
        assert "BroadcastHashJoin" not in large_plan and "SortMergeJoin" in large_plan
        wide = dim.selectExpr("k", "repeat('x', 1000) as pad", "array(1, 2) as a")
        plan = lambda most: big.join(bounded_broadcast(wide, max_bytes=most), "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(40_000) and "BroadcastHashJoin" not in plan(20_000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_are_a_key(spark):
    from streamlytics.operators.detect import click_cap, login_fail_arrival
    df = spark.createDataFrame([(None, i, i * 1000_000, "fail") for i in range(5)] + [(1, 9, 0, "fail")],
                               "user_id BIGINT, seq BIGINT, ts_us BIGINT, event_type STRING")
    for cap in (3, 100, 1000, 5000):
        out = click_cap(df, ("user_id",), cap=cap, reset="never")
        assert out.filter("output = 'pass'").count() == min(cap, 5) + 1
    hits = login_fail_arrival(df, within="2 seconds", bucket_width=2)     # neighbours across buckets
    assert rows(hits, "first_us", "last_us") == [(i * 1000_000, (i + 1) * 1000_000) for i in range(4)]


def test_running_sum_keeps_null_keys(spark):
    from streamlytics.operators.sequence import running_sum
    for kind, value in (("BIGINT", 7), ("STRING", "x"), ("DATE", None), ("DOUBLE", 1.5), ("TIMESTAMP", None), ("BOOLEAN", True)):
        df = spark.createDataFrame([(None, i, 1) for i in range(6)] + [(value, 9, 1)], f"k {kind}, t BIGINT, v BIGINT")
        got = running_sum(df, "k", ["t"], time_bucket("t", 2), "v", "s")
        assert rows(got.filter("k IS NULL AND t < 6"), "t", "s") == [(i, i + 1) for i in range(6)]


def test_arrival_order_over_files(spark, tmp_path):
    from streamlytics.operators.detect import login_fail_arrival
    from streamlytics.sources.records import read_records
    (tmp_path / "part-0001.csv").write_text("1,10.0.0.1,fail,100\n1,10.0.0.1,success,101\n")
    (tmp_path / "part-0002 +x.csv").write_text("1,10.0.0.1,fail,102\n" + "2,10.0.0.2,success,102\n" * 500)
    df = read_records(spark, str(tmp_path), "login")
    assert df.count() == 503 and df.select("seq").distinct().count() == 503
    assert [r.ts_us // 1000000 for r in df.filter("user_id = 1").orderBy("seq").collect()] == [100, 101, 102]
    assert login_fail_arrival(df).count() == 0


def test_times_do_not_move_with_the_session_zone(spark):
    from streamlytics.functions.time import epoch_us, format_window_time, parse_log_time
    from pyspark.sql.types import TimestampNTZType
    df = spark.createDataFrame([("17/05/2015:10:05:03",), ("08/03/2015:02:30:00",), ("01/01/1969:23:59:59",)], "s STRING")
    df = df.select(parse_log_time("s").alias("a"), epoch_us(F.expr("to_timestamp_ntz(s, 'dd/MM/yyyy:HH:mm:ss')"), TimestampNTZType()).alias("b"))
    df = df.withColumn("t", format_window_time(F.expr("a div 1000")))
    want = rows(df)
    assert (1431857103_000000, 1431857103_000000, "2015/05/17-10:05:03") in want and len(want) == 3
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("Asia/Shanghai", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert rows(df) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_top_n_beyond_the_group_limit(spark):
    """Many ranks: the same rows, and no window or part of one is sorted whole by a task."""
    from pyspark.sql import Window
    from streamlytics.operators import topn
    df = spark.range(60_000).selectExpr("id % 2 AS w", "id AS k", "(id * 7919) % 5000 AS cnt")
    got = topn.top_n_by_count(df, "k", 5000, "w")
    order = Window.partitionBy("w").orderBy(F.desc("cnt"), "k")
    want = df.withColumn("rank", F.row_number().over(order).cast("long")).filter("rank <= 5000").select("w", "rank", "k", "cnt")
    assert rows(got) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [row_number()") == 2 and "_part" in plan
    # what the last window sorts: PARTS times n rows at most, here all of PARTS parts of 1,875
    parts = df.groupBy("w", F.pmod(F.xxhash64("w", "k", "cnt"), F.lit(topn.PARTS)).alias("p")).count()
    assert parts.agg(F.max("count")).first()[0] < 30_000 / topn.PARTS * 1.2


def test_counts_of_full_bitmaps_and_sketches(spark):
    from streamlytics.operators.distinct import linear_count, linear_count_error
    df = spark.range(3000).selectExpr("id % 40 AS g", "pmod(xxhash64(id), 128) AS pos").groupBy("g").agg(F.countDistinct("pos").alias("x"))
    got = df.select("x", linear_count("x", 128).alias("n"), linear_count_error(F.lit(75), 128).alias("e")).collect()
    assert all(abs(r.n - 75) <= 4 * r.e + 1 and r.x < 75 for r in got)
    assert abs(sum(r.n for r in got) / 40 - 75) < 3 < 75 - sum(r.x for r in got) / 40
    assert spark.range(1).select(linear_count(F.lit(64), 64).alias("n")).first().n is None
