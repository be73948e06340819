"""Streaming behaviour that the batch oracles cannot see: late rows, outer-join
emission, update-mode early results, file sources and tagged sinks."""

import itertools
import os
import tempfile
import time

from pyspark.sql import functions as F

import fixtures as FX
from helpers import rows
from streamlytics.plans import jobs
from streamlytics.session import scratch_path
from streamlytics.sources.records import read_records, read_records_stream, records_from_lines
from streamlytics.streaming import jobs as SJ
from streamlytics.streaming.core import run_available_now, state_settings, with_event_time


def _write_csv(folder, name, lines):
    folder = folder[len("file:"):] if folder.startswith("file:") else folder
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    # a stream takes files in the order of their times
    at = time.time() - 10_000 + next(_WRITTEN)
    os.utime(os.path.join(folder, name), (at, at))


_WRITTEN = itertools.count()


def test_read_records_file_keeps_order(spark):
    d = tempfile.mkdtemp(dir=os.environ.get("TMPDIR", "/tmp"))
    _write_csv(d, "LoginLog.csv", FX.LOGIN_LOG.strip().splitlines())
    df = read_records(spark, d, "login")
    assert df.count() == 48
    assert df.orderBy("seq").select("user_id").first()[0] == 5402
    assert jobs.login_fail_cep(df).count() == 1 and jobs.login_fail_state(df).count() == 0


def test_decode_queue_values(spark):
    raw = spark.createDataFrame([(bytearray(b"543462,1715,beijing,beijing,1511658000"), 7)],
                                "value BINARY, offset BIGINT")
    from streamlytics.sources.records import decode_records
    out = decode_records(raw, "ad_click")
    assert rows(out, "offset", "user_id", "ad_id", "province", "ts_us") == [
        (7, 543462, 1715, "beijing", 1511658000_000000)]


def test_access_log_parse_file(spark):
    d = tempfile.mkdtemp(dir=os.environ.get("TMPDIR", "/tmp"))
    _write_csv(d, "apache.log", [
        "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash-monitorama-2013/images/kibana-search.png",
        "83.149.9.216 - - 17/05/2015:10:05:43 +0000 GET /presentations/logstash-monitorama-2013/plugin/zoom-js/zoom.js"])
    from streamlytics.sources.access_log import read_access_log
    df = read_access_log(spark, d)
    got = rows(df, "ip", "ts_us", "method")
    assert got[0] == ("83.149.9.216", 1431857103_000000, "GET")
    assert jobs.hot_urls(df).count() > 0   # .js line dropped, .png kept
    assert {r[0] for r in rows(jobs.hot_urls(df), "url")} == {
        "/presentations/logstash-monitorama-2013/images/kibana-search.png"}


def test_late_rows_dropped_by_stream_window(spark):
    src = scratch_path(spark, "late-src")
    lines = ["1,1,1,pv,1000", "2,1,1,pv,4000", "3,1,1,pv,8000"]
    _write_csv(src, "a.csv", lines)
    s = with_event_time(read_records_stream(spark, src, "user_behavior", max_files=1), "ts_us", "0 seconds")
    c = SJ.stream_window_count(s.filter("behavior = 'pv'"), None, "1 hour")
    out, ck = scratch_path(spark, "late-out"), scratch_path(spark, "late-ck")
    q = c.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).start()
    q.processAllAvailable()
    # watermark is now 8000 s: a row at 100 s (window [0, 3600)) is late and dropped,
    # a row at 9000 s is counted.
    _write_csv(src, "b.csv", ["4,1,1,pv,100", "5,1,1,pv,9000", "6,1,1,pv,20000"])
    q.processAllAvailable()
    q.stop()
    got = dict(rows(spark.read.parquet(out), "window_start", "cnt"))
    assert got[0] == 1          # 1000 s only; the late 100 s row is not counted
    assert got[3600_000] == 1   # 4000
    assert got[7200_000] == 2   # 8000, 9000
    assert 18000_000 not in got  # 20000 s: window still open at the end


def test_stream_reconcile_full_outer(spark):
    src_o, src_r = scratch_path(spark, "orders"), scratch_path(spark, "receipts")
    _write_csv(src_o, "o.csv", FX.ORDER_LOG.strip().splitlines())
    _write_csv(src_r, "r.csv", FX.RECEIPT_LOG.strip().splitlines())
    pays = (read_records_stream(spark, src_o, "order").filter("tx_id IS NOT NULL AND tx_id <> ''")
            .select("tx_id", "order_id", F.col("ts_us").alias("pay_us")))
    pays = with_event_time(pays, "pay_us", "0 seconds", "pay_ts")
    recs = read_records_stream(spark, src_r, "receipt").select("tx_id", "pay_channel", F.col("ts_us").alias("receipt_us"))
    recs = with_event_time(recs, "receipt_us", "0 seconds", "receipt_ts")
    j = SJ.stream_interval_join(pays, recs, "tx_id", "-5 seconds", "5 seconds", "pay_ts", "receipt_ts", "full_outer")
    got = run_available_now(j.drop("pay_ts", "receipt_ts"), "reconcile")
    by = {}
    for tag, tx in rows(got, "output", "tx_id"):
        by.setdefault(tag, set()).add(tx)
    assert by["matched"] == {"sd76f87d6", "3hu3k2432", "435kjb45d", "329d09f9f", "3243hr9h9"}
    # unmatched rows are emitted once the watermark passes them; all that are
    # emitted must be unmatched in the batch form too
    o = records_from_lines(spark, FX.ORDER_LOG, "order").filter("tx_id IS NOT NULL AND tx_id <> ''")
    r = records_from_lines(spark, FX.RECEIPT_LOG, "receipt")
    batch = jobs.tx_match(o.select("tx_id", "order_id", F.col("ts_us").alias("pay_us")),
                          r.select("tx_id", "pay_channel", F.col("ts_us").alias("receipt_us")))
    bu = {t: {x for (x,) in rows(batch.filter(F.col("output") == t), "tx_id")} for t in ("unmatched_pay", "unmatched_receipt")}
    assert by.get("unmatched_pay", set()) <= bu["unmatched_pay"]
    assert by.get("unmatched_receipt", set()) <= bu["unmatched_receipt"]
    # with the global watermark the minimum of both streams' maxima, every unmatched
    # row whose interval ended before it must have been flushed
    wm = min(o.agg(F.max("ts_us")).first()[0], r.agg(F.max("ts_us")).first()[0])
    due_pay = {x for (x, t) in rows(batch.filter("output = 'unmatched_pay'"), "tx_id", "pay_us") if t + 5_000_000 < wm}
    due_rec = {x for (x, t) in rows(batch.filter("output = 'unmatched_receipt'"), "tx_id", "receipt_us")
               if t + 5_000_000 < wm}
    assert due_pay <= by.get("unmatched_pay", set()) and len(due_pay) > 15
    assert due_rec <= by.get("unmatched_receipt", set()) and len(due_rec) > 15


def test_update_mode_early_results(spark):
    src = scratch_path(spark, "uv-src")
    _write_csv(src, "a.csv", ["1,1,1,pv,10", "2,1,1,pv,20", "1,1,1,pv,30"])
    s = with_event_time(read_records_stream(spark, src, "user_behavior"), "ts_us", "0 seconds")
    got = run_available_now(SJ.stream_approx_unique_visitors(s, "1 hour"), "uv-upd", mode="update")
    assert rows(got, "window_start", "uv") == [(0, 2)]


def test_side_outputs_written_once(spark):
    from streamlytics.operators.outputs import split, write_split
    clicks = records_from_lines(spark, FX.AD_CLICK_LOG, "ad_click")
    tagged = jobs.blacklist_filter(clicks)
    path = scratch_path(spark, "side")
    write_split(tagged.drop("msg").withColumn("msg", F.col("output")), path)
    back = spark.read.parquet(path)
    assert dict(rows(back.groupBy("output").count())) == {"pass": 122, "warn": 1}
    parts = split(tagged, tags=["pass", "warn"])
    assert parts["warn"].count() == 1


def test_click_cap_never_reset_and_day_reset(spark):
    lines = [f"1,9,p,c,{86400 * d + i}" for d in range(2) for i in range(3)]
    clicks = records_from_lines(spark, lines, "ad_click")
    day = jobs.blacklist_filter(clicks, cap=2, reset="day")
    never = jobs.blacklist_filter(clicks, cap=2, reset="never")
    assert day.filter("output = 'pass'").count() == 4 and day.filter("output = 'warn'").count() == 2
    assert never.filter("output = 'pass'").count() == 2 and never.filter("output = 'warn'").count() == 1


def _two_file_stream(spark, text, kind, split_at, name):
    src = scratch_path(spark, name)
    lines = text.strip().splitlines()
    _write_csv(src, "a.csv", lines[:split_at])
    _write_csv(src, "b.csv", lines[split_at:])
    s = read_records_stream(spark, src, kind, max_files=1)
    return s.withColumn("seq", F.col("ts_us"))   # tie-break only; order comes from event time


def test_stream_strict_pattern_uses_event_time_across_batches(spark):
    from streamlytics.streaming.state import stream_strict_pair
    # file 1 ends with user 1035's fail 842 and success 844; its fail 843 arrives in file 2
    s = with_event_time(_two_file_stream(spark, FX.LOGIN_LOG, "login", 8, "login2"), "ts_us", "5 seconds")
    got = run_available_now(stream_strict_pair(s), "strict2")
    assert rows(got) == [(1035, 1558430842_000000, 1558430843_000000, "login fail!")]


def test_stream_followed_by_with_timeouts(spark):
    from streamlytics.streaming.state import stream_followed_by_within
    s = with_event_time(_two_file_stream(spark, FX.ORDER_LOG, "order", 40, "orders2"), "ts_us", "0 seconds")
    got = run_available_now(stream_followed_by_within(s), "followed2")
    assert got.filter("output = 'matched'").count() == 36
    assert {r[0] for r in rows(got.filter("output = 'timeout'"), "order_id")} == {34730, 34756, 34767}


def test_stream_click_cap_state_across_batches(spark):
    from streamlytics.streaming.state import stream_click_cap
    # the hot (user, ad) key has 121 clicks; split so that its 100th click is in file 1.
    # The two rows stamped in year 2449 would push the watermark centuries ahead (and
    # are outside the pandas timestamp range): the guard bounds the watermark's column, and
    # the rows themselves are counted, as in the batch form.
    s = _two_file_stream(spark, FX.AD_CLICK_LOG, "ad_click", 110, "clicks2")
    s = with_event_time(s, "ts_us", "0 seconds", max_ts_us=1511700000_000000)   # the same day
    got = run_available_now(stream_click_cap(s, ("user_id", "ad_id"), cap=100, reset="day"), "cap2")
    assert got.filter("output = 'pass'").count() == 122 and "province" in got.columns
    assert rows(got.filter("output = 'warn'"), "user_id", "ad_id", "msg") == [
        (937166, 1715, "Click over 100 times today.")]


def test_stream_access_log_and_tagged_side_outputs(spark):
    from streamlytics.sources.access_log import read_access_log_stream
    from streamlytics.streaming.core import write_side_outputs
    src = scratch_path(spark, "weblog")
    _write_csv(src, "apache.log", [
        "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /a.png",
        "83.149.9.216 - - 17/05/2015:10:05:43 +0000 GET /b.js",
        "10.0.0.1 - - 17/05/2015:10:06:00 +0000 POST /c.html"])
    log = read_access_log_stream(spark, src)
    tagged = log.withColumn("output", F.when(F.col("url").rlike(r"\.(css|js)$"), "static").otherwise("page"))
    out, ck = scratch_path(spark, "tag-out"), scratch_path(spark, "tag-ck")
    q = write_side_outputs(tagged, out, ck, trigger={"availableNow": True})
    q.awaitTermination()
    back = spark.read.parquet(out)
    assert dict(rows(back.groupBy("output").count())) == {"page": 2, "static": 1}
    assert rows(back.filter("output = 'page'"), "ts_us") == [(1431857103_000000,), (1431857160_000000,)]


def test_click_cap_day_before_epoch(spark):
    # -1 s and +1 s are on different UTC days (1969-12-31 and 1970-01-01)
    clicks = records_from_lines(spark, ["1,9,p,c,-1", "1,9,p,c,1"], "ad_click")
    out = jobs.blacklist_filter(clicks, cap=1, reset="day")
    assert out.filter("output = 'pass'").count() == 2


def test_stream_order_outcomes_timers_across_batches(spark):
    from streamlytics.streaming.state import stream_order_outcomes
    # file 1 ends at 1558430943 s; file 2 holds the late pays (34756, 34767), the
    # pay without create (34768) and moves the watermark past every deadline
    s = with_event_time(_two_file_stream(spark, FX.ORDER_LOG, "order", 60, "orders3"), "ts_us", "0 seconds")
    got = run_available_now(stream_order_outcomes(s), "outcomes2")
    by = {}
    for oid, msg in rows(got, "order_id", "msg"):
        by.setdefault(msg, set()).add(oid)
    assert len(by["payed successfully"]) == 36
    assert by["payed but already timeout"] == {34756, 34767}
    assert by["order timeout"] == {34730}
    assert by["already payed but not found create log"] == {34768}


def test_malformed_record_fails_the_job(spark):
    import pytest
    bad = records_from_lines(spark, ["5402,83.149.11.115,success,1558430815", "x,1.2.3.4,fail,notatime"], "login")
    with pytest.raises(Exception):
        bad.collect()


def test_late_pay_before_its_timer_is_matched(spark):
    from streamlytics.streaming.state import stream_order_outcomes
    src = scratch_path(spark, "late-pay")
    _write_csv(src, "a.csv", ["1,create,,100", "2,create,,530"])
    _write_csv(src, "b.csv", ["1,pay,t1,200"])                   # behind the watermark (530 s), before 1000 s
    _write_csv(src, "c.csv", ["3,create,,5000"])
    s = with_event_time(read_records_stream(spark, src, "order", max_files=1).withColumn("seq", F.col("ts_us")))
    got = run_available_now(stream_order_outcomes(s), "late-pay")
    assert rows(got, "order_id", "msg") == [(1, "payed successfully"), (2, "order timeout")]


def test_late_click_of_the_day_counts(spark):
    from streamlytics.streaming.state import stream_click_cap
    src = scratch_path(spark, "late-click")
    _write_csv(src, "a.csv", ["1,9,p,c,1000"])
    _write_csv(src, "b.csv", ["1,9,p,c,200", "1,9,p,c,300"])
    s = with_event_time(read_records_stream(spark, src, "ad_click", max_files=1).withColumn("seq", F.col("ts_us")))
    got = run_available_now(stream_click_cap(s, cap=2), "late-click")
    assert rows(got, "ts_us", "output") == [(200_000000, "pass"), (300_000000, "warn"), (1000_000000, "pass")]


def test_arrival_order_on_streamed_files(spark):
    """D2 on several files, with a restart from the checkpoint between them, is the one file's answer."""
    from streamlytics.streaming.state import stream_login_fail
    lines = FX.LOGIN_LOG.strip().splitlines()
    lines += [f"7,10.0.0.1,fail,{t}" for t in (1558430900, 1558430899, 1558430901)] + ["7,10.0.0.1,success,1558430900", "7,10.0.0.1,fail,1558430902"]
    whole = jobs.login_fail_state(records_from_lines(spark, lines, "login"))
    src, out, ck = (scratch_path(spark, f"arrival-{x}") for x in ("in", "out", "ck"))
    for many, cuts in ((1, [(0, 9), (9, 30), (30, 31)]), (2, [(31, 49), (49, 50), (50, None)])):
        for i, (a, b) in enumerate(cuts):
            _write_csv(src, f"{'zyx'[i]}{many}.csv", lines[a:b])      # names do not sort by arrival
        s = with_event_time(read_records_stream(spark, src, "login", max_files=2, arrival=True), "ts_us", "5 seconds")
        with state_settings(spark):
            q = stream_login_fail(s).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck) \
                .trigger(availableNow=True).start()
        q.awaitTermination()
    got = spark.read.parquet(out)
    assert rows(got, "user_id", "first_us", "last_us") == rows(whole, "user_id", "first_us", "last_us") and got.count() > 0


def test_late_clicks_never_pass_the_cap(spark):
    """The day is over, four more micro-batches bring two of its clicks each: one pass, one warning."""
    from streamlytics.streaming.state import stream_click_cap
    src = scratch_path(spark, "late-clicks")
    _write_csv(src, "a.csv", ["1,9,p,c,1000"])
    _write_csv(src, "b.csv", [f"2,9,p,c,{3 * 86400}"])
    for i in range(4):
        _write_csv(src, f"c{i}.csv", [f"1,9,p,c,{2000 + i}", f"1,9,p,c,{3000 + i}"])
    s = with_event_time(read_records_stream(spark, src, "ad_click", max_files=1).withColumn("seq", F.col("ts_us")))
    got = run_available_now(stream_click_cap(s, cap=1), "late-clicks")
    assert rows(got.filter("user_id = 1"), "ts_us", "output") == [(1000_000000, "pass"), (2000_000000, "warn")]
    # with one day kept, rows of older days share the oldest kept one's count
    got = run_available_now(stream_click_cap(s, cap=1, keep="1 day"), "late-clicks-1")
    assert got.filter("user_id = 1 and output = 'pass'").count() == 2
    assert got.filter("user_id = 1 and output = 'warn'").count() == 1


def test_null_and_many_typed_keys_on_streams(spark):
    from streamlytics.streaming.state import stream_click_cap, stream_order_outcomes
    src = scratch_path(spark, "null-keys")
    schema = "k1 string, k2 timestamp, k3 decimal(20,3), event_type string, ts_us long, seq long"
    at = "timestamp_micros(1234567890123456)"
    spark.sql(f"SELECT k1, IF(k1 = 'a', {at}, NULL) AS k2, CAST(IF(k1 = 'a', NULL, 1.5) AS decimal(20,3)) AS k3, e AS event_type, "
              "t * 1000000 AS ts_us, t AS seq FROM VALUES ('a', 'create', 10L), ('a', 'pay', 20L), (NULL, 'create', 11L), "
              "('b', 'pay', 12L), ('z', 'other', 99999L) AS v(k1, e, t)").coalesce(1).write.parquet(src)
    s = with_event_time(spark.readStream.schema(schema).parquet(src))
    got = run_available_now(stream_order_outcomes(s, ("k1", "k2", "k3"), within="1 minute"), "typed-orders")
    assert got.schema["k2"].dataType.simpleString() == "timestamp" and got.schema["k3"].dataType.simpleString() == "decimal(20,3)"
    assert {(r.k1, r.k2 is None, r.k3 is None, r.msg) for r in got.collect()} == {
        ("a", False, True, "payed successfully"), (None, True, False, "order timeout"),
        ("b", True, False, "already payed but not found create log")}
    assert got.filter(f"k2 = {at}").count() == 1
    capped = run_available_now(stream_click_cap(s, ("k1", "k2"), cap=1), "typed-clicks")
    assert capped.filter("output = 'pass'").count() == 4 and capped.filter("output = 'warn'").count() == 1


def test_an_idle_key_is_not_looked_at_again(spark):
    """The reads and writes of a bucket's state follow the batch's rows, not the open keys."""
    from types import SimpleNamespace
    import pandas as pd
    from streamlytics.streaming.processors import ClickCap, OrderOutcomes

    class Map(dict):
        calls = 0

        def getValue(self, k):
            Map.calls += 1
            return self.get(k)

        def updateValue(self, k, v):
            Map.calls += 1
            self[k] = v

        def removeKey(self, k):
            Map.calls += 1
            self.pop(k, None)

    def started(p, names):
        p.names = names
        p.init(SimpleNamespace(getMapState=lambda *a: Map(), registerTimer=lambda t: None))
        return p
    wm = SimpleNamespace(getCurrentWatermarkInMs=lambda: 1)
    cap = started(ClickCap(["k", "ts_us", "seq"], 2, "x", "ts_us", "seq", True, 7), ["k", "ts_us", "seq", "_key"])
    orders = started(OrderOutcomes("event_type", "create", "pay", 900_000_000, "ts_us"), ["_key", "event_type", "ts_us"])
    click = lambda k: pd.DataFrame({"k": [k], "ts_us": [5], "seq": [5], "_key": [f"{k}"]})
    order = lambda k, t: pd.DataFrame({"_key": [f"{k}"], "event_type": ["create"], "ts_us": [t]})
    used = []
    for n in (10, 2000):                                       # few, then many keys wait
        for i in range(n):
            list(cap.handleInputRows((0,), iter([click(i)]), wm))
        list(orders.handleInputRows((0,), iter([order(i, 10 ** 9 + i) for i in range(n)]), wm))
        Map.calls = 0
        list(cap.handleInputRows((0,), iter([click("new%d" % n)]), wm))
        list(orders.handleInputRows((0,), iter([order("new%d" % n, 5 * 10 ** 9)]), wm))
        used.append(Map.calls)
    assert used[0] == used[1] <= 8
    Map.calls = 0                                              # a timer before any deadline reads the slices' names only
    list(orders.handleExpiredTimer((0,), wm, None))
    assert Map.calls == 0


def test_a_hot_key_sends_few_rows_of_each_batch(spark):
    import pandas as pd
    from streamlytics.streaming.processors import earliest
    hot = pd.DataFrame({"_key": ["hot"] * 850 + [f"k{i}" for i in range(150)], "ts_us": range(1000, 0, -1), "seq": range(1000)})
    out = pd.concat(earliest(["_key"], ["ts_us", "seq"], 3)(iter([hot, hot])))
    assert (out["_key"] == "hot").sum() == 6 and len(out) == 306
    assert sorted(out[out["_key"] == "hot"]["ts_us"].unique()) == [151, 152, 153]


def _brute_match(rows_, wait):
    """(pay, receipt) of one key's (ts, side, id) in event time, with the timers' effects."""
    pay = receipt = None
    timers, out = [], []
    for ts, side, name in sorted(rows_):
        if any(t < ts for t in timers):
            out += [(pay, receipt)] if pay or receipt else []
            pay = receipt = None
            timers = [t for t in timers if t >= ts]
        if side == "pay" and receipt or side == "receipt" and pay:
            out.append((name, receipt) if side == "pay" else (pay, name))
            pay, receipt = (None, None)
            continue
        pay, receipt = (name, receipt) if side == "pay" else (pay, name)
        timers.append(ts + wait)
    return out + ([(pay, receipt)] if pay or receipt else [])


def test_tx_match_on_repeated_ids(spark):
    """One to one, in order, over several micro-batches: as a walk over each key's rows."""
    import random
    from collections import defaultdict
    from streamlytics.streaming.state import stream_tx_match
    rng = random.Random(9)
    src = {s: scratch_path(spark, f"match-{s}") for s in ("pay", "receipt")}
    by, used = defaultdict(list), set()
    parts = {s: [[] for _ in range(4)] for s in src}
    for i in range(400):
        key, ts, side = f"k{rng.randrange(12)}" if i % 9 else None, rng.randrange(400), rng.choice(["pay", "receipt"])
        if (key, ts) in used:
            continue
        used.add((key, ts))
        by[key].append((ts, side, i))
        parts[side][ts // 100].append((key, i, ts * 1_000_000))
    for side in src:
        parts[side][3].append(("end", 10_000, 5_000_000_000))     # both inputs end late, so that every timer fires
        for p in parts[side]:
            spark.createDataFrame(p, f"tx string, {side}_id long, {side}_us long").coalesce(1).write.mode("append").parquet(src[side])
    ends = [spark.readStream.schema(f"tx string, {s}_id long, {s}_us long").option("maxFilesPerTrigger", 1).parquet(src[s]) for s in ("pay", "receipt")]
    got = run_available_now(stream_tx_match(*ends, "tx", "5 seconds", "pay_us", "receipt_us"), "match")
    assert got.columns == ["tx", "pay_id", "pay_us", "receipt_id", "receipt_us", "output"]
    want = sorted(((k, *m) for k, own in by.items() for m in _brute_match(own, 5)), key=repr)
    assert sorted(((r.tx, r.pay_id, r.receipt_id) for r in got.filter("tx is null or tx <> 'end'").collect()), key=repr) == want
    tags = {(r.pay_id is not None, r.receipt_id is not None): r.output for r in got.collect()}
    assert tags == {(True, True): "matched", (True, False): "unmatched_pay", (False, True): "unmatched_receipt"}


def test_stretches_unfold_to_the_windows(spark):
    """Sliding windows over micro-batches with late rows: each closed window counts what came before it closed."""
    src = scratch_path(spark, "stretches")
    batches = [[(None, 3), ("a", 5), ("a", 5), ("a", 9)], [("a", 30), ("a", 4), ("b", 29)], [("b", 64), ("a", 26), ("a", 1)], [("z", 90)]]
    for rows_ in batches:
        spark.createDataFrame([(k, t * 1_000_000) for k, t in rows_], "k string, ts_us long").coalesce(1).write.mode("append").parquet(src)
    s = with_event_time(spark.readStream.schema("k string, ts_us long").option("maxFilesPerTrigger", 1).parquet(src))
    got = SJ.unfold_windows(run_available_now(SJ.stream_sliding_stretches(s, "k", "20 seconds", "2 seconds"), "stretches"), "20 seconds", "2 seconds")
    want, wm = {}, 0
    for rows_ in batches:
        for k, t in rows_:
            for e in range(t // 2 * 2 + 2, t // 2 * 2 + 22, 2):
                if e > wm and e <= 90:
                    want[k, e] = want.get((k, e), 0) + 1
        wm = max(wm, max(t for _, t in rows_))
    assert {(r.k, r.window_end // 1000): r.cnt for r in got.collect()} == want
    assert got.count() == len(want) and got.filter("window_end - window_start <> 20000").count() == 0


def test_running_bitmap_counts_each_row(spark):
    from streamlytics.streaming.state import stream_running_unique_visitors
    src = scratch_path(spark, "running")
    batches = [[(1, 10), (2, 11), (1, 12)], [(2, 3605), (3, 13), (3, 3600)], [(9, 14), (2, 3700)], [(5, 9000)]]
    n = 0
    for rows_ in batches:
        spark.createDataFrame([(u, t * 1_000_000, (n := n + 1)) for u, t in rows_], "user_id long, ts_us long, seq long").coalesce(1) \
            .write.mode("append").parquet(src)
    s = with_event_time(spark.readStream.schema("user_id long, ts_us long, seq long").option("maxFilesPerTrigger", 1).parquet(src))
    got = run_available_now(stream_running_unique_visitors(s), "running")
    # user 9's row of the first hour comes when the watermark has passed it
    assert rows(got, "seq", "window_end", "uv") == [
        (1, 3600000, 1), (2, 3600000, 2), (3, 3600000, 2), (4, 7200000, 2), (5, 3600000, 3), (6, 7200000, 1), (8, 7200000, 2), (9, 10800000, 1)]


def test_running_bitmap_keeps_dense_and_sparse_parts():
    import numpy as np
    from streamlytics.streaming.processors import RunningDistinct
    p, kept = RunningDistinct(1, "t", "s"), {}
    p.seen = type("S", (), {"getValue": lambda self, k: kept.get(k), "updateValue": lambda self, k, v: kept.__setitem__(k, v)})()
    for n in (0, 1, 2047, 2048, 30000):
        bits = np.zeros(1 << 15, np.uint8)
        bits[np.random.default_rng(n).choice(1 << 15, n, replace=False)] = 1
        p._store((1,), bits)
        assert (p._load((1,)) == bits).all() and len(kept[((1,),)][0]) <= 4096


def test_finished_keys_leave_no_state(spark):
    from streamlytics.streaming import state as ST
    def left(build, kind, lines):
        src = scratch_path(spark, f"state-{kind}")
        for i, part in enumerate(lines):
            _write_csv(src, f"{i}.csv", part)
        s = with_event_time(read_records_stream(spark, src, kind, max_files=1).withColumn("seq", F.col("ts_us")))
        with state_settings(spark):
            q = build(s).writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "state-ck")).start()
        q.processAllAvailable()
        q.processAllAvailable()
        n = q.lastProgress["stateOperators"][0]["numRowsTotal"]
        q.stop()
        return n
    orders = [[f"{i},create,,{100 + i}" for i in range(50)] + [f"{i},pay,t{i},{160 + i}" for i in range(50)],
              ["900,create,,2000000"], ["901,create,,2000001"]]
    assert left(lambda s: ST.stream_followed_by_within(s), "order", orders) <= 2
    logins = [[f"{i},10.0.0.1,fail,{100 + i}" for i in range(50)] + [f"{i},10.0.0.1,success,{101 + i}" for i in range(50)],
              ["900,10.0.0.1,fail,2000000"], ["901,10.0.0.1,fail,2000001"]]
    assert left(lambda s: ST.stream_strict_pair(s), "login", logins) <= 2
    assert left(lambda s: ST.stream_login_fail(s), "login", logins) <= 2
    assert left(lambda s: ST.stream_order_outcomes(s), "order", orders) <= 8
    clicks = [[f"{i},9,p,c,{i}" for i in range(200)], ["900,9,p,c,2000000"], ["901,9,p,c,2000001"]]
    assert left(lambda s: ST.stream_click_cap(s), "ad_click", clicks) <= 10


def test_watermark_follows_rows_that_a_filter_drops(spark):
    src = scratch_path(spark, "wm")
    _write_csv(src, "a.csv", ["1,1,1,pv,100"])
    _write_csv(src, "b.csv", ["1,1,1,buy,50000"])
    s = with_event_time(read_records_stream(spark, src, "user_behavior", max_files=1))
    got = run_available_now(SJ.stream_window_count(SJ.page_views(s), None, "1 hour"), "wm")
    assert rows(got, "window_start", "cnt") == [(0, 1)]


def test_a_corrupt_sink_is_an_error(spark):
    import pytest
    from streamlytics.streaming.core import _read_or_empty
    path = scratch_path(spark, "corrupt")
    assert _read_or_empty(spark, path, spark.range(1).schema).count() == 0
    _write_csv(path, "part-0.parquet", ["not parquet"])
    with pytest.raises(Exception):
        _read_or_empty(spark, path, spark.range(1).schema).count()


def test_long_watermark_delay(spark):
    df = spark.readStream.format("rate").load().selectExpr("value as ts_us")
    assert with_event_time(df, "ts_us", "15 days").isStreaming


def _counted_state():
    """A handle whose map states count their calls."""
    from types import SimpleNamespace

    class Map(dict):
        def getValue(self, k):
            handle.calls += 1
            return self.get(k)

        def updateValue(self, k, v):
            handle.calls += 1
            self[k] = v

        def removeKey(self, k):
            handle.calls += 1
            self.pop(k, None)

    def timer(at):
        handle.calls += 1
        handle.timers.append(at)
    handle = SimpleNamespace(calls=0, timers=[], getMapState=lambda *a: Map(), registerTimer=timer)
    return handle


def test_state_calls_of_the_two_input_match_do_not_grow_with_the_keys():
    """A bucket's batch of many keys, and their timers, cost a bounded number of state calls (F1)."""
    from types import SimpleNamespace
    import pandas as pd
    from streamlytics.streaming.processors import TxMatch
    for n in (50, 3000):
        handle, p = _counted_state(), TxMatch(5_000_000, "ts_us", "_row")
        p.names = ["_key", "_row", "_left", "ts_us"]
        p.init(handle)
        wm = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
        first = pd.DataFrame([(f"k{i}", f"l{i}", True, i * 10_000_000) for i in range(n)], columns=p.names)
        second = pd.DataFrame([(f"k{i}", f"r{i}", False, i * 10_000_000 + 1) for i in range(0, n, 2)], columns=p.names)
        assert [len(x) for x in p.handleInputRows((0,), iter([first]), wm)] == [0]
        out = pd.concat(p.handleInputRows((0,), iter([second]), wm))
        assert sorted(out.itertuples(index=False, name=None)) == sorted((f"k{i}", f"l{i}", f"r{i}") for i in range(0, n, 2))
        assert handle.timers[0] == 5000
        late = SimpleNamespace(getCurrentWatermarkInMs=lambda: (n - 10) * 10_000)
        out = pd.concat(p.handleExpiredTimer((0,), late, None))
        assert sorted(out["_key"]) == sorted(f"k{i}" for i in range(1, n - 10, 2)) and handle.timers[-1] == (n - 10) * 10_000 + 5000
        out = pd.concat(p.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda: n * 10_000), None))
        assert len(out) == 5 and not p.waiting.held and not p.waiting.due
        assert handle.calls <= 60


def test_state_calls_of_the_order_outcomes_do_not_grow_with_the_keys():
    """Creates that wait, their pays and their timers cost a bounded number of state calls."""
    from types import SimpleNamespace
    import pandas as pd
    from streamlytics.streaming.processors import NONE, OrderOutcomes
    at = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    for n in (50, 3000):
        handle, p = _counted_state(), OrderOutcomes("event_type", "create", "pay", 900_000_000, "ts_us")
        p.names = ["_key", "event_type", "ts_us"]
        p.init(handle)
        created = pd.DataFrame([(f"k{i}", "create", i * 10 ** 9) for i in range(n)], columns=p.names)
        paid = pd.DataFrame([(f"k{i}", "pay", i * 10 ** 9 + 5) for i in range(0, n, 2)], columns=p.names)
        assert [len(x) for x in p.handleInputRows((0,), iter([created]), at(0))] == [0]
        out = pd.concat(p.handleInputRows((0,), iter([paid]), at(0)))
        assert sorted(out["_key"]) == sorted(f"k{i}" for i in range(0, n, 2)) and set(out["outcome"]) == {"in time"}
        out = pd.concat(p.handleExpiredTimer((0,), at(n * 10 ** 6), None))
        assert sorted(out["_key"]) == sorted(f"k{i}" for i in range(1, n, 2)) and set(out["outcome"]) == {"no pay"}
        assert set(out["pay_us"]) == {NONE} and not p.waiting.held and handle.calls <= 60


def test_followed_by_over_batches_in_bounded_state_calls():
    """C2 by a bucket's processor: as one walk over each key's rows, whatever the batches; state
    calls do not grow with the keys (F5)."""
    import random
    from types import SimpleNamespace
    import pandas as pd
    from streamlytics.streaming.processors import FollowedBy
    rng, within, cols = random.Random(4), 3_000_000, ["_key", "event_type", "ts_us", "seq"]
    data = sorted(((f"k{rng.randrange(800)}", rng.choice(["create", "pay", "view"]), rng.randrange(60_000_000), i) for i in range(6000)), key=lambda r: r[2])
    want, opened = [], {}
    for k, kind, t, _ in data:
        own = opened.setdefault(k, [])
        want += [(k, c, None) for c in own if c + within <= t]
        own[:] = [c for c in own if c + within > t]
        if kind == "pay":
            want += [(k, c, t) for c in own]
            own.clear()
        elif kind == "create":
            own.append(t)
    want += [(k, c, None) for k, own in opened.items() for c in own]
    handle, got = _counted_state(), []
    p = FollowedBy("event_type", "create", "pay", within, "ts_us", "seq", "paid", "timeout")
    p.names = cols
    p.init(handle)
    wm = 0
    for i in range(0, 6000, 1500):
        at, part = SimpleNamespace(getCurrentWatermarkInMs=lambda: wm), data[i:i + 1500]
        rng.shuffle(part)
        got += [*p.handleInputRows((0,), iter([pd.DataFrame(part, columns=cols)]), at), *p.handleExpiredTimer((0,), at, None)]
        wm = max(r[2] for r in part) // 1000
    for wm in (wm, 100_000):
        got += p.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda: wm), None)
    rows_ = [(r[0], r[1], None if pd.isna(r[2]) else r[2]) for r in pd.concat(got)[["_key", "start_us", "end_us"]].itertuples(index=False)]
    assert sorted(rows_, key=str) == sorted(want, key=str) and len(want) > 1000
    assert not p.waiting.held and handle.calls <= 160


def test_late_rows_of_a_pattern_are_dropped(spark):
    from streamlytics.streaming.state import stream_followed_by_within
    src = scratch_path(spark, "late-pattern")
    for name, lines in (("a", ["1,create,,100", "9,other,,5000"]), ("b", ["9,other,,6000"]), ("c", ["1,pay,t1,200", "9,other,,6500"]), ("d", ["9,other,,20000"])):
        _write_csv(src, f"{name}.csv", lines)
    s = with_event_time(read_records_stream(spark, src, "order", max_files=1).withColumn("seq", F.col("ts_us")))
    got = run_available_now(stream_followed_by_within(s, within="2 hours"), "late-pattern")
    assert rows(got, "order_id", "start_us", "end_us", "output") == [(1, 100_000000, None, "timeout")]


def test_a_click_cap_group_holds_a_small_part_of_a_batch(spark, monkeypatch):
    """A Python call holds one group's rows: one in some hundreds of a batch's."""
    from streamlytics.streaming import state as ST
    monkeypatch.setattr(ST.PR, "run_processor", lambda d, by, *a, **k: d.groupBy(*by).count())
    clicks = spark.range(40_000).selectExpr("id AS user_id", "id % 7 AS ad_id", "id AS ts_us", "id AS seq")
    groups = [r["count"] for r in ST.stream_click_cap(clicks).collect()]
    assert sum(groups) == 40_000 and max(groups) < 200
