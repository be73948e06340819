"""Scalar functions F1-F9 against hand-computed values."""

from streamlytics.functions.text import drop_static_resources, split_fields, tx_present
from streamlytics.functions.time import (duration_us, format_sql_time, format_window_time,
                                         next_midnight_us, parse_log_time)


def test_time_formats(spark):
    df = spark.createDataFrame([(1511661720_000,), (0,)], "ms BIGINT")
    got = [tuple(r) for r in df.select(format_window_time("ms"), format_sql_time("ms")).collect()]
    assert got == [("2017/11/26-02:02:00", "2017-11-26 02:02:00.0"), ("1970/01/01-00:00:00", "1970-01-01 00:00:00.0")]


def test_parse_log_time_and_split(spark):
    df = spark.createDataFrame([("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /a.css",)], "l STRING")
    f = split_fields("l", " ")
    r = df.select(f.getItem(0), parse_log_time(f.getItem(3)), f.getItem(6)).first()
    assert tuple(r) == ("83.149.9.216", 1431857103_000000, "/a.css")


def test_next_midnight(spark):
    df = spark.createDataFrame([(1511661701_000000,), (86400_000000,), (-1,)], "t BIGINT")
    got = [r[0] for r in df.select(next_midnight_us("t")).collect()]
    assert got == [1511740800_000000, 2 * 86400_000000, 0]


def test_static_resource_filter_and_tx(spark):
    urls = ["/a.css", "/b.js", "/c.json", "/d.html", "/x.css?v=1", "/js", "/e.JS"]
    df = spark.createDataFrame([(u,) for u in urls], "u STRING")
    kept = sorted(r[0] for r in df.filter(drop_static_resources("u")).collect())
    assert kept == sorted(["/c.json", "/d.html", "/x.css?v=1", "/js", "/e.JS"])
    tx = spark.createDataFrame([("a",), ("",), (None,), (" ",)], "t STRING")
    assert [r[0] for r in tx.filter(tx_present("t")).collect()] == ["a"]


def test_durations():
    assert duration_us("1 hour") == 3_600_000_000
    assert duration_us("5 seconds") == 5_000_000
    assert duration_us("15 minutes") == 900_000_000
    assert duration_us(42) == 42


def test_records_are_trimmed(spark):
    from streamlytics.sources.records import records_from_lines
    df = records_from_lines(spark, [" 5402 , 83.149.11.115 ,  success , 1558430815 "], "login")
    r = df.select("user_id", "ip", "event_type", "ts_us").first()
    assert tuple(r) == (5402, "83.149.11.115", "success", 1558430815_000000)


def test_file_records_are_trimmed(spark, tmp_path):
    from streamlytics.sources.records import read_records
    (tmp_path / "a.csv").write_text(" 5402 , 83.149.11.115 ,  success , 1558430815 \n")
    r = read_records(spark, str(tmp_path), "login").select("user_id", "ip", "event_type", "ts_us").first()
    assert tuple(r) == (5402, "83.149.11.115", "success", 1558430815_000000)
