"""Web access-log lines (space separated) -> ip, user_id, ts_us, method, url.

Fields used: 0 ip, 2 user, 3 time 'dd/MM/yyyy:HH:mm:ss' (UTC; the zone field 4 is
ignored, as in the reference), 5 method, 6 url.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import parse_log_time


def parse_access_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    f = F.split(F.col(value_col), " ")
    keep = [c for c in lines.columns if c != value_col]
    return lines.select(f.getItem(0).alias("ip"), f.getItem(2).alias("user_id"),
                        parse_log_time(f.getItem(3)).alias("ts_us"),
                        f.getItem(5).alias("method"), f.getItem(6).alias("url"), *keep)


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_access_log(spark.read.text(path))


def read_access_log_stream(spark: SparkSession, path: str) -> DataFrame:
    return parse_access_log(spark.readStream.text(path))
