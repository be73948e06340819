"""Record streams of the reference's domain, derived from the driver's tables.

The driver ships TPC-H-like tables plus an ``events`` table
(event_id, ts, user_id, event_type, value, props='{"k": n}'). The jobs of the
reference read user-behaviour, web-log, ad-click, marketing, login, order and
receipt records; each is derived here with column expressions only (one scan of
``events``, no shuffle except the dimension join of ad clicks), so the work grows
with the tables. ``seq`` (= ``event_id``) is the arrival order; ``ts_us`` is the
event time in epoch microseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import US_PER, epoch_us, LOG_TIME_FORMAT, epoch_ms_to_ntz
from ..session import configure

# ---- fixed values of the mapping (chosen once; the oracle SQL uses the same) ----
# events.event_type -> UserBehavior.behavior
BEHAVIOR_OF_EVENT = {"view": "pv", "purchase": "buy", "click": "cart", "signup": "fav"}
# events.event_type -> marketing behaviour (error plays the uninstall that P2 drops)
MARKETING_OF_EVENT = {"view": "BROWSE", "click": "CLICK", "purchase": "PURCHASE",
                      "signup": "INSTALL", "error": "UNINSTALL"}
# Marketing channels of the reference's simulated source, picked by k % 6.
CHANNELS = ["appstore", "xiaomistore", "huaweistore", "weibo", "wechat", "tieba"]
# URL suffix picked by k % 5 (two are static resources that P3 drops).
URL_SUFFIXES = [".css", ".js", ".html", ".json", ""]
# Receipt pay channels, picked by k % 2.
PAY_CHANNELS = ["wechat", "alipay"]


def table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    """A driver table; ``stream=True`` reads it as a file stream (new files of the
    table's folder/pattern arrive as micro-batches)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if not stream:
        return spark.read.parquet(path)
    schema = spark.read.parquet(path).schema
    # A glob (not a plain file path) lets the file-stream source list the table.
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parq[u]et")


def events(spark: SparkSession, sf_dir: str, where=None, stream: bool = False) -> DataFrame:
    """``events`` with ``ts_us`` (epoch µs), ``seq`` (arrival) and ``k`` (props item).

    ``where`` is an optional predicate on the raw columns, applied before any
    derivation so that it reaches the Parquet scan (``PushedFilters``). Event
    time is read as UTC wall clock, whatever the session's zone.
    """
    configure(spark)
    df = table(spark, sf_dir, "events", stream)
    if where is not None:
        df = df.filter(where)
    ts_type = df.schema["ts"].dataType
    return df.select(
        "event_id", "user_id", "event_type", "props",
        epoch_us("ts", ts_type).alias("ts_us"),
        F.col("event_id").alias("seq"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def in_batches(spark: SparkSession, df: DataFrame, lo_us: int, hi_us: int, n: int, late=None, ts_col: str = "ts_us") -> DataFrame:
    """``df`` (with ``ts_col``) as a stream of ``n`` micro-batches: its rows are written as
    ordered sets of files, by their place in [lo_us, hi_us], and read one set a batch.
    ``late`` (a column of whole numbers) delays a row by so many batches."""
    from ..session import scratch_path
    k = max(1, spark.sparkContext.defaultParallelism // 4)
    at = F.expr(f"({ts_col} - {lo_us}L) * {n}L div {hi_us - lo_us + 1}L")
    d = df.withColumn("_batch", F.greatest(F.lit(0), F.least(at + (F.lit(0) if late is None else late), F.lit(n - 1))))
    path = scratch_path(spark, "batches")
    for i in range(n):
        # the stream takes files in the order they were written
        d.filter(F.col("_batch") == i).drop("_batch").repartition(k).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", k).parquet(path)


def time_range(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Least and largest event time of ``events`` (µs)."""
    return tuple(events(spark, sf_dir).agg(F.min("ts_us"), F.max("ts_us")).first())


def single_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with one create each (a signup, order_id its event) and, for three in four,
    one pay 0 to 11 hours later."""
    e = events(spark, sf_dir).filter(F.col("event_type") == "signup")
    pay = F.struct(F.lit("pay").alias("event_type"), (F.col("ts_us") + (F.col("event_id") * 7919) % 12 * US_PER["h"]).alias("ts_us"))
    create = F.struct(F.lit("create").alias("event_type"), F.col("ts_us"))
    rows = F.explode(F.when(F.col("event_id") % 4 != 0, F.array(create, pay)).otherwise(F.array(create)))
    return e.select(F.col("event_id").alias("order_id"), rows.alias("x")).select("order_id", "x.event_type", "x.ts_us") \
        .withColumn("seq", F.col("order_id") * 2 + (F.col("event_type") == "pay").cast("int"))


def unique_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts with unique transaction ids: of four purchases in five, up to 6 s from the
    pay, and of no purchase (signups)."""
    e = events(spark, sf_dir)
    bought = F.col("event_type") == "purchase"
    tx = F.concat(F.when(bought, "tx").otherwise("rx"), F.col("event_id").cast("string"))
    at = F.when(bought, F.col("ts_us") + (F.col("event_id") % 13 - 6) * US_PER["s"]).otherwise(F.col("ts_us"))
    return e.filter((bought & (F.col("event_id") % 5 != 0)) | (F.col("event_type") == "signup")) \
        .select(tx.alias("tx_id"), _pick(PAY_CHANNELS, F.col("k")).alias("pay_channel"), at.alias("receipt_us"))


def _map(col: str, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, F.lit(v)) if expr is None
                else expr.when(F.col(col) == k, F.lit(v)))
    return expr.otherwise(F.col(col) if default is None else F.lit(default))


def _pick(values: list, idx) -> "F.Column":
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)).cast("int") + 1)


def user_behavior(spark: SparkSession, sf_dir: str, where=None, stream: bool = False) -> DataFrame:
    """UserBehavior records: user_id, item_id, category_id, behavior, ts_us, seq."""
    e = events(spark, sf_dir, where, stream)
    return e.select(
        "user_id", F.col("k").alias("item_id"), (F.col("k") % 10).cast("int").alias("category_id"),
        _map("event_type", BEHAVIOR_OF_EVENT).alias("behavior"), "ts_us", "seq")


def access_log_lines(spark: SparkSession, sf_dir: str, where=None, stream: bool = False) -> DataFrame:
    """Web access-log text lines (``value``), space separated like a server log:
    ``ip - user dd/MM/yyyy:HH:mm:ss +0000 METHOD url``."""
    e = events(spark, sf_dir, where, stream)
    u = F.col("user_id")
    ip = F.concat_ws(".", F.lit("10"), F.expr("(user_id div 65536) % 256").cast("string"),
                     F.expr("(user_id div 256) % 256").cast("string"), (u % 256).cast("string"))
    when = F.date_format(epoch_ms_to_ntz(F.floor(F.col("ts_us") / 1000)), LOG_TIME_FORMAT)
    method = F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET")
    url = F.concat(F.lit("/p/"), F.col("k").cast("string"), _pick(URL_SUFFIXES, F.col("k")))
    line = F.concat_ws(" ", ip, F.lit("-"), F.concat(F.lit("u"), F.col("user_id").cast("string")),
                       when, F.lit("+0000"), method, url)
    return e.select(line.alias("value"), "seq")


def ad_clicks(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """AdClickLog records: user_id, ad_id, province (region), city (nation), ts_us, seq.

    ``nation`` and ``region`` are broadcast after a row-count check
    (``bounded_broadcast``); ``customer`` grows with the data and is joined by the
    planner's size-checked choice (broadcast below the threshold, else a shuffle
    join that AQE splits if a user is hot).
    """
    from ..operators.dims import bounded_broadcast
    e = events(spark, sf_dir, None, stream).filter(F.col("event_type") == "click")
    geo = (table(spark, sf_dir, "nation")
           .join(bounded_broadcast(table(spark, sf_dir, "region")),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("province")))
    cust = (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            .join(bounded_broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "province", "city"))
    return (e.join(cust, e.user_id == cust.c_custkey)
            .select("user_id", F.col("k").alias("ad_id"), "province", "city", "ts_us", "seq"))


def marketing_events(spark: SparkSession, sf_dir: str, where=None, stream: bool = False) -> DataFrame:
    """MarketingUserBehavior records: user_id, behavior, channel, ts_us, seq."""
    e = events(spark, sf_dir, where, stream)
    return e.select("user_id", _map("event_type", MARKETING_OF_EVENT).alias("behavior"),
                    _pick(CHANNELS, F.col("k")).alias("channel"), "ts_us", "seq")


def login_events(spark: SparkSession, sf_dir: str, where=None, stream: bool = False) -> DataFrame:
    """LoginEvent records: user_id, ip, event_type ('fail' for error, else 'success'), ts_us, seq."""
    e = events(spark, sf_dir, where, stream)
    return e.select("user_id", F.format_string("10.0.%d.%d", F.col("k"), F.col("user_id") % 256).alias("ip"),
                    F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("event_type"),
                    "ts_us", "seq")


def order_events(spark: SparkSession, sf_dir: str, where=None, stream: bool = False) -> DataFrame:
    """OrderEvent records keyed by user: signup = create, purchase = pay (tx 'tx<event_id>')."""
    e = events(spark, sf_dir, where, stream)
    et = (F.when(F.col("event_type") == "signup", "create")
          .when(F.col("event_type") == "purchase", "pay").otherwise(F.col("event_type")))
    tx = F.when(F.col("event_type") == "purchase", F.concat(F.lit("tx"), F.col("event_id").cast("string")))
    return e.select(F.col("user_id").alias("order_id"), et.alias("event_type"), tx.alias("tx_id"), "ts_us", "seq")


def pay_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Pays for reconciliation: purchases keyed by user (the shared key of both streams)."""
    return as_pays(events(spark, sf_dir, None, stream).filter(F.col("event_type") == "purchase"))


def as_pays(e: DataFrame, *more: str) -> DataFrame:
    return e.select(F.col("user_id").alias("key"), F.col("event_id").alias("pay_id"), "ts_us", *more)


def receipt_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Receipts for reconciliation: clicks keyed by user, channel by k % 2."""
    return as_receipts(events(spark, sf_dir, None, stream).filter(F.col("event_type") == "click"))


def as_receipts(e: DataFrame, *more: str) -> DataFrame:
    return e.select(F.col("user_id").alias("key"), F.col("event_id").alias("receipt_id"),
                    _pick(PAY_CHANNELS, F.col("k")).alias("pay_channel"), "ts_us", *more)
