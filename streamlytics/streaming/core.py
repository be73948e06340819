"""Event time, watermarks and sinks for Structured Streaming.

Streams carry the event time twice: ``ts_us`` (epoch µs, used by the shared batch
operators) and ``ts`` (TIMESTAMP, what ``withWatermark`` and ``F.window`` need).
Rows behind the watermark are dropped by Spark's windowed aggregates and joins, as
in the reference framework, and by the patterns (C1, C2); the keyed process functions
(D1, D2, D3) do not drop them.

The reference assigns watermarks before it filters, so they follow every row. Spark's
optimizer pushes a filter that does not read the event time below ``withWatermark``,
and the watermark would follow the kept rows only; ``after_watermark`` makes a filter
that stays above it.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import duration_us
from ..session import REQUIRED_CONF, scratch_path


def with_event_time(df: DataFrame, ts_us_col: str = "ts_us", delay="0 seconds", ts_col: str = "ts",
                    max_ts_us: int | None = None) -> DataFrame:
    """T1 (``delay=0``: ascending timestamps) / T2 (bounded out-of-orderness).

    ``max_ts_us`` optionally bounds the watermark's column: a row with an impossible
    future time (one would push the watermark years ahead and make every later row late)
    stands at the bound there, and one before 1678 at its start. No row is dropped, and
    ``ts_us`` keeps the row's own time, which the keyed functions use. In a window by the
    watermark's column such a row counts at the bound.
    """
    at = F.col(ts_us_col)
    if max_ts_us is not None:
        at = F.greatest(F.least(at, F.lit(max_ts_us)), F.lit(_FIRST_PANDAS_US))
    d = df.withColumn(ts_col, F.timestamp_micros(at))
    return d.withWatermark(ts_col, _duration_text(delay))


# 1678-01-01, after the first instant that pandas' nanoseconds can hold
_FIRST_PANDAS_US = -9_214_560_000_000_000


def after_watermark(condition: Column, ts_col: str = "ts") -> Column:
    """``condition`` as one that also reads the event time, so that it is applied after the
    watermark (rows without a time don't pass)."""
    return F.when(F.col(ts_col).isNotNull(), condition).otherwise(F.lit(False))


def window_bounds_ms(w: str = "w") -> list[Column]:
    return [(F.unix_micros(F.col(f"{w}.start")) / 1000).cast("bigint").alias("window_start"),
            (F.unix_micros(F.col(f"{w}.end")) / 1000).cast("bigint").alias("window_end")]


def _duration_text(d) -> str:
    return f"{duration_us(d)} microseconds"


def run_available_now(df: DataFrame, name: str, mode: str = "append",
                      foreach: Callable[[DataFrame], DataFrame] | None = None,
                      state_partitions: int | None = None) -> DataFrame:
    """Run a streaming DataFrame over everything available now and return the
    result table (a Parquet folder under the shared checkpoint folder).

    ``foreach`` maps each micro-batch (a static DataFrame) before it is appended,
    e.g. a batch top-N over the windows the batch has just closed.
    ``state_partitions`` fixes the number of state-store partitions of the query
    (taken from ``spark.sql.shuffle.partitions`` when the query first starts and
    kept in its checkpoint); the session setting is restored afterwards.
    """
    spark = df.sparkSession
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    w = df.writeStream.option("checkpointLocation", ckpt).outputMode(mode).trigger(availableNow=True)
    with state_settings(spark, state_partitions):
        if foreach is None and mode == "append":
            q = w.format("parquet").option("path", out).start()
        else:
            fn = foreach or (lambda b: b)

            def sink(batch: DataFrame, epoch_id: int) -> None:
                # foreachBatch is at-least-once: a retried epoch overwrites its own
                # folder instead of appending a second copy.
                fn(batch).write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")
            q = w.foreachBatch(sink).start()
    q.awaitTermination()
    schema = (foreach(df.sparkSession.createDataFrame([], df.schema)) if foreach else df).schema
    res = _read_or_empty(spark, out, schema)
    return res.drop("epoch") if "epoch" in res.columns else res


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None):
    """The settings with which a query with state starts (and which it keeps): RocksDB as the
    state store, which the processors need, and the number of state partitions. The session's
    own are restored."""
    new = {k: v for k, v in REQUIRED_CONF.items() if "stateStore" in k}
    if partitions:
        new["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in new}
    try:
        for k, v in new.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.parquet(path).select(*schema.fieldNames())
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)     # nothing was written: no closed window yet


def write_side_outputs(df: DataFrame, path: str, checkpoint: str, tag_col: str = "output",
                       trigger: dict | None = None):
    """S5 for streams: one query writes every tagged output (main + side outputs)
    into ``path/<tag_col>=<tag>/`` (start it; returns the StreamingQuery)."""
    w = (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .partitionBy(tag_col).outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def console(df: DataFrame, label: str | None = None, mode: str = "append"):
    """Print a stream (``print("label")`` of the reference) via the console sink."""
    if label:
        df = df.select(F.lit(label).alias("label"), "*")
    return df.writeStream.format("console").option("truncate", False).outputMode(mode).start()
