"""Comma-separated records -> typed rows with event time in epoch µs.

Batch: ``read_records(spark, path, kind)``; stream: ``read_records_stream``;
queue payloads: ``decode_records(df_with_binary_value, kind)``. Fields are
trimmed; malformed rows fail the job (FAILFAST), as the reference's parser does.
An arrival sequence ``seq`` is attached where the source defines one (for batch reads the
file, by name, and the position in it), because order-sensitive operators need it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SCHEMAS, TIME_UNIT
from ..session import configure

_SCALE = {"s": 1_000_000, "ms": 1_000}


def _finish(df: DataFrame, kind: str) -> DataFrame:
    unit = TIME_UNIT.get(kind, "s")
    str_cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    out = df.select(*[F.trim(F.col(c)).alias(c) if c in str_cols else F.col(c) for c in df.columns])
    return out.withColumn("ts_us", F.col("event_time") * F.lit(_SCALE[unit]))


def read_records(spark: SparkSession, path: str, kind: str, with_seq: bool = True) -> DataFrame:
    """Read a CSV file/folder of one record kind (no header)."""
    configure(spark)
    df = (spark.read.schema(SCHEMAS[kind]).option("mode", "FAILFAST")
          .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
          .csv(path))
    out = _finish(df, kind)
    if with_seq:
        out = _arrival(spark, out, df.inputFiles())
    return out


# seq = file number * 2^_FILE_BITS + byte where the scanned block begins + row of the task
_FILE_BITS = 44


def _arrival(spark: SparkSession, df: DataFrame, files: list[str]) -> DataFrame:
    """``df`` with ``seq``, ascending by (file name, position), without a sort.

    Spark deals blocks of files to tasks largest first, so a task's row number alone says
    nothing about the file. A block that is followed by another of its file is a whole
    split and alone in its task, which so reads fewer rows than the block has bytes: block
    start plus row number ascends within a file."""
    row = F.expr(f"monotonically_increasing_id() & {(1 << 33) - 1}L")
    placed = df.withColumn("_at", F.col("_metadata.file_block_start") + row)
    if len(files) < 2:
        return placed.withColumn("seq", F.col("_at")).drop("_at")
    # both spellings of a path, file:/x and file:///x, as the former
    order = spark.createDataFrame([(re.sub("^(\\w+):/+", r"\1:/", f), i) for i, f in enumerate(sorted(files))],
                                  "_file string, _number bigint")
    placed = placed.withColumn("_path", F.regexp_replace(F.col("_metadata.file_path"), "^(\\w+):/+", "$1:/"))
    # file names only: their number is the folder's listing, which the driver holds anyway
    number = F.coalesce("_number", F.raise_error(F.concat(F.lit("not in the listing: "), "_path")).cast("bigint"))
    return placed.join(order, F.col("_path") == F.col("_file"), "left") \
        .withColumn("seq", number * F.lit(1 << _FILE_BITS) + F.col("_at")) \
        .drop("_at", "_path", "_file", "_number")


def read_records_stream(spark: SparkSession, path: str, kind: str, max_files: int | None = None,
                        arrival: bool = False) -> DataFrame:
    """Streaming form of ``read_records`` (a folder that receives new CSV files).

    With ``arrival`` the rows carry ``seq``, a text that sorts by arrival: the file's time and
    name, in the order in which a stream takes files, and the line. Each file is then one
    segment, read by one task as a whole, so segments should be of some 100 MB at most."""
    configure(spark)
    if arrival:
        r = spark.readStream.format("text").option("wholetext", True)
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        lines = r.load(path).select(F.col("_metadata.file_modification_time").alias("_at"), F.col("_metadata.file_name").alias("_name"),
                                    F.posexplode(F.split("value", "\r?\n")).alias("_line", "value"))
        seq = F.format_string("%016d/%s/%012d", F.unix_micros("_at"), "_name", "_line")
        return decode_records(lines.filter(F.trim("value") != "").select(seq.alias("seq"), "value"), kind)
    r = (spark.readStream.schema(SCHEMAS[kind]).option("mode", "FAILFAST")
         .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return _finish(r.csv(path), kind)


def decode_records(df: DataFrame, kind: str, value_col: str = "value") -> DataFrame:
    """S3: decode a message-queue ``value`` (binary or string) holding one CSV record,
    as delivered by ``spark.readStream.format('kafka')``; other columns are kept."""
    parsed = F.from_csv(F.col(value_col).cast("string"), SCHEMAS[kind],
                        {"mode": "FAILFAST", "ignoreLeadingWhiteSpace": "true",
                         "ignoreTrailingWhiteSpace": "true"})
    keep = [c for c in df.columns if c != value_col]
    out = df.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")
    return _finish(out, kind)


def records_from_lines(spark: SparkSession, lines: list[str] | str, kind: str) -> DataFrame:
    """Small in-memory input (tests, examples): CSV lines -> typed records with
    ``seq`` = line position. Not for large data: the lines pass through the driver."""
    if isinstance(lines, str):
        lines = [ln for ln in lines.splitlines() if ln.strip()]
    raw = spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "seq BIGINT, value STRING")
    return decode_records(raw, kind)


def read_queue_stream(spark: SparkSession, servers: str, topic: str, kind: str,
                      starting_offsets: str = "latest", options: dict | None = None) -> DataFrame:
    """S3: records from a message-queue topic (Kafka source), decoded like S1.

    Starts from the latest offsets, as the reference's consumer does. The record's
    ``offset`` is kept as ``seq`` (arrival order within a topic partition) and the
    partition as ``queue_partition``. Needs the Kafka connector on the classpath
    (not part of this image; ``decode_records`` is tested on its own).
    """
    configure(spark)
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    raw = r.load().select("value", F.col("partition").alias("queue_partition"), F.col("offset").alias("seq"))
    return decode_records(raw, kind)
