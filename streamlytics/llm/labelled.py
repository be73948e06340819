"""Labelled rows for the classifiers: the split by crc32 and the bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import text_key
from .tables import written


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def training_texts(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, max_rows: int) -> DataFrame:
    """(doc_id, text, y) of labelled rows outside the held-out remainder, about ``max_rows`` of
    them: with more, those whose hash is below the share, the same ones in every run. Null ids
    and labels are left out; rows that repeat a (doc_id, text) are one. The share is taken of the
    labels, whose ids, so bounded, are sent to the scan of the texts, and again of the
    texts found, as many of them may have one id."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")) \
        .filter(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("_id"), modulus) != held))
    n = known.count()
    if n > max_rows:
        known = known.filter(_below(max_rows / n, F.col("_id")))
    found = docs.select("doc_id", "text").join(F.broadcast(known.distinct()), F.col("doc_id") == F.col("_id")) \
        .select("doc_id", "text", "y", text_key("text").alias("_key"))
    found = written(found.groupBy("doc_id", "_key", "y").agg(F.first("text").alias("text")), "labelled")
    n = found.count()
    if n > max_rows:
        found = found.filter(_below(max_rows / n, F.col("doc_id"), F.col("_key"), F.lit(1)))
    return found.select("doc_id", "text", "y")


def _below(share: float, *of: Column) -> Column:
    return F.pmod(F.xxhash64(*of), F.lit(1 << 30)) < int(share * (1 << 30))
