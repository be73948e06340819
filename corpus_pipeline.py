"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes the table its predecessor wrote and returns the documents it keeps, with
the columns of ``documents``; the last returns packed pieces. The stages handle nulls, empty
and long texts, ties, repeated rows, empty tables and extra columns as their operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamlytics.llm import decontaminate, line_dedup, ngram_join, packing, quality_rules
from streamlytics.llm.queries import tokenizer_path
from streamlytics.llm.tables import read, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines that a host repeats too often."""
    return quality_rules.apply(docs.select(COLUMNS), enough_docs=quality_rules.ENOUGH_DOCS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines equal, or within one word, to an earlier line; emptied documents go."""
    return line_dedup.apply(docs.select(COLUMNS))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return ngram_join.apply(docs.select(COLUMNS))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontaminate.apply(docs.select(COLUMNS), read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 ids."""
    return packing.pack(docs.select(COLUMNS), tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram join", near_copies),
          ("decontamination", benchmark_free), ("packing", packed)]

# SQL cannot express the BPE ids; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
