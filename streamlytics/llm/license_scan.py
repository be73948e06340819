"""Operator 11, licence scans: an exact set-similarity join of text blocks with templates.

A-Z are lower-cased; a word is a run of characters other than ``\\x00-\\x2F``, ``\\x3A-\\x60`` and
``\\x7B-\\x7F``. A block is ``lines`` neighbouring lines of a text, one for each line it can
begin with; a template is a labelled text. Both are sets of words, and a block has a
template's label if it holds at least ``threshold`` of the template's words.

The words are ordered globally, by the number of blocks of the whole table that hold them,
the rarest first. A block that meets the threshold of a template of t words, needing a of
them, holds one of the template's first t - a + 1 (prefix filter) and has a words or more
(length filter); where the first word they share is the i-th of the template and the j-th
of the block, min(t - i, b - j) words are still to come and must be a or more (positional
filter). So the scan of the texts carries on only blocks with a word of some prefix, with
their ordered words, of which only those that a template has can count. These blocks are
joined with the templates' prefixes on the word, filtered, and the whole sets compared.
Every block that meets the threshold is found, once per template.

Beside it, base phrases are looked up as words in a row anywhere in the text.

Defined cases: null and blank texts have no word, empty labels and score 0; a template
without words is in no block; equal templates and equal rows each count; ties in frequency
go by the word; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written
from .text import LOWER, Words, text_chunks

THRESHOLD, LINES = 0.8, 1
_GAP = np.zeros(256, bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    _GAP[_a:_b + 1] = True

# fixed values: the contract's phrases and their labels
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

# Notices as they are commonly written; (label, text).
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("no-warranty", "The software is provided as is, without warranty of any kind, express or implied"),
    ("public-domain", "This work is released into the public domain"),
]


def words_of(texts: list[str]) -> list[list[str]]:
    w = Words(pa.array(texts, pa.string()), table=LOWER, space=_GAP)
    flat = [w.buf[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)]
    return [flat[a:b] for a, b in zip(w.first[:-1], w.first[1:])]


class _Vocabulary:
    """Hashes of some words, and of each word of a batch its number among them, or -1."""

    def __init__(self, words: list[str]):
        w = Words(pa.array(words, pa.string()), table=LOWER, space=_GAP)
        self.hash = w.hashes()
        self.order = np.argsort(self.hash)
        self.sorted = self.hash[self.order]

    def number(self, h: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.full(len(h), -1)
        i = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[i] == h, self.order[i], -1)


class _Blocks:
    """The words of a batch, and (block, word) for every word of every block."""

    def __init__(self, column: pa.Array, lines: int):
        self.w = w = Words(column, table=LOWER, space=_GAP)
        self.h, self.doc = w.hashes(), w.doc_of_word()
        breaks = np.concatenate([[0], np.cumsum(w.buf == 10)])
        top = breaks[w.offs] + np.arange(w.n + 1)                  # first line of each text, over the batch
        line = breaks[w.starts] + self.doc
        word = np.arange(len(line))
        spread = [(line - s, word, line - s >= top[self.doc]) for s in range(lines)]
        self.block = np.concatenate([b[ok] for b, _, ok in spread])
        self.word = np.concatenate([i[ok] for _, i, ok in spread])
        self.top = top


def _pairs(block: np.ndarray, number: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (block, number), sorted."""
    pair = np.unique(block * size + number)
    return pair // size, pair % size


def _frequencies(vocabulary: list[str], lines: int):
    def run(batches):
        v = _Vocabulary(vocabulary)
        for batch in text_chunks(batches, "text"):
            b = _Blocks(batch.column(0), lines)
            number = v.number(b.h)[b.word]
            found = number >= 0
            _, number = _pairs(b.block[found], number[found], max(1, len(vocabulary)))
            n = np.bincount(number, minlength=len(vocabulary))
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([vocabulary[i] for i in at], pa.string()), pa.array(n[at])], names=["word", "n"])
    return run


def block_frequencies(docs: DataFrame, vocabulary: list[str], lines: int = LINES) -> dict[str, int]:
    """The number of blocks of the table that hold each word of ``vocabulary``."""
    rows = docs.select("text").mapInArrow(_frequencies(vocabulary, lines), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {w: 0 for w in vocabulary} | dict(map(tuple, rows))


_SCAN = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
         "blocks array<struct<line: int, size: int, words: array<int>>>")


def _scan(base: list[tuple[str, str]], ordered: list[str], prefixes: set[str], lines: int):
    """One row a text: its words, base phrases, and the blocks that hold a word of a prefix."""
    rare = np.array([w in prefixes for w in ordered], bool)

    def run(batches):
        v = _Vocabulary(ordered)
        phrases = []
        for label, text in base:
            phrases.append((label, Words(pa.array([text], pa.string()), table=LOWER, space=_GAP).hashes()))
        for batch in text_chunks(batches, "text"):
            b = _Blocks(batch.column(1), lines)
            w, n = b.w, b.w.n
            n_base, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            labels = [set() for _ in range(n)]
            for label, h in phrases:
                m = max(0, len(b.h) - len(h) + 1)
                hit = b.doc[:m] == b.doc[len(b.h) - m:]
                for i, x in enumerate(h):
                    hit &= b.h[i:i + m] == x
                at = np.flatnonzero(hit)
                doc, place = b.doc[at], at - w.first[b.doc[at]]
                np.add.at(n_base, doc, 1)
                np.minimum.at(first, doc, place)
                np.maximum.at(last, doc, place)
                for d in np.unique(doc):
                    labels[d].add(label)
            number = v.number(b.h)[b.word]
            known = number >= 0
            wanted = np.unique(b.block[known][rare[number[known]]])
            size = np.bincount(np.searchsorted(wanted, b.block[np.isin(b.block, wanted)]), minlength=len(wanted))
            known &= np.isin(b.block, wanted)
            block, number = _pairs(b.block[known], number[known], max(1, len(ordered)))
            cuts = np.concatenate([np.searchsorted(block, wanted), [len(block)]])
            doc = np.searchsorted(b.top, wanted, side="right") - 1
            blocks = pa.StructArray.from_arrays(
                [pa.array((wanted - b.top[doc]).astype(np.int32)), pa.array(size.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(number.astype(np.int32)))], ["line", "size", "words"])
            none = n_base == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(w.counts().astype(np.int64)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                 pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                 pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)), blocks)],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"])
    return run


def scan(docs: DataFrame, templates=None, base=None, threshold: float = THRESHOLD, lines: int = LINES) -> tuple[DataFrame, DataFrame]:
    """(texts, matches). ``texts``: row, doc_id, n_words, n_base, first_word, last_word,
    base_labels, one row a text. ``matches``: row, doc_id, line, label, template, shared,
    containment, for every block that meets the threshold of a template."""
    share = Fraction(str(threshold))
    if not 0 < share <= 1 or lines < 1:
        raise ValueError("threshold must be above 0 and at most 1, lines at least 1")
    templates, base = TEMPLATES if templates is None else templates, BASE if base is None else base
    sets = [sorted(set(ws)) for ws in words_of([t for _, t in templates])]
    vocabulary = sorted({w for ws in sets for w in ws})
    often = block_frequencies(docs, vocabulary, lines) if vocabulary else {}
    ordered = sorted(vocabulary, key=lambda w: (often[w], w))
    place = {w: i for i, w in enumerate(ordered)}
    index, prefixes = [], set()
    for k, ((label, _), ws) in enumerate(zip(templates, sets)):
        need = -(-share.numerator * len(ws) // share.denominator)
        ws = sorted(ws, key=place.get)
        for i, x in enumerate(ws[:len(ws) - need + 1]):
            prefixes.add(x)
            index.append((place[x], i, k, label, need, [place[y] for y in ws]))
    index = docs.sparkSession.createDataFrame(index, "word int, i int, template int, label string, need int, whole array<int>")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(_scan(base, ordered, prefixes, lines), _SCAN)
    texts = written(texts.withColumn("row", F.monotonically_increasing_id()), "scan")
    blocks = texts.select("row", "doc_id", F.explode("blocks").alias("b")) \
        .select("row", "doc_id", "b.line", "b.size", "b.words", F.posexplode("b.words").alias("j", "word"))
    shared = F.array_intersect("words", "whole")
    matches = blocks.join(index, "word") \
        .filter((F.col("size") >= F.col("need"))
                & (F.least(F.size("whole") - F.col("i"), F.size("words") - F.col("j")) >= F.col("need"))) \
        .filter(shared[0] == F.col("word")).withColumn("shared", F.size(shared)).filter(F.col("shared") >= F.col("need")) \
        .select("row", "doc_id", "line", "label", "template", "shared", (F.col("shared") / F.size("whole")).alias("containment"))
    return texts.drop("blocks"), matches


def licenses(docs: DataFrame, **params) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score): a row for
    each text. ``labels`` are the base labels and those of the templates found; ``score`` is
    the greatest containment found, 1 where a base phrase is, 0 where nothing is."""
    texts, matches = scan(docs, **params)
    found = matches.groupBy(F.col("row").alias("r")).agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    none = F.array().cast("array<string>")
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return texts.join(found, F.col("row") == F.col("r"), "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined("base_labels").alias("base_labels"),
        joined(F.array_union("base_labels", F.coalesce("found", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
