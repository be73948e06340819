"""Operator 2, near-duplicate line dedup by a deletion-neighbourhood join.

Lines (the ``\\n``-split) are sequences of words; edit distance counts words put in, left
out or replaced. A document is a (doc_id, text); a line with an earlier line (by the first
place, (doc_id, text key, line number), of either) within the bound is removed wherever it stands; of equal lines only the first place
stays. The bound is 1 for lines of at least ``min_words`` words, 0 for shorter ones, where
one word changes too much. Lines without a word always stay.

Two lines within one edit have a common variant with at most one word deleted: a replaced
word is deleted at the same place of both, a word put in is deleted from the longer line.
So each line emits itself and all its one-word deletions as 128-bit hashes; lines meet on
(variant, place) or, one of them whole, on the variant. Each group carries only the least
place up, never pairs, so a group of any size costs its rows. The keeper found is verified
on the words.

A line emits its deletions only if it can have a partner: of two lines within one edit,
the shorter of L words, either the first L // 2 words are equal or the last L - L // 2 are.
Each line emits these halves' hashes for L = its length and one less; lines whose halves
are all unique have no partner, and nothing else is left out.

Defined cases: null and blank texts have no line; null ``doc_id`` come last; texts that share
a ``doc_id``, or have none, are documents of their own, told apart by the 64-bit key of
their text; rows that repeat both share their places, so neither is a copy of the other's;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality_rules import text_key
from .tables import null_safe, unused, written
from .text import Words, mix, signed, text_chunks

MIN_WORDS = 8
_HALVES = ("h1", "h2", "h3", "h4")
_LAST = (1 << 63) - 1
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Sums:
    """Prefix sums of word hashes, from which any run's hash follows."""

    def __init__(self, h: np.ndarray, base: int):
        n = len(h) + 2
        self.up, self.down = np.full(n, np.uint64(base)), np.full(n, np.uint64(pow(base, -1, 1 << 64)))
        self.up[0] = self.down[0] = 1
        self.up, self.down = np.multiply.accumulate(self.up), np.multiply.accumulate(self.down)
        self.total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h ^ np.uint64(base)) * self.up[:len(h)], out=self.total[1:])

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of words a..b - 1."""
        return mix((self.total[b] - self.total[a]) * self.down[a] + (b - a).astype(np.uint64))

    def without(self, a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Hash of words a..b - 1 without word p: that of the shorter sequence itself."""
        return mix((self.total[p] - self.total[a]) * self.down[a]
                   + (self.total[b] - self.total[p + 1]) * self.down[a + 1] + (b - a - 1).astype(np.uint64))


def _line_bounds(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines with words: text index, line number, first and end word."""
    doc = w.doc_of_word()
    newlines = np.concatenate([[0], np.cumsum(w.buf == 10)])
    number = newlines[w.starts] - newlines[w.offs[doc]]
    a = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])])) \
        if len(doc) else np.zeros(0, np.int64)
    return doc[a], number[a], a, np.concatenate([a[1:], [len(doc)]]).astype(np.int64) if len(a) else a


def _places(min_words: int):
    def run(batches):
        for batch in text_chunks(batches):
            w = Words(batch.column(1))
            h = w.hashes()
            doc, number, a, b = _line_bounds(w)
            one, two = (_Sums(h, x) for x in _BASES)
            n = b - a
            halves = []
            for d in (0, 1):
                ok = n - d >= min_words
                size = np.where(ok, n - d, 1)
                cut = size // 2
                tag = mix(size.astype(np.uint64))
                halves += [pa.array(signed(x), mask=~ok) for x in (one.run(a, a + cut) ^ tag,
                                                                   one.run(b - (size - cut), b) ^ mix(tag))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), batch.column(2).take(pa.array(doc)), pa.array(number.astype(np.int32)),
                 pa.array(n.astype(np.int32)), pa.array(signed(one.run(a, b))), pa.array(signed(two.run(a, b))), *halves],
                names=["doc", "key", "line", "n", "l1", "l2", *_HALVES])
    return run


def _candidate_lines(batches):
    """Of each text the asked lines (numbers in the last column), with their hashes."""
    for batch in batches:
        docs, keys, numbers, texts = [], [], [], []
        for doc, key, text, asked in zip(*(batch.column(i).to_pylist() for i in range(4))):
            lines = (text or "").split("\n")
            for i in set(asked):
                if i < len(lines):
                    docs.append(doc)
                    keys.append(key)
                    numbers.append(i)
                    texts.append(lines[i])
        for part in text_chunks([pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(keys, pa.int64()), pa.array(numbers, pa.int32()), pa.array(texts, pa.string())],
                names=["doc", "key", "line", "text"])]):
            w = Words(part.column(3))
            h = w.hashes()
            one, two = (_Sums(h, x) for x in _BASES)
            a, b = w.first[:-1], w.first[1:]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(signed(one.run(a, b))), pa.array(signed(two.run(a, b)))],
                names=["doc", "key", "line", "text", "l1", "l2"])


def _variants(batches):
    """Each line whole (place -1) and without each of its words."""
    for batch in text_chunks(batches, "text", 1 << 20):
        w = Words(batch.column(0))
        one, two = (_Sums(w.hashes(), x) for x in _BASES)
        a, b = w.first[:-1], w.first[1:]
        at = w.doc_of_word()
        p = np.arange(len(at))
        own = np.arange(w.n)
        rows = pa.array(np.concatenate([own, at]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(np.concatenate([s.run(a, b), s.without(a[at], b[at], p)]))) for s in (one, two)]
            + [pa.array(np.concatenate([np.full(w.n, -1), p - a[at]]).astype(np.int32)), batch.column(1).take(rows)],
            names=["v1", "v2", "p", "place"])


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether word sequences a and b differ by at most one edit."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def _verify(batches):
    for batch in batches:
        ok = [within_one(a.encode().split(), b.encode().split())
              for a, b in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(ok, pa.bool_())) for i in range(5)],
                                         names=["l1", "l2", "k_doc", "k_key", "k_line"])


def near_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(l1, l2, k_doc, k_key, k_line): distinct lines with an earlier line within one edit, and its place."""
    halves = lines.filter("h1 is not null").select("l1", "l2", F.explode(F.array(*_HALVES)).alias("half")) \
        .filter("half is not null")
    shared = halves.groupBy("half").agg(F.count("*").alias("c")).filter("c > 1").select("half")
    asked = halves.join(shared, "half", "left_semi").select("l1", "l2").distinct() \
        .join(lines.select("l1", "l2", "first"), ["l1", "l2"])
    per_doc = asked.groupBy(F.col("first.doc").alias("d"), F.col("first.key").alias("k")).agg(F.collect_list("first.line").alias("asked"))
    found = docs.join(per_doc, (docs["doc"] == per_doc["d"]) & (docs["key"] == per_doc["k"])).select("doc", "key", "text", "asked") \
        .mapInArrow(_candidate_lines, "doc long, key long, line int, text string, l1 long, l2 long")
    # repeated rows give a line twice
    cand = written(found.groupBy("l1", "l2").agg(F.first("text").alias("text"), F.min(F.struct("doc", "key", "line")).alias("at"))
                   .select("text", F.col("at").alias("place"), "l1", "l2"), "lines")
    place = "place struct<doc: long, key: long, line: int>"          # names a distinct line, too
    rows = cand.select("text", "place").mapInArrow(_variants, f"v1 long, v2 long, p int, {place}")
    # most variants are one line's alone; only the others are carried on
    shared = rows.groupBy("v1", "v2").agg(F.count("*").alias("c")).filter("c > 1").select("v1", "v2")
    rows = written(rows.join(shared, ["v1", "v2"], "left_semi"), "variants")
    group = rows.groupBy("v1", "v2", "p").agg(F.min("place").alias("least"))
    both = group.groupBy("v1", "v2").agg(
        F.min(F.when(F.col("p") < 0, F.col("least"))).alias("whole"), F.min(F.when(F.col("p") >= 0, F.col("least"))).alias("cut"))
    best = group.join(both, ["v1", "v2"]).select(
        "v1", "v2", "p", F.when(F.col("p") < 0, F.least("whole", "cut")).otherwise(F.least("least", "whole")).alias("best"))
    keeper = rows.join(best, ["v1", "v2", "p"]).filter(F.col("best") < F.col("place")) \
        .groupBy("place").agg(F.min("best").alias("best"))
    mine = cand.select("place", "l1", "l2", F.col("text").alias("mine"))
    other = cand.select(F.col("place").alias("best"), F.col("text").alias("other"))
    return keeper.join(mine, "place").join(other, "best") \
        .select("l1", "l2", F.col("best.doc").alias("k_doc"), F.col("best.key").alias("k_key"), F.col("best.line").alias("k_line"),
                "mine", "other").mapInArrow(_verify, "l1 long, l2 long, k_doc long, k_key long, k_line int")


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, line_no, n_words, kept_doc_id, kept_text_key, kept_line_no, distance):
    each line removed and the earliest line that stands for it."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), "text", text_key("text").alias("key"))
    places = written(docs.mapInArrow(_places(min_words), "doc long, key long, line int, n int, l1 long, l2 long, h1 long, h2 long, h3 long, h4 long"),
                     "places")
    here = F.struct("doc", "key", "line")
    lines = written(places.groupBy("l1", "l2").agg(F.min(here).alias("first"), F.max(here).alias("last"),
                                                   *[F.first(h).alias(h) for h in _HALVES]), "distinct")
    near = written(near_lines(docs, lines), "near")
    gone = written(lines.drop(*_HALVES).join(near, ["l1", "l2"], "left").filter(F.col("k_doc").isNotNull() | (F.col("first") != F.col("last"))) \
        .select("l1", "l2", "first", F.struct(F.col("k_doc").alias("doc"), F.col("k_key").alias("key"), F.col("k_line").alias("line")).alias("near"),
                F.col("k_doc").isNotNull().alias("is_near")), "gone")
    named = lambda c, n: F.when(c != _LAST, c).alias(n)
    kept = F.when(F.col("is_near"), F.col("near")).otherwise(F.col("first"))
    return places.join(gone, ["l1", "l2"]).filter(F.col("is_near") | (here != F.col("first"))) \
        .withColumn("kept", kept) \
        .select(named(F.col("doc"), "doc_id"), F.col("key").alias("text_key"), F.col("line").cast("long").alias("line_no"), F.col("n").cast("long").alias("n_words"),
                named(F.col("kept.doc"), "kept_doc_id"), F.col("kept.key").alias("kept_text_key"), F.col("kept.line").cast("long").alias("kept_line_no"),
                F.col("is_near").cast("int").alias("distance")).distinct()


def _drop(batches):
    for batch in batches:
        at = batch.schema.get_field_index("text")
        out, keep = [], []
        for text, gone in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            if text is not None and gone:
                gone = set(gone)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
                keep.append(bool(text.encode().strip()))
            else:
                keep.append(True)
            out.append(text)
        cols = [pa.array(out, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))


def apply(docs: DataFrame, **params) -> DataFrame:
    """The documents without their removed lines, same columns; one that loses all goes."""
    d, k, t, lines = unused(docs, "_d", "_k", "_t", "_gone")
    gone = removed_lines(docs, **params).groupBy(F.col("doc_id").alias(d), F.col("text_key").alias(k)) \
        .agg(F.collect_list("line_no").alias(lines))
    return null_safe(docs.withColumn(t, text_key("text")), gone, {"doc_id": d, t: k}, "left").drop(d, k, t).mapInArrow(_drop, docs.schema)
