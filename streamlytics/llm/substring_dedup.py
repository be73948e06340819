"""Operator 10, substring dedup by sliding sentence spans.

Words are lower-cased (ASCII). A sentence ends at a word that ends in ``.``, ``!`` or ``?``,
at a line end, and at the text's end; a sentence of more than ``LONG`` words also ends at
each word whose hash is a multiple of 16, so that text without stops is cut at the same
places wherever it stands. From every sentence and to every sentence the shortest run of at
least ``min_words`` words is hashed (128 bits); a run has at least ``min_sentences``
sentences, or is one that has ``min_words`` by itself.

Of the words that begin in a sentence of more than ``LONG`` words also every ``min_words`` in
a row are a run where a repeat ends: of each ``NEAR`` neighbouring ones those of the least hash are
joined first, which finds any passage of ``min_words + NEAR - 1`` words wherever it begins;
where the removed runs of a text leave off, those within ``NEAR`` words of the last (or
first) of them, and of the place it stands in first, are joined, too, which gives the
passage's exact first and last word.

Runs are joined over all documents; each but the first, by (doc_id, text key, place), covers
sentences to remove. Covered stretches of a document are merged into ranges of bytes of its
UTF-8 text.

Most runs stand in one place only. So the texts are read twice: first only the 64-bit hashes
are counted, then the runs whose hash was found again are made, with places and second hash,
and only they are written.

Defined cases: null and blank texts have no sentence; null ``doc_id`` come last; texts that
share a ``doc_id``, or have none, are documents of their own, told apart by the 64-bit key of
their text; rows that repeat both share their places, so neither is a copy of the other; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quality_rules import text_key
from .tables import null_safe, unused, written
from .text import Words, runs_hash, signed, text_chunks

MIN_SENTENCES, MIN_WORDS, LONG, NEAR = 2, 20, 20, 30
_LAST = (1 << 63) - 1
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True


def least_of_each(value: np.ndarray, row: np.ndarray, k: int = NEAR) -> np.ndarray:
    """Marks the values that are the least of some k in neighbouring rows."""
    out = np.zeros(len(row), bool)
    if len(row) >= k:
        least = np.lib.stride_tricks.sliding_window_view(value, k).min(axis=1)
        whole = row[k - 1:] - row[:len(least)] == k - 1
        for i in range(k):
            out[i:i + len(least)] |= whole & (value[i:i + len(least)] == least)
    return out


def sentence_spans(w: Words, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS, found=None, bases=_BASES):
    """(text index, first byte, end byte, open ends, a hash for each of ``bases``) of every run; open
    ends: 1 if a run of words may begin before it, 2 if one may end behind it, or their sum.
    With ``found``, two lists for each text, only the runs of words that end behind the end
    bytes of the first or begin before the first bytes of the second."""
    n = len(w.starts)
    empty = np.zeros(0, np.int64)
    if not n:
        return empty, empty, empty, empty, *[empty.astype(np.uint64) for _ in bases]
    h, doc = w.hashes(), w.doc_of_word()
    lines = np.concatenate([[0], np.cumsum(w.buf == 10)])
    last = np.ones(n, bool)
    last[:-1] = (doc[1:] != doc[:-1]) | (lines[w.starts[1:]] > lines[w.ends[:-1]])
    last |= _STOPS[w.buf[w.ends - 1]]
    close = np.flatnonzero(last)
    length = np.diff(np.concatenate([[-1], close]))
    long = np.repeat(length > LONG, length)
    last |= long & (h % np.uint64(16) == 0)
    close = np.flatnonzero(last) + 1                      # word bounds of sentence j: open[j]:close[j]
    start = np.concatenate([[0], close[:-1]])
    sdoc = doc[start]
    # the shortest run from sentence j ends with e, the shortest one to e begins with j
    own = np.arange(len(start))
    more = np.where(close - start >= min_words, 0, min_sentences - 1)
    ahead = np.maximum(np.searchsorted(close, start + min_words), own + more)
    back = np.minimum(np.searchsorted(start, close - min_words, side="right") - 1, own - more)
    ok = (ahead < len(start), back >= 0)
    j = np.concatenate([own[ok[0]], back[ok[1]]])
    e = np.concatenate([ahead[ok[0]], own[ok[1]]])
    whole = sdoc[j] == sdoc[e]
    # rows of min_words words that begin in a long sentence
    row = np.arange(max(0, n - min_words + 1))
    fits = np.append(long[row] & (doc[row] == doc[row + min_words - 1]), False)
    row = row[fits[:-1]]
    if found is None:
        row = row[least_of_each(runs_hash(h, min_words)[row], row)]
        pair = np.unique((j * len(start) + e)[whole])
        a = np.concatenate([start[pair // len(start)], row])
        b = np.concatenate([close[pair % len(start)], row + min_words])
    else:
        near = np.zeros(n + 1, np.int64)
        words = [np.searchsorted(flat, np.concatenate([empty, *(w.offs[i] + np.array(x, np.int64) for i, x in enumerate(asked))]))
                 for flat, asked in zip((w.ends, w.starts), found)]
        for first in (words[0] - min_words + 2, words[1] - NEAR):
            np.add.at(near, np.clip(first, 0, n), 1)
            np.add.at(near, np.clip(first + NEAR, 0, n), -1)
        a = row[np.cumsum(near)[row] > 0]
        b = a + min_words
    opened = np.where(a > 0, fits[np.clip(a - 1, 0, len(fits) - 1)], False) + 2 * fits[np.clip(b - min_words + 1, 0, len(fits) - 1)]
    # a run's hash from prefix sums of its words' hashes times powers of an odd base
    out = [doc[a], w.starts[a] - w.offs[doc[a]], w.ends[b - 1] - w.offs[doc[a]], opened]
    for base in bases:
        up = np.full(n, np.uint64(base), np.uint64)
        up[0] = 1
        up = np.multiply.accumulate(up)
        down = np.full(n, np.uint64(pow(base, -1, 1 << 64)), np.uint64)
        down[0] = 1
        down = np.multiply.accumulate(down)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((h ^ np.uint64(base)) * up, out=total[1:])
        out.append(runs_hash((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64), 1))
    return tuple(out)


def _hashes(min_sentences: int, min_words: int, near: bool):
    """The first hash of every run."""
    def run(batches):
        for batch in text_chunks(batches):
            found = [batch.column(i).to_pylist() for i in (3, 4)] if near else None
            *_, h1 = sentence_spans(Words(batch.column(2), lower=True), min_sentences, min_words, found, _BASES[:1])
            yield pa.RecordBatch.from_arrays([pa.array(signed(h1))], names=["h1"])
    return run


def _spans(min_sentences: int, min_words: int, near: bool):
    def run(batches):
        for batch in text_chunks(batches):
            found = [batch.column(i).to_pylist() for i in (3, 4)] if near else None
            at, b0, b1, opened, h1, h2 = sentence_spans(Words(batch.column(2), lower=True), min_sentences, min_words, found)
            row = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(h1)), pa.array(signed(h2)), batch.column(0).take(row), batch.column(1).take(row),
                 pa.array(b0.astype(np.int32)), pa.array(b1.astype(np.int32)), pa.array(opened.astype(np.int8))],
                names=["h1", "h2", "doc", "key", "b0", "b1", "opened"])
    return run


def _repeats(docs: DataFrame, name: str, min_sentences: int, min_words: int, near: bool = False):
    """The runs of ``docs`` whose hash is found at two places or more, with the first of them."""
    rule = (min_sentences, min_words, near)
    # written, so that the joins below read two plain shuffles and can split a hot run
    again = written(docs.mapInArrow(_hashes(*rule), "h1 long").groupBy("h1").agg(F.count("*").alias("c"))
                    .filter("c > 1").select("h1"), f"{name}-hashes")
    spans = written(docs.mapInArrow(_spans(*rule), "h1 long, h2 long, doc long, key long, b0 int, b1 int, opened byte")
                    .join(again, "h1", "left_semi"), name)
    place = F.struct("doc", "key", "b0", "b1")
    first = written(spans.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                    .filter(F.col("first") != F.col("last")).select("h1", "h2", "first"), f"{name}-repeated")
    return spans.join(first, ["h1", "h2"])


def repeated_ranges(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, start_byte, end_byte, n_spans, first_doc_id): the ranges to remove; of
    the documents their removed runs stand in first, the least."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), text_key("text").alias("key"), "text")
    place = F.struct("doc", "key", "b0", "b1")
    runs = _repeats(docs, "spans", min_sentences, min_words)
    later = written(runs.filter(place != F.col("first")), "later")
    # where the removed runs of a text leave off and words may follow, and where these runs stand first
    order = Window.partitionBy("doc", "key").orderBy("b0", "b1")
    before = Window.unboundedPreceding
    ends = F.coalesce(F.lead("b0").over(order) > F.max("b1").over(order.rowsBetween(before, 0)), F.lit(True))
    begins = F.coalesce(F.col("b0") > F.max("b1").over(order.rowsBetween(before, -1)), F.lit(True))
    edges = later.withColumn("ends", ends & (F.col("opened") >= 2)).withColumn("begins", begins & (F.col("opened") % 2 == 1)) \
        .filter("ends or begins").select(F.explode(F.array(place, F.col("first"))).alias("at"), "ends", "begins")
    found = edges.groupBy(F.col("at.doc").alias("d"), F.col("at.key").alias("k")).agg(
        F.collect_set(F.when(F.col("ends"), F.col("at.b1"))).alias("ends"), F.collect_set(F.when(F.col("begins"), F.col("at.b0"))).alias("begins"))
    asked = docs.join(found, (docs["doc"] == F.col("d")) & (docs["key"] == F.col("k"))).select("doc", "key", "text", "ends", "begins")
    exact = _repeats(written(asked, "asked"), "near", min_sentences, min_words, near=True).filter(place != F.col("first"))
    later = later.unionByName(exact).groupBy("doc", "key", "b0", "b1").agg(F.min("first.doc").alias("keeper"))
    reach = F.max("b1").over(order.rowsBetween(before, -1))
    part = F.sum(F.when(F.col("b0") <= F.col("reach"), 0).otherwise(1)).over(order)
    named = lambda c, n: F.when(F.col(c) != _LAST, F.col(c)).alias(n)
    return later.withColumn("reach", reach).withColumn("part", part) \
        .groupBy("doc", "key", "part").agg(F.min("b0").alias("start_byte"), F.max("b1").alias("end_byte"),
                                           F.count("*").alias("n_spans"), F.min("keeper").alias("keeper")) \
        .select(named("doc", "doc_id"), F.col("key").alias("text_key"), "start_byte", "end_byte", "n_spans", named("keeper", "first_doc_id"))


def _cut(batches):
    for batch in batches:
        at = batch.schema.get_field_index("text")
        out = []
        for text, ranges in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            if text is not None and ranges:
                raw, parts, end = text.encode(), [], 0
                for x in sorted(ranges, key=lambda x: x["start_byte"]):
                    parts.append(raw[end:x["start_byte"]])
                    end = x["end_byte"]
                text = b"".join([*parts, raw[end:]]).decode()
            out.append(text)
        cols = [pa.array(out, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])


def apply(docs: DataFrame, **params) -> DataFrame:
    """All documents, same columns, without the sentences of repeated runs."""
    d, k, t, cuts = unused(docs, "_d", "_k", "_t", "_ranges")
    ranges = repeated_ranges(docs, **params).groupBy(F.col("doc_id").alias(d), F.col("text_key").alias(k)) \
        .agg(F.collect_list(F.struct("start_byte", "end_byte")).alias(cuts))
    return null_safe(docs.withColumn(t, text_key("text")), ranges, {"doc_id": d, t: k}, "left").drop(d, k, t).mapInArrow(_cut, docs.schema)
