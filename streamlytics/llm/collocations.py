"""Operator 12, phrase collocations by prefix-free parsing.

Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, those at spaces
and tabs into words; a phrase lies within one piece. The words of a text are parsed into
overlapping chunks: a chunk begins with the text and wherever the hash of the next
``max_words - 1`` words is a multiple of ``PERIOD``, and it reaches to the end of the next
such window, so what a chunk holds, not where it stands, decides its cuts, and copied text
gives the same chunks. The dictionary of distinct chunks with their parse frequencies is
written once. A phrase occurrence belongs to the chunk in which it begins before the last
window (in a text's last chunk: anywhere), where all of it lies: overlaps count once.

Phrases are counted inside the dictionary's chunks, weighted by their frequencies, in passes
over it: words; pairs of frequent words; triples of frequent pairs; longer phrases all of
whose triples are frequent. A part of a frequent phrase is frequent, so nothing is lost, and
the phrases themselves are counted, not hashes. What a pass needs of the one before is a
bitmap of ``BITS`` bits, whatever the data's size; a bit set by chance only lets a rare
phrase be counted, which then fails.

Phrases of 2 or more words with ``min_count`` are candidates; those inside a longer one that
is as frequent go. The rest are scored by their lowest cut, floor(1000 a n / (l r)), in
decimals, and each language's first ``top`` by score, count and phrase are returned; they
are ranked in salted parts first.

Defined cases: a null ``lang`` is ``und``; null and blank texts have no word; equal rows each
count; ties in score and count go by the phrase's bytes; a text without a trigger is one
chunk; an empty table gives an empty result; other columns are not read. Inside one batch
of at most 4 MB phrases are told apart by a 64-bit hash.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import written
from .text import LOWER, Words, mix, runs_hash, signed, text_chunks

MIN_COUNT, TOP, MAX_WORDS, PERIOD = 100, 2000, 5, 32
BITS = 1 << 24
_PARTS = 256
_BREAK = 10
_PIECES = LOWER.copy()
_PIECES[list(b".,;:!?\x0a\x0b\x0c\x0d")] = _BREAK


def _chunks(overlap: int, period: int):
    def run(batches):
        for batch in text_chunks(batches, "text"):
            w = Words(batch.column(1), table=_PIECES)
            n = len(w.starts)
            if not n:
                continue
            doc = w.doc_of_word()
            first = np.concatenate([[True], doc[1:] != doc[:-1]])
            begin = first.copy()
            windows = runs_hash(w.hashes(), overlap)
            begin[:len(windows)] |= (windows % np.uint64(period) == 0) & (doc[:len(windows)] == doc[overlap - 1:])
            at = np.flatnonzero(begin)
            last = np.append(first[at[1:]], True)                  # the text ends with this chunk
            end = np.append(at[1:], n) + np.where(last, 0, overlap)
            # one byte between words: a space, or a break between pieces
            breaks = np.concatenate([[0], np.cumsum(w.buf == _BREAK)])
            inner = np.flatnonzero(~first)
            joint = w.starts[inner] - 1
            keep = np.zeros(len(w.buf) + 1, np.int64)
            keep[w.starts] += 1
            keep[w.ends] -= 1
            keep = np.cumsum(keep)[:-1].astype(bool)
            keep[joint] = True
            text = w.buf.copy()
            text[joint] = np.where(breaks[w.starts[inner]] > breaks[w.ends[inner - 1]], _BREAK, 32)
            place = np.concatenate([[0], np.cumsum(keep)])
            flat = text[keep].tobytes()
            chunks = [flat[a:b] for a, b in zip(place[w.starts[at]].tolist(), place[w.ends[end - 1]].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc[at])), pa.array(chunks, pa.string()), pa.array(last, pa.bool_())],
                names=["lang", "chunk", "last"])
    return run


def dictionary(docs: DataFrame, max_words: int = MAX_WORDS, period: int = PERIOD) -> DataFrame:
    """(lang, chunk, last, freq): the distinct chunks and how often each stands in the parse;
    ``last``: it ends a text. Words are joined by a space, pieces by a line end."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    parse = texts.mapInArrow(_chunks(max_words - 1, period), "lang string, chunk string, last boolean")
    return parse.groupBy("lang", "chunk", "last").agg(F.count("*").alias("freq"))


def _hashes(w: Words, lang: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word in its row's language."""
    codes = lang.dictionary_encode()
    salt = np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in codes.dictionary.to_pylist()], np.uint64)
    return mix(w.hashes() ^ salt[np.asarray(codes.indices)[w.doc_of_word()]]) if len(w.starts) else np.zeros(0, np.uint64)


class _Phrases:
    """The words of a batch of chunks, the pieces they are in, and what each is worth."""

    def __init__(self, batch: pa.RecordBatch, overlap: int):
        self.w = w = Words(batch.column(1))
        self.lang, self.row = batch.column(0), w.doc_of_word()
        self.h = _hashes(w, self.lang)
        left = w.first[1:][self.row] - np.arange(len(self.h))      # words to the chunk's end
        self.own = np.asarray(batch.column(2).cast(pa.int8())).astype(bool)[self.row] | (left > overlap)
        breaks = np.concatenate([[0], np.cumsum(w.buf == _BREAK)])
        self.piece = breaks[w.starts] + self.row
        self.freq = np.asarray(batch.column(3))[self.row]
        self.flat = w.raw.tobytes()

    def starts(self, k: int) -> np.ndarray:
        """Word positions at which a phrase of k words begins that belongs to its chunk."""
        m = max(0, len(self.h) - k + 1)
        return np.flatnonzero(self.own[:m] & (self.piece[:m] == self.piece[k - 1:]))

    def within(self, at: np.ndarray, k: int, part: int, bits: np.ndarray) -> np.ndarray:
        """Of the phrases of k words at ``at`` those all of whose ``part`` words in a row are marked."""
        marked = _has(bits, runs_hash(self.h, part))
        for i in range(k - part + 1):
            at = at[marked[at + i]]
        return at

    def texts(self, at: np.ndarray, k: int) -> pa.Array:
        return pa.array([self.flat[a:b] for a, b in zip(self.w.starts[at].tolist(), self.w.ends[at + k - 1].tolist())], pa.string())

    def counted(self, at: np.ndarray, k: int) -> pa.RecordBatch:
        """(lang, phrase, c) of the different phrases of k words at ``at``."""
        key, first, back = np.unique(runs_hash(self.h, k)[at], return_index=True, return_inverse=True)
        c = np.rint(np.bincount(back, self.freq[at], len(key))).astype(np.int64)
        at = at[first]
        return pa.RecordBatch.from_arrays([self.lang.take(pa.array(self.row[at])), self.texts(at, k), pa.array(c)], names=["lang", "phrase", "c"])


def _has(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    x = key % np.uint64(BITS)
    return (bits[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counts(overlap: int, sizes: list[int], part: int, bits: np.ndarray | None):
    """Counts of the phrases of some sizes; with ``bits`` only of those whose parts are marked."""
    def run(batches):
        for batch in text_chunks(batches, "chunk"):
            p = _Phrases(batch, overlap)
            for k in sizes:
                at = p.starts(k)
                yield p.counted(at if bits is None else p.within(at, k, part, bits), k)
    return run


def _keys(k: int):
    """The hash of each phrase, all of k words, as ``_Phrases`` makes it."""
    def run(batches):
        for batch in batches:
            w = Words(batch.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(signed(runs_hash(_hashes(w, batch.column(0)), k)[w.first[:-1]]))], names=["key"])
    return run


def bitmap(phrases: DataFrame, k: int) -> np.ndarray:
    """The bitmap of some phrases (lang, phrase) of k words: BITS / 8 bytes whatever their number."""
    place = F.pmod(F.col("key"), F.lit(BITS)) + 1
    rows = phrases.select("lang", "phrase").mapInArrow(_keys(k), "key long") \
        .groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m"))
    out = np.zeros(BITS // 8, np.uint8)
    for b, m in rows.collect():
        out[(b - 1) * 4096:b * 4096] = np.frombuffer(m, np.uint8)
    return out


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of every phrase of 1 to ``max_words`` words found ``min_count`` times or
    more, and (lang, n) with the number of words of each language."""
    chunks = written(dictionary(docs, max_words), "chunks")

    def count(sizes: list[int], part: int, bits: np.ndarray | None) -> DataFrame:
        return chunks.mapInArrow(_counts(max_words - 1, sizes, part, bits), "lang string, phrase string, c long") \
            .groupBy("lang", "phrase").agg(F.sum("c").alias("f"))
    words = written(count([1], 0, None), "words")
    found = words.filter(F.col("f") >= min_count)
    phrases, bits = found, bitmap(found, 1)
    for k in range(2, min(3, max_words) + 1):
        found = written(count([k], k - 1, bits).filter(F.col("f") >= min_count), f"phrases-{k}")
        phrases, bits = phrases.unionByName(found), bitmap(found, k)
    if max_words > 3:
        phrases = phrases.unionByName(count(list(range(4, max_words + 1)), 3, bits).filter(F.col("f") >= min_count))
    return written(phrases, "phrases"), words.groupBy("lang").agg(F.sum("f").alias("n"))


def _words(c: str):
    return F.split(c, " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` candidates."""
    if max_words < 2:
        raise ValueError("max_words must be at least 2")
    phrases, totals = phrase_counts(docs, min_count, max_words)
    size = F.size(_words("phrase"))
    cand = phrases.filter(size > 1).withColumnRenamed("f", "a")
    # a longer phrase that is as frequent has an extension by one word that is, too
    inside = cand.filter(size > 2).select("lang", F.explode(F.array(
        F.array_join(F.slice(_words("phrase"), F.lit(1), size - 1), " "),
        F.array_join(F.slice(_words("phrase"), F.lit(2), size - 1), " "))).alias("phrase"), F.col("a").alias("longer")) \
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    cand = cand.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).drop("longer")
    ws = _words("phrase")
    cuts = cand.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(ws, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(ws, F.col("k") + 1, size), " ").alias("rest"))
    part = lambda name, c: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(c))
    scored = cuts.join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang") \
        .withColumn("score", F.expr("cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)) "
                                    "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")) \
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))).orderBy(*order)
    first = best.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
