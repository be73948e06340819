"""Operator 1, quality rules: cross-document line frequency.

Each line is normalised (ASCII lower case, runs of white space as one space, digits as
``0``) and hashed. Per host (the ``source`` column) the distinct documents that carry a
line are counted, exact copies of a text counting once. A line above both limits
(``min_docs`` documents and ``max_share`` of the host's distinct documents), or above
``enough_docs`` documents whatever the host's size, is removed from every document of the
host but the earliest (least ``doc_id``) that has it, so that no content goes altogether.
Without ``enough_docs`` (the default) a line must be above both limits; the query and the
pipeline's stage give ``ENOUGH_DOCS``. A document with fewer than ``min_words`` words or less than
``min_left`` of its words afterwards is depleted and rejected, as is one that fails the
base rules (under 10 words, or over 20 % of them in repeated 5-word windows).

Defined cases: a null or blank text has no words and fails the base rules; a null host is
a host of its own; a null ``doc_id`` is never the earliest; rows that repeat a document
get the same verdict each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import null_safe, unused, written
from .text import SPACE, Words, lists, mix, runs_hash, text_chunks

MIN_DOCS, MAX_SHARE, ENOUGH_DOCS = 5, 0.10, 20
MIN_WORDS, MIN_LEFT = 10, 0.3
_PROFILE = ("doc_id long, source string, text_key long, n_words long, word_chars long, n_symbols long, "
            "n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<long>")
_SYMBOLS = b"#*$%&|<>"
_DIGITS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")


def normal_line(line: bytes) -> bytes:
    return b" ".join(line.translate(_DIGITS).split())


def line_hash(line: bytes) -> int:
    """Signed 64-bit hash of a normalised line."""
    h = xxhash.xxh3_64_intdigest(line)
    return h - (1 << 64) if h >> 63 else h


def repeat_words(w: Words, k: int = 5) -> np.ndarray:
    """Per text, its words inside k-word windows found twice or more in that text. Window
    hashes pick the texts that may have any; those are then counted on their words."""
    out = np.zeros(w.n, np.int64)
    doc = w.doc_of_word()
    runs = runs_hash(w.hashes(), k)
    whole = doc[:len(runs)] == doc[k - 1:] if len(runs) else np.zeros(0, bool)
    at = doc[:len(runs)][whole]
    key = mix(runs[whole] + at.astype(np.uint64))
    ranked = np.sort(key)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    for i in np.unique(at[np.isin(key, twice)]) if len(twice) else ():
        words = w.raw[w.offs[i]:w.offs[i + 1]].tobytes().split()
        windows = list(zip(*(words[j:] for j in range(k))))
        often = {x for x, n in Counter(windows).items() if n > 1}
        step = np.zeros(len(words) + 1, np.int64)
        starts = np.flatnonzero(np.fromiter((x in often for x in windows), bool, len(windows)))
        np.add.at(step, starts, 1)
        np.add.at(step, starts + k, -1)
        out[i] = (np.cumsum(step[:-1]) > 0).sum()
    return out


def _profiles(batches):
    for batch in text_chunks(batches):
        w = Words(batch.column(1))
        counts = w.counts()
        raw, offs = w.raw.tobytes(), w.offs
        # code points: bytes that don't continue one; those outside words are all ASCII
        heads = np.concatenate([[0], np.cumsum((w.raw & 0xC0) != 0x80)])
        blanks = np.concatenate([[0], np.cumsum(SPACE[w.raw])])
        chars = np.diff(heads[offs]) - np.diff(blanks[offs])
        symbols, dups, lh, lw, bounds = [], [], [], [], [0]
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
            text = raw[a:b]
            symbols.append(len(text) - len(text.translate(None, _SYMBOLS)))
            own = [x for x in text.split(b"\n") if x.strip()]
            dups.append(len(own) - len(set(own)))
            per: dict[int, int] = {}
            for x in own:
                norm = normal_line(x)
                key = line_hash(norm)
                per[key] = per.get(key, 0) + norm.count(b" ") + 1
            lh.extend(per)
            lw.extend(per.values())
            bounds.append(len(lh))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.array(counts, pa.int64()),
             pa.array(chars, pa.int64()), pa.array(symbols, pa.int64()), pa.array(dups, pa.int64()),
             pa.array(repeat_words(w), pa.int64()),
             lists(np.array(lh, np.int64), np.array(bounds), pa.int64()),
             lists(np.array(lw, np.int64), np.array(bounds), pa.int64())],
            names=["doc_id", "source", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                   "n_repeat_words", "lines", "line_words"])


def text_key(column: str):
    """64-bit key of a whole text; a null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def profile(docs: DataFrame) -> DataFrame:
    """One row per document: base measures and its distinct normalised lines' hashes."""
    return docs.select("doc_id", "text", "source", text_key("text").alias("text_key")).mapInArrow(_profiles, _PROFILE)


def frequent_lines(prof: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
                   enough_docs: int | None = None) -> DataFrame:
    """(host, line, first_doc) of the lines above the limits. Both counts pre-aggregate
    before their shuffle, so a hot host or line is spread."""
    lines = prof.select("source", "text_key", "doc_id", F.explode("lines").alias("line"))
    per_text = lines.groupBy("source", "line", "text_key").agg(F.min("doc_id").alias("doc_id"))
    count = per_text.groupBy("source", "line").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first_doc")) \
        .filter(F.col("docs") > (min_docs if enough_docs is None else min(min_docs, enough_docs)))
    hosts = prof.groupBy("source", "text_key").agg(F.lit(1).alias("one")) \
        .groupBy(F.col("source").alias("host")).agg(F.count("*").alias("host_docs"))
    hot = (F.col("docs") > min_docs) & (F.col("docs") > F.col("host_docs") * F.lit(max_share))
    if enough_docs is not None:
        hot = hot | (F.col("docs") > enough_docs)
    return null_safe(count, hosts, {"source": "host"}, "inner").filter(hot) \
        .select(F.col("host"), F.col("line").alias("hot_line"), "first_doc", "docs")


def verdicts(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
             min_words: int = MIN_WORDS, min_left: float = MIN_LEFT, enough_docs: int | None = None) -> DataFrame:
    """One row per document: doc_id, text_key, base measures, removed line hashes, words
    removed, base_failed, kept."""
    prof = written(profile(docs), "profile")
    hot = frequent_lines(prof, min_docs, max_share, enough_docs)
    lines = prof.filter(F.size("lines") > 0).select(
        "doc_id", "source", "text_key", F.explode(F.arrays_zip("lines", "line_words")).alias("x")) \
        .select("doc_id", "source", "text_key", F.col("x.lines").alias("line"), F.col("x.line_words").alias("w"))
    gone = null_safe(lines, hot, {"source": "host", "line": "hot_line"}, "inner") \
        .filter(~F.col("doc_id").eqNullSafe(F.col("first_doc"))) \
        .groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("source").alias("s")) \
        .agg(F.collect_set(F.struct("line", "w")).alias("x")) \
        .select("d", "t", "s", F.col("x.line").alias("removed"),
                F.aggregate("x", F.lit(0).cast("long"), lambda a, y: a + y["w"]).alias("gone_words"))
    left = F.col("n_words") - F.coalesce("gone_words", F.lit(0))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return null_safe(prof.drop("lines", "line_words"), gone, {"doc_id": "d", "text_key": "t", "source": "s"}, "left") \
        .select("doc_id", "source", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                failed.alias("base_failed"),
                (~failed & (left >= min_words) & (left >= F.col("n_words") * F.lit(min_left))).alias("kept"),
                F.coalesce("gone_words", F.lit(0)).alias("n_removed_words"),
                F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed_lines"), "removed")


def _strip(batches):
    """Texts without the lines whose hash is in ``removed`` (the last column)."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts, gone = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
        out = [t if not g or t is None else "\n".join(
            x for x in t.split("\n") if not x.strip(" \t\n\r\x0b\x0c") or line_hash(normal_line(x.encode())) not in g)
            for t, g in zip(texts, map(set, (x or () for x in gone)))]
        cols = [pa.array(out, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])


def apply(docs: DataFrame, **limits) -> DataFrame:
    """The kept documents, same columns, with the lines above the limits taken out."""
    key, d, t, s, gone = unused(docs, "_key", "_d", "_t", "_s", "_gone")
    v = written(verdicts(docs, **limits).filter("kept")
                .groupBy(F.col("doc_id").alias(d), F.col("source").alias(s), F.col("text_key").alias(t))
                .agg(F.first("removed").alias(gone)), "verdicts")
    found = null_safe(docs.withColumn(key, text_key("text")), v, {"doc_id": d, "source": s, key: t}, "inner")
    return found.select(*docs.columns, gone).mapInArrow(_strip, docs.schema)
