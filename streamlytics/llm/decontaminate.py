"""Operator 4, benchmark decontamination by size-partitioned MinHash containment search.

Texts are sets of five-word shingles (ASCII lower case; a text of one to four words has one
shingle, all of it). An item is found in a document that holds at least ``threshold`` of
its shingles, however long the document is.

Documents are partitioned by size in powers of two. A document's signature is a
one-permutation MinHash: the hash range is cut into bins, their number a multiple of the
partition's upper size, and each bin keeps its least hash. As the bins grow with the
partition, a shingle that item and document share is its bin's least with a probability
that does not fall with size; the multiple is set for each item size class so that an item
at the threshold meets no bin with a probability of at most ``miss``. Very short items need
so many bins that each shingle has its own. Documents whose signature meets an item's
shingles are candidates, verified on the words themselves.

The items are a stated query set. They go to every task while their shingles number at most
``max_sent``, which is counted first; above it, signatures and items are joined by hash and
candidates by key, with the same result.

Defined cases: null and blank texts and items have no shingles and match nothing; repeated
rows of either table give one row; an item found often in a document counts once; a null ``doc_id`` or
``item_id`` stays null; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality_rules import text_key
from .tables import null_safe, unused, written
from .text import Words, distinct_per_text, shingles, signed, text_chunks

K, THRESHOLD, MISS, MAX_SENT = 5, 0.8, 1e-6, 4_000_000
_HITS = "doc_id long, text_key long, item_id long, n_shared long, n_item long"


def size_class(n) -> np.ndarray:
    """0 for 1, 1 for 2 to 3, 2 for 4 to 7 and so on."""
    return np.frexp(np.asarray(n, float))[1] - 1


def bin_bits(item_class: int, threshold: float, miss: float) -> int:
    """log2 of the bins for each shingle of a partition's largest document (perhaps below 0)."""
    need = max(1, math.ceil(threshold * 2 ** item_class - 1e-9))    # shared by the smallest item of its class
    least = 1 - miss ** (1 / need)                                  # each must be its bin's least so often
    bits = -6
    # with x shingles a bin, one of them is its least with probability (1 - e^-x) / x
    while -math.expm1(-2.0 ** -bits) / 2.0 ** -bits < least and bits < 20:
        bits += 1
    return bits if bits < 20 else 64


def signature(value: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """Mask over the hashes (sorted in each text) of those that are the least of their bin."""
    count = np.diff(bounds)
    power = np.repeat(np.clip(size_class(np.maximum(count, 1)) + 1 + bits, 0, 64), count).astype(np.uint64)
    bin_ = np.where(power == 0, np.uint64(0), value >> np.where(power == 0, np.uint64(0), np.uint64(64) - power))
    keep = np.ones(len(value), bool)
    keep[1:] = bin_[1:] != bin_[:-1]
    keep[bounds[:-1][count > 0]] = True
    return keep


def word_shingles(text: str | None) -> set[tuple[bytes, ...]]:
    words = (text or "").encode().translate(_LOWER).split()
    return set(zip(*(words[i:] for i in range(K)))) if len(words) >= K else {tuple(words)} if words else set()


_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _item_rows(batches):
    for batch in text_chunks(batches):
        w = Words(batch.column(1), lower=True)
        value, bounds = distinct_per_text(*shingles(w, K), w.n)
        at = np.repeat(np.arange(w.n), np.diff(bounds))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(at)), pa.array(signed(value)),
             pa.array(np.repeat(size_class(np.maximum(np.diff(bounds), 1)), np.diff(bounds)).astype(np.int32))],
            names=["item", "h", "size"])


def _verified(doc, key, found: dict, text: str) -> list[tuple]:
    own = word_shingles(text)
    return [(doc, key, name, n, len(s)) for name, s, need in found.values() if (n := len(s & own)) >= need]


def _need(n: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * n - 1e-9))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                      names=["doc_id", "text_key", "item_id", "n_shared", "n_item"])


def _search(sent, threshold: float, miss: float):
    """Probes each document's signatures with the items in the broadcast; verifies."""
    def run(batches):
        value, owner, names, texts, sizes = sent.value
        own = [word_shingles(t) for t in texts]
        classes = {}
        for c in np.unique(sizes[owner]) if len(owner) else ():
            mine = sizes[owner] == c
            classes[int(c)] = (bin_bits(int(c), threshold, miss), value[mine], owner[mine])
        for batch in text_chunks(batches):
            w = Words(batch.column(1), lower=True)
            v, bounds = distinct_per_text(*shingles(w, K), w.n)
            at = np.repeat(np.arange(w.n), np.diff(bounds))
            meets: dict[int, set[int]] = {}
            for bits, iv, io in classes.values():
                keep = np.flatnonzero(signature(v, bounds, bits))
                lo = np.searchsorted(iv, v[keep])
                hit = (lo < len(iv)) & (iv[np.minimum(lo, len(iv) - 1)] == v[keep])
                for i, p in zip(at[keep[hit]].tolist(), lo[hit].tolist()):
                    q = p
                    while q < len(iv) and iv[q] == iv[p]:
                        meets.setdefault(i, set()).add(int(io[q]))
                        q += 1
            rows = []
            docs, keys, text = batch.column(0), batch.column(2), batch.column(1)
            for i, items in meets.items():
                found = {j: (names[j], own[j], _need(len(own[j]), threshold)) for j in items}
                rows += _verified(docs[i].as_py(), keys[i].as_py(), found, text[i].as_py())
            yield _rows(rows)
    return run


def _signatures(classes: list[int], threshold: float, miss: float):
    def run(batches):
        for batch in text_chunks(batches):
            w = Words(batch.column(1), lower=True)
            v, bounds = distinct_per_text(*shingles(w, K), w.n)
            at = np.repeat(np.arange(w.n), np.diff(bounds))
            for c in classes:
                keep = signature(v, bounds, bin_bits(c, threshold, miss))
                i = pa.array(at[keep])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(i), batch.column(2).take(i), pa.array(signed(v[keep])),
                     pa.array(np.full(len(i), c, np.int32))], names=["doc_id", "text_key", "h", "size"])
    return run


def _verify(threshold: float):
    def run(batches):
        for batch in batches:
            rows = []
            for doc, key, text, name, item in zip(*(batch.column(i).to_pylist() for i in range(5))):
                s = word_shingles(item)
                rows += _verified(doc, key, {0: (name, s, _need(len(s), threshold))}, text)
            yield _rows(rows)
    return run


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, miss: float = MISS,
                 max_sent: int = MAX_SENT) -> DataFrame:
    """(doc_id, text_key, item_id, n_shared, n_item): documents that hold an item."""
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", text_key("text").alias("text_key"))
    items = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].alias("text"))
    parts = written(items.mapInArrow(_item_rows, "item long, h long, size int"), "items")
    if parts.count() <= max_sent:
        held = items.filter(F.col("text").isNotNull()).collect()          # bounded: checked above
        w = Words(pa.array([r["text"] for r in held], pa.string()), lower=True)
        value, bounds = distinct_per_text(*shingles(w, K), w.n)
        owner = np.repeat(np.arange(w.n), np.diff(bounds))
        order = np.argsort(value, kind="stable")
        sizes = size_class(np.maximum(np.diff(bounds), 1)) if w.n else np.zeros(0, int)
        sent = spark.sparkContext.broadcast(
            (value[order], owner[order], [r["item_id"] for r in held], [r["text"] for r in held], sizes))
        return docs.mapInArrow(_search(sent, threshold, miss), _HITS).distinct()
    classes = sorted(r["size"] for r in parts.select("size").distinct().collect())   # at most 64
    keyed = docs.mapInArrow(_signatures(classes, threshold, miss), "doc_id long, text_key long, h long, size int")
    pairs = keyed.join(parts, ["h", "size"]).select("doc_id", "text_key", "item").distinct()
    cand = null_safe(pairs, docs.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), F.col("text").alias("t"))
                     .distinct(), {"doc_id": "d", "text_key": "k"}, "inner")
    cand = null_safe(cand, items.select(F.col("item_id").alias("i"), F.col("text").alias("item_text")),
                     {"item": "i"}, "inner")
    return cand.select("doc_id", "text_key", "t", "item", "item_text").mapInArrow(_verify(threshold), _HITS) \
        .distinct()


def apply(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """The documents that hold no item, same columns."""
    d, k = unused(docs, "_d", "_k")
    bad = contaminated(docs, items, **params).select(F.col("doc_id").alias(d), F.col("text_key").alias(k)).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad[d]) & (text_key("text") == bad[k]), "left_anti")
