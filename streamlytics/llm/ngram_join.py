"""Operator 6, n-gram Jaccard self-join with an LSH forest.

Texts are sets of five-word shingles (ASCII lower case; a text of one to four words has one
shingle, all of it); two texts are linked at a Jaccard similarity of ``threshold`` or more.

Copies (equal word sequences) are collapsed first. Each remaining text has one label a tree:
a sequence of MinHash values. A tree is the prefix trie of its labels, and texts below the
same node share a prefix. From the full depth the prefix is shortened until a pair at the
threshold meets in some tree with the target recall; a node at that depth is a group of
equal prefixes, found by hashing the prefix, which needs no global sort. Each group links
its members to one of them only; the components of those links hold all candidates.

Inside a component every pair is verified exactly: shared shingles are counted with matrix
products, no pair is written out. A component of more than ``block`` texts, or 2,048 times
as many shingles, is dealt into blocks by hash, and each pair of blocks is a task of its
own; partial link counts are summed, and links are reduced to one for each text and task. Classes are the components of verified links.

Defined cases: a null or blank text has no shingle, no link and is its own class; a null
``doc_id`` stays null and names a class only if all its members are null; repeated rows are
copies of each other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .line_dedup import _BASES, _Sums
from .quality_rules import text_key
from .tables import null_safe, unused, written
from .text import Words, distinct_per_text, mix, shingles, signed, text_chunks

K, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 24, 10, 0.9999
BLOCK = 512


def prefix_length(trees: int, depth: int, threshold: float, recall: float) -> int:
    """The longest prefix at which a pair at the threshold meets with the target recall."""
    r = depth
    while r > 1 and 1 - (1 - threshold ** r) ** trees < recall:
        r -= 1
    return r


def minhash_prefixes(value: np.ndarray, bounds: np.ndarray, trees: int, r: int) -> np.ndarray:
    """(texts, trees): hash of each text's first r MinHash values in each tree."""
    n = len(bounds) - 1
    out = np.zeros((n, trees), np.uint64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if not len(full):
        return out
    at = bounds[:-1][full]
    for t in range(trees):
        label = np.full(len(full), np.uint64(t + 1))
        for j in range(r):
            odd = mix(np.array([t * 1000 + j + 1], np.uint64))[0] | np.uint64(1)
            label = mix(label * np.uint64(_BASES[0]) + np.minimum.reduceat(value * odd, at))
        out[full, t] = label
    return out


def _signatures(trees: int, r: int):
    def run(batches):
        for batch in text_chunks(batches, limit=1 << 20):
            w = Words(batch.column(1), lower=True)
            h = w.hashes()
            value, bounds = distinct_per_text(*shingles(w, K, h), w.n)
            one, two = (_Sums(h, x).run(w.first[:-1], w.first[1:]) for x in _BASES)
            labels = signed(minhash_prefixes(value, bounds, trees, r).ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(signed(one)), pa.array(signed(two)),
                 pa.array(np.diff(bounds).astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, w.n * trees + 1, trees, dtype=np.int32)), pa.array(labels))],
                names=["doc", "text_key", "k1", "k2", "n", "labels"])
    return run


def _sets(batches):
    """Shingle sets of the asked texts; a row whose text is another one (a repeated doc_id) goes."""
    for batch in text_chunks(batches):
        w = Words(batch.column(1), lower=True)
        h = w.hashes()
        value, bounds = distinct_per_text(*shingles(w, K, h), w.n)
        one, two = (signed(_Sums(h, x).run(w.first[:-1], w.first[1:])) for x in _BASES)
        same = (one == np.asarray(batch.column(2))) & (two == np.asarray(batch.column(3)))
        sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(signed(value)))
        out = pa.RecordBatch.from_arrays([batch.column(2), batch.column(4), batch.column(5), batch.column(6), sets],
                                         names=["node", "comp", "blocks", "copies", "s"])
        yield out.filter(pa.array(same))


def _pairs_in(threshold: float):
    """Exact links inside a block, or between two: per text its links and one link to keep."""
    def run(key, table):
        i, j = key[1].as_py(), key[2].as_py()
        node = np.asarray(table.column("node"))
        copies = np.asarray(table.column("copies"))
        side = np.asarray(table.column("side"))
        sets = table.column("s").combine_chunks()
        size = np.diff(np.asarray(sets.offsets))
        value = np.asarray(sets.flatten())
        at = np.repeat(np.arange(len(node)), size)
        rank, count = np.unique(value, return_inverse=True, return_counts=True)[1:]
        shared = count[rank] > 1
        cols, rank = np.unique(rank[shared], return_inverse=True)
        at = at[shared]
        inter = np.zeros((len(node), len(node)), np.float32)
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        width = 4096
        for c in range(0, len(cols), width):
            lo, hi = np.searchsorted(rank, [c, c + width])
            m = np.zeros((len(node), min(width, len(cols) - c)), np.float32)
            m[at[lo:hi], rank[lo:hi] - c] = 1
            inter += m @ m.T
        union = size[:, None] + size[None, :] - inter
        link = inter >= threshold * union - 1e-6
        np.fill_diagonal(link, False)
        if i != j:
            link &= side[:, None] != side[None, :]
        # the least node reached inside this task
        root = np.arange(len(node))
        order = np.argsort(node)
        pos = np.empty(len(node), np.int64)
        pos[order] = np.arange(len(node))
        low = pos.copy()
        while True:
            new = np.minimum(low, np.where(link, low[None, :], len(node)).min(axis=1, initial=len(node)))
            new = np.minimum(new, new[order[new]])
            if (new == low).all():
                break
            low = new
        root = node[order[low]]
        return pa.table({"node": node, "root": root, "links": link.sum(axis=1).astype(np.int64),
                         "doc_links": (link @ copies).astype(np.int64)})
    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH,
                    recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, text_key, class_id (least doc_id of its class), n_links
    (documents linked to it, copies too), n_text_links (different texts linked to its text)."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc"), "text", text_key("text").alias("text_key"))
    r = prefix_length(trees, depth, threshold, recall)
    prof = written(docs.mapInArrow(_signatures(trees, r),
                                   "doc long, text_key long, k1 long, k2 long, n int, labels array<long>"), "signatures")
    texts = written(prof.filter("n > 0").groupBy("k1", "k2").agg(
        F.min("doc").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("labels").alias("labels")), "texts")
    keys = texts.select(F.col("k1").alias("node"), F.explode("labels").alias("prefix"))
    groups = keys.groupBy("prefix").agg(F.min("node").alias("root"), F.max("node").alias("top")) \
        .filter("root <> top").select("prefix", "root")
    cand = written(connected(keys.join(groups, "prefix").select(F.col("node").alias("a"), F.col("root").alias("b"))),
                   "candidates")
    asked = texts.drop("labels").join(cand, texts["k1"] == cand["node"])
    sizes = asked.groupBy("root").agg(F.ceil(F.greatest(
        F.count("*") / F.lit(block), F.sum("n") / F.lit(block * 2048))).cast("int").alias("blocks"))
    asked = asked.join(sizes, "root") \
        .select("rep", "k1", "k2", F.col("root").alias("comp"), "blocks", "copies")
    sets = null_safe(docs, asked, {"doc": "rep"}, "inner").select("doc", "text", "k1", "k2", "comp", "blocks", "copies") \
        .mapInArrow(_sets, "node long, comp long, blocks int, copies long, s array<long>")
    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = sets.withColumn("side", side).withColumn("o", other) \
        .select("comp", F.least("side", "o").alias("i"), F.greatest("side", "o").alias("j"), "side", "node", "copies", "s")
    # a text read twice (repeated rows) counts once
    dealt = dealt.dropDuplicates(["comp", "i", "j", "node"])
    found = written(dealt.groupBy("comp", "i", "j").applyInArrow(
        _pairs_in(threshold), "node long, root long, links long, doc_links long"), "verified")
    total = found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("doc_links").alias("doc_links"))
    linked = written(connected(found.filter("links > 0").select(F.col("node").alias("a"), F.col("root").alias("b"))), "classes")
    of_text = texts.drop("labels").join(total, texts["k1"] == total["node"], "left").drop("node") \
        .join(linked, texts["k1"] == linked["node"], "left").drop("node") \
        .withColumn("root", F.coalesce("root", "k1"))
    names = of_text.groupBy(F.col("root").alias("named")).agg(F.min("rep").alias("class_id"))
    of_text = of_text.join(names, F.col("root") == F.col("named")) \
        .select(F.col("k1").alias("t1"), F.col("k2").alias("t2"), "class_id", "copies", "links", "doc_links")
    return prof.drop("labels").join(of_text, (F.col("k1") == F.col("t1")) & (F.col("k2") == F.col("t2")), "left") \
        .select(F.col("doc").alias("doc_id"), "text_key",
                F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc")).alias("class_id"),
                (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("doc_links", F.lit(0))).alias("n_links"),
                F.coalesce("links", F.lit(0)).alias("n_text_links"))


def apply(docs: DataFrame, **params) -> DataFrame:
    """One document of each class stays, the one with the least doc_id; same columns."""
    key, i, no, d, k, none = unused(docs, "_key", "_i", "_no", "_d", "_k", "_none")
    known = lambda c, i, no: [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(i), F.col(c).isNull().alias(no)]
    keep = near_duplicates(docs, **params).filter(F.col("doc_id").eqNullSafe(F.col("class_id"))) \
        .select(*known("doc_id", d, none), F.col("text_key").alias(k)).distinct()
    # joined by the columns by which repeated rows go, so that texts are shuffled once
    found = docs.select("*", *known("doc_id", i, no), text_key("text").alias(key))
    return found.join(keep, (found[i] == keep[d]) & (found[no] == keep[none]) & (found[key] == keep[k]), "left_semi") \
        .dropDuplicates([i, no, key]).drop(i, no, key)
