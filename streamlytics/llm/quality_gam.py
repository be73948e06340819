"""Operator 8, a quality classifier: a generalised additive model with pairwise interactions.

Each text gives ``FEATURES`` measured on the text alone. A feature's values are cut into
bins at quantiles of the training sample. The model adds one table lookup a feature, and one
a chosen pair of features on coarser bins. The tables are learnt by cyclic boosting: in
turn, each feature gets a shallow tree (two cuts) fitted to what the model still misses,
whose leaf values, shrunk, are added to its table; then the pairs with the largest gain
get trees of depth two. Scoring is bin search and table addition, vectorised.

It is fitted on at most about ``max_rows`` labelled rows outside the held-out remainder
(a bounded sample, as a parameter; features are computed by Spark tasks, and the sample's
feature rows are the only thing gathered). All documents are scored, whole.

Defined cases: null and blank texts have the features of an empty text and are scored;
without labelled rows of both kinds every score is the share of label 1 (0.5 without any);
repeated rows are scored each; a null ``doc_id`` stays null and counts as an empty text in
the split; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .labelled import remainder, training_texts
from .text import SPACE, Words, mix, runs_hash, text_chunks

MAX_ROWS, MODULUS, HELD, CUT = 20_000, 5, 0, 0.3
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE, L2 = 32, 8, 8, 120, 40, 0.15, 2.0
FEATURES = ("log_words", "log_bytes", "word_bytes", "symbols", "marks", "stops", "commas", "upper", "digits", "non_ascii",
            "distinct_words", "repeated_runs", "neighbour_repeats", "top_word", "log_lines", "line_words", "short_lines",
            "blank_share", "short_words", "long_words", "capitals", "bars", "odd_ends")


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _MARK, _STOP, _COMMA, _BAR = (_flags(x) for x in (b"#*$%&<>=@^~_\\/{}[]", b"!?", b".", b",;:", b"|"))
_UPPER, _ALPHA, _DIGIT = (_flags(x) for x in (bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)]), b"0123456789"))
_HIGH = np.arange(256) >= 128
_ODD_END = ~(_ALPHA | _HIGH | _DIGIT | _STOP | _COMMA | _MARK | _flags(b"'\")"))


def features(w: Words) -> np.ndarray:
    """(texts, features) float32."""
    n = w.n
    size = np.diff(w.offs).astype(float)
    words = w.counts().astype(float)
    some = np.maximum(words, 1)
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags[w.raw])])[w.offs]).astype(float)
    doc = w.doc_of_word()
    per_doc = lambda x: np.bincount(doc, x, n) if len(doc) else np.zeros(n)
    length = (w.ends - w.starts).astype(float)
    h = mix(w.hashes() + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    # words alike inside a text, as runs of the sorted hashes
    order = np.lexsort((h, doc))
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[order][1:] != h[order][:-1]
    heads = np.flatnonzero(fresh)
    count = np.diff(np.concatenate([heads, [len(h)]]))
    distinct = np.bincount(doc[order][heads], minlength=n)[:n] if len(h) else np.zeros(n)
    top = np.zeros(n)
    np.maximum.at(top, doc[order][heads], count)
    runs = runs_hash(h, 4)
    run_doc = doc[:len(runs)]
    inside = run_doc == doc[3:] if len(runs) else np.zeros(0, bool)
    key, run_doc = runs[inside], run_doc[inside]
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order][1:] == key[order][:-1]
    repeated = np.bincount(run_doc[again], minlength=n)[:n]
    nearby = np.zeros(len(h), bool)
    nearby[1:] = h[1:] == h[:-1]
    newlines = np.concatenate([[0], np.cumsum(w.raw == 10)])
    line = newlines[w.starts] if len(w.starts) else np.zeros(0, int)
    begins = np.ones(len(line), bool)
    begins[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(begins)
    line_words = np.diff(np.concatenate([starts, [len(line)]]))
    lines = np.bincount(doc[starts], minlength=n)[:n].astype(float)
    short_lines = np.bincount(doc[starts], line_words <= 2, n)[:n] if len(starts) else np.zeros(n)
    letters = np.maximum(total(_ALPHA), 1)
    cols = [np.log1p(words), np.log1p(size), per_doc(length) / some, total(_SYMBOL) / some, total(_MARK) / some,
            total(_STOP) / some, total(_COMMA) / some, total(_UPPER) / letters, total(_DIGIT) / some,
            total(_HIGH) / np.maximum(size, 1), distinct / some,
            repeated / some, per_doc(nearby) / some, top / some, np.log1p(lines), words / np.maximum(lines, 1),
            short_lines / np.maximum(lines, 1), total(SPACE) / np.maximum(size, 1), per_doc(length <= 3) / some,
            per_doc(length >= 14) / some, per_doc(_UPPER[w.raw[w.starts]] if len(doc) else doc) / some, total(_BAR) / some,
            per_doc(_ODD_END[w.raw[w.ends - 1]] if len(doc) else doc) / some]
    return np.stack(cols, axis=1).astype(np.float32)


@dataclass
class Model:
    """base + sum of tables[f][bin of f] + sum of pair tables; all bounded by the bin counts."""
    base: float
    cuts: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pair_cuts: list = field(default_factory=list)
    pairs: list = field(default_factory=list)          # (feature, feature, table)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            z += table[np.searchsorted(cuts, x[:, f], side="right")]
        coarse = {f: np.searchsorted(self.pair_cuts[f], x[:, f], side="right") for a, b, _ in self.pairs for f in (a, b)}
        for a, b, table in self.pairs:
            z += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-z))


def _quantiles(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def _leaf(g, h):
    return g / (h + L2)


def _gain(g, h):
    return g * g / (h + L2)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of bins with gradient sums g, hessian sums h."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _shallow(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values by bin of a tree with two cuts."""
    _, first = _best_cut(g, h)
    parts = [p for p in (slice(0, first), slice(first, len(g))) if len(g[p])]
    gains = [_best_cut(g[p], h[p]) for p in parts]
    i = int(np.argmax([x for x, _ in gains]))
    if gains[i][0] > 0:
        p, at = parts[i], gains[i][1]
        parts[i:i + 1] = [slice(p.start, p.start + at), slice(p.start + at, p.stop)]
    out = np.zeros(len(g))
    for p in parts:
        out[p] = _leaf(g[p].sum(), h[p].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts the rows once and each part's columns once."""
    best = (0.0, np.zeros_like(g))
    whole = _gain(g.sum(), h.sum())
    for at in range(1, len(g)):
        gain, out = -whole, np.zeros_like(g)
        for rows in (slice(0, at), slice(at, len(g))):
            gs, hs = g[rows].sum(axis=0), h[rows].sum(axis=0)
            cut = _best_cut(gs, hs)[1]
            for cols in (slice(0, cut), slice(cut, len(gs))):
                a, b = gs[cols].sum(), hs[cols].sum()
                gain += _gain(a, b)
                out[rows, cols] = _leaf(a, b)
        if gain > best[0]:
            best = (gain, out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    if len(y) == 0 or y.min() == y.max():
        share = 0.5 if len(y) == 0 else float(np.clip(y.mean(), 0.001, 0.999))
        return Model(float(np.log(share / (1 - share))))
    share = y.mean()
    m = Model(float(np.log(share / (1 - share))))
    d = x.shape[1]
    m.cuts = [_quantiles(x[:, f], BINS) for f in range(d)]
    m.tables = [np.zeros(len(c) + 1) for c in m.cuts]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(m.cuts)]
    z = np.full(len(y), m.base)

    def sums(code, size):
        p = 1 / (1 + np.exp(-z))
        return np.bincount(code, y - p, size), np.bincount(code, p * (1 - p), size)

    for _ in range(ROUNDS):
        for f in range(d):
            step = RATE * _shallow(*sums(bins[f], len(m.tables[f])))
            m.tables[f] += step
            z += step[bins[f]]
    m.pair_cuts = [_quantiles(x[:, f], PAIR_BINS) for f in range(d)]
    coarse = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(m.pair_cuts)]
    size = [len(c) + 1 for c in m.pair_cuts]
    code = lambda a, b: coarse[a] * size[b] + coarse[b]
    gains = []
    for a in range(d):
        for b in range(a + 1, d):
            g, h = (s.reshape(size[a], size[b]) for s in sums(code(a, b), size[a] * size[b]))
            gains.append((_quadrants(g, h)[0], a, b))
    m.pairs = [(a, b, np.zeros((size[a], size[b]))) for gain, a, b in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in m.pairs:
            g, h = (s.reshape(size[a], size[b]) for s in sums(code(a, b), size[a] * size[b]))
            step = RATE * _quadrants(g, h)[1]
            table += step
            z += step[coarse[a], coarse[b]]
    return m


def _measured(batches):
    for batch in text_chunks(batches):
        x = features(Words(batch.column(0)))
        yield pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32())), batch.column(1)],
            names=["x", "y"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, modulus: int = MODULUS, held: int = HELD) -> Model:
    sample = training_texts(docs, labels, "quality", modulus, held, max_rows)
    got = sample.select("text", "y").mapInArrow(_measured, "x array<float>, y int").toPandas()   # bounded by max_rows
    if not len(got):
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.stack(got["x"].to_numpy()), got["y"].to_numpy(float))


def _scores(sent, cut: float):
    def run(batches):
        model = sent.value
        for batch in text_chunks(batches):
            s = model.score(features(Words(batch.column(1))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(s, pa.float64()), pa.array((s >= cut).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, modulus: int = MODULUS, held: int = HELD,
             cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score (probability of quality 1), predicted."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    sent = spark.sparkContext.broadcast(train(docs, labels, max_rows, modulus, held))
    return docs.select("doc_id", "text", (remainder(F.col("doc_id"), modulus) == held).alias("held_out")) \
        .mapInArrow(_scores(sent, cut), "doc_id long, held_out boolean, score double, predicted int")
