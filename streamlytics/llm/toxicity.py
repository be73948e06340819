"""Operator 9, toxicity by maximum-scoring segments.

Token weights: words (lower case, without marks around them) are counted in toxic and other
texts of the training sample, once a text, so that a text that repeats a word has one say. A
word's weight is the log-odds of the two rates, both with an informative Dirichlet prior
(a share ``PRIOR`` of the sample's counts, spread as they are), taken ``SHRINK`` standard errors
towards zero. Words that stay above zero by a ``MIN_Z`` form the
lexicon; every other token has one negative weight, the log-odds of being outside it.

Scan: the passages of a text are its maximal scoring segments, found in one pass (each
segment is joined to an earlier one exactly while that raises the total). As all negative
weights are alike, the pass visits only lexicon words and takes the gaps between by length.

Calibration: in texts of n tokens without toxic passages the largest segment total follows
an extreme-value law, P(S > s) about 1 - exp(-K n exp(-lambda s)). lambda solves the moment
equation on the weights' frequencies in the other training texts, K is fitted to their
largest segments. A passage's evidence is lambda s - ln(K n), and passages of evidence above
``EVIDENCE`` are significant. A text's score is a logistic function of the evidence of its
best passage, the sum over its significant ones and their density, fitted on the sample.

It is fitted on at most about ``max_rows`` labelled rows outside the held-out remainder (a
bounded sample, as a parameter; counts are made by Spark). All documents are scanned whole.

Defined cases: null and blank texts have no token and get the score of a text without
passages; without labelled rows of both kinds the lexicon is empty and every score is the
share of label 1 (0.5 without any); repeated rows are scored each; a null ``doc_id`` stays
null and counts as an empty text in the split; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .labelled import remainder, training_texts
from .tables import written

MAX_ROWS, MODULUS, HELD, CUT = 20_000, 4, 2, 0.3
PRIOR, SHRINK, MIN_Z, EVIDENCE, L2 = 0.1, 1.0, 2.5, 0.0, 0.5
_EDGE = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")


def token(word: str) -> str:
    """A word as counted: lower case, without marks around it (itself if only marks)."""
    return _EDGE.sub("", word.lower()) or word


def lower_words(text: str | None) -> list[bytes]:
    """The words of the lower-cased text, as UTF-8."""
    return (text or "").lower().encode().split()


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    other: float = -0.01
    lam: float = 1.0
    log_k: float = 0.0
    coef: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def passages(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens, and (first token, end token, evidence) of each segment."""
        words = lower_words(text)
        n = len(words)
        known = self.known
        hits = [(i, w) for i, w in enumerate(map(known, words)) if w > 0]
        return n, [(a, b, self.lam * s - self.log_k - math.log(n)) for a, b, s in segments(hits, self.other)]

    def known(self, word: bytes) -> float:
        w = self.cache.get(word)
        if w is None:
            if len(self.cache) > 300_000:
                self.cache.clear()
            w = self.cache[word] = self.weights.get(token(word.decode()), 0.0)
        return w

    def __post_init__(self):
        self.cache: dict[bytes, float] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "cache"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.cache = {}

    def measures(self, text: str | None) -> tuple[list[float], list[tuple[int, int, float]]]:
        n, found = self.passages(text)
        real = [p for p in found if p[2] > EVIDENCE]
        best = max((p[2] for p in found), default=-5.0)
        total = sum(p[2] for p in real)
        return [1.0, max(best, -5.0), math.log1p(total), math.log1p(100 * sum(b - a for a, b, _ in real) / max(n, 1))], real

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.coef, -30, 30)))


def segments(hits: list[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, total) of a sequence that has the positive
    weights ``hits`` (place, weight) and ``other`` (negative) everywhere else. One pass: each
    candidate keeps the cumulative totals before (low) and after (high) it; a new one joins
    the candidates from the last with a lower low, if its high is higher, and is tried again."""
    found: list[list] = []                                   # [first, end, low, high, link]
    total, at = 0.0, 0
    for i, w in hits:
        total += other * (i - at)
        cand = [i, i + 1, total, total + w]
        total += w
        at = i + 1
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= cand[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= cand[3]:
                found.append([*cand, j])
                break
            cand = [found[j][0], cand[1], found[j][2], cand[3]]
            link = found[j][4]
            del found[j:]
            j = link
    return [(a, b, high - low) for a, b, low, high, _ in found]


def solve_lambda(rates: dict[float, float], other: float) -> float:
    """lambda > 0 with sum of rate exp(lambda weight) = 1, the rest of the rate at ``other``."""
    rest = 1 - sum(rates.values())
    f = lambda x: sum(p * math.exp(min(700, x * w)) for w, p in rates.items()) + rest * math.exp(x * other) - 1
    hi = 1e-3
    while f(hi) < 0 and hi < 1e4:
        hi *= 2
    lo = 0.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def _count(batches):
    """Toxic and other texts that have each token, summed over the batch."""
    for batch in batches:
        by = (Counter(), Counter())
        for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
            by[y].update({token(w.decode()) for w in set(lower_words(text.as_py()))})
        out: dict[str, list[int]] = {}
        for y in (0, 1):
            for w, c in by[y].items():
                out.setdefault(w, [0, 0])[y] += c
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(out), pa.string())] + [pa.array([c[y] for c in out.values()], pa.int64()) for y in (1, 0)],
            names=["token", "toxic", "clean"])


def lexicon(sample: DataFrame) -> tuple[dict[str, float], float, dict[str, int], int]:
    """Weights of the words above zero, the weight of all others, the words' counts in the other
    texts, and the sum of all counts there."""
    counts = written(sample.select("text", "y").mapInArrow(_count, "token string, toxic long, clean long")
                     .groupBy("token").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")), "tokens")
    nt, nc = counts.agg(F.sum("t"), F.sum("c")).first()
    if not nt or not nc:
        return {}, -0.01, {}, nc or 0
    a, all_ = F.lit(PRIOR) * (F.col("t") + F.col("c")), PRIOR * (nt + nc)
    odds = F.log((F.col("t") + a) / (nt + all_ - F.col("t") - a)) - F.log((F.col("c") + a) / (nc + all_ - F.col("c") - a))
    error = F.sqrt(1 / (F.col("t") + a) + 1 / (F.col("c") + a))
    # bounded by the words of the bounded sample
    rows = counts.withColumn("odds", odds).withColumn("se", error).filter(F.col("odds") > MIN_Z * F.col("se")) \
        .select("token", "t", "c", (F.col("odds") - SHRINK * F.col("se")).alias("w")).orderBy("token").collect()
    qt, qc = sum(r.t for r in rows) / nt, sum(r.c for r in rows) / nc
    other = min(-0.01, math.log((1 - min(qt, 0.9)) / (1 - min(qc, 0.5))))
    return {r.token: r.w for r in rows}, other, {r.token: r.c for r in rows}, nc


def _largest(sent):
    def run(batches):
        model = sent.value
        for batch in batches:
            rows = [(max((x[2] for x in p), default=None), n, y) for (n, p), y in zip(
                (model.passages(t.as_py()) for t in batch.column(0)), batch.column(1).to_pylist())]
            cols = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32())],
                                             names=["best", "n", "y"])
    return run


def _measured(sent):
    def run(batches):
        model = sent.value
        for batch in batches:
            rows = [model.measures(t.as_py())[0] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])
    return run


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    w[0] = math.log(share / (1 - share))
    ridge = L2 * np.eye(len(w))
    ridge[0, 0] = 1e-6
    for _ in range(200 if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        pull = ridge @ np.concatenate([[0.0], w[1:]])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - pull)
        w += step * min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, modulus: int = MODULUS, held: int = HELD) -> Model:
    sc = docs.sparkSession.sparkContext
    sample = training_texts(docs, labels, "toxic", modulus, held, max_rows).select("text", "y")
    weights, other, clean, n_clean = lexicon(sample)
    model = Model(weights, other)
    if weights:
        rates = Counter()
        for t, w in weights.items():
            rates[w] += (clean[t] + 0.5) / (n_clean + 1)
        model.lam = solve_lambda(rates, other)
        # the mean of an extreme-value law: lambda S - ln n lies Euler's constant above ln K
        got = sample.mapInArrow(_largest(sc.broadcast(model)), "best double, n long, y int") \
            .filter("y = 0 and n > 0").agg(F.avg(F.when(F.col("best").isNotNull(), F.col("best")).otherwise(-F.log("n")))).first()
        model.log_k = min(0.0, (got[0] or 0.0) - np.euler_gamma)
    got = sample.mapInArrow(_measured(sc.broadcast(model)), "x array<double>, y int").toPandas()       # bounded by max_rows
    if len(got) and got["y"].nunique() == 2 and weights:
        model.coef = fit_logistic(np.stack(got["x"].to_numpy()), got["y"].to_numpy(float))
    else:
        share = float(np.clip(got["y"].mean(), 1e-3, 1 - 1e-3)) if len(got) else 0.5
        model.coef = np.array([math.log(share / (1 - share)), 0.0, 0.0, 0.0])
    return model


def _scores(sent, cut: float):
    def run(batches):
        model = sent.value
        for batch in batches:
            got = [model.measures(t.as_py()) for t in batch.column(1)]
            s = model.score(np.array([x for x, _ in got]).reshape(-1, 4))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(s, pa.float64()), pa.array((s >= cut).astype(np.int32)),
                 pa.array([[{"first_word": a, "end_word": b, "evidence": e} for a, b, e in p] for _, p in got],
                          pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("evidence", pa.float64())])))],
                names=["doc_id", "held_out", "score", "predicted", "passages"])
    return run


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, modulus: int = MODULUS, held: int = HELD,
             cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted, passages (significant ones, in words of the text)."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    sent = spark.sparkContext.broadcast(train(docs, labels, max_rows, modulus, held))
    return docs.select("doc_id", "text", (remainder(F.col("doc_id"), modulus) == held).alias("held_out")) \
        .mapInArrow(_scores(sent, cut), "doc_id long, held_out boolean, score double, predicted int, "
                    "passages array<struct<first_word: long, end_word: long, evidence: double>>")
