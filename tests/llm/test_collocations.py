"""Prefix-free parsing and collocations against plain counting of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from streamlytics.llm import collocations as C
from util import ODD, SCHEMA, corpus, docs_frame, prose

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for p in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(_LOW)):
        ws = re.findall("[^\x20\x09]+", p)
        if ws:
            yield ws


def counts(rows, max_words):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for m in range(1, max_words + 1):
                for i in range(len(ws) - m + 1):
                    f[lang, tuple(ws[i:i + m])] += 1
    return f, n


def brute(rows, min_count, top, max_words):
    f, n = counts(rows, max_words)
    f = {k: a for k, a in f.items() if a >= min_count}
    cand = {k: a for k, a in f.items() if len(k[1]) > 1}
    gone = {(lang, p[i:j]) for (lang, p), a in cand.items() for i in range(len(p)) for j in range(i + 1, len(p) + 1)
            if j - i < len(p) and f.get((lang, p[i:j])) == a}
    best = {}
    for (lang, p), a in cand.items():
        if (lang, p) not in gone:
            s, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            best.setdefault(lang, []).append((s, a, " ".join(p), f[lang, p[:k]], f[lang, p[k:]]))
    for lang, found in best.items():
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        for rank, (s, a, p, left, right) in enumerate(found[:top], 1):
            yield lang, rank, p, a, left, right, n[lang], s


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "h", len(t or "")) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(4)


@pytest.mark.parametrize("max_words,min_count,top", [(5, 3, 2000), (2, 2, 7), (3, 4, 40), (7, 2, 100)])
def test_against_every_phrase(spark, max_words, min_count, top):
    rng = random.Random(max_words)
    rows = [(t, rng.choice(["en", "en", "de", None, "und"])) for _, t, _ in corpus(21, 50)]
    rows += [(prose(rng, 150, 12), "en") for _ in range(12)] + [(t, "en") for t in ODD]
    rows += [("a a a a a a a a a a a", "en"), ("tick " * 400, "de"), ("x Y\tz. X y\x0bz; x y z", None)] * 3
    got = C.collocations(frame(spark, rows), min_count, top, max_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, min_count, top, max_words))


@pytest.mark.parametrize("period", [1, 3, 1 << 60])
def test_chunks_hold_each_phrase_once(spark, period):
    rng = random.Random(5)
    rows = [(prose(rng, 90, 30), "en") for _ in range(8)] + [(t, "en") for t in ODD]
    rows += rows[:3]
    f, n = counts(rows, 5)
    found = Counter()
    chunks = C.dictionary(frame(spark, rows), period=period).collect()
    for r in chunks:
        p = C._Phrases(pa.RecordBatch.from_arrays([pa.array([r.lang]), pa.array([r.chunk]), pa.array([r["last"]]), pa.array([r.freq])],
                                                  names=["lang", "chunk", "last", "freq"]), 4)
        for k in range(1, 6):
            for t in p.texts(p.starts(k), k).to_pylist():
                found[r.lang, tuple(t.split(" "))] += r.freq
    assert found == f
    assert sum(r.freq for r in chunks if r["last"]) == sum(1 for t, _ in rows if any(pieces(t)))


def test_bitmap_marks_exactly_its_phrases(spark):
    rng = random.Random(6)
    some = sorted({("l%d" % rng.randrange(3), " ".join("w%d" % rng.randrange(50) for _ in range(3))) for _ in range(500)})
    bits = C.bitmap(spark.createDataFrame(some, "lang string, phrase string").repartition(3), 3)
    batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in some]), pa.array([x[1] for x in some]), pa.array([True] * len(some)),
                                        pa.array([1] * len(some))], names=["lang", "chunk", "last", "freq"])
    p = C._Phrases(batch, 4)
    at = p.starts(3)
    keys = set((C.runs_hash(p.h, 3)[at] % np.uint64(C.BITS)).tolist())
    assert len(at) == len(some) and len(p.within(at, 3, 3, bits)) == len(some)
    assert set(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == keys


def test_empty_and_clashing(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(i, "one two three. One two") for i in range(3)]
    got = C.collocations(docs_frame(spark, rows), 2)
    assert sorted(map(tuple, got.collect())) == sorted(brute([(t, "en") for _, t in rows], 2, 2000, 5))


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10 ** 12, 10 ** 13, 10 ** 12 + 7, 10 ** 12 + 9)], "a long, n long, l long, r long") \
        .selectExpr("cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)) "
                    "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) AS s").first()
    assert row.s == 1000 * 10 ** 25 // ((10 ** 12 + 7) * (10 ** 12 + 9))
