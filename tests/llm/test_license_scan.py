"""The set-similarity join and base phrases against plain sets of every block."""

import random
import re
from fractions import Fraction

import pytest

from streamlytics.llm import license_scan as L
from util import ODD, SCHEMA, corpus, docs_frame

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return _WORD.findall((text or "").translate(_LOW))


def brute_matches(text, templates, threshold, lines):
    rows = (text or "").split("\n")
    for i in range(len(rows)):
        block = set(words("\n".join(rows[i:i + lines])))
        for k, (label, t) in enumerate(templates):
            t = set(words(t))
            if t and len(block & t) >= Fraction(str(threshold)) * len(t):
                yield i, label, k, len(block & t), len(block & t) / len(t)


def brute(rows, templates=L.TEMPLATES, threshold=0.8, lines=1):
    for r in rows:
        ws = words(r[1])
        at = [(p, label) for label, phrase in L.BASE for p in range(len(ws)) if ws[p:p + len(phrase.split())] == phrase.split()]
        found = list(brute_matches(r[1], templates, threshold, lines))
        base = {label for _, label in at}
        yield (r[0], len(ws), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted(base)),
               ",".join(sorted(base | {m[1] for m in found})), 1.0 if at else max((m[4] for m in found), default=0.0))


def texts(seed, vocabulary, n=60):
    """Lines drawn from few words, so that many blocks lie around the threshold."""
    rng = random.Random(seed)
    for i in range(n):
        line = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9)))
        yield i, "\n".join(line() for _ in range(rng.randint(0, 6)))


def test_registered_parameters_on_odd_texts(spark):
    rng = random.Random(2)
    rows = [r[:2] for r in corpus(31, 30)] + [(700 + i, t) for i, t in enumerate(ODD)]
    for i, (_, t) in enumerate(L.TEMPLATES):
        ws = t.split()
        ws.pop(rng.randrange(len(ws)))
        rows += [(800 + i, "Some words\n" + t.upper() + "."), (900 + i, " ".join(ws)), (950 + i, " ".join(rng.sample(t.split(), len(t.split()))))]
    rows += [(1000, "CC BY-NC cc by.All Rights\nReserved! general public\x00license"), (1001, "ccby cc-by éall rights reserved"),
             (1002, "cc " * 50 + "by"), (1003, "all rights reserved " * 300), (None, "cc by"), (None, None), (1003, "MIT"), (1003, "MIT")]
    got = L.licenses(docs_frame(spark, rows))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("threshold,lines", [(0.8, 1), (0.8, 2), (0.5, 3), (1.0, 1), (0.34, 1)])
def test_every_block_is_found(spark, threshold, lines):
    vocabulary = list("abcdefghij")
    rng = random.Random(lines)
    templates = [("t%d" % (i % 5), " ".join(rng.sample(vocabulary, rng.randint(1, 8)))) for i in range(12)] + [("none", "."), ("t1", "a b c d"), ("t1", "a b c d")]
    rows = list(texts(lines, vocabulary))
    df = spark.createDataFrame([(i, t, "en", "h", 1) for i, t in rows], SCHEMA).repartition(3)
    _, found = L.scan(df, templates, [], threshold, lines)
    want = sorted((d, *m) for d, t in rows for m in brute_matches(t, templates, threshold, lines))
    assert want and sorted(map(tuple, found.select("doc_id", "line", "label", "template", "shared", "containment").collect())) == want


def test_order_is_by_blocks_of_the_whole_table(spark):
    rows = [(1, "the the\nthe a\nmit", "en"), (2, "the", "en"), (3, None, "en")]
    df = docs_frame(spark, rows)
    assert L.block_frequencies(df, ["a", "mit", "the", "zzz"]) == {"the": 3, "a": 1, "mit": 1, "zzz": 0}
    assert L.block_frequencies(df, ["the", "mit"], lines=2) == {"the": 3, "mit": 2}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert L.licenses(empty).count() == 0
    got = L.licenses(spark.createDataFrame([(1, "mit license", "en", "h", 1)], SCHEMA), templates=[], base=[]).collect()
    assert [tuple(r) for r in got] == [(1, 2, 0, None, None, "", "", 0.0)]
