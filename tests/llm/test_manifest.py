"""The Merkle manifest against a tree built row by row."""

import hashlib
import random
import zlib
from collections import defaultdict

from streamlytics.llm import merkle
from util import ODD, SCHEMA, docs_frame, prose

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(*values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        p = levels[-1]
        levels.append([digest("".join(p[i:i + fan])) for i in range(0, len(p), fan)])
    return levels


def path(levels, i, fan):
    for nodes in levels[:-1]:
        a = i // fan * fan
        yield "".join(nodes[a:i]), "".join(nodes[i + 1:a + fan])
        i //= fan


def brute(rows, fan=8):
    """rows: (doc_id, text, lang, source, n_chars)"""
    by = defaultdict(list)
    for d, t, lang, s, n in rows:
        by[lang].append((d is not None, d or 0, leaf(d, s, lang, n, t), d, t, s, n))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([r[2] for r in sorted(by[x], key=lambda r: r[:3])], fan) for x in langs}
    top = tree([trees[x][-1][0] for x in langs], fan)
    for j, x in enumerate(langs):
        for i, (_, _, h, d, t, s, n) in enumerate(sorted(by[x], key=lambda r: r[:3])):
            steps = [*path(trees[x], i, fan), *path(top, j, fan)]
            f = h
            if d is not None and zlib.crc32(str(d).encode()) % 3 == 0:
                f = leaf(d, s, x, n, t if t is None else t.translate(_LOW))
            for a, b in steps:
                f = digest(a + f + b)
            yield d, h, trees[x][-1][0], top[-1][0], digest("".join(a + b for a, b in steps)), f, f == top[-1][0]


def check(spark, rows, fan=8, depth=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = merkle.manifest(df, fan=fan, depth=depth)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows, fan), key=repr)


def test_odd_rows_and_one_large_language(spark):
    rng = random.Random(3)
    rows = [(i * 7 % 701, prose(rng, 6), "en", "h", i) for i in range(700)]
    rows += [(900 + i, t, rng.choice([None, "de", "zz", "é"]), None if i % 2 else "s", None if i % 3 else i)
             for i, t in enumerate(ODD)]
    rows += [(None, "Null id", "en", "h", 1), (None, "Null id", "en", "h", 1), (None, None, None, None, None)]
    rows += [rows[5], rows[5], (rows[5][0], "Another Text", "en", "h", 3)]
    check(spark, rows)


def test_many_languages_small_fan(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 4), "l%d" % (i % 23 if i % 3 else 0), "h", 2) for i in range(150)]
    check(spark, rows, fan=2, depth=2)
    check(spark, rows, fan=3, depth=1)


def test_one_row_no_row_clashing_columns(spark):
    check(spark, [(3, "Alone", "en", "h", 5)])
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(i, "Text %d" % i, "h") for i in range(20)]
    got = merkle.manifest(docs_frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute([(d, t, "en", s, len(t)) for d, t, s in rows]))


def test_tampered_rows_are_found(spark):
    rows = [(i, "Upper" if i % 2 else "lower", "en", "h", 5) for i in range(60)]
    for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 3 != 0 or r.doc_id % 2 == 0)
