"""The pipeline, stage by stage against brute force, and its contract."""

import random
from collections import defaultdict

import corpus_pipeline
from streamlytics.llm import packing
from test_dedup import brute_classes, brute_items, brute_lines
from test_scores import BYTE_JSON, RANKS, brute_quality
from util import SCHEMA, corpus, prose

COLUMNS = corpus_pipeline.COLUMNS


def tables(spark, tmp_path, rows, items):
    spark.createDataFrame([(d, t, "en", h, len(t or "")) for d, t, h in rows], SCHEMA).repartition(3) \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def expected(rows, items):
    """The documents left after each stage, as (doc_id, text, source)."""
    ok = defaultdict(list)
    for r in brute_quality(rows):
        ok[r[0]].append(r[7])
    rows = [r for r in rows if all(ok[r[0]])]                   # no line is above the limits here
    yield rows
    gone = defaultdict(set)
    for d, _, i, *_ in brute_lines(rows):
        gone[d].add(i)
    out = []
    for d, t, h in rows:
        text = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d])
        if text.strip():
            out.append((d, text, h))
    rows = out
    yield rows
    first = {d: c for d, c, *_ in brute_classes(rows)}
    rows = [r for r in rows if first[r[0]] == r[0]]
    yield rows
    bad = {r[0] for r in brute_items(rows, items)}
    rows = [r for r in rows if r[0] not in bad]
    yield rows
    yield sorted((d, at, n) for d, t, _ in rows for at, n in starts(len(packing.encode(t, RANKS, BYTE_JSON)) + 1))


def starts(n):
    at = 0
    for x in packing.cuts(n):
        yield at, x
        at += x


def test_each_stage(spark, tmp_path):
    rng = random.Random(6)
    items = [(i, prose(rng, n)) for i, n in enumerate((9, 30, 60))]
    rows = [(d, t, "s%d" % i) for i, (d, t, _) in enumerate(dict((r[0], r) for r in corpus(12, 40) if r[0] is not None).values())]
    rows += [(8000 + i, prose(rng, 50) + " " + t + " " + prose(rng, 50), "s") for i, t in items]
    sf = tables(spark, tmp_path, rows, items)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram join", "decontamination", "packing"]
    for k, ((name, stage), wanted) in enumerate(zip(corpus_pipeline.STAGES, expected(rows, items))):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == COLUMNS, name
            assert sorted((r.doc_id, r.text, r.source) for r in out.collect()) == sorted(wanted), name
            out.write.parquet(str(tmp_path / str(k)))
            docs = spark.read.parquet(str(tmp_path / str(k)))
        else:
            assert sorted((r.doc_id, r.start, r.length) for r in out.collect()) == wanted
    assert sorted((r.doc_id, r.start, r.length) for r in corpus_pipeline.run(spark, sf).collect()) == wanted


def test_empty_and_odd(spark, tmp_path):
    sf = tables(spark, tmp_path / "a", [], [(1, "a b c d e f")])
    assert corpus_pipeline.run(spark, sf).count() == 0
    rows = [r for r in corpus(13, 25)] + [(1, None, None), (None, None, None)]
    sf = tables(spark, tmp_path / "b", [r[:3] for r in rows], [])
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_rows_without_an_id_or_with_a_shared_one_keep_their_texts(spark, tmp_path):
    """Texts that are no copy of any other pass every filtering stage unchanged, whatever their ids."""
    rng = random.Random(17)
    lines = lambda: "\n".join(" ".join("w%x" % rng.randrange(1 << 30) for _ in range(12)) for _ in range(6))
    unique = [(None, lines(), "a"), (None, lines(), "a"), (None, lines(), None), (7, lines(), "b"), (7, lines(), "b"), (7, lines(), None)]
    shared = lines()
    first, second = shared.split("\n")[:3], shared.split("\n")[3:]
    copies = [(1, shared, "c"), (7, lines() + "\n" + "\n".join(second), "c"), (None, "\n".join(first) + "\n" + lines(), "c")]
    sf = tables(spark, tmp_path, unique + copies, [(1, lines())])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        stage(spark, docs, sf).write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
        left = [(r.doc_id, r.text) for r in docs.collect()]
        assert len(left) == 9 and all((d, t) in left for d, t, _ in unique) and (1, shared) in left, name
    assert (7, copies[1][1].rsplit("\n", 3)[0]) in left                       # only their own copied lines are gone
    assert (None, copies[2][1].split("\n", 3)[3]) in left
