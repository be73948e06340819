"""Operators 2, 4, 6, 10 against brute force on planted tables."""

import random
import re
from collections import defaultdict

import pytest

from streamlytics.llm import decontaminate, line_dedup, ngram_join, substring_dedup
from streamlytics.llm.quality_rules import text_key
from streamlytics.llm.text import Words
from util import SCHEMA, corpus, docs_frame, prose

LAST = (1 << 63) - 1


def low(text):
    return (text or "").encode().translate(decontaminate._LOWER).split()


def shingle_set(text):
    w = low(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


# ---- op 2 ----

def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def text_keys(spark, rows):
    """Text -> the key that orders texts of the same id."""
    df = spark.createDataFrame([(r[1] or "",) for r in rows], "text string")
    return dict(map(tuple, df.select("text", text_key("text")).distinct().collect()))


def document(r, keys):
    return (LAST if r[0] is None else r[0], keys.get(r[1] or "", 0))


def brute_lines(rows, keys={}):
    """(doc_id, text key, line, kept doc_id, kept text key, kept line, distance)"""
    places = defaultdict(set)
    for r in rows:
        for i, x in enumerate((r[1] or "").split("\n")):
            w = tuple(x.encode().split())
            if w:
                places[w].add((*document(r, keys), i))
    out = set()
    for w, own in places.items():
        near = [min(p) for v, p in places.items()
                if v != w and len(v) >= 8 and len(w) >= 8 and abs(len(v) - len(w)) < 2 and lev(v, w) <= 1 and min(p) < min(own)]
        for p in own:
            if near:
                out.add((*p, *min(near), 1))
            elif p != min(own):
                out.add((*p, *min(own), 0))
    return out


def test_removed_lines(spark):
    rows = corpus(3, 40)
    rng = random.Random(5)
    line = ["v%d" % i for i in range(10)]
    for i in range(30):                       # a group of lines that replace, add or lack one word
        w = list(line)
        p = rng.randrange(10)
        w[p:p + rng.randint(0, 1)] = ["new%d" % i] * rng.randint(0, 1)
        rows.append((1000 + i, " ".join(w)))
    rows += [(2000, "a a a a a a a a a"), (2001, "a a a a a a a a"), (2002, "b a a a a a a a a"), (2003, "x y z"), (2004, "x y q")]
    rows += [(2003, "other words"), (2003, line[0] + " x\nx y z"), (None, "x y q\nu v"), (None, "u v\nnobody else has this"), (None, "u v")]
    found = line_dedup.removed_lines(docs_frame(spark, rows)).collect()
    got = {tuple(LAST if v is None else v for v in (r.doc_id, r.text_key, r.line_no, r.kept_doc_id, r.kept_text_key, r.kept_line_no, r.distance))
           for r in found}
    assert got == brute_lines(rows, text_keys(spark, rows)) and len(got) == len(found)


def test_within_one():
    rng = random.Random(2)
    for _ in range(4000):
        a = [rng.choice("ab") for _ in range(rng.randint(0, 6))]
        b = [rng.choice("ab") for _ in range(rng.randint(0, 6))]
        assert line_dedup.within_one(a, b) == (lev(a, b) <= 1), (a, b)


def test_line_dedup_apply(spark):
    rows = [(1, "a b\nc d"), (2, "a b\ne f"), (3, "c d\na b"), (4, None), (5, "")]
    got = line_dedup.apply(docs_frame(spark, rows))
    assert got.columns == docs_frame(spark, rows).columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "a b\nc d", 2: "e f", 4: None, 5: ""}


def test_line_dedup_tells_texts_of_one_id_apart(spark):
    """Rows without an id, and rows that share one, lose their own lines only."""
    rows = [(None, "c\nb"), (None, "u\nv"), (7, "q\na"), (7, "x\ny"), (8, "b"), (9, "a"), (7, "x\ny"), (6, "q"), (5, "c")]
    got = line_dedup.apply(docs_frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, "u\nv"), (7, "x\ny"), (7, "x\ny"), (8, "b"), (6, "q"), (5, "c"), (7, "a")])
    rows = corpus(23, 40)
    rows = [(r[0] and r[0] % 9, r[1]) for r in rows]           # a few ids, many texts each
    keys = text_keys(spark, rows)
    gone = defaultdict(set)
    for d, k, i, *_ in brute_lines(rows, keys):
        gone[d, k].add(i)
    want = []
    for r in rows:
        out = [x for i, x in enumerate((r[1] or "").split("\n")) if i not in gone[document(r, keys)]]
        if not gone[document(r, keys)]:
            want.append(r)
        elif "\n".join(out).encode().strip():
            want.append((r[0], "\n".join(out)))
    got = [(r.doc_id, r.text) for r in line_dedup.apply(docs_frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


# ---- op 6 ----

def brute_classes(rows):
    sets = [shingle_set(r[1]) for r in rows]
    words = [tuple(low(r[1])) for r in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and sets[i] and sets[j]
              and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    cls = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in links[i]:
                if cls[j] < cls[i]:
                    cls[i], changed = cls[j], True
    least = {c: min((rows[i][0] for i in range(n) if cls[i] == c and rows[i][0] is not None), default=None) for c in cls}
    return sorted(((r[0], least[cls[i]], len(links[i]), len({words[j] for j in links[i]} - {words[i]}))
                   for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates(spark, block):
    rows = corpus(7, 50)
    rng = random.Random(1)
    t = prose(rng, 150)
    for i in range(25):                        # near copies of one text, so of each other
        w = t.split(" ")
        w[rng.randrange(len(w))] = "u%d" % i
        rows.append((5000 + i, " ".join(w)))
    got = ngram_join.near_duplicates(docs_frame(spark, rows), block=block)
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in got.collect()), key=repr) == brute_classes(rows)


def test_ngram_apply(spark):
    t = prose(random.Random(4), 80)
    rows = [(9, t), (4, t), (4, t), (6, t + " more"), (7, "other words that stand alone here"), (8, None), (8, None), (None, "")]
    got = ngram_join.apply(docs_frame(spark, rows))
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 4, 7, 8]


def test_ngram_apply_shuffles_the_texts_once(spark):
    """Nothing is dealt anew after the join that keeps one of each class; null ids and repeated rows as before."""
    same = "one two three four five six seven eight"
    rows = [(None, same), (None, same), (None, "a text of its own"), (3, "another text here"), (3, "another text here"), (3, "a third"), (9, "a third")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ngram_join.apply(docs_frame(spark, rows))
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan[:plan.index("SortMergeJoin")]
    assert sorted(((r.doc_id or 0, r.text) for r in got.collect())) == [
        (0, "a text of its own"), (0, same), (3, "a third"), (3, "another text here")]



def test_prefix_length():
    r = ngram_join.prefix_length(24, 10, 0.8, 0.9999)
    assert 1 - (1 - 0.8 ** r) ** 24 >= 0.9999 > 1 - (1 - 0.8 ** (r + 1)) ** 24


# ---- op 4 ----

def brute_items(rows, items):
    out = set()
    for r in rows:
        s = shingle_set(r[1])
        for i, t in items:
            q = shingle_set(t)
            if q and 5 * len(q & s) >= 4 * len(q):
                out.add((r[0], i, len(q & s), len(q)))
    return out


@pytest.mark.parametrize("max_sent", [decontaminate.MAX_SENT, 0])
def test_contaminated(spark, max_sent):
    rng = random.Random(11)
    items = [(i, prose(rng, n)) for i, n in enumerate([1, 3, 5, 6, 8, 9, 12, 20, 40, 80, 200])] + [(50, None), (None, "x y z v w q"), (51, "")]
    rows = corpus(2, 30)
    for k, (i, t) in enumerate(items):
        for size in (0, 30, 3000):
            w = (t or "").split(" ")
            for e in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = "zz"
            rows.append((9000 + k * 10 + len(str(size)), (prose(rng, size) + " " + " ".join(w) + " " + prose(rng, size)).strip()))
    q = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs_frame(spark, rows), q, max_sent=max_sent)
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got.collect()} == brute_items(rows, items)
    kept = decontaminate.apply(docs_frame(spark, rows), q, max_sent=max_sent)
    bad = {r[0] for r in brute_items(rows, items)}
    assert sorted((r.doc_id or 0) for r in kept.collect()) == sorted((r[0] or 0) for r in rows if r[0] not in bad)


# ---- op 10 ----

def brute_spans(rows, keys={}):
    """The runs from the docstring's rule, on Python words; long sentences are in no test here."""
    runs = defaultdict(set)
    for r in rows:
        raw = (r[1] or "").encode()
        sent, doc = [], document(r, keys)
        at = 0
        for line in raw.split(b"\n"):
            words = [(m.start() + at, m.end() + at, m.group().translate(decontaminate._LOWER)) for m in re.finditer(rb"[^\x20\x09-\x0D]+", line)]
            cur = []
            for w in words:
                cur.append(w)
                if w[2][-1:] in (b".", b"!", b"?"):
                    sent.append(cur)
                    cur = []
            if cur:
                sent.append(cur)
            at += len(line) + 1
        assert all(len(s) <= substring_dedup.LONG for s in sent)
        for j in range(len(sent)):
            run = []
            for e in range(j, len(sent)):
                run += sent[e]
                if len(run) >= 20:
                    runs[tuple(w for _, _, w in run)].add((doc, run[0][0], run[-1][1]))
                    break
            run = []
            for e in range(j, -1, -1):
                run = sent[e] + run
                if len(run) >= 20:
                    runs[tuple(w for _, _, w in run)].add((doc, run[0][0], run[-1][1]))
                    break
    gone = defaultdict(set)
    for own in runs.values():
        for doc, a, b in own - {min(own)}:
            gone[doc].update(range(a, b))
    return gone


def test_repeated_ranges(spark):
    rows = [r for r in corpus(9, 50) if r[1] is None or len(r[1]) < 100000]
    rows += [(r[0] and r[0] % 9, r[1]) for r in corpus(29, 25)]  # ids that several texts share
    got = defaultdict(set)
    for r in substring_dedup.repeated_ranges(docs_frame(spark, rows)).collect():
        at = (LAST if r.doc_id is None else r.doc_id, r.text_key)
        assert not got[at] & set(range(r.start_byte, r.end_byte))
        got[at].update(range(r.start_byte, r.end_byte))
    keys = text_keys(spark, rows)
    assert dict(got) == dict(brute_spans(rows, keys))
    out = []
    for r in rows:
        raw, gone = (r[1] or "").encode(), got.get(document(r, keys), ())
        out.append((r[0], r[1] if r[1] is None else bytes(c for i, c in enumerate(raw) if i not in gone).decode()))
    left = [(r.doc_id, r.text) for r in substring_dedup.apply(docs_frame(spark, rows)).collect()]
    assert sorted(left, key=repr) == sorted(out, key=repr)


def test_substring_dedup_cuts_no_text_by_another(spark):
    rng = random.Random(4)
    shared = prose(rng, 60).replace("\n", " ")
    alone = ["é" * 200 + " " + prose(rng, 30) for _ in range(3)]
    rows = [(None, shared), (None, alone[0]), (7, "Before it. " + shared), (7, alone[1]), (7, alone[2]), (1, shared)]
    got = sorted(((r.doc_id or 0, r.text) for r in substring_dedup.apply(docs_frame(spark, rows)).collect()))
    assert [t for d, t in got if t in alone] and sorted(t for d, t in got if t in alone) == sorted(alone)
    assert (1, shared) in got and (0, "") in got and any(d == 7 and t.strip() == "Before it." for d, t in got)


def test_short_passages_among_short_sentences(spark):
    """51 to 60 words that begin and end inside sentences of 4 to 40 words: found, all but their ends."""
    rng = random.Random(28)
    rows, size, found = [], {}, defaultdict(int)

    def sentences(n):
        out = []
        while len(out) < n:
            k = rng.randint(4, 40)
            out += ["w%x" % rng.randrange(1 << 30) for _ in range(k)]
            out[-1] += rng.choice([".", "!", ".\n"])
        return " ".join(out[:n]).replace("\n ", "\n")
    for k in range(200):
        shared = sentences(51 + k % 10)
        rows += [(2 * k, sentences(rng.randint(1, 60)) + " " + shared + " " + sentences(40)),
                 (2 * k + 1, sentences(rng.randint(1, 60)) + " " + shared + " " + sentences(40))]
        size[2 * k + 1] = len(shared)
    for r in substring_dedup.repeated_ranges(docs_frame(spark, rows)).collect():
        found[r.doc_id] += r.end_byte - r.start_byte
    assert set(found) <= set(size)                       # nothing else is cut
    assert len(found) >= 0.95 * len(size)
    assert sum(found[d] / n for d, n in size.items()) >= 0.75 * len(size)


def test_substring_apply(spark):
    rng = random.Random(3)
    shared, a, b = prose(rng, 60).replace("\n", " "), prose(rng, 40), prose(rng, 40)
    rows = [(1, a + "\n" + shared), (2, b + "\n" + shared + "\nThe end."), (3, None), (4, "")]
    out = {r.doc_id: r.text for r in substring_dedup.apply(docs_frame(spark, rows)).collect()}
    assert out[1] == rows[0][1] and out[2] == b + "\n\nThe end." and out[3] is None and out[4] == ""


def test_long_sentence_is_found_anywhere(spark):
    rng = random.Random(8)
    words = lambda n: " ".join("w%x" % rng.randrange(5000) for _ in range(n))
    shared = words(400)
    rows = [(1, words(300) + " " + shared + " " + words(77)), (2, words(131) + " " + shared + " " + words(300))]
    got = substring_dedup.repeated_ranges(docs_frame(spark, rows)).collect()
    assert {r.doc_id for r in got} == {2} and sum(r.end_byte - r.start_byte for r in got) > 0.7 * len(shared)


def test_passages_inside_long_sentences(spark):
    """51 to 60 words in the middle of lines without stops, and 52-word lines: found to the byte."""
    rng = random.Random(18)
    words = lambda n: " ".join("w%x" % rng.randrange(1 << 30) for _ in range(n))
    rows, wanted = [], {}
    for k in range(60):
        shared = words(51 + k % 10)
        before = words(rng.randint(1, 70)) + " "
        rows += [(2 * k, words(rng.randint(1, 70)) + " " + shared + " " + words(9)), (2 * k + 1, before + shared + " " + words(rng.randint(1, 70)))]
        wanted[2 * k + 1] = (len(before), len(before) + len(shared))
    for k in range(200, 320, 2):
        shared = words(52)
        rows += [(k, words(5) + "\n" + shared), (k + 1, shared + "\n" + words(5))]
        wanted[k + 1] = (0, len(shared))
    got = substring_dedup.repeated_ranges(docs_frame(spark, rows)).collect()
    assert {r.doc_id: (r.start_byte, r.end_byte) for r in got} == wanted and len(got) == len(wanted)


# ---- all ----

def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    for df in (line_dedup.removed_lines(empty), line_dedup.apply(empty), ngram_join.near_duplicates(empty), ngram_join.apply(empty),
               decontaminate.contaminated(empty, items), decontaminate.apply(empty, items.limit(0)),
               decontaminate.contaminated(empty, items, max_sent=0), substring_dedup.repeated_ranges(empty), substring_dedup.apply(empty)):
        assert df.count() == 0
    full = docs_frame(spark, [(1, "a b c d e f g")])
    assert decontaminate.contaminated(full, items.limit(0)).count() == 0
    assert decontaminate.contaminated(full, items.limit(0), max_sent=-1).count() == 0


def test_words_view():
    import pyarrow as pa
    texts = ["", "a b", None, " ", "c", "d\ne", "ü ñ"]
    w = Words(pa.array(texts))
    assert w.counts().tolist() == [0, 2, 0, 0, 1, 2, 2]
    assert [w.buf[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)] == ["a", "b", "c", "d", "e", "ü", "ñ"]
    v = Words(pa.array(["zz", *texts]).slice(1))
    assert (v.hashes() == w.hashes()).all() and len(set(w.hashes().tolist())) == 7
