"""Small planted tables and brute-force helpers of the operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source); columns of ``documents``, and extra ones
    whose names clash with the operators' own."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "h", len(r[1] or "")) for r in rows]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(full, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in ("doc", "line", "n", "h", "node", "key", "item", "kept", "_key", "w", "_d", "_k", "_t", "_s", "_gone", "_ranges", "y", "x", "chunk")])


def prose(rng, n, vocabulary=4000):
    """n words in sentences of 4 to 14, some as lines."""
    out = []
    while len(out) < n:
        k = min(rng.randint(4, 14), n - len(out))
        s = ["w%x" % rng.randrange(vocabulary) for _ in range(k)]
        s[0] = s[0].capitalize()
        s[-1] += rng.choice([".", ".", "!", ".\n"])
        out += s
    return " ".join(out).replace("\n ", "\n").strip()


ODD = [None, "", " \n\t ", "one", "two words", "éàü ñ 中文 🙂", "a\x0bb\x0cc\r\nd", "A. B! C? D.\n\nA. B! C? D.", "\n\n\n"]


def corpus(seed=1, n=60):
    """Prose with exact copies, near copies, shared passages, shared lines and odd texts."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(3, 180)) for _ in range(n)]
    passage = prose(rng, 70).replace("\n", " ")
    line = " ".join("b%x" % rng.randrange(99) for _ in range(12))
    out = list(base) + ODD
    for t in base[:12]:
        out.append(t)
        w = t.split(" ")
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(len(w))] = "edit%x" % rng.randrange(9)
        out.append(" ".join(w))
    for t in base[12:20]:
        out.append(t + "\n" + passage + "\n" + prose(rng, 20))
        out.append(line + "\n" + t)
        out.append(line.replace("b", "b0", 1) + "\n" + prose(rng, 30))
    out.append(base[20] * 40)
    rng.shuffle(out)
    rows = [(i * 3 + 1, t, "h%d" % (i % 3) if i % 7 else None) for i, t in enumerate(out)]
    return rows + [(None, base[1], "h1"), (None, "only a null id has these words here", None), rows[5], rows[6], rows[6]]
