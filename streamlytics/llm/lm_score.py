"""Operator 5, language-model scoring with a causal self-attention model (``attention``).

Tokens are lower-cased (ASCII) words and one end a text. The model's probability of a word
is a mixture of the attention model's probability of its subword ids, given the text before,
and the word's share of the training tokens (``mix`` is the share's weight; unseen words have
none). Subwords are those of a byte-level BPE of ``size`` tokens, learnt from the training
split's ``SPELT`` commonest words and their counts (``vocabulary``); a public BPE's first ranks fill
what a small corpus leaves free.

Gathered from all training texts (crc32 of the id modulo ``modulus`` not ``held``): the
word counts, by partial sums and one shuffle by word; and all ids of all of them, for the
attention model, which learns from every word whatever the corpus's size. Training is
data-parallel, the texts dealt to tasks of about ``SHARE`` words: one task finds a first solution in at most
``WARM`` steps; then each of ``ROUNDS`` rounds sends the parameters (about 1 MB, fixed) to
tasks that each run Adam over their part of the windows, a ``ROUNDS``-th in each round, and
averages their results by Spark, ``FAN`` at a time.

Scoring goes by chunks of at most ``ROWS`` neighbouring rows, so of ``ROWS`` times
``LONG_TEXT`` bytes (a longer text is one by itself). The counts of the ``COMMON`` commonest words (a fixed bound) are sent to the tasks;
a chunk's other distinct words fetch theirs by a join, those that occur in no other chunk
keep their own, and texts and counts meet by chunk. Overlapping windows score each
subword once, many windows in one masked attention.

Defined cases: a null or blank text is its end alone; a null ``doc_id`` stays null and counts
as an empty text in the split; repeated rows are counted and scored each; without training
texts all counts are 0 and the attention model is an untrained one; an empty table gives an
empty result; texts are scored whole however long; other columns are not read.
"""

from __future__ import annotations

import base64
from collections import Counter
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from . import attention
from .labelled import remainder
from .tables import written
from .text import LOWER

SIZE, MIX, MODULUS, HELD = 4095, 0.35, 10, 0
ROWS, LONG_TEXT = 1024, 1 << 16
COMMON, _HELD_WORDS = 200_000, 500_000
SPELT, _SPELT_TOTAL, _LONG_WORD = 100_000, 1_000_000, 64
LINE, FAN = 64, 32
WARM, WARM_PASSES, ROUNDS, RATE, BATCH, SHARE = 500, 3, 2, 0.01, 320, 480_000
_LOWER = LOWER.tobytes()
_AHEAD = attention.WINDOW - attention.STEP + 3            # ids of a window before its first target
_WIDE = _AHEAD + attention.STEP + 1


def words_of(text: pa.Scalar) -> list[bytes]:
    raw = text.as_buffer() if text.is_valid else None
    return raw.to_pybytes().translate(_LOWER).split() if raw is not None else []


def _public(ranks_path: str, size: int) -> list[bytes]:
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return sorted((t for t, r in ranks.items() if r < size), key=ranks.get)


def vocabulary(counts: dict[bytes, int], ranks_path: str, size: int) -> tuple[bytes, ...]:
    """``size`` tokens in the order of their ranks: the bytes, then BPE's merges on the words of
    ``counts`` (each after a space, as bytes), then public ones. Counts are scaled to about
    ``_SPELT_TOTAL`` in all, so that the time is bounded; words over ``_LONG_WORD`` bytes wait."""
    from tokenizers import Tokenizer, models, trainers
    most = sorted(((n, w) for w, n in counts.items() if len(w) <= _LONG_WORD), reverse=True)[:SPELT]
    scale = min(1, _SPELT_TOTAL / max(1, sum(n for n, _ in most)))
    learnt = Tokenizer(models.BPE())
    learnt.train_from_iterator(
        chain.from_iterable([" " + w.decode("latin-1")] * max(1, round(n * scale)) for n, w in most),
        trainers.BpeTrainer(vocab_size=size, min_frequency=2, show_progress=False, initial_alphabet=list(map(chr, range(256)))))
    ranks = learnt.get_vocab()
    own = [t.encode("latin-1") for t in sorted(ranks, key=ranks.get)]
    return tuple(dict.fromkeys([*own, *_public(ranks_path, size)]))[:size]


class Spelling(dict):
    """word -> its subword ids, those of the word after a space. Kept words are bounded.
    ``ranks``: the tokens in order, or the path of a public table of them."""

    def __init__(self, ranks: str | tuple[bytes, ...], size: int):
        import tiktoken
        super().__init__()
        tokens = _public(ranks, size) if isinstance(ranks, str) else ranks
        self.encoder = tiktoken.Encoding("first", pat_str=_PIECES, mergeable_ranks={t: r for r, t in enumerate(tokens)}, special_tokens={})
        self.begins = np.zeros(size, bool)
        self.begins[[r for r, t in enumerate(tokens) if t[:1] == b" "]] = True

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        ids = self[word] = tuple(self.encoder.encode_ordinary(" " + word.decode(errors="replace")))
        return ids

    def all(self, words) -> list[tuple[int, ...]]:
        """The words' ids. New words are encoded together: words hold no space, so each begins
        with the only space it has."""
        if len(self) > _HELD_WORDS:
            self.clear()
        new = [w for w in words if w not in self]
        if new:
            ids = self.encoder.encode_ordinary(b" ".join([b"", *new]).decode(errors="replace"))
            heads = np.flatnonzero(self.begins[ids]).tolist()
            if len(heads) == len(new):
                self.update((w, tuple(ids[a:b])) for w, a, b in zip(new, heads, [*heads[1:], len(ids)]))
        return list(map(self.__getitem__, words))


_PIECES = r" [^ ]{0,255}|[^ ]{1,256}"      # a word, in parts if it is long


@lru_cache(maxsize=1)
def spelling(ranks: str | tuple[bytes, ...], size: int) -> Spelling:
    return Spelling(ranks, size)


def subwords(words: list[bytes], spelled: Spelling) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words and the places where words begin."""
    each = spelled.all(words)
    size = np.fromiter(map(len, each), np.int64, len(each))
    ids = np.fromiter(chain.from_iterable(each), np.int32, int(size.sum()))
    return ids, np.cumsum(size) - size


class _Numbers(dict):
    """word -> its number, in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n

    def of(self, text: pa.Scalar) -> np.ndarray:
        found = words_of(text)
        return np.fromiter(map(self.__getitem__, found), np.int32, len(found))


class _Spelt:
    """The ids of numbered words, for arrays of their numbers."""

    def __init__(self, number: _Numbers, spelled: Spelling):
        self.ids, self.begin = subwords(list(number), spelled)
        self.length = np.diff(np.append(self.begin, len(self.ids)))

    def __call__(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words and the places where words begin."""
        size = self.length[t]
        first = np.cumsum(size) - size
        return self.ids[np.repeat(self.begin[t] - first, size) + np.arange(int(size.sum()))], first


# ---- counts ----

def _partial_counts(batches):
    """Words, the end as an empty one, and their counts in a part of the texts."""
    own: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.int64())],
                                          names=["word", "c"])
    for batch in batches:
        for x in batch.column(0):
            own.update(words_of(x))
            own[b""] += 1
            if len(own) > _HELD_WORDS:
                yield out()
                own.clear()
    if own:
        yield out()


def _rare(sent):
    """Per chunk its distinct words outside the broadcast ones, with their training counts in it."""
    def run(batches):
        common = sent.value
        for batch in batches:
            chunk = np.asarray(batch.column(0))
            held = batch.column(2).to_pylist()
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for a, b in zip(cuts, cuts[1:]):
                own: Counter = Counter()
                seen: set = set()
                for i in range(a, b):
                    (seen if held[i] else own).update(filterfalse(common.__contains__, words_of(batch.column(1)[i])))
                names, n = list(own), list(own.values())
                more = [w for w in seen if w not in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(names) + len(more), chunk[a] if b > a else 0)), pa.array(names + more, pa.binary()),
                     pa.array(n + [0] * len(more), pa.int64())], names=["chunk", "word", "own"])
    return run


def common_words(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The words of the largest counts, at most ``most``: those above a limit that is found
    from a histogram (a few hundred rows)."""
    level = F.floor(F.log2("c") * 8)
    rows = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    limit, n = None, 0
    for r in rows:
        n += r.n
        if n > most:
            break
        limit = r.level
    if limit is None:
        return {}
    return {bytes(r.word): r.c for r in counts.filter(level >= limit).collect()}


def _chunked(docs: DataFrame, modulus: int, held: int) -> DataFrame:
    """doc_id, text, chunk, held_out; chunks are neighbouring rows of a file, so that a read
    again, by any task, deals the same ones."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), "_metadata.file_path", "_metadata.row_index")
    row = F.when(F.octet_length("text") > LONG_TEXT, -1 - F.col("row_index")).otherwise(F.floor(F.col("row_index") / ROWS))
    return docs.select("doc_id", "text", F.xxhash64("file_path", row).alias("chunk"),
                       (remainder(F.col("doc_id"), modulus) == held).alias("held_out"))


# ---- training ----

def _lines(ranks: str | tuple[bytes, ...], size: int):
    """All ids of each text and its end, in lines of ``LINE`` windows' targets at most, behind
    the ids that the first window has before them; in front of a text stand ends."""
    ahead, end = np.full(_AHEAD, size, np.int32), np.array([size], np.int32)

    def out(number: _Numbers, texts: list[np.ndarray]):
        spelt, rows = _Spelt(number, spelling(ranks, size)), []
        for t in texts:
            ids = np.concatenate([ahead, spelt(t)[0], end])
            rows.extend(ids[k:k + _AHEAD + LINE * attention.STEP] for k in range(0, len(ids) - _AHEAD, LINE * attention.STEP))
        bounds = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(rows)))], names=["w"])

    def run(batches):
        number, texts, pending = _Numbers(), [], 0
        for batch in batches:
            for x in batch.column(0):
                texts.append(number.of(x))
                pending += len(texts[-1]) + 1
                if pending > _HELD_WORDS:
                    yield out(number, texts)
                    number, texts, pending = _Numbers(), [], 0
        if texts:
            yield out(number, texts)
    return run


def cut_lines(lines, size: int) -> np.ndarray:
    """The windows of some lines: the ids before and among their targets, and how many targets
    they have. Each target stands in one window."""
    s = attention.STEP
    kind = np.int16 if size < 1 << 15 else np.int32
    out = [np.zeros((0, _WIDE), kind)]
    for line in lines:
        first = np.arange(0, len(line) - _AHEAD, s)
        full = np.concatenate([line, np.full(s, size)]).astype(kind)
        own = np.minimum(s, len(line) - _AHEAD - first).astype(kind)
        out.append(np.concatenate([full[first[:, None] + np.arange(_WIDE - 1)], own[:, None]], axis=1))
    return np.concatenate(out)


def _names(size: int) -> list[tuple[str, tuple]]:
    return [(k, v.shape) for k, v in attention.init(size, np.random.default_rng(0)).items()]


def _flat(p: dict) -> np.ndarray:
    return np.concatenate([v.ravel() for v in p.values()]).astype(np.float32)


def _unflat(flat: np.ndarray, size: int) -> dict:
    out, at = {}, 0
    for name, shape in _names(size):
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape).copy()
        at += n
    return out


def _train(sent, size: int, turn: int):
    """Adam over this task's windows of the round; its parameters in parts, with their weight."""
    def run(batches):
        from pyspark import TaskContext
        got = cut_lines((np.asarray(x.values) for b in batches for x in b.column(0)), size)
        task = TaskContext.get().partitionId()
        rng = np.random.default_rng(task)
        got = got[rng.permutation(len(got))]
        steps = min(WARM, WARM_PASSES * -(-len(got) // BATCH))
        if turn:
            got = got[turn - 1::ROUNDS]
            steps = -(-len(got) // BATCH)
        if not len(got) or (turn == 0 and task):
            return
        p = _unflat(sent.value, size)
        adam = attention.Adam(p, RATE / (1 + 3 * turn))
        w, s = attention.WINDOW + 2, attention.STEP
        tokens = 0
        for i in range(steps):
            at = i * BATCH % len(got)
            x = got[at:at + BATCH].astype(np.int32)
            scored = np.arange(s)[None, :] < x[:, -1:]
            logp, grad = attention.windows(p, x[:, :w], x[:, _AHEAD:_AHEAD + s], scored)
            adam.step(p, grad, len(logp))
            tokens += len(logp)
        flat = _flat(p)
        for k in range(0, len(flat), 1 << 14):
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([task], pa.int32()), pa.array([float(tokens)]),
                 pa.array([flat[k:k + (1 << 14)]], pa.list_(pa.float32()))], names=["part", "bucket", "n", "v"])
    return run


def _average(key, table):
    """Weighted mean of one part of the parameters over some tasks, with the summed weight."""
    n = np.asarray(table.column("n"))
    v = np.stack([np.asarray(x.values) for x in table.column("v")]).astype(float)
    mean = (v * n[:, None]).sum(axis=0) / n.sum()
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bucket": pa.array([key[1].as_py()], pa.int32()),
                     "n": pa.array([float(n.sum())]), "v": pa.array([mean.astype(np.float32)], pa.list_(pa.float32()))})


def averaged(done: DataFrame, tasks: int, fan: int = FAN) -> DataFrame:
    """The weighted mean of the tasks' parameters (part, bucket: the task, n, v), ``fan`` of them
    at a time, so that no group holds more however many tasks there are."""
    while True:
        done = done.groupBy("part", F.expr(f"bucket div {fan}").cast("int").alias("up")) \
            .applyInArrow(_average, "part int, bucket int, n double, v array<float>")
        tasks = -(-tasks // fan)
        if tasks == 1:
            return done


def train(docs: DataFrame, n_words: int, ranks: str | tuple[bytes, ...], size: int = SIZE) -> np.ndarray:
    """Parameters of the attention model, learnt from the texts of ``docs``, ``n_words`` long."""
    sc = docs.sparkSession.sparkContext
    # dealt before they are written, so that each round reads them without a shuffle
    shares = written(docs.select("text").mapInArrow(_lines(ranks, size), "w array<int>")
                     .repartition(max(1, n_words // SHARE)), "lines")
    n = shares.count()
    flat = _flat(attention.init(size, np.random.default_rng(7)))
    for turn in range(1 + ROUNDS if n else 0):
        own = shares if turn else shares.filter(F.spark_partition_id() == 0)
        done = own.mapInArrow(_train(sc.broadcast(flat), size, turn), "part int, bucket int, n double, v array<float>")
        mean = averaged(done, shares.rdd.getNumPartitions())
        got = sorted(mean.select("part", "v").collect())                # the model: its size is fixed
        flat = np.concatenate([np.array(r.v, np.float32) for r in got]) if got else flat
    return flat


# ---- scoring ----

def _score(sent, words, ends: int, ranks: tuple[bytes, ...], size: int, mix: float, total: int, distinct: int):
    log_all = np.log10(total + 0.1 * (distinct + 1))

    def run(key, left, right):
        p = _unflat(sent.value, size)
        common = words.value
        # texts as numbers of the chunk's words
        number = _Numbers()
        texts = list(map(number.of, left.column("text")))
        held = left.column("held_out").to_pylist()
        own = np.zeros(len(number) + 1, np.int64)            # words of no other chunk keep their count in this one
        learnt = [t for t, out in zip(texts, held) if not out]
        if learnt:
            own += np.bincount(np.concatenate(learnt), minlength=len(own))
        rare = dict(zip(right.column("word").to_pylist(), right.column("c").to_pylist()))
        count = np.array([common.get(w) or rare.get(w) or n for w, n in zip(number, own.tolist())], float)
        spelt = _Spelt(number, spelling(ranks, size))
        with np.errstate(divide="ignore"):
            share = np.log(np.append(count, ends) / max(total, 1)) + np.log(mix)
        base = np.log10(np.append(count, ends) + 0.1) - log_all
        seen = np.append(count, ends) > 0
        out = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}

        def flush(group: list[np.ndarray]) -> None:
            """Scores some texts: word numbers, with the end as the one after all words."""
            n = np.array([len(t) for t in group])
            t = np.concatenate(group)
            ids, first = spelt(t)
            word_bounds = np.concatenate([[0], np.cumsum(n)])
            bounds = np.append(first, len(ids))[word_bounds]
            win = attention.cut(ids, bounds, size)
            logp = np.concatenate([attention.score(p, *(x[k:k + 4096] for x in win)) for k in range(0, len(win[0]), 4096)])
            # with an end behind each text: its words' first places, and the end's own
            tokens = np.insert(t, word_bounds[1:], len(number))
            heads = np.insert(first, word_bounds[1:], bounds[1:]) + np.repeat(np.arange(len(n)), n + 1)
            word = np.add.reduceat(logp.astype(float), heads)
            both = np.logaddexp(share[tokens], word + np.log(1 - mix)) / np.log(10)
            at = word_bounds[:-1] + np.arange(len(n))
            out["score"] += np.add.reduceat(both, at).tolist()
            out["base_score"] += np.add.reduceat(base[tokens], at).tolist()
            out["n_tokens"] += (n + 1).tolist()
            out["n_known"] += np.add.reduceat(seen[tokens].astype(np.int64), at).tolist()

        group, pending = [], 0
        for t in texts:
            group.append(t)
            pending += len(t)
            if pending > 30_000:
                flush(group)
                group, pending = [], 0
        if group:
            flush(group)
        return pa.table({"doc_id": left.column("doc_id"), "held_out": left.column("held_out"),
                         "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
                         "train_tokens": pa.array([total] * len(texts), pa.int64()),
                         "base_score": pa.array(out["base_score"], pa.float64()), "score": pa.array(out["score"], pa.float64())})
    return run


def score(docs: DataFrame, ranks_path: str, size: int = SIZE, mix: float = MIX, modulus: int = MODULUS, held: int = HELD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10). ``docs``
    is a table read from files, or any DataFrame, which is written first."""
    spark = docs.sparkSession
    ship_package(spark)
    if not docs.inputFiles() or "_metadata" in docs.columns or docs.isStreaming:
        docs = written(docs.select("doc_id", "text"), "documents")
    base = _chunked(docs, modulus, held)
    texts = base.filter(~F.col("held_out")).select("text")
    counts = written(texts.mapInArrow(_partial_counts, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = texts.count()
    sc = spark.sparkContext
    words = sc.broadcast(common_words(counts.filter(F.col("word") != F.lit(b"")), COMMON))
    ranks = vocabulary(words.value, ranks_path, size)
    sent = sc.broadcast(train(texts, total - ends, ranks, size))
    rare = base.select("chunk", "text", "held_out").mapInArrow(_rare(words), "chunk long, word binary, own long") \
        .join(counts, "word").filter("c <> own").select("chunk", "word", "c")
    return base.groupBy("chunk").cogroup(rare.groupBy("chunk")).applyInArrow(
        _score(sent, words, ends, ranks, size, mix, total, distinct),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
