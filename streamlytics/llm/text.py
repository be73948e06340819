"""Vectorised text helpers shared by the operators (numpy over Arrow buffers).

A word is a maximal run of bytes other than space and \\x09-\\x0D. Python's ``bytes``
methods and the tables below split on exactly these, and every such byte is ASCII, so
words of the UTF-8 bytes are words of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLOCK = 1 << 17
_powers: dict = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: hashes that differ stay different, bits spread."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, _BLOCK)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def text_chunks(batches, column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``limit`` bytes of text (a longer text is a
    piece of its own), so that the arrays made from a piece stay bounded."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        size = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        part = np.cumsum(size) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                yield batch.slice(int(a), int(b - a))


class Words:
    """The words of a column of texts: one flat numpy view, no Python object per word.

    ``buf`` holds the texts' bytes back to back, ``offs`` where each text begins,
    ``starts``/``ends`` the words, ``first[i]:first[i + 1]`` the words of text i.
    Null texts have none. ``table`` maps bytes before words are found, ``space`` marks the
    bytes between words, where not the default's.
    """

    def __init__(self, column: pa.Array, lower: bool = False, table: np.ndarray | None = None, space: np.ndarray = SPACE):
        column = pc.fill_null(column, "") if column.null_count else column
        column = column.cast(pa.large_string())
        n = len(column)
        offs = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.raw = raw[offs[0]:offs[-1]]
        self.offs = offs - offs[0]
        table = LOWER if lower and table is None else table
        self.buf = self.raw if table is None else table[self.raw]
        space = space[self.buf]
        inside = ~space
        begin, end = inside.copy(), inside.copy()
        if len(begin):
            begin[1:] &= space[:-1]
            end[:-1] &= space[1:]
            heads = self.offs[:-1][np.diff(self.offs) > 0]
            begin[heads] = inside[heads]
            end[heads[1:] - 1] = inside[heads[1:] - 1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, self.offs)
        self.n = n

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, equal for equal words in any task."""
        return span_hashes(self.buf, self.starts, self.ends)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts())


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of ascending, disjoint spans of ``buf``, in blocks."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK, side="right")))
        at = starts[i]
        sub = buf[at:ends[j - 1]]
        up, down = _powers_to(len(sub) + 1)
        total = np.zeros(len(sub) + 1, np.uint64)
        np.cumsum((sub.astype(np.uint64) + np.uint64(1)) * up[:len(sub)], out=total[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def runs_hash(word: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of k neighbouring values (length len(word) - k + 1, at least 0)."""
    n = max(0, len(word) - k + 1)
    out = np.full(n, np.uint64(seed + 1), np.uint64)
    for i in range(k):
        out += word[i:i + n] * np.uint64(pow(0xD6E8FEB86659FD93, 2 * i + 1, 1 << 64))
    return mix(out)


def shingles(words: Words, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of each text's k-word shingles, with repeats, in text order. A
    text of 1 to k - 1 words has one shingle, all of it; a text without words has none."""
    h = words.hashes() if hashes is None else hashes
    doc = words.doc_of_word()
    runs = runs_hash(h, k)
    whole = doc[:len(runs)] == doc[k - 1:] if len(runs) else np.zeros(0, bool)
    value, at = runs[whole], doc[:len(runs)][whole]
    count = words.counts()
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.array([_fold(h[words.first[i]:words.first[i + 1]]) for i in short], np.uint64)
        order = np.argsort(np.concatenate([at, short]), kind="stable")
        value, at = np.concatenate([value, extra])[order], np.concatenate([at, short])[order]
    return value, at


def _fold(h: np.ndarray) -> np.uint64:
    return runs_hash(h, len(h), seed=len(h))[0]


def distinct_per_text(value: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The values without repeats inside a text, sorted by (text, value); and n + 1 bounds."""
    order = np.lexsort((value, at))
    value, at = value[order], at[order]
    if len(value):
        fresh = np.ones(len(value), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1])
        value, at = value[fresh], at[fresh]
    return value, np.searchsorted(at, np.arange(n + 1))


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list array: values[bounds[i]:bounds[i + 1]] for each i."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
