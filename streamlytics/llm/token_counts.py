"""Operator 3, exact token counts at every prefix by dynamic programming.

The vocabulary is a BPE with word ends (byte-level symbols, a word's last symbol carries
``</w>``), read from a ``tokenizers`` JSON; text is normalised (NFC, lower case) and cut
into pieces as that file says, and BPE never joins two pieces. So the count at a prefix is
that of the pieces before, plus that of the piece begun there.

Inside a piece the counts of all prefixes come from one pass: the encoding of s[:i] is the
encoding of some s[:i - l] and one more token, the only one that ends there and is
compatible with the token before it, i.e. BPE over the two tokens' symbols gives these two
back. Encodings of plain prefixes are kept by their last token; the prefix as a text of its
own ends with a word-end token instead, which is looked for in the same way. States are
shared by all pieces that begin alike, and pieces are remembered (bounded, then started anew).
``prefix_table`` stores the count at every prefix; ``token_totals`` asks the same tables for
whole texts and for the longest prefix within a limit.

Positions are code points of the normalised text; for a text in NFC whose lower case is as
long (nearly all) these are its own. Special strings are one token each, as the library has
them by default; a prefix that ends inside one counts it as ordinary text.

Defined cases: a null text is empty (0 bytes, 0 tokens, no row in the prefix table); a null
``doc_id`` stays null; repeated rows are counted each; an empty table gives an empty result;
whole texts are counted however long; other columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

LIMIT, PART = 2048, 8192
_KEEP_PIECES, _KEEP_STATES, _LONG_PIECE = 500_000, 400_000, 48
# The piece pattern, the contractions in it and the two special strings.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_SPECIALS = r"<\|startoftext\|>|<\|endoftext\|>"
_NEVER = 1 << 60


def _byte_symbols() -> list[str]:
    """The byte-level alphabet: printable bytes as themselves, others from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    shown = set(own)
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class _Totals(dict):
    """piece -> its count."""

    def __init__(self, counter):
        super().__init__()
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        if len(self) > _KEEP_PIECES:
            self.clear()
        out = self[piece] = self.counter.piece_total(piece)
        return out


class PrefixCounter(dict):
    """piece -> bytes, the count at each of the piece's prefixes (a short piece's)."""

    def __init__(self, json_path: str):
        super().__init__()
        with open(json_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.enders = {t[:-4] for t in self.vocab if t.endswith("</w>") and len(t) > 4}
        self.symbol = _byte_symbols()
        self.longest = max(len(t.removesuffix("</w>")) for t in self.vocab)
        made = {a + b: i for (a, b), i in reversed(self.ranks.items())}
        if any(max(made.get(a, -1), made.get(b, -1)) >= i for (a, b), i in self.ranks.items()):
            raise ValueError("merges must come after those that make their parts")
        self.fits: dict[tuple[str, str], bool] = {}
        self.edges: dict[str, tuple | None] = {}
        self.states: dict[str, tuple[str, int]] = {"": ("", 0)}    # of a piece's prefix: last token, count
        self.totals = _Totals(self)
        self.pattern = regex.compile(rf"\s+|{_PIECES}")
        self.special = regex.compile(_SPECIALS)

    def _edges(self, token: str):
        """How BPE builds a token from its symbols: what stands at its left and right edge
        up to (not at) which rank, in order; None if BPE doesn't give back the token."""
        symbols = self._symbols(token)
        left, right = [[symbols[0], _NEVER]], [[symbols[-1], _NEVER]]
        while len(symbols) > 1:
            rank, i = min((self.ranks.get(x, _NEVER), i) for i, x in enumerate(zip(symbols, symbols[1:])))
            if rank == _NEVER:
                return None
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            for chain, edge in ((left, symbols[0]), (right, symbols[-1])):
                if chain[-1][0] != edge:
                    chain[-1][1] = rank
                    chain.append([edge, _NEVER])
        return left, right

    @staticmethod
    def _symbols(token: str) -> list[str]:
        if token.endswith("</w>") and len(token) > 4:
            return [*token[:-5], token[-5:]]
        return list(token)

    def _fit(self, a: str, b: str) -> bool:
        """Whether BPE keeps tokens a, b as they are when b follows a (a may be none).

        Merges run by rank, left before right, so the two stay apart unless the symbols that
        meet at some time are a pair of a rank before the next change of either."""
        known = self.fits.get((a, b))
        if known is None:
            known = self.fits[a, b] = self._apart(a, b)
        return known

    def _edge(self, token: str):
        if token not in self.edges:
            self.edges[token] = self._edges(token)
        return self.edges[token]

    def _apart(self, a: str, b: str) -> bool:
        if self._edge(b) is None:
            return False
        if not a:
            return True
        right, left = self._edge(a)[1], self._edge(b)[0]
        i = j = 0
        while True:
            (x, until_x), (y, until_y) = right[i], left[j]
            rank = self.ranks.get((x, y), _NEVER)
            if rank < until_x and rank <= until_y and rank != _NEVER:
                return False
            if until_x == until_y == _NEVER:
                return True
            if until_x <= until_y:
                i += 1
            if until_y <= until_x:
                j += 1

    def _plain_state(self, text: str, i: int, last) -> tuple[str, int]:
        """Last token and count of the prefix text[:i] (byte symbols), given ``last`` of shorter ones."""
        for n in range(min(i, self.longest), 0, -1):
            own = text[i - n:i]
            if own in self.vocab:
                state = last(i - n)
                if self._fit(state[0], own):
                    return own, state[1] + 1
        raise ValueError(f"the vocabulary has no symbols for {text[:i]!r}")

    def _ended_count(self, text: str, i: int, last) -> int:
        """Count of text[:i] as a text of its own, which ends a word."""
        for n in range(min(i, self.longest), 0, -1):
            own = text[i - n:i]
            if own in self.enders:
                state = last(i - n)
                if self._fit(state[0], own + "</w>"):
                    return state[1] + 1
        raise ValueError(f"the vocabulary has no symbols for {text[:i]!r}")

    def _states(self, text: str, upto: int):
        """A function from a length, 0 to ``upto``, to that prefix's state."""
        if len(text) > _LONG_PIECE:
            states: list[tuple] = [("", 0)]
            for i in range(1, upto + 1):
                states.append(self._plain_state(text, i, states.__getitem__))
            return states.__getitem__
        if len(self.states) > _KEEP_STATES:
            self.states = {"": ("", 0)}
        if len(self.fits) > 2 * _KEEP_STATES:
            self.fits = {}
        known = self.states
        last = lambda j: known[text[:j]]
        at = upto
        while text[:at] not in known:
            at -= 1
        for i in range(at + 1, upto + 1):
            known[text[:i]] = self._plain_state(text, i, last)
        return last

    def piece_counts(self, piece: str) -> list[int]:
        """Counts at every prefix (in code points) of a piece."""
        if piece in _CONTRACTIONS:
            # a cut contraction is a quote and letters, pieces of their own
            return [sum(self.piece_counts(x)[-1] for x in self.pattern.findall(piece[:i]) if x != piece)
                    for i in range(1, len(piece))] + [self._ended_counts(piece)[-1]]
        return self._ended_counts(piece)

    def _ended_counts(self, piece: str) -> list[int]:
        raw = piece.encode()
        text = "".join(map(self.symbol.__getitem__, raw))
        last = self._states(text, len(text) - 1)
        return [self._ended_count(text, i, last) for i, b in zip(range(1, len(text) + 1), [*raw[1:], 0]) if b & 0xC0 != 0x80]

    def piece_total(self, piece: str) -> int:
        """Count of a whole piece."""
        if not self.piece(piece):
            return 0
        text = "".join(map(self.symbol.__getitem__, piece.encode()))
        return self._ended_count(text, len(text), self._states(text, len(text) - 1))

    def total_and_fit(self, text: str | None, limit: int) -> tuple[int, int]:
        """Count of the whole text, and the length of its longest prefix within the limit."""
        if not text or self.special.search(text):
            c = self.counts(text)
            fit = np.flatnonzero(c <= limit)
            return int(c[-1]) if len(c) else 0, int(fit[-1]) + 1 if len(fit) else 0
        parts = self.pattern.findall(normal(text))
        each = list(map(self.totals.__getitem__, parts))
        total = sum(each)
        if total <= limit:
            return total, sum(map(len, parts))
        # the count before a piece never falls, so only pieces from the last one within count
        before = np.cumsum([0, *each[:-1]])
        for j in range(int(np.searchsorted(before, limit, side="right")) - 1, -1, -1):
            inside = self.piece_counts(parts[j]) if self.piece(parts[j]) else [0] * len(parts[j])
            fit = [i for i, c in enumerate(inside, 1) if before[j] + c <= limit]
            if fit:
                return total, sum(map(len, parts[:j])) + fit[-1]
        return total, 0

    def __missing__(self, piece: str) -> bytes:
        out = bytes(len(piece)) if piece[0].isspace() and not self.piece(piece) else bytes(self.piece_counts(piece))
        if len(self) > _KEEP_PIECES:
            self.clear()
        self[piece] = out
        return out

    def piece(self, x: str) -> bool:
        return not _BLANK.fullmatch(x)

    def counts(self, text: str | None) -> np.ndarray:
        """Count at each non-empty prefix of the normalised text."""
        if not text:
            return np.zeros(0, np.int64)
        out, base, at = [], 0, 0
        for m in self.special.finditer(text):
            head = self._plain(text[at:m.end()])[:-1]
            n = len(normal(text[at:m.start()]))
            base_here = base + (int(head[n - 1]) if n else 0)
            out += [head + base, np.array([base_here + 1])]
            base, at = base_here + 1, m.end()
        out.append(self._plain(text[at:]) + base)
        return np.concatenate(out)

    def _plain(self, text: str) -> np.ndarray:
        parts = self.pattern.findall(normal(text))
        if not parts:
            return np.zeros(0, np.int64)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        if size.max() < 256:
            inner = np.frombuffer(b"".join(map(self.__getitem__, parts)), np.uint8).astype(np.int64)
        else:
            inner = np.concatenate([np.array(self.piece_counts(x), np.int64) if self.piece(x) else np.zeros(len(x), np.int64)
                                    for x in parts])
        total = inner[np.cumsum(size) - 1]
        return inner + np.repeat(np.cumsum(total) - total, size)


_BLANK = regex.compile(r"\s+")


def normal(text: str) -> str:
    text = unicodedata.normalize("NFC", text)
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


@lru_cache(maxsize=2)
def counter(json_path: str) -> PrefixCounter:
    return PrefixCounter(json_path)


def _summary(json_path: str, limit: int):
    def run(batches):
        table = counter(json_path)
        for batch in batches:
            rows = []
            for x in batch.column(1):
                text = x.as_py()
                rows.append((len((text or "").encode()), *table.total_and_fit(text, limit)))
            cols = list(zip(*rows)) if rows else [()] * 3
            n = pa.array(cols[1], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), n,
                 pa.array([x > limit for x in cols[1]], pa.bool_()), pa.array(cols[2], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])
    return run


def token_totals(docs: DataFrame, json_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (the longest prefix within the limit)."""
    ship_package(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(
        _summary(json_path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def _parts(json_path: str, part: int):
    def run(batches):
        table = counter(json_path)
        for batch in batches:
            for doc, x in zip(batch.column(0), batch.column(1)):
                c = table.counts(x.as_py())
                for at in range(0, len(c), part):
                    own = c[at:at + part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc.as_py()], pa.int64()), pa.array([at // part], pa.int64()),
                         pa.array([int(own.min())]), pa.array([int(own.max())]), pa.array([own.astype(np.int32)], pa.list_(pa.int32()))],
                        names=["doc_id", "part", "least", "most", "counts"])
    return run


def prefix_table(docs: DataFrame, json_path: str, part: int = PART) -> DataFrame:
    """doc_id, part, least, most, counts: the count at every prefix, ``part`` of them a row
    (element i of part p is prefix p * part + i + 1). Written once, it answers the functions
    below; least and most let Parquet skip parts."""
    ship_package(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(
        _parts(json_path, part), "doc_id long, part long, least long, most long, counts array<int>")


def count_at(table: DataFrame, asked: DataFrame, part: int = PART) -> DataFrame:
    """For each (doc_id, n_chars >= 1) of ``asked``: n_tokens of that prefix; none beyond the text."""
    asked = asked.select(F.col("doc_id").alias("d"), "n_chars")
    return table.join(asked, (F.col("doc_id") == F.col("d")) & (F.col("part") == F.floor((F.col("n_chars") - 1) / part))) \
        .filter((F.col("n_chars") - 1) % part < F.size("counts")) \
        .select("doc_id", "n_chars", F.element_at("counts", ((F.col("n_chars") - 1) % part + 1).cast("int")).cast("long").alias("n_tokens"))


def longest_within(table: DataFrame, budget: int, part: int = PART) -> DataFrame:
    """doc_id, n_chars: the longest prefix of at most ``budget`` tokens (of documents with one)."""
    fits = F.array_max(F.transform("counts", lambda c, i: F.when(c <= budget, i + 1)))
    return table.filter(F.col("least") <= budget).groupBy("doc_id") \
        .agg(F.max(F.col("part") * part + fits).alias("n_chars"))
