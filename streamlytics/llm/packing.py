"""Operator 7, harmonic packing into sequences of ``capacity`` ids.

A piece of length l belongs to reciprocal class k when capacity // (k + 1) < l <=
capacity // k, and a bin of class k holds exactly k pieces. As documents may be cut
freely, a document is cut where that makes classes fit: whole sequences first, then the
rest, unless it nearly fills its class's share, gives up a head of exactly the next class's
share, and so on; what remains is short, and short pieces fill their bins almost fully.
Each worker (input partition) fills its bins on its own. The pieces left in its unfinished
bins, fewer than k a class, are packed together by decreasing length, so a worker leaves
about one partly filled sequence.

Ids are those of the given byte-level BPE, then ``end_id``. Defined cases: a null text is
empty (its document is the end id alone); a null ``doc_id`` stays null; repeated rows are
packed each; an empty table gives an empty result; texts are encoded whole however long;
other columns are not read. Sequence numbers come from the partition number and the order
inside it: a task that runs again after a loss gives the same ones.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..session import ship_package

CAPACITY, END_ID, FULL = 2048, 1, 0.97
SMALLEST = 48
SPECIAL = "<|endoftext|>"
_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long")


@lru_cache(maxsize=2)
def _encoders(ranks_path: str, json_path: str):
    """The vocabulary as ranks, for ordinary text, and as the JSON that defines the ids, for
    texts with the special string; both give the same ids for ordinary text."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return fast, Tokenizer.from_file(json_path)


def encode(text: str | None, ranks_path: str, json_path: str) -> list[int]:
    fast, exact = _encoders(ranks_path, json_path)
    if not text:
        return []
    if SPECIAL in text:
        return exact.encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


def cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of n ids, in order; they sum to n."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        share = capacity // k
        if rest <= SMALLEST or rest >= FULL * share:
            out.append(rest)
            break
        head = capacity // (k + 1)
        out.append(head)
        rest -= head
    return out


class _Bins:
    """The open bin of each class, and the sequences this worker has closed."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.n = capacity, {}, 0

    def add(self, piece: tuple) -> list[tuple]:
        """Puts a piece in its class's bin; the bin's pieces, with sequence, once full."""
        k = self.capacity // piece[2]
        own = self.open.setdefault(k, [])
        own.append(piece)
        if len(own) < k:
            return []
        del self.open[k]
        return self._close(own)

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        at, out = 0, []
        for p in pieces:
            out.append((*p, self.n, at))
            at += p[2]
        self.n += 1
        return out

    def rest(self) -> list[tuple]:
        """The unfinished bins' pieces, longest first, each where it fits first."""
        bins: list[list] = []
        room: list[int] = []
        for p in sorted((p for own in self.open.values() for p in own), key=lambda p: -p[2]):
            i = next((i for i, r in enumerate(room) if r >= p[2]), -1)
            if i < 0:
                bins.append([])
                room.append(self.capacity)
            bins[i].append(p)
            room[i] -= p[2]
        self.open = {}
        return [x for b in bins for x in self._close(b)]


def _packer(capacity: int, end_id: int, ranks_path: str, json_path: str, with_ids: bool):
    def run(batches):
        worker = TaskContext.get().partitionId() << 33
        bins = _Bins(capacity)

        def batch(rows):
            cols = list(zip(*rows)) if rows else [()] * 9
            doc, start, length, crc, total, ids, seq, off = cols
            arrays = [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                      pa.array(crc, pa.int64()), pa.array(total, pa.int64()),
                      pa.array(np.array(seq, np.int64) + worker), pa.array(off, pa.int64())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, np.uint32).astype(np.int32) for x in ids], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        done: list[tuple] = []
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array([*encode(text.as_py(), ranks_path, json_path), end_id], "<u4")
                at = 0
                for n in cuts(len(ids), capacity):
                    part = ids[at:at + n].tobytes()
                    done += bins.add((doc, at, n, zlib.crc32(part), len(ids), part if with_ids else None))
                    at += n
                if len(done) >= (1000 if with_ids else 20000):
                    yield batch(done)
                    done = []
        done += bins.rest()
        if done:
            yield batch(done)
    return run


def pack(docs: DataFrame, ranks_path: str, json_path: str, capacity: int = CAPACITY,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece; with ``with_ids`` its ids as well. No shuffle."""
    ship_package(docs.sparkSession)
    schema = _SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(
        _packer(capacity, end_id, ranks_path, json_path, with_ids), schema)
