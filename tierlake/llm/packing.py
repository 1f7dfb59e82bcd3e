"""Token packing by Karmarkar-Karp multiway differencing.

A document's ids (byte-level BPE, then the end id 0) are cut into full windows, each a
sequence of its own, and a rest.  The rests are packed whole, per bundle of ``BUNDLE``:
each piece starts as a partial partition into k windows, and the two partitions of largest
imbalance are merged with their loads opposed, until one is left.  Its windows are
nearly equal; while the largest exceeds the capacity, k rises by one, as long as not more
than a share ``SPARE`` of the bundle is padding.  Then only a window that still exceeds the
capacity is cut, where it is full; what was cut off, in parts as long as the other windows lack
on average, is differenced again with those that lack more than ``NEAR`` ids.  Each such round
closes at least one full window.

A bundle lies within one task, so nothing is shuffled, and a lost task is simply
recomputed: a sequence id is the partition's number and a count in it.

Ids are those of the ``tokenizers`` library for the file.  It needs four times the CPU
seconds of ``tiktoken`` for the same vocabulary, so texts of Latin letters and ASCII
that hold no special token's string, where both give the same ids, go to the latter;
all others go to ``tokenizers`` itself.

Defined cases: a null text is empty, so it has the end id only; repeated rows are
packed once each; no rows give no pieces.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tierlake.llm.words import text_slices

CAPACITY = 1024
BUNDLE = 512
SPARE = 0.005
NEAR = 4
END_ID = 0

_NOT_LATIN = re.compile("[^\\x00-\\x1b\\x20-\\x84\\x86-\\u024f]")

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    _made: dict[tuple[str, str], Encoder] = {}

    def __init__(self, path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(w): int(r) for w, r in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("same vocabulary", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str, ranks_path: str) -> Encoder:
        key = (path, ranks_path)
        if key not in cls._made:
            cls._made[key] = cls(*key)
        return cls._made[key]

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special) or _NOT_LATIN.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp multiway differencing: item numbers of k windows of nearly equal load."""
    if k == 1:
        return [list(range(len(sizes)))]
    heap = []
    for i, s in enumerate(sizes):
        loads = np.zeros(k, dtype=np.int64)
        loads[-1] = s                                # ascending, least load taken off
        heap.append((-s, i, loads, [None] * (k - 1) + [i]))
    heapq.heapify(heap)
    tick = len(sizes)
    while len(heap) > 1:
        _, _, la, wa = heapq.heappop(heap)
        _, _, lb, wb = heapq.heappop(heap)
        loads = la + lb[::-1]                        # the largest meets the smallest
        order = np.argsort(loads, kind="stable")
        both = [a if b is None else b if a is None else (a, b) for a, b in zip(wa, reversed(wb))]
        loads = loads[order]
        loads -= loads[0]
        heapq.heappush(heap, (-int(loads[-1]), tick, loads, [both[o] for o in order.tolist()]))
        tick += 1

    def items(tree) -> list[int]:
        out, todo = [], [tree]
        while todo:
            t = todo.pop()
            if isinstance(t, tuple):
                todo += t
            elif t is not None:
                out.append(t)
        return out
    return [items(t) for t in heap[0][3]]


def windows(sizes: list[int], capacity: int = CAPACITY, most: int | None = None) -> list[list[int]]:
    """Item numbers of windows that hold whole items.  Their count rises while one exceeds the
    capacity; with ``most`` given, up to that, and some may then exceed it."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        out = differencing(sizes, k)
        if most is not None and k >= most or all(sum(sizes[i] for i in w) <= capacity for w in out):
            return [w for w in out if w]
        k += 1


def filled(sizes: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start, length): items are cut only where a window is full."""
    todo = [(i, 0, s) for i, s in enumerate(sizes) if s]
    out = []
    while todo:
        lengths = [p[2] for p in todo]
        most = int(sum(lengths) * (1 + SPARE) / capacity)
        parts = [sorted((todo[i] for i in w), key=lambda p: (-p[2], p)) for w in windows(lengths, capacity, most)]
        loads = [sum(p[2] for p in w) for w in parts]
        if max(loads) <= capacity:
            return out + parts
        todo = []
        gaps = [capacity - load for load in loads if load < capacity - NEAR]
        gap = -(-sum(gaps) // len(gaps)) if gaps else capacity
        for window, load in zip(parts, loads):
            if load < capacity - NEAR:
                todo += window
                continue
            full, room = [], capacity
            for item, start, length in window:
                here = min(room, length)
                if here:
                    full.append((item, start, here))
                n = -(-(length - here) // gap)
                edges = [start + here + (length - here) * j // max(n, 1) for j in range(n + 1)]
                todo += [(item, a, b - a) for a, b in zip(edges, edges[1:])]
                room -= here
            out.append(full)
    return out


def pack(documents: DataFrame, tokenizer: str, ranks: str, text: str = "text") -> DataFrame:
    """One row per piece: the columns of ``documents`` but the text, then start, length,
    ids_crc32, doc_tokens, sequence_id and offset (replaced where they exist)."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    made = T.StructType.fromDDL(PIECES)
    kept = [f for f in documents.schema if f.name != text and f.name not in made.names]
    schema = T.StructType(kept + made.fields)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        encoder = Encoder.of(tokenizer, ranks)
        sequence = TaskContext.get().partitionId() << 33
        rests: list[tuple] = []              # (kept values, start, doc tokens, ids)
        rows: list[tuple] = []

        def place(window: list[tuple]) -> None:
            nonlocal sequence
            at = 0
            for rest, skip, length in window:
                other, start, n, ids = rest
                rows.append((other, start + skip, length, zlib.crc32(ids[4 * skip:4 * (skip + length)]), n, sequence, at))
                at += length
            sequence += 1

        def settle() -> None:
            for window in filled([len(r[3]) // 4 for r in rests]):
                place([(rests[i], skip, length) for i, skip, length in window])
            rests.clear()

        def drain() -> pa.RecordBatch:
            values = [[r[0][k] for r in rows] for k in range(len(names))]
            values += [[r[k] for r in rows] for k in range(1, 7)]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(values, arrow)], schema=arrow)

        for batch in batches:
            for part, texts in text_slices(batch.select([*names, text]), text):
                others = list(zip(*(part.column(c).to_pylist() for c in names))) or [()] * len(texts)
                for other, t in zip(others, texts):
                    ids = (encoder.ids(t.decode()) if t else b"") + END_ID.to_bytes(4, "little")
                    n = len(ids) // 4
                    whole = n - n % CAPACITY
                    for start in range(0, whole, CAPACITY):
                        place([((other, 0, n, ids), start, CAPACITY)])
                    if whole < n:
                        rests.append((other, whole, n, ids[4 * whole:]))
                        if len(rests) == BUNDLE:
                            settle()
                if len(rows) > 20_000:
                    yield drain()
        settle()
        if rows:
            yield drain()

    return documents.select(*names, text).mapInArrow(run, schema)
