"""Words of whole texts as 64-bit hashes, vectorised over blocks of texts.

A word is a maximal run of ASCII digits, ASCII letters (lower-cased) and
non-ASCII characters.  In UTF-8 every byte of a non-ASCII character is at least
0x80, so the rule is exact on bytes.  A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20          # bytes handled by one set of numpy arrays

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_NON_WORD = bytes(i for i in range(256) if not _IS_WORD[_LOWER[i]])

_BASE = 0x9E3779B97F4A7C15     # odd, so it has an inverse modulo 2^64
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n, BLOCK_BYTES) + 1
        _POWERS[:] = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(29))


def _pieces(text: bytes) -> Iterator[bytes]:
    """Cut a long text before a byte that is in no word."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        end = at + BLOCK_BYTES
        cut = max(text.rfind(bytes([c]), at + 1, end) for c in _NON_WORD)
        while cut < 0 and end < len(text):   # one word longer than a block
            if text[end] in _NON_WORD:
                cut = end
            end += 1
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets): words of text i are offsets[i]:offsets[i+1]."""
    counts = np.zeros(len(texts), dtype=np.int64)
    found: list[np.ndarray] = []
    part: list[bytes] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if part:
            h, of = _hash_block(part)
            found.append(h)
            np.add.at(counts, np.asarray(owner, dtype=np.int64)[of], 1)
        part.clear()
        owner.clear()
        held = 0

    for i, text in enumerate(texts):
        if not text:
            continue
        for piece in (text,) if len(text) <= BLOCK_BYTES else _pieces(text):
            if held + len(piece) > BLOCK_BYTES:
                flush()
            part.append(piece)
            owner.append(i)
            held += len(piece) + 1
    flush()
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(counts, out=offsets[1:])
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), offsets


def _hash_block(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buf = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)]
    word = np.zeros(len(buf) + 1, dtype=bool)
    word[1:] = _IS_WORD[buf]
    edges = np.flatnonzero(word[1:] != word[:-1])
    start, end = edges[::2], edges[1::2]
    power, inverse = _powers(len(buf))
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:len(buf)], out=sums[1:])
    h = (sums[end] - sums[start]) * inverse[start]
    first = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
    return mix(h + (end - start).astype(np.uint64)), np.searchsorted(first, start, "right") - 1


def text_slices(batch: pa.RecordBatch, column: str,
                most_bytes: int = 4 * BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch of about ``most_bytes`` of text each (one row at least),
    with the texts as UTF-8 bytes."""
    col = batch.column(column).cast(pa.large_binary())
    at, held, texts = 0, 0, []
    for i in range(batch.num_rows):
        v = col[i].as_py()
        n = len(v) if v else 0
        if texts and held + n > most_bytes:
            yield batch.slice(at, i - at), texts
            at, held, texts = i, 0, []
        texts.append(v)
        held += n
    if texts:
        yield batch.slice(at), texts
