"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Texts are encoded as the library would encode them whole.  A long text is first cut at
places where the split pattern ends a match whatever stands around them: before white
space that follows something else, after the last letter of a run of letters and after
the last digit of a run of digits.  No match reaches over such a place and no match
looks beyond it (the one look-ahead, of white space, looks at what follows white space),
so the parts' ids put together are the whole text's.

White space is the exception to handle by hand: its matches back off one character
before a visible one, and the pattern's engine gives up on very long runs.  A run longer
than ``PART_CHARS`` is therefore matched here by the same rule and merged as one piece.
A run of letters, digits or signs without a place to cut is one match and is encoded
whole, in a time that grows almost linearly with its length.

Decoding joins the raw bytes of the ids; it never goes through text, so ids that split a
character are no special case.  Digests are fed part by part, so memory holds the ids of
one part, not of one text.

Defined cases: a null text is empty, has no ids and decodes to no bytes; bytes that are
no UTF-8 are replaced by U+FFFD before encoding; repeated rows give repeated results;
extra columns pass through, those named like a made column are replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from tierlake.llm.words import text_slices

PART_CHARS = 1 << 16
MADE = ("n_tokens", "ids_sha256", "decoded_sha256")


class ByteBpe:
    """The library's encoding for one rank file and split pattern."""

    _made: dict[tuple[str, str], ByteBpe] = {}

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(ranks_path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # classes that later versions of Unicode only add to
        self.place = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})"
                                   r"|(?<=\p{L})(?=[\p{N}\p{P}\p{S}])|(?<=\p{N})(?=[\p{L}\p{P}\p{S}])")
        self.space = regex.compile(r"\p{White_Space}{2,}")

    @classmethod
    def of(cls, ranks_path: str, pattern: str) -> ByteBpe:
        key = (ranks_path, pattern)
        if key not in cls._made:
            cls._made[key] = cls(*key)
        return cls._made[key]

    def parts(self, text: str, size: int = PART_CHARS) -> Iterator[tuple[str, bool]]:
        """(part, is it one match): cut at safe places, each part about ``size`` long."""
        at = 0
        while len(text) - at > size:
            cut = self.place.search(text, at + size)
            end = cut.start() if cut else len(text)
            yield from self._spaced(text[at:end], size)
            at = end
        yield from self._spaced(text[at:], size)

    def _spaced(self, part: str, size: int) -> Iterator[tuple[str, bool]]:
        """``part`` with its runs of more than ``size`` white spaces apart.  A part ends in white
        space only where the text ends."""
        at = 0
        for run in self.space.finditer(part):
            if run.end() - run.start() <= size:
                continue
            if run.start() > at:
                yield part[at:run.start()], False
            # the run's match leaves its last character to what follows, if anything does
            at = run.end() - (run.end() < len(part))
            yield part[run.start():at], True
        if at < len(part):
            yield part[at:], False

    def encode_parts(self, text: str, size: int = PART_CHARS) -> Iterator[list[int]]:
        for part, one_match in self.parts(text, size):
            if one_match:
                yield self.encoding._encode_single_piece(part)
            else:
                yield self.encoding.encode_ordinary(part)

    def encode(self, text: str, size: int = PART_CHARS) -> list[int]:
        return [i for ids in self.encode_parts(text, size) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)

    def digests(self, text: str, size: int = PART_CHARS) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the comma-joined ids, SHA-256 of the decoded bytes)."""
        n, joined, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.encode_parts(text, size):
            joined.update((("," if n and ids else "") + ",".join(map(str, ids))).encode())
            decoded.update(self.decode(ids))
            n += len(ids)
        return n, joined.hexdigest(), decoded.hexdigest()


def _kept(documents: DataFrame, text: str, made: tuple[str, ...]) -> list[str]:
    return [f.name for f in documents.schema if f.name != text and f.name not in made]


def _mapped(documents: DataFrame, column: str, kept: list[str], schema, compute) -> DataFrame:
    """``kept`` columns and what ``compute`` makes of each value of ``column``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, column):
                made = compute(texts)
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), *made],
                                                 names=[*kept, *schema.names[len(kept):]])
    return documents.select(*kept, column).mapInArrow(run, schema)


def encode(documents: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``documents`` without the text, plus ``ids`` (array of int) of the whole text."""
    kept = _kept(documents, text, ("ids",))

    def compute(texts):
        bpe = ByteBpe.of(ranks, pattern)
        return [pa.array([bpe.encode(t.decode(errors="replace")) if t else [] for t in texts],
                         pa.list_(pa.int32()))]
    return _mapped(documents, text, kept, documents.select(*kept).schema.add("ids", ArrayType(IntegerType())), compute)


def decode(encoded: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The raw bytes of every row's ids as ``decoded`` (null ids: none); the ids go."""
    kept = [f.name for f in encoded.schema if f.name not in (ids, "decoded")]
    schema = encoded.select(*kept).schema.add("decoded", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.of(ranks, pattern)
        for b in batches:
            out = [bpe.decode(v) if v else b"" for v in (x.as_py() for x in b.column(ids))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(out, pa.binary())],
                                             names=[*kept, "decoded"])
    return encoded.select(*kept, ids).mapInArrow(run, schema)


def round_trip(documents: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``documents`` without the text, plus n_tokens, ids_sha256 (of the decimal ids, comma-joined)
    and decoded_sha256 (of the bytes that the ids decode to)."""
    kept = _kept(documents, text, MADE)
    schema = (documents.select(*kept).schema.add("n_tokens", "long").add("ids_sha256", "string")
              .add("decoded_sha256", "string"))

    def compute(texts):
        bpe = ByteBpe.of(ranks, pattern)
        found = [bpe.digests(t.decode(errors="replace") if t else "") for t in texts]
        return [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
    return _mapped(documents, text, kept, schema, compute)
