"""Token counts of whole texts.

An Arrow function encodes batches that are balanced by bytes and returns lengths
only.  Long texts are split at safe boundaries: before a space that follows another
character than a space.  No piece of the vocabulary has a space mark after another
character (this is checked when the model is loaded), so no merge crosses such a
boundary, and since the model puts a space mark before every text, the parts are
encoded without their leading space and the counts add up to the whole text's.

Defined cases: a null text is empty and has no tokens.  Extra columns pass through;
n_bytes, n_tokens and over_limit are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tierlake.llm.words import text_slices

PART_CHARS = 1 << 14
BATCH_BYTES = 1 << 18
LIMIT = 4096
MARK = "▁"

_loaded: dict = {}


class Counter:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        crossing = any(MARK in p.lstrip(MARK) for p in pieces)
        # does the model put one mark before a text and keep runs of spaces?
        marks = self.model.encode("a  b", out_type=str)
        self.safe = not crossing and "".join(marks) == f"{MARK}a{MARK}{MARK}b"

    @classmethod
    def of(cls, path: str) -> Counter:
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def parts(self, text: str, size: int = PART_CHARS) -> list[str]:
        if not self.safe:
            return [text]
        out, at = [], 0
        while len(text) - at > size:
            cut = text.rfind(" ", at + 1, at + size)
            while cut > at and text[cut - 1] in (" ", MARK):
                cut -= 1
            if cut <= at + 1:      # no boundary here: the next one after
                cut = text.find(" ", at + size)
                while 0 <= cut and text[cut - 1] in (" ", MARK):
                    cut = text.find(" ", cut + 1)
                # a part of no characters would have no tokens, while a last space has one
                if cut < 0 or cut + 1 == len(text):
                    break
            out.append(text[at:cut])
            at = cut + 1           # the model adds this space again
        return [*out, text[at:]]

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        batch: list[str] = []
        owner: list[int] = []
        held = 0

        def encode() -> None:
            nonlocal held
            for i, ids in zip(owner, self.model.encode(batch, num_threads=1)):
                out[i] += len(ids)
            batch.clear()
            owner.clear()
            held = 0

        for i, text in enumerate(texts):
            for part in self.parts(text):
                n = 4 * len(part) if not part.isascii() else len(part)
                if batch and held + n > BATCH_BYTES:
                    encode()
                batch.append(part)
                owner.append(i)
                held += n
        if batch:
            encode()
        return out


def count_tokens(documents: DataFrame, model: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``documents`` without the text, plus n_bytes (UTF-8), n_tokens and over_limit."""
    made = ("n_bytes", "n_tokens", "over_limit")
    kept = [f.name for f in documents.schema if f.name != text and f.name not in made]
    schema = (documents.select(*kept).schema.add("n_bytes", "long").add("n_tokens", "long")
              .add("over_limit", "boolean"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(model)
        for batch in batches:
            for rows, texts in text_slices(batch, text):
                n = counter.counts([t.decode() if t else "" for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in kept),
                     pa.array([len(t) if t else 0 for t in texts], pa.int64()), pa.array(n, pa.int64()),
                     pa.array([k > limit for k in n], pa.bool_())], names=[*kept, *made])

    return documents.select(*kept, text).mapInArrow(run, schema)
