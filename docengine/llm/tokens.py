"""Token ids of whole texts by a public tokenizer file.

The file of ``word_bpe_49k.json`` drops white space before anything else and
no token crosses it, so the ids of a text are those of its white-space-free
parts in a row.  Parts repeat, so each worker keeps the ids of those it saw
last; the ids are those of ``Tokenizer.encode`` (tested against it).
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from docengine.llm.common import text_column, texts

TOKENIZER = "word_bpe_49k.json"
MEMO = 300_000  # parts a worker keeps in each of two generations


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter a byte-level vocabulary writes for it.

    Printable bytes stand for themselves, the others for the code points
    from 256 on, in ascending order.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder(dict):
    """Part of a text -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.older = self.tokenizer.model, _byte_letters(), {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self._encode(part)
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        self[part] = ids
        return ids

    def _encode(self, part: str) -> bytes:
        # One run of plain Latin letters is one token word: no need for the
        # normalizer and the splitting expression, and case does not matter.
        if part.isalpha():
            if part.isascii():
                lower = part.lower()
            elif max(part) < "ƀ" and len(lower := part.lower()) == len(part) and max(lower) < "ƀ":
                pass
            else:
                return self._whole(part)
            if lower != part:
                return self[lower]
            word = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        if part[-1:] in (".", ",") and part[:-1].isalpha():
            return self[part[:-1].lower() if part.isascii() else part[:-1]] + self[part[-1]]
        return self._whole(part)

    def _whole(self, part: str) -> bytes:
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes() if part else b""

    def text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(docs: DataFrame, emit, schema: str, path: str | None = None) -> DataFrame:
    """``emit(doc_ids, ids)`` over batches of (doc_id, packed ids of the whole text)."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).text
        for b in batches:
            if b.num_rows:
                yield from emit(b.column(0).to_pylist(), [encode(t) for t in text_column(b)])

    return texts(docs).mapInArrow(run, schema)
