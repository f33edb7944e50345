"""Token ids of whole texts, and their pieces.

The tokenizer splits at white space before anything else, so the ids of a text are those of its
space-separated parts in order. Each part is encoded once and its ids kept as bytes; a text is then
a lookup and a join. A Python worker keeps the first ``CACHE_ENTRIES`` parts that it meets.

Most parts are one word, or one word and a run of ASCII marks. If its letters are Latin-1, normalising it is
putting it in lower case and it is not split any further, so it can go to the tokenizer's model
directly. All other parts take the whole way.
"""

from __future__ import annotations

import os
import zlib
from array import array
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfcurve.llm.common import map_batches, texts

END = 1
LENGTH = 4096
CACHE_ENTRIES = 400_000
CACHE_CHARS = 64


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: itself if it is printable, else the next
    unused one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.latin = str.maketrans({c: "".join(map(_byte_letters().get, chr(c).encode())) for c in range(256)})
        self.cache: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        # only a tokenizer of this kind splits and folds words as ``_word`` does
        self.folds = '"type":"Lowercase"' in self.tokenizer.to_str()

    def _whole(self, part: str) -> bytes:
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        """The ids of a part that the cache does not have; it gets it while there is room."""
        cache = self.cache
        word = part.rstrip(punctuation)
        if self.folds and word.isalpha() and len(word) <= CACHE_CHARS and (word.isascii() or ord(max(word)) < 256):
            low = word.lower()
            ids = cache.get(low)
            if ids is None:
                letters = low if low.isascii() else low.translate(self.latin)
                ids = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
            if len(word) < len(part):
                marks = part[len(word) :]
                if marks not in self.marks:
                    self.marks[marks] = self._whole(marks)
                ids += self.marks[marks]
        else:
            ids = self._whole(part)
        if len(cache) < CACHE_ENTRIES and len(part) <= CACHE_CHARS:
            cache[part] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text as little-endian 32-bit numbers."""
        parts = text.replace("\n", " ").split(" ")
        found = list(map(self.cache.get, parts))
        if None in found:
            found = [self._part(p) if ids is None else ids for p, ids in zip(parts, found)]
        return np.frombuffer(b"".join(found), "<u4")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """Pieces of every row of ``docs``: doc_id, piece, start, length, ids_crc32, and ids if wanted.

    A document is its ids and then the id 1; a null text has only that. Documents of more than
    ``length`` ids are cut into pieces of ``length``, the last of which may be shorter; nothing is
    lost. ``ids`` are little-endian unsigned 32-bit numbers. Other columns are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, piece, start, size, crc, raw = [], [], [], [], [], []
        encode = encoder(tokenizer).encode
        for row, text in enumerate(texts(batch, 1)):
            whole = np.append(encode(text), np.uint32(END)).astype("<u4")
            for k, a in enumerate(range(0, len(whole), length)):
                data = whole[a : a + length].tobytes()
                at.append(row)
                piece.append(k)
                start.append(a)
                size.append(len(data) // 4)
                crc.append(zlib.crc32(data))
                raw.append(data)
        columns = [
            batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
            pa.array(size, pa.int64()), pa.array(crc, pa.int64()),
        ]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays(columns + [pa.array(raw, pa.binary())] * keep_ids, names + ["ids"] * keep_ids)

    picked = docs.select("doc_id", "text")
    kind = picked.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return map_batches(picked, run, schema)
