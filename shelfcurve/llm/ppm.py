"""Language identification by prediction by partial matching.

For each language the bytes of its training texts give one context tree of depth ``order``: how
often each byte followed each context of 0 to ``order`` bytes. A byte costs, at the longest context
that was ever seen, -log2 of its share there, or an escape (method C: the number of different
followers over that number plus the total) and then its cost one byte shorter; below the empty
context every byte value costs 8 bits. The statistics are frozen after training, so the cost of a
byte depends on the ``order`` bytes before it only, and the code length of a whole text is a sum of
table entries. The language with the shortest code wins.

Training draws a bounded sample: at most ``per_language`` whole texts of each language, those with
the smallest hash of (doc_id, text). The counts of the contexts are aggregated by Spark, and what
the driver gets is bounded by the size of that sample, not by the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfcurve.llm.common import map_batches, ship, slices, texts

UNDETERMINED = "und"
PER_LANGUAGE = 300
SAMPLE_TASKS = 8
ORDER = 3


@dataclass
class Model:
    """Frozen code lengths. ``symbol`` maps a byte to a dense number, the last one standing for
    every byte that training never saw; ``context`` maps three symbols to the longest of their
    suffixes that was seen; ``bits`` has a row per (context, symbol) and a column per language."""

    languages: list[str]
    symbol: np.ndarray
    context: np.ndarray
    bits: np.ndarray

    @property
    def size(self) -> int:
        return int(self.symbol.max()) + 1

    def code_lengths(self, data: bytes) -> np.ndarray:
        """Bits that each language needs for ``data``; the text is preceded by spaces."""
        size = self.size
        s = self.symbol[np.frombuffer(b" " * ORDER + data, np.uint8)].astype(np.int64)
        total = np.zeros(len(self.languages))
        step = 1 << 20
        for at in range(0, len(data), step):
            part = s[at : at + step + ORDER]
            key = (part[:-3] * size + part[1:-2]) * size + part[2:-1]
            rows = self.context[key].astype(np.int64) * size + part[3:]
            total += self.bits[rows].sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: str) -> tuple[str, float, float]:
        """The language, its share among the languages by code length, and its bits per byte."""
        if not self.languages or not any(c.isalpha() for c in text):
            return UNDETERMINED, 0.0, 0.0
        data = text.encode("utf-8", "surrogatepass")
        bits = self.code_lengths(data)
        best = int(bits.argmin())
        share = float(1 / np.exp2(np.clip(bits[best] - bits, -1000, 0)).sum())
        return self.languages[best], share, float(bits[best] / len(data))


def sample(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` rows (lang, text) of each language, chosen by the hash of the text.

    Copies of a text count once. The ranking moves hashes only, made distinct and limited per language
    before the shuffle; copies are folded before they move.
    """
    keyed = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").select("lang", "text", F.xxhash64("text").alias("k"))
    order = Window.partitionBy("lang").orderBy("k")
    chosen = keyed.select("lang", "k").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_language)
    met = keyed.join(F.broadcast(chosen.select("lang", "k")), ["lang", "k"])
    # a bounded number of texts: few tasks count them, each a context once for all its texts
    return met.groupBy("lang", "k").agg(F.min("text").alias("text")).select("lang", "text").coalesce(SAMPLE_TASKS)


def count_contexts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each run of ``ORDER`` + 1 bytes occurs, as an integer."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                b = np.frombuffer(b" " * ORDER + text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
                by.setdefault(lang, []).append((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:])
            for lang, grams in by.items():
                gram, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])

    counted = rows.mapInArrow(run, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def build_model(counts: list[tuple[str, int, int]]) -> Model:
    """The frozen tables of a list of (language, run of four bytes, count).

    The table of an order is the table of the order below it plus escapes, overwritten where the
    longer context was seen. Only contexts that some language saw have rows of their own.
    """
    languages = sorted({lang for lang, _, _ in counts})
    if not languages:
        return Model([], np.zeros(256, np.int64), np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    lang = np.searchsorted(languages, [c[0] for c in counts])
    gram = np.array([c[1] for c in counts], np.int64)
    n = np.array([c[2] for c in counts], np.float64)
    used = np.unique([(gram >> shift) & 255 for shift in (24, 16, 8, 0)])
    symbol = np.full(256, len(used), np.int64)
    symbol[used] = np.arange(len(used))
    size = len(used) + 1
    gram = sum(symbol[(gram >> (8 * k)) & 255] * size**k for k in range(ORDER + 1))

    row_of = np.zeros(size**ORDER, np.int32)
    levels, base = [], 0
    shorter, bits = np.zeros(1, np.int64), np.full((1, size, len(languages)), 8.0)
    for order in range(ORDER + 1):
        contexts = np.unique(gram // size % size**order)
        bits = bits[np.searchsorted(shorter, contexts % size ** max(order - 1, 0))]
        for k in range(len(languages)):
            pair, at = np.unique(gram[lang == k] % size ** (order + 1), return_inverse=True)
            count = np.bincount(at, weights=n[lang == k])
            seen, row = np.unique(pair // size, return_inverse=True)
            total, kinds = np.bincount(row, weights=count), np.bincount(row)
            place = np.searchsorted(contexts, seen)
            bits[place, :, k] -= np.log2(kinds / (total + kinds))[:, None]
            bits[place[row], pair % size, k] = -np.log2(count / (total + kinds)[row])
        row_of.reshape(-1, size**order)[:, contexts] = base + np.arange(len(contexts), dtype=np.int32)
        levels.append(bits.astype(np.float32).reshape(-1, len(languages)))
        base, shorter = base + len(contexts), contexts
    return Model(languages, symbol, row_of, np.concatenate(levels))


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model of the non-null languages of ``labelled`` (doc_id, lang, text)."""
    return build_model([tuple(r) for r in count_contexts(sample(labelled, per_language)).collect()])


def predict(docs: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """``keys`` of each row with lang_pred, score and bits_per_byte of its ``text``.

    A null text, or one without a letter, gives ``und``, 0 and 0; so does every text if the model
    learned no language. Repeated rows are predicted each; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score, bits = zip(*map(shared.value.predict, texts(batch, len(keys))))
        columns = [batch.column(k) for k in range(len(keys))]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())],
            [*keys, "lang_pred", "score", "bits_per_byte"],
        )

    picked = docs.select(*keys, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return map_batches(picked, run, f"{fields}, lang_pred string, score double, bits_per_byte double")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """Rows with a language, that is all but those predicted as ``und``; every column passes through."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = [shared.value.predict(text)[0] != UNDETERMINED for text in texts(batch)]
        return batch.filter(pa.array(known, pa.bool_()))

    return map_batches(docs, run, docs.schema)
