"""Document fingerprints from Lempel-Ziv phrases.

A text's bytes are parsed into phrases: each is the shortest one that was not a phrase before. Texts
that share much get many phrases in common, as a compressor would find. The set of phrases is
hashed, and the ``SIZE`` smallest hashes are the fingerprint (8 hex digits each, rising). The
likeness of two fingerprints is the share of common hashes among the smallest of both together, an
estimate of the sets' Jaccard similarity, exact if both sets are small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfcurve.llm.common import ship, slices

SIZE = 128


def parse(data: bytes, known: set[bytes] | None = None, start: int = 0) -> list[int]:
    """The ends of the phrases of ``data`` from ``start``; ``known`` are the phrases so far and grows.

    Every beginning of a phrase is a phrase, so the longest known match is found by stepping up or
    down from the length of the last one.
    """
    known = set() if known is None else known
    add, ends, n, size = known.add, [], len(data), 1
    at = start
    while at < n:
        piece = data[at : at + size]
        if piece in known:
            while True:
                size += 1
                if at + size > n:
                    break
                piece = data[at : at + size]
                if piece not in known:
                    break
        else:
            while size > 1:
                shorter = data[at : at + size - 1]
                if shorter in known:
                    break
                piece = shorter
                size -= 1
        if at + size > n:  # what is left is a phrase already, or shorter than the piece tried
            size = n - at
            piece = data[at:n]
        add(piece)
        at += size
        ends.append(at)
    return ends


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class Hasher:
    """Hashes of many pieces of one text by prefix sums of a polynomial modulo 2^64."""

    def __init__(self) -> None:
        self.power = self.back = np.ones(1, np.uint64)

    def _room(self, n: int) -> None:
        if len(self.power) <= n:
            n = max(n + 1, 2 * len(self.power))
            self.power = np.cumprod(np.append(np.uint64(1), np.full(n, _BASE, np.uint64)))
            self.back = np.cumprod(np.append(np.uint64(1), np.full(n, _BACK, np.uint64)))

    def __call__(self, data: bytes, ends: np.ndarray) -> np.ndarray:
        """32-bit hashes of the pieces of ``data`` that end at ``ends``."""
        self._room(len(data))
        starts = np.append(np.int64(0), ends[:-1])
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=sums[1:])
        x = (sums[ends] - sums[starts]) * self.back[starts]
        x = (x ^ (x >> np.uint64(30))) * _MIX[0]
        x = (x ^ (x >> np.uint64(27))) * _MIX[1]
        return (x ^ (x >> np.uint64(31))) >> np.uint64(32)


def least(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The smallest different hashes, rising."""
    some = hashes if len(hashes) <= 4 * size else np.partition(hashes, 2 * size)[: 2 * size]
    out = np.unique(some)
    if len(out) < size:
        out = np.unique(hashes)
    return out[:size]


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Two empty texts are alike, an empty and another one are not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:size]
    return float((np.isin(both, a) & np.isin(both, b)).sum() / len(both))


def sketch(text: str, hasher: Hasher, size: int = SIZE) -> np.ndarray:
    data = text.encode("utf-8", "surrogatepass")
    return least(hasher(data, np.array(parse(data), np.int64)), size) if data else np.empty(0, np.uint64)


def sketch_with_edit(text: str, edited: str, shared: int, hasher: Hasher, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Sketches of ``text`` and of ``edited``, which begin with the same ``shared`` code points.

    The common beginning is parsed once: the phrases that end in it are those of both.
    """
    data, other = text.encode("utf-8", "surrogatepass"), edited.encode("utf-8", "surrogatepass")
    if not data:
        return np.empty(0, np.uint64), sketch(edited, hasher, size)
    same = len(text[:shared].encode("utf-8", "surrogatepass"))
    known: set[bytes] = set()
    ends = parse(data, known)
    first = least(hasher(data, np.array(ends, np.int64)), size)
    if not other:
        return first, np.empty(0, np.uint64)
    # the last phrase may be one that was there before, so it is not a sign of what is new
    kept = int(np.searchsorted(ends, same, "right"))
    if kept == len(ends) and kept:
        kept -= 1
    start = ends[kept - 1] if kept else 0
    before, at = set(), 0
    for end in ends[:kept]:
        before.add(data[at:end])
        at = end
    more = parse(other, before, start)
    return first, least(hasher(other, np.array(ends[:kept] + more, np.int64)), size)


def edit(text: str, following: str) -> tuple[str, int]:
    """``text`` with its last third replaced by as many first code points of ``following``, or all."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third], len(text) - third


def fingerprints_with_edits(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The next document is that of the next smaller doc_id, after the last the first; null ids come
    last, equal ids are ordered by their texts' hashes. A null text counts as empty. The rows are
    dealt to ranges of doc_id, so each text is shuffled once, and the first row of a range is copied
    to the range before it. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    picked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = picked.where("doc_id IS NOT NULL").approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 0.2 / ranges)
    cuts = sorted(set(cuts)) or [0.0]
    split = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_key", outputCol="_range", handleInvalid="keep")
    # ranges are numbered in the order of the rows: the greatest ids first, nulls last
    number = F.lit(len(cuts)) - F.col("_range").cast("int")
    placed = split.transform(picked.withColumn("_key", F.col("doc_id").cast("double"))).select(
        F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(number).alias("part"), "doc_id", "text"
    )
    firsts = placed.groupBy("part").agg(F.max("doc_id").alias("doc_id")).orderBy("part").collect()
    if not firsts:
        return spark.createDataFrame([], _schema(picked))
    before = {r["part"]: firsts[k - 1]["part"] for k, r in enumerate(firsts)}  # the first range follows the last
    heads = spark.createDataFrame([(r["part"], r["doc_id"], before[r["part"]]) for r in firsts], f"at int, id {_kind(picked)}, target int")
    copies = placed.join(F.broadcast(heads), (F.col("part") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("id")))
    # of equal ids the first by hash
    copies = copies.groupBy("target").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "doc_id", "text")).alias("c"))
    rows = placed.withColumn("copy", F.lit(False)).unionByName(
        copies.select(F.col("target").alias("part"), "c.doc_id", "c.text", F.lit(True).alias("copy"))
    )
    dealt = rows.repartitionById(len(cuts) + 2, F.col("part")).sortWithinPartitions(
        "part", "copy", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        held = None  # the last row, which waits for the text after it
        waiting = None  # the one before it, which waits for the fingerprint after it
        for batch in (part for whole in batches for part in slices(whole)):
            out = []
            for doc_id, text, copy in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                if held is not None:
                    edited, shared = edit(held[1], text)
                    own, changed = sketch_with_edit(held[1], edited, shared, hasher, size)
                    if waiting is not None:
                        out.append((*waiting[:-1], likeness(waiting[-1], own, size)))
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    waiting = (held[0], len(held[1]), digest, written(own), written(changed), likeness(own, changed, size), own)
                held = (doc_id, text)
                if copy:  # the range ends
                    out.append((*waiting[:-1], likeness(waiting[-1], sketch(text, hasher, size), size)))
                    held = waiting = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], _NAMES)

    kinds = [to_arrow_type(picked.schema["doc_id"].dataType), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    return dealt.mapInArrow(run, _schema(picked))


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _schema(docs: DataFrame) -> str:
    kinds = [_kind(docs), "bigint", "string", "string", "string", "double", "double"]
    return ", ".join(f"{n} {k}" for n, k in zip(_NAMES, kinds))
