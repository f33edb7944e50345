"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts and items are folded alike: A-Z in lower case, every run of other ASCII characters one space,
a space at both ends. A pattern is the folded form of ``window`` consecutive words of an item, or
of the whole item if it has fewer, spaces at both ends included, so a match begins and ends at
words. Patterns are grouped by length (a class spans a factor of two, so that a short item does not
shorten the jumps for the long ones). For each class, blocks of ``block`` bytes within the first m
bytes of its patterns (m: its shortest) give the shift table; a block that is in no pattern lets
the search jump m - block + 1 bytes. Where the shift is zero, the patterns in the bucket of that
suffix block are compared directly.

The patterns are made in blocks of about ``per_pass`` benchmark rows and ``PASS_BYTES`` of text. Each
block is one pass over the documents; its findings are written and its tables given up before the
next pass, so a task holds the patterns of one block, however large the benchmark. (A single item
longer than a block is a block of its own.)
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcurve.llm.common import hex_digest, map_batches, texts
from shelfcurve.session import materialise

WINDOW = 10
PER_PASS = 20_000
PASS_BYTES = 32 << 20

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows_of(words: list[bytes], window: int = WINDOW) -> set[bytes]:
    """Patterns of an item."""
    last = max(len(words) - window, 0)
    return {b" %b " % b" ".join(words[i : i + window]) for i in range(last + 1)} if words else set()


class Searcher:
    """Shift tables and suffix buckets of a set of patterns."""

    def __init__(self, patterns: set[bytes], block: int = 8):
        classes = defaultdict(list)
        for p in patterns:
            classes[len(p).bit_length()].append(p)
        self.tables = []
        for group in classes.values():
            m = min(map(len, group))
            b = min(block, max(2, m // 2))
            shift: dict[bytes, int] = {}
            bucket = defaultdict(list)
            for p in group:
                for j in range(b, m + 1):
                    key = p[j - b : j]
                    shift[key] = min(shift.get(key, m), m - j)
                bucket[p[m - b : m]].append(p)
            self.tables.append((m, b, shift, dict(bucket)))

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(start, pattern) of every occurrence."""
        for m, b, shift, bucket in self.tables:
            at, size, jump, get = m, len(text), m - b + 1, shift.get
            while at <= size:
                key = text[at - b : at]
                step = get(key, jump)
                if step:
                    at += step
                    continue
                start = at - m
                for p in bucket[key]:
                    if text.startswith(p, start):
                        yield start, p
                at += 1


def search(words: list[bytes], searcher: Searcher) -> tuple[list[tuple[int, int]], set[bytes]]:
    """Merged ranges of words that are hit, and the patterns that occur."""
    text = b" %b " % b" ".join(words)
    found = list(searcher.find(text))
    if not found:
        return [], set()
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    ranges: list[tuple[int, int]] = []
    for start, p in sorted(found, key=lambda f: (f[0], -len(f[1]))):
        a = int(np.searchsorted(spaces, start))
        b = a + p.count(b" ") - 1
        if ranges and a <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(b, ranges[-1][1]))
        else:
            ranges.append((a, b))
    return ranges, {p for _, p in found}


def _passes(benchmark: DataFrame, per_pass: int) -> list[DataFrame]:
    """The benchmark in blocks of about ``per_pass`` rows and ``PASS_BYTES``, by hash."""
    rows, size = benchmark.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-rows // per_pass), -(-size // PASS_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [benchmark.where(part == k) for k in range(blocks)]


def _patterns(block: DataFrame, window: int) -> dict[bytes, set[str]]:
    """Pattern -> ids of the items that have it; a null id marks words but names no item."""
    owners: dict[bytes, set[str]] = defaultdict(set)
    for item, text in block.select(F.col("item_id").cast("string"), "text").collect():
        for p in windows_of(words_of(text or ""), window):
            owners[p].update([] if item is None else [item])
    return dict(owners)


def _found(batch: pa.RecordBatch, searcher: Searcher, owners: dict[bytes, set[str]], all_rows: bool) -> pa.RecordBatch:
    """Words, ranges and items of each text of (row, doc_id, text), or of those with a hit alone."""
    rows, n, found, items = [], [], [], []
    for at, text in enumerate(texts(batch, 2)):
        words = words_of(text)
        ranges, patterns = search(words, searcher)
        if ranges or all_rows:
            rows.append(at)
            n.append(len(words))
            found.append([list(r) for r in ranges])
            items.append(sorted({item for p in patterns for item in owners[p]}))
    kept = batch.take(pa.array(rows, pa.int64()))
    made = [pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.list_(pa.int32()))), pa.array(items, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), *made], ["row", "doc_id", "n_words", "ranges", "items"])


def _told(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The answer for each (doc_id, n_words, ranges, items), where ranges and items may overlap."""
    hits = [_merged([tuple(r) for r in ranges]) for ranges in batch.column("ranges").to_pylist()]
    items = [sorted(set(i)) for i in batch.column("items").to_pylist()]
    n = [sum(b - a for a, b in ranges) for ranges in hits]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"), batch.column("n_words"),
            pa.array(n, pa.int64()),
            pa.array([len(i) for i in items], pa.int64()),
            pa.array([hex_digest(",".join(i).encode()) for i in items]),
            pa.array([x > 0 for x in n]),
            pa.array([[list(r) for r in ranges] for ranges in hits], pa.list_(pa.list_(pa.int32()))),
        ],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hits"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, per_pass: int = PER_PASS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits.

    ``hits`` are the merged [from, to) ranges of hit words. A null or wordless text has no words, a
    null or wordless item no windows; an empty benchmark contaminates nothing. Repeated documents
    are judged each; repeated items count once. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    blocks = _passes(benchmark.select("item_id", "text"), per_pass)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    if len(blocks) > 1:  # every pass must see the same numbers
        rows = materialise(rows, "numbered")
    found = None
    for k, block in enumerate(blocks):
        owners = _patterns(block, window)
        shared = spark.sparkContext.broadcast((Searcher(set(owners)), owners))
        schema = f"row bigint, doc_id {kind}, n_words bigint, ranges array<array<int>>, items array<string>"
        mine = materialise(map_batches(rows, lambda batch, s=shared, first=k == 0: _found(batch, *s.value, first), schema), "found")
        shared.destroy()
        found = mine if found is None else found.unionByName(mine)
    # rows are numbered, so those of one document meet whatever their number
    whole = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("ranges")).alias("ranges"), F.flatten(F.collect_list("items")).alias("items"),
    )
    told = whole if len(blocks) > 1 else found
    done = f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, hits array<array<int>>"
    return map_batches(told.select("doc_id", "n_words", "ranges", "items"), _told, done)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, per_pass: int = PER_PASS) -> DataFrame:
    """Rows in which no window of the benchmark occurs; every column passes through, whatever its name.

    A null or wordless text has no window and stays; repeated rows stay or go together. Between passes
    what is left is written, so a task holds the patterns of one block.
    """
    at = docs.columns.index("text")
    blocks = _passes(benchmark.select("item_id", "text"), per_pass)
    for k, block in enumerate(blocks):
        shared = docs.sparkSession.sparkContext.broadcast(Searcher(set(_patterns(block, window))))

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            clean = [next(shared.value.find(b" %b " % b" ".join(words_of(t))), None) is None for t in texts(batch, at)]
            return batch.filter(pa.array(clean, pa.bool_()))

        docs = map_batches(docs, run, docs.schema)
        if k < len(blocks) - 1:
            docs = materialise(docs, "clean")
            shared.destroy()
    return docs
