"""Removal of repeated substrings with suffix arrays of shards.

A string of ``length`` bytes that starts in more than one place is removed wherever it is. To bring
equal strings together, each has an anchor: the ``GRAM`` bytes in it with the least hash, the first
of several. The strings of a text that share an anchor follow each other, so a text falls into
regions, one per anchor; equal strings have equal anchors, at equal places. Only anchors that occur
more than once matter. Their regions are shuffled by the anchor, equal regions combined on the way,
and each shard of a few hundred kilobytes of whole anchors gets a suffix array by induced sorting
and its permuted common prefixes. A start is repeated if its common prefix with a neighbour in the
array reaches ``length``, or if its region stands for several equal ones. A string that repeats takes
at least half of the bytes that are left beside its anchor from one side of it; so a region whose
anchor has no such half in common with another region of the anchor stays out of the array, and one
that has it on one side only enters it without the other half.

An anchor with more than ``hot`` different regions would make a shard grow with the corpus. Its
strings are dealt anew, each by its own whole content: equal ones are combined before the shuffle,
and those of more than one place are repeated.

Equal texts are one text with a count. Matches never cross texts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcurve.llm.common import ship, slices
from shelfcurve.llm.sais import permuted_lcp, suffix_array
from shelfcurve.session import discard, materialise

LENGTH = 200
GRAM = 64
SHARD = 400_000
HOT = 2_000

_BASE = 0xD6E8FEB86659FD93


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes at each place."""
    n = len(data) - GRAM + 1
    word = np.zeros(len(data) - 7, np.uint64)
    for j in range(8):
        word |= data[j : j + len(word)].astype(np.uint64) << np.uint64(8 * j)
    x = np.zeros(n, np.uint64)
    for k in range(0, GRAM, 8):
        x ^= word[k : k + n]
        x *= np.uint64(_BASE)
        x ^= x >> np.uint64(32)
    x *= np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def regions(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, its place, start, end) of the regions of a text; together they hold each of its strings once."""
    n = len(data) - length + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, none
    hashes = _gram_hashes(np.frombuffer(data, np.uint8))
    w = length - GRAM + 1
    # the place rides along with the upper half of the hash, so the first least one wins
    both = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    size = -(-len(both) // w) * w
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(both)] = both
    block = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(behind[:n], ahead[w - 1 : w - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
    end = np.append(start[1:], n) - 1 + length
    return hashes[place[start]].view(np.int64), place[start], start, end


def _encode(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _outline(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(doc, anchor, region) of every region of every text; ``region`` has 12 bits for the size, 12 for
    the place of the anchor in the region, and the start above them."""
    for batch in (part for whole in batches for part in slices(whole, 4 << 20)):
        doc, anchor, region = [], [], []
        for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            key, place, start, end = regions(_encode(text), length)
            doc.append(np.full(len(key), d))
            anchor.append(key)
            region.append(start << 24 | place - start << 12 | end - start)
        columns = [pa.array(np.concatenate(c), pa.int64()) for c in (doc, anchor, region)]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "anchor", "region"])


def _cut_regions(batches: Iterator[pa.RecordBatch], with_bytes: bool) -> Iterator[pa.RecordBatch]:
    """(anchor, rh, doc, region) of the marked regions of (doc, text, marks), or (anchor, rh, n, at, data)
    of those that stand for all that are equal to them; ``at`` is the place of the anchor."""
    for batch in (part for whole in batches for part in slices(whole, 4 << 20)):
        rows: list[tuple] = []
        size = 0
        for doc, text, marks in zip(*(batch.column(k).to_pylist() for k in range(3))):
            data = _encode(text)
            for m in marks:
                piece = data[(at := m["region"] >> 24) : at + (m["region"] & 4095)]
                digest = _digest(piece)
                place = m["region"] >> 12 & 4095
                rows.append((m["anchor"], digest, m["n"], place, piece) if with_bytes else (m["anchor"], digest, doc, m["region"]))
                size += len(piece)
                if size > 16 << 20:
                    yield _region_batch(rows, with_bytes)
                    rows, size = [], 0
        if rows:
            yield _region_batch(rows, with_bytes)


def _region_batch(rows: list[tuple], with_bytes: bool) -> pa.RecordBatch:
    names = ["anchor", "rh", "n", "at", "data"] if with_bytes else ["anchor", "rh", "doc", "region"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), *([pa.binary()] if with_bytes else [])]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def repeated_starts(pieces: list[bytes], counts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece the places where a string starts that starts anywhere else in the shard.

    A piece that stands for several equal ones is in the array once; its strings all start elsewhere.
    """
    s = np.zeros(sum(map(len, pieces)) + len(pieces) + 1, np.int64)
    at = np.cumsum([0, *(len(p) + 1 for p in pieces)]).tolist()
    for p, a in zip(pieces, at):
        s[a : a + len(p)] = np.frombuffer(p, np.uint8)
        s[a : a + len(p)] += 2
        s[a + len(p)] = 1
    sa = suffix_array(s, 258)
    reach = permuted_lcp(s, sa)[sa] >= length
    again = np.zeros(len(s), bool)
    again[sa[reach]] = True
    again[sa[:-1][reach[1:]]] = True
    for p, n, a in zip(pieces, counts, at):
        if n > 1:
            again[a : a + len(p)] = True
    return [np.flatnonzero(again[a : a + max(len(p) - length + 1, 0)]) for p, a in zip(pieces, at)]


def _runs(starts: np.ndarray, length: int) -> list[list[int]]:
    """Covered [from, to) of strings at rising ``starts``."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > length)
    first, last = starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)]
    return [[a, b + length] for a, b in zip(first.tolist(), last.tolist())]


def _matched(group: list[tuple], length: int) -> list[tuple]:
    """(anchor, rh, data, n, from) of the parts of an anchor's regions that may share a string with
    another place: the part begins at ``from`` of its region (anchor, rh, data, n, at).

    Where the half before or after the anchor has no other place, no repeated string holds all of it,
    and the part ends one byte short of that half. Strings of a region with equals all repeat.
    """
    half = (length - GRAM + 1) // 2
    sides = []
    for _, _, data, _, at in group:
        before = data[at - half : at + GRAM] if at >= half else None
        after = data[at : at + GRAM + half] if len(data) - at >= GRAM + half else None
        sides.append((before, after))
    before_many, after_many = (Counter(side[k] for side in sides) for k in (0, 1))
    parts = []
    for (anchor, rh, data, n, at), (before, after) in zip(group, sides):
        if n > 1:
            parts.append((anchor, rh, data, n, 0))
            continue
        shared_before, shared_after = before is not None and before_many[before] > 1, after is not None and after_many[after] > 1
        if shared_before or shared_after:
            start = 0 if shared_before else max(at - half + 1, 0)
            part = data[start : len(data) if shared_after else at + GRAM + half - 1]
            parts.append((anchor, rh, part, n, start))
    return parts


def _shards(batches: Iterator[pa.RecordBatch], length: int, shard: int) -> Iterator[pa.RecordBatch]:
    """Suffix arrays of whole anchors of a partition sorted by anchor (anchor, rh, data, n, at)."""

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        starts = repeated_starts([r[2] for r in rows], [r[3] for r in rows], length)
        some = [(r[0], r[1], _runs(s + r[4], length)) for r, s in zip(rows, starts) if len(s)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some], pa.binary()), pa.array([r[2] for r in some], pa.list_(pa.list_(pa.int32())))],
            ["anchor", "rh", "spans"],
        )

    each = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    rows, size = [], 0
    for _, group in groupby(each, itemgetter(0)):
        group = _matched(list(group), length)
        rows += group
        size += sum(len(r[2]) for r in group)
        if size >= shard:
            yield solved(rows)
            rows, size = [], 0
    if rows:
        yield solved(rows)


def _hot_strings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(window, anchor, rh, at, n) of every string of hot regions."""
    for batch in (part for whole in batches for part in slices(whole, 1 << 18)):
        rows = [
            (_digest(data[k : k + length]), anchor, rh, k, n)
            for anchor, rh, data, n in zip(*(c.to_pylist() for c in batch.columns))
            for k in range(len(data) - length + 1)
        ]
        kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["window", "anchor", "rh", "at", "n"])


def _remove(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Digest of (th, text, spans)."""
    for batch in (part for whole in batches for part in slices(whole)):
        rows = []
        for th, text, spans in zip(*(batch.column(k).to_pylist() for k in range(3))):
            data, merged = _encode(text), []
            for a, b in sorted((s["from"], s["to"]) for s in spans):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            kept, at = [], 0
            for a, b in merged:
                kept.append(data[at:a])
                at = b
            rows.append((th, sum(b - a for a, b in merged), len(merged), hashlib.sha256(b"".join(kept) + data[at:]).hexdigest(), merged))
        if rows:
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["th", "n_removed", "n_spans", "kept_sha256", "removed"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed.

    ``removed`` are the maximal removed [from, to) bytes in UTF-8. A null text counts as empty and
    keeps nothing. Rows with equal texts are places of their own: a repeated text of at least
    ``length`` bytes is removed whole. Texts shorter than that stay. Only doc_id and text are read.
    """
    if not GRAM <= length <= 2000:
        raise ValueError(f"strings need {GRAM} bytes for an anchor, and their regions fewer than 4096")
    ship(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", text.alias("text")).withColumn("th", F.unhex(F.md5("text")))
    plain = materialise(named.select("doc_id", "th", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("plain")), "texts")
    copies = plain.groupBy("th").agg(F.count("*").alias("copies"))
    # each text once, with a number of its own; copies are folded before the shuffle
    long = named.where(F.octet_length("text") >= length).groupBy("th").agg(F.first("text").alias("text"))
    long = materialise(long.withColumn("doc", F.monotonically_increasing_id()), "different")

    outline = materialise(long.select("doc", "text").mapInArrow(lambda it: _outline(it, length), "doc bigint, anchor bigint, region bigint"), "outline")
    again = outline.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    marks = outline.join(again, "anchor").groupBy("doc").agg(F.collect_list(F.struct("anchor", "region", F.lit(1).cast("bigint").alias("n"))).alias("marks"))
    marked = materialise(long.join(marks, "doc").select("doc", "th", "text", "marks"), "marked")
    discard(long, outline)

    cut = marked.select("doc", "text", "marks").mapInArrow(lambda it: _cut_regions(it, False), "anchor bigint, rh binary, doc bigint, region bigint")
    cut = materialise(cut, "cut")
    # one region stands for all equal ones; only its bytes are shuffled
    chosen = cut.groupBy("anchor", "rh").agg(F.min(F.struct("doc", "region")).alias("first"), F.count("*").alias("n"))
    chosen = chosen.groupBy(F.col("first.doc").alias("doc")).agg(F.collect_list(F.struct("anchor", F.col("first.region").alias("region"), "n")).alias("chosen"))
    distinct = marked.select("doc", "text").join(chosen, "doc").mapInArrow(
        lambda it: _cut_regions(it, True), "anchor bigint, rh binary, n bigint, at bigint, data binary"
    )
    distinct = materialise(distinct.select("anchor", "rh", "data", "n", "at"), "regions")
    crowded = materialise(distinct.groupBy("anchor").agg(F.count("*").alias("k")).where(F.col("k") > hot).select("anchor"), "crowded")
    dealt = distinct.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    solved = dealt.mapInArrow(lambda it: _shards(it, length, shard), "anchor bigint, rh binary, spans array<array<int>>")

    strings = distinct.join(crowded, "anchor", "left_semi").select("anchor", "rh", "data", "n").mapInArrow(
        lambda it: _hot_strings(it, length), "window binary, anchor bigint, rh binary, at int, n bigint"
    )
    twice = strings.groupBy("window").agg(F.sum("n").alias("places")).where("places > 1").select("window")
    span = F.array(F.col("at"), F.col("at") + length)
    hot_spans = strings.join(twice, "window").groupBy("anchor", "rh").agg(F.collect_list(span).alias("spans"))
    spans = materialise(solved.unionByName(hot_spans), "spans")
    discard(distinct)

    place = F.shiftright("region", 24)
    found = cut.join(spans, ["anchor", "rh"]).select("doc", place.alias("start"), F.explode("spans").alias("s"))
    by_text = found.select("doc", F.struct((F.col("start") + F.col("s")[0]).alias("from"), (F.col("start") + F.col("s")[1]).alias("to")).alias("span"))
    by_text = by_text.groupBy("doc").agg(F.collect_set("span").alias("spans"))
    changed = marked.select("doc", "th", "text").join(by_text, "doc").select("th", "text", "spans").mapInArrow(
        lambda it: _remove(it, length), "th binary, n_removed bigint, n_spans bigint, kept_sha256 string, removed array<array<int>>"
    )
    changed = materialise(changed, "changed")
    discard(marked, cut, spans)

    # a text that is there twice goes whole, whatever its regions say
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    nothing = F.expr("cast(array() as array<array<int>>)")
    judged = copies.join(changed, "th", "left")
    return plain.join(judged, "th").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "plain")).alias("kept_sha256"),
        F.when(whole, F.array(F.array(F.lit(0), F.col("n_bytes").cast("int")))).otherwise(F.coalesce("removed", nothing)).alias("removed"),
    )
