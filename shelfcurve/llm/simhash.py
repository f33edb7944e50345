"""Near duplicates by SimHash and multi-index hashing.

A fingerprint has 64 bits: bit k is 1 if it is set in more than half of the XXH64 hashes of the
text's shingles. Two fingerprints link if they differ in at most four bits. Then one of their two
halves of 32 bits differs in at most two, so some value lies within one bit of both halves: each
fingerprint is entered in the tables of both halves under the 33 values of its ball of radius one,
and fingerprints that meet under a value are compared in full.

Only distinct fingerprints are indexed. Those under one value are compared block by block, and what
leaves a task is a link from each to an earlier one of its component there, never all pairs. More
than ``dense`` fingerprints under one value are not compared: they go under all 2,081 values of the
64-bit ball of radius two. Members of such a ball differ in four bits at most, and any two that do
share one, so links to the ball's least member say all there is to say.

Components come from alternating large-star and small-star steps over the links, a table in the
shared folder after each. Neither links nor fingerprints reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfcurve.llm.common import free_name, map_batches, ship, texts
from shelfcurve.session import materialise

SHINGLE = 4
SEED = 42
DISTANCE = 4
DENSE = 4096


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number; zero for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(line, SEED)
    ends = np.fromiter(map(len, words), np.int64, len(words))
    np.cumsum(ends + 1, out=ends)  # one past the space after each word
    starts = [0, *ends[:-shingle].tolist()]
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())), np.uint64, len(starts))
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed number. A null text has no words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t, shingle) for t in texts(batch, 1)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    picked = docs.select("doc_id", "text")
    return map_batches(picked, run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, fp bigint")


_NEAR = np.array([0] + [1 << k for k in range(32)], np.uint64)


def _table_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Each fingerprint under the 33 values next to each half; the key's bit 32 tells the half."""
    fp = batch.column(0).to_numpy().view(np.uint64)
    low, high = fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32)
    keys = np.concatenate([(low[:, None] ^ _NEAR).ravel(), (high[:, None] ^ _NEAR).ravel() | np.uint64(1 << 32)])
    each = np.repeat(fp, 33).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.concatenate([each, each]))], ["key", "fp"])


def _stars(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each of a few fingerprints to a lesser one of its component among them."""
    n = len(fp)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for at in range(n - 1):
        near = np.flatnonzero(np.bitwise_count(fp[at + 1 :] ^ fp[at]) <= DISTANCE)
        for other in (near + at + 1).tolist():
            a, b = root(at), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
    top = np.array([root(k) for k in range(n)])
    moved = np.flatnonzero(top != np.arange(n))
    return fp[moved], fp[top[moved]]


def _meet(batches: Iterator[pa.RecordBatch], dense: int) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal keys of a sorted partition; members of longer runs have b null."""

    def out(a: list[np.ndarray], b: list[np.ndarray], crowd: list[np.ndarray]) -> pa.RecordBatch:
        crowded = np.unique(np.concatenate([*crowd, np.empty(0, np.uint64)]))
        left = np.concatenate([*a, crowded]).view(np.int64)
        linked = pa.array(np.concatenate([*b, np.empty(0, np.uint64)]).view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(left), pa.concat_arrays([linked, pa.nulls(len(crowded), pa.int64())])], ["a", "b"])

    def links(key: np.ndarray, fp: np.ndarray, a: list, b: list, crowd: list) -> None:
        edge = np.flatnonzero(np.diff(key)) + 1
        start, stop = np.concatenate([[0], edge]), np.concatenate([edge, [len(key)]])
        size = stop - start
        pair = start[size == 2]
        if len(pair):
            x, y = fp[pair], fp[pair + 1]
            near = np.bitwise_count(x ^ y) <= DISTANCE
            a.append(np.maximum(x, y)[near])
            b.append(np.minimum(x, y)[near])
        for s, e in zip(start[size > 2].tolist(), stop[size > 2].tolist()):
            if e - s > dense:
                crowd.append(fp[s:e])
            else:
                x, y = _stars(np.sort(fp[s:e]))
                a.append(x)
                b.append(y)

    held_key, held = np.empty(0, np.int64), np.empty(0, np.uint64)
    spilling = None  # the key of a run that is already known to be crowded
    for batch in batches:
        key = batch.column(0).to_numpy()
        fp = batch.column(1).to_numpy().view(np.uint64)
        a, b, crowd = [], [], []
        if spilling is not None:
            stays = int(np.searchsorted(key, spilling, "right"))
            crowd.append(fp[:stays])
            key, fp = key[stays:], fp[stays:]
            if len(key):
                spilling = None
        key, fp = np.concatenate([held_key, key]), np.concatenate([held, fp])
        held_key, held = key[:0], fp[:0]
        if len(key):
            last = int(np.searchsorted(key, key[-1]))
            if len(key) - last > dense:
                crowd.append(fp[last:])
                spilling = int(key[-1])
            else:
                held_key, held = key[last:].copy(), fp[last:].copy()
            if last:
                links(key[:last], fp[:last], a, b, crowd)
        if a or crowd:
            yield out(a, b, crowd)
    if len(held_key):
        a, b, crowd = [], [], []
        links(held_key, held, a, b, crowd)
        if a or crowd:
            yield out(a, b, crowd)


_PAIRS = [(1 << i) | (1 << j) for i in range(64) for j in range(i)]


def _ball_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Each fingerprint under all values within two bits."""
    fp = batch.column(0).to_numpy().view(np.uint64)
    near = np.array([0, *(1 << k for k in range(64)), *_PAIRS], np.uint64)
    return pa.RecordBatch.from_arrays(
        [pa.array((fp[:, None] ^ near).ravel().view(np.int64)), pa.array(np.repeat(fp, len(near)).view(np.int64))], ["key", "fp"]
    )


def links(distinct: DataFrame, dense: int = DENSE) -> DataFrame:
    """(a, b): links between different fingerprints of ``distinct`` (fp) whose components are those
    of all pairs that differ in at most ``DISTANCE`` bits."""
    ship(distinct.sparkSession)
    keyed = map_batches(distinct.select("fp"), _table_rows, "key bigint, fp bigint")
    sorted_keys = keyed.repartition("key").sortWithinPartitions("key")
    met = materialise(sorted_keys.mapInArrow(lambda it: _meet(it, dense), "a bigint, b bigint"), "links")
    near = met.where("b IS NOT NULL")
    crowd = met.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    balls = map_batches(crowd, _ball_rows, "key bigint, fp bigint")
    least = balls.groupBy("key").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    dense_links = balls.join(least, "key").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return near.unionByName(dense_links).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of the component of every node of ``edges`` (a, b)."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:  # a node's greater neighbours move to its least neighbour
            both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:  # a node's lesser neighbours, and itself, move to the least
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(least, "a")
        if large:
            moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return moved.where("a <> b").distinct()

    now = materialise(edges.where("a <> b").select("a", "b"), "edges")
    while True:
        after = materialise(star(star(now, True), False), "edges")
        # at rest every node hangs on one least node, and no least node hangs on another
        if after.groupBy("a").count().where("count > 1").isEmpty() and after.join(after.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = after


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, dense: int = DENSE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, links.

    ``component_id`` is the smallest doc_id among all rows that links lead to, itself included; null
    if none of them has a doc_id. ``links`` counts the other rows with the same component. Texts
    without words share fingerprint zero. Repeated rows appear each. Only doc_id and text are read.
    """
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    roots = components(links(distinct, dense)).withColumnRenamed("node", "fp")
    placed = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("size"))
    by_fp = placed.select("fp", "root").join(groups, "root").select("fp", "component_id", "size")
    return rows.join(materialise(by_fp, "components"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", (F.col("size") - 1).alias("links")
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with exactly one row of each component: that of the least doc_id, null being the
    greatest, and of its rows the one whose text has the least hash.

    Rows of one doc_id with different texts are judged each by their own text. Of rows equal in doc_id
    and text one stays; it keeps its other columns, whatever their names. No rows give none.
    """
    row = lambda: F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text"))
    found = near_duplicates(docs.select(row().alias("doc_id"), "text"), shingle)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("key")).distinct()
    name = free_name(docs)
    # joined alike at every size, so that the shuffle of texts follows the input
    kept = materialise(kept, "kept").withColumnRenamed("key", name).hint("merge")
    return docs.withColumn(name, row()).join(kept, name, "left_semi").dropDuplicates([name]).drop(name)
