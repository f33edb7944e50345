"""Near duplicates by min-max hashing, confirmed on full shingle sets.

A document's set are its distinct word shingles. Each of ``PERMUTATIONS`` hash functions is evaluated
once per shingle and gives two values, its least and its greatest, so a signature has twice as many
values as evaluations; the share of equal values of two signatures is an unbiased estimate of their
similarity. The values are banded by ``ROWS``: two sets of similarity s miss each other in all bands
with odds of (1 - s^5)^40, 7e-11 at 0.85. Low bits of the values make a sketch; the sketches of two
linked sets agree in at least ``AGREE`` of 200 places but for odds of about 1e-11.

Only different sets are compared, one of each. Those that meet in a band and agree in size and sketch
are joined to candidate groups: what leaves a task is a tree over them, never all pairs. A band value
of more than ``dense`` sets is not compared at all, its sets are chained in order of size; groups may
be too large, never too small. Links are then confirmed inside each group on the full sets, shuffled
once by group: a set is compared with all others of its group at once through their shingles, and a
group is done as soon as all that is left are sets of one component.

A group of more than ``block`` shingles is cut into blocks. First every block is compared with
itself and with one set of the group, the pivot; then only sets outside the group's greatest component
so far meet all blocks. Copies of one text, however many, cost one comparison each.

The set of a document with fewer words than a shingle is its word sequence. Documents without words
or text have an empty set and link with nothing. Repeated rows appear each; rows with a null doc_id
link like others, but a component is named by the least doc_id it has, null if it has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfcurve.llm.common import map_batches, ship, texts
from shelfcurve.llm.simhash import components
from shelfcurve.operators.joins import join_group_stats
from shelfcurve.session import materialise

SHINGLE = 5
PERCENT = 85
PERMUTATIONS = 100
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
AGREE = 159
SEED = 42
DENSE = 4096
BLOCK = 2_000_000

_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = np.random.default_rng(SEED + 1).integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2)


def shingles(text: str, shingle: int = SHINGLE) -> set[bytes]:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    line = b" ".join(words)
    if len(words) <= shingle:
        return {line} if words else set()
    ends = np.fromiter(map(len, words), np.int64, len(words))
    np.cumsum(ends + 1, out=ends)  # one past the space after each word
    return {line[a:b] for a, b in zip([0, *ends[:-shingle].tolist()], (ends[shingle - 1 :] - 1).tolist())}


def hashes(found: set[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    made = np.fromiter((digest(s, SEED) for s in found), np.uint64, len(found))
    made.sort()
    return made


def signature(values: np.ndarray) -> np.ndarray:
    """The least values under each permutation, then the greatest."""
    least, most = np.full(PERMUTATIONS, np.iinfo(np.uint64).max), np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(values), 4096):
        under = values[at : at + 4096, None] * _FACTORS + _SHIFTS
        np.minimum(least, under.min(axis=0), out=least)
        np.maximum(most, under.max(axis=0), out=most)
    return np.concatenate([least, most])


def _bands(values: np.ndarray) -> np.ndarray:
    """One value per band of a signature."""
    rows = values.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(rows[k].tobytes(), k) for k in range(BANDS)], np.uint64).view(np.int64)


def _sketch(values: np.ndarray) -> np.ndarray:
    bits = np.zeros(256, np.uint8)
    bits[: len(values)] = (values >> np.uint64(40)).astype(np.uint8) & 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, same, bands, sketch) by row; ``same`` tells equal sets, null for an empty one."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, same, bands, sketch = [], [], [], []
        for text in texts(batch, 1):
            found = hashes(shingles(text, shingle))
            n.append(len(found))
            if len(found):
                values = signature(found)
                same.append(hashlib.sha256(found.tobytes()).digest()[:16])
                bands.append(_bands(values))
                sketch.append(_sketch(values))
            else:
                same.append(None)
                bands.append(None)
                sketch.append(None)
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(bands, longs), pa.array(sketch, longs)],
            ["doc_id", "n_shingles", "same", "bands", "sketch"],
        )

    picked = docs.select("doc_id", "text")
    kind = picked.schema["doc_id"].dataType.simpleString()
    return map_batches(picked, run, f"doc_id {kind}, n_shingles bigint, same binary, bands array<bigint>, sketch array<bigint>")


def _near(ids: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A tree over some sets in order of size: links of those that agree in size and sketch."""
    n = len(ids)
    left, right = [], []
    component = np.arange(n)
    reach = np.searchsorted(sizes, sizes * 100 // percent, "right")
    for k in range(n - 1):
        stop = int(reach[k])
        apart = np.flatnonzero(component[k + 1 : stop] != component[k]) + k + 1
        if not len(apart):
            continue
        differ = np.bitwise_count(sketches[apart] ^ sketches[k]).sum(axis=1)
        near = apart[differ <= 2 * PERMUTATIONS - AGREE]
        for other in near.tolist():
            if component[other] != component[k]:
                component[component == component[other]] = component[k]
                left.append(k)
                right.append(other)
        if len(left) == n - 1:
            break
    return ids[right], ids[left]


def _meet(batches: Iterator[pa.RecordBatch], dense: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Candidate links within each run of equal bands of a partition sorted by (band, size)."""

    def columns(batch):
        sketch = np.stack([batch.column(k).to_numpy() for k in range(3, 7)], axis=1).view(np.uint64)
        return [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), sketch]

    def chain(ids, sizes, before):
        """Each set with the one before it, unless that one is too small for it and all after it."""
        ids, sizes = np.concatenate([before[0], ids]), np.concatenate([before[1], sizes])
        near = sizes[:-1] * 100 >= sizes[1:] * percent
        return ids[1:][near], ids[:-1][near]

    def runs(band, ids, sizes, sketch, out):
        edges = [0, *(np.flatnonzero(np.diff(band)) + 1).tolist(), len(band)]
        for a, b in zip(edges, edges[1:]):
            if b - a > dense:
                out.append(chain(ids[a:b], sizes[a:b], (ids[:0], sizes[:0])))
            elif b - a > 1:
                out.append(_near(ids[a:b], sizes[a:b], sketch[a:b], percent))

    def links(out):
        a, b = (np.concatenate([x[k] for x in out]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    held, crowd = None, None  # rows of the last band so far; or of a crowded band its key and last row
    for batch in batches:
        band, ids, sizes, sketch = columns(batch)
        out = []
        if crowd is not None:
            stays = int(np.searchsorted(band, crowd[0], "right"))
            out.append(chain(ids[:stays], sizes[:stays], crowd[1]))
            if stays == len(band):
                crowd = (crowd[0], (ids[-1:], sizes[-1:])) if stays else crowd
                yield links(out)
                continue
            crowd = None
            band, ids, sizes, sketch = band[stays:], ids[stays:], sizes[stays:], sketch[stays:]
        if held is not None:
            band, ids, sizes, sketch = (np.concatenate([h, x]) for h, x in zip(held, (band, ids, sizes, sketch)))
        last = int(np.searchsorted(band, band[-1])) if len(band) else 0
        runs(band[:last], ids[:last], sizes[:last], sketch[:last], out)
        held = None
        if len(band) - last > dense:
            out.append(chain(ids[last:], sizes[last:], (ids[:0], sizes[:0])))
            crowd = (band[-1], (ids[-1:], sizes[-1:]))
        elif len(band):
            held = [x[last:].copy() for x in (band, ids, sizes, sketch)]
        if out:
            yield links(out)
    if held is not None:
        out = []
        runs(*held, out)
        if out:
            yield links(out)


def candidates(sets: DataFrame, dense: int = DENSE, percent: int = PERCENT) -> DataFrame:
    """(a, b): links that join all sets of ``sets`` (id, n_shingles, bands, sketch) which may be near."""
    ship(sets.sparkSession)
    words = [F.get("sketch", F.lit(k)).alias(f"s{k}") for k in range(4)]
    keyed = sets.select(F.explode("bands").alias("band"), "id", F.col("n_shingles").alias("size"), *words)
    ordered = keyed.repartition("band").sortWithinPartitions("band", "size", "id")
    return ordered.mapInArrow(lambda it: _meet(it, dense, percent), "a bigint, b bigint").distinct()


def confirm(sets: list[np.ndarray], percent: int, asked: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """Links that give the components of all pairs of at least ``percent`` of similarity.

    One set at a time is compared with all others, through an index from shingles to sets. It is taken
    from a component other than the greatest, so that of two unlinked components one is asked whole.
    With ``asked`` only those sets need to be compared.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if n else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    parent, weight = np.arange(n), np.ones(n, np.int64)
    members = {k: [k] for k in range(n)}
    left, right = [], []
    open_ = np.ones(n, bool) if asked is None else asked.copy()
    while True:
        waiting = np.flatnonzero(open_)
        if not len(waiting):
            break
        if asked is None:
            outside = waiting[parent[waiting] != np.argmax(weight)]
            if not len(outside):
                break  # all that is not compared yet is of one component
            k = int(outside[0])
        else:
            k = int(waiting[0])
        open_[k] = False
        starts, stops = np.searchsorted(flat, sets[k]), np.searchsorted(flat, sets[k], "right")
        counts = stops - starts
        places = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        shared = np.bincount(owner[places], minlength=n)
        union = sizes + sizes[k] - shared
        for other in np.flatnonzero((100 * shared >= percent * union) & (parent != parent[k])).tolist():
            a, b = int(parent[k]), int(parent[other])
            if a == b:
                continue
            left.append(k)
            right.append(other)
            if weight[a] < weight[b]:
                a, b = b, a
            parent[members[b]] = a
            members[a] += members.pop(b)
            weight[a] += weight[b]
            weight[b] = 0
    return left, right


_LINKS = "grp bigint, a bigint, b bigint"


def _confirm_runs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal (grp, block) of a partition sorted by (grp, block, id, asked).
    Of rows with one id the last counts: an asker, or one of several equal rows."""
    held, key = [], None

    def done():
        rows = pa.Table.from_batches(held)
        ids = rows.column("id").to_numpy()
        last = np.flatnonzero(np.append(np.diff(ids) != 0, True))
        rows, ids = rows.take(pa.array(last)), ids[last]
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in rows.column("set")]
        asked = np.array(rows.column("asked").to_pylist(), object)
        left, right = confirm(sets, percent, None if asked[0] is None else asked.astype(bool))
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(left), pa.int64()), pa.array(ids[left]), pa.array(ids[right])], ["grp", "a", "b"])

    for batch in batches:
        grp, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(grp) != 0) | (np.diff(block) != 0)) + 1).tolist(), len(grp)]
        for a, b in zip(edges, edges[1:]):
            if b == a:
                continue
            if held and key != (grp[a], block[a]):
                yield done()
                held.clear()
            key = (int(grp[a]), int(block[a]))
            held.append(batch.slice(a, b - a))
    if held:
        yield done()


def _compare(rows: DataFrame, percent: int) -> DataFrame:
    dealt = rows.select("grp", "block", "asked", "id", "set").repartition("grp", "block").sortWithinPartitions("grp", "block", "id", "asked")
    return dealt.mapInArrow(lambda it: _confirm_runs(it, percent), _LINKS)


def links(docs: DataFrame, sets: DataFrame, groups: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(a, b): confirmed links between the sets of ``groups`` (id, grp); ``sets`` (id, key, n_shingles)
    tells the row of ``docs`` to read each from."""
    wanted = materialise(sets.join(groups, "id").select("id", "grp", "key", F.col("n_shingles").alias("n")), "wanted")
    blocks = lambda: F.ceil(F.sum("n") / block).cast("bigint")
    weights = wanted.groupBy("grp").agg(blocks().alias("blocks"), F.min(F.struct("n", "id"))["id"].alias("pivot"))
    placed = join_group_stats(wanted, materialise(weights, "weights"), ["grp"])
    keys = materialise(placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))), "placed")

    kept = ["id", "grp", "n", "block", "blocks", "pivot"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [hashes(shingles(t, shingle)).tobytes() for t in texts(batch, "text")]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(made, pa.binary())], [*kept, "set"])

    # joined alike at every size, so that the shuffle of texts follows the input
    met = docs.select(_row_key().alias("key"), "text").join(keys.hint("merge"), "key").select(*kept, "text")
    found = materialise(map_batches(met, run, ", ".join(f"{c} bigint" for c in kept) + ", set binary"), "sets")

    shown = lambda df, asked: df.select("grp", "block", F.lit(asked).cast("boolean").alias("asked"), "id", "set")
    cut = found.where("blocks > 1")
    pivots = cut.where("id = pivot").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    first = materialise(_compare(shown(found.unionByName(pivots), None), percent), "confirmed")

    # sets of cut groups outside their greatest component meet all blocks, in parts no larger than a block
    members = cut.select("grp", "id", "n").distinct()
    inner = first.join(members.select("grp").distinct(), "grp", "left_semi").select("a", "b")
    rooted = members.join(components(inner).withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = materialise(rooted, "rooted")
    sized = rooted.groupBy("grp", "root").agg(F.count("*").alias("m"))
    main = sized.groupBy("grp").agg(F.max(F.struct("m", "root"))["root"].alias("main"))
    outside = join_group_stats(rooted, main, ["grp"]).where("root <> main")
    parts = materialise(outside.groupBy("grp").agg(blocks().alias("parts")), "parts")
    dealt = join_group_stats(outside, parts, ["grp"]).select("id", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))
    pair = (F.col("part") * F.col("blocks") + F.col("block")).alias("block")
    asking = cut.join(dealt, "id").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    others = join_group_stats(cut, parts, ["grp"]).withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
    both = [shown(df.select("grp", pair, "id", "set"), asked) for df, asked in ((asking, True), (others, False))]
    return first.unionByName(_compare(both[0].unionByName(both[1]), percent)).select("a", "b")


def _row_key():
    """Tells a row from others, but not from one that is equal in doc_id and text."""
    return F.struct("doc_id", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("text"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, dense: int = DENSE, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept. Only doc_id and text are read.

    ``component_id`` is the least doc_id among all rows that links lead to, itself included; ``kept`` is
    true where doc_id is that (or both are null).
    """
    keyed = docs.select(_row_key().alias("doc_id"), "text")
    rows = materialise(signatures(keyed, shingle).withColumnRenamed("doc_id", "key").withColumn("doc_id", F.col("key.doc_id")), "signatures")
    full = rows.where("same IS NOT NULL")
    # one row per different set, with the least doc_id and one text that has it
    whole = full.groupBy("same").agg(F.min("doc_id").alias("least"), F.min(F.struct("key", "n_shingles", "bands", "sketch")).alias("x"))
    sets = materialise(whole.select("same", "least", "x.*", F.monotonically_increasing_id().alias("id")), "different")
    tree = materialise(candidates(sets, dense, percent), "candidates")
    groups = components(tree).select(F.col("node").alias("id"), F.col("root").alias("grp"))
    groups = materialise(groups.unionByName(groups.select(F.col("grp").alias("id"), "grp").distinct()), "groups")
    linked = components(materialise(links(docs, sets, groups, shingle, percent, block), "links"))
    placed = sets.select("same", "id", "least").join(linked.withColumnRenamed("node", "id"), "id", "left")
    placed = materialise(placed.select("same", "least", F.coalesce("root", "id").alias("root")), "rooted")
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(join_group_stats(placed, names, ["root"]).select("same", "component_id"), "named")
    narrow = rows.select("doc_id", "n_shingles", "same")
    told = join_group_stats(narrow.where("same IS NOT NULL"), named, ["same"]).select("doc_id", "n_shingles", "component_id")
    empty = narrow.where("same IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return told.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
