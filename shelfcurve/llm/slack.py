"""Best-fit packing by minimum bin slack.

Pieces are dealt at random to groups of about ``group`` pieces, and each group is packed by itself.
A bin starts with the longest piece that is left. A dynamic program over the lengths that are left,
longest first, keeps in a bitset which sums can be reached in the rest of the bin; it stops when the
bin can be filled to the last token, else it takes the greatest sum. That combination is removed,
and the next bin starts. The pieces of bins with slack are dealt and packed again, for ``rounds``
rounds, so that the odd last bins of the groups are filled with each other's pieces.

A group is bounded by its number of pieces, whatever the corpus; no piece's text or id decides where
it is dealt, so no key can make a group grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcurve.llm.common import ship
from shelfcurve.llm.tokens import LENGTH, pieces
from shelfcurve.session import materialise

GROUP = 2048
ROUNDS = 3
GROUPS_PER_TASK = 8


def fullest(lengths: list[int], counts: list[int], room: int) -> list[tuple[int, int]]:
    """(length, how many) with the greatest sum up to ``room``; ``lengths`` fall, ``counts`` say how many there are."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    full = 1 << room
    for length, count in zip(lengths, counts):
        if length > room:
            continue
        take = 1
        left = min(count, room // length)
        while left > 0:  # binary parts of the multiplicity
            part = min(take, left)
            grown = (reach | reach << length * part) & mask
            if grown != reach:
                steps.append((length, part, reach))
                reach = grown
            left -= part
            take *= 2
            if reach & full:
                break
        if reach & full:
            break
    total = reach.bit_length() - 1
    chosen = []
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            chosen.append((length, part))
            total -= length * part
    return chosen


def pack(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the place in it of each piece. Equal lengths are taken in the given order."""
    order = np.lexsort((np.arange(len(lengths)), -lengths))
    values, first, count = np.unique(-lengths[order], return_index=True, return_counts=True)
    kinds = (-values).tolist()
    left, at = count.tolist(), first.tolist()
    where = {v: k for k, v in enumerate(kinds)}
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number = 0
    while kinds:
        chosen = [(kinds[0], 1)]
        left[0] -= 1
        chosen += fullest(kinds, left, room - kinds[0])
        left[0] += 1
        place = 0
        for length, n in chosen:
            k = where[length]
            for row in order[at[k] : at[k] + n].tolist():
                bins[row], places[row] = number, place
                place += length
            at[k] += n
            left[k] -= n
        number += 1
        if any(left[where[length]] == 0 for length, _ in chosen):
            keep = [k for k, n in enumerate(left) if n]
            kinds, left, at = [kinds[k] for k in keep], [left[k] for k in keep], [at[k] for k in keep]
            where = {v: k for k, v in enumerate(kinds)}
    return bins, places


def _pack_groups(batches: Iterator[pa.RecordBatch], room: int) -> Iterator[pa.RecordBatch]:
    """Pack each run of equal groups (column 0) of a sorted partition; column 1 has the lengths."""

    def packed(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        lengths = rows.column(1).to_numpy()
        bins, places = pack(lengths, room)
        used = np.bincount(bins, weights=lengths)[bins].astype(np.int64)
        out = rows.append_column("bin", pa.array(bins)).append_column("offset", pa.array(places)).append_column("used", pa.array(used))
        return out.to_batches()[0]

    held: list[pa.RecordBatch] = []
    for batch in batches:
        group = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for a, b in zip(edges, edges[1:]):
            if held and held[0].column(0)[0].as_py() != group[a]:
                yield packed(pa.Table.from_batches(held))
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield packed(pa.Table.from_batches(held))


def pack_pieces(rows: DataFrame, room: int = LENGTH, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """``rows``, which have a ``length`` of at most ``room``, with sequence_id and offset.

    Columns named row, turn, bin, used or group_id are taken by the packing. ``rows`` should be a
    stored table: they are numbered once and then join their places by that number.
    """
    ship(rows.sparkSession)
    numbered = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "pieces")
    todo, done = numbered.select("length", "row"), []
    for turn in range(rounds):
        # so many groups that each has about ``group`` pieces
        groups = max(1, -(-todo.count() // group))
        dealt = todo.select(F.pmod(F.xxhash64(F.lit(turn), "row"), F.lit(groups)).alias("group_id"), "length", "row")
        dealt = dealt.repartition(-(-groups // GROUPS_PER_TASK), "group_id").sortWithinPartitions("group_id", "row")
        packed = dealt.mapInArrow(
            lambda it: _pack_groups(it, room), "group_id bigint, length bigint, row bigint, bin bigint, offset bigint, used bigint"
        )
        packed = materialise(packed.withColumn("turn", F.lit(turn)), "packed")
        last = turn == rounds - 1 or groups == 1
        done.append(packed if last else packed.where(F.col("used") == room))
        todo = packed.where(F.col("used") < room).select("length", "row")
        if last:
            break
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    # groups are dealt by hash; one that is several times too large is an error, never a shared number
    bits = (8 * group).bit_length()
    number = F.expr(f"""if(bin < {1 << bits} AND group_id < {1 << 58 - bits},
        shiftleft(CAST(turn AS BIGINT), 58) + shiftleft(group_id, {bits}) + bin, raise_error('a group has too many sequences'))""").cast("bigint")
    return numbered.join(placed.select("row", number.alias("sequence_id"), "offset"), "row").drop("row")


def pack_documents(docs: DataFrame, tokenizer: str, room: int = LENGTH, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece of every row of ``docs``: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. Null and empty texts are one piece of one id. See ``tokens.pieces``."""
    return pack_pieces(pieces(docs, tokenizer, room), room, group, rounds)
