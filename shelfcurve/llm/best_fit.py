"""Packed token matrices by best-fit decreasing with a segment tree.

Documents become pieces of at most ``room`` ids (see ``tokens.pieces``; overlong ones are cut, and
nothing is lost). Pieces are dealt at random to groups, each of which is packed by itself: longest
first, each into the open sequence with the least room that still holds it, which a segment tree
over the room left finds in a logarithmic number of steps. Each sequence is written as one row of an
id matrix with the cumulative lengths of its segments and the offsets where positions start anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcurve.llm.common import ship
from shelfcurve.llm.tokens import LENGTH, pieces

GROUP_BYTES = 8 << 20
GROUPS_PER_TASK = 4
PAD = 0


class Rooms:
    """How many open sequences have each amount of room left, as a segment tree of counts."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.count = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def _add(self, room: int, n: int) -> None:
        at = room + self.base
        while at:
            self.count[at] += n
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove a sequence with the smallest room of at least ``least``; its number and room."""
        at, count = least + self.base, self.count
        while not count[at]:
            while at & 1:  # up to the first node that has a right sibling
                at >>= 1
            if at == 0:
                return None
            at += 1
        while at < self.base:
            at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.base
        self._add(room, -1)
        return self.open[room].pop(), room


def pack(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each piece and its offset there."""
    rooms = Rooms(room)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number = 0
    for row in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[row])
        found = rooms.take(length)
        if found is None:
            found, number = (number, room), number + 1
        sequence[row], offset[row] = found[0], room - found[1]
        rooms.put(found[1] - length, found[0])
    return sequence, offset


def _write_group(rows: pa.Table, room: int) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    lengths = rows.column("length").to_numpy()
    sequence, offset = pack(lengths, room)
    ids, doc_ids, numbers = rows.column("ids").to_pylist(), rows.column("doc_id"), rows.column("piece").to_pylist()
    order = np.lexsort((offset, sequence))
    edges = np.flatnonzero(np.diff(sequence[order], prepend=-1, append=sequence.max() + 1)).tolist()
    out = {k: [] for k in ("n", "ids", "cumulative", "resets", "docs", "pieces")}
    pad = np.uint32(PAD).tobytes()
    for a, b in zip(edges, edges[1:]):
        mine = order[a:b]
        ends = np.cumsum(lengths[mine])
        out["n"].append(int(ends[-1]))
        out["ids"].append(b"".join(ids[k] for k in mine) + pad * (room - int(ends[-1])))
        out["cumulative"].append([0, *ends.tolist()])
        out["resets"].append(offset[mine].tolist())
        out["docs"].append(doc_ids.take(pa.array(mine)).to_pylist())
        out["pieces"].append([numbers[k] for k in mine])
    group = rows.column("group_id")[0].as_py()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([(group << 32) + k for k in range(len(out["n"]))], pa.int64()),
            pa.array(out["n"], pa.int32()), pa.array(out["ids"], pa.binary()),
            pa.array(out["cumulative"], pa.list_(pa.int32())), pa.array(out["resets"], pa.list_(pa.int32())),
            pa.array(out["docs"], pa.list_(doc_ids.type)), pa.array(out["pieces"], pa.list_(pa.int32())),
        ],
        ["sequence_id", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "pieces"],
    )


def pack_matrix(docs: DataFrame, tokenizer: str, room: int = LENGTH, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids, cu_seqlens, position_resets, doc_ids, pieces.

    ``ids`` are ``room`` little-endian unsigned 32-bit numbers, those from ``n_tokens`` on padding;
    ``cu_seqlens`` run from 0 to ``n_tokens``; ``position_resets`` are the offsets at which positions
    start at 0, one per piece; ``doc_ids`` and ``pieces`` name the pieces in order. Null and empty
    texts are one id. A group has about ``group_bytes`` of text, whatever the corpus.
    """
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    dealt = pieces(docs, tokenizer, room, keep_ids=True).withColumn("group_id", F.floor(F.rand(11) * groups))
    dealt = dealt.repartition(-(-groups // GROUPS_PER_TASK), "group_id").sortWithinPartitions("group_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            group = batch.column("group_id").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            for a, b in zip(edges, edges[1:]):
                if held and held[0].column("group_id")[0].as_py() != group[a]:
                    yield _write_group(pa.Table.from_batches(held), room)
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield _write_group(pa.Table.from_batches(held), room)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(
        run,
        "sequence_id bigint, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
        f"doc_ids array<{kind}>, pieces array<int>",
    )


def position_ids(n_tokens: int, resets: list[int]) -> np.ndarray:
    """Positions of a sequence: 0, 1, 2 ... from each reset on."""
    at = np.arange(n_tokens)
    return at - np.array(resets)[np.searchsorted(resets, at, "right") - 1]
