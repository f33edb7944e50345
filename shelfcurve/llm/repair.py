"""Repair of the structure of conversations: cost DP and prefix-doubling path ranking.

A conversation is repaired by edits on its rows, in order: Keep, Rerole (to user or assistant),
Delete, and Insert of an empty turn before a row or at the end. The repaired role initials must match
``(s?(ua)+)?``, which an automaton of four states reads: nothing yet, after s, after u, after ua. The
cheapest edits come from a DP over the nodes (row, state). Of all cheapest ones the audit, the
initials of the edits in order, that is least as a string is taken: from every node the optimal arcs
are known, nodes are ranked by the first 1, 2, 4, ... letters of their least audit, each rank made of
two ranks of half the length, with a pointer that jumps as far; a path is read off through the
doubled pointers. From one node two optimal arcs never have the same letter, so the least letter of a
node settles its arc.

A conversation may hold any part of all rows. The rows are stored in ranges of (conversation, order);
the part of a conversation in a range is a piece. A piece is summed up as a matrix of least costs
between states; per conversation the matrices give each piece the costs that follow it, and with them
a piece knows, for each state it may be entered in, its audit and the state it is left in. A walk over
these, one step per piece, gives the state each piece is entered in. The repaired text is hashed as a
stream. So no task holds more than a range, or a number of small records per conversation.

Rows are ordered by turn (nulls first), then role, then the SHA-256 of the text; equal rows follow
each other. A null text or role is one space. A null conv_id is a conversation. Other columns are not
read. A conversation without rows is not returned by ``repair``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcurve.llm.common import map_batches, ship, slices
from shelfcurve.operators.joins import join_group_stats
from shelfcurve.operators.windows import RANGE, ordered_ranges
from shelfcurve.session import materialise

# fixed values: what edits cost
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACE = r"\x20\x09-\x0D"
LETTERS = "DIKR"  # in ASCII order
ROLES = ("", "user", "assistant")
NEVER = 1 << 40
COPIES = 10_000

# states: 0 nothing yet, 1 after s, 2 after u, 3 after ua
_READ = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_NEXT = np.array([2, 2, 3, 2])  # after the one role that may be added in each state
_ADDED = np.array([1, 1, 2, 1])  # that role's place in ROLES
_END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)  # least cost of an end by inserts


def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Cost and target of D, K and R by symbol and state. A symbol is 3 * initial + condition: the
    initial one of s, u, a, other; the condition sound, truncated, or to be deleted."""
    cost, to = np.full((12, 4, 3), NEVER, np.int64), np.zeros((12, 4, 3), np.int64)
    for k, initial in enumerate("sua?"):
        for condition in range(3):
            more = TRUNCATED if condition == 1 else 0
            for q in range(4):
                s = 3 * k + condition
                cost[s, q, 0], to[s, q, 0] = DELETE, q
                if condition < 2:
                    cost[s, q, 2], to[s, q, 2] = REROLE + more, _NEXT[q]
                    if initial in _READ and _READ[initial][q] is not None:
                        cost[s, q, 1], to[s, q, 1] = more, _READ[initial][q]
    return cost, to


_COST, _TO = _symbols()


def _inserts() -> np.ndarray:
    """Least cost between states by inserts alone."""
    least = np.full((4, 4), NEVER, np.int64)
    for q in range(4):
        at, cost = q, 0
        while cost < least[q, at]:
            least[q, at] = cost
            at, cost = _NEXT[at], cost + INSERT
    return least


_INSERTS = _inserts()


def _row_costs(symbols: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For some rows and the costs after them: cost by (row, state) of D, K, R, and the least cost
    with inserts before the row."""
    row = np.arange(len(symbols))[:, None, None]
    edits = _COST[symbols] + after[row, _TO[symbols]]
    least = (_INSERTS[None] + edits.min(axis=2)[:, None, :]).min(axis=2)
    return edits, least


def _backwards(pieces: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(step, pieces that have a row there), from the last rows to the first; pieces end together."""
    sizes = np.array([len(p) for p in pieces])
    for step in range(1, int(sizes.max(initial=0)) + 1):
        yield step, np.flatnonzero(sizes >= step)


def matrices(pieces: list[np.ndarray]) -> np.ndarray:
    """Least cost from state to state over each piece, inserts before its rows included."""
    out = np.full((len(pieces), 4, 4), NEVER, np.int64)
    out[:, range(4), range(4)] = 0
    for step, some in _backwards(pieces):
        symbols = np.array([pieces[k][-step] for k in some])
        for last in range(4):
            out[some, :, last] = _row_costs(symbols, out[some, :, last])[1]
    return np.minimum(out, NEVER)


def _dense(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks."""
    both = first * (second.max(initial=0) + 1) + second
    return np.unique(both, return_inverse=True)[1]


class Ranked:
    """The optimal arcs of some pieces, ranked by doubling. ``after``: costs by (piece, state) that
    follow each piece; ``last`` tells the pieces whose conversation ends with them."""

    def __init__(self, pieces: list[np.ndarray], after: np.ndarray, last: np.ndarray):
        sizes = np.array([len(p) for p in pieces])
        self.first = 4 * np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
        n = int(4 * (sizes + 1).sum())
        self.letter = np.zeros(n, np.int64)  # 0: the end, else 1 + place in LETTERS
        self.jump = np.arange(n)
        self.costs = after.copy()
        end = self.first + 4 * sizes
        for q in (0, 1, 2, 3):
            inserting = last & (_END[q] > 0)
            self.letter[end[inserting] + q], self.jump[end[inserting] + q] = 2, end[inserting] + _NEXT[q]
        for step, some in _backwards(pieces):
            symbols = np.array([pieces[k][-step] for k in some])
            edits, least = _row_costs(symbols, self.costs[some])
            inserting = INSERT + least[:, _NEXT]
            node = (end[some] - 4 * step)[:, None] + np.arange(4)
            letter, jump = np.full(least.shape, 4), node + 4 - np.arange(4) + _TO[symbols][:, :, 2]
            for code, cost, target in (
                (3, edits[:, :, 1], node + 4 - np.arange(4) + _TO[symbols][:, :, 1]),
                (2, inserting, node - np.arange(4) + _NEXT),
                (1, edits[:, :, 0], node + 4),
            ):
                optimal = cost == least
                letter, jump = np.where(optimal, code, letter), np.where(optimal, target, jump)
            self.letter[node], self.jump[node] = letter, jump
            self.costs[some] = least
        self.jumps, self.rank = [self.jump], self.letter
        while (self.letter[self.jumps[-1]] > 0).any():  # some path is longer than the pointers reach
            self.rank = _dense(self.rank, self.rank[self.jumps[-1]])
            self.jumps.append(self.jumps[-1][self.jumps[-1]])

    def path(self, node: int) -> np.ndarray:
        """The nodes of the least path from ``node``, its end included."""
        nodes = np.array([node])
        for jump in self.jumps:
            nodes = np.concatenate([nodes, jump[nodes]])
        ends = np.flatnonzero(self.letter[nodes] == 0)
        return nodes[: ends[0] + 1]

    def audit(self, path: np.ndarray) -> str:
        return "".join(LETTERS[k - 1] for k in self.letter[path[:-1]].tolist())


def _codes(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(s.encode(), np.uint8) - ord("A") for s in column.to_pylist()]


def _piece_matrices(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = matrices(_codes(batch.column("symbols"))).reshape(-1, 16)
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.tolist(), pa.list_(pa.int64()))], [*batch.schema.names, "matrix"])


def _followers(batch: pa.RecordBatch) -> pa.RecordBatch:
    """For each conversation, whose matrices stand in order, the costs after each piece."""
    out = []
    for found in batch.column("matrices").to_pylist():
        costs, after = [_END], np.array(found, np.int64).reshape(-1, 4, 4)
        for matrix in after[:0:-1]:
            costs.append((matrix + costs[-1][None]).min(axis=1))
        out.append([c.tolist() for c in costs[::-1]])
    kept = [n for n in batch.schema.names if n != "matrices"]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(out, pa.list_(pa.list_(pa.int64())))], [*kept, "after"])


def _outcomes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """By the state a piece is entered in: its cost, its audit and the state it is left in."""
    pieces = _codes(batch.column("symbols"))
    ranked = Ranked(pieces, np.array(batch.column("after").to_pylist(), np.int64).reshape(-1, 4), np.array(batch.column("last").to_pylist(), bool))
    outcomes = []
    for k, first in enumerate(ranked.first.tolist()):
        paths = [ranked.path(first + q) for q in range(4)]
        outcomes.append([{"cost": int(ranked.costs[k, q]), "audit": ranked.audit(p), "left": int(p[-1]) % 4} for q, p in enumerate(paths)])
    kind = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("left", pa.int32())]))
    kept = [n for n in batch.schema.names if n not in ("symbols", "after", "last")]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(outcomes, kind)], [*kept, "outcomes"])


def _edits(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Per row of a piece: the roles inserted before it and its own role, by their places in ROLES: 0 for
    a kept one, -1 for a deleted row. Inserts at the end stand on a row after the last."""
    made = []
    for audit, state, codes in zip(batch.column("audit").to_pylist(), batch.column("entered").to_pylist(), _codes(batch.column("symbols"))):
        rows, before = [], []
        for letter in audit:
            if letter == "I":
                before.append(int(_ADDED[state]))
                state = int(_NEXT[state])
                continue
            symbol = codes[len(rows)]
            rows.append({"before": before, "role": {"D": -1, "K": 0, "R": int(_ADDED[state])}[letter]})
            before, state = [], int(_TO[symbol, state, "DKR".index(letter)])
        made.append(rows + [{"before": before, "role": -1}])
    kind = pa.list_(pa.struct([("before", pa.list_(pa.int32())), ("role", pa.int32())]))
    kept = [n for n in batch.schema.names if n not in ("audit", "entered", "symbols")]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(made, kind)], [*kept, "rows"])


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation of a sorted partition, newline-joined, as a stream."""
    now, digest, out = None, None, []
    for whole in batches:
        for batch in slices(whole):
            for conv, lines in zip(batch.column("conv").to_pylist(), batch.column("lines").to_pylist()):
                if now is None or conv != now:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest, some = conv, hashlib.sha256(), False
                for line in lines:
                    digest.update(("\n" if some else "").encode() + line.encode("utf-8", "surrogatepass"))
                    some = True
            if len(out) > 1000:
                yield _hashes(out, whole.schema)
                out = []
    if now is not None:
        out.append((now, digest.hexdigest()))
        yield _hashes(out, whole.schema)


def _hashes(found: list[tuple[dict, str]], schema: pa.Schema) -> pa.RecordBatch:
    conv = pa.array([c for c, _ in found], schema.field("conv").type)
    return pa.RecordBatch.from_arrays([conv, pa.array([h for _, h in found])], ["conv", "repaired_sha256"])


def _initial() -> Column:
    return F.substring("role", 1, 1)


def _ordered(turns: DataFrame) -> DataFrame:
    """The rows with their faults, in stored ranges: conv, turn, role, sig, copy, text, fault, symbol, pos."""
    full = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = turns.select(F.struct("conv_id").alias("conv"), "turn", full("role").alias("role"), full("text").alias("text"))
    same = rows.withColumn("sig", F.sha2("text", 256)).groupBy("conv", "turn", "role", "sig", "text").agg(F.count("*").alias("n"))
    same = materialise(same.withColumn("id", F.struct("conv", "role", "sig")), "turns")
    # where a role and text are first seen; the rows meet it in a join that deals a hot one over many tasks
    seen = same.groupBy("id").agg(F.min(F.struct("turn")).alias("since"))
    told = join_group_stats(same, seen, ["id"])
    part = F.explode(F.expr(f"sequence(0L, n - 1, {COPIES}L)"))
    told = told.withColumn("part", part).withColumn("copy", F.explode(F.expr(f"sequence(part, least(part + {COPIES}, n) - 1)")))
    fault = (
        F.when(~F.col("text").rlike(f"[^{SPACE}]"), "blank")
        .when((F.struct("turn") != F.col("since")) | (F.col("copy") > 0), "duplicate")
        .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), "truncated")
    )
    initial = F.when(_initial() == "s", 0).when(_initial() == "u", 3).when(_initial() == "a", 6).otherwise(9)
    condition = F.when(F.col("fault").isNull(), 0).when(F.col("fault") == "truncated", 1).otherwise(2)
    marked = told.withColumn("fault", fault).withColumn("symbol", F.char(initial + condition + ord("A")))
    kept = marked.select("conv", "turn", "role", "sig", "copy", "text", "fault", "symbol")
    order = ["conv", "turn", "role", "sig", "copy"]
    place = F.row_number().over(Window.partitionBy(*RANGE, "conv").orderBy(*order[1:]))
    return ordered_ranges(kept, order).withColumn("pos", place)


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text) with rows: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    ship(turns.sparkSession)
    rows = _ordered(turns)
    count = lambda f: F.count(F.when(F.col("fault") == f, 1)).alias(f)
    pair = F.concat(F.lag(_initial()).over(Window.partitionBy(*RANGE, "conv").orderBy("pos")), _initial())
    legal = ("su", "ua", "au")
    pieces = rows.withColumn("pair", pair).groupBy(*RANGE, "conv").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))), lambda x: x["symbol"]), "").alias("symbols"),
        count("blank"), count("duplicate"), count("truncated"),
        F.count(F.when(~F.col("pair").isin(*legal), 1)).alias("illegal"),
        F.min_by(_initial(), "pos").alias("head"), F.max_by(_initial(), "pos").alias("tail"),
    )
    pieces = materialise(pieces, "pieces")
    conv = pieces.schema["conv"].dataType.simpleString()
    place = f"_bucket bigint, _range int, conv {conv}"

    measured = map_batches(pieces.select(*RANGE, "conv", "symbols"), _piece_matrices, f"{place}, symbols string, matrix array<bigint>")
    gathered = measured.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("_range", "_bucket", "matrix"))).alias("p"))
    gathered = gathered.select("conv", F.transform("p", lambda x: F.struct(x["_bucket"], x["_range"])).alias("places"), F.col("p.matrix").alias("matrices"))
    followed = map_batches(gathered, _followers, f"conv {conv}, places array<struct<_bucket:bigint,_range:int>>, after array<array<bigint>>")
    followed = followed.select("conv", F.size("places").alias("n"), F.posexplode(F.arrays_zip("places", "after")).alias("i", "x"))
    followed = followed.select("conv", "x.places._bucket", "x.places._range", "x.after", (F.col("i") + 1 == F.col("n")).alias("last"))
    known = pieces.join(followed, [*RANGE, "conv"])
    tried = map_batches(
        known.select(*RANGE, "conv", "symbols", "after", "last"), _outcomes, f"{place}, outcomes array<struct<cost:bigint,audit:string,left:int>>"
    )
    tried = materialise(tried, "outcomes")
    ends = pieces.drop("symbols").join(tried, [*RANGE, "conv"])
    walked = ends.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("_range", "_bucket", "outcomes", "head", "tail"))).alias("p"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
    )
    step = lambda acc, x: F.concat(acc, F.array(F.get(x["outcomes"], F.element_at(acc, -1))["left"]))
    states = F.aggregate("p", F.expr("array(0)"), step)
    between = F.expr("size(filter(sequence(1, size(p)), i -> i < size(p) AND concat(p[i - 1].tail, p[i].head) NOT IN ('su', 'ua', 'au')))")
    walked = walked.select(
        "conv", "blank", "duplicate", "truncated", (F.col("illegal") + between).alias("illegal"),
        F.expr("p[0].outcomes[0].cost").alias("cost"),
        F.zip_with("p", F.slice(states, F.lit(1), F.size("p")), lambda x, q: F.struct(
            x["_bucket"], x["_range"], q.alias("entered"), F.get(x["outcomes"], q)["audit"].alias("audit"))).alias("walk"),
    )
    walked = materialise(walked, "walks")

    steps = walked.select("conv", F.inline("walk")).join(pieces.select(*RANGE, "conv", "symbols"), [*RANGE, "conv"])
    edits = map_batches(
        steps.select(*RANGE, "conv", "symbols", "entered", "audit"), _edits, f"{place}, rows array<struct<before:array<int>,role:int>>"
    )
    edits = edits.select(*RANGE, "conv", F.posexplode("rows").alias("i", "e")).select(*RANGE, "conv", (F.col("i") + 1).alias("pos"), "e.*")
    named = F.array(*map(F.lit, ROLES))
    added = F.transform("before", lambda r: F.concat(F.get(named, r), F.lit(":")))
    own = F.concat(F.when(F.col("edit") == 0, F.col("role")).otherwise(F.get(named, F.col("edit"))), F.lit(":"), F.col("text"))
    lines = F.concat(added, F.when(F.col("edit") >= 0, F.array(own)).otherwise(F.array().cast("array<string>")))
    texts = edits.withColumnRenamed("role", "edit").join(rows.select(*RANGE, "conv", "pos", "role", "text"), [*RANGE, "conv", "pos"], "left")
    written = texts.select("conv", "_range", "pos", lines.alias("lines")).repartition("conv").sortWithinPartitions("conv", "_range", "pos")
    hashed = written.select("conv", "lines").mapInArrow(_hash_lines, f"conv {conv}, repaired_sha256 string")

    turn_sets = rows.where("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv")
    gaps = turn_sets.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    audit = F.array_join(F.transform("walk", lambda x: x["audit"]), "").alias("audit")
    return walked.join(gaps, "conv", "left").join(hashed, "conv").select(
        "conv.conv_id", F.coalesce("gaps", F.lit(0)).cast("bigint").alias("gaps"),
        *[F.col(c).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], audit, "repaired_sha256",
    )


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with faults that depend on conv_id and turn alone."""
    full = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(full("conv_id"), F.lit(":"), full("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(full("text"), "[.!?]", "")).otherwise(full("text"))
    role = F.when(kind == 4, "user").otherwise(full("role"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("again")).drop("again")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """``repair`` after ``damage``, for every conv_id of ``turns``; one without rows is repaired by nothing."""
    every = turns.select(F.struct("conv_id").alias("conv")).distinct()
    found = repair(damage(turns)).withColumn("conv", F.struct("conv_id")).drop("conv_id")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, "conv", "left").select(
        "conv.conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
