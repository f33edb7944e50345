"""Conversation repair against a plain search over costs and audits."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute_repair import answer, repaired

from shelfcurve.llm import repair
from shelfcurve.llm.queries import QUERIES

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def check(df):
    got = rows_of(repair.repair_damaged(df))
    assert got == answer([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    return got


def test_query_equals_plain_search(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = rows_of(QUERIES["op13_conversation_repair"](spark, sf_dir))
    assert got == answer(list(map(tuple, turns.collect())))
    assert {k for r in got for k in r[7]} == set("DIKR")


def test_odd_rows(spark):
    """Null ids, turns, roles and texts, unknown roles, ties in turn, repeated rows, very long texts."""
    rng = random.Random(1)
    roles = ["system", "user", "assistant", "tool", None, "", "superuser", "été"]
    texts = ["a.", "b!", "c", "d? ", "", None, " \n", "x" * 50_000 + ".", "end.\n", "\x0c."]
    data = [(rng.choice([None, *range(50)]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for _ in range(500)]
    df = spark.createDataFrame([(*r, 1, "k", 2.0) for r in data], SCHEMA + ", pos int, conv string, symbol double")
    check(df)


def test_no_rows_and_none_left(spark):
    assert check(spark.createDataFrame([], SCHEMA)) == []
    # conversation 4 loses its only row to the damage
    gone = next(c for c in range(100) if not answer([(c, 0, "user", "a.")])[0][7])
    assert check(spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA))[0][1:8] == (0, 0, 0, 0, 0, 0, "")


def test_a_conversation_over_many_ranges(spark):
    """Two thirds of the rows are of one conversation, whose pieces lie in several ranges."""
    rng = random.Random(2)
    roles = ["system", "user", "assistant", "user", "assistant", "tool"]
    data = [(1 if i % 3 else i, rng.randrange(9000), rng.choice(roles), rng.choice([f"{i}.", f"{i}", "ok.", f"{i} x?"])) for i in range(6000)]
    check(spark.createDataFrame(data, SCHEMA))
    pieces = repair._ordered(spark.createDataFrame(data, SCHEMA)).where("conv.conv_id = 1").select("_range").distinct().count()
    assert pieces > 1


@pytest.mark.parametrize("cut", [1, 3, 50])
def test_pieces_give_the_answer_of_the_whole(cut):
    rng = random.Random(cut)
    roles = {0: "system", 3: "user", 6: "assistant", 9: "tool"}
    for _ in range(40):
        rows = [(k, rng.choice(list(roles.values())), rng.choice([f"{k}.", f"{k}", "", "again."])) for k in range(rng.randrange(1, 30))]
        seen, codes = set(), []
        for _, role, text in rows:
            bad = not text or (role, text) in seen
            seen.add((role, text))
            codes.append({v: k for k, v in roles.items()}[role] + (2 if bad else 1 if text[-1] != "." else 0))
        pieces = [np.array(codes[k : k + cut]) for k in range(0, len(codes), cut)]
        after = [repair._END]
        for m in repair.matrices(pieces)[:0:-1]:
            after.append((m + after[-1][None]).min(axis=1))
        last = np.arange(len(pieces)) == len(pieces) - 1
        ranked = repair.Ranked(pieces, np.array(after[::-1]), last)
        state, audit = 0, ""
        for first in ranked.first.tolist():
            path = ranked.path(first + state)
            state, audit = int(path[-1]) % 4, audit + ranked.audit(path)
        assert (int(ranked.costs[0, 0]), audit) == repaired(rows)[5:7]


def test_ranks_order_the_audits():
    """Ranks after doubling sort nodes as their whole audits do."""
    rng = np.random.default_rng(1)
    pieces = [rng.integers(0, 12, n) for n in (1, 7, 40)]
    ranked = repair.Ranked(pieces, np.tile(repair._END, (3, 1)), np.ones(3, bool))
    audits = [ranked.audit(ranked.path(v)) for v in range(len(ranked.letter))]
    order = np.argsort(ranked.rank, kind="stable")
    assert [audits[v] for v in order] == sorted(audits)
