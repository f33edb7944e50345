"""Min-max hashing against all pairs of shingle sets."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute_minhash import near_duplicates, shingles
from cases import empty, odd

from shelfcurve.llm import minhash
from shelfcurve.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def check(df, **kw):
    got = sorted(map(tuple, minhash.near_duplicates(df, **kw).select(*COLUMNS).collect()), key=str)
    assert got == near_duplicates([(r.doc_id, r.text) for r in df.collect()])
    return got


def copies(groups, each, seed=3):
    """Groups of edited copies, also chains whose ends are unlike each other."""
    rng, rows = random.Random(seed), []
    words = [f"W{i}" for i in range(400)]
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([6, 30, 120, 300]))]
        for _ in range(each if g else 4 * each):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.1:
                base = text
            rows.append((len(rows), rng.choice([" ", "\n", " \x0b"]).join(text[: len(text) if rng.random() < 0.7 else len(text) * 19 // 20])))
    return rows


def test_query_equals_all_pairs(spark, sf_dir):
    got = sorted(map(tuple, QUERIES["op12_minhash_duplicates"](spark, sf_dir).select(*COLUMNS).collect()), key=str)
    assert got == near_duplicates([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])
    assert any(not r[-1] for r in got)


def test_odd_rows_and_none(spark):
    assert len(check(odd(spark))) == odd(spark).count()
    assert check(empty(spark)) == []


@pytest.mark.parametrize("limits", [{}, {"dense": 20, "block": 3000}])
def test_groups_of_copies(spark, limits):
    """The second case chains crowded bands and cuts groups into blocks."""
    got = check(spark.createDataFrame(copies(12, 40), "doc_id bigint, text string"), **limits)
    assert sum(not r[-1] for r in got) > len(got) / 4


def test_crowds_over_several_batches():
    """Runs of one band that begin, go on and end in different Arrow batches."""
    import pyarrow as pa

    n = 300
    band = np.repeat([1, 2, 3], [50, 200, 50])
    size = np.concatenate([np.full(50, 10), np.sort(np.arange(200) % 7 + 100), np.full(50, 10)])
    rows = pa.RecordBatch.from_arrays([pa.array(x) for x in (band, np.arange(n), size, *[np.zeros(n, np.int64)] * 4)], list("abcdefg"))
    for step in (7, 60, 300):
        out = list(minhash._meet(iter([rows.slice(k, step) for k in range(0, n, step)]), 60, 85))
        links = {tuple(x) for b in out for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
        parent = list(range(n))
        for a, b in links:
            old, new = parent[a], parent[b]
            parent = [new if p == old else p for p in parent]
        assert len(set(parent)) == 3 and len(links) == n - 3


def test_signature_estimates_without_bias():
    rng = random.Random(1)
    shared, errors = 0.6, []
    for _ in range(60):
        both = [rng.getrandbits(64) for _ in range(300)]
        a, b = [np.array(sorted(both[:60] + both[120:]), np.uint64), np.array(sorted(both[60:]), np.uint64)]
        errors.append((minhash.signature(a) == minhash.signature(b)).mean() - shared)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


@pytest.mark.parametrize("asked", [False, True])
def test_confirm_equals_all_pairs(asked):
    texts = [t for _, t in copies(4, 10)]
    sets = [minhash.hashes(minhash.shingles(t)) for t in dict.fromkeys(texts)]
    left, right = minhash.confirm(sets, 85, np.ones(len(sets), bool) if asked else None)
    groups = list(range(len(sets)))
    for a, b in zip(left, right):
        old, new = groups[a], groups[b]
        groups = [new if g == old else g for g in groups]
    plain = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 85 * (len(a) + len(b) - shared):
                old, new = plain[i], plain[j]
                plain = [new if g == old else g for g in plain]
    same = lambda marks: [[m == x for m in marks] for x in marks]
    assert same(groups) == same(plain)
    assert {len(minhash.shingles(t)) == len(shingles(t)) for t in texts} == {True}
