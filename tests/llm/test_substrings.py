"""Removal of repeated substrings against all windows of all texts."""

import hashlib
import random
from collections import Counter

import numpy as np
from cases import empty, odd, odd_rows

from shelfcurve.llm import sais, substrings
from shelfcurve.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(docs, length=200):
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for doc_id, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        starts = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain(docs)
    assert told(QUERIES["op7_repeated_substrings"](spark, SF)) == want and sum(0 < r[2] < r[1] for r in want) > 5


def test_hot_anchors_and_small_shards(spark):
    pick = random.Random(8)
    word = lambda n: "".join(pick.choice("abcdé ") for _ in range(n))
    passage, short = word(230), word(120)
    texts = [word(pick.randint(0, 150)) + passage + word(pick.randint(0, 150)) + short + word(90) for _ in range(40)]
    texts += [short + word(60) + short + word(60), passage * 3, "a" * 450, "ab" * 300, "b" * 199]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = plain(docs)
    for hot, shard in [(2000, 400_000), (5, 400_000), (2000, 2000)]:
        assert told(substrings.remove_repeats(frame, shard=shard, hot=hot)) == want
    assert told(substrings.remove_repeats(frame, length=70)) == plain(docs, 70)


def test_odd_rows(spark):
    want = plain([(r[0], r[1]) for r in odd_rows()])
    assert told(substrings.remove_repeats(odd(spark))) == want
    assert substrings.remove_repeats(empty(spark)).count() == 0


def prefix(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_suffix_array_and_prefixes(monkeypatch):
    pick = random.Random(6)
    for _ in range(400):
        monkeypatch.setattr(sais, "SMALL", pick.choice([1, 512]))
        k = pick.choice([2, 3, 30])
        s = [pick.randint(1, k) for _ in range(pick.randint(0, 50))] * pick.choice([1, 1, 3]) + [0]
        array = np.array(s, np.int64)
        want = sorted(range(len(s)), key=lambda i: s[i:])
        assert sais.suffix_array(array, k + 1).tolist() == want
        common = [0] * len(s)
        for a, b in zip(want, want[1:]):
            common[b] = prefix(s[a:], s[b:])
        assert sais.permuted_lcp(array, np.array(want)).tolist() == common
