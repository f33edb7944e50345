"""SimHash near duplicates and slack packing against plain versions of themselves."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import xxhash
from cases import empty, odd, odd_rows
from pyspark.sql import functions as F

from shelfcurve.llm import simhash, slack, tokens
from shelfcurve.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 4]) for i in range(max(len(w) - 4, 0) + 1)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(fps, ids):
    """Smallest id of each row's component by comparing all pairs."""
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(fps)):
        groups[root(i)].append(ids[i])
    return [min((x for x in groups[root(i)] if x is not None), default=None) for i in range(len(fps))]


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    fps = [plain_fingerprint(d.text) for d in docs]
    want = sorted(zip([d.doc_id for d in docs], [f"{f:016x}" for f in fps], plain_components(fps, [d.doc_id for d in docs])))
    got = sorted(tuple(r)[:3] for r in QUERIES["op9_simhash_duplicates"](spark, SF).collect())
    assert got == want and any(a != c for a, _, c in want)


def chains():
    """Fingerprints in chains, crowds and alone."""
    pick = random.Random(3)
    out = {0, 2**64 - 1, 1 << 63}
    for _ in range(12):
        x = pick.getrandbits(64)
        for _ in range(25):
            out.add(x)
            for _ in range(pick.randint(1, 6)):
                x ^= 1 << pick.randrange(64)
    base = pick.getrandbits(64)
    out |= {base ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(12)}
    return sorted(out)


def test_components_of_chains_and_crowds(spark):
    fps = chains()
    want = plain_components(fps, list(range(len(fps))))
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(4)
    for dense in (4096, 6):
        roots = {r.node: r.root for r in simhash.components(simhash.links(frame, dense)).collect()}
        groups = defaultdict(set)
        for k, s in enumerate(signed):
            groups[roots.get(s, s)].add(k)
        got = {frozenset(g) for g in groups.values()}
        by = defaultdict(set)
        for k, c in enumerate(want):
            by[c].add(k)
        assert got == {frozenset(g) for g in by.values()}, dense


def one_of_each(rows):
    """Of (doc_id, text) rows the first of each component: by doc_id, null last, then by the text's hash."""
    groups = {}
    for (doc_id, text), c in zip(rows, plain_components([plain_fingerprint(t) for _, t in rows], list(range(len(rows))))):
        place = (doc_id is None, doc_id or 0, hashlib.sha256((text or "").encode()).hexdigest())
        groups.setdefault(c, []).append((place, str(doc_id), text))
    return sorted((min(g, key=lambda x: x[0])[1:] for g in groups.values()), key=str)


def test_one_row_of_each_component_stays(rows):
    """Repeated doc_ids with different texts, and columns named like helpers."""
    a, b = "one two three four five six seven eight", "quite another text with other words in it altogether"
    docs = rows("doc_id long, text string, _kept int, helper string, _holes int", (3, a, 1, "x", 2), (5, a, 1, "x", 2), (5, b, 1, "x", 2), (None, b, 1, "x", 2))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, a), (5, b)]


def test_simhash_odd_rows(spark):
    got = simhash.near_duplicates(odd(spark)).collect()
    data = odd_rows()
    fps = [plain_fingerprint(r[1]) for r in data]
    want = plain_components(fps, [r[0] for r in data])
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == sorted((str(d[0]), f"{f:016x}", c) for d, f, c in zip(data, fps, want))
    kept = simhash.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(((str(r.doc_id), r.text) for r in kept.collect()), key=str) == one_of_each([(d[0], d[1]) for d in data])
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0


def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_tokenizer())
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def check_packing(packed, docs, room):
    """Every piece is there, bins are gapless and not too full; returns the number of bins."""
    want = []
    for doc_id, ids in docs:
        for k, a in enumerate(range(0, len(ids), room)):
            part = np.array(ids[a : a + room], "<u4")
            want.append((str(doc_id), k, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(want)
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= room
    return len(bins)


def test_packing_query_is_lossless_and_tight(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = whole_ids([d.text for d in docs])
    bins = check_packing(QUERIES["op3_slack_packing"](spark, SF).collect(), list(zip([d.doc_id for d in docs], ids)), 4096)
    assert bins <= -(-sum(map(len, ids)) // 4096) + 1


def test_packing_odd_rows_and_small_groups(spark):
    data = odd_rows()
    ids = whole_ids([r[1] for r in data])
    for room, group, rounds in [(4096, 2048, 3), (64, 8, 3), (7, 4, 1)]:
        packed = slack.pack_documents(odd(spark), tokens.default_tokenizer(), room, group, rounds).collect()
        check_packing(packed, list(zip([r[0] for r in data], ids)), room)
    assert slack.pack_documents(empty(spark), tokens.default_tokenizer()).count() == 0


def test_sequences_of_large_groups_have_numbers_of_their_own(spark):
    full = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit(4096).cast("bigint").alias("length"))
    assert slack.pack_pieces(full, group=20_000).select("sequence_id").distinct().count() == 40_000


def test_fullest_is_the_fullest():
    pick = random.Random(1)
    for _ in range(400):
        lengths = sorted({pick.randint(1, 40) for _ in range(pick.randint(1, 8))}, reverse=True)
        counts = [pick.randint(1, 4) for _ in lengths]
        room = pick.randint(0, 90)
        sums = {0}
        for length, n in zip(lengths, counts):
            sums = {s + k * length for s in sums for k in range(n + 1)}
        chosen = slack.fullest(lengths, counts, room)
        total = sum(length * n for length, n in chosen)
        assert total == max(s for s in sums if s <= room)
        used = defaultdict(int)
        for length, n in chosen:
            used[length] += n
        assert all(used[length] <= n for length, n in zip(lengths, counts))


def test_cached_encoding_is_the_tokenizers():
    texts = [r[1] or "" for r in odd_rows()] + ["It's they'll  don't\r\n<|endoftext|>x İ ΣΣ αΣ é ́a", "²Ⅷ ٠ _a_ 9a"]
    texts += ["Àé,Ñ! straße. µª º", "ÿŸ Ā. a" + "b" * 70, "x.", ".", "don't.", "a.b", "É"]
    encoder = tokens.Encoder(tokens.default_tokenizer())
    for _ in range(2):
        assert [[*encoder.encode(t), 1] for t in texts] == whole_ids(texts)
