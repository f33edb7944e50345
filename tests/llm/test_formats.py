"""Chat formatting, fingerprints, matrices and URL lists against plain versions of themselves."""

import hashlib
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from cases import empty, odd, odd_rows

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from oracle import connect, differences  # noqa: E402

from shelfcurve.llm import best_fit, chat, lz, tokens, url_lists
from shelfcurve.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


# chat


def plain_chat(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out.append((conv, len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss)))
    return sorted(out, key=str)


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    control = "<|im_end|><|im_start|>assistant ok"
    want = plain_chat([*rows, (-1, 0, "user", control), (-1, 1, "assistant", control)])
    assert sorted((tuple(r)[:5] for r in QUERIES["op6_chat_format"](spark, SF).collect()), key=str) == want


def test_chat_reads_back_any_text(spark, rows):
    nasty = ["", "<", "|", "<|", "<||", "<|||im_end|>", "<|im_sep|>", "<|im_end|>\n<|im_start|>", "\n", "a\\b$1", "<|n|>", "é\U0001f600", "x" * 3000]
    data = [(k % 5, k, r, t, 0.5) for k, (r, t) in enumerate((r, t) for t in nasty for r in ("user", "assistant", "assistant", "a\nb<|n|>", None))]
    data += [(None, None, "assistant", None, 1.0), (None, 1, "assistant", "x", 1.0), (None, 1, "assistant", "x", 1.0)]
    turns = rows("conv_id long, turn long, role string, text string, turns double", *data)
    made = chat.format_conversations(turns)
    from pyspark.sql import functions as F

    read = made.select("conv_id", "formatted", "loss_mask", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    got = []
    for r in read.collect():
        got.append((r.conv_id, len(r.turns), sha("".join(f"{t.role}\n{t.text}\n" for t in r.turns)), len("".join(r.loss)), sha("".join(r.loss))))
        starts = sum(a != b for a, b in zip([None, *(t.role for t in r.turns)], (t.role for t in r.turns)))
        assert r.formatted.count(chat.START) == starts == r.formatted.count(chat.END)
    assert sorted(got, key=str) == plain_chat([d[:4] for d in data])
    assert chat.format_conversations(turns.where("turn > 1000")).count() == 0


# fingerprints


def plain_phrases(data):
    known, at, ends = set(), 0, []
    for k in range(1, len(data) + 1):
        if data[at:k] not in known or k == len(data):
            known.add(data[at:k])
            ends.append(k)
            at = k
    return known, ends


def plain_fingerprint(text):
    """The smallest hashes of the phrase set, each hashed alone."""
    data = text.encode("utf-8", "surrogatepass")
    known, _ = plain_phrases(data)
    out = set()
    for p in known:
        x = sum((b + 1) * pow(lz._BASE, k, 1 << 64) for k, b in enumerate(p)) % (1 << 64)
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % (1 << 64)
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB % (1 << 64)
        out.add((x ^ (x >> 31)) >> 32)
    return sorted(out)[: lz.SIZE]


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    both = sorted({*a, *b})[: lz.SIZE]
    return sum(x in a and x in b for x in both) / len(both)


def plain_edits(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for k, (doc_id, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = map(plain_fingerprint, (text, edited, after))
        out.append((doc_id, len(text), sha(edited), "".join(f"{x:08x}" for x in a), "".join(f"{x:08x}" for x in b), plain_likeness(a, b), plain_likeness(a, c)))
    return out


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: str(r[:5])), sorted(want, key=lambda r: str(r[:5]))):
        assert tuple(g)[:5] == w[:5] and tuple(g)[5:] == pytest.approx(w[5:])


def test_fingerprint_query(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op5_lz_fingerprint"](spark, SF).collect()
    same(got, plain_edits(docs))
    assert sum(r.near_edited > r.near_next for r in got) > 0.95 * len(got)


def test_fingerprint_odd_rows(spark, rows):
    data = [r for r in odd_rows() if r[0] is not None and r[0] != 7]
    frame = spark.createDataFrame(data, odd(spark).schema).repartition(3)
    same(lz.fingerprints_with_edits(frame).collect(), plain_edits([(r[0], r[1] or "") for r in data]))
    assert lz.fingerprints_with_edits(odd(spark)).count() == len(odd_rows())
    assert lz.fingerprints_with_edits(empty(spark)).count() == 0
    alone = lz.fingerprints_with_edits(rows("doc_id long, text string", (1, "abcabc"))).collect()
    same(alone, plain_edits([(1, "abcabc")]))


def test_parse_is_the_plain_parse():
    import random

    pick = random.Random(2)
    for _ in range(500):
        data = bytes(pick.choice(b"ab" if pick.random() < 0.5 else b"abcdef") for _ in range(pick.randint(0, 60)))
        assert lz.parse(data) == plain_phrases(data)[1], data


# matrices


def whole_ids(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(tokens.default_tokenizer()).encode(text or "", add_special_tokens=False).ids, 1]


def check_matrix(got, docs, room):
    found = defaultdict(dict)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == room and r.n_tokens == r.cu_seqlens[-1] and not ids[r.n_tokens :].any()
        assert r.position_resets == r.cu_seqlens[:-1]
        positions = best_fit.position_ids(r.n_tokens, r.position_resets)
        assert [k for k, p in enumerate(positions) if p == 0] == r.position_resets
        for a, b, doc, piece in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.pieces):
            found[doc].setdefault(piece, []).append(ids[a:b].tolist())
    for doc, text in docs:
        ids = whole_ids(text)
        assert all(found[doc][k][0] == ids[a : a + room] for k, a in enumerate(range(0, len(ids), room)))
    assert len({r.sequence_id for r in got}) == len(got)
    return sum(len(p) for d in found.values() for p in d.values())


def test_matrix_is_lossless(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for room, size in [(4096, 1 << 23), (100, 20000)]:
        got = best_fit.pack_matrix(frame, tokens.default_tokenizer(), room, size).collect()
        check_matrix(got, docs, room)
        used = sum(r.n_tokens for r in got)
        assert used == sum(len(whole_ids(t)) for _, t in docs)
        if room == 4096:
            assert len(got) <= -(-used // room) + 2


def test_matrix_odd_rows(spark):
    data = [r for r in odd_rows() if r[0] not in (None, 7)]
    got = best_fit.pack_matrix(spark.createDataFrame(data, odd(spark).schema), tokens.default_tokenizer(), 64).collect()
    check_matrix(got, [(r[0], r[1]) for r in data], 64)
    assert sum(len(r.pieces) for r in best_fit.pack_matrix(odd(spark), tokens.default_tokenizer()).collect()) == sum(-(-len(whole_ids(r[1])) // 4096) for r in odd_rows())
    assert best_fit.pack_matrix(empty(spark), tokens.default_tokenizer()).count() == 0


def test_rooms_give_the_tightest():
    import random

    pick = random.Random(4)
    rooms, held = best_fit.Rooms(50), []
    for k in range(2000):
        if pick.random() < 0.55 or not held:
            room = pick.randint(0, 50)
            rooms.put(room, k)
            held.append(room)
        else:
            least = pick.randint(0, 50)
            fit = [r for r in held if r >= least]
            got = rooms.take(least)
            assert (got is None) == (not fit)
            if fit:
                assert got[1] == min(fit)
                held.remove(got[1])


# URL lists


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_url_query_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(QUERIES["op10_url_list_join"](spark, folder), connect(folder), ORACLES["op10_url_list_join"]) == []


def test_url_odd_rows(spark, rows):
    changes = rows(
        "pattern string, day long, added boolean, host string",
        ("bad.org", 10, True, ""), ("bad.org", 20, False, ""), ("bad.org", 20, True, ""), ("bad.org", 90, True, ""), ("bad.org", 95, True, ""),
        ("a.com/x", 0, True, ""), (None, 1, True, ""), ("b.com", None, True, ""), ("c.com", 5, None, ""), ("d.com", 7, False, ""), ("d.com", 3, True, ""),
    )
    captures = rows(
        "page_id long, url string, fetched_day long, found string",
        (1, "http://u:p@www.BAD.org.:80/q", 10, ""), (1, "http://u:p@www.BAD.org.:80/q", 10, ""), (2, "http://bad.org", 20, ""), (3, "https://bad.org/?a", 200, ""),
        (4, "http://a.com/x/y", 0, ""), (5, "http://a.com/xy", 9, ""), (6, None, 3, ""), (7, "bad.org", 10, ""), (8, "http://bad.org", None, ""), (None, "http://d.com", 6, ""),
        (9, "http://d.com", 7, ""), (10, "http://notbad.org", 15, ""), (11, "http://c.com", 9, ""),
    )
    got = sorted((str(r.page_id), r.n_active, r.patterns, r.blocked) for r in url_lists.filter_urls(captures, changes, 8).collect())
    none = (0, "", False)
    assert got == sorted(
        [("1", 1, "bad.org", True)] * 2
        + [("2", *none), ("3", 1, "bad.org", True), ("4", 1, "a.com/x", True), ("5", *none), ("6", *none), ("7", *none), ("8", *none),
           ("None", 1, "d.com", True), ("9", *none), ("10", *none), ("11", *none)]
    )
    assert url_lists.filter_urls(captures.where("page_id > 99"), changes).count() == 0
    assert {r.blocked for r in url_lists.filter_urls(captures, changes.where("day > 999")).collect()} == {False}
