"""Every stage of the pipeline against a brute-force version, on real, odd, repeated and no rows."""

import sys
from collections import defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cases import empty, odd
from test_duplicates_packing import check_packing, one_of_each, whole_ids
from test_text_operators import plain_contamination

import corpus_pipeline
from shelfcurve.llm import secrets

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def pairs(rows):
    return sorted(((str(d), t) for d, t in rows), key=str)


def identified(rows):
    return [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]


def clean(rows, items):
    return [(d, t) for d, t in rows if not plain_contamination([(d, t)], items)[0][5]]


def redacted(rows):
    """Rows (doc_id, text, source): values of few owners and repositories are replaced."""
    owners, holders, found = defaultdict(set), defaultdict(set), []
    for d, t, s in rows:
        base = secrets.base_spans(t or "")
        spans = [*base, *secrets.token_spans(t or "", base)]
        found.append(spans)
        for *_, value in spans:
            owners[value].add(s)
            holders[value].add(d)
    out = []
    for (d, t, _), spans in zip(rows, found):
        marks = set()
        for _, end, _, value in spans:
            if len(owners[value]) <= secrets.MAX_OWNERS and len(holders[value]) <= secrets.MAX_REPOSITORIES:
                marks.add((end - len(value), end))
        # a letter that stands for a hole: overlapping ones are one
        cut, last = [], 0
        for a, b in sorted(marks):
            if a >= last:
                cut.append([a, b])
            else:
                cut[-1][1] = max(cut[-1][1], b)
            last = max(last, b)
        for a, b in reversed(cut):
            t = t[:a] + "<secret>" + t[b:]
        out.append((d, t))
    return out


@pytest.fixture(scope="module")
def items(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]


@pytest.fixture(scope="module")
def inputs(spark):
    """Real rows, some of them twice, one id with two texts, odd rows; with columns that stages might use themselves."""
    real = spark.read.parquet(f"{SF}/documents.parquet")
    known = real.columns
    mixed = real.unionByName(real.where("doc_id < 20")).unionByName(odd(spark).select(known))
    return mixed.selectExpr("*", "1 AS helper", "2 AS row", "'x' AS _kept", "3 AS hash").repartition(4)


def run(spark, name, docs):
    return STAGES[name](spark, docs, SF)


def read(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_language_stage(spark, inputs):
    assert pairs(read(run(spark, "language_id", inputs))) == pairs(identified(read(inputs)))


def test_duplicates_stage(spark, inputs):
    got = run(spark, "near_duplicates", inputs)
    assert got.columns == inputs.columns
    assert pairs(read(got)) == one_of_each(read(inputs))


def test_decontamination_stage(spark, inputs, items):
    got = run(spark, "decontamination", inputs)
    assert got.columns == inputs.columns
    assert pairs(read(got)) == pairs(clean(read(inputs), items))


def test_secret_stage(spark, inputs):
    got = run(spark, "secret_scan", inputs)
    assert got.columns == inputs.columns
    assert pairs(read(got)) == pairs(redacted([(r.doc_id, r.text, r.source) for r in inputs.collect()]))
    assert all(r.n_chars == len(r.text) for r in got.collect() if r.text and "<secret>" in r.text)


def test_packing_stage(spark, inputs):
    rows = read(inputs)
    ids = whole_ids([t for _, t in rows])
    check_packing(run(spark, "packing", inputs).collect(), list(zip([d for d, _ in rows], ids)), 4096)


def test_stages_without_rows(spark):
    for name in STAGES:
        assert run(spark, name, empty(spark)).count() == 0


def test_whole_run(spark, items):
    """The stages one after the other, each on all that the one before it kept."""
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    source = {d: s for d, _, s in docs}
    one = [(int(d), t) for d, t in one_of_each(identified([(d, t) for d, t, _ in docs]))]
    rows = redacted([(d, t, source[d]) for d, t in clean(one, items)])
    packed = corpus_pipeline.run(spark, SF).collect()
    check_packing(packed, list(zip([d for d, _ in rows], whole_ids([t for _, t in rows]))), 4096)
    assert {r.doc_id for r in packed} == {d for d, _ in rows}


def test_stage_names():
    assert list(STAGES) == ["language_id", "near_duplicates", "decontamination", "secret_scan", "packing"]
