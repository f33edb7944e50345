"""The Merkle manifest against plain lists."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute_merkle import manifest
from cases import empty, odd

from shelfcurve.llm import merkle
from shelfcurve.llm.queries import QUERIES

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(df):
    got = sorted(map(tuple, merkle.manifest(df).select(*COLUMNS).collect()), key=str)
    assert got == manifest([r.asDict() for r in df.collect()])
    return got


def test_query_equals_plain_lists(spark, sf_dir):
    got = sorted(map(tuple, QUERIES["op11_merkle_manifest"](spark, sf_dir).select(*COLUMNS).collect()), key=str)
    assert got == manifest([r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


def test_odd_rows(spark):
    assert len(check(odd(spark))) == odd(spark).count()


def test_empty(spark):
    df = merkle.manifest(empty(spark))
    assert df.columns == COLUMNS and df.count() == 0


@pytest.mark.parametrize("n", [1, 16, 17, 257])
def test_sizes_at_the_edges(spark, n):
    check(spark.range(n).selectExpr("id AS doc_id", "'A' AS text", "'x' AS lang", "'s' AS source", "1 AS n_chars"))


def test_hot_source_many_sources_sparse_and_repeated_ids(spark):
    """Most rows in one source, 400 others, negative and far apart ids, equal rows, ids with two texts."""
    df = spark.range(20_000).select(
        (F.col("id") * F.expr("if(id % 3 = 0, 1, 97700123)") - 5000).alias("doc_id"),
        F.concat(F.lit("T"), F.col("id") % 7).alias("text"),
        F.lit(None).cast("string").alias("lang"),
        F.expr("if(id % 3 > 0, 'hot', concat('s', id % 400))").alias("source"),
        F.lit(3).alias("n_chars"),
    )
    some = df.where("abs(doc_id) % 41 = 0")
    check(df.unionByName(some).unionByName(some).unionByName(some.withColumn("text", F.lit("X"))))
