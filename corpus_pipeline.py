"""A training-data pipeline over ``documents``: five stages, each one operator of shelfcurve.llm.

A stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. Its result is
written as Parquet in the shared folder and read back as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcurve.llm import ppm, secrets, simhash, slack, tokens, wu_manber
from shelfcurve.llm.common import table
from shelfcurve.session import discard, store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told go on; those without a letter, null and empty ones too, go.
    The model learns from a bounded sample of the labelled documents. Repeated rows are judged alike;
    the columns of documents go on, others do not. No rows give none."""
    docs = docs.select(*COLUMNS)
    return ppm.keep_identified(docs, ppm.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest doc_id goes on, null being the greatest;
    of rows with that doc_id the one whose text has the least hash. Texts without words are one group.
    Other columns go on with their row."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten words of a benchmark item go. A null or wordless text holds
    none and goes on; repeated rows are judged alike; all columns go on."""
    return wu_manber.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Values that look like live credentials of few owners are replaced; every row and column goes on,
    a null text as null. Repeated rows are treated alike."""
    return secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows and their places in sequences of 4096 tokens. A null or empty text is one
    piece of one token; repeated rows are packed each; other columns do not go on."""
    return slack.pack_documents(docs, tokens.default_tokenizer())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# SQL has neither the code lengths, nor the hash, nor the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage writes on its way is removed with its end, its result once the
    next stage has read it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        done = store(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        docs = before = done
    return docs
