"""Corpus pipeline: toxicity, line dedup, near duplicates, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All
but the last return the columns of docs, whatever further columns there are; the last
returns what op6_sentencepiece does.

A null text stays null, counts as empty, links with nothing and has the end id only. Rows
that agree in doc_id and text are one document and go or stay together; a null doc_id is
kept like any other. Of equal lines and of linked documents the one with the smallest
doc_id stays. Empty tables of documents, labels or benchmark give no rows, no lexicon and
no hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm.bpe import encode_documents, model_path
from gazetta.llm.common import cut, table
from gazetta.llm.decontaminate import keep_clean
from gazetta.llm.jaccard import keep_one
from gazetta.llm.linededup import dedup_lines
from gazetta.llm.toxicity import keep_civil


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    return keep_civil(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats go; every document stays, and n_chars follows its text."""
    out = dedup_lines(docs).select(*[f"`{c}`" for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    return encode_documents(docs, model_path()).toDF("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The learned toxicity score has no SQL form; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each from a reliable copy of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
