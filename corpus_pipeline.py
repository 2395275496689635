"""The corpus pipeline: quality rules, quality classifier, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept
and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. Models are trained
from `sf_dir`: its whole `documents` are the web text that the labels belong to,
whatever earlier stages have dropped.

Null and empty texts fail the rules (fewer than 20 words); an empty table passes
through as an empty table; without labelled rows a model keeps what it is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logtide.llm import ngram_join, packing, pu_quality, quality_rules
from logtide.llm.common import fold, table, written
from logtide.llm.queries import tokenizer_path


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the calibrated n-gram classifier."""
    model = quality_rules.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.keep_quality(docs, model)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier calls good."""
    model = pu_quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                             fold("doc_id", 4) != 2)
    return pu_quality.keep_predicted(docs, model)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return ngram_join.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), limit=2048, end_id=0)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("ngram_join", near_duplicates_stage),
    ("best_fit_packing", packing_stage),
]

# The two classifiers are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
