"""Corpus pipeline: toxicity, exact dedup, near-duplicate dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; what it
returns is written as Parquet in the shared scratch folder and read again as the next stage's
``docs``.  All stages but the last return the columns of ``documents``; the last returns the
packed pieces.  Labels and benchmark items come from ``sf_dir``.

Defined cases (each stage's operator states its own): rows with a null or empty text and with null or
repeated ids pass every stage that has no reason to drop them, an empty table gives empty results, and
further columns travel along to the last stage, clashing names included; texts are read whole.

No SQL twin: a trained classifier and a packing heuristic have none.  The tests hold each stage
against a brute-force version on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from autopulse.llm import decontam, exact_dedup, near_dup, packing, toxicity
from autopulse.llm.common import materialise, read


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labelled ones among them, does not reject."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
