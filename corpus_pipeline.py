"""Documents to packed training sequences, one stage at a time, each stage written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickloom.cluster import shared_dir
from tickloom.llm import decontam, neardup, packing, secret_scan, toxicity


#: Near-duplicates of the corpus share this many hundredths of their shingles; op10's own contract says 85.
NEAR_PERCENT = 80


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest id."""
    return neardup.without_near_duplicates(docs, percent=NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more stands in benchmark windows go."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; no document goes."""
    return secret_scan.without_secrets(docs)


def packing_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    return packing.packed(docs)


STAGES = [("toxicity", toxic), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("secret_scan", secrets), ("packing", packing_)]

#: Trained models and minwise trees are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
