"""The corpus pipeline: five stages over ``documents``, each written as Parquet
to the shared folder and read again as the next one's input.

Each stage but the last returns the columns of ``documents``. ``ORACLE_SQL`` is
None: language identification is a trained model, which SQL can't express. The
operators have their own tests in ``tests/llm``; of the stages, columns and row
counts are tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelake.llm.common import stage
from farelake.llm.op02_minhash import stage_near_dedup
from farelake.llm.op03_language import stage_language
from farelake.llm.op04_mixing import stage_mixing
from farelake.llm.op07_decontaminate import stage_decontaminate
from farelake.llm.op10_tokens import stage_tokens


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stage_language(spark, docs, sf_dir)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stage_near_dedup(spark, docs, sf_dir)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stage_decontaminate(spark, docs, sf_dir)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stage_mixing(spark, docs, sf_dir)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stage_tokens(spark, docs, sf_dir)


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mixing", mixing), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
