"""A corpus pipeline of five stages over `documents`, each written as Parquet and read again.

Quality rules drop documents; near-duplicates leave one document of each
class; secrets are redacted in place; the mix repeats or leaves out documents
to meet its sources' targets, in training order; the last stage packs what is
left into bins. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm.common import materialize
from quillspark.llm.op01_packing import pack
from quillspark.llm.op04_quality import keep_quality
from quillspark.llm.op05_secrets import redact_secrets
from quillspark.llm.op06_neardup import drop_near_duplicates
from quillspark.llm.op07_mixing import mix_rows


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]

#: Near-duplicate classes and sequential packing are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
