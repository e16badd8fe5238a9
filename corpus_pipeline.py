"""The corpus pipeline: language, near duplicates, benchmark passages, personal data, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.cluster import remove
from tidemark.llm import decontam, langid, packing, pii, simhash
from tidemark.llm.common import checkpoint_folder, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the rejected go."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in their texts."""
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of tokens."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: SQL can express neither compression nor the models; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again by the next. What a stage
    wrote is deleted when the next has written its own; the last one's stays, as the result is read from it."""
    docs, folder = table(spark, sf_dir, "documents"), f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return docs
