"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import chat, decontam, langid, lm, packing, pii, quality, secrets, sharding, simhash
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), path="source")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_held_out(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_held_out(table(spark, sf_dir, "documents"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    ops = (op1_pii, op2_secrets, op3_langid, op4_packing, op5_quality, op6_chat, op7_simhash, op8_sharding, op9_lm, op10_decontam)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    out = {"op6_chat": chat.ORACLE_SQL}
    return out | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
