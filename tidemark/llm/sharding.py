"""Stable shards by jump consistent hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.cluster import ship
from tidemark.llm.common import checkpointed

SHARDS = 8


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of unsigned 64-bit keys into 0 .. shards - 1, without a ring table. Growing from n to n + 1
    shards moves a share of 1 / (n + 1) of the keys, all into the new shard."""
    key = keys.astype(np.uint64).copy()
    at = np.zeros(len(key), np.int64)
    ahead = np.zeros(len(key), np.int64)
    open_ = np.ones(len(key), bool)
    while open_.any():
        at[open_] = ahead[open_]
        with np.errstate(over="ignore"):
            key[open_] = key[open_] * np.uint64(2862933555777941757) + np.uint64(1)
        ahead[open_] = ((at[open_] + 1) * (float(1 << 31) / ((key[open_] >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
        open_ &= ahead < shards
    return at.astype(np.int32)


def jump_column(key: Column, shards: int) -> Column:
    @F.pandas_udf("int")
    def run(k: pd.Series) -> pd.Series:
        return pd.Series(jump(k.to_numpy().astype(np.int64).view(np.uint64), shards))

    return run(key)


def assign(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row.

    The shard depends on the key and the number of shards only (law `key`); a null key counts as 0, a key that is no
    integer by its 64-bit hash. grown_shard is the one with a shard more. Slots count each shard's rows from 0 without
    gaps: every partition counts its own rows, and the partitions' counts, summed by a window over (shard, partition),
    say where each begins, so no shard is ever gathered into a task. Repeated rows get slots of their own.
    """
    ship(docs.sparkSession)
    whole = docs.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    k = F.coalesce(F.col(key).cast("long") if whole else F.xxhash64(key), F.lit(0).cast("long"))
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    small = docs.select("doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), k.alias("k"))
    placed = small.select("doc_id", "size", "text_crc32", jump_column(F.col("k"), shards).alias("shard"), jump_column(F.col("k"), shards + 1).alias("grown_shard"))

    def counted(frames):
        seen, part = np.zeros(shards, np.int64), TaskContext.get().partitionId()
        for f in frames:
            f["local"] = f.groupby("shard").cumcount().to_numpy() + seen[f["shard"].to_numpy()]
            seen += np.bincount(f["shard"], minlength=shards)
            f["part"] = part
            yield f

    kind = docs.schema["doc_id"].dataType.simpleString()
    fixed = checkpointed(placed.mapInPandas(counted, f"doc_id {kind}, size long, text_crc32 long, shard int, grown_shard int, local long, part int"))
    counts = fixed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return fixed.join(begins, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("begin") + F.col("local")).cast("long").alias("slot"), "grown_shard"
    )
