"""Exact splits and contiguous slices."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.cluster import checkpointed


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "n__") -> DataFrame:
    """Rows numbered from 0 in a total order without one task for all: a range shuffle, local numbers, and each
    partition's offset from the partitions' counts."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("i__", F.monotonically_increasing_id())
    held = parts.withColumns({"p__": F.shiftright("i__", 33), "k__": F.col("i__").bitwiseAND((1 << 33) - 1)}).drop("i__")
    held = checkpointed(held)  # later passes must see the same numbers, also after a lost executor
    counts = held.groupBy("p__").agg(F.count(F.lit(1)).alias("c__"))
    begins = counts.select("p__", F.coalesce(F.sum("c__").over(W.partitionBy(F.lit(0)).orderBy("p__").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("b__"))
    return held.join(begins, "p__").withColumn(name, F.col("b__") + F.col("k__")).drop("p__", "k__", "b__")


def bounds(rows: int, ratios: Sequence[float]) -> list[int]:
    """Where each part ends; the last takes what is left."""
    if not ratios or any(r <= 0 for r in ratios):
        raise ValueError("ratios must be positive")
    total, ends, so_far = sum(ratios), [], 0
    for r in ratios[:-1]:
        so_far += int(rows * r / total)
        ends.append(so_far)
    return [*ends, rows]


def _cut(placed: DataFrame, ratios: Sequence[float]) -> list[DataFrame]:
    ends = bounds(placed.count(), ratios)
    return [placed.where((F.col("n__") >= a) & (F.col("n__") < b)).drop("n__") for a, b in zip([0, *ends], ends)]


def split_sequential(df: DataFrame, ratios: Sequence[float], order: Sequence[Column | str]) -> list[DataFrame]:
    return _cut(numbered(df, order), ratios)


def split_random(df: DataFrame, ratios: Sequence[float], seed: int, keys: Sequence[str]) -> list[DataFrame]:
    """Parts of exact sizes in an order that the seed and the keys decide."""
    return _cut(numbered(df, [F.xxhash64(F.lit(seed), *keys), *keys]), ratios)


def train_val_test(parts: Sequence[DataFrame], target: str, time: str = "datetime") -> dict[str, DataFrame]:
    """x and y of each part: y is the target, x the rest without the time."""
    out = {}
    for name, part in zip(("train", "val", "test"), parts):
        out |= {f"x_{name}": part.drop(target, time), f"y_{name}": part.select(target)}
    return out


def missing_times(every: DataFrame, parts: Sequence[DataFrame], time: str = "datetime") -> DataFrame:
    kept = parts[0].select(time)
    for p in parts[1:]:
        kept = kept.unionByName(p.select(time))
    return every.select(time).join(kept.distinct(), time, "left_anti")


def random_slice(df: DataFrame, rows: int, order: Sequence[Column | str], low: float = 0.0, high: float = 1.0, seed: int | None = None) -> DataFrame:
    """So many consecutive rows, from a start between the shares low and high of the table."""
    if rows <= 0 or not 0 <= low < high <= 1:
        raise ValueError("rows must be positive and 0 <= low < high <= 1")
    placed = numbered(df, order)
    n = placed.count()
    first, last = int(n * low), int(n * high)
    if last - first < rows:
        raise ValueError(f"{rows} rows do not fit between {first} and {last}")
    start = int(np.random.default_rng(seed).integers(first, last - rows + 1))
    return placed.where((F.col("n__") >= start) & (F.col("n__") < start + rows)).orderBy("n__").drop("n__")
