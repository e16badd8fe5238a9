"""Price bars from trades and from one-second buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.filters import apply_fields, apply_filters
from tidemark.operators.native import maker_flag
from tidemark.plans.windows import LatestRows, RandomRows, TimeRange, Window, in_range, seeded

BAR_COLUMNS = (
    "datetime", "open", "high", "low", "close", "mean", "std", "median", "iqr", "volume", "maker_ratio", "no_of_trades", "open_liquidity", "high_liquidity",
    "low_liquidity", "close_liquidity", "liquidity_sum", "maker_volume", "maker_liquidity",
)


def bucket(time: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket of so many seconds."""
    return F.timestamp_seconds(seconds * F.floor(F.unix_seconds(time.cast("timestamp")) / seconds))


def element_quantiles(rows: DataFrame, key: str, value: str, levels: Mapping[str, float]) -> DataFrame:
    """By key, the exact quantiles that pick an element: the one at floor(level * n) of the sorted values, the last at
    most; no interpolation. Equal values are counted before they are dealt out, and positions are their counts' sums."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(key, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(W.partitionBy(key).orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    placed = counted.withColumns({"upto": upto, "n": F.sum("c").over(W.partitionBy(key))})
    at = lambda level: F.least(F.floor(F.lit(level) * F.col("n")), F.col("n") - 1)
    return placed.groupBy(key).agg(*(F.min(F.when(F.col("upto") > at(level), F.col("v"))).alias(name) for name, level in levels.items()))


def windowed_bars(bars: DataFrame, window: Window) -> DataFrame:
    """Row windows of bars count bars; the result rises by time."""
    if isinstance(window, LatestRows):
        bars = bars.orderBy(F.desc("datetime")).limit(window.rows)
    elif isinstance(window, RandomRows):
        bars = bars.withColumn("seed__", F.unix_millis("datetime")).orderBy(seeded("seed__"), "datetime").limit(window.rows).drop("seed__")
    return bars.orderBy("datetime")


def native_bars(trades: DataFrame, window: Window, seconds: int = 1, quantity: str = "quantity", maker: Column | None = None, id_column: str = "trade_id", fields: Sequence[str] | None = None, filters: Sequence[Mapping[str, Any]] | None = None) -> DataFrame:
    """BAR_COLUMNS of each bucket. One shuffle, by bucket; sums are exact decimals, so their order does not matter.

    The median and the quartiles come from counts of the bucket's different prices, so no task holds a bucket's trades.
    """
    if seconds <= 0:
        raise ValueError(f"kline_size must be > 0, got {seconds}")
    maker = F.col("is_buyer_maker") if maker is None else maker
    time_limited = in_range(trades, "datetime", window) if isinstance(window, TimeRange) else trades
    rows = time_limited.select(bucket(F.col("datetime"), seconds).alias("bucket"), F.col(id_column).alias("id"), F.col("price").cast("double").alias("p"), F.col(quantity).cast("double").alias("q"), maker.cast("double").alias("m"))
    value = F.col("p") * F.col("q")
    exact = lambda c: F.sum(c.cast("decimal(38,12)")).cast("double")
    tenths = lambda c: F.round(F.sum(c.cast("decimal(38,9)")), 1).cast("double")  # noqa: E731  rounded while exact
    grouped = rows.groupBy(F.col("bucket").alias("datetime")).agg(
        F.min_by("p", "id").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "id").alias("close"),
        F.round(F.try_divide(F.sum(F.col("p").cast("decimal(28,10)")), F.count(F.lit(1))), 5).cast("double").alias("mean"), F.round(F.stddev_pop("p"), 6).alias("std"),
        F.round(exact(F.col("q")), 9).alias("volume"), F.avg("m").alias("maker_ratio"), F.count(F.lit(1)).alias("no_of_trades"),
        F.min_by(value, "id").alias("open_liquidity"), F.max(value).alias("high_liquidity"), F.min(value).alias("low_liquidity"), F.max_by(value, "id").alias("close_liquidity"),
        tenths(value).alias("liquidity_sum"), exact(F.col("m") * F.col("q")).alias("maker_volume"), tenths(F.col("m") * value).alias("maker_liquidity"),
    )
    if set(fields or BAR_COLUMNS) & {"median", "iqr"} or any(f.get("field") in ("median", "iqr") for f in filters or ()):
        grouped = grouped.join(element_quantiles(rows, "bucket", "p", {"median": 0.5, "q1__": 0.25, "q3__": 0.75}).withColumnRenamed("bucket", "datetime"), "datetime")
        grouped = grouped.withColumn("iqr", F.col("q3__") - F.col("q1__"))
    bars = grouped.select(*(c for c in BAR_COLUMNS if c in grouped.columns))
    return apply_fields(apply_filters(windowed_bars(bars, window), filters), fields)


def side_maker() -> Column:
    """The maker expression of exchanges that report a side."""
    return maker_flag(F.col("side"))


def aligned_bars(seconds_ohlc: DataFrame, seconds: int = 1, fields: Sequence[str] | None = None, filters: Sequence[Mapping[str, Any]] | None = None) -> DataFrame:
    """Bars of eight columns from one-second OHLC rows that a window has already limited."""
    if seconds <= 0:
        raise ValueError(f"kline_size must be > 0, got {seconds}")
    bars = (
        seconds_ohlc.groupBy(bucket(F.col("aligned_at_utc"), seconds).alias("datetime"))
        .agg(
            F.min_by("open_price", "aligned_at_utc").alias("open"), F.max("high_price").alias("high"), F.min("low_price").alias("low"), F.max_by("close_price", "aligned_at_utc").alias("close"),
            F.round(F.sum("quantity_sum"), 9).alias("volume"), F.sum("trade_count").alias("no_of_trades"), F.round(F.sum("quote_volume_sum"), 1).alias("liquidity_sum"),
        )
        .orderBy("datetime")
    )
    return apply_fields(apply_filters(bars, filters), fields)


BAR_TYPES = ("base", "trade", "volume", "liquidity")


def data_bars(df: DataFrame, bar_type: str = "base", **params: Any) -> DataFrame:
    """Base bars are the data itself; the threshold kinds are named but not available."""
    if bar_type not in BAR_TYPES:
        raise ValueError(f"Unknown bar_type: {bar_type}. Must be one of {list(BAR_TYPES)}")
    if bar_type == "base":
        return df
    size = params.get(f"{bar_type}_threshold")
    if not isinstance(size, int | float) or isinstance(size, bool) or size <= 0:
        raise ValueError(f"{bar_type}_threshold must be a positive number for bar_type={bar_type}")
    raise NotImplementedError(f"bar_type={bar_type} is not available")
