"""Bitcoin formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed values of the protocol.
SATS_PER_BTC = 100_000_000
FIRST_SUBSIDY_SATS = 50 * SATS_PER_BTC
HALVING_BLOCKS = 210_000
HALVINGS = 64


def halving(height: Column) -> Column:
    return F.floor(height / HALVING_BLOCKS).cast("long")


def subsidy_sats(height: Column) -> Column:
    """The first subsidy, halved for each halving by a shift."""
    h, out = halving(height), F.lit(0).cast("long")
    for k in range(HALVINGS):
        if FIRST_SUBSIDY_SATS >> k:
            out = F.when(h == k, F.lit(FIRST_SUBSIDY_SATS >> k).cast("long")).otherwise(out)
    return out


def supply_sats(height: Column) -> Column:
    """All subsidies up to and with the block: over the eras, the blocks in each times its subsidy."""
    blocks = height + 1
    eras = [(k, FIRST_SUBSIDY_SATS >> k) for k in range(HALVINGS) if FIRST_SUBSIDY_SATS >> k]
    out = F.lit(0).cast("long")
    for k, subsidy in eras:
        out = out + F.greatest(F.lit(0), F.least(blocks - k * HALVING_BLOCKS, F.lit(HALVING_BLOCKS))).cast("long") * subsidy
    return out


def hashrate(difficulty: Column, seconds: Column) -> Column:
    return difficulty * F.lit(float(2**32)) / seconds


def fee_rate(fee_btc: Column, vsize: Column) -> Column:
    return fee_btc * SATS_PER_BTC / vsize


def observed_intervals(headers: DataFrame, key: str = "source_chain") -> DataFrame:
    """Seconds since the block before; of the first one, until the next."""
    order = W.partitionBy(key).orderBy("height")
    t = F.col("timestamp")
    return headers.withColumn("observed_interval_seconds", (F.coalesce(t - F.lag("timestamp").over(order), F.lead("timestamp").over(order) - t) / 1000).cast("long"))


def fee_totals(transactions: DataFrame) -> DataFrame:
    """Inputs less outputs of each block's transactions but the coinbase; a negative total fails.

    values holds each transaction's sums as JSON.
    """
    value = lambda k: F.get_json_object("values", f"$.{k}").try_cast("decimal(38,18)")
    fee = F.sum(F.when(~F.col("coinbase").cast("boolean"), value("input_value_btc_sum") - value("output_value_btc_sum")).otherwise(0))
    out = transactions.groupBy("block_height", "block_hash", "block_timestamp").agg(fee.alias("fee"))
    return out.select("block_height", "block_hash", "block_timestamp", F.when(F.col("fee") >= 0, F.col("fee").cast("double")).otherwise(F.raise_error(F.lit("negative fee total"))).alias("fee_total_btc"))


def subsidy_schedule(headers: DataFrame) -> DataFrame:
    h = F.col("height")
    return headers.select(h.alias("block_height"), "block_hash", F.col("timestamp").alias("block_timestamp"), halving(h).alias("halving_interval"), subsidy_sats(h).alias("subsidy_sats"), (subsidy_sats(h) / SATS_PER_BTC).alias("subsidy_btc"))


def circulating_supply(headers: DataFrame) -> DataFrame:
    s = supply_sats(F.col("height"))
    return headers.select(F.col("height").alias("block_height"), "block_hash", F.col("timestamp").alias("block_timestamp"), s.alias("circulating_supply_sats"), (s / SATS_PER_BTC).alias("circulating_supply_btc"))


def network_hashrate(headers: DataFrame, key: str = "source_chain") -> DataFrame:
    timed = observed_intervals(headers, key)
    i = F.col("observed_interval_seconds")
    return timed.select(F.col("height").alias("block_height"), "block_hash", F.col("timestamp").alias("block_timestamp"), "difficulty", i, F.when(i > 0, hashrate(F.col("difficulty"), i)).alias("hashrate_hs"))
