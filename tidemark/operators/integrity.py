"""Data-quality suites: violations as rows, and a guard that fails on any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.bitcoin import SATS_PER_BTC, halving, hashrate, subsidy_sats, supply_sats
from tidemark.functions.text import close_to


def violations(df: DataFrame, checks: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """One row for each failed check of a row: keys and the check's name."""
    failed = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items())), lambda x: x.isNotNull())
    return df.select(*keys, F.explode(failed).alias("violation"))


def report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row: how many rows there are and how many fail each check; a single aggregation."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in checks.items()))


def require(summary: DataFrame) -> dict:
    """The report as a dict; any failed check raises."""
    row = summary.first().asDict()
    bad = {k: v for k, v in row.items() if k != "rows" and v}
    if bad:
        raise ValueError(f"integrity checks failed: {bad}")
    return row


def neighbours(df: DataFrame, order: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """previous_<column> of the row before by order, within the keys: one partition of a stream at a time. Without keys all
    rows meet in one task, so that is for a single partition's rows only."""
    w = W.partitionBy(*keys).orderBy(order) if keys else W.partitionBy(F.lit(0)).orderBy(order)
    return df.withColumns({f"previous_{c}": F.lag(c).over(w) for c in columns})


def numbered_rows(df: DataFrame, order: str, keys: Sequence[str], name: str = "row_no") -> DataFrame:
    """Numbers from 1 within the keys, as messages about rows give them."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(order)))


def exchange_checks(df: DataFrame, exchange: str, keys: Sequence[str] = ("partition_id",), row_order: str = "row_no", copies: bool = True) -> tuple[DataFrame, dict[str, Column]]:
    """Trades with their neighbours in source order, and an exchange's checks.

    Binance ids follow each other; OKX ids rise, exact duplicates allowed if copies are; Bybit ids rise and sizes may be zero.
    """
    size = "quantity" if exchange == "binance" else "size"
    compared = ["trade_id", "price", size] + (["side"] if exchange != "binance" else [])
    df = neighbours(df, row_order, keys, compared)
    previous, first = F.col("previous_trade_id"), F.col("previous_trade_id").isNull()
    same = F.lit(True)
    for c in compared:
        same = same & F.col(c).eqNullSafe(F.col(f"previous_{c}"))
    order = {"binance": F.col("trade_id") == previous + 1, "okx": (F.col("trade_id") > previous) | same if copies else F.col("trade_id") > previous, "bybit": F.col("trade_id") > previous}[exchange]
    checks = {
        "id_sequence": first | order, "id_not_negative": F.col("trade_id") >= 0, "price_positive": F.col("price") > 0,
        "size_positive": F.col(size) >= 0 if exchange == "bybit" else F.col(size) > 0, "timestamp_positive": F.col("timestamp") > 0,
    }
    if exchange == "binance":
        checks["maker_flag"] = F.col("is_buyer_maker").isNotNull()
    else:
        checks["side"] = F.lower("side").isin("buy", "sell")
    return df, checks


def header_checks(df: DataFrame, key: str = "source_chain") -> tuple[DataFrame, dict[str, Column]]:
    df = neighbours(df, "height", [key], ["height", "block_hash", "timestamp_ms"])
    first = F.col("previous_height").isNull()
    return df, {
        "height_sequence": first | (F.col("height") == F.col("previous_height") + 1), "linked": first | (F.col("prev_hash") == F.col("previous_block_hash")),
        "hash": F.col("block_hash").rlike("^[0-9a-f]{64}$"), "difficulty_positive": F.col("difficulty").cast("double") > 0, "timestamp_positive": F.col("timestamp_ms") > 0,
    }


def transaction_checks(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    df = neighbours(df, "transaction_index", ["block_height"], ["transaction_index"]).withColumn("same_txid", F.count(F.lit(1)).over(W.partitionBy("block_height", "txid")))
    return df, {
        "index_sequence": F.col("transaction_index") == F.coalesce(F.col("previous_transaction_index") + 1, F.lit(0)), "unique_txid": F.col("same_txid") == 1,
        "coinbase_first": F.col("coinbase").cast("boolean") == (F.col("transaction_index") == 0), "values_json": F.get_json_object("values", "$").isNotNull(),
    }


def mempool_checks(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    df = df.withColumns({"same_txid": F.count(F.lit(1)).over(W.partitionBy("snapshot_at_unix_ms", "txid"))})
    return df, {"unique_txid": F.col("same_txid") == 1, "fee_rate": F.col("fee_rate_sat_vb").cast("double") >= 0, "vsize": F.col("vsize") > 0, "first_seen": F.col("first_seen_timestamp") >= 0}


def fee_checks(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    return df, {"fee_not_negative": F.col("fee_total_btc").cast("double") >= 0, "height": F.col("block_height") >= 0}


def subsidy_checks(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    h = F.col("block_height")
    return df, {
        "halving": F.col("halving_interval") == halving(h), "subsidy": F.col("subsidy_sats") == subsidy_sats(h), "btc": close_to(F.col("subsidy_btc").cast("double"), subsidy_sats(h) / SATS_PER_BTC)
    }


def hashrate_checks(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    want = hashrate(F.col("difficulty").cast("double"), F.col("observed_interval_seconds"))
    return df, {"interval": F.col("observed_interval_seconds") > 0, "formula": close_to(F.col("hashrate_hs").cast("double"), want, 1e-9)}


def supply_checks(df: DataFrame, key: str = "source_chain") -> tuple[DataFrame, dict[str, Column]]:
    df = neighbours(df, "block_height", [key], ["circulating_supply_sats"])
    want, before = supply_sats(F.col("block_height")), F.col("previous_circulating_supply_sats")
    return df, {
        "formula": F.col("circulating_supply_sats") == want, "btc": close_to(F.col("circulating_supply_btc").cast("double"), want / SATS_PER_BTC),
        "monotonic": before.isNull() | (F.col("circulating_supply_sats") >= before),
    }


def etf_checks(records: DataFrame, required: Sequence[str], allowed: Sequence[str], whole: Sequence[str] = ()) -> DataFrame:
    """By source and record: missing and unknown metric names, counts that are not whole, more than one day, times that
    are not midnight."""
    day = F.col("observed_at_utc")
    grouped = records.groupBy("source_id").agg(
        F.array_sort(F.collect_set("metric_name")).alias("names"), F.count_distinct(F.to_date(day)).alias("days"), F.count_if(day != F.date_trunc("day", day)).alias("not_midnight"),
        F.count_if(F.col("metric_name").isin(list(whole)) & (F.col("metric_value_float") != F.floor("metric_value_float"))).alias("not_whole"),
    )
    need, may = (F.array(*map(F.lit, sorted(x))) for x in (required, allowed))
    return grouped.select("source_id", F.array_except(need, "names").alias("missing"), F.array_except("names", may).alias("unknown"), (F.col("days") > 1).alias("several_days"), "not_midnight", "not_whole")


def conflicting(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys with more than one version of their other columns."""
    return df.groupBy(key).agg(F.count_distinct(F.struct(*columns)).alias("versions")).where("versions > 1")


def keep_first(df: DataFrame, keys: Sequence[str], order: str, *ties: str) -> DataFrame:
    """The whole first row of each key by the order column; of equal ones the first by ties, such as a row's file and its
    place there. Without ties any of them may be kept."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(order, *ties)).alias("r__")).select("r__.*")


def schema_differences(df: DataFrame, wanted: dict[str, str]) -> list[str]:
    """How a stored table differs from its contract; none if names and types agree."""
    have = dict(df.dtypes)
    return [f"{c}: {have.get(c, 'missing')} instead of {t}" for c, t in wanted.items() if have.get(c) != t] + [f"{c}: not in the contract" for c in have if c not in wanted]
