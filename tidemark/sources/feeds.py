"""Fetched sources: economic series, blocks, rights. Fetching is a client object's; here JSON becomes rows.

No fetcher is bundled: a client is any object with the named methods, so tests and deployments bring their own.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import metric_id
from tidemark.functions.text import missing_dot


def series_observations(bundles: DataFrame) -> DataFrame:
    """Long metric rows of raw series bundles (series_id, unit, last_updated, observations as a JSON list)."""
    o = F.explode(F.from_json("observations", "array<struct<realtime_start:string,realtime_end:string,date:string,value:string>>")).alias("o")
    rows = bundles.select("series_id", "unit", "last_updated", o)
    source = F.concat(F.lit("fred_"), F.lower("series_id"))
    return rows.select(
        metric_id(source, F.col("series_id"), F.col("o.date"), F.col("o.realtime_start"), F.col("o.realtime_end"), F.col("o.value")).alias("metric_id"), source.alias("source_id"),
        F.col("series_id").alias("metric_name"), F.col("unit").alias("metric_unit"), missing_dot(F.col("o.value")).alias("metric_value_float"), F.to_timestamp("o.date").alias("observed_at_utc"),
        F.to_json(F.struct(F.col("last_updated").alias("last_updated_utc"))).alias("provenance_json"),
    )


def vintages(wide: DataFrame) -> DataFrame:
    """Rows of observations by vintage, whose columns are SERIES_YYYYMMDD, as (series_id, vintage, date, value)."""
    cells = F.explode(F.from_json("row", "map<string,string>")).alias("column", "value")
    long = wide.select(F.get_json_object("row", "$.date").alias("date"), cells).where("column <> 'date'")
    return long.select(
        F.regexp_extract("column", r"^(.*)_(\d{8})$", 1).alias("series_id"), F.to_date(F.regexp_extract("column", r"_(\d{8})$", 1), "yyyyMMdd").alias("vintage"), F.to_date("date").alias("date"), missing_dot(F.col("value")).alias("value")
    )


def fetch_in_halves(fetch: Callable[[list], list], ids: list) -> list:
    """All results of a fetch that may refuse a long list: halves are tried until one id is refused alone."""
    try:
        return fetch(ids)
    except ValueError:
        if len(ids) < 2:
            raise
        mid = len(ids) // 2
        return fetch_in_halves(fetch, ids[:mid]) + fetch_in_halves(fetch, ids[mid:])


def incremental_range(cursor: date | None, first: date, last: date, as_of: date) -> tuple[date, date] | None:
    """The days to ask for: after the cursor, up to the series' end or the reference day; None when there is nothing new."""
    start = first if cursor is None else cursor + timedelta(days=1)
    end = min(last, as_of)
    return None if start > end else (start, end)


def blocks(spark: SparkSession, client, first: int, last: int, verbosity: int = 2) -> DataFrame:
    """Block documents of a height range, through client.getblockhash and client.getblock, as (height, block JSON)."""
    if not 0 <= first <= last <= client.getblockcount():
        raise ValueError(f"heights {first} to {last} are not all there")
    rows = [(h, json.dumps(client.getblock(client.getblockhash(h), verbosity), sort_keys=True)) for h in range(first, last + 1)]
    return spark.createDataFrame(rows, "height long, block string")


def headers_of(raw: DataFrame, chain: str = "main") -> DataFrame:
    b = F.from_json("block", "hash string, previousblockhash string, merkleroot string, version long, nonce long, difficulty string, time long")
    return raw.select("height", b.alias("b")).select(
        "height", F.col("b.hash").alias("block_hash"), F.coalesce("b.previousblockhash", F.lit("0" * 64)).alias("prev_hash"), F.col("b.merkleroot").alias("merkle_root"), "b.version", "b.nonce",
        "b.difficulty", (F.col("b.time") * 1000).alias("timestamp_ms"), F.lit(chain).alias("source_chain"),
    )


def transactions_of(raw: DataFrame, chain: str = "main") -> DataFrame:
    """Transactions of blocks with their inputs, outputs, scripts and witness as JSON, and the sums of both sides."""
    vin = "array<struct<coinbase:string,txid:string,vout:long,prevout:struct<value:string>,scriptSig:struct<hex:string>,txinwitness:array<string>>>"
    vout = "array<struct<n:long,value:string,scriptPubKey:struct<hex:string,type:string>>>"
    b = F.from_json("block", f"hash string, time long, tx array<struct<txid:string,vin:{vin},vout:{vout}>>")
    tx = raw.select("height", b.alias("b")).select("height", "b.hash", "b.time", F.posexplode("b.tx").alias("transaction_index", "t"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("decimal(38,8)"), lambda a, x: (a + F.coalesce(x.try_cast("decimal(28,8)"), F.lit(0))).cast("decimal(38,8)"))
    ins, outs = F.transform("t.vin", lambda x: x["prevout"]["value"]), F.transform("t.vout", lambda x: x["value"])
    return tx.select(
        F.col("height").alias("block_height"), F.col("hash").alias("block_hash"), (F.col("time") * 1000).alias("block_timestamp_ms"), F.col("transaction_index").cast("long").alias("transaction_index"), F.col("t.txid").alias("txid"),
        F.to_json(F.transform("t.vin", lambda x: F.struct(x["txid"].alias("txid"), x["vout"].alias("vout")))).alias("inputs"), F.to_json(F.transform("t.vout", lambda x: F.struct(x["n"].alias("n"), x["value"].alias("value")))).alias("outputs"),
        F.to_json(F.struct(total(ins).cast("string").alias("input_value_btc_sum"), total(outs).cast("string").alias("output_value_btc_sum"))).alias("values"),
        F.to_json(F.transform("t.vout", lambda x: x["scriptPubKey"])).alias("scripts"), F.to_json(F.transform("t.vin", lambda x: x["txinwitness"])).alias("witness_data"),
        F.exists("t.vin", lambda x: x["coinbase"].isNotNull()).alias("coinbase"), F.lit(chain).alias("source_chain"),
    )


def mempool_of(snapshot: DataFrame, chain: str = "main") -> DataFrame:
    """Rows of mempool snapshots (snapshot_at_unix_ms, mempool as a JSON object by txid)."""
    entry = "struct<vsize:long,time:long,fees:struct<base:string>,`bip125-replaceable`:boolean>"
    m = snapshot.select("snapshot_at_unix_ms", F.explode(F.from_json("mempool", f"map<string,{entry}>")).alias("txid", "m"))
    fee = F.col("m.fees.base").try_cast("decimal(28,8)") * 100_000_000 / F.col("m.vsize")
    return m.select("snapshot_at_unix_ms", "txid", fee.cast("double").alias("fee_rate_sat_vb"), "m.vsize", F.col("m.time").alias("first_seen_timestamp"), F.col("m.bip125-replaceable").alias("rbf_flag"), F.lit(chain).alias("source_chain"))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """A JSON registry of series; ids must be there and differ."""
    df = spark.read.option("multiLine", True).json(path)
    rows = df.select(F.explode("series").alias("s")).select("s.*") if "series" in df.columns else df
    bad = rows.groupBy("series_id").count().where("series_id is null or count > 1").count()
    if bad:
        raise ValueError("series registry has missing or repeated ids")
    return rows


class RateGate:
    """At least so many seconds between requests of a source, whichever thread makes them."""

    def __init__(self, seconds: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.seconds, self.clock, self.sleep, self.lock, self.next = seconds, clock, sleep, threading.Lock(), 0.0

    def wait(self) -> None:
        with self.lock:
            now = self.clock()
            if now < self.next:
                self.sleep(self.next - now)
                now = self.next
            self.next = now + self.seconds


def pages_of(fetch: Callable[[int], list], size: int) -> Iterator:
    at = 0
    while rows := fetch(at):
        yield from rows
        if len(rows) < size:
            return
        at += size
