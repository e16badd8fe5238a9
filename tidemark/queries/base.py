"""Registered queries over the driver's tables, and the same in SQL for DuckDB.

`events` stands for a trade stream, `lineitem` for an exchange that reports a side, events by day and type for daily
metrics, `orders` for revisioned state and partitions.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import Dataset
from tidemark.functions import bitcoin, identity, text
from tidemark.operators import aligned, bars, eventlog, filters, integrity, native, proofs, serving, splits
from tidemark.plans import windows
from tidemark.plans.windows import AllRows, LatestRows, Month, RandomRows, TimeRange
from tidemark.sources import artifacts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain_times(f(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return add


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as times without a zone, as DuckDB's."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- stand-ins --------------------------------------------------------------------------------------------------------

TRADES = Dataset(
    "events_trades", "events", "events", "trade_id", "datetime", "timestamp",
    "trade_id long, timestamp long, price double, quantity double, quote_quantity double, is_buyer_maker byte, is_best_match byte, datetime timestamp",
    ("trade_id", "timestamp", "price", "quantity", "is_buyer_maker"), "exchange", "daily", "numeric", 0, "test",
)

TRADES_SQL = """trades as (
  select event_id as trade_id, epoch_us(ts) // 1000 as timestamp, value as price, cast(json_extract_string(props, '$.k') as double) as quantity,
         cast(value as decimal(18, 2)) * cast(json_extract_string(props, '$.k') as decimal(18, 0)) as quote, user_id % 2 as is_buyer_maker, ts as datetime
  from events)"""


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    at, k = F.col("ts").cast("timestamp"), F.get_json_object("props", "$.k")
    quote = F.col("value").cast("decimal(18,2)") * k.cast("decimal(18,0)")
    return e.select(
        F.col("event_id").alias("trade_id"), F.unix_millis(at).alias("timestamp"), F.col("value").alias("price"), k.cast("double").alias("quantity"), quote.cast("double").alias("quote_quantity"),
        (F.col("user_id") % 2).cast("byte").alias("is_buyer_maker"), F.lit(1).cast("byte").alias("is_best_match"), at.alias("datetime"),
    )


SIDED_SQL = """sided as (
  select l_orderkey * 8 + l_linenumber as trade_id, l_extendedprice as price, l_quantity as size, case when l_returnflag = 'R' then 'Sell' else 'buy' end as side, l_shipdate as datetime from lineitem)"""


def sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    at = F.col("l_shipdate").cast("timestamp")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("trade_id"), F.unix_millis(at).alias("timestamp"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("size"),
        F.when(F.col("l_returnflag") == "R", "Sell").otherwise("buy").alias("side"), at.alias("datetime"),
    )


LOG_SQL = """log as (
  select 'events' as source_id, event_type as stream_id, strftime(ts, '%Y-%m-%d') as partition_id, cast(event_id as varchar) as source_offset, ts as source_event_time, ts + interval 1 hour as ingested_at,
         '{"price":"' || cast(cast(value as decimal(18, 2)) as varchar) || '","qty":"' || json_extract_string(props, '$.k') || '"}' as payload_json from events)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    payload = F.to_json(F.struct(F.col("value").cast("decimal(18,2)").cast("string").alias("price"), F.get_json_object("props", "$.k").alias("qty")))
    rows = e.select(
        F.lit("events").alias("source_id"), F.col("event_type").alias("stream_id"), F.date_format("ts", "yyyy-MM-dd").alias("partition_id"), F.col("event_id").cast("string").alias("source_offset"),
        at.alias("source_event_time"), payload.alias("payload_json"), (at + F.expr("interval 1 hour")).alias("g"),
    )
    return eventlog.envelope(rows, F.col("g"))


DAILY_SQL = """daily as (
  select cast(date_trunc('day', ts) as timestamp) as aligned_at_utc, 'events' as source_id, event_type as metric_name, cast(sum(cast(value as decimal(18, 2))) as double) as metric_value_float,
         max(ts) as latest_ingested_at_utc, count(*) as records_in_bucket from events group by 1, 2, 3)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics in the observation columns."""
    e = table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    g = e.groupBy(F.date_trunc("day", at).alias("aligned_at_utc"), F.col("event_type").alias("metric_name")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("metric_value_float"), F.max(at).alias("latest_ingested_at_utc"), F.count(F.lit(1)).alias("records_in_bucket")
    )
    none = F.lit(None)
    return g.select(
        "aligned_at_utc", F.lit("events").alias("source_id"), "metric_name", none.cast("string").alias("metric_unit"), none.cast("string").alias("metric_value_string"), none.cast("long").alias("metric_value_int"),
        "metric_value_float", none.cast("int").alias("metric_value_bool"), F.lit("{}").alias("dimensions_json"), none.cast("string").alias("provenance_json"), "latest_ingested_at_utc", "records_in_bucket",
    )


WEEK = TimeRange("2024-01-08T00:00:00Z", "2024-01-15T00:00:00Z")
WEEK_SQL = "datetime >= timestamp '2024-01-08' and datetime < timestamp '2024-01-15'"
NATIVE = ("trade_id", "timestamp", "price", "quantity", "is_buyer_maker")
NATIVE_SQL = "trade_id, timestamp, price, quantity, cast(is_buyer_maker as tinyint) as is_buyer_maker, datetime"


# --- scans, windows, filters ------------------------------------------------------------------------------------------


@query("src_01_native_time_range", f"with {TRADES_SQL} select {NATIVE_SQL} from trades where {WEEK_SQL}")
def _(spark, d):
    return native.query_native(trades(spark, d), TRADES, WEEK)


@query("flt_11_native_month", f"with {TRADES_SQL} select {NATIVE_SQL} from trades where datetime >= timestamp '2024-01-01' and datetime < timestamp '2024-02-01'")
def _(spark, d):
    return native.query_native(trades(spark, d), TRADES, Month(1, 2024))


@query("src_02_table_scan", "select o_orderkey, o_totalprice, o_orderdate from orders")
def _(spark, d):
    return native.query_table(table(spark, d, "orders"), AllRows(), ["o_orderkey", "o_totalprice", "o_orderdate"], "o_orderkey", "o_orderdate")


@query("src_08_day_bounds", "select cast(min(ts) as date) as min_day, cast(max(ts) as date) as max_day from events")
def _(spark, d):
    return spark.createDataFrame([windows.day_bounds(table(spark, d, "events"), "ts")], "min_day date, max_day date")


@query("top_01_latest_rows", f"with {TRADES_SQL} select {NATIVE_SQL} from trades order by date_trunc('day', datetime) desc, trade_id desc limit 40")
def _(spark, d):
    return native.query_native(trades(spark, d), TRADES, LatestRows(40))


@query("top_02_random_rows", f"with {TRADES_SQL} select {NATIVE_SQL} from trades order by md5(trade_id || '|' || timestamp), trade_id limit 50")
def _(spark, d):
    return native.query_native(trades(spark, d), TRADES, RandomRows(50))


@query("flt_t1_filter_after_window", f"with {TRADES_SQL}, w as (select {NATIVE_SQL} from trades order by date_trunc('day', datetime) desc, trade_id desc limit 100) select * from w where price > 20 and quantity not in (1.0, 2.0)")
def _(spark, d):
    return native.query_native(trades(spark, d), TRADES, LatestRows(100), filters=[{"field": "price", "op": "gt", "value": 20}, {"field": "quantity", "op": "not_in", "value": [1.0, 2.0]}])


_FILTERS = {
    "flt_01_eq": ("eq", 7, "trade_id = 7"), "flt_02_ne": ("ne", 7, "trade_id <> 7"), "flt_03_gt": ("gt", 300, "trade_id > 300"), "flt_04_gte": ("gte", 300, "trade_id >= 300"),
    "flt_05_lt": ("lt", 300, "trade_id < 300"), "flt_06_lte": ("lte", 300, "trade_id <= 300"), "flt_07_in": ("in", [1, 5, 9], "trade_id in (1, 5, 9)"), "flt_08_not_in": ("not_in", [1, 5, 9], "trade_id not in (1, 5, 9)"),
}
for _name, (_op, _value, _where) in _FILTERS.items():
    query(_name, f"with {TRADES_SQL} select trade_id, price from trades where {_where}")(
        lambda spark, d, op=_op, value=_value: filters.apply_fields(filters.apply_filters(trades(spark, d), [{"field": "trade_id", "op": op, "value": value}]), ["trade_id", " price ", "trade_id"])
    )


@query("prjc_06_iso_text", f"with {TRADES_SQL} select trade_id, strftime(datetime, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(cast(epoch_us(datetime) // 1000 % 1000 as varchar), 3, '0') || 'Z' as datetime from trades")
def _(spark, d):
    return native.iso_text(trades(spark, d).select("trade_id", "datetime"))


@query("prjc_07_epoch_millis", f"with {TRADES_SQL} select trade_id, timestamp from trades")
def _(spark, d):
    t = trades(spark, d)
    mixed = F.when(F.col("trade_id") % 2 == 0, F.col("timestamp")).otherwise(F.col("timestamp") * 1000 + 7)
    return t.select("trade_id", native.epoch_millis(mixed).alias("timestamp"))


@query("prjc_08_sides", f"with {SIDED_SQL} select trade_id, price, size as quantity, case when lower(side) = 'buy' then 0 else 1 end as is_buyer_maker, datetime from sided")
def _(spark, d):
    return sided(spark, d).select("trade_id", "price", F.col("size").alias("quantity"), native.maker_flag(F.col("side")).alias("is_buyer_maker"), "datetime")


@query("flt_14_keyset_page", f"with {LOG_SQL} select source_offset, stream_id, ingested_at from log where ingested_at > timestamp '2024-01-05 00:00:00' order by ingested_at, cast(source_offset as bigint) limit 100")
def _(spark, d):
    rows = log(spark, d).withColumn("event_id", F.lpad("source_offset", 12, "0"))
    return eventlog.page(rows, 100, ("2024-01-05 00:00:00", "999999999999")).select("source_offset", "stream_id", "ingested_at")


# --- bars -------------------------------------------------------------------------------------------------------------

_BARS_SQL = """
select time_bucket(interval 1 hour, datetime) as datetime, arg_min(price, trade_id) as open, max(price) as high, min(price) as low, arg_max(price, trade_id) as close,
  ((sum(cast(round(price * 100) as bigint)) * 2000 + count(*))::bigint // (2 * count(*))) / 1e5 as mean,
  round(stddev_pop(price), 6) as std, list_sort(list(price))[cast(floor(0.5 * count(*)) as int) + 1] as median,
  list_sort(list(price))[least(cast(floor(0.75 * count(*)) as int) + 1, count(*))] - list_sort(list(price))[cast(floor(0.25 * count(*)) as int) + 1] as iqr,
  round(cast(sum(cast(quantity as decimal(38, 12))) as double), 9) as volume, avg(is_buyer_maker) as maker_ratio, count(*) as no_of_trades,
  arg_min(price * quantity, trade_id) as open_liquidity, max(price * quantity) as high_liquidity, min(price * quantity) as low_liquidity, arg_max(price * quantity, trade_id) as close_liquidity,
  cast(round(sum(cast(price * quantity as decimal(38, 9))), 1) as double) as liquidity_sum, cast(sum(cast(is_buyer_maker * quantity as decimal(38, 12))) as double) as maker_volume,
  cast(round(sum(cast(is_buyer_maker * price * quantity as decimal(38, 9))), 1) as double) as maker_liquidity
from trades group by 1"""


def hourly_bars(spark: SparkSession, d: str) -> DataFrame:
    return bars.native_bars(trades(spark, d), AllRows(), 3600)


query("agg_01_bars_hourly", f"with {TRADES_SQL} {_BARS_SQL}")(hourly_bars)


@query("agg_05_bars_sided_daily", f"with {SIDED_SQL} select cast(date_trunc('day', datetime) as timestamp) as datetime, arg_min(price, trade_id) as open, max(price) as high, min(price) as low, arg_max(price, trade_id) as close, count(*) as no_of_trades, avg(case when lower(side) = 'buy' then 0.0 else 1.0 end) as maker_ratio from sided group by 1")
def _(spark, d):
    return bars.native_bars(sided(spark, d), AllRows(), 86_400, "size", bars.side_maker(), fields=["datetime", "open", "high", "low", "close", "no_of_trades", "maker_ratio"])


@query("top_07_latest_bars", f"with {TRADES_SQL}, b as (select time_bucket(interval 1 hour, datetime) as datetime, arg_min(price, trade_id) as open, arg_max(price, trade_id) as close, count(*) as no_of_trades from trades group by 1) select * from b order by datetime desc limit 24")
def _(spark, d):
    return bars.native_bars(trades(spark, d), LatestRows(24), 3600, fields=["datetime", "open", "close", "no_of_trades"])


@query("top_07_random_bars", f"with {TRADES_SQL}, b as (select time_bucket(interval 1 hour, datetime) as datetime, count(*) as no_of_trades from trades group by 1) select * from b order by md5(cast(epoch_us(datetime) // 1000 as varchar)), datetime limit 24")
def _(spark, d):
    return bars.native_bars(trades(spark, d), RandomRows(24), 3600, fields=["datetime", "no_of_trades"])


@query("flt_13_bars_time_range", f"with {TRADES_SQL} select time_bucket(interval 15 minute, datetime) as datetime, max(price) as high, count(*) as no_of_trades from trades where {WEEK_SQL} group by 1 having max(price) >= 50")
def _(spark, d):
    return bars.native_bars(trades(spark, d), WEEK, 900, fields=["datetime", "high", "no_of_trades"], filters=[{"field": "high", "op": "gte", "value": 50.0}])


@query("bar_01_base", f"with {TRADES_SQL} select trade_id, price from trades")
def _(spark, d):
    return bars.data_bars(trades(spark, d).select("trade_id", "price"), "base")


# --- event log and buckets --------------------------------------------------------------------------------------------


@query("snk_02_envelope", f"with {LOG_SQL} select source_id, stream_id, partition_id, source_offset, payload_json, sha256(payload_json) as payload_sha256 from log")
def _(spark, d):
    return log(spark, d).select("source_id", "stream_id", "partition_id", "source_offset", "payload_json", "payload_sha256")


@query("str_07_exactly_once", f"""with {LOG_SQL}, have as (select * from log where cast(source_offset as bigint) % 3 = 0)
select case when cast(source_offset as bigint) % 3 = 0 then case when cast(source_offset as bigint) % 5 = 0 then 'conflict' else 'duplicate' end else 'inserted' end as outcome, count(*) as n from log group by 1""")
def _(spark, d):
    every = log(spark, d)
    n = F.col("source_offset").cast("long")
    changed = every.withColumn("payload_sha256", F.when((n % 3 == 0) & (n % 5 == 0), F.sha2(F.lit("other"), 256)).otherwise(F.col("payload_sha256")))
    return eventlog.classify(changed, every.where(n % 3 == 0)).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def one_second_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Buckets of the log as if of one exchange's stream."""
    own = log(spark, d).withColumns({"source_id": F.lit("binance"), "stream_id": F.lit("binance_spot_trades")})
    return aligned.bucketise(own)


@query("agg_25_buckets", f"""with {LOG_SQL} select stream_id, partition_id, date_trunc('second', source_event_time) as aligned_at_utc, count(*) as bucket_event_count, max(ingested_at) as latest_ingested_at_utc from log group by all""")
def _(spark, d):
    return aligned.bucketise(log(spark, d)).select("stream_id", "partition_id", "aligned_at_utc", "bucket_event_count", "latest_ingested_at_utc")


@query("agg_25_bucket_digest", """with r as (
  select date_trunc('hour', ts) as aligned_at_utc, ts, event_id, '{"event_id":"' || lpad(cast(event_id as varchar), 12, '0') || '","ingested_at_utc":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
    case when epoch_us(ts) % 1000000 = 0 then '' else '.' || lpad(cast(epoch_us(ts) % 1000000 as varchar), 6, '0') end || '+00:00","payload_json":"{}","payload_sha256_raw":"' || sha256('{}') ||
    '","source_event_time_utc":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when epoch_us(ts) % 1000000 = 0 then '' else '.' || lpad(cast(epoch_us(ts) % 1000000 as varchar), 6, '0') end ||
    '+00:00","source_offset_or_equivalent":"' || event_id || '"}' as j from events)
select aligned_at_utc, count(*) as bucket_event_count, sha256('{"rows":[' || string_agg(j, ',' order by ts, event_id) || ']}') as bucket_sha256 from r group by 1""")
def _(spark, d):
    e = table(spark, d, "events")
    at = F.col("ts").cast("timestamp")
    rows = e.select(
        F.lit("s").alias("source_id"), F.lit("t").alias("stream_id"), F.lit("p").alias("partition_id"), F.col("event_id").cast("string").alias("source_offset"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("event_id"),
        at.alias("source_event_time"), at.alias("ingested_at"), F.lit("{}").alias("payload_json"), F.sha2(F.lit("{}"), 256).alias("payload_sha256"),
    )
    return aligned.bucketise(rows, 3600).select("aligned_at_utc", "bucket_event_count", "bucket_sha256")


_SECONDS_SQL = f"""with {TRADES_SQL} select date_trunc('second', datetime) as aligned_at_utc, arg_min(price, trade_id) as open_price, max(price) as high_price, min(price) as low_price, arg_max(price, trade_id) as close_price,
  cast(sum(cast(quantity as decimal(38, 12))) as double) as quantity_sum, cast(sum(quote) as double) as quote_volume_sum, count(*) as trade_count from trades group by 1"""


@query("agg_19_exchange_seconds", _SECONDS_SQL)
def _(spark, d):
    return aligned.query_aligned(one_second_buckets(spark, d), "binance_spot_trades", AllRows())


@query("agg_40_seconds_from_trades", _SECONDS_SQL)
def _(spark, d):
    return aligned.seconds_from_trades(trades(spark, d))


@query("agg_18_aligned_bars", f"with {TRADES_SQL} select time_bucket(interval 1 hour, datetime) as datetime, arg_min(price, (date_trunc('second', datetime), trade_id)) as open, max(price) as high, min(price) as low, count(*) as no_of_trades, round(cast(sum(cast(quantity as decimal(38, 12))) as double), 9) as volume from trades group by 1")
def _(spark, d):
    seconds = aligned.query_aligned(one_second_buckets(spark, d), "binance_spot_trades", AllRows())
    return bars.aligned_bars(seconds, 3600, ["datetime", "open", "high", "low", "no_of_trades", "volume"])


@query("src_05_aligned_time_range", f"{_SECONDS_SQL.replace('from trades group', 'from trades where ' + WEEK_SQL + ' group')}")
def _(spark, d):
    return aligned.query_aligned(one_second_buckets(spark, d), "binance_spot_trades", WEEK)


# --- observations and forward fill ------------------------------------------------------------------------------------


@query("agg_24_observations", f"with {DAILY_SQL} select * from daily")
def _(spark, d):
    return daily(spark, d).select("aligned_at_utc", "source_id", "metric_name", "metric_value_float", "latest_ingested_at_utc", "records_in_bucket")


@query("win_02_forward_fill", f"""with {DAILY_SQL}, known as (
  select * from daily where aligned_at_utc >= timestamp '2024-01-08 12:00:00' and aligned_at_utc < timestamp '2024-01-15'
  union all select arg_max(aligned_at_utc, aligned_at_utc), source_id, metric_name, arg_max(metric_value_float, aligned_at_utc), arg_max(latest_ingested_at_utc, aligned_at_utc), arg_max(records_in_bucket, aligned_at_utc)
  from daily where aligned_at_utc < timestamp '2024-01-08 12:00:00' group by source_id, metric_name
), led as (select *, lead(aligned_at_utc) over (partition by source_id, metric_name order by aligned_at_utc) as following from known)
select metric_name, aligned_at_utc, metric_value_float, greatest(aligned_at_utc, timestamp '2024-01-08 12:00:00') as valid_from_utc,
  least(coalesce(following, timestamp '2024-01-15'), timestamp '2024-01-15') as valid_to_utc_exclusive from led where coalesce(following, timestamp '2024-01-15') > timestamp '2024-01-08 12:00:00'""")
def _(spark, d):
    out = aligned.forward_fill(daily(spark, d), TimeRange("2024-01-08T12:00:00Z", "2024-01-15T00:00:00Z"))
    return out.select("metric_name", "aligned_at_utc", "metric_value_float", "valid_from_utc", "valid_to_utc_exclusive")


@query("join_07_prior_state", f"with {DAILY_SQL} select metric_name, max(aligned_at_utc) as aligned_at_utc, arg_max(metric_value_float, aligned_at_utc) as metric_value_float from daily where aligned_at_utc < timestamp '2024-01-08' group by 1")
def _(spark, d):
    return aligned.prior_state(daily(spark, d), F.lit("2024-01-08").cast("timestamp")).select("metric_name", "aligned_at_utc", "metric_value_float")


@query("top_05_latest_observations", f"with {DAILY_SQL} select aligned_at_utc, metric_name, metric_value_float from daily order by aligned_at_utc desc, source_id desc, metric_name desc limit 15")
def _(spark, d):
    return aligned.metric_window(daily(spark, d), LatestRows(15)).select("aligned_at_utc", "metric_name", "metric_value_float")


@query("top_06_random_observations", f"""with {DAILY_SQL}, t as (select *, strftime(aligned_at_utc, '%Y-%m-%dT%H:%M:%S') || '+00:00|' || source_id || '|' || metric_name || '|' || strftime(latest_ingested_at_utc, '%Y-%m-%dT%H:%M:%S') ||
  case when epoch_us(latest_ingested_at_utc) % 1000000 = 0 then '' else '.' || lpad(cast(epoch_us(latest_ingested_at_utc) % 1000000 as varchar), 6, '0') end || '+00:00|' || records_in_bucket as k from daily)
select aligned_at_utc, metric_name, metric_value_float from t order by substr(sha256(k), 1, 16), aligned_at_utc, source_id, metric_name limit 15""")
def _(spark, d):
    return aligned.metric_window(daily(spark, d), RandomRows(15)).select("aligned_at_utc", "metric_name", "metric_value_float")


@query("win_08_keep_last", "select o_custkey, max(o_orderdate) as o_orderdate, arg_max(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey from orders group by 1")
def _(spark, d):
    return eventlog.latest(table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("win_09_keep_first", "select l_orderkey, min(l_linenumber) as l_linenumber, arg_min(l_partkey, l_linenumber) as l_partkey from lineitem group by 1")
def _(spark, d):
    """Of a number's several lines the table's first, as DuckDB reads them: order keys and numbers are not unique."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    return integrity.keep_first(lines, ["l_orderkey"], "l_linenumber", "file", "at").drop("file", "at")


# --- state, proofs, planning ------------------------------------------------------------------------------------------


@query("agg_28_latest_state", "select o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as state from orders group by 1")
def _(spark, d):
    return eventlog.latest(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", F.col("o_orderstatus").alias("state"))


@query("agg_30_next_revision", "select o_custkey, count(*) + 1 as next_revision from orders group by 1")
def _(spark, d):
    o = table(spark, d, "orders")
    numbered = o.select("o_custkey", F.row_number().over(eventlog_order()).alias("revision"))
    return eventlog.next_revision(numbered, ["o_custkey"])


def eventlog_order():
    from pyspark.sql import Window

    return Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")


@query("top_09_duplicate_revisions", "select o_custkey, cast(o_orderdate as date) as revision, count(*) as rows from orders group by 1, 2 having count(*) > 1")
def _(spark, d):
    return eventlog.duplicate_revisions(table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("revision")), ["o_custkey"])


@query("src_07_active_log", f"with {LOG_SQL} select stream_id, partition_id, count(*) as n from log where not (stream_id = (select min(stream_id) from log) and ingested_at <= timestamp '2024-01-10') group by 1, 2")
def _(spark, d):
    every = log(spark, d)
    first = every.agg(F.min("stream_id").alias("stream_id"))
    resets = every.select(*eventlog.STREAM).distinct().join(F.broadcast(first), "stream_id").select(*eventlog.STREAM, F.lit("2024-01-10").cast("timestamp").alias("reset_at"))
    return eventlog.active(every, resets).groupBy("stream_id", "partition_id").agg(F.count(F.lit(1)).alias("n"))


@query("agg_26_source_proof", f"""with {LOG_SQL}, l as (select *, cast(source_offset as bigint) as o, sha256(payload_json) as h from log)
select stream_id, partition_id, count(*) as row_count, cast(min(o) as varchar) as first_offset, cast(max(o) as varchar) as last_offset, sha256(string_agg(source_offset, chr(10) order by o) || chr(10)) as offset_digest from l group by 1, 2""")
def _(spark, d):
    return proofs.source_proof(log(spark, d), "numeric").select("stream_id", "partition_id", "row_count", "first_offset", "last_offset", "offset_digest")


@query("agg_27_canonical_proof", f"""with {LOG_SQL}, l as (select *, cast(source_offset as bigint) as o from log)
select stream_id, partition_id, count(*) as row_count, count(distinct o) as unique_offset_count, max(o) - min(o) + 1 - count(distinct o) as gap_count, count(*) - count(distinct o) as duplicate_count from l group by 1, 2""")
def _(spark, d):
    return proofs.canonical_proof(log(spark, d), "numeric").select("stream_id", "partition_id", "row_count", "unique_offset_count", "gap_count", "duplicate_count")


@query("agg_38_range_proof", """with p as (select o_orderstatus as stream_id, strftime(o_orderdate, '%Y-%m-%d') as partition_id, count(*) as row_count from orders group by 1, 2)
select stream_id, count(*) as partition_count, cast(sum(row_count) as bigint) as row_count, min(partition_id) as first_partition, max(partition_id) as last_partition,
  sha256(string_agg(partition_id || '|' || row_count, chr(10) order by partition_id) || chr(10)) as range_digest from p group by 1""")
def _(spark, d):
    o = table(spark, d, "orders")
    p = o.groupBy(F.col("o_orderstatus").alias("stream_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("partition_id")).agg(F.count(F.lit(1)).alias("row_count"))
    return proofs.range_proof(p.withColumn("identity_digest", F.col("row_count").cast("string")), ["stream_id"])


@query("agg_35_gap_summary", """with n as (select event_type, event_id, lead(event_id) over (partition by event_type order by event_id) as nx from events),
g as (select event_type, min(event_id) as min_offset, max(event_id) as max_offset, max(event_id) - min(event_id) + 1 as expected_count, count(distinct event_id) as observed_count,
  max(event_id) - min(event_id) + 1 - count(distinct event_id) as gap_count, count(event_id) - count(distinct event_id) as duplicate_count from events group by 1)
select g.*, (select string_agg(m, ',' order by m) from (select unnest(range(event_id + 1, nx)) as m from n where n.event_type = g.event_type and nx > event_id + 1 order by m limit 10)) as first_missing from g""")
def _(spark, d):
    out = proofs.gap_summary(table(spark, d, "events"), ["event_type"], "event_id")
    return out.withColumn("first_missing", F.array_join("first_missing", ","))


# a quarter of the orders' days count as proved, so that there are gaps to find
_PROVED = "select distinct 'o' as source_id, 'd' as stream_id, strftime(o_orderdate, '%Y-%m-%d') as partition_id from orders where o_orderkey % 4 = 0"
_LOGGED = "select distinct 'o' as source_id, 'd' as stream_id, strftime(l_shipdate, '%Y-%m-%d') as partition_id from lineitem"


def _proved(spark, d):
    return table(spark, d, "orders").where("o_orderkey % 4 = 0").select(F.lit("o").alias("source_id"), F.lit("d").alias("stream_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("partition_id")).distinct()


def _logged(spark, d):
    return table(spark, d, "lineitem").select(F.lit("o").alias("source_id"), F.lit("d").alias("stream_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("partition_id"))


@query("join_02_unproved", f"{_LOGGED} except {_PROVED}")
def _(spark, d):
    states = _proved(spark, d).withColumns({"state": F.lit("proved_complete"), "revision": F.lit(1), "recorded_at": F.lit("2024-01-01").cast("timestamp")})
    return proofs.unproved_partitions(_logged(spark, d), states)


@query("join_03_ambiguous", f"with e as ({_LOGGED} union {_PROVED}) select 'o' as source_id, 'd' as stream_id, count(*) as ambiguous_count, min(partition_id) as first_partition from (select * from e except {_PROVED})")
def _(spark, d):
    p = _proved(spark, d).withColumns({"state": F.lit("empty_proved"), "revision": F.lit(1), "recorded_at": F.lit("2024-01-01").cast("timestamp")})
    return proofs.ambiguous_partitions(_logged(spark, d), p, p)


@query("join_05_missing_days", "select strftime(d, '%Y-%m-%d') as partition_id from generate_series(timestamp '1995-01-02', timestamp '1995-06-30', interval 1 day) s(d) where isodow(d) <= 5 and strftime(d, '%Y-%m-%d') not in (select strftime(o_orderdate, '%Y-%m-%d') from orders where o_orderkey % 4 = 0)")
def _(spark, d):
    return proofs.missing_days(proofs.days(spark, date(1995, 1, 2), date(1995, 6, 30), business=True), _proved(spark, d))


@query("join_06_coverage", f"with a as ({_LOGGED}), b as ({_PROVED}) select coalesce(a.source_id, b.source_id) as source_id, coalesce(a.stream_id, b.stream_id) as stream_id, coalesce(a.partition_id, b.partition_id) as partition_id, a.partition_id is not null as projected, b.partition_id is not null as proved from a full join b on a.partition_id = b.partition_id where a.partition_id is null or b.partition_id is null")
def _(spark, d):
    return proofs.coverage_differences(_logged(spark, d), _proved(spark, d))


@query("gen_01_days", "select strftime(d, '%Y-%m-%d') as partition_id from generate_series(timestamp '2024-01-01', timestamp '2024-12-31', interval 1 day) s(d)")
def _(spark, d):
    return proofs.days(spark, date(2024, 1, 1), date(2024, 12, 31))


@query("set_01_union", f"{_LOGGED} union {_PROVED}")
def _(spark, d):
    return proofs.known_partitions(_logged(spark, d), _proved(spark, d))


@query("agg_26_two_level_digest", f"""with {LOG_SQL}, o as (select *, cast(source_offset as bigint) as n, row_number() over (partition by stream_id, partition_id order by cast(source_offset as bigint)) - 1 as k from log),
b as (select stream_id, partition_id, k // 4 as b, count(*) as rows, sha256(string_agg(source_offset || '|' || source_offset || '|' || sha256(payload_json), chr(10) order by k) || chr(10)) as digest from o group by all)
select stream_id, partition_id, cast(sum(rows) as bigint) as row_count, sha256(string_agg(digest, chr(10) order by b) || chr(10)) as block_digest from b group by 1, 2""")
def _(spark, d):
    events = log(spark, d).withColumn("event_id", F.col("source_offset"))
    return proofs.two_level_digest(events, "numeric", 4).drop("source_id")


# --- quality ----------------------------------------------------------------------------------------------------------


# every eleventh trade is left out here, as gaps are what the report is to count
@query("dq_01_exchange_report", "with n as (select *, lag(event_id) over (partition by cast(ts as date) order by event_id) as p from events where event_id % 11 <> 3) select count(*) as rows, count(*) filter (p is not null and event_id <> p + 1) as id_sequence, 0::bigint as id_not_negative, count(*) filter (value <= 0) as price_positive, count(*) filter (cast(json_extract_string(props, '$.k') as double) <= 0) as size_positive, 0::bigint as timestamp_positive, 0::bigint as maker_flag from n")
def _(spark, d):
    daily_trades = trades(spark, d).where("trade_id % 11 <> 3").withColumn("partition_id", F.to_date("datetime"))
    df, checks = integrity.exchange_checks(daily_trades, "binance", row_order="trade_id")
    return integrity.report(df, checks)


@query("win_04_continuity", "select event_type, count(*) filter (event_id <> p + 1) as breaks from (select event_type, event_id, lag(event_id) over (partition by event_type order by event_id) as p from events) group by 1")
def _(spark, d):
    e = integrity.neighbours(table(spark, d, "events"), "event_id", ["event_type"], ["event_id"])
    return e.groupBy("event_type").agg(F.count_if(F.col("event_id") != F.col("previous_event_id") + 1).alias("breaks"))


@query("agg_33_conflicts", "select l_orderkey, count(distinct (l_partkey, l_suppkey)) as versions from lineitem group by 1 having count(distinct (l_partkey, l_suppkey)) > 1")
def _(spark, d):
    return integrity.conflicting(table(spark, d, "lineitem"), "l_orderkey", ["l_partkey", "l_suppkey"])


@query("agg_31_metric_warnings", f"""with {DAILY_SQL}, l as (select metric_name, max(cast(aligned_at_utc as date)) as last_day from daily group by 1), t as (select distinct metric_name from daily)
select t.metric_name as source_id, l.last_day, 'stale' as warning from t join l using (metric_name) where date '2024-03-01' - l.last_day > 3""")
def _(spark, d):
    m = daily(spark, d).withColumnsRenamed({"aligned_at_utc": "observed_at_utc", "source_id": "x"}).withColumn("source_id", F.col("metric_name"))
    names = [r[0] for r in m.select("metric_name").distinct().orderBy("metric_name").collect()]
    return serving.metric_warnings(m, names, [], "2024-03-01", 3).select("source_id", "last_day", "warning")


@query("dq_13_freshness", f"with {DAILY_SQL} select max(aligned_at_utc) as as_of, cast(epoch(timestamp '2024-03-01') - epoch(max(aligned_at_utc)) as double) as lag_seconds, timestamp '2024-03-01' - max(aligned_at_utc) > interval 2 day as stale from daily")
def _(spark, d):
    found = serving.freshness(daily(spark, d), datetime(2024, 3, 1, tzinfo=UTC), timedelta(days=2))
    return spark.createDataFrame([(found["as_of"], found["lag_seconds"], found["stale"])], "as_of timestamp, lag_seconds double, stale boolean")


# --- formulas, text, artifacts ----------------------------------------------------------------------------------------


@query("fn_subsidy", "select o_orderkey as height, case when o_orderkey * 100 // 210000 >= 64 then 0 else 5000000000 >> cast(o_orderkey * 100 // 210000 as int) end as subsidy_sats from orders")
def _(spark, d):
    h = F.col("o_orderkey") * 100
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("height"), bitcoin.subsidy_sats(h).alias("subsidy_sats"))


@query("fn_supply", "select o_orderkey as height, cast((select sum(greatest(0, least(o_orderkey * 100 + 1 - e * 210000, 210000)) * (5000000000 >> cast(e as int))) from range(0, 33) r(e)) as bigint) as supply_sats from orders")
def _(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("height"), bitcoin.supply_sats(F.col("o_orderkey") * 100).alias("supply_sats"))


@query("win_07_intervals", "select event_type, event_id, cast(coalesce(epoch_us(ts) // 1000 - lag(epoch_us(ts) // 1000) over w, lead(epoch_us(ts) // 1000) over w - epoch_us(ts) // 1000) // 1000 as bigint) as observed_interval_seconds from events window w as (partition by event_type order by event_id)")
def _(spark, d):
    e = table(spark, d, "events").select("event_type", F.col("event_id").alias("height"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"))
    out = bitcoin.observed_intervals(e.withColumn("timestamp", F.col("timestamp")), "event_type")
    return out.select("event_type", F.col("height").alias("event_id"), F.floor((F.col("observed_interval_seconds"))).cast("long").alias("observed_interval_seconds"))


@query("fn_order_key", """with o as (select case when event_id % 3 = 0 then 'x' || event_id else cast(event_id as varchar) end as o from events)
select o, lead(o) over (order by o[1] = 'x', try_cast(o as bigint), o) as following from o""")
def _(spark, d):
    """Every offset with the one after it: digits as numbers, then text."""
    n = F.col("event_id").cast("string")
    e = table(spark, d, "events").select(F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("x"), n)).otherwise(n).alias("o"))
    placed = splits.numbered(e, [identity.order_key(F.col("o"))], "n")
    after = placed.select((F.col("n") - 1).alias("n"), F.col("o").alias("following"))
    return placed.join(after, "n", "left").select("o", "following")


@query("fn_amount", "select o_orderkey, o_totalprice as amount from orders")
def _(spark, d):
    o = table(spark, d, "orders")
    shown = F.concat(F.lit("$ "), F.format_number("o_totalprice", 2))
    return o.select("o_orderkey", text.amount(shown).alias("amount"))


@query("fn_metric_id", "select n_nationkey, sha256('a|' || n_name || '|' || n_regionkey) as metric_id from nation")
def _(spark, d):
    return table(spark, d, "nation").select("n_nationkey", identity.metric_id(F.lit("a"), F.col("n_name"), F.col("n_regionkey").cast("string")).alias("metric_id"))


@query("src_19_artifact_records", """with c as (select n_regionkey, count(*) as n from nation group by 1), r as (select r_regionkey, r_name, n from region join c on r_regionkey = n_regionkey)
select 'html' as parser, cast(r_regionkey as varchar) as artifact_id, unnest(range(n)) as record_index, r_name as first_cell from r
union all select 'csv', cast(r_regionkey as varchar), unnest(range(n)), r_name from r union all select 'json', cast(r_regionkey as varchar), unnest(range(n)), r_name from r union all select 'text', cast(r_regionkey as varchar), unnest(range(n)), null from r""")
def _(spark, d):
    """The nations of each region as a page, a file, a JSON document and text lines."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("n_regionkey")
    cells = F.concat(F.lit("<tr><td>"), "r_name", F.lit("</td><td> $"), "n_nationkey", F.lit("</td></tr>"))
    rows = lambda c, sep: F.array_join(F.collect_list(c), sep)
    made = n.agg(
        F.concat(F.lit("<table><tr><th>Region Name</th><th>2024 Key</th></tr>"), rows(cells, ""), F.lit("</table>")).alias("html"),
        F.concat(F.lit("Region Name,2024 Key\n"), rows(F.concat_ws(",", "r_name", "n_nationkey"), "\n")).alias("csv"),
        F.to_json(F.struct(F.collect_list(F.struct(F.col("r_name").alias("Region Name"), F.col("n_nationkey").alias("2024 Key"))).alias("data"))).alias("json"),
        rows(F.concat(F.lit(" line "), "n_nationkey"), "\n\n").alias("text"),
    )
    long = made.select(F.col("n_regionkey").cast("string").alias("artifact_id"), F.explode(F.create_map(*(x for f in ("html", "csv", "json", "text") for x in (F.lit(f), F.col(f))))).alias("format", "content"))
    return artifacts.parse(long).select("parser", "artifact_id", "record_index", F.col("fields")["region_name"].alias("first_cell"))


@query("spl_01_sequential", "select case when n < cast(floor(t * 7 / 10) as bigint) then 'a' else 'b' end as part, count(*) as rows, min(event_id) as first, max(event_id) as last from (select event_id, row_number() over (order by event_id) - 1 as n, count(*) over () as t from events) group by 1")
def _(spark, d):
    a, b = splits.split_sequential(table(spark, d, "events").select("event_id"), [7, 3], ["event_id"])
    one = lambda name, p: p.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    return one("a", a).unionByName(one("b", b))


@query("ext_grid_join", f"""with {DAILY_SQL}, named as (select *, dense_rank() over (order by metric_name) - 1 as k from daily), g as (select unnest(generate_series(timestamp '2024-01-08', timestamp '2024-01-15' - interval 1 hour, interval 1 hour)) as t),
v as (select g.t, k, arg_max(metric_value_float, aligned_at_utc) as v from g join named on aligned_at_utc <= g.t group by 1, 2)
select t as aligned_at_utc, """ + ", ".join(f"max(v) filter (k = {k}) as m{k}" for k in range(5)) + " from v group by 1")
def _(spark, d):
    filled = aligned.forward_fill(daily(spark, d), WEEK)
    names = [r[0] for r in filled.select("metric_name").distinct().orderBy("metric_name").collect()]
    return aligned.on_grid([(f"m{k}", filled.where(F.col("metric_name") == n)) for k, n in enumerate(names)], WEEK.start, WEEK.end, 3600)


