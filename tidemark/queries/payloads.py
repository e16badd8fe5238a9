"""The twelve datasets made of the driver's tables: payloads through envelopes, projectors, buckets and readers.

Expressions are written once, in Spark's dialect; duck() puts them into DuckDB's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import DATASETS
from tidemark.functions.identity import EVENT_NAMESPACE
from tidemark.operators import aligned, eventlog, native
from tidemark.plans.windows import AllRows, LatestRows, RandomRows, TimeRange
from tidemark.queries.base import query, table
from tidemark.streaming.projector import native_rows

_DUCK = (("get_json_object(", "json_extract_string("), ("unix_micros(", "epoch_us("), (" div ", " // "), ("sha2(", "sha256("), (", 256)", ")"))
#: What Spark computes in another way than the SQL: a power of two of 63 and more is no bigint; long before it nothing is left of a subsidy.
_SPARK = (("pow(2, (o_orderkey * 100) div 210000)", "pow(2, least((o_orderkey * 100) div 210000, 62))"),)


def in_spark(expression: str) -> str:
    for theirs, own in _SPARK:
        expression = expression.replace(theirs, own)
    return expression


def duck(expression: str) -> str:
    for ours, theirs in _DUCK:
        expression = expression.replace(ours, theirs)
    return expression


@dataclass(frozen=True)
class Made:
    """A dataset's rows: the table they are made of, offset and time, the payload's fields and the native columns."""

    table: str
    offset: str
    at: str
    fields: dict[str, str]
    native: dict[str, str]
    week: tuple[str, str]


def _money(c: str) -> str:
    return f"cast({c} as decimal(18,2))"


def _text(c: str) -> str:
    return f"cast({c} as string)"


_EVENT_WEEK, _ORDER_WEEK = ("2024-01-08T00:00:00Z", "2024-01-15T00:00:00Z"), ("1995-01-01T00:00:00Z", "1995-03-01T00:00:00Z")
_K = "get_json_object(props, '$.k')"
_TS, _DAY, _HOUR = "cast(ts as timestamp)", "cast(date_trunc('day', ts) as timestamp)", "cast(date_trunc('hour', ts) as timestamp)"
_SHIPPED, _ORDERED = "cast(l_shipdate as timestamp)", "cast(o_orderdate as timestamp)"
_LINE = "l_orderkey * 8 + l_linenumber"
_SIDE = "case when l_returnflag = 'R' then 'sell' else 'buy' end"
_QUOTE = f"{_money('value')} * cast({_K} as decimal(18,0))"

_SIDED = {"price": _text(_money("l_extendedprice")), "side": _SIDE, "size": _text(_money("l_quantity")), "timestamp": f"(unix_micros({_SHIPPED}) div 1000)", "trade_id": _LINE}
_SIDED_NATIVE = {
    "trade_id": _LINE, "side": _SIDE, "price": f"cast({_money('l_extendedprice')} as double)", "size": f"cast({_money('l_quantity')} as double)",
    "quote_quantity": f"cast({_money('l_extendedprice')} as double) * cast({_money('l_quantity')} as double)", "timestamp": f"(unix_micros({_SHIPPED}) div 1000)", "datetime": _SHIPPED,
}

_KIND = "case event_id % 5 when 0 then 'null' when 1 then 'bool' when 2 then 'int' when 3 then 'float' else 'string' end"
_SCALAR = f"case event_id % 5 when 1 then case when event_id % 2 = 0 then 'true' else 'false' end when 2 then {_text('event_id')} when 3 then {_text(_money('value'))} when 4 then concat('t', {_text('event_id')}) end"
_FLAG = "case when event_id % 5 = 1 then event_id % 2 = 0 end"
_PROVENANCE = """'{"last_updated_utc":"2024-01-05T00:00:00Z"}'"""
_METRIC = Made(
    "events", _text("event_id"), _DAY,
    {
        "dimensions": "'{}'", "metric_name": f"concat('m', {_text('user_id % 4')})", "metric_unit": "'USD'", "metric_value_bool": _FLAG, "metric_value_kind": _KIND, "metric_value_text": _SCALAR,
        "provenance": _PROVENANCE, "record_source_id": "event_type",
    },
    {
        "metric_id": _text("event_id"), "source_id": "event_type", "metric_name": f"concat('m', {_text('user_id % 4')})", "metric_unit": "'USD'", "metric_value_string": _SCALAR,
        "metric_value_int": "case when event_id % 5 = 2 then event_id end", "metric_value_float": f"case event_id % 5 when 2 then cast(event_id as double) when 3 then cast({_money('value')} as double) end",
        "metric_value_bool": _FLAG, "observed_at_utc": _DAY, "dimensions_json": "'{}'", "provenance_json": _PROVENANCE, "ingested_at_utc": f"{_TS} + interval 1 hour",
    },
    _EVENT_WEEK,
)

_HASH = lambda c: f"sha2({c}, 256)"
_H100 = "(o_orderkey * 100)"
_SATS = f"cast(5000000000 div cast(pow(2, {_H100} div 210000) as bigint) as bigint)"
_BTC = lambda sats: f"concat({_text(f'{sats} div 100000000')}, '.', lpad({_text(f'{sats} % 100000000')}, 8, '0'))"
_BLOCK = {"block_hash": _HASH(_text("o_orderkey")), "block_height": "o_orderkey", "block_timestamp_ms": f"(unix_micros({_ORDERED}) div 1000)", "source_chain": "'main'"}
_BLOCK_NATIVE = {"block_height": "o_orderkey", "block_hash": _HASH(_text("o_orderkey")), "block_timestamp": f"(unix_micros({_ORDERED}) div 1000)", "datetime": _ORDERED, "source_chain": "'main'"}


def _derived(fields: dict[str, str], columns: dict[str, str]) -> Made:
    return Made("orders", _text("o_orderkey"), _ORDERED, _BLOCK | fields, _BLOCK_NATIVE | columns, _ORDER_WEEK)


_VALUE = _text(_money("o_totalprice"))
_PAID = f"concat('{{\"input_value_btc_sum\":\"', {_text(_money('l_extendedprice'))}, '\",\"output_value_btc_sum\":\"', {_text(_money('l_extendedprice') + ' - ' + _money('l_tax'))}, '\"}}')"

MADE: dict[str, Made] = {
    "binance_spot_trades": Made(
        "events", _text("event_id"), _TS,
        {"is_best_match": "true", "is_buyer_maker": "user_id % 2 = 1", "price": _text(_money("value")), "qty": _K, "quote_qty": _text(_QUOTE), "trade_id": "event_id"},
        {
            "trade_id": "event_id", "timestamp": f"(unix_micros({_TS}) div 1000)", "price": f"cast({_money('value')} as double)", "quantity": f"cast({_K} as double)", "quote_quantity": f"cast({_QUOTE} as double)",
            "is_buyer_maker": "cast(user_id % 2 as tinyint)", "is_best_match": "cast(1 as tinyint)", "datetime": _TS,
        },
        _EVENT_WEEK,
    ),
    "okx_spot_trades": Made("lineitem", _text(_LINE), _SHIPPED, _SIDED | {"instrument_name": "'BTC-USDT'"}, _SIDED_NATIVE | {"instrument_name": "'BTC-USDT'"}, _ORDER_WEEK),
    "bybit_spot_trades": Made(
        "lineitem", _text(_LINE), _SHIPPED, _SIDED | {"symbol": "'BTCUSDT'", "trd_match_id": f"concat('m-', {_text(_LINE)})", "tick_direction": "'PlusTick'", "gross_value": _text(_money("l_tax")), "home_notional": _text(_money("l_discount"))},
        _SIDED_NATIVE | {"symbol": "'BTCUSDT'", "trd_match_id": f"concat('m-', {_text(_LINE)})", "tick_direction": "'PlusTick'", "gross_value": f"cast({_money('l_tax')} as double)", "home_notional": f"cast({_money('l_discount')} as double)", "foreign_notional": "cast(null as double)"},
        _ORDER_WEEK,
    ),
    "etf_daily_metrics": _METRIC,
    "fred_series_metrics": _METRIC,
    "bitcoin_block_headers": Made(
        "orders", _text("o_orderkey"), _ORDERED,
        {
            "block_hash": _HASH(_text("o_orderkey")), "difficulty": _VALUE, "height": "o_orderkey", "merkle_root": _HASH(f"concat('m', {_text('o_orderkey')})"), "nonce": "o_custkey",
            "prev_hash": _HASH(_text("o_orderkey - 1")), "source_chain": "'main'", "timestamp_ms": f"(unix_micros({_ORDERED}) div 1000)", "version": "1",
        },
        {
            "height": "o_orderkey", "block_hash": _HASH(_text("o_orderkey")), "prev_hash": _HASH(_text("o_orderkey - 1")), "merkle_root": _HASH(f"concat('m', {_text('o_orderkey')})"), "version": "1",
            "nonce": "o_custkey", "difficulty": f"cast({_money('o_totalprice')} as double)", "timestamp": f"(unix_micros({_ORDERED}) div 1000)", "datetime": _ORDERED, "source_chain": "'main'",
        },
        _ORDER_WEEK,
    ),
    "bitcoin_block_transactions": Made(
        "lineitem", f"concat(lpad({_text('l_orderkey')}, 12, '0'), ':', {_text('l_linenumber')})", _SHIPPED,
        {
            "block_hash": _HASH(_text("l_orderkey")), "block_height": "l_orderkey", "block_timestamp_ms": f"(unix_micros({_SHIPPED}) div 1000)", "coinbase": "l_linenumber = 1", "inputs_json": "'[]'", "outputs_json": "'[]'",
            "scripts_json": "'[]'", "source_chain": "'main'", "transaction_index": "l_linenumber - 1", "txid": _HASH(f"concat({_text('l_orderkey')}, '|', {_text('l_linenumber')})"), "values_json": _PAID, "witness_data_json": "'[]'",
        },
        {
            "block_height": "l_orderkey", "block_hash": _HASH(_text("l_orderkey")), "block_timestamp": f"(unix_micros({_SHIPPED}) div 1000)", "transaction_index": "l_linenumber - 1",
            "txid": _HASH(f"concat({_text('l_orderkey')}, '|', {_text('l_linenumber')})"), "inputs": "'[]'", "outputs": "'[]'", "values": _PAID, "scripts": "'[]'", "witness_data": "'[]'",
            "coinbase": "case when l_linenumber = 1 then 1 else 0 end", "datetime": _SHIPPED, "source_chain": "'main'",
        },
        _ORDER_WEEK,
    ),
    "bitcoin_mempool_state": Made(
        "events", _HASH(_text("event_id")), _HOUR,
        {
            "fee_rate_sat_vb": _text(_money("value")), "first_seen_timestamp": f"(unix_micros({_TS}) div 1000) div 1000", "rbf_flag": "user_id % 2 = 1", "snapshot_at_unix_ms": f"(unix_micros({_HOUR}) div 1000)", "source_chain": "'main'",
            "txid": _HASH(_text("event_id")), "vsize": f"cast({_K} as bigint)",
        },
        {
            "snapshot_at": _HOUR, "snapshot_at_unix_ms": f"(unix_micros({_HOUR}) div 1000)", "txid": _HASH(_text("event_id")), "fee_rate_sat_vb": f"cast({_money('value')} as double)", "vsize": f"cast({_K} as bigint)",
            "first_seen_timestamp": f"(unix_micros({_TS}) div 1000) div 1000", "rbf_flag": "cast(user_id % 2 as tinyint)", "source_chain": "'main'",
        },
        _EVENT_WEEK,
    ),
    "bitcoin_block_fee_totals": _derived({"fee_total_btc": _VALUE}, {"fee_total_btc": f"cast({_money('o_totalprice')} as double)"}),
    "bitcoin_block_subsidy_schedule": _derived(
        {"halving_interval": f"{_H100} div 210000", "subsidy_btc": _BTC(_SATS), "subsidy_sats": _SATS}, {"halving_interval": f"{_H100} div 210000", "subsidy_sats": _SATS, "subsidy_btc": f"cast({_BTC(_SATS)} as double)"}
    ),
    "bitcoin_network_hashrate_estimate": _derived(
        {"difficulty": _VALUE, "hashrate_hs": _text(f"{_money('o_totalprice')} * 2"), "observed_interval_seconds": "o_custkey + 1"},
        {"difficulty": f"cast({_money('o_totalprice')} as double)", "observed_interval_seconds": "o_custkey + 1", "hashrate_hs": f"cast({_money('o_totalprice')} * 2 as double)"},
    ),
    "bitcoin_circulating_supply": _derived(
        {"circulating_supply_btc": _BTC("(o_orderkey * 5000000)"), "circulating_supply_sats": "o_orderkey * 5000000"}, {"circulating_supply_sats": "o_orderkey * 5000000", "circulating_supply_btc": f"cast({_BTC('(o_orderkey * 5000000)')} as double)"}
    ),
}


def log_of(spark: SparkSession, d: str, dataset: str) -> DataFrame:
    """The dataset's events in their envelopes, ingested an hour after their time."""
    spec, m = DATASETS[dataset], MADE[dataset]
    payload = "to_json(named_struct(" + ", ".join(f"'{n}', {in_spark(e)}" for n, e in sorted(m.fields.items())) + "))"
    time = "ts" if m.table == "events" else m.at
    rows = table(spark, d, m.table).select(
        F.lit(spec.source).alias("source_id"), F.lit(dataset).alias("stream_id"), F.expr(f"cast(cast({m.at} as date) as string)").alias("partition_id"), F.expr(m.offset).alias("source_offset"),
        F.expr(m.at).alias("source_event_time"), F.expr(payload).alias("payload_json"), F.expr(f"cast({time} as timestamp) + interval 1 hour").alias("g"),
    )
    return eventlog.envelope(rows, F.col("g"))


def native_of(spark: SparkSession, d: str, dataset: str) -> DataFrame:
    return native_rows(log_of(spark, d, dataset), dataset)


def buckets_of(spark: SparkSession, d: str, dataset: str) -> DataFrame:
    return aligned.bucketise(log_of(spark, d, dataset))


def native_sql(dataset: str) -> str:
    m = MADE[dataset]
    return f"select {', '.join(f'{duck(e)} as {n if n != 'values' else chr(34) + n + chr(34)}' for n, e in m.native.items())} from {m.table}"


def uuid5_sql(name: str) -> str:
    h = f"sha1(unhex('{EVENT_NAMESPACE.hex}') || encode({name}))"
    return f"(select h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', (position(h[17:17] in '0123456789abcdef') - 1) % 4 + 1, 1) || h[18:20] || '-' || h[21:32] from (select {h} as h))"


def events_sql(dataset: str) -> str:
    """The log's rows with the payload's fields as columns, prefixed by f_, as a CTE named made."""
    spec, m = DATASETS[dataset], MADE[dataset]
    at, time = duck(m.at), "ts" if m.table == "events" else duck(m.at)
    fields = ", ".join(f"{duck(e)} as f_{n}" for n, e in m.fields.items())
    name = f"'1|{spec.source}|{dataset}|' || cast(cast({at} as date) as varchar) || '|' || {duck(m.offset)}"
    return f"made as (select cast(cast({at} as date) as varchar) as partition_id, {duck(m.offset)} as source_offset, {at} as t, cast({time} as timestamp) + interval 1 hour as ingested_at, {name} as name, {fields} from {m.table})"


def _bounds(dataset: str) -> str:
    low, high = (f"timestamp '{x[:10]}'" for x in MADE[dataset].week)
    return f">= {low} and {{c}} < {high}"


def _register(number: int, dataset: str) -> None:
    spec, m = DATASETS[dataset], MADE[dataset]
    query(f"prj_{number:02}_{dataset}", native_sql(dataset))(lambda spark, d: native_of(spark, d, dataset))

    shown = list(dict.fromkeys([*spec.default_columns, spec.time_column]))
    where = _bounds(dataset).format(c=spec.time_column)
    query(f"src_03_{dataset}", f"select {', '.join(shown)} from ({native_sql(dataset)}) where {spec.time_column} {where}")(
        lambda spark, d: native.query_native(native_of(spark, d, dataset), dataset, TimeRange(*m.week))
    )

    first = f"with {events_sql(dataset)}, ids as (select *, {uuid5_sql('name')} as id from made)"
    query(
        f"prj_{number + 12}_{dataset}_buckets",
        f"""{first} select partition_id, date_trunc('second', t) as aligned_at_utc, count(*) as bucket_event_count, min(struct_pack(a := t, i := id)).i as first_event_id, max(struct_pack(a := t, i := id)).i as last_event_id,
        arg_min(source_offset, struct_pack(a := t, i := id)) as first_source_offset, arg_max(source_offset, struct_pack(a := t, i := id)) as last_source_offset, arg_max(ingested_at, struct_pack(a := t, i := id)) as latest_ingested_at_utc from ids group by 1, 2""",
    )(lambda spark, d: buckets_of(spark, d, dataset).select("partition_id", "aligned_at_utc", "bucket_event_count", "first_event_id", "last_event_id", "first_source_offset", "last_source_offset", "latest_ingested_at_utc"))


for _n, _dataset in enumerate(DATASETS, 1):
    _register(_n, _dataset)


# --- identity ---------------------------------------------------------------------------------------------------------


@query("fn_uuid5", f"with {events_sql('binance_spot_trades')} select source_offset, {uuid5_sql('name')} as event_id from made")
def _(spark, d):
    return log_of(spark, d, "binance_spot_trades").select("source_offset", "event_id")


@query(
    "fn_payload_bytes",
    f"""with {events_sql('okx_spot_trades')} select source_offset, sha256('{{"instrument_name":"' || f_instrument_name || '","price":"' || f_price || '","side":"' || f_side || '","size":"' || f_size || '","timestamp":' || f_timestamp || ',"trade_id":' || f_trade_id || '}}') as payload_sha256 from made""",
)
def _(spark, d):
    return log_of(spark, d, "okx_spot_trades").select("source_offset", "payload_sha256")


# --- aligned readers --------------------------------------------------------------------------------------------------

_SECONDS = """select date_trunc('second', t) as aligned_at_utc, cast(arg_min(cast(f_price as decimal(38, 12)), cast(source_offset as bigint)) as double) as open_price, cast(max(cast(f_price as decimal(38, 12))) as double) as high_price,
  cast(min(cast(f_price as decimal(38, 12))) as double) as low_price, cast(arg_max(cast(f_price as decimal(38, 12)), cast(source_offset as bigint)) as double) as close_price,
  cast(sum(cast(f_size as decimal(38, 12))) as double) as quantity_sum, cast(sum(cast(f_price as decimal(18, 2)) * cast(f_size as decimal(18, 2))) as double) as quote_volume_sum, count(*) as trade_count from made group by 1"""

for _dataset in ("okx_spot_trades", "bybit_spot_trades"):
    query(f"agg_19_{_dataset}", f"with {events_sql(_dataset)} {_SECONDS}")(lambda spark, d, name=_dataset: aligned.query_aligned(buckets_of(spark, d, name), name, AllRows()))


@query(
    "agg_20_header_buckets",
    f"""with {events_sql('bitcoin_block_headers')} select t as aligned_at_utc, count(*) as records_in_bucket, max(f_height) as latest_height, arg_max(f_block_hash, f_height) as latest_block_hash, arg_max(f_prev_hash, f_height) as latest_prev_hash,
  arg_max(f_nonce, f_height) as latest_nonce, cast(arg_max(f_difficulty, f_height) as double) as latest_difficulty, arg_max(f_timestamp_ms, f_height) as latest_timestamp_ms from made group by partition_id, t""",
)
def _(spark, d):
    columns = ["aligned_at_utc", "records_in_bucket", "latest_height", "latest_block_hash", "latest_prev_hash", "latest_nonce", "latest_difficulty", "latest_timestamp_ms"]
    return aligned.query_aligned(buckets_of(spark, d, "bitcoin_block_headers"), "bitcoin_block_headers", AllRows(), columns)


_IN, _OUT = "cast(json_extract_string(f_values_json, '$.input_value_btc_sum') as decimal(18, 2))", "cast(json_extract_string(f_values_json, '$.output_value_btc_sum') as decimal(18, 2))"


@query(
    "agg_21_transaction_buckets",
    f"""with {events_sql('bitcoin_block_transactions')}, k as (select *, struct_pack(h := f_block_height, i := f_transaction_index, t := f_txid) as o from made) select t as aligned_at_utc, count(*) as tx_count, count(*) filter (f_coinbase) as coinbase_tx_count,
  cast(sum({_IN}) as double) as total_input_value_btc, cast(sum({_OUT}) as double) as total_output_value_btc, min(o).h as first_block_height, max(o).h as last_block_height, max(o).t as latest_txid from k group by partition_id, t""",
)
def _(spark, d):
    columns = ["aligned_at_utc", "tx_count", "coinbase_tx_count", "total_input_value_btc", "total_output_value_btc", "first_block_height", "last_block_height", "latest_txid"]
    return aligned.query_aligned(buckets_of(spark, d, "bitcoin_block_transactions"), "bitcoin_block_transactions", AllRows(), columns)


@query(
    "agg_22_mempool_buckets",
    f"""with {events_sql('bitcoin_mempool_state')}, k as (select *, cast(f_fee_rate_sat_vb as decimal(18, 2)) as fee from made) select t as aligned_at_utc, count(*) as tx_count, cast(min(fee) as double) as fee_rate_sat_vb_min, cast(max(fee) as double) as fee_rate_sat_vb_max,
  cast(sum(fee) as double) / count(*) as fee_rate_sat_vb_avg, cast(sum(f_vsize) as bigint) as total_vsize, min(f_first_seen_timestamp) as first_seen_timestamp_min, max(f_first_seen_timestamp) as first_seen_timestamp_max,
  count(*) filter (f_rbf_flag) as rbf_true_count, max(f_txid) as latest_txid from k group by partition_id, t""",
)
def _(spark, d):
    columns = ["aligned_at_utc", "tx_count", "fee_rate_sat_vb_min", "fee_rate_sat_vb_max", "fee_rate_sat_vb_avg", "total_vsize", "first_seen_timestamp_min", "first_seen_timestamp_max", "rbf_true_count", "latest_txid"]
    return aligned.query_aligned(buckets_of(spark, d, "bitcoin_mempool_state"), "bitcoin_mempool_state", AllRows(), columns)


@query(
    "agg_23_derived_buckets",
    f"""with {events_sql('bitcoin_block_fee_totals')} select t as aligned_at_utc, 'block_fee_total_btc' as metric_name, 'BTC' as metric_unit, cast(arg_max(f_fee_total_btc, cast(source_offset as bigint)) as double) as metric_value_float,
  max(ingested_at) as latest_ingested_at_utc, count(*) as records_in_bucket from made group by partition_id, t""",
)
def _(spark, d):
    columns = ["aligned_at_utc", "metric_name", "metric_unit", "metric_value_float", "latest_ingested_at_utc", "records_in_bucket"]
    return aligned.query_aligned(buckets_of(spark, d, "bitcoin_block_fee_totals"), "bitcoin_block_fee_totals", AllRows(), columns)


_OBSERVED = f"""{events_sql('etf_daily_metrics')}, k as (select *, struct_pack(g := ingested_at, o := source_offset) as o from made),
l as (select t as aligned_at_utc, f_record_source_id as source_id, f_metric_name as metric_name, max(o) as o, count(*) as records_in_bucket from k group by 1, 2, 3),
observed as (select l.aligned_at_utc, l.source_id, l.metric_name, k.f_metric_value_text as metric_value_string, case when k.f_metric_value_kind = 'int' then cast(k.f_metric_value_text as bigint) end as metric_value_int,
  case when k.f_metric_value_kind in ('int', 'float') then cast(k.f_metric_value_text as double) end as metric_value_float, cast(k.f_metric_value_bool as int) as metric_value_bool, l.o.g as latest_ingested_at_utc, l.records_in_bucket
  from l join k on k.o = l.o and k.t = l.aligned_at_utc and k.f_record_source_id = l.source_id and k.f_metric_name = l.metric_name)"""
_OBSERVED_COLUMNS = ["aligned_at_utc", "source_id", "metric_name", "metric_value_string", "metric_value_int", "metric_value_float", "metric_value_bool", "latest_ingested_at_utc", "records_in_bucket"]

for _dataset in ("etf_daily_metrics", "fred_series_metrics"):
    query(f"agg_24_{_dataset}", f"with {_OBSERVED} select * from observed")(lambda spark, d, name=_dataset: aligned.query_aligned(buckets_of(spark, d, name), name, AllRows(), _OBSERVED_COLUMNS))


@query(
    "src_06_metrics_filled",
    f"""with {_OBSERVED}, known as (select * from observed where aligned_at_utc {_bounds('etf_daily_metrics').format(c='aligned_at_utc')} union all
  select unnest(max_by(observed, aligned_at_utc)) from observed where aligned_at_utc < timestamp '2024-01-08' group by source_id, metric_name),
led as (select *, coalesce(lead(aligned_at_utc) over (partition by source_id, metric_name order by aligned_at_utc), timestamp '2024-01-15') as following from known)
select source_id, metric_name, metric_value_string, greatest(aligned_at_utc, timestamp '2024-01-08') as valid_from_utc, least(following, timestamp '2024-01-15') as valid_to_utc_exclusive from led where following > timestamp '2024-01-08'""",
)
def _(spark, d):
    return aligned.query_aligned(buckets_of(spark, d, "etf_daily_metrics"), "etf_daily_metrics", TimeRange(*_EVENT_WEEK), ["source_id", "metric_name", "metric_value_string", "valid_from_utc", "valid_to_utc_exclusive"])


@query(
    "src_06_derived_filled",
    f"""with {events_sql('bitcoin_circulating_supply')}, b as (select t, cast(arg_max(f_circulating_supply_btc, cast(source_offset as bigint)) as double) as v from made group by t),
known as (select * from b where t {_bounds('bitcoin_circulating_supply').format(c='t')} union all select max(t), arg_max(v, t) from b where t < timestamp '1995-01-01' having max(t) is not null),
led as (select *, coalesce(lead(t) over (order by t), timestamp '1995-03-01') as following from known)
select v as metric_value_float, greatest(t, timestamp '1995-01-01') as valid_from_utc, least(following, timestamp '1995-03-01') as valid_to_utc_exclusive from led where following > timestamp '1995-01-01'""",
)
def _(spark, d):
    return aligned.query_aligned(buckets_of(spark, d, "bitcoin_circulating_supply"), "bitcoin_circulating_supply", TimeRange(*_ORDER_WEEK), ["metric_value_float", "valid_from_utc", "valid_to_utc_exclusive"])


@query("src_06_stream_range", f"with {events_sql('bitcoin_block_headers')} select t as aligned_at_utc, count(*) as records_in_bucket, max(f_height) as latest_height from made where t {_bounds('bitcoin_block_headers').format(c='t')} group by t")
def _(spark, d):
    return aligned.query_aligned(buckets_of(spark, d, "bitcoin_block_headers"), "bitcoin_block_headers", TimeRange(*_ORDER_WEEK), ["aligned_at_utc", "records_in_bucket", "latest_height"])


@query(
    "top_03_latest_buckets",
    f"""with {events_sql('okx_spot_trades')}, ids as (select *, {uuid5_sql('name')} as id from made), b as (select t, arg_min(source_offset, struct_pack(a := t, i := id)) as f, count(*) as trade_count from ids group by t)
select t as aligned_at_utc, trade_count from b order by t desc, f desc limit 25""",
)
def _(spark, d):
    return aligned.query_aligned(buckets_of(spark, d, "okx_spot_trades"), "okx_spot_trades", LatestRows(25), ["aligned_at_utc", "trade_count"])


@query(
    "top_04_random_buckets",
    f"""with {events_sql('bitcoin_mempool_state')}, ids as (select *, {uuid5_sql('name')} as id from made), r as (select t, '{{"event_id":"' || id || '","ingested_at_utc":"' || strftime(ingested_at, '%Y-%m-%dT%H:%M:%S') ||
    case when epoch_us(ingested_at) % 1000000 = 0 then '' else '.' || lpad(cast(epoch_us(ingested_at) % 1000000 as varchar), 6, '0') end || '+00:00","payload_json":"' || replace(p, '"', '\\"') || '","payload_sha256_raw":"' || sha256(p) ||
    '","source_event_time_utc":"' || strftime(t, '%Y-%m-%dT%H:%M:%S') || '+00:00","source_offset_or_equivalent":"' || source_offset || '"}}' as j, id from (select *, '{{"fee_rate_sat_vb":"' || f_fee_rate_sat_vb || '","first_seen_timestamp":' || f_first_seen_timestamp ||
    ',"rbf_flag":' || f_rbf_flag || ',"snapshot_at_unix_ms":' || f_snapshot_at_unix_ms || ',"source_chain":"main","txid":"' || f_txid || '","vsize":' || f_vsize || '}}' as p from ids)),
b as (select t, count(*) as tx_count, sha256('{{"rows":[' || string_agg(j, ',' order by id) || ']}}') as sha from r group by t)
select t as aligned_at_utc, tx_count, sha as bucket_sha256 from b order by md5(epoch_us(t) // 1000 || '|' || sha), sha limit 25""",
)
def _(spark, d):
    return aligned.query_aligned(buckets_of(spark, d, "bitcoin_mempool_state"), "bitcoin_mempool_state", RandomRows(25), ["aligned_at_utc", "tx_count", "bucket_sha256"])
