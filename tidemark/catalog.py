"""The closed catalogue: twelve datasets, their columns, time columns, bucket modes, partitions and number precision.

All values here are fixed values: they name the tables and fields that sources and clients agree on.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Dataset:
    name: str
    source: str
    table: str
    id_column: str
    time_column: str
    seed_column: str
    schema: str
    default_columns: tuple[str, ...]
    bucket_mode: str  # exchange, stream, derived or metrics
    partition_scheme: str  # daily or height_range
    offset_ordering: str  # numeric, numeric_monotonic or lexicographic
    rank: int
    phase: str
    earliest: date | int | None = None
    max_concurrent: int | None = None
    min_interval_seconds: float | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(StructType.fromDDL(self.schema).fieldNames())

    @property
    def forward_fills(self) -> bool:
        return self.bucket_mode in ("derived", "metrics")


_METRICS = (
    "metric_id string, source_id string, metric_name string, metric_unit string, metric_value_string string, metric_value_int long, metric_value_float double, "
    "metric_value_bool boolean, observed_at_utc timestamp, dimensions_json string, provenance_json string, ingested_at_utc timestamp"
)
_METRIC_DEFAULTS = ("source_id", "metric_name", "metric_unit", "metric_value_float", "metric_value_int", "metric_value_string", "observed_at_utc")


def _height(name: str, columns: str, defaults: str, rank: int) -> Dataset:
    return Dataset(
        name, "bitcoin_core", f"canonical_{name}_native_v1", "block_height", "datetime", "block_timestamp",
        f"block_height long, block_hash string, block_timestamp long, {columns}, datetime timestamp, source_chain string",
        ("block_height", "block_timestamp", *defaults.split()), "derived", "height_range", "numeric", rank, "bitcoin_derived", 0,
    )


DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset(
            "binance_spot_trades", "binance", "canonical_binance_spot_trades_native_v1", "trade_id", "datetime", "timestamp",
            "trade_id long, timestamp long, price double, quantity double, quote_quantity double, is_buyer_maker byte, is_best_match byte, datetime timestamp",
            ("trade_id", "timestamp", "price", "quantity", "is_buyer_maker"), "exchange", "daily", "numeric", 1, "exchange_primary", date(2017, 8, 17), 20,
        ),
        Dataset(
            "okx_spot_trades", "okx", "canonical_okx_spot_trades_native_v1", "trade_id", "datetime", "timestamp",
            "instrument_name string, trade_id long, side string, price double, size double, quote_quantity double, timestamp long, datetime timestamp",
            ("trade_id", "timestamp", "price", "size", "side"), "exchange", "daily", "numeric_monotonic", 2, "exchange_parallel", date(2021, 9, 1), 20, 0.75,
        ),
        Dataset(
            "bybit_spot_trades", "bybit", "canonical_bybit_spot_trades_native_v1", "trade_id", "datetime", "timestamp",
            "symbol string, trade_id long, trd_match_id string, side string, price double, size double, quote_quantity double, timestamp long, datetime timestamp, "
            "tick_direction string, gross_value double, home_notional double, foreign_notional double",
            ("trade_id", "timestamp", "price", "size", "side", "trd_match_id"), "exchange", "daily", "lexicographic", 3, "exchange_parallel", date(2020, 3, 25), 20,
        ),
        Dataset(
            "etf_daily_metrics", "etf", "canonical_etf_daily_metrics_native_v1", "metric_id", "observed_at_utc", "observed_at_utc",
            _METRICS, _METRIC_DEFAULTS, "metrics", "daily", "lexicographic", 4, "etf", date(2024, 1, 11),
        ),
        Dataset(
            "fred_series_metrics", "fred", "canonical_fred_series_metrics_native_v1", "metric_id", "observed_at_utc", "observed_at_utc",
            _METRICS, _METRIC_DEFAULTS, "metrics", "daily", "lexicographic", 5, "fred",
        ),
        Dataset(
            "bitcoin_block_headers", "bitcoin_core", "canonical_bitcoin_block_headers_native_v1", "height", "datetime", "timestamp",
            "height long, block_hash string, prev_hash string, merkle_root string, version int, nonce long, difficulty double, timestamp long, datetime timestamp, source_chain string",
            ("height", "timestamp", "difficulty", "nonce", "version", "merkle_root", "prev_hash"), "stream", "height_range", "numeric", 6, "bitcoin_base", 0,
        ),
        Dataset(
            "bitcoin_block_transactions", "bitcoin_core", "canonical_bitcoin_block_transactions_native_v1", "txid", "datetime", "block_timestamp",
            "block_height long, block_hash string, block_timestamp long, transaction_index long, txid string, inputs string, outputs string, values string, scripts string, "
            "witness_data string, coinbase byte, datetime timestamp, source_chain string",
            ("block_height", "block_timestamp", "transaction_index", "txid", "coinbase"), "stream", "height_range", "lexicographic", 7, "bitcoin_base", 0,
        ),
        Dataset(
            "bitcoin_mempool_state", "bitcoin_core", "canonical_bitcoin_mempool_state_native_v1", "txid", "snapshot_at", "snapshot_at_unix_ms",
            "snapshot_at timestamp, snapshot_at_unix_ms long, txid string, fee_rate_sat_vb double, vsize long, first_seen_timestamp long, rbf_flag byte, source_chain string",
            ("snapshot_at_unix_ms", "txid", "fee_rate_sat_vb", "vsize", "first_seen_timestamp", "rbf_flag"), "stream", "daily", "lexicographic", 8, "bitcoin_base",
        ),
        _height("bitcoin_block_fee_totals", "fee_total_btc double", "fee_total_btc", 9),
        _height("bitcoin_block_subsidy_schedule", "halving_interval long, subsidy_sats long, subsidy_btc double", "halving_interval subsidy_sats subsidy_btc", 10),
        _height("bitcoin_network_hashrate_estimate", "difficulty double, observed_interval_seconds long, hashrate_hs double", "difficulty observed_interval_seconds hashrate_hs", 11),
        _height("bitcoin_circulating_supply", "circulating_supply_sats long, circulating_supply_btc double", "circulating_supply_sats circulating_supply_btc", 12),
    )
}

#: Columns that an aligned query may select, by bucket mode (streams by dataset).
OHLC = ("aligned_at_utc", "open_price", "high_price", "low_price", "close_price", "quantity_sum", "quote_volume_sum", "trade_count")
OBSERVATION = (
    "aligned_at_utc", "source_id", "metric_name", "metric_unit", "metric_value_string", "metric_value_int", "metric_value_float", "metric_value_bool",
    "dimensions_json", "provenance_json", "latest_ingested_at_utc", "records_in_bucket",
)
VALIDITY = ("valid_from_utc", "valid_to_utc_exclusive")
_BUCKET_TAIL = ("latest_ingested_at_utc", "first_source_offset_or_equivalent", "last_source_offset_or_equivalent", "bucket_sha256")
STREAM_COLUMNS = {
    "bitcoin_block_headers": (
        "aligned_at_utc", "records_in_bucket", "latest_height", "latest_block_hash", "latest_prev_hash", "latest_merkle_root", "latest_version", "latest_nonce",
        "latest_difficulty", "latest_timestamp_ms", "latest_source_chain", *_BUCKET_TAIL,
    ),
    "bitcoin_block_transactions": (
        "aligned_at_utc", "records_in_bucket", "tx_count", "coinbase_tx_count", "total_input_value_btc", "total_output_value_btc", "first_block_height",
        "last_block_height", "latest_block_timestamp_ms", "latest_txid", "latest_source_chain", *_BUCKET_TAIL,
    ),
    "bitcoin_mempool_state": (
        "aligned_at_utc", "records_in_bucket", "tx_count", "fee_rate_sat_vb_min", "fee_rate_sat_vb_max", "fee_rate_sat_vb_avg", "total_vsize",
        "first_seen_timestamp_min", "first_seen_timestamp_max", "rbf_true_count", "latest_snapshot_at_unix_ms", "latest_txid", "latest_source_chain", *_BUCKET_TAIL,
    ),
}


def aligned_columns(dataset: str) -> tuple[str, ...]:
    mode = DATASETS[dataset].bucket_mode
    return OHLC if mode == "exchange" else STREAM_COLUMNS[dataset] if mode == "stream" else OBSERVATION + VALIDITY


#: Derived streams: metric name, unit and the payload field that holds the value.
DERIVED_METRICS = {
    "bitcoin_block_fee_totals": ("block_fee_total_btc", "BTC", "fee_total_btc"),
    "bitcoin_block_subsidy_schedule": ("block_subsidy_btc", "BTC", "subsidy_btc"),
    "bitcoin_network_hashrate_estimate": ("network_hashrate_hs", "H/s", "hashrate_hs"),
    "bitcoin_circulating_supply": ("btc_circulating_supply_btc", "BTC", "circulating_supply_btc"),
}

#: Numbers in payloads by (source, stream): field path -> None for whole numbers, or the decimal scale.
PRECISION: dict[tuple[str, str], dict[str, int | None]] = {
    ("binance", "binance_spot_trades"): {"trade_id": None, "price": 8, "qty": 8, "quote_qty": 8},
    ("okx", "okx_spot_trades"): {"trade_id": None, "price": 8, "size": 20, "timestamp": None},
    ("bybit", "bybit_spot_trades"): {"trade_id": None, "price": 15, "size": 15, "quote_quantity": 15, "timestamp": None, "gross_value": 15, "home_notional": 15, "foreign_notional": 15},
    ("bitcoin_core", "bitcoin_block_headers"): {"height": None, "version": None, "nonce": None, "difficulty": 18, "timestamp_ms": None},
    ("bitcoin_core", "bitcoin_block_transactions"): {"block_height": None, "block_timestamp_ms": None, "transaction_index": None},
    ("bitcoin_core", "bitcoin_mempool_state"): {"snapshot_at_unix_ms": None, "fee_rate_sat_vb": 18, "vsize": None, "first_seen_timestamp": None},
    ("bitcoin_core", "bitcoin_block_fee_totals"): {"block_height": None, "block_timestamp_ms": None, "fee_total_btc": 18, "metric_value": 18},
    ("bitcoin_core", "bitcoin_block_subsidy_schedule"): {"block_height": None, "block_timestamp_ms": None, "halving_interval": None, "subsidy_sats": None, "subsidy_btc": 18, "metric_value": 18},
    ("bitcoin_core", "bitcoin_network_hashrate_estimate"): {"block_height": None, "block_timestamp_ms": None, "difficulty": 18, "observed_interval_seconds": None, "hashrate_hs": 18, "metric_value": 18},
    ("bitcoin_core", "bitcoin_circulating_supply"): {"block_height": None, "block_timestamp_ms": None, "circulating_supply_sats": None, "circulating_supply_btc": 18, "metric_value": 18},
}

#: The event envelope, and one stored one-second bucket.
EVENT = (
    "envelope_version int, event_id string, source_id string, stream_id string, partition_id string, source_offset string, source_event_time timestamp, "
    "ingested_at timestamp, payload_content_type string, payload_encoding string, payload_raw binary, payload_sha256 string, payload_json string"
)
BUCKET = (
    "source_id string, stream_id string, partition_id string, aligned_at_utc timestamp, bucket_event_count long, first_event_id string, last_event_id string, "
    "first_source_offset string, last_source_offset string, latest_ingested_at_utc timestamp, payload_rows_json string, bucket_sha256 string"
)
