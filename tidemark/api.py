"""The facade: historical data of every dataset, raw queries and exports over a root folder of tables."""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import BUCKET, DATASETS, OHLC
from tidemark.operators import aligned, bars, native, sinks
from tidemark.operators.filters import apply_fields, apply_filters, require_scalars
from tidemark.operators.serving import enforce_strict, rights_decision, window_warnings
from tidemark.plans.windows import resolve, resolve_historical
from tidemark.sources.exchange_csv import BINANCE, binance_trades, csv_lines

MODES = ("native", "aligned_1s")


class Tables:
    """Native tables and buckets under a root folder; or given as DataFrames, as in tests."""

    def __init__(self, spark: SparkSession, root: str | None = None, frames: Mapping[str, DataFrame] | None = None):
        self.spark, self.root, self.frames = spark, root, dict(frames or {})

    def native(self, dataset: str) -> DataFrame:
        spec = DATASETS[dataset]
        return self.frames[dataset] if dataset in self.frames else self.spark.read.schema(f"{spec.schema}, month string").parquet(f"{self.root}/{spec.table}")

    def buckets(self) -> DataFrame:
        return self.frames["aligned_1s"] if "aligned_1s" in self.frames else self.spark.read.schema(BUCKET).parquet(f"{self.root}/aligned_1s")


def _mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"Unsupported mode={mode!r}; expected native or aligned_1s")
    return mode


class HistoricalData:
    """get_* methods put their result into .data (a lazy DataFrame) and its columns into .data_columns."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.data: DataFrame | None = None
        self.data_columns: list[str] = []

    def _keep(self, df: DataFrame) -> DataFrame:
        self.data, self.data_columns = df, df.columns
        return df

    def _window(self, dataset: str, mode: str, strict: bool, start_date, end_date, n_latest_rows, n_random_rows):
        spec = DATASETS[dataset]
        table, column = (self.tables.native(dataset), spec.time_column) if _mode(mode) == "native" else (self.tables.buckets().where(F.col("stream_id") == dataset), "aligned_at_utc")
        window = resolve_historical(table, column, start_date, end_date, n_latest_rows, n_random_rows)
        enforce_strict(window_warnings(window), strict)
        return window

    def get_binance_file(self, path: str, has_header: bool = False) -> DataFrame:
        return self._keep(binance_trades(csv_lines(self.tables.spark, path, BINANCE, "sniffed" if has_header else "none")).orderBy("row_no").drop("row_no", "price_text", "quantity_text", "quote_quantity_text"))

    def spot_trades(self, source: str, mode: str = "native", start_date=None, end_date=None, n_latest_rows=None, n_random_rows=None, fields=None, filters=None, strict=False, include_datetime_col=True) -> DataFrame:
        dataset = f"{source}_spot_trades"
        window = self._window(dataset, mode, strict, start_date, end_date, n_latest_rows, n_random_rows)
        if mode == "native":
            return self._keep(native.spot_trades(self.tables.native(dataset), dataset, window, fields, filters, include_datetime_col))
        return self._keep(apply_fields(aligned.query_aligned(self.tables.buckets(), dataset, window, filters=filters, fields_first=False), fields))

    def spot_klines(self, source: str, mode: str = "native", start_date=None, end_date=None, n_latest_rows=None, n_random_rows=None, fields=None, filters=None, strict=False, kline_size: int = 1) -> DataFrame:
        dataset = f"{source}_spot_trades"
        window = self._window(dataset, mode, strict, start_date, end_date, n_latest_rows, n_random_rows)
        if mode == "native":
            own = {"quantity": "quantity"} if source == "binance" else {"quantity": "size", "maker": bars.side_maker()}
            return self._keep(bars.native_bars(self.tables.native(dataset), window, kline_size, fields=fields, filters=filters, **own))
        seconds = aligned.query_aligned(self.tables.buckets(), dataset, window, OHLC)
        return self._keep(bars.aligned_bars(seconds, kline_size, fields, filters))

    def dataset(self, name: str, mode: str = "native", start_date=None, end_date=None, n_latest_rows=None, n_random_rows=None, fields=None, filters=None, strict=False) -> DataFrame:
        window = self._window(name, mode, strict, start_date, end_date, n_latest_rows, n_random_rows)
        if mode == "native":
            df = apply_filters(native.query_native(self.tables.native(name), name, window, DATASETS[name].columns), filters)
        else:
            df = aligned.query_aligned(self.tables.buckets(), name, window, filters=filters, fields_first=False)
        return self._keep(apply_fields(df, fields))


def _named(method: str, *args: str):
    def get(self: HistoricalData, **options: Any) -> DataFrame:
        return getattr(self, method)(*args, **options)

    return get


for _source in ("binance", "okx", "bybit"):
    setattr(HistoricalData, f"get_{_source}_spot_trades", _named("spot_trades", _source))
    setattr(HistoricalData, f"get_{_source}_spot_klines", _named("spot_klines", _source))
for _name, _spec in DATASETS.items():
    if _spec.bucket_mode != "exchange":
        setattr(HistoricalData, f"get_{_name}", _named("dataset", _name))


class Busy(RuntimeError):
    """More requests wait than may."""


class Admission:
    """So many queries at once, and so many more that wait."""

    def __init__(self, running: int = 4, waiting: int = 16):
        self.slots, self.room, self.lock, self.inside = threading.Semaphore(running), running + waiting, threading.Lock(), 0

    @contextmanager
    def admitted(self):
        with self.lock:
            if self.inside >= self.room:
                raise Busy("query queue is full")
            self.inside += 1
        try:
            with self.slots:
                yield
        finally:
            with self.lock:
                self.inside -= 1


class Empty(LookupError):
    """The query has no rows."""


class Service:
    """Raw queries and exports by request dicts: rights, admission, one window at most, warnings, strict mode."""

    def __init__(self, tables: Tables, rights: dict | None = None, running: int = 4, waiting: int = 16):
        self.tables, self.rights = tables, rights
        self.gates = {mode: Admission(running, waiting) for mode in MODES}

    def frame(self, request: Mapping[str, Any]) -> tuple[DataFrame, list[dict], str, str]:
        sources = request.get("sources") or []
        if len(sources) != 1:
            raise ValueError("exactly one source must be given")
        dataset, mode, filters = sources[0], _mode(request.get("mode", "native")), request.get("filters")
        if dataset not in DATASETS:
            raise ValueError(f"unknown source: {dataset}")
        if filters:
            require_scalars(filters)
        if self.rights is not None:
            rights_decision(self.rights, dataset, request.get("auth_token"))
        window = resolve(request.get("month_year"), request.get("n_rows"), request.get("n_random"), request.get("time_range"))
        warnings = window_warnings(window)
        enforce_strict(warnings, bool(request.get("strict")))
        if mode == "native":
            df = native.query_native(self.tables.native(dataset), dataset, window, request.get("fields"), iso=True, filters=filters)
        else:
            df = aligned.query_aligned(self.tables.buckets(), dataset, window, request.get("fields"), iso=True, filters=filters)
        return df, warnings, mode, dataset

    def query(self, request: Mapping[str, Any]) -> dict:
        df, warnings, mode, dataset = self.frame(request)
        with self.gates[mode].admitted():
            out = sinks.envelope(df, mode, dataset, warnings)
        if not out["rows"]:
            raise Empty("no rows for this query")
        return out

    def export(self, request: Mapping[str, Any], folder: str, form: str = "parquet") -> dict:
        given: Sequence = [k for k in ("month_year", "n_rows", "n_random", "time_range") if request.get(k) is not None]
        if len(given) != 1:
            raise ValueError("an export needs exactly one window")
        df, _, mode, _ = self.frame(request)
        with self.gates[mode].admitted():
            return sinks.export(df, folder, form, {k: v for k, v in request.items() if k != "auth_token"})
