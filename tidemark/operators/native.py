"""Scans of typed native tables: columns, window, shape, filters, fields; one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import DATASETS, Dataset
from tidemark.operators.filters import apply_fields, apply_filters, require_columns, unique
from tidemark.plans.windows import Window, apply_native

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def iso_text(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text with milliseconds."""
    return df.withColumns({f.name: F.date_format(f.name, ISO) for f in df.schema if f.dataType.typeName().startswith("timestamp")})


def epoch_millis(ts: Column) -> Column:
    """Milliseconds of an epoch that may be in microseconds."""
    return F.when(ts < 10**13, ts).otherwise(F.floor(ts / 1000)).cast("long")


def query_native(table: DataFrame, dataset: Dataset | str, window: Window, select_columns: Sequence[str] | None = None, include_datetime: bool = True, iso: bool = False, filters: Sequence[Mapping[str, Any]] | None = None) -> DataFrame:
    """Rows of a native table in a window: whitelist or default columns, stable order by (time, id), then filters.

    Columns needed for the window and the order are read besides the requested ones and dropped at the end; nothing
    else is read. Filters see the windowed result's columns only.
    """
    spec = DATASETS[dataset] if isinstance(dataset, str) else dataset
    wanted = require_columns(spec.default_columns if select_columns is None else select_columns, spec.columns, spec.name)
    shown = unique([*wanted, spec.time_column]) if include_datetime else wanted
    read = unique([*shown, spec.time_column, spec.id_column, spec.seed_column])
    return _shaped(table, window, read, shown, spec.id_column, spec.time_column, spec.seed_column, iso, filters)


def query_table(table: DataFrame, window: Window, select_columns: Sequence[str], id_column: str, time_column: str = "datetime", seed_column: str | None = None, iso: bool = False, filters: Sequence[Mapping[str, Any]] | None = None) -> DataFrame:
    """The same over any table with an id and a time column."""
    wanted = require_columns(select_columns, table.columns, "table")
    read = unique([*wanted, time_column, id_column, seed_column or time_column])
    return _shaped(table, window, read, wanted, id_column, time_column, seed_column or time_column, iso, filters)


def _shaped(table, window, read, shown, id_column, time_column, seed_column, iso, filters) -> DataFrame:
    month = ["month"] if "month" in table.columns and "month" not in read else []
    df = apply_native(table.select(*read, *month), window, id_column, time_column, seed_column).select(*read)
    if "timestamp" in shown and dict(df.dtypes)["timestamp"] in ("bigint", "int"):
        df = df.withColumn("timestamp", epoch_millis(F.col("timestamp")))
    df = df.orderBy(time_column, id_column).select(*shown)
    return apply_filters(iso_text(df) if iso else df, filters)


def maker_flag(side: Column) -> Column:
    """0 for a buy and 1 for a sell; any other side fails."""
    low = F.lower(F.trim(side))
    return F.when(low == "buy", F.lit(0)).when(low == "sell", F.lit(1)).otherwise(F.raise_error(F.concat(F.lit("Unsupported side value in spot trades stream: "), F.coalesce(side, F.lit("null")))).cast("int"))


def spot_trades(table: DataFrame, dataset: str, window: Window, fields: Sequence[str] | None = None, filters: Sequence[Mapping[str, Any]] | None = None, include_datetime: bool = True) -> DataFrame:
    """Trades of any exchange in one shape: trade_id, timestamp, price, quantity, is_buyer_maker, datetime; filters first."""
    df = query_native(table, dataset, window)
    if "size" in df.columns:
        df = df.select("trade_id", "timestamp", "price", F.col("size").alias("quantity"), maker_flag(F.col("side")).alias("is_buyer_maker"), "datetime")
    df = df.select("trade_id", "timestamp", "price", "quantity", F.col("is_buyer_maker").cast("int").alias("is_buyer_maker"), *(["datetime"] if include_datetime else []))
    return apply_fields(apply_filters(df, filters), fields)
