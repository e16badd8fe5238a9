"""Trade files of three exchanges: text columns read with a fixed schema, checked and typed by expressions.

Every reader takes a DataFrame of text columns with row_no (1 for the first data row) and partition_day, fails on the
first bad value with its row number when computed, and returns the exchange's typed rows with row_no.
"""

from __future__ import annotations

import io
import re
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.cluster import ship
from tidemark.functions.text import half_up_millis

#: The files' columns.
BINANCE = ("trade_id", "price", "quantity", "quote_quantity", "timestamp", "is_buyer_maker", "is_best_match")
OKX = ("instrument_name", "trade_id", "side", "price", "size", "created_time")
BYBIT = ("timestamp", "symbol", "side", "size", "price", "tickDirection", "trdMatchID", "grossValue", "homeNotional", "foreignNotional")
BYBIT_OPTIONAL = "RPI"
DAY_MS = 86_400_000


def csv_lines(spark: SparkSession, path: str, columns: tuple[str, ...], header: str, optional: tuple[str, ...] = ()) -> DataFrame:
    """Lines of files, plain or zipped, as text columns with file and row_no. header: required, none or sniffed.

    A file is one row here, as row numbers need its order; files are days, dealt out over the cluster.
    """
    names = [*columns, *optional]
    schema = ", ".join(f"`{c}` string" for c in names) + ", file string, row_no long"

    def rows(frames):
        for frame in frames:
            for path_, content in zip(frame["path"], frame["content"]):
                if content[:2] == b"PK":
                    archive = zipfile.ZipFile(io.BytesIO(content))
                    content = archive.read(archive.namelist()[0])
                lines = content.decode("utf-8-sig").splitlines()
                start = 0
                if header != "none" and lines:
                    first = tuple(x.strip() for x in lines[0].split(","))
                    if first[: len(columns)] == columns and set(first[len(columns) :]) <= set(optional):
                        start = 1
                    elif header == "required":
                        raise ValueError(f"{path_}: unexpected header {lines[0]!r}")
                    elif not re.match(r"\s*[0-9]", lines[0]):
                        start = 1
                out = []
                for n, line in enumerate(lines[start:], 1):
                    cells = [x.strip() for x in line.split(",")]
                    if not len(columns) <= len(cells) <= len(names):
                        raise ValueError(f"{path_}: row {n} has {len(cells)} columns")
                    out.append([*cells, *[None] * (len(names) - len(cells)), path_, n])
                yield pd.DataFrame(out, columns=[*names, "file", "row_no"])

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, schema)


def _checked(value: Column, ok: Column, what: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.concat(F.lit(f"bad {what} in row "), F.col("row_no").cast("string"))))


def whole(c: str) -> Column:
    t = F.trim(F.col(c))
    return _checked(t.try_cast("long"), t.rlike(r"^[0-9]+$") & t.try_cast("long").isNotNull(), c)


def decimal_text(c: str) -> Column:
    """The number as the file has it, digit for digit."""
    t = F.trim(F.col(c))
    return _checked(t, t.rlike(r"^[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"), c)


def decimal(c: str) -> Column:
    return decimal_text(c).try_cast("double")


def texts(*columns: str) -> list[Column]:
    """<name>_text of each number: payloads are made of these, never of doubles."""
    return [decimal_text(c).alias(f"{c}_text") for c in columns]


def flag(c: str) -> Column:
    t = F.lower(F.trim(F.col(c)))
    return _checked(t == "true", t.isin("true", "false"), c)


def millis(c: str) -> Column:
    n = whole(c)
    return F.when(n < 10**13, n).otherwise(F.floor(n / 1000)).cast("long")


def _in_day(ms: Column, start: Column) -> Column:
    first = F.unix_millis(start.cast("timestamp"))
    return _checked(ms, (ms >= first) & (ms < first + DAY_MS), "timestamp (outside of the day)")


def binance_trades(lines: DataFrame, day: str | None = None) -> DataFrame:
    """Ids, decimals, true/false text; time in milliseconds or microseconds; within the UTC day, if one is given."""
    ms = millis("timestamp") if day is None else _in_day(millis("timestamp"), F.lit(day).cast("date"))
    return lines.select(
        whole("trade_id").alias("trade_id"), decimal("price").alias("price"), decimal("quantity").alias("quantity"), decimal("quote_quantity").alias("quote_quantity"), ms.alias("timestamp"),
        flag("is_buyer_maker").cast("byte").alias("is_buyer_maker"), flag("is_best_match").cast("byte").alias("is_best_match"), F.timestamp_millis(ms).alias("datetime"), "row_no", *texts("price", "quantity", "quote_quantity"),
    )


def okx_trades(lines: DataFrame, instrument: str = "BTC-USDT", day: str | None = None) -> DataFrame:
    """One instrument; buy or sell; 13-digit milliseconds, within the source's day, which starts at 16:00 UTC."""
    name, t, side = F.trim("instrument_name"), F.trim("created_time"), F.lower(F.trim("side"))
    ms = _checked(t.try_cast("long"), t.rlike(r"^[0-9]{13}$"), "created_time")
    if day is not None:
        ms = _in_day(ms, F.lit(day).cast("date").cast("timestamp") - F.expr("interval 8 hours"))
    price, size = decimal("price"), decimal("size")
    return lines.select(
        _checked(name, name == instrument, "instrument_name").alias("instrument_name"), whole("trade_id").alias("trade_id"), _checked(side, side.isin("buy", "sell"), "side").alias("side"),
        price.alias("price"), size.alias("size"), (price * size).alias("quote_quantity"), ms.alias("timestamp"), F.timestamp_millis(ms).alias("datetime"), "row_no", *texts("price", "size"),
    )


_UUID = r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"


def bybit_trades(lines: DataFrame, symbol: str = "BTCUSDT", day: str | None = None) -> DataFrame:
    """Decimal seconds, half up to milliseconds; the id is the digits of m-<digits>, or the row's number from 0 for a UUID."""
    match = F.trim("trdMatchID")
    trade_id = F.when(match.rlike("^m-[0-9]+$"), F.substring(match, 3, 30).try_cast("long")).when(match.rlike(_UUID), F.col("row_no") - 1)
    side, name, t = F.lower(F.trim("side")), F.trim("symbol"), F.trim("timestamp")
    ms = _checked(half_up_millis(t), t.rlike(r"^[0-9]+(\.[0-9]+)?$"), "timestamp")
    if day is not None:
        ms = _in_day(ms, F.lit(day).cast("date"))
    price, size = decimal("price"), decimal("size")
    return lines.select(
        _checked(name, name == symbol, "symbol").alias("symbol"), _checked(trade_id, trade_id.isNotNull(), "trdMatchID").alias("trade_id"), match.alias("trd_match_id"),
        _checked(side, side.isin("buy", "sell"), "side").alias("side"), price.alias("price"), size.alias("size"), (price * size).alias("quote_quantity"), ms.alias("timestamp"),
        F.timestamp_millis(ms).alias("datetime"), F.trim("tickDirection").alias("tick_direction"), decimal("grossValue").alias("gross_value"), decimal("homeNotional").alias("home_notional"),
        decimal("foreignNotional").alias("foreign_notional"), "row_no", *texts("price", "size", "grossValue", "homeNotional", "foreignNotional"),
    )


#: The payloads' fields, in their order, and where each comes from; numbers come as the file's text. Fixed values.
_PAYLOADS = {
    "binance": {"is_best_match": "is_best_match", "is_buyer_maker": "is_buyer_maker", "price": "price_text", "qty": "quantity_text", "quote_qty": "quote_quantity_text", "trade_id": "trade_id"},
    "okx": {"instrument_name": "instrument_name", "price": "price_text", "side": "side", "size": "size_text", "timestamp": "timestamp", "trade_id": "trade_id"},
    "bybit": {
        "foreign_notional": "foreignNotional_text", "gross_value": "grossValue_text", "home_notional": "homeNotional_text", "price": "price_text", "quote_quantity": "foreignNotional_text", "side": "side",
        "size": "size_text", "symbol": "symbol", "tick_direction": "tick_direction", "timestamp": "timestamp", "trd_match_id": "trd_match_id", "trade_id": "trade_id",
    },
}


def payload_events(trades: DataFrame, exchange: str, partition: Column) -> DataFrame:
    """Rows for the event log: identity columns, event time and the payload as JSON, numbers as the file has them.

    The offset is the trade's id; Bybit's is the match id, as its ids are no numbers.
    """
    cell = lambda n, c: (F.col(c).cast("boolean") if n.startswith("is_") else F.col(c)).alias(n)
    payload = F.to_json(F.struct(*(cell(n, c) for n, c in _PAYLOADS[exchange].items())))
    offset = F.col("trd_match_id") if exchange == "bybit" else F.col("trade_id").cast("string")
    return trades.select(
        F.lit(exchange).alias("source_id"), F.lit(f"{exchange}_spot_trades").alias("stream_id"), partition.alias("partition_id"), offset.alias("source_offset"),
        F.col("datetime").alias("source_event_time"), payload.alias("payload_json"),
    )
