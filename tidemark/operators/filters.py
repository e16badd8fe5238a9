"""Projection by fields and the eight filter operators; both check their columns before a plan is made."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, date, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_COMPARE = {
    "eq": lambda c, v: c == F.lit(v), "ne": lambda c, v: c != F.lit(v), "gt": lambda c, v: c > F.lit(v), "gte": lambda c, v: c >= F.lit(v),
    "lt": lambda c, v: c < F.lit(v), "lte": lambda c, v: c <= F.lit(v), "in": lambda c, v: c.isin(list(v)), "not_in": lambda c, v: ~c.isin(list(v)),
}
OPERATORS = tuple(_COMPARE)


def normalise(filters: Sequence[Mapping[str, Any]]) -> list[tuple[str, str, Any]]:
    """Checked (field, op, value) clauses."""
    out = []
    for k, clause in enumerate(filters):
        field, op = clause.get("field"), clause.get("op")
        if not isinstance(field, str) or not field.strip():
            raise ValueError(f"filters[{k}].field must be a non-empty string")
        if op not in _COMPARE:
            raise ValueError(f"filters[{k}].op must be one of {sorted(OPERATORS)}")
        if "value" not in clause:
            raise ValueError(f"filters[{k}].value must be provided")
        value = clause["value"]
        if op in ("in", "not_in") and (not isinstance(value, list) or not value):
            raise ValueError(f"filters[{k}].value must be a non-empty list when op={op}")
        out.append((field.strip(), op, value))
    return out


def require_scalars(filters: Sequence[Mapping[str, Any]]) -> None:
    """What requests from outside must also hold: single values for all operators but the list ones."""
    for k, (_, op, value) in enumerate(normalise(filters)):
        if op not in ("in", "not_in") and isinstance(value, list | dict | tuple | set):
            raise ValueError(f"filters[{k}].value must be a scalar when op={op}")


def condition(field: str, op: str, value: Any) -> Column:
    return _COMPARE[op](F.col(f"`{field}`"), value)


def apply_filters(df: DataFrame, filters: Sequence[Mapping[str, Any]] | None) -> DataFrame:
    """All clauses, after the window: a row limit below them stays below them. A null never passes, not even ne or not_in."""
    for k, (field, op, value) in enumerate(normalise(filters or ())):
        if field not in df.columns:
            raise ValueError(f"filters[{k}].field is not available in result columns: {field}")
        kind = df.schema[field].dataType
        values = value if isinstance(value, list) else [value]
        if isinstance(kind, StringType) != all(isinstance(v, str) for v in values) and not (kind.typeName().startswith(("timestamp", "date")) and all(not isinstance(v, bool | int | float) for v in values)):
            raise ValueError(f"Invalid filter at filters[{k}] for field={field}, op={op}: {kind.simpleString()} cannot be compared with {value!r}")
        df = df.where(condition(field, op, value))
    return df


def in_tuples(df: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose columns' tuple is one of wanted's: a semi join, of which Spark sends the smaller side if it is small."""
    return df.join(wanted.select(*columns).distinct(), list(columns), "left_semi")


def on_days(df: DataFrame, time_column: str, days: Sequence[date]) -> DataFrame:
    """Rows of some UTC days, as ranges of the column itself, so that they reach the scan."""
    own = F.lit(False)
    for d in sorted(set(days)):
        start = datetime(d.year, d.month, d.day, tzinfo=UTC)
        own = own | ((F.col(time_column) >= F.lit(start)) & (F.col(time_column) < F.lit(start + timedelta(days=1))))
    return df.where(own)


def unique(columns: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(columns))


def require_columns(requested: Sequence[str], allowed: Sequence[str], dataset: str) -> list[str]:
    """The requested columns without repeats; an empty or unknown selection is an error."""
    if not requested:
        raise ValueError(f"select_columns must be non-empty for dataset={dataset}")
    unknown = [c for c in requested if c not in allowed]
    if unknown:
        raise ValueError(f"Unsupported columns for dataset={dataset}: {unknown}. Allowed: {list(allowed)}")
    return unique(requested)


def apply_fields(df: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    if fields is None:
        return df
    if not fields:
        raise ValueError("fields must be non-empty when provided")
    for k, f in enumerate(fields):
        if not f.strip():
            raise ValueError(f"fields[{k}] must be a non-empty string")
    chosen = unique([f.strip() for f in fields])
    missing = [c for c in chosen if c not in df.columns]
    if missing:
        raise ValueError(f"fields contains columns that are not available in result: {missing}")
    return df.select(*(F.col(f"`{c}`") for c in chosen))
