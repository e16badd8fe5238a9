"""The five query windows, their resolution from request parameters, and the aligned planner."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import DATASETS


def instant(text: str) -> datetime:
    """An ISO instant in UTC, cut to milliseconds; without an offset it is UTC already."""
    at = datetime.fromisoformat(text.replace("Z", "+00:00"))
    at = at.replace(tzinfo=UTC) if at.tzinfo is None else at.astimezone(UTC)
    return at.replace(microsecond=at.microsecond // 1000 * 1000)


@dataclass(frozen=True)
class Month:
    month: int
    year: int

    def __post_init__(self):
        if not 1 <= self.month <= 12:
            raise ValueError(f"month must be 1 to 12, got {self.month}")

    def as_range(self) -> TimeRange:
        after = date(self.year + self.month // 12, self.month % 12 + 1, 1)
        return TimeRange(f"{date(self.year, self.month, 1).isoformat()}T00:00:00Z", f"{after.isoformat()}T00:00:00Z")


@dataclass(frozen=True)
class TimeRange:
    """[start, end)"""

    start: str
    end: str

    def __post_init__(self):
        if instant(self.start) >= instant(self.end):
            raise ValueError(f"a time range must start before its end, got {self.start} and {self.end}")


@dataclass(frozen=True)
class LatestRows:
    rows: int

    def __post_init__(self):
        _positive(self.rows)


@dataclass(frozen=True)
class RandomRows:
    rows: int

    def __post_init__(self):
        _positive(self.rows)


@dataclass(frozen=True)
class AllRows:
    pass


Window = Month | TimeRange | LatestRows | RandomRows | AllRows


def _positive(rows: int) -> None:
    if rows <= 0:
        raise ValueError(f"a number of rows must be positive, got {rows}")


def in_range(df: DataFrame, time_column: str, window: Window) -> DataFrame:
    """The half-open time predicate of a month or range; other windows pass all rows. Literals reach the scan, and the
    month partition column, where the table has one, is bounded too, so that whole partitions are pruned."""
    if isinstance(window, Month):
        window = window.as_range()
    if not isinstance(window, TimeRange):
        return df
    start, end = instant(window.start), instant(window.end)
    out = df.where((F.col(time_column) >= F.lit(start)) & (F.col(time_column) < F.lit(end)))
    if "month" in df.columns:
        out = out.where(F.col("month").between(start.strftime("%Y-%m"), (end - timedelta(milliseconds=1)).strftime("%Y-%m")))
    return out


def seeded(*columns: str):
    """The order of a deterministic random choice: a hash of the columns, not a sample."""
    return F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in columns)))


def apply_native(df: DataFrame, window: Window, id_column: str, time_column: str, seed_column: str) -> DataFrame:
    """Latest rows are the last by (day, id), not by time; random rows the smallest by a hash of (id, seed)."""
    if isinstance(window, LatestRows):
        return df.orderBy(F.date_trunc("day", time_column).desc(), F.col(id_column).desc()).limit(window.rows)
    if isinstance(window, RandomRows):
        seed = F.col(seed_column)
        if seed_column == time_column:
            df = df.withColumn("seed__", F.unix_millis(seed.cast("timestamp")))
            return df.orderBy(seeded(id_column, "seed__"), id_column).limit(window.rows).drop("seed__")
        return df.orderBy(seeded(id_column, seed_column), id_column).limit(window.rows)
    return in_range(df, time_column, window)


def resolve(month_year: tuple[int, int] | None = None, n_rows: int | None = None, n_random: int | None = None, time_range: tuple[str, str] | None = None) -> Window:
    """The window of a raw request; at most one parameter."""
    given = [x for x in (month_year, n_rows, n_random, time_range) if x is not None]
    if len(given) > 1:
        raise ValueError("At most one of month_year, n_rows, n_random, or time_range can be provided.")
    if month_year is not None:
        return Month(*month_year)
    if time_range is not None:
        return TimeRange(*time_range)
    if n_rows is not None:
        return LatestRows(n_rows)
    return AllRows() if n_random is None else RandomRows(n_random)


def strict_date(label: str, text: str) -> date:
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"{label} must be strict YYYY-MM-DD (UTC day); got {text!r}")
    try:
        return date.fromisoformat(text)
    except ValueError as e:
        raise ValueError(f"{label} must be a valid YYYY-MM-DD date (UTC day); got {text!r}") from e


def day_bounds(df: DataFrame, time_column: str) -> tuple[date | None, date | None]:
    low, high = df.agg(F.to_date(F.min(time_column)), F.to_date(F.max(time_column))).first()
    return low, high


def resolve_historical(df: DataFrame, time_column: str, start_date: str | None = None, end_date: str | None = None, n_latest_rows: int | None = None, n_random_rows: int | None = None) -> Window:
    """The window of a historical request; end_date is inclusive, and an open bound is the table's own first or last day."""
    dated = start_date is not None or end_date is not None
    if dated + (n_latest_rows is not None) + (n_random_rows is not None) > 1:
        raise ValueError("At most one window mode can be provided: date-window(start_date/end_date) | n_latest_rows | n_random_rows")
    if n_latest_rows is not None:
        return LatestRows(n_latest_rows)
    if n_random_rows is not None:
        return RandomRows(n_random_rows)
    if not dated:
        return AllRows()
    start = strict_date("start_date", start_date) if start_date is not None else None
    end = strict_date("end_date", end_date) if end_date is not None else None
    if start is None or end is None:
        low, high = day_bounds(df, time_column)
        if low is None:
            raise ValueError("date-window mode cannot resolve open bounds because source table has no rows")
        start, end = start or low, end or high
    if start > end:
        raise ValueError(f"date-window must satisfy start_date <= end_date; got start_date={start.isoformat()} end_date={end.isoformat()}")
    return TimeRange(f"{start.isoformat()}T00:00:00Z", f"{(end + timedelta(days=1)).isoformat()}T00:00:00Z")


@dataclass(frozen=True)
class AlignedPlan:
    dataset: str
    path: str
    window: Window


def plan_aligned(dataset: str, window: Window) -> AlignedPlan:
    """Metrics and derived streams answer months and ranges by forward-filled intervals, other windows by observations."""
    if dataset not in DATASETS:
        raise ValueError(f"Unsupported aligned dataset: {dataset}")
    spec = DATASETS[dataset]
    if spec.bucket_mode == "exchange":
        return AlignedPlan(dataset, f"{spec.source}_aligned", window)
    family = {"stream": "bitcoin_stream", "derived": "bitcoin_derived"}.get(spec.bucket_mode, spec.source)
    plan = AlignedPlan(dataset, f"{family}_aligned_observation", window)
    if spec.forward_fills and isinstance(window, Month | TimeRange):
        return replace(plan, path=f"{family}_aligned_forward_fill", window=window.as_range() if isinstance(window, Month) else window)
    return plan
