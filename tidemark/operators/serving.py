"""What stands around a query: warnings, rights, availability, the mempool boundary."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import UTC, date, datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.eventlog import latest
from tidemark.operators.filters import on_days
from tidemark.operators.proofs import TERMINAL
from tidemark.plans.windows import LatestRows, Month, RandomRows, TimeRange, Window, instant

RIGHTS = ("Hosted Allowed", "BYOK Required", "Ingest Only")


def window_warnings(window: Window) -> list[dict]:
    if isinstance(window, LatestRows):
        return [{"code": "WINDOW_LATEST_ROWS_MUTABLE", "message": "Latest rows change as data arrive"}]
    if isinstance(window, RandomRows):
        return [{"code": "WINDOW_RANDOM_SAMPLE", "message": "Random rows are a choice, not the whole"}]
    return []


def enforce_strict(warnings: Sequence[dict], strict: bool) -> None:
    if strict and warnings:
        raise ValueError("Warnings present while strict=true")


def metric_warnings(metrics: DataFrame, sources: Sequence[str], required: Sequence[str], today: str, stale_days: int) -> DataFrame:
    """For each source: missing, stale (last day too old) or incomplete (metrics of its last day are lacking)."""
    wanted = metrics.sparkSession.createDataFrame([(s,) for s in sources], "source_id string")
    last = metrics.groupBy("source_id").agg(F.max(F.to_date("observed_at_utc")).alias("last_day"))
    on_last = metrics.join(last, "source_id").where(F.to_date("observed_at_utc") == F.col("last_day")).groupBy("source_id").agg(F.collect_set("metric_name").alias("names"))
    lacking = F.array_except(F.array(*map(F.lit, sorted(required))), F.coalesce("names", F.array().cast("array<string>")))
    joined = wanted.join(last, "source_id", "left").join(on_last, "source_id", "left")
    kind = F.when(F.col("last_day").isNull(), "missing").when(F.datediff(F.lit(today).cast("date"), "last_day") > stale_days, "stale").when(F.size(lacking) > 0, "incomplete")
    return joined.select("source_id", "last_day", kind.alias("warning"), F.when(F.col("last_day").isNotNull(), lacking).alias("lacking")).where(F.col("warning").isNotNull())


def last_publications(metrics: DataFrame) -> DataFrame:
    """By source, the latest publication that the provenance JSON names; null where none can be read."""
    return metrics.groupBy("source_id").agg(F.max(F.try_to_timestamp(F.get_json_object("provenance_json", "$.last_updated_utc"))).alias("published"))


def publish_warnings(metrics: DataFrame, today: str, stale_days: int) -> DataFrame:
    """By source, when its last publication (in the provenance JSON) is not known or too long ago."""
    out = last_publications(metrics)
    kind = F.when(F.col("published").isNull(), "publish_missing").when(F.datediff(F.lit(today).cast("date"), F.to_date("published")) > stale_days, "publish_stale")
    return out.select("source_id", "published", kind.alias("warning")).where(F.col("warning").isNotNull())


def freshness(aligned: DataFrame, now: datetime, stale_after: timedelta) -> dict | None:
    """The newest instant that the result covers (the end of an interval, or a bucket), its lag, and whether it is stale."""
    column = F.greatest("aligned_at_utc", "valid_to_utc_exclusive") if "valid_to_utc_exclusive" in aligned.columns else F.col("aligned_at_utc")
    top = aligned.agg(F.max(F.unix_micros(column))).first()[0]
    if top is None:
        return None
    lag = now.astimezone(UTC) - datetime.fromtimestamp(top / 1e6, UTC)
    return {"as_of": datetime.fromtimestamp(top / 1e6, UTC), "lag_seconds": lag.total_seconds(), "stale": lag > stale_after}


def mempool_boundary(proof_states: DataFrame, mempool: DataFrame) -> datetime | None:
    """The first snapshot of the earliest proved day, from which on mempool data can be served."""
    done = latest(proof_states, ("partition_id",), ("recorded_at",)).where(F.col("state").isin(*TERMINAL))
    first = done.agg(F.min("partition_id")).first()[0]
    if first is None:
        return None
    top = on_days(mempool, "snapshot_at", [date.fromisoformat(first)]).agg(F.min(F.unix_micros("snapshot_at"))).first()[0]
    return None if top is None else datetime.fromtimestamp(top / 1e6, UTC)


def reject_before_boundary(window: Window, boundary: datetime | None) -> None:
    if boundary is None:
        raise ValueError("no proved mempool partition can be served")
    start = instant(window.as_range().start if isinstance(window, Month) else window.start) if isinstance(window, Month | TimeRange) else None
    if start is not None and start < boundary:
        raise ValueError(f"mempool data start at {boundary.isoformat()}")


def load_rights(path: str) -> dict:
    """The rights matrix from a JSON file: sources with their datasets and states, each dataset named once."""
    matrix = json.loads(Path(path).read_text())
    names = [d for s in matrix.get("sources", []) for d in s.get("datasets", [])]
    if not names or len(names) != len(set(names)):
        raise ValueError("a rights matrix names each dataset once")
    return matrix


def rights_decision(matrix: dict, dataset: str, auth_token: str | None = None) -> dict:
    """Whether a dataset may be served: hosted ones after legal sign-off, others with the client's own key, some never."""
    row = next((s for s in matrix.get("sources", []) if dataset in s.get("datasets", [])), None)
    if row is None:
        raise PermissionError(f"no rights are stated for {dataset}")
    state = row.get("rights_state")
    if state not in RIGHTS:
        raise PermissionError(f"unknown rights state {state!r} of {dataset}")
    if state == "Ingest Only":
        raise PermissionError(f"{dataset} is for ingestion only")
    if state == "BYOK Required" and not auth_token:
        raise PermissionError(f"{dataset} needs the client's own key")
    if state == "Hosted Allowed" and not row.get("legal_signoff_artifact"):
        raise PermissionError(f"{dataset} has no legal sign-off")
    return {"dataset": dataset, "source": row.get("source"), "rights_state": state, "provisional": row.get("serving_state", "promote") == "shadow"}
