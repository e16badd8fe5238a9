"""The event log: envelopes, exactly-once append, logical resets, revisioned state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identity import ENVELOPE_VERSION, event_id

STREAM = ("source_id", "stream_id", "partition_id")
IDENTITY = (*STREAM, "source_offset")


def envelope(rows: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Events of rows with source_id, stream_id, partition_id, source_offset, source_event_time and payload_json.

    Payload bytes are the JSON text's; a payload that is not a JSON object fails.
    """
    payload = F.when(F.trim("payload_json").rlike(r"^\{"), F.col("payload_json")).otherwise(F.raise_error(F.concat(F.lit("payload must be a JSON object: "), F.coalesce("payload_json", F.lit("null")))))
    return rows.select(
        F.lit(ENVELOPE_VERSION).alias("envelope_version"), event_id(*(F.col(c) for c in IDENTITY)).alias("event_id"), *STREAM, "source_offset", "source_event_time",
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"), F.lit("application/json").alias("payload_content_type"), F.lit("utf-8").alias("payload_encoding"),
        F.encode(payload, "UTF-8").alias("payload_raw"), F.sha2(payload, 256).alias("payload_sha256"), payload.alias("payload_json"),
    )


def classify(new: DataFrame, log: DataFrame) -> DataFrame:
    """Each new event with outcome: inserted, duplicate (same identity and payload) or conflict (same identity, another
    payload), against the log and within the batch, where the first by payload hash counts as the one to insert."""
    known = log.select("event_id", F.col("payload_sha256").alias("known_sha256"))
    batch = new.groupBy("event_id").agg(F.min("payload_sha256").alias("batch_sha256"), F.min(F.struct("payload_sha256", "ingested_at")).alias("first"))
    joined = new.join(batch, "event_id").join(known, "event_id", "left")
    reference = F.coalesce("known_sha256", "batch_sha256")
    outcome = F.when(F.col("payload_sha256") != reference, "conflict").when(F.col("known_sha256").isNotNull(), "duplicate").otherwise("inserted")
    return joined.withColumn("outcome", outcome).drop("known_sha256", "batch_sha256", "first")


def one_of_each(events: DataFrame) -> DataFrame:
    """One event of each identity, the one with the least payload hash: the same one however often a plan is computed."""
    return events.groupBy("event_id").agg(F.min_by(F.struct(*events.columns), F.struct("payload_sha256", "ingested_at")).alias("e")).select("e.*")


def to_insert(new: DataFrame, log: DataFrame) -> DataFrame:
    """The events to append: no identity of the log, each identity once. A conflict fails when the result is computed.

    The batch is computed once and dealt out once, by identity.
    """
    sha = F.col("payload_sha256")
    each = new.groupBy("event_id").agg(F.min_by(F.struct(*new.columns), F.struct("payload_sha256", "ingested_at")).alias("e"), F.min(sha).alias("low"), F.max(sha).alias("high"))
    known = log.groupBy("event_id").agg(F.min(sha).alias("known_low"), F.max(sha).alias("known_high"))
    least, most = F.least("low", "known_low"), F.greatest("high", "known_high")
    conflict = F.raise_error(F.concat(F.lit("same identity, another payload: "), F.col("event_id"))).cast("boolean")
    fresh = F.when(least != most, conflict).otherwise(F.col("known_low").isNull())
    return each.join(known, "event_id", "left").where(fresh).select("e.*")


def active(log: DataFrame, resets: DataFrame) -> DataFrame:
    """The log without what a partition's latest reset boundary hides: events ingested at or before it."""
    last = resets.groupBy(*STREAM).agg(F.max("reset_at").alias("reset_at"))
    joined = log.join(last, list(STREAM), "left")
    return joined.where(F.col("reset_at").isNull() | (F.col("ingested_at") > F.col("reset_at"))).drop("reset_at")


def latest(states: DataFrame, keys: Sequence[str], order: Sequence[str] = ("revision",)) -> DataFrame:
    """The whole latest row of each key by the order columns."""
    return states.groupBy(*keys).agg(F.max_by(F.struct(*states.columns), F.struct(*order)).alias("s")).select("s.*")


def duplicate_revisions(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that have a revision more than once; a state table must have none."""
    return states.groupBy(*keys, "revision").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def next_revision(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    return states.groupBy(*keys).agg((F.coalesce(F.max("revision"), F.lit(0)) + 1).alias("next_revision"))


def non_numeric_offsets(events: DataFrame, keys: Sequence[str] = STREAM) -> DataFrame:
    """By key, how many offsets are no whole numbers, and the least of them; pages by numeric offset need none."""
    odd = F.col("source_offset").try_cast("decimal(38,0)").isNull()
    return events.groupBy(*keys).agg(F.count_if(odd).alias("non_numeric_count"), F.min(F.when(odd, F.col("source_offset"))).alias("sample_offset"))


def without_quarantined(events: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Events of streams that are not in quarantine."""
    open_ = latest(quarantined, STREAM).where("status = 'quarantined'").select(*STREAM)
    return events.join(open_, list(STREAM), "left_anti")


def page(events: DataFrame, size: int, after: tuple | None = None, order: str = "ingested_event_id") -> DataFrame:
    """The next page of a keyset: rows after (ingested_at, event_id), or after the numeric offset."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    if order == "ingested_event_id":
        if after is not None:
            at, last = F.lit(after[0]).cast("timestamp"), F.lit(after[1])
            events = events.where((F.col("ingested_at") > at) | ((F.col("ingested_at") == at) & (F.col("event_id") > last)))
        return events.orderBy("ingested_at", "event_id").limit(size)
    if order != "source_offset_numeric":
        raise ValueError(f"unknown page order: {order}")
    n = F.col("source_offset").try_cast("decimal(38,0)")
    whole = F.when(n.isNotNull(), n).otherwise(F.raise_error(F.concat(F.lit("offset is not numeric: "), F.col("source_offset"))))
    events = events.withColumn("n__", whole)
    if after is not None:
        events = events.where((F.col("n__") > F.lit(after[0])) | ((F.col("n__") == F.lit(after[0])) & (F.col("event_id") > F.lit(after[1]))))
    return events.orderBy("n__", "event_id").limit(size).drop("n__")


ORDERINGS = ("numeric", "numeric_monotonic", "lexicographic", "opaque")


def compare_offsets(left: str, right: str, ordering: str) -> int:
    """-1, 0 or 1 for two offsets; opaque offsets can only be equal, numeric ones must be numbers."""
    if ordering not in ORDERINGS:
        raise ValueError(f"unknown offset ordering: {ordering}")
    if ordering.startswith("numeric"):
        a, b = int(left), int(right)
        return (a > b) - (a < b)
    if ordering == "opaque" and left != right:
        raise ValueError("opaque offsets have no order")
    return (left > right) - (left < right)


def advance_cursor(current: dict | None, offset: str, ordering: str, expected_previous: str | None) -> dict:
    """The next cursor state: the offset must come after the current one, which must be what the writer expected."""
    previous = current["offset"] if current else None
    if previous != expected_previous:
        raise ValueError(f"cursor is at {previous!r}, not at the expected {expected_previous!r}")
    if previous is not None and compare_offsets(offset, previous, ordering) <= 0:
        raise ValueError(f"cursor cannot move from {previous!r} to {offset!r}")
    return {"offset": offset, "previous_offset": previous, "revision": (current["revision"] if current else 0) + 1}


def completeness(expected: int, observed: int) -> dict:
    """A completeness checkpoint; a gap calls for quarantine."""
    return {"expected": expected, "observed": observed, "gap": max(expected - observed, 0), "status": "complete" if observed >= expected else "gap_detected", "quarantine": observed < expected}
