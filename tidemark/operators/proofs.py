"""Partition proofs, their state machine, and planning by what is proved."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.identity import line_digest, sorted_collect
from tidemark.operators.eventlog import STREAM, latest
from tidemark.operators.splits import numbered


def _numeric(ordering: str) -> bool:
    return ordering in ("numeric", "numeric_monotonic")


def _offset_order(ordering: str) -> list[Column]:
    own = [F.col("event_id"), F.col("payload_sha256")]
    if not _numeric(ordering):
        return [F.col("source_offset"), *own]
    n = F.col("source_offset").try_cast("decimal(38,0)")
    return [F.when(n.isNotNull(), n).otherwise(F.raise_error(F.concat(F.lit("an offset of a numeric stream is no whole number: "), F.col("source_offset")))), *own]


def source_proof(events: DataFrame, ordering: str) -> DataFrame:
    """For each partition: row_count, first and last offset, and digests of its offsets and its identities in order.

    A digest is one SHA-256 over a partition's ordered lines, so each partition's identities (not its payloads) meet in
    one task; two_level_digest needs no more than a block's lines in one.
    """
    ordered = sorted_collect(_offset_order(ordering), F.struct("source_offset", "event_id", "payload_sha256"))
    out = events.groupBy(*STREAM).agg(F.count(F.lit(1)).alias("row_count"), ordered.alias("m"))
    line = lambda x: F.concat_ws("|", x["source_offset"], x["event_id"], x["payload_sha256"])
    return out.select(
        *STREAM, "row_count", F.element_at("m", 1)["source_offset"].alias("first_offset"), F.element_at("m", -1)["source_offset"].alias("last_offset"),
        line_digest(F.transform("m", lambda x: x["source_offset"])).alias("offset_digest"), line_digest(F.transform("m", line)).alias("identity_digest"),
    )


def canonical_proof(events: DataFrame, ordering: str) -> DataFrame:
    """The source proof with unique_offset_count, gap_count (numeric offsets only) and duplicate_count."""
    n = F.col("source_offset").try_cast("decimal(38,0)")
    gaps = F.greatest(F.max(n) - F.min(n) + 1 - F.count_distinct("source_offset"), F.lit(0)).cast("long") if ordering == "numeric" else F.lit(0).cast("long")
    counts = events.groupBy(*STREAM).agg(
        F.count_distinct("source_offset").alias("unique_offset_count"), gaps.alias("gap_count"), (F.count(F.lit(1)) - F.count_distinct("source_offset")).alias("duplicate_count")
    )
    return source_proof(events, ordering).join(counts, list(STREAM))


def proof_result(source: DataFrame, canonical: DataFrame) -> DataFrame:
    """The state that each partition's two proofs lead to, with the reason."""
    c = canonical.select(*STREAM, *(F.col(x).alias(f"canonical_{x}") for x in ("row_count", "first_offset", "last_offset", "offset_digest", "identity_digest")), "gap_count", "duplicate_count")
    j = source.join(c, list(STREAM), "left")
    same = [F.col(x).eqNullSafe(F.col(f"canonical_{x}")) for x in ("row_count", "first_offset", "last_offset", "offset_digest", "identity_digest")]
    reason = (
        F.when(F.coalesce("canonical_row_count", F.lit(0)) != F.col("row_count"), "row_count_mismatch")
        .when(F.col("duplicate_count") > 0, "duplicate_offsets")
        .when(F.col("gap_count") > 0, "offset_gap")
        .when(~same[3], "offset_digest_mismatch")
        .when(~same[4], "identity_digest_mismatch")
        .otherwise("match")
    )
    reason = F.when(F.col("row_count") == 0, F.when(F.coalesce("canonical_row_count", F.lit(0)) == 0, "empty").otherwise("row_count_mismatch")).otherwise(reason)
    return j.select(*STREAM, "row_count", reason.alias("reason"), F.when(reason == "match", "proved_complete").when(reason == "empty", "empty_proved").otherwise("quarantined").alias("state"))


def two_level_digest(events: DataFrame, ordering: str, block: int = 65_536) -> DataFrame:
    """Another digest, not equal to the source proof's: of blocks of consecutive lines, and then of the blocks' digests.

    No task holds more than a block's lines and a partition's block digests: rows are numbered over all partitions by a
    range shuffle, and a partition's first number is taken off.
    """
    placed = numbered(events.select(*STREAM, "source_offset", "event_id", "payload_sha256"), [*STREAM, *_offset_order(ordering)], "n")
    first = placed.groupBy(*STREAM).agg(F.min("n").alias("first"))
    ordered = placed.join(first, list(STREAM)).withColumn("at", F.col("n") - F.col("first"))
    line = F.concat_ws("|", "source_offset", "event_id", "payload_sha256")
    blocks = ordered.groupBy(*STREAM, F.floor(F.col("at") / block).alias("b")).agg(line_digest(sorted_collect([F.col("at")], line)).alias("d"), F.count(F.lit(1)).alias("n"))
    return blocks.groupBy(*STREAM).agg(F.sum("n").alias("row_count"), line_digest(sorted_collect([F.col("b")], F.col("d"))).alias("block_digest"))


def range_proof(proofs: DataFrame, keys: Sequence[str] = ("source_id", "stream_id")) -> DataFrame:
    """Over a stream's partition proofs: how many, their rows, first and last partition, and a digest of their digests."""
    lines = sorted_collect([F.col("partition_id")], F.concat_ws("|", "partition_id", "identity_digest"))
    return proofs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("partition_count"), F.sum("row_count").alias("row_count"), F.min("partition_id").alias("first_partition"), F.max("partition_id").alias("last_partition"),
        line_digest(lines).alias("range_digest"),
    )


def rows_fingerprint(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """By key, SHA-256 of the rows as one JSON list: objects with sorted keys, in the order given. For sets that are
    small by nature, as the rows of one fetch."""
    shown = F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"})
    listed = sorted_collect([F.col(c) for c in order], shown)
    return rows.groupBy(*keys).agg(F.sha2(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")), 256).alias("fingerprint"))


def records_fingerprint(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """By key, SHA-256 over metric_id|payload_sha256 lines in the order of the ids."""
    return records.groupBy(*keys).agg(line_digest(sorted_collect([F.col("metric_id")], F.concat_ws("|", "metric_id", "payload_sha256"))).alias("fingerprint"))


def side_counts(**tables: DataFrame) -> DataFrame:
    """One row with each table's number of rows; the tables are counted in one job, a row each is summed up."""
    counts = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, t in tables.items()]
    both = reduce(DataFrame.unionByName, counts)
    return both.agg(*(F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in tables))


# --- state machine --------------------------------------------------------------------------------------------------

TERMINAL = ("proved_complete", "empty_proved")
#: Which states may follow which; fixed values.
TRANSITIONS: dict[str | None, tuple[str, ...]] = {
    None: ("source_manifested",),
    "source_manifested": ("source_manifested", "canonical_written_unproved", "empty_proved", "quarantined", "reconcile_required"),
    "canonical_written_unproved": ("proved_complete", "quarantined", "reconcile_required"),
    "quarantined": ("reconcile_required", "source_manifested"),
    "reconcile_required": ("source_manifested", "canonical_written_unproved", "proved_complete", "quarantined"),
    "proved_complete": ("reconcile_required",),
    "empty_proved": ("reconcile_required",),
}


def next_state(current: str | None, wanted: str) -> str:
    if wanted not in TRANSITIONS.get(current, ()):
        raise ValueError(f"a partition cannot go from {current} to {wanted}")
    return wanted


def assert_can_execute(state: str | None, mode: str) -> None:
    """Backfills write new or failed partitions; reconciles rework those that exist."""
    if mode not in ("backfill", "reconcile"):
        raise ValueError(f"unknown execution mode: {mode}")
    if mode == "backfill" and state in (*TERMINAL, "canonical_written_unproved", "quarantined", "reconcile_required"):
        raise ValueError(f"partition in state {state} needs reconcile, not backfill")
    if mode == "reconcile" and state is None:
        raise ValueError("reconcile needs a partition that exists")


# --- planning -------------------------------------------------------------------------------------------------------


def terminal_partitions(states: DataFrame) -> DataFrame:
    return latest(states, STREAM, ("revision", "recorded_at")).where(F.col("state").isin(*TERMINAL)).select(*STREAM)


def unproved_partitions(log: DataFrame, states: DataFrame) -> DataFrame:
    """Partitions of the log without a terminal proof."""
    return log.select(*STREAM).distinct().join(terminal_partitions(states), list(STREAM), "left_anti")


def known_partitions(*tables: DataFrame) -> DataFrame:
    """The partitions that any of the tables names, each once."""
    return reduce(DataFrame.union, (t.select(*STREAM) for t in tables)).distinct()


def ambiguous_partitions(log: DataFrame, manifests: DataFrame, proofs: DataFrame) -> DataFrame:
    """The same over all partitions that the log, manifests or proofs know, counted by stream."""
    every = known_partitions(log, manifests, proofs)
    return every.join(terminal_partitions(proofs), list(STREAM), "left_anti").groupBy("source_id", "stream_id").agg(F.count(F.lit(1)).alias("ambiguous_count"), F.min("partition_id").alias("first_partition"))


def coverage_differences(watermarks: DataFrame, proofs: DataFrame) -> DataFrame:
    """Partitions that only one side has; projections may be served when there are none."""
    a, b = (f.select(*STREAM).distinct().withColumn(name, F.lit(True)) for f, name in ((watermarks, "projected"), (proofs, "proved")))
    return a.join(b, list(STREAM), "full").where(F.col("projected").isNull() | F.col("proved").isNull()).select(*STREAM, F.col("projected").isNotNull().alias("projected"), F.col("proved").isNotNull().alias("proved"))


def days(spark: SparkSession, first: date, last: date, business: bool = False) -> DataFrame:
    """Daily partition ids from first to last, Mondays to Fridays only for business days."""
    if first > last:
        raise ValueError("first day is after the last")
    all_days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias("d"))
    return (all_days.where(F.weekday("d") < 5) if business else all_days).select(F.date_format("d", "yyyy-MM-dd").alias("partition_id"))


def missing_days(planned: DataFrame, proved: DataFrame) -> DataFrame:
    return planned.join(proved.select("partition_id").distinct(), "partition_id", "left_anti").orderBy("partition_id")


def resume_from(proved: DataFrame, first: date) -> date:
    """The first day after the unbroken run of proved days that starts at `first`; proved days after a break are an error."""
    row = (
        proved.select(F.to_date("partition_id").alias("d")).distinct().where(F.col("d") >= F.lit(first))
        .agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("last"), F.date_add(F.lit(first), F.count(F.lit(1)).cast("int")).alias("next")).first()
    )
    if row["n"] and row["next"] <= row["last"]:
        raise ValueError(f"proved days are not contiguous from {first}: {row['n']} up to {row['last']}")
    return row["next"]


def height_range(partition_id: str) -> tuple[int, int]:
    """(first, last) of a height partition id such as 000000000000-000000000143."""
    low, _, high = partition_id.partition("-")
    if not (low.isdigit() and high.isdigit()) or int(low) > int(high):
        raise ValueError(f"not a height range: {partition_id!r}")
    return int(low), int(high)


def height_partition(first: int, last: int, width: int = 12) -> str:
    if not 0 <= first <= last:
        raise ValueError(f"not a height range: {first} to {last}")
    return f"{first:0{width}d}-{last:0{width}d}"


def gap_summary(offsets: DataFrame, keys: Sequence[str], offset: str, preview: int = 10) -> DataFrame:
    """By key: min, max, expected, observed, gap and duplicate counts, and the first missing numbers.

    Missing numbers come from the holes between neighbours, so a hole's size does not matter.
    """
    n = F.col(offset)
    counts = offsets.groupBy(*keys).agg(
        F.min(n).alias("min_offset"), F.max(n).alias("max_offset"), (F.max(n) - F.min(n) + 1).alias("expected_count"), F.count_distinct(n).alias("observed_count"),
        (F.max(n) - F.min(n) + 1 - F.count_distinct(n)).alias("gap_count"), (F.count(n) - F.count_distinct(n)).alias("duplicate_count"),
    )
    once = offsets.select(*keys, n.alias("n")).distinct()
    holes = once.withColumn("next", F.lead("n").over(W.partitionBy(*keys).orderBy("n"))).where(F.col("next") > F.col("n") + 1)
    first = holes.withColumn("r", F.row_number().over(W.partitionBy(*keys).orderBy("n"))).where(F.col("r") <= preview)
    shown = first.select(*keys, F.explode(F.sequence(F.col("n") + 1, F.least(F.col("next") - 1, F.col("n") + preview))).alias("m"))
    listed = shown.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list("m")), 1, preview).alias("first_missing"))
    return counts.join(listed, list(keys), "left").withColumn("first_missing", F.coalesce("first_missing", F.array().cast("array<bigint>")))
