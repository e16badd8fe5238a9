"""State that lasts: revisioned tables of cursors, completeness, quarantine, partition proofs and bucket policies.

A state table is a folder of Parquet rows that are only ever added: a key's state is its row with the highest revision.
One writer works on a table at a time, as one job does on a stream; a writer that read an older state fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.cluster import checkpointed
from tidemark.functions.identity import state_id
from tidemark.operators.eventlog import STREAM, latest, next_revision
from tidemark.operators.proofs import TRANSITIONS
from tidemark.operators.sinks import exists

NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "tidemark/state")


class StateTable:
    """Rows of keys, own columns, revision, recorded_at and a deterministic id under a folder."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str] = STREAM):
        self.spark, self.path, self.keys = spark, path, tuple(keys)
        self.schema = f"{schema}, revision long, recorded_at timestamp, state_id string"

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path) if exists(self.spark, self.path) else self.spark.createDataFrame([], self.schema)

    def latest(self) -> DataFrame:
        return latest(self.rows(), self.keys, ("revision", "recorded_at", "state_id"))

    def append(self, changes: DataFrame, recorded_at: Column | None = None) -> int:
        """Add a next revision for each changed key; returns how many. A key whose latest row has the same values is a
        duplicate and adds nothing; a key that comes twice in the changes is an error."""
        own = [c for c in changes.columns if c not in self.keys]
        now = self.latest().select(*self.keys, F.col("revision").alias("r__"), F.struct(*own).alias("s__"))
        numbered = changes.join(now, list(self.keys), "left").where(~F.struct(*own).eqNullSafe(F.col("s__")))
        rows = numbered.select(*self.keys, *own, (F.coalesce("r__", F.lit(0)) + 1).alias("revision"), (F.current_timestamp() if recorded_at is None else recorded_at).alias("recorded_at"))
        rows = checkpointed(rows.withColumn("state_id", state_id(NAMESPACE, *(F.col(k) for k in self.keys), F.col("revision"))))
        if not rows.groupBy(*self.keys).count().where("count > 1").isEmpty():
            raise ValueError("a key comes more than once in one change of state")
        n = rows.count()
        if n:
            rows.write.mode("append").parquet(self.path)
        return n


def _checked(judged: DataFrame, problem: Column, say: str) -> DataFrame:
    bad = judged.withColumn("problem__", problem).where("problem__ is not null").limit(1).collect()
    if bad:
        raise ValueError(f"{say}: {bad[0]['problem__']}")
    return judged


# --- ingest cursors ---------------------------------------------------------------------------------------------------


def offset_after(new: Column, old: Column, ordering: str) -> Column:
    """Whether an offset comes after another: by number, by text, or, of opaque ones, whenever they differ."""
    if ordering.startswith("numeric"):
        number = lambda c: F.when(c.try_cast("decimal(38,0)").isNotNull(), c.try_cast("decimal(38,0)")).when(c.isNotNull(), F.raise_error(F.concat(F.lit("offset is not numeric: "), c)).cast("decimal(38,0)"))
        return number(new) > number(old)
    return new > old if ordering == "lexicographic" else new != old


def advance_cursors(table: StateTable, ledger_path: str, moves: DataFrame, ordering: str, recorded_at: Column | None = None) -> int:
    """Move cursors of many streams: moves has the keys, offset and expected_previous (null for a new cursor).

    All moves hold or none: a cursor must stand where the writer expects it and can only go on. Each move is a ledger row.
    """
    now = table.latest().select(*table.keys, F.col("offset").alias("previous_offset"))
    judged = checkpointed(moves.join(now, list(table.keys), "left"))
    at = F.concat_ws("|", *table.keys, F.coalesce("previous_offset", F.lit("-")), F.coalesce("expected_previous", F.lit("-")), "offset")
    problem = F.when(~F.col("previous_offset").eqNullSafe(F.col("expected_previous")), at).when(F.col("previous_offset").isNotNull() & ~offset_after(F.col("offset"), F.col("previous_offset"), ordering), at)
    _checked(judged, problem, "a cursor cannot move")
    n = table.append(judged.select(*table.keys, "offset"), recorded_at)
    if n:
        judged.select(*table.keys, "previous_offset", "offset").write.mode("append").parquet(ledger_path)
    return n


# --- completeness and quarantine --------------------------------------------------------------------------------------


def record_completeness(table: StateTable, quarantine: StateTable, counts: DataFrame, recorded_at: Column | None = None) -> int:
    """Checkpoints of expected and observed rows by stream; those with a gap go into quarantine. Returns how many do."""
    gap = F.greatest(F.col("expected") - F.col("observed"), F.lit(0))
    judged = checkpointed(counts.select(*table.keys, "expected", "observed", gap.alias("gap"), F.when(gap > 0, "gap_detected").otherwise("complete").alias("status")))
    table.append(judged, recorded_at)
    bad = judged.where("gap > 0")
    quarantine.append(bad.select(*quarantine.keys, F.lit("quarantined").alias("status"), F.concat(F.lit("gap of "), F.col("gap")).alias("reason")), recorded_at)
    return bad.count()


def release(quarantine: StateTable, streams: DataFrame, reason: str, recorded_at: Column | None = None) -> int:
    held = quarantine.latest().where("status = 'quarantined'").select(*quarantine.keys)
    return quarantine.append(held.join(streams.select(*quarantine.keys).distinct(), list(quarantine.keys), "left_semi").select(*quarantine.keys, F.lit("released").alias("status"), F.lit(reason).alias("reason")), recorded_at)


# --- partitions -------------------------------------------------------------------------------------------------------


def move_partitions(table: StateTable, wanted: DataFrame, recorded_at: Column | None = None) -> int:
    """Bring partitions into states (keys, state, reason); all moves must be allowed ones, or none is made."""
    allowed = F.create_map(*(x for a, b in TRANSITIONS.items() for x in (F.lit(a or ""), F.array(*map(F.lit, b)))))
    judged = checkpointed(wanted.join(table.latest().select(*table.keys, F.col("state").alias("current")), list(table.keys), "left"))
    ok = F.array_contains(allowed[F.coalesce("current", F.lit(""))], F.col("state"))
    _checked(judged, F.when(~F.coalesce(ok, F.lit(False)), F.concat_ws("|", *table.keys, F.coalesce("current", F.lit("-")), "state")), "a partition cannot go there")
    return table.append(judged.select(*table.keys, "state", "reason"), recorded_at)


# --- bucket policies --------------------------------------------------------------------------------------------------

POLICY = "source_id string, stream_id string, bucket_size_seconds long, tier string, hot_days long, warm_days long"
TIERS = ("hot", "warm", "cold")


def set_policies(table: StateTable, policies: DataFrame, recorded_at: Column | None = None) -> int:
    """Bucket size, storage tier and retention by stream; equal policies are duplicates, others the next revision."""
    bad = (F.col("bucket_size_seconds") <= 0) | ~F.col("tier").isin(*TIERS) | (F.col("hot_days") <= 0) | (F.col("warm_days") < F.col("hot_days"))
    _checked(policies, F.when(F.coalesce(bad, F.lit(True)), F.concat_ws("|", "source_id", "stream_id")), "not a bucket policy")
    return table.append(policies, recorded_at)


def bucket_sizes(table: StateTable) -> Mapping[tuple[str, str], int]:
    """The sizes by stream; the catalogue bounds how many there are."""
    return {(r["source_id"], r["stream_id"]): r["bucket_size_seconds"] for r in table.latest().collect()}
