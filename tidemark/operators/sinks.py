"""Sinks: partitioned tables, idempotent appends, exports with checksums, the audit chain."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.cluster import checkpointed, remove
from tidemark.operators.eventlog import to_insert

RETENTION_DAYS = 365


def append_native(df: DataFrame, path: str, time_column: str, order: Sequence[str]) -> None:
    """Append to a table partitioned by month; rows lie sorted within files, so that row groups can be skipped."""
    placed = df.withColumn("month", F.date_format(time_column, "yyyy-MM"))
    placed.repartition("month").sortWithinPartitions("month", *order).write.mode("append").partitionBy("month").parquet(path)


def append_events(new: DataFrame, path: str) -> int:
    """Append the events that the log does not hold; returns how many. Conflicts fail before anything is written.

    Only the log's part that the batch can meet is read: its sources and streams (folders of the log, as many as the
    catalogue has) and its span of partitions, which is compared with the files' statistics.
    """
    spark, batch = new.sparkSession, checkpointed(new)
    log = spark.read.schema(new.schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], new.schema)
    fresh = checkpointed(to_insert(batch, part_of(log, batch)))
    n = fresh.count()
    if n:
        fresh.sortWithinPartitions("source_id", "stream_id", "partition_id").write.mode("append").partitionBy("source_id", "stream_id").parquet(path)
    return n


def part_of(log: DataFrame, batch: DataFrame) -> DataFrame:
    """The log's rows of the batch's streams, from its first to its last partition of each."""
    spans = batch.groupBy("source_id", "stream_id").agg(F.min("partition_id").alias("low"), F.max("partition_id").alias("high")).collect()
    own = F.lit(False)
    for r in spans:
        own = own | ((F.col("source_id") == r["source_id"]) & (F.col("stream_id") == r["stream_id"]) & F.col("partition_id").between(r["low"], r["high"]))
    return log.where(own)


WRITERS = ("writer", "assume_new_partition")


def write_frame(events: DataFrame, path: str, mode: str = "writer") -> int:
    """Write a frame of events: against the log event by event, or as partitions of which the log must have nothing yet."""
    if mode not in WRITERS:
        raise ValueError(f"unknown writer mode: {mode}")
    if mode == "writer":
        return append_events(events, path)
    spark, batch = events.sparkSession, checkpointed(events)
    keys = ["source_id", "stream_id", "partition_id"]
    if exists(spark, path):
        there = part_of(spark.read.schema(events.schema).parquet(path), batch).join(batch.select(*keys).distinct(), keys, "left_semi")
        if not there.limit(1).isEmpty():
            raise ValueError("the target partition is not empty")
    batch.write.mode("append").partitionBy("source_id", "stream_id").parquet(path)
    return batch.count()


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def insert_new_partition(df: DataFrame, path: str, partition_column: str) -> None:
    """A staged bulk insert: the target partitions must be empty of rows."""
    spark = df.sparkSession
    if exists(spark, path):
        there = spark.read.parquet(path).join(df.select(partition_column).distinct(), partition_column, "left_semi")
        if not there.limit(1).isEmpty():
            raise ValueError("the target partition is not empty")
    df.write.mode("append").partitionBy(partition_column).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_column: str) -> int:
    """Put these rows in place of the partitions that they have; counts them again."""
    spark, df = df.sparkSession, checkpointed(df)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_column).parquet(path)
    written = spark.read.parquet(path).join(df.select(partition_column).distinct(), partition_column, "left_semi").count()
    if written != (n := df.count()):
        raise ValueError(f"{written} rows lie there instead of {n}")
    return n


def reset_partition(spark: SparkSession, tables: Mapping[str, str], keys: Mapping[str, str], partition_column: str = "partition_id") -> dict[str, int]:
    """Empty one partition of several tables (name to folder, partitioned by partition_column) before it is done again,
    and see that nothing is left; returns how many rows went of each."""
    gone = {}
    for name, path in tables.items():
        if not exists(spark, path):
            gone[name] = 0
            continue
        every = spark.read.parquet(path)
        whole = every.where(F.col(partition_column) == keys[partition_column])
        left = checkpointed(without_partition(whole, {k: v for k, v in keys.items() if k in every.columns}))
        gone[name] = whole.count() - left.count()
        folder = f"{path}/{partition_column}={keys[partition_column]}"
        if not left.isEmpty():
            left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_column).parquet(path)
        elif exists(spark, folder):
            remove(spark, folder)
        after = spark.read.schema(every.schema).parquet(path)
        for k, v in keys.items():
            after = after.where(F.col(k) == v) if k in after.columns else after
        if not after.isEmpty():
            raise ValueError(f"{name} still has rows of the partition")
    return gone


def without_partition(df: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The rows of a projection without those of one partition."""
    match = F.lit(True)
    for k, v in keys.items():
        match = match & (F.col(k) == v)
    return df.where(~F.coalesce(match, F.lit(False)))


def export(df: DataFrame, folder: str, form: str = "parquet", request: dict | None = None) -> dict:
    """One Parquet or CSV file with its SHA-256 and metadata.json; a failure leaves error.json and is raised.

    The driver writes the metadata, so the folder is one that it sees.
    """
    if form not in ("parquet", "csv"):
        raise ValueError(f"unknown export format: {form}")
    root = Path(folder)
    root.mkdir(parents=True, exist_ok=True)
    try:
        writer = df.coalesce(1).write.mode("overwrite")
        (writer.parquet if form == "parquet" else writer.option("header", True).csv)(str(root / "data"))
        part = next(p for p in sorted((root / "data").iterdir()) if p.name.startswith("part-"))
        digest = hashlib.sha256()
        with part.open("rb") as f:
            while chunk := f.read(1 << 20):
                digest.update(chunk)
        spark = df.sparkSession
        rows = (spark.read.parquet(str(part)) if form == "parquet" else spark.read.option("header", True).csv(str(part))).count()
        meta = {"format": form, "file": f"data/{part.name}", "sha256": digest.hexdigest(), "bytes": part.stat().st_size, "row_count": rows, "columns": df.columns, "request": request or {}}
        (root / "metadata.json").write_text(json.dumps(meta, sort_keys=True))
        return meta
    except Exception as e:
        (root / "error.json").write_text(json.dumps({"error": type(e).__name__, "message": str(e)[:2000]}))
        raise


#: Rows that one answer may hold; larger results are exported.
MOST_ROWS = 1_000_000


def envelope(df: DataFrame, mode: str, source: str, warnings: Sequence[dict] = (), most: int = MOST_ROWS) -> dict:
    """The answer to a query: mode, source, row_count, schema, warnings, rows. A result of over `most` rows is an error,
    never cut; an export and a stored envelope have no such limit."""
    rows = [r.asDict(recursive=True) for r in df.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"the result has over {most} rows; export it")
    return _head(df, mode, source, len(rows), warnings) | {"rows": rows}


def stored_envelope(df: DataFrame, mode: str, source: str, path: str, warnings: Sequence[dict] = ()) -> dict:
    """The answer to a query of any size: its rows are written by the tasks to a new folder, rows_path, as Parquet, and
    none of them reaches the driver; row_count is what lies there."""
    df.write.parquet(path)
    return _head(df, mode, source, df.sparkSession.read.parquet(path).count(), warnings) | {"rows_path": path}


def _head(df: DataFrame, mode: str, source: str, rows: int, warnings: Sequence[dict]) -> dict:
    return {"mode": mode, "source": source, "row_count": rows, "schema": [{"name": n, "dtype": t} for n, t in df.dtypes], "warnings": list(warnings)}


def persist_artifact(root: str, source_id: str, content: bytes, content_type: str, fetched_at: datetime) -> dict:
    """An artifact under a key of its source, day and digest, with a manifest; the same content lies once."""
    digest = hashlib.sha256(content).hexdigest()
    day = fetched_at.astimezone(UTC)
    folder = Path(root) / source_id / day.strftime("%Y/%m/%d") / digest
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "content").write_bytes(content)
    manifest = {"artifact_id": str(uuid.uuid5(uuid.NAMESPACE_URL, f"{source_id}|{digest}")), "source_id": source_id, "sha256": digest, "bytes": len(content), "content_type": content_type, "fetched_at_utc": day.isoformat()}
    (folder / "manifest.json").write_text(json.dumps(manifest, sort_keys=True))
    return manifest


def append_manifest(path: str, event: str, details: dict, at: datetime) -> dict:
    """One more line of a backfill's manifest: what happened to which partition, and when."""
    record = {"event": event, "at_utc": at.astimezone(UTC).isoformat(), **details}
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a") as f:
        f.write(json.dumps(record, sort_keys=True) + "\n")
    return record


# --- metrics --------------------------------------------------------------------------------------------------------


def persist_metrics(records: DataFrame, path: str) -> int:
    """Append long metric rows (metric_id, source_id, observed_at_utc, ...) that are not there yet, partitioned by source
    and month; returns how many. An id that comes with other values fails."""
    spark = records.sparkSession
    dated = records.withColumn("month", F.date_format("observed_at_utc", "yyyy-MM"))
    digest = F.sha2(F.to_json(F.struct(*sorted(c for c in records.columns if c != "ingested_at_utc")), {"ignoreNullFields": "false"}), 256)
    new = checkpointed(dated.withColumn("digest", digest))
    span = new.agg(F.min("month"), F.max("month")).first()
    known = spark.read.schema(new.schema).parquet(path).where(F.col("month").between(span[0], span[1])) if exists(spark, path) and span[0] else spark.createDataFrame([], new.schema)
    both = new.select("metric_id", "digest").union(known.select("metric_id", "digest")).distinct()
    clash = both.groupBy("metric_id").count().where("count > 1").select("metric_id").limit(1).collect()
    if clash:
        raise ValueError(f"metric {clash[0][0]} comes with other values")
    fresh = checkpointed(new.dropDuplicates(["metric_id"]).join(known.select("metric_id"), "metric_id", "left_anti"))
    n = fresh.count()
    if n:
        fresh.write.mode("append").partitionBy("source_id", "month").parquet(path)
    return n


def persist_bundles(bundles: DataFrame, path: str, fetched_at: datetime) -> int:
    """Keep raw series bundles as they came, by series and content: the same content lies once; returns how many are new.

    A large bundle comes in pages, rows with a column page, all of one bundle for each series: none of its texts need hold
    it whole, and its digest is that of its pages' digests in order.
    """
    spark = bundles.sparkSession
    rows = bundles.withColumn("bundle_sha256", F.sha2(F.to_json(F.struct(*sorted(bundles.columns))), 256))
    if "page" in bundles.columns:
        digest = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("page", "bundle_sha256"))), lambda x: x["bundle_sha256"]), "|"), 256)
        whole = rows.groupBy("series_id").agg(digest.alias("whole"))
        rows = rows.dropDuplicates(["series_id", "page", "bundle_sha256"]).join(whole, "series_id").withColumn("bundle_sha256", F.col("whole")).drop("whole")
    else:
        rows = rows.dropDuplicates(["series_id", "bundle_sha256"])
    rows = rows.withColumn("fetched_at_utc", F.lit(fetched_at))
    if exists(spark, path):
        known = spark.read.schema(rows.schema).parquet(path).select("series_id", "bundle_sha256").distinct()
        rows = rows.join(known, ["series_id", "bundle_sha256"], "left_anti")
    rows = checkpointed(rows)
    n = rows.select("series_id", "bundle_sha256").distinct().count()
    if n:
        rows.write.mode("append").partitionBy("series_id").parquet(path)
    return n


# --- audit ----------------------------------------------------------------------------------------------------------


def _event_hash(record: dict) -> str:
    return hashlib.sha256(json.dumps({k: v for k, v in record.items() if k != "event_hash"}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def append_audit(path: str, kind: str, details: dict, at: datetime, retention_days: int = RETENTION_DAYS) -> dict:
    """One more line of a hash-chained log; the whole chain so far is checked first, so that no append covers a change."""
    if retention_days < RETENTION_DAYS:
        raise ValueError(f"audit retention must be at least {RETENTION_DAYS} days")
    chain = check_audit(path)
    record = {"sequence": len(chain), "kind": kind, "at_utc": at.astimezone(UTC).isoformat(), "details": details, "previous_event_hash": chain[-1]["event_hash"] if chain else None}
    record["event_hash"] = _event_hash(record)
    with open(path, "a") as f:
        f.write(json.dumps(record, sort_keys=True) + "\n")
    return record


def check_audit(path: str) -> list[dict]:
    """The log's records; a broken chain raises."""
    if not Path(path).exists():
        return []
    out = [json.loads(x) for x in Path(path).read_text().splitlines()]
    before = None
    for k, r in enumerate(out):
        if r["sequence"] != k or r["previous_event_hash"] != before or r["event_hash"] != _event_hash(r):
            raise ValueError(f"audit chain is broken at record {k}")
        before = r["event_hash"]
    return out


def broken_links(audit: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Records of a log, as a table, whose previous hash is not the hash of the record before."""
    w = W.partitionBy(*keys).orderBy("sequence") if keys else W.partitionBy(F.lit(0)).orderBy("sequence")
    return audit.withColumn("before", F.lag("event_hash").over(w)).where(~F.col("previous_event_hash").eqNullSafe(F.col("before"))).drop("before")
