"""Projections as structured streams: the log's new files into buckets or native rows, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.catalog import DATASETS, EVENT
from tidemark.functions.text import exact_number
from tidemark.operators.aligned import bucketise, decoded_value
from tidemark.operators.eventlog import STREAM
from tidemark.operators.native import maker_flag


def batch_path(output: str, batch: int) -> str:
    return f"{output}/batch={batch}"


def project(spark: SparkSession, log: str, output: str, checkpoint: str, build: Callable[[DataFrame], DataFrame], files_per_batch: int | None = None, stream_id: str | None = None):
    """Run a projection over what is new in the log, and end; a restart goes on where it stopped.

    Each batch overwrites its own folder, so a batch that is run again after a crash leaves its rows once. There is no
    lateness: an event that comes late is projected by the batch in which it comes.
    """
    reader = spark.readStream.schema(StructType.fromDDL(EVENT))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    events = reader.parquet(log)
    if stream_id:
        events = events.where(F.col("stream_id") == stream_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            build(held).write.mode("overwrite").parquet(batch_path(f"{output}/rows", batch_id))
            watermark(held).write.mode("overwrite").parquet(batch_path(f"{output}/watermarks", batch_id))
        finally:
            held.unpersist()

    query = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def watermark(batch: DataFrame) -> DataFrame:
    """The last event of each partition in a batch, by (ingested_at, event_id), and how many there were."""
    last = F.max(F.struct("ingested_at", "event_id", "source_offset"))
    return batch.groupBy(*STREAM).agg(last.alias("l"), F.count(F.lit(1)).alias("events")).select(*STREAM, F.col("l.ingested_at").alias("ingested_at"), F.col("l.event_id").alias("event_id"), F.col("l.source_offset").alias("source_offset"), "events")


def watermarks(spark: SparkSession, output: str) -> DataFrame:
    """The progress over all batches; the batch number is the revision."""
    rows = spark.read.parquet(f"{output}/watermarks")
    state = F.struct("ingested_at", "event_id", "source_offset")
    return rows.groupBy(*STREAM).agg(F.max(state).alias("s"), F.sum("events").alias("events"), F.max("batch").alias("revision")).select(*STREAM, "s.*", "events", "revision")


def went_back(spark: SparkSession, output: str) -> DataFrame:
    """Batches whose last event is before that of an earlier batch of their partition; there should be none."""
    rows = spark.read.parquet(f"{output}/watermarks")
    a, b = rows.alias("a"), rows.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in STREAM]
    return a.join(b, [*same, F.col("a.batch") + 1 == F.col("b.batch"), F.struct("b.ingested_at", "b.event_id") < F.struct("a.ingested_at", "a.event_id")]).select("b.*")


def projected(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(f"{output}/rows").drop("batch")


def align(spark: SparkSession, log: str, output: str, checkpoint: str, seconds: int = 1, **options):
    """The bucket projection: one stored bucket row for each bucket and batch."""
    return project(spark, log, output, checkpoint, lambda events: bucketise(events, seconds), **options)


# --- native rows of payloads ------------------------------------------------------------------------------------------


def native_rows(events: DataFrame, dataset: str) -> DataFrame:
    """Typed rows of a dataset's events, in its native columns; payloads that do not fit fail."""
    spec = DATASETS[dataset]
    json = lambda k: F.get_json_object("payload_json", f"$.{k}")
    real = lambda k, s=12: exact_number(json(k), s, k).cast("double")
    whole = lambda k: exact_number(json(k), None, k).cast("long")
    flag = lambda k: json(k).try_cast("boolean").cast("byte")
    ms = F.unix_millis("source_event_time")
    at = F.col("source_event_time")
    if dataset == "binance_spot_trades":
        cells = {"trade_id": whole("trade_id"), "timestamp": ms, "price": real("price"), "quantity": real("qty"), "quote_quantity": real("quote_qty"), "is_buyer_maker": flag("is_buyer_maker"), "is_best_match": flag("is_best_match"), "datetime": at}
    elif dataset in ("okx_spot_trades", "bybit_spot_trades"):
        sided = F.when(maker_flag(json("side")) >= 0, F.lower(json("side")))
        cells = {"trade_id": whole("trade_id"), "side": sided, "price": real("price"), "size": real("size", 20), "quote_quantity": real("price") * real("size", 20), "timestamp": whole("timestamp"), "datetime": at}
        if dataset == "okx_spot_trades":
            cells["instrument_name"] = json("instrument_name")
        else:
            optional = lambda k: json(k).try_cast("double")
            cells |= {"symbol": json("symbol"), "trd_match_id": json("trd_match_id"), "tick_direction": json("tick_direction"), "gross_value": optional("gross_value"), "home_notional": optional("home_notional"), "foreign_notional": optional("foreign_notional")}
    elif spec.bucket_mode == "metrics":
        cells = {
            "metric_id": F.col("source_offset"), "source_id": json("record_source_id"), "metric_name": json("metric_name"), "metric_unit": json("metric_unit"),
            **decoded_value(json("metric_value_kind"), json("metric_value_text"), json("metric_value_bool").try_cast("boolean")), "observed_at_utc": at, "dimensions_json": json("dimensions"),
            "provenance_json": json("provenance"), "ingested_at_utc": F.col("ingested_at"),
        }
    elif dataset == "bitcoin_block_transactions":
        cells = {
            "block_height": whole("block_height"), "block_hash": json("block_hash"), "block_timestamp": whole("block_timestamp_ms"), "transaction_index": whole("transaction_index"), "txid": json("txid"),
            "inputs": json("inputs_json"), "outputs": json("outputs_json"), "values": json("values_json"), "scripts": json("scripts_json"), "witness_data": json("witness_data_json"), "coinbase": flag("coinbase"),
            "datetime": at, "source_chain": json("source_chain"),
        }
    elif dataset == "bitcoin_mempool_state":
        cells = {"snapshot_at": at, "snapshot_at_unix_ms": whole("snapshot_at_unix_ms"), "txid": json("txid"), "fee_rate_sat_vb": real("fee_rate_sat_vb", 18), "vsize": whole("vsize"), "first_seen_timestamp": whole("first_seen_timestamp"), "rbf_flag": flag("rbf_flag"), "source_chain": json("source_chain")}
    else:
        cells = {}
        for f in StructType.fromDDL(spec.schema):
            key = {"block_timestamp": "block_timestamp_ms", "timestamp": "timestamp_ms"}.get(f.name, f.name)
            kind = f.dataType.typeName()
            cells[f.name] = at if f.name == "datetime" else json(key).try_cast("double") if kind == "double" else whole(key) if kind in ("long", "integer") else json(key)
    schema = StructType.fromDDL(spec.schema)
    return events.where(F.col("stream_id") == dataset).select(*(cells[f.name].cast(f.dataType).alias(f.name) for f in schema))
