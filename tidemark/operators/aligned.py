"""One-second buckets: events into stored buckets, and the readers over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.catalog import DATASETS, DERIVED_METRICS, OBSERVATION, STREAM_COLUMNS, VALIDITY, aligned_columns
from tidemark.functions.identity import iso_instant, json_safe, order_key
from tidemark.operators.filters import apply_filters, require_columns
from tidemark.operators.native import iso_text
from tidemark.plans.windows import AllRows, LatestRows, RandomRows, TimeRange, Window, in_range, instant, plan_aligned, seeded

EVENT_ROW = "event_id string, ingested_at_utc string, payload_json string, payload_sha256_raw string, source_event_time_utc string, source_offset_or_equivalent string"


# --- writing --------------------------------------------------------------------------------------------------------


def bucketise(events: DataFrame, seconds: int = 1) -> DataFrame:
    """Stored bucket rows of a batch of events: (source, stream, partition, bucket) with its events as ordered JSON.

    First and last are by (event time, event id); an event without a time fails. A batch makes its own rows: late
    events become a further row of their bucket, and the readers merge.
    """
    if seconds <= 0:
        raise ValueError("bucket size must be positive")
    time = F.coalesce(F.col("source_event_time"), F.raise_error(F.concat(F.lit("Aligned projection requires a source event time for every event; event_id="), F.col("event_id"))).cast("timestamp"))
    row = F.struct(
        F.col("event_id"), iso_instant(F.col("ingested_at")).alias("ingested_at_utc"), json_safe(F.col("payload_json")).alias("payload_json"),
        F.col("payload_sha256").alias("payload_sha256_raw"), iso_instant(F.col("source_event_time")).alias("source_event_time_utc"), F.col("source_offset").alias("source_offset_or_equivalent"),
    )
    at = F.timestamp_seconds(seconds * F.floor(F.unix_seconds(time) / seconds))
    keyed = events.select("source_id", "stream_id", "partition_id", at.alias("aligned_at_utc"), F.struct(F.col("source_event_time").alias("t"), F.col("event_id").alias("i"), F.col("ingested_at").alias("g"), row.alias("r")).alias("e"))
    grouped = keyed.groupBy("source_id", "stream_id", "partition_id", "aligned_at_utc").agg(F.array_sort(F.collect_list("e")).alias("es"))
    first, last = F.element_at("es", 1), F.element_at("es", -1)
    text = F.to_json(F.struct(F.transform("es", lambda e: e["r"]).alias("rows")))
    return grouped.select(
        "source_id", "stream_id", "partition_id", "aligned_at_utc", F.size("es").cast("long").alias("bucket_event_count"), first["i"].alias("first_event_id"), last["i"].alias("last_event_id"),
        first["r"]["source_offset_or_equivalent"].alias("first_source_offset"), last["r"]["source_offset_or_equivalent"].alias("last_source_offset"),
        last["g"].alias("latest_ingested_at_utc"), text.alias("payload_rows_json"), F.sha2(text, 256).alias("bucket_sha256"),
    )


# --- reading --------------------------------------------------------------------------------------------------------


def stored(buckets: DataFrame, dataset: str, window: Window) -> DataFrame:
    """Stored rows of a dataset's stream in a window. Row windows count stored rows, before any merge."""
    spec = DATASETS[dataset]
    own = buckets.where((F.col("source_id") == spec.source) & (F.col("stream_id") == spec.name))
    if isinstance(window, LatestRows):
        return own.orderBy(F.desc("aligned_at_utc"), F.desc("first_source_offset")).limit(window.rows)
    if isinstance(window, RandomRows):
        return own.withColumn("ms__", F.unix_millis("aligned_at_utc")).orderBy(seeded("ms__", "bucket_sha256"), "bucket_sha256").limit(window.rows).drop("ms__")
    return in_range(own, "aligned_at_utc", window)


def events_of(rows: DataFrame, *kept: str) -> DataFrame:
    """The bucket rows' events, with the named columns; a bucket whose JSON has no events fails."""
    parsed = rows.select(*kept, F.from_json("payload_rows_json", f"rows array<struct<{EVENT_ROW.replace(' string', ':string')}>>")["rows"].alias("rows"))
    whole = F.when(F.size("rows") > 0, F.col("rows")).otherwise(F.raise_error(F.lit("aligned payload_rows_json must hold a non-empty list of rows")))
    return parsed.select(*kept, F.explode(whole).alias("e")).select(*kept, "e.*")


def number(text: Column, label: str, scale: int = 18) -> Column:
    value = text.try_cast(f"decimal(38,{scale})")
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"{label} must be a decimal")))


def trades_of(events: DataFrame, source: str, *kept: str) -> DataFrame:
    """price, quantity and quote of each event: a quote of the payload's own where the source has one, else price by size."""
    payload = lambda key: F.get_json_object("payload_json", f"$.{key}")
    price = number(payload("price"), "payload.price", 12)
    quantity = number(payload("qty" if source == "binance" else "size"), "payload.quantity", 12)
    product = (price.cast("decimal(19,9)") * quantity.cast("decimal(19,9)")).cast("decimal(38,12)")
    quote = F.coalesce(payload("quote_qty").try_cast("decimal(38,12)"), product) if source == "binance" else product
    return events.select(*kept, order_key(F.col("source_offset_or_equivalent")).alias("k"), price.alias("price"), quantity.alias("quantity"), quote.alias("quote"))


def exchange_seconds(rows: DataFrame, source: str) -> DataFrame:
    """OHLC of each second over all of its stored rows: exact decimal sums, first and last by the offsets' order."""
    trades = trades_of(events_of(rows, "aligned_at_utc"), source, "aligned_at_utc")
    return (
        trades.groupBy("aligned_at_utc")
        .agg(
            F.min_by("price", "k").cast("double").alias("open_price"), F.max("price").cast("double").alias("high_price"), F.min("price").cast("double").alias("low_price"),
            F.max_by("price", "k").cast("double").alias("close_price"), F.sum("quantity").cast("double").alias("quantity_sum"), F.sum("quote").cast("double").alias("quote_volume_sum"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .orderBy("aligned_at_utc")
    )


def seconds_from_trades(trades: DataFrame, quantity: str = "quantity", quote: str | None = "quote_quantity") -> DataFrame:
    """The same OHLC straight from native trades."""
    q = F.col(quantity).cast("decimal(38,12)")
    v = F.col(quote).cast("decimal(38,12)") if quote else (F.col("price").cast("decimal(19,9)") * F.col(quantity).cast("decimal(19,9)")).cast("decimal(38,12)")
    return (
        trades.groupBy(F.date_trunc("second", "datetime").alias("aligned_at_utc"))
        .agg(
            F.min_by("price", "trade_id").cast("double").alias("open_price"), F.max("price").cast("double").alias("high_price"), F.min("price").cast("double").alias("low_price"),
            F.max_by("price", "trade_id").cast("double").alias("close_price"), F.sum(q).cast("double").alias("quantity_sum"), F.sum(v).cast("double").alias("quote_volume_sum"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .orderBy("aligned_at_utc")
    )


_STREAM_PAYLOADS = {
    "bitcoin_block_headers": "height long, block_hash string, prev_hash string, merkle_root string, version long, nonce long, difficulty string, timestamp_ms long, source_chain string",
    "bitcoin_block_transactions": "block_height long, block_timestamp_ms long, transaction_index long, txid string, coinbase boolean, values_json string, source_chain string",
    "bitcoin_mempool_state": "snapshot_at_unix_ms long, txid string, fee_rate_sat_vb string, vsize long, first_seen_timestamp long, rbf_flag boolean, source_chain string",
}


def stream_buckets(rows: DataFrame, dataset: str) -> DataFrame:
    """One row for each stored bucket row of a block, transaction or mempool stream; stored rows are not merged."""
    kept = ("aligned_at_utc", "latest_ingested_at_utc", "first_source_offset", "last_source_offset", "bucket_sha256", "first_event_id", "partition_id")
    events = events_of(rows, *kept).withColumn("p", F.from_json("payload_json", _STREAM_PAYLOADS[dataset]))
    p = lambda f: F.col(f"p.{f}")
    if dataset == "bitcoin_block_headers":
        order = F.struct(p("height"))
        own = {f"latest_{f}": F.max_by(p(f), order) for f in ("height", "block_hash", "prev_hash", "merkle_root", "version", "nonce", "timestamp_ms", "source_chain")}
        own["latest_difficulty"] = F.max_by(number(p("difficulty"), "difficulty"), order).cast("double")
    elif dataset == "bitcoin_block_transactions":
        order = F.struct(p("block_height"), p("transaction_index"), p("txid"))
        value = lambda k: number(F.get_json_object(p("values_json"), f"$.{k}"), k)
        own = {
            "tx_count": F.count(F.lit(1)), "coinbase_tx_count": F.count_if(p("coinbase")), "total_input_value_btc": F.sum(value("input_value_btc_sum")).cast("double"),
            "total_output_value_btc": F.sum(value("output_value_btc_sum")).cast("double"), "first_block_height": F.min_by(p("block_height"), order), "last_block_height": F.max_by(p("block_height"), order),
            "latest_block_timestamp_ms": F.max_by(p("block_timestamp_ms"), order), "latest_txid": F.max_by(p("txid"), order), "latest_source_chain": F.max_by(p("source_chain"), order),
        }
    else:
        order = F.struct(p("snapshot_at_unix_ms"), p("txid"))
        fee = number(p("fee_rate_sat_vb"), "fee_rate_sat_vb")
        own = {
            "tx_count": F.count(F.lit(1)), "fee_rate_sat_vb_min": F.min(fee).cast("double"), "fee_rate_sat_vb_max": F.max(fee).cast("double"),
            "fee_rate_sat_vb_avg": (F.sum(fee).cast("double") / F.count(F.lit(1))), "total_vsize": F.sum(p("vsize")), "first_seen_timestamp_min": F.min(p("first_seen_timestamp")),
            "first_seen_timestamp_max": F.max(p("first_seen_timestamp")), "rbf_true_count": F.count_if(p("rbf_flag")), "latest_snapshot_at_unix_ms": F.max_by(p("snapshot_at_unix_ms"), order),
            "latest_txid": F.max_by(p("txid"), order), "latest_source_chain": F.max_by(p("source_chain"), order),
        }
    out = events.groupBy(*kept).agg(F.count(F.lit(1)).alias("records_in_bucket"), *(c.alias(n) for n, c in own.items()))
    out = out.withColumnsRenamed({"first_source_offset": "first_source_offset_or_equivalent", "last_source_offset": "last_source_offset_or_equivalent"})
    return out.select(*STREAM_COLUMNS[dataset]).orderBy("aligned_at_utc", "first_source_offset_or_equivalent")


def derived_observations(rows: DataFrame, dataset: str) -> DataFrame:
    """One observation for each stored bucket row: the last event's value by (time, offset, id)."""
    name, unit, key = DERIVED_METRICS[dataset]
    kept = ("aligned_at_utc", "bucket_sha256", "first_event_id", "partition_id")
    json = lambda k: F.get_json_object("payload_json", f"$.{k}")
    given = lambda k, other: F.when(F.length(F.trim(json(k))) > 0, json(k)).otherwise(F.lit(other))
    value = F.coalesce(json("metric_value"), json(key))
    fields = F.struct(given("metric_name", name).alias("n"), given("metric_unit", unit).alias("u"), value.alias("v"), json("provenance").alias("o"))
    order = F.struct(F.to_timestamp("source_event_time_utc"), order_key(F.col("source_offset_or_equivalent")), F.col("event_id"))
    out = events_of(rows, *kept).groupBy(*kept).agg(F.max_by(fields, order).alias("f"), F.max(F.to_timestamp("ingested_at_utc")).alias("latest_ingested_at_utc"), F.count(F.lit(1)).alias("records_in_bucket"))
    none = F.lit(None)
    text = F.col("f.v").try_cast("double")
    return out.select(
        "aligned_at_utc", F.lit(DATASETS[dataset].source).alias("source_id"), F.col("f.n").alias("metric_name"), F.col("f.u").alias("metric_unit"), none.cast("string").alias("metric_value_string"),
        none.cast("long").alias("metric_value_int"), F.when(text.isNotNull(), text).otherwise(F.raise_error(F.lit("metric_value must be a decimal"))).alias("metric_value_float"),
        none.cast("int").alias("metric_value_bool"), F.lit("{}").alias("dimensions_json"), F.col("f.o").alias("provenance_json"), "latest_ingested_at_utc", "records_in_bucket",
    )


def decoded_value(kind: Column, text: Column, flag: Column) -> dict[str, Column]:
    """The four value columns of a tagged scalar: null, bool, int, float or string."""
    fail = lambda what: F.raise_error(F.concat(F.lit(what), F.coalesce(kind, F.lit("null"))))
    whole, real = text.try_cast("long"), text.try_cast("double")
    checked = (
        F.when(kind == "null", F.lit(None).cast("string"))
        .when((kind == "bool") & flag.isNotNull() & text.isin("true", "false"), text)
        .when((kind == "int") & whole.isNotNull(), text)
        .when((kind == "float") & real.isNotNull(), text)
        .when((kind == "string") & text.isNotNull(), text)
        .otherwise(fail("metric value does not fit its kind: "))
    )
    return {
        "metric_value_string": checked, "metric_value_int": F.when(kind == "int", whole), "metric_value_float": F.when(kind.isin("int", "float"), real),
        "metric_value_bool": F.when(kind == "bool", flag.cast("int")),
    }


def encoded_value(string: Column, whole: Column, real: Column, flag: Column) -> dict[str, Column]:
    """The tagged scalar of four value columns; the inverse of decoded_value."""
    kind = F.when(flag.isNotNull(), "bool").when(whole.isNotNull(), "int").when(real.isNotNull(), "float").when(string.isNotNull(), "string").otherwise("null")
    text = F.when(flag.isNotNull(), F.when(flag.cast("boolean"), "true").otherwise("false")).when(whole.isNotNull(), whole.cast("string")).when(real.isNotNull(), F.coalesce(string, real.cast("string"))).otherwise(string)
    return {"metric_value_kind": kind, "metric_value_text": text, "metric_value_bool": flag.cast("boolean")}


def metric_observations(rows: DataFrame) -> DataFrame:
    """For each (second, source, metric) over all stored rows, the last by (ingested, offset, id), and how many there were."""
    json = lambda k: F.get_json_object("payload_json", f"$.{k}")
    events = events_of(rows, "aligned_at_utc").select(
        "aligned_at_utc", json("record_source_id").alias("source_id"), json("metric_name").alias("metric_name"),
        F.struct(F.to_timestamp("ingested_at_utc").alias("g"), F.col("source_offset_or_equivalent").alias("o"), F.col("event_id").alias("i")).alias("k"),
        F.struct(
            json("metric_unit").alias("metric_unit"), *(c.alias(n) for n, c in decoded_value(json("metric_value_kind"), json("metric_value_text"), json("metric_value_bool").try_cast("boolean")).items()),
            json("dimensions").alias("dimensions_json"), json("provenance").alias("provenance_json"),
        ).alias("f"),
    )
    latest = events.groupBy("aligned_at_utc", "source_id", "metric_name").agg(F.max_by("f", "k").alias("f"), F.max("k").alias("k"), F.count(F.lit(1)).alias("records_in_bucket"))
    return latest.select("aligned_at_utc", "source_id", "metric_name", "f.*", F.col("k.g").alias("latest_ingested_at_utc"), "records_in_bucket").select(*OBSERVATION)


def metric_window(observations: DataFrame, window: Window) -> DataFrame:
    """Row windows of observations: the last by (time, source, metric), or the smallest by a digest of the row."""
    if isinstance(window, LatestRows):
        return observations.orderBy(F.desc("aligned_at_utc"), F.desc("source_id"), F.desc("metric_name")).limit(window.rows)
    if isinstance(window, RandomRows):
        text = F.concat_ws("|", iso_instant(F.col("aligned_at_utc")), F.col("source_id"), F.col("metric_name"), iso_instant(F.col("latest_ingested_at_utc")), F.col("records_in_bucket").cast("string"))
        return observations.orderBy(F.substring(F.sha2(text, 256), 1, 16), "aligned_at_utc", "source_id", "metric_name").limit(window.rows)
    return in_range(observations, "aligned_at_utc", window)


# --- forward fill ---------------------------------------------------------------------------------------------------


def validity(observations: DataFrame, start: Column, end: Column) -> DataFrame:
    """How long each observation holds within [start, end): until the metric's next one. Of several at one instant the
    last ingested holds. Intervals of a metric tile its part of the window without overlap."""
    key = W.partitionBy("source_id", "metric_name")
    once = observations.withColumn("r__", F.row_number().over(W.partitionBy("source_id", "metric_name", "aligned_at_utc").orderBy(F.desc("latest_ingested_at_utc")))).where("r__ = 1").drop("r__")
    following = F.lead("aligned_at_utc").over(key.orderBy("aligned_at_utc"))
    spans = once.withColumns({"valid_from_utc": F.greatest(F.col("aligned_at_utc"), start), "valid_to_utc_exclusive": F.least(F.coalesce(following, end), end)})
    return spans.where((F.col("valid_to_utc_exclusive") > F.col("valid_from_utc")) & (F.col("valid_to_utc_exclusive") > start) & (F.col("valid_from_utc") < end))


def prior_state(observations: DataFrame, start: Column) -> DataFrame:
    """The last observation of each metric before the start; an aggregation over all history, never a sort of it."""
    before = observations.where(F.col("aligned_at_utc") < start)
    row = F.struct(*observations.columns)
    return before.groupBy("source_id", "metric_name").agg(F.max_by(row, F.struct("aligned_at_utc", "latest_ingested_at_utc")).alias("o")).select("o.*")


def forward_fill(observations: DataFrame, window: TimeRange, prior: DataFrame | None = None) -> DataFrame:
    """Validity intervals in a range: observations in it, and the state before it (prior, or that of all earlier ones)."""
    start, end = F.lit(instant(window.start)), F.lit(instant(window.end))
    inside = observations.where((F.col("aligned_at_utc") >= start) & (F.col("aligned_at_utc") < end))
    both = inside.unionByName(prior_state(observations, start) if prior is None else prior)
    return validity(both, start, end).orderBy("source_id", "metric_name", "valid_from_utc")


# --- queries --------------------------------------------------------------------------------------------------------


def query_aligned(buckets: DataFrame, dataset: str, window: Window, select_columns: Sequence[str] | None = None, iso: bool = False, filters: Sequence[Mapping[str, Any]] | None = None, fields_first: bool = True) -> DataFrame:
    """An aligned query by its plan: seconds, bucket rows, observations or intervals; then columns and filters.

    fields_first: columns are selected before the filters, which can then use only those (raw requests); else filters
    see all columns and the selection follows (historical requests).
    """
    plan = plan_aligned(dataset, window)
    spec = DATASETS[dataset]
    filled = plan.path.endswith("forward_fill")
    chosen = None if select_columns is None else require_columns(select_columns, aligned_columns(dataset), dataset)
    if chosen and not filled and (extra := [c for c in chosen if c in VALIDITY]):
        raise ValueError(f"columns {extra} exist for forward-filled windows only; dataset={dataset}")
    if spec.bucket_mode == "exchange":
        df = exchange_seconds(stored(buckets, dataset, plan.window), spec.source)
    elif spec.bucket_mode == "stream":
        df = stream_buckets(stored(buckets, dataset, plan.window), dataset)
    elif spec.bucket_mode == "derived":
        if filled:
            start = F.lit(instant(plan.window.start))
            last = stored(buckets, dataset, AllRows()).where(F.col("aligned_at_utc") < start).orderBy(F.desc("aligned_at_utc"), F.desc("first_source_offset")).limit(1)
            df = forward_fill(derived_observations(stored(buckets, dataset, plan.window), dataset), plan.window, derived_observations(last, dataset))
        else:
            df = derived_observations(stored(buckets, dataset, plan.window), dataset).orderBy("aligned_at_utc", "source_id", "metric_name")
    else:
        every = metric_observations(stored(buckets, dataset, AllRows()))
        df = forward_fill(every, plan.window) if filled else metric_window(every, plan.window).orderBy("aligned_at_utc", "source_id", "metric_name")
    df = iso_text(df) if iso else df
    if fields_first:
        return apply_filters(df.select(*chosen) if chosen else df, filters)
    df = apply_filters(df, filters)
    return df.select(*chosen) if chosen else df


def on_grid(intervals: Sequence[tuple[str, DataFrame]], start: str, end: str, seconds: int = 1) -> DataFrame:
    """Extension: several sources' intervals on one grid of instants, a column each, the value that holds then.

    Each interval is spread over the instants in it by a generated sequence, so the join is an equi-join.
    """
    base = None
    for name, frame in intervals:
        first = F.timestamp_seconds(seconds * F.ceil(F.unix_micros("valid_from_utc") / (seconds * 1_000_000)))
        last = F.timestamp_micros(F.unix_micros("valid_to_utc_exclusive") - 1)
        points = frame.where(first <= last).select(F.explode(F.sequence(first, last, F.expr(f"interval {seconds} second"))).alias("aligned_at_utc"), F.col("metric_value_float").alias(name))
        points = points.where(F.col("aligned_at_utc").between(F.lit(instant(start)), F.lit(instant(end))))
        base = points if base is None else base.join(points, "aligned_at_utc", "full")
    return base.orderBy("aligned_at_utc")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
