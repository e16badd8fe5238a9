"""Sinks, state tables, streams and the facade over the driver's tables, written to and read from the shared folder."""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.api import HistoricalData, Service, Tables
from tidemark.catalog import DATASETS, EVENT
from tidemark.cluster import checkpoint_folder
from tidemark.operators import eventlog, native, proofs, serving, sinks, state
from tidemark.plans import windows
from tidemark.queries.base import query, table
from tidemark.queries.payloads import buckets_of, events_sql, log_of, native_of, native_sql
from tidemark.sources import etf, feeds
from tidemark.streaming import projector

T0 = datetime(2024, 3, 1, tzinfo=UTC)


def folder(spark: SparkSession) -> str:
    """A new folder in the one that driver and executors share."""
    return f"{checkpoint_folder(spark)}/queries/{uuid.uuid4().hex}"


def local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def _made(dataset: str, select: str) -> str:
    return f"with {events_sql(dataset)} {select}"


# --- sinks ------------------------------------------------------------------------------------------------------------


@query("snk_01_export", "select n_nationkey, n_name, form, (select count(*) from nation) as row_count, true as digest_ok from nation, (values ('csv'), ('parquet')) f(form)")
def _(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    out = []
    for form in ("csv", "parquet"):
        path = local(folder(spark))
        meta = sinks.export(n, path, form)
        told = json.loads((Path(path) / "metadata.json").read_text())
        ok = hashlib.sha256((Path(path) / told["file"]).read_bytes()).hexdigest() == told["sha256"] == meta["sha256"]
        back = spark.read.schema(n.schema).option("header", True).csv(f"{path}/data") if form == "csv" else spark.read.parquet(f"{path}/data")
        out.append(back.withColumns({"form": F.lit(form), "row_count": F.lit(meta["row_count"]).cast("long"), "digest_ok": F.lit(ok)}))
    return out[0].unionByName(out[1])


@query("snk_03_new_partition", _made("binance_spot_trades", "select partition_id, count(*) as n, true as refused from made group by 1"))
def _(spark, d):
    path, rows = folder(spark), log_of(spark, d, "binance_spot_trades").coalesce(1)
    sinks.insert_new_partition(rows, path, "partition_id")
    try:
        sinks.insert_new_partition(rows, path, "partition_id")
        refused = False
    except ValueError:
        refused = True
    return spark.read.parquet(path).groupBy(F.col("partition_id").cast("string").alias("partition_id")).agg(F.count(F.lit(1)).alias("n")).withColumn("refused", F.lit(refused))


@query("snk_04_writer_modes", "select (select count(*) from events) as first, count(*) filter (event_id % 3 <> 0) as second, (select count(*) from events) as stored from events")
def _(spark, d):
    path, rows = folder(spark), log_of(spark, d, "binance_spot_trades")
    some = F.col("source_offset").cast("long") % 3 == 0
    first = sinks.write_frame(rows.where(some), path, "assume_new_partition")
    second = sinks.write_frame(rows, path, "writer")
    return spark.createDataFrame([(first + second, second, spark.read.parquet(path).count())], "first long, second long, stored long")


@query("snk_02_append_twice", "select event_type as stream_id, count(*) as n from events group by 1")
def _(spark, d):
    from tidemark.queries.base import log

    path, rows = folder(spark), log(spark, d)
    sinks.append_events(rows.where(F.col("source_offset").cast("long") % 2 == 0), path)
    sinks.append_events(rows, path)
    if sinks.append_events(rows, path):
        raise ValueError("a third append added rows")
    return spark.read.parquet(path).groupBy("stream_id").agg(F.count(F.lit(1)).alias("n"))


@query("snk_05_native", f"select strftime(datetime, '%Y-%m') as month, count(*) as n, min(trade_id) as first_id from ({native_sql('okx_spot_trades')}) group by 1")
def _(spark, d):
    path = folder(spark)
    sinks.append_native(native_of(spark, d, "okx_spot_trades"), path, "datetime", ["datetime", "trade_id"])
    return spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.min("trade_id").alias("first_id"))


@query("snk_06_buckets", _made("bitcoin_mempool_state", "select partition_id, count(distinct t) as buckets, count(*) as events from made group by 1"))
def _(spark, d):
    path = folder(spark)
    sinks.insert_new_partition(buckets_of(spark, d, "bitcoin_mempool_state"), path, "partition_id")
    return spark.read.parquet(path).groupBy(F.date_format("partition_id", "yyyy-MM-dd").alias("partition_id")).agg(F.count(F.lit(1)).alias("buckets"), F.sum("bucket_event_count").alias("events"))


@query("snk_07_replace_month", "select strftime(o_orderdate, '%Y-%m') as month, count(*) as n, sum(case when strftime(o_orderdate, '%Y-%m') = '1995-02' then 1 else 0 end)::bigint as changed from orders group by 1")
def _(spark, d):
    path = folder(spark)
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.lit(0).alias("changed"))
    sinks.replace_partitions(o, path, "month")
    sinks.replace_partitions(o.where("month = '1995-02'").withColumn("changed", F.lit(1)), path, "month")
    return spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum("changed").alias("changed"))


@query("snk_08_artifacts", "select sha256(r_name) as sha256, length(r_name) as bytes, 1::bigint as files from region")
def _(spark, d):
    path = local(folder(spark))
    out = []
    for r in table(spark, d, "region").select("r_name").collect():
        m = [sinks.persist_artifact(path, "regions", r["r_name"].encode(), "text/plain", T0) for _ in range(2)][1]
        out.append((m["sha256"], m["bytes"], len(list(Path(path).rglob(f"{m['sha256']}/content")))))
    return spark.createDataFrame(out, "sha256 string, bytes long, files long")


_ISSUER = etf.Issuer("etf_region", {"net_assets": "net_assets", "shares": "shares_outstanding"}, {"net_assets": "USD"}, ["shares"], "date", ["shares"])


def _parsed(spark, d) -> DataFrame:
    n = table(spark, d, "nation")
    fields = F.create_map(F.lit("date"), F.lit("01/15/2024"), F.lit("net_assets"), F.when(F.col("n_nationkey") % 4 == 0, "-").otherwise(F.concat(F.lit("$"), F.col("n_nationkey").cast("string"), F.lit(".5M"))), F.lit("shares_outstanding"), F.concat((F.col("n_nationkey") + 1).cast("string"), F.lit(",000")), F.lit("other"), F.lit("x"))
    return n.select(F.col("n_name").alias("artifact_id"), F.lit("html").alias("parser"), F.col("n_nationkey").cast("long").alias("record_index"), fields.alias("fields"))


_FUND = """select sha256('etf_region|2024-01-15:' || k || '|' || m || '|' || t) as metric_id, m as metric_name, v as metric_value_float, timestamp '2024-01-15' as observed_at_utc from (
  select n_nationkey as k, 'net_assets' as m, case when n_nationkey % 4 = 0 then '-' else '$' || n_nationkey || '.5M' end as t, case when n_nationkey % 4 = 0 then null else (n_nationkey + 0.5)::double * 1000000 end as v from nation
  union all select n_nationkey, 'shares', (n_nationkey + 1) || ',000', (n_nationkey + 1)::double * 1000 from nation)"""


@query("src_17_fund_records", _FUND)
def _(spark, d):
    return etf.normalise(_parsed(spark, d), _ISSUER).select("metric_id", "metric_name", "metric_value_float", "observed_at_utc")


@query("snk_09_metric_staging", f"select metric_name, count(distinct metric_id) as rows, 0::bigint as again from ({_FUND}) group by 1")
def _(spark, d):
    path, rows = folder(spark), etf.normalise(_parsed(spark, d), _ISSUER)
    sinks.persist_metrics(rows, path)
    again = sinks.persist_metrics(rows, path)
    return spark.read.parquet(path).groupBy("metric_name").agg(F.count(F.lit(1)).alias("rows")).withColumn("again", F.lit(again).cast("long"))


#: Order keys that a page of a series bundle spans.
_PAGE = 50_000


def _bundles(spark, d) -> DataFrame:
    o = F.struct(F.lit("2024-01-01").alias("realtime_start"), F.lit("9999-12-31").alias("realtime_end"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderkey").cast("string").alias("value"))
    made = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("series_id"), F.floor(F.col("o_orderkey") / _PAGE).cast("long").alias("page")).agg(F.to_json(F.array_sort(F.collect_list(o))).alias("observations"))
    return made.select("series_id", "page", F.lit("USD").alias("unit"), F.lit("2024-01-05").alias("last_updated"), "observations")


@query("snk_10_series", "select 'fred_' || lower(o_orderstatus) as source_id, count(*) as rows, 1::bigint as bundles, 0::bigint as again from orders group by 1")
def _(spark, d):
    path, bundles = folder(spark), _bundles(spark, d)
    long = feeds.series_observations(bundles)
    sinks.persist_metrics(long, f"{path}/long")
    sinks.persist_bundles(bundles, f"{path}/raw", T0)
    again = sinks.persist_metrics(long, f"{path}/long") + sinks.persist_bundles(bundles, f"{path}/raw", T0)
    kept = spark.read.parquet(f"{path}/raw").groupBy(F.concat(F.lit("fred_"), F.lower("series_id")).alias("source_id")).agg(F.count_distinct("bundle_sha256").alias("bundles"))
    return spark.read.parquet(f"{path}/long").groupBy("source_id").agg(F.count(F.lit(1)).alias("rows")).join(kept, "source_id").withColumn("again", F.lit(again).cast("long"))


@query("snk_11_audit_chain", "select r_regionkey as sequence, r_name as kind, true as linked from region")
def _(spark, d):
    path = f"{local(folder(spark))}.jsonl"
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    for r in table(spark, d, "region").orderBy("r_regionkey").collect():
        sinks.append_audit(path, r["r_name"], {"key": r["r_regionkey"]}, T0)
    sinks.check_audit(path)
    chain = spark.read.json(path)
    broken = sinks.broken_links(chain).select("sequence", F.lit(False).alias("linked"))
    return chain.select("sequence", "kind").join(broken, "sequence", "left").select("sequence", "kind", F.coalesce("linked", F.lit(True)).alias("linked"))


@query("snk_12_manifest", "select r_name as partition_id, 'written' as event, '2024-03-01T00:00:00+00:00' as at_utc from region")
def _(spark, d):
    path = f"{local(folder(spark))}/manifest.jsonl"
    for r in table(spark, d, "region").select("r_name").collect():
        sinks.append_manifest(path, "written", {"partition_id": r["r_name"]}, T0)
    return spark.read.json(path).select("partition_id", "event", "at_utc")


@query("snk_13_envelope", "select 'native' as mode, count(*) as row_count, 'trade_id bigint,price double' as schema, max(event_id) as last_id from events")
def _(spark, d):
    out = sinks.stored_envelope(native_of(spark, d, "binance_spot_trades").select("trade_id", "price"), "native", "binance_spot_trades", folder(spark))
    last = spark.read.parquet(out["rows_path"]).agg(F.max("trade_id")).first()[0]
    return spark.createDataFrame([(out["mode"], out["row_count"], ",".join(f"{c['name']} {c['dtype']}" for c in out["schema"]), last)], "mode string, row_count long, schema string, last_id long")


@query("snk_14_reset", """select 'log' as name, count(*) filter (cast(ts as date) = date '2024-01-09') as gone, count(*) filter (cast(ts as date) <> date '2024-01-09') as remain from events
union all select 'buckets', count(distinct date_trunc('hour', ts)) filter (cast(ts as date) = date '2024-01-09'), count(distinct date_trunc('hour', ts)) filter (cast(ts as date) <> date '2024-01-09') from events union all select 'none', 0, 0""")
def _(spark, d):
    path = folder(spark)
    log_of(spark, d, "bitcoin_mempool_state").write.partitionBy("partition_id").parquet(f"{path}/log")
    buckets_of(spark, d, "bitcoin_mempool_state").write.partitionBy("partition_id").parquet(f"{path}/buckets")
    names = {n: f"{path}/{n}" for n in ("log", "buckets", "none")}
    gone = sinks.reset_partition(spark, names, {"partition_id": "2024-01-09", "stream_id": "bitcoin_mempool_state"})
    return spark.createDataFrame([(n, gone[n], spark.read.parquet(p).count() if sinks.exists(spark, p) else 0) for n, p in names.items()], "name string, gone long, remain long")


# --- state ------------------------------------------------------------------------------------------------------------


def _streams(spark, d) -> DataFrame:
    return table(spark, d, "events").groupBy(F.lit("s").alias("source_id"), F.col("event_type").alias("stream_id"), F.date_format("ts", "yyyy-MM-dd").alias("partition_id"))


@query("str_06_policies", "select distinct event_type as stream_id, case when event_type = 'click' then 60 else 1 end as bucket_size_seconds, case when event_type = 'click' then 2 else 1 end as revision from events")
def _(spark, d):
    t = state.StateTable(spark, folder(spark), state.POLICY, ("source_id", "stream_id"))
    names = table(spark, d, "events").select(F.lit("s").alias("source_id"), F.col("event_type").alias("stream_id"), F.lit(1).cast("long").alias("bucket_size_seconds"), F.lit("hot").alias("tier"), F.lit(7).cast("long").alias("hot_days"), F.lit(90).cast("long").alias("warm_days")).distinct()
    state.set_policies(t, names)
    state.set_policies(t, names)  # a duplicate
    state.set_policies(t, names.where("stream_id = 'click'").withColumn("bucket_size_seconds", F.lit(60).cast("long")))
    sizes = state.bucket_sizes(t)
    return t.latest().select("stream_id", "bucket_size_seconds", "revision").where(F.lit(len(sizes) > 0))


_CURSOR = "source_id string, stream_id string, partition_id string, offset string"


@query("str_08_cursors", "select event_type as stream_id, strftime(ts, '%Y-%m-%d') as partition_id, cast(max(event_id) as varchar) as offset, case when max(event_id) > min(event_id) then 2 else 1 end as revision, case when max(event_id) > min(event_id) then 2 else 1 end as ledger_rows from events group by 1, 2")
def _(spark, d):
    path = folder(spark)
    t = state.StateTable(spark, f"{path}/cursors", _CURSOR)
    ends = _streams(spark, d).agg(F.min("event_id").alias("a"), F.max("event_id").alias("b"))
    none = F.lit(None).cast("string")
    state.advance_cursors(t, f"{path}/ledger", ends.select(*eventlog.STREAM, F.col("a").cast("string").alias("offset"), none.alias("expected_previous")), "numeric")
    state.advance_cursors(t, f"{path}/ledger", ends.where("b > a").select(*eventlog.STREAM, F.col("b").cast("string").alias("offset"), F.col("a").cast("string").alias("expected_previous")), "numeric")
    for wrong in ("0", "999999999"):
        try:
            state.advance_cursors(t, f"{path}/ledger", ends.select(*eventlog.STREAM, F.col("b").cast("string").alias("offset"), F.lit(wrong).alias("expected_previous")), "numeric")
        except ValueError:
            continue
        raise ValueError("a cursor moved from where it was not")
    rows = spark.read.parquet(f"{path}/ledger").groupBy("stream_id", "partition_id").agg(F.count(F.lit(1)).cast("int").alias("ledger_rows"))
    return t.latest().select("stream_id", "partition_id", "offset", F.col("revision").cast("int").alias("revision")).join(rows, ["stream_id", "partition_id"])


_COMPLETE, _QUARANTINE = "source_id string, stream_id string, partition_id string, expected long, observed long, gap long, status string", "source_id string, stream_id string, partition_id string, status string, reason string"


@query("str_09_completeness", "with c as (select event_type as stream_id, strftime(ts, '%Y-%m-%d') as partition_id, count(*) as expected, count(*) filter (event_id % 10 <> 0) as observed from events group by 1, 2) select *, expected - observed as gap, case when expected > observed then 'gap_detected' else 'complete' end as status from c")
def _(spark, d):
    path = folder(spark)
    t, q = state.StateTable(spark, f"{path}/complete", _COMPLETE), state.StateTable(spark, f"{path}/quarantine", _QUARANTINE)
    state.record_completeness(t, q, _streams(spark, d).agg(F.count(F.lit(1)).alias("expected"), F.count_if(F.col("event_id") % 10 != 0).alias("observed")))
    return t.latest().select("stream_id", "partition_id", "expected", "observed", "gap", "status")


@query("str_10_quarantine", "with c as (select event_type as stream_id, strftime(ts, '%Y-%m-%d') as partition_id, bool_or(event_id % 10 = 0) as bad from events group by 1, 2) select e.event_type as stream_id, count(*) as n from events e join c on c.stream_id = e.event_type and c.partition_id = strftime(e.ts, '%Y-%m-%d') where not c.bad or e.event_type = 'view' group by 1")
def _(spark, d):
    from tidemark.queries.base import log

    path = folder(spark)
    t, q = state.StateTable(spark, f"{path}/complete", _COMPLETE), state.StateTable(spark, f"{path}/quarantine", _QUARANTINE)
    counts = _streams(spark, d).agg(F.count(F.lit(1)).alias("expected"), F.count_if(F.col("event_id") % 10 != 0).alias("observed"))
    state.record_completeness(t, q, counts)
    state.release(q, counts.where("stream_id = 'view'"), "checked")
    rows = log(spark, d).withColumn("source_id", F.lit("s"))
    return eventlog.without_quarantined(rows, q.rows()).groupBy("stream_id").agg(F.count(F.lit(1)).alias("n"))


@query("str_11_partition_states", "select distinct event_type as stream_id, strftime(ts, '%Y-%m-%d') as partition_id, case when event_type = 'error' then 'quarantined' else 'proved_complete' end as state, 3 as revision from events")
def _(spark, d):
    t = state.StateTable(spark, folder(spark), "source_id string, stream_id string, partition_id string, state string, reason string")
    keys = _streams(spark, d).agg(F.count(F.lit(1)).alias("n")).drop("n")
    for s in ("source_manifested", "canonical_written_unproved"):
        state.move_partitions(t, keys.withColumns({"state": F.lit(s), "reason": F.lit("r")}))
    state.move_partitions(t, keys.withColumns({"state": F.when(F.col("stream_id") == "error", "quarantined").otherwise("proved_complete"), "reason": F.lit("r")}))
    try:
        state.move_partitions(t, keys.withColumns({"state": F.lit("empty_proved"), "reason": F.lit("r")}))
    except ValueError:
        return t.latest().select("stream_id", "partition_id", "state", F.col("revision").cast("int").alias("revision"))
    raise ValueError("a partition went where it cannot go")


@query("str_15_height_ranges", "select distinct lpad(cast(o_orderkey // 144 * 144 as varchar), 12, '0') || '-' || lpad(cast(o_orderkey // 144 * 144 + 143 as varchar), 12, '0') as partition_id, o_orderkey // 144 * 144 as first, o_orderkey // 144 * 144 + 143 as last from orders")
def _(spark, d):
    starts = [r[0] for r in table(spark, d, "orders").select(F.expr("o_orderkey div 144 * 144")).distinct().collect()]
    ids = [proofs.height_partition(s, s + 143) for s in starts]
    return spark.createDataFrame([(i, *proofs.height_range(i)) for i in ids], "partition_id string, first long, last long")


@query("str_16_rate_gate", "select k, cast(k * 0.75 as double) as waited from range(0, 6) t(k)")
def _(spark, d):
    clock = [0.0]
    gate = feeds.RateGate(0.75, lambda: clock[0], lambda s: clock.__setitem__(0, clock[0] + s))
    out = []
    for k in range(6):
        gate.wait()
        out.append((k, clock[0]))
    return spark.createDataFrame(out, "k long, waited double")


@query("str_17_incremental", "with c as (select o_orderstatus as series_id, min(cast(o_orderdate as date)) as low, max(cast(o_orderdate as date)) as high from orders group by 1) select series_id, (low + 1)::date as start, least(high, date '1998-01-01') as until from c where (low + 1)::date <= least(high, date '1998-01-01')")
def _(spark, d):
    from datetime import date

    c = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("series_id"), F.floor(F.col("o_orderkey") / _PAGE).cast("long").alias("page")).agg(F.to_date(F.min("o_orderdate")).alias("low"), F.to_date(F.max("o_orderdate")).alias("high"))
    spans = [(r["series_id"], feeds.incremental_range(r["low"], r["low"], r["high"], date(1998, 1, 1))) for r in c.collect()]
    return spark.createDataFrame([(s, *x) for s, x in spans if x], "series_id string, start date, until date")


# --- streams ----------------------------------------------------------------------------------------------------------


def _projected(spark, d) -> str:
    """The log in two appends, projected after each, in small batches."""
    path, rows = folder(spark), log_of(spark, d, "bitcoin_mempool_state")
    early = F.col("source_event_time") < "2024-01-15"
    for part in (rows.where(early), rows.where(~early)):
        part.select(*(F.col(c) for c in spark.createDataFrame([], EVENT).columns)).repartition(3).write.mode("append").parquet(f"{path}/log")
        projector.align(spark, f"{path}/log", f"{path}/out", f"{path}/checkpoint", files_per_batch=2)
    return path


@query("str_01_resumed_batches", _made("bitcoin_mempool_state", "select partition_id, count(*) as events, count(distinct t) as seconds from made group by 1"))
def _(spark, d):
    rows = projector.projected(spark, f"{_projected(spark, d)}/out")
    return rows.groupBy("partition_id").agg(F.sum("bucket_event_count").alias("events"), F.count_distinct("aligned_at_utc").alias("seconds"))


@query("str_03_watermarks", _made("bitcoin_mempool_state", "select partition_id, count(*) as events, max(ingested_at) as ingested_at from made group by 1"))
def _(spark, d):
    return projector.watermarks(spark, f"{_projected(spark, d)}/out").select("partition_id", "events", "ingested_at")


@query("str_02_commits", "select count(distinct cast(ts as date)) as partitions, true as rising from events")
def _(spark, d):
    out = f"{_projected(spark, d)}/out"
    marks = projector.watermarks(spark, out)
    rows = spark.read.parquet(f"{out}/watermarks")
    once = rows.groupBy("batch", "partition_id").count().where("count > 1").isEmpty()
    return marks.agg(F.count_distinct("partition_id").alias("partitions")).withColumn("rising", F.lit(once))


@query("str_05_late_events", "select strftime(ts, '%Y-%m-%d') as partition_id, count(*) as n from events group by 1")
def _(spark, d):
    """Native rows of the projected log, where the later half of each partition comes first."""
    path, rows = folder(spark), log_of(spark, d, "binance_spot_trades").select(*spark.createDataFrame([], EVENT).columns)
    odd = F.col("source_offset").cast("long") % 2 == 1
    for part in (rows.where(odd), rows.where(~odd)):
        part.write.mode("append").parquet(f"{path}/log")
        projector.project(spark, f"{path}/log", f"{path}/out", f"{path}/checkpoint", lambda e: projector.native_rows(e, "binance_spot_trades"))
    return projector.projected(spark, f"{path}/out").groupBy(F.date_format("datetime", "yyyy-MM-dd").alias("partition_id")).agg(F.count(F.lit(1)).alias("n"))


# --- sources with clients ---------------------------------------------------------------------------------------------


class _Node:
    """A stand-in for a node's client."""

    def getblockcount(self):
        return 20

    def getblockhash(self, h):
        return f"{h:064x}"

    def getblock(self, h, verbosity):
        n = int(h, 16)
        return {"hash": h, "previousblockhash": f"{n - 1:064x}", "merkleroot": "m", "version": 1, "nonce": n, "difficulty": "1.5", "time": 1_700_000_000 + n, "tx": []}


@query("src_14_node_blocks", "select k as height, lpad(to_hex(k), 64, '0') as block_hash, lpad(to_hex(k - 1), 64, '0') as prev_hash, (1700000000 + k) * 1000 as timestamp_ms from range(5, 16) t(k)")
def _(spark, d):
    h = feeds.headers_of(feeds.blocks(spark, _Node(), 5, 15))
    return h.select("height", F.upper("block_hash").alias("block_hash"), F.upper("prev_hash").alias("prev_hash"), "timestamp_ms")


@query("src_15_halved_fetch", "select r_regionkey as id from region")
def _(spark, d):
    ids = [r[0] for r in table(spark, d, "region").select("r_regionkey").orderBy("r_regionkey").collect()]

    def fetch(part):
        if len(part) > 2:
            raise ValueError("too many")
        return part

    return spark.createDataFrame([(int(i),) for i in feeds.fetch_in_halves(fetch, ids)], "id long")


@query("src_16_registry", "select r_name as series_id from region")
def _(spark, d):
    path = folder(spark)
    table(spark, d, "region").select(F.col("r_name").alias("series_id"), F.lit("USD").alias("unit")).coalesce(1).write.json(path)
    rows = spark.read.json(path)
    rows.agg(F.to_json(F.struct(F.collect_list(F.struct("series_id", "unit")).alias("series"))).alias("value")).coalesce(1).write.text(f"{path}-one")
    return feeds.registry(spark, f"{path}-one").select("series_id")


class _Web:
    def get(self, url):
        return url.encode(), "text/plain"


@query("src_18_fetched_artifacts", "select r_name as url, sha256(r_name) as sha256, true as refused from region")
def _(spark, d):
    out = []
    for r in table(spark, d, "region").select("r_name").collect():
        got = etf.fetch_artifact(_Web(), "regions", r["r_name"])
        try:
            etf.fetch_artifact(_Web(), "regions", r["r_name"], "wrong")
            refused = False
        except ValueError:
            refused = True
        out.append((got["url"], got["sha256"], refused))
    return spark.createDataFrame(out, "url string, sha256 string, refused boolean")


@query("src_13_source_days", "select strftime(d, '%Y-%m-%d') as day, epoch_us(d - interval 8 hours) // 1000 as first_ms, 'f.zip' as file from generate_series(timestamp '2024-01-01', timestamp '2024-01-10', interval 1 day) s(d)")
def _(spark, d):
    from datetime import date

    days = proofs.days(spark, date(2024, 1, 1), date(2024, 1, 10)).select(F.col("partition_id").alias("day"))
    name, _ = etf.download_link({"code": "0", "data": {"details": [{"groupDetails": [{"filename": "f.zip", "url": "u"}]}]}}, "2024-01-01")
    return days.select("day", F.unix_millis(F.to_timestamp("day") - F.expr("interval 8 hours")).alias("first_ms"), F.lit(name).alias("file"))


# --- the facade -------------------------------------------------------------------------------------------------------


def _tables(spark, d) -> Tables:
    frames = {n: native_of(spark, d, n) for n in DATASETS}
    return Tables(spark, frames=frames | {"aligned_1s": buckets_of(spark, d, "okx_spot_trades").unionByName(buckets_of(spark, d, "bitcoin_mempool_state"))})


@query("src_04_dispatcher", " union all ".join(f"select '{n}' as dataset, count(*) as n from ({native_sql(n)}) where {s.time_column} >= timestamp '1995-01-01' and {s.time_column} < timestamp '2024-01-10'" for n, s in DATASETS.items()))
def _(spark, d):
    tables, out = _tables(spark, d), None
    for n in DATASETS:
        one = native.query_native(tables.native(n), n, windows.TimeRange("1995-01-01T00:00:00Z", "2024-01-10T00:00:00Z")).agg(F.lit(n).alias("dataset"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("api_01_spot_trades", f"select trade_id, timestamp, price, size as quantity, case when side = 'buy' then 0 else 1 end as is_buyer_maker, datetime from ({native_sql('okx_spot_trades')}) where datetime >= timestamp '1995-01-01' and datetime < timestamp '1995-02-11' and size > 10")
def _(spark, d):
    return HistoricalData(_tables(spark, d)).get_okx_spot_trades(start_date="1995-01-01", end_date="1995-02-10", filters=[{"field": "quantity", "op": "gt", "value": 10.0}])


@query("api_02_klines", f"select cast(date_trunc('day', datetime) as timestamp) as datetime, max(price) as high, min(price) as low, count(*) as no_of_trades from ({native_sql('bybit_spot_trades')}) where datetime >= timestamp '1995-01-01' group by 1")
def _(spark, d):
    return HistoricalData(_tables(spark, d)).get_bybit_spot_klines(start_date="1995-01-01", kline_size=86_400, fields=["datetime", "high", "low", "no_of_trades"])


@query("api_02_metrics", f"select metric_name, metric_value_string, observed_at_utc from ({native_sql('etf_daily_metrics')}) where observed_at_utc < timestamp '2024-01-06' and metric_name = 'm1'")
def _(spark, d):
    return HistoricalData(_tables(spark, d)).get_etf_daily_metrics(end_date="2024-01-05", fields=["metric_name", "metric_value_string", "observed_at_utc"], filters=[{"field": "metric_name", "op": "eq", "value": "m1"}])


@query("api_02_aligned", "select cast(date_trunc('hour', ts) as timestamp) as aligned_at_utc, count(*) as tx_count from events where ts >= timestamp '2024-01-03' and ts < timestamp '2024-01-06' group by 1")
def _(spark, d):
    return HistoricalData(_tables(spark, d)).get_bitcoin_mempool_state(mode="aligned_1s", start_date="2024-01-03", end_date="2024-01-05", fields=["aligned_at_utc", "tx_count"])


@query("api_03_raw_query", "select event_id as trade_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(cast(epoch_us(ts) // 1000 % 1000 as varchar), 3, '0') || 'Z' as datetime from events where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-09'")
def _(spark, d):
    out = Service(_tables(spark, d)).query({"sources": ["binance_spot_trades"], "fields": ["trade_id"], "time_range": ("2024-01-08T00:00:00Z", "2024-01-09T00:00:00Z")})
    return spark.createDataFrame([(r["trade_id"], r["datetime"]) for r in out["rows"]], "trade_id long, datetime string")


@query("api_05_window_rules", "select * from (values (0, false), (1, true), (2, true), (3, false)) t(k, accepted)")
def _(spark, d):
    out = []
    for given in ({"n_rows": 5, "n_random": 5}, {}, {"month_year": (1, 2024)}, {"n_rows": 0}):
        try:
            windows.resolve(**given)
            out.append(True)
        except ValueError:
            out.append(False)
    return spark.createDataFrame(list(enumerate(out)), "k int, accepted boolean")


_RIGHTS = {"sources": [{"source": "a", "datasets": ["x"], "rights_state": "Hosted Allowed", "legal_signoff_artifact": "s"}, {"source": "b", "datasets": ["y"], "rights_state": "BYOK Required"}, {"source": "c", "datasets": ["z"], "rights_state": "Ingest Only"}]}


@query("src_20_rights", "select * from (values ('x', true, true), ('y', false, true), ('z', false, false), ('w', false, false)) t(dataset, open, with_key)")
def _(spark, d):
    path = f"{local(folder(spark))}/rights.json"
    Path(path).parent.mkdir(parents=True)
    Path(path).write_text(json.dumps(_RIGHTS))
    matrix = serving.load_rights(path)

    def allowed(name, token=None):
        try:
            return bool(serving.rights_decision(matrix, name, token))
        except PermissionError:
            return False

    return spark.createDataFrame([(n, allowed(n), allowed(n, "key")) for n in "xyzw"], "dataset string, open boolean, with_key boolean")


@query("api_08_export_job", "select n_nationkey from nation where false union all select count(*) from events where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-09'")
def _(spark, d):
    meta = Service(_tables(spark, d)).export({"sources": ["binance_spot_trades"], "time_range": ("2024-01-08T00:00:00Z", "2024-01-09T00:00:00Z")}, local(folder(spark)))
    return spark.createDataFrame([(meta["row_count"],)], "n_nationkey long")


