import hashlib
import json
import uuid
from datetime import UTC, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import identity
from tidemark.operators import aligned, bars, eventlog
from tidemark.plans.windows import AllRows, LatestRows, Month, RandomRows, TimeRange

T0 = datetime(2024, 1, 1, tzinfo=UTC)


def log(spark, rows, source="binance", stream="binance_spot_trades"):
    """rows: offset, seconds after T0, payload dict"""
    frame = spark.createDataFrame([(source, stream, "2024-01-01", str(o), T0 + timedelta(seconds=s), json.dumps(p, sort_keys=True, separators=(",", ":"))) for o, s, p in rows], "source_id string, stream_id string, partition_id string, source_offset string, source_event_time timestamp, payload_json string")
    return eventlog.envelope(frame, F.lit(T0 + timedelta(days=1)))


def test_event_ids_are_uuid5(spark):
    rows = log(spark, [(7, 0, {"a": 1})]).collect()
    assert rows[0]["event_id"] == str(uuid.uuid5(identity.EVENT_NAMESPACE, "1|binance|binance_spot_trades|2024-01-01|7"))
    with pytest.raises(Exception, match="must be set"):
        log(spark, [(" ", 0, {"a": 1})]).collect()


def test_seconds_merge_stored_rows(spark):
    trade = lambda p, q: {"price": str(p), "qty": str(q), "quote_qty": str(p * q)}
    first = aligned.bucketise(log(spark, [(101, 0.2, trade(101.0, 2.0))]))
    second = aligned.bucketise(log(spark, [(100, 0.1, trade(100.0, 1.0)), (102, 1.0, trade(102.0, 0.5))]))
    buckets = first.unionByName(second)
    rows = aligned.query_aligned(buckets, "binance_spot_trades", AllRows()).collect()
    assert [tuple(r)[1:] for r in rows] == [(100.0, 101.0, 100.0, 101.0, 3.0, 302.0, 2), (102.0, 102.0, 102.0, 102.0, 0.5, 51.0, 1)]
    assert aligned.query_aligned(buckets, "binance_spot_trades", AllRows(), iso=True).first()["aligned_at_utc"] == "2024-01-01T00:00:00.000Z"
    assert aligned.query_aligned(buckets, "binance_spot_trades", LatestRows(1)).count() == 1
    assert aligned.query_aligned(buckets, "binance_spot_trades", RandomRows(2)).count() in (1, 2)
    only = aligned.query_aligned(buckets, "binance_spot_trades", AllRows(), ["open_price"], filters=[{"field": "close_price", "op": "gte", "value": 102.0}], fields_first=False)
    assert only.columns == ["open_price"] and only.count() == 1
    with pytest.raises(ValueError, match="not available"):
        aligned.query_aligned(buckets, "binance_spot_trades", AllRows(), ["open_price"], filters=[{"field": "close_price", "op": "gte", "value": 1.0}])


def test_offsets_order_as_numbers_before_text(spark):
    trade = lambda p: {"price": str(p), "qty": "1"}
    rows = aligned.bucketise(log(spark, [(10, 0, trade(5.0)), (9, 0.5, trade(7.0)), ("m-1", 0.1, trade(3.0))]))
    r = aligned.query_aligned(rows, "binance_spot_trades", AllRows()).first()
    assert (r["open_price"], r["close_price"]) == (7.0, 3.0)


def test_other_exchanges_take_price_by_size(spark):
    rows = aligned.bucketise(log(spark, [(1, 0, {"price": "2.5", "size": "4", "quote_qty": "99"})], "okx", "okx_spot_trades"))
    assert aligned.query_aligned(rows, "okx_spot_trades", AllRows()).first()["quote_volume_sum"] == 10.0


def test_bucket_json_and_digest_are_canonical(spark):
    events = log(spark, [(1, 0.5, {"p": 'a"b'}), (2, 0.25, {"p": "c"})])
    b = aligned.bucketise(events).first()
    rows = [
        {"event_id": e["event_id"], "source_offset_or_equivalent": e["source_offset"], "source_event_time_utc": e["source_event_time"].replace(tzinfo=UTC).isoformat(), "ingested_at_utc": e["ingested_at"].replace(tzinfo=UTC).isoformat(), "payload_json": e["payload_json"], "payload_sha256_raw": e["payload_sha256"]}
        for e in sorted(events.collect(), key=lambda e: e["source_event_time"])
    ]
    want = json.dumps({"rows": rows}, sort_keys=True, separators=(",", ":"), ensure_ascii=True)
    assert b["payload_rows_json"] == want and b["bucket_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert (b["first_source_offset"], b["last_source_offset"]) == ("2", "1")


def test_missing_time_and_bad_json_fail(spark):
    with pytest.raises(Exception, match="source event time"):
        aligned.bucketise(log(spark, [(1, 0, {})]).withColumn("source_event_time", F.lit(None).cast("timestamp"))).collect()
    bad = aligned.bucketise(log(spark, [(1, 0, {})])).withColumn("payload_rows_json", F.lit('{"rows":[]}'))
    with pytest.raises(Exception, match="non-empty"):
        aligned.query_aligned(bad, "binance_spot_trades", AllRows()).collect()


def test_stream_buckets(spark):
    h = lambda n: {"height": n, "block_hash": f"h{n}", "prev_hash": f"h{n - 1}", "merkle_root": "m", "version": 1, "nonce": 2, "difficulty": "3.5", "timestamp_ms": n, "source_chain": "main"}
    rows = aligned.bucketise(log(spark, [(100, 0, h(100)), (101, 0, h(101))], "bitcoin_core", "bitcoin_block_headers"))
    r = aligned.query_aligned(rows, "bitcoin_block_headers", Month(1, 2024)).first()
    assert (r["records_in_bucket"], r["latest_height"], r["latest_block_hash"], r["latest_difficulty"]) == (2, 101, "h101", 3.5)
    t = lambda n, i, o, c: {"block_height": 1, "block_timestamp_ms": 5, "transaction_index": n, "txid": f"t{n}", "coinbase": c, "source_chain": "main", "values_json": json.dumps({"input_value_btc_sum": i, "output_value_btc_sum": o})}
    rows = aligned.bucketise(log(spark, [("1:0", 0, t(0, "0", "6.25", True)), ("1:1", 0, t(1, "1.5", "1.4", False))], "bitcoin_core", "bitcoin_block_transactions"))
    r = aligned.query_aligned(rows, "bitcoin_block_transactions", AllRows()).first()
    assert (r["total_input_value_btc"], r["total_output_value_btc"], r["coinbase_tx_count"], r["tx_count"], r["latest_txid"]) == (1.5, 7.65, 1, 2, "t1")
    m = lambda i, fee, v, rbf: {"snapshot_at_unix_ms": 9, "txid": i, "fee_rate_sat_vb": fee, "vsize": v, "first_seen_timestamp": 3, "rbf_flag": rbf, "source_chain": "main"}
    rows = aligned.bucketise(log(spark, [("9:a", 0, m("a", "10", 100, True)), ("9:b", 0, m("b", "20", 300, False))], "bitcoin_core", "bitcoin_mempool_state"))
    r = aligned.query_aligned(rows, "bitcoin_mempool_state", AllRows()).first()
    assert (r["fee_rate_sat_vb_min"], r["fee_rate_sat_vb_max"], r["fee_rate_sat_vb_avg"], r["total_vsize"], r["rbf_true_count"]) == (10.0, 20.0, 15.0, 400, 1)


def test_derived_observations_and_fill(spark):
    p = lambda v: {"fee_total_btc": str(v), "provenance": {"a": 1}}
    rows = aligned.bucketise(log(spark, [(1, 0, p(1.5)), (2, 0.5, p(2.5)), (3, 100, p(3.5))], "bitcoin_core", "bitcoin_block_fee_totals"))
    obs = aligned.query_aligned(rows, "bitcoin_block_fee_totals", AllRows()).collect()
    assert [(r["metric_value_float"], r["records_in_bucket"], r["metric_name"]) for r in obs] == [(2.5, 2, "block_fee_total_btc"), (3.5, 1, "block_fee_total_btc")]
    filled = aligned.query_aligned(rows, "bitcoin_block_fee_totals", TimeRange("2024-01-01T00:00:50Z", "2024-01-01T00:02:00Z")).collect()
    assert [(r["metric_value_float"], r["valid_from_utc"].second, r["valid_to_utc_exclusive"].minute) for r in filled] == [(2.5, 50, 1), (3.5, 40, 2)]
    with pytest.raises(ValueError, match="forward-filled"):
        aligned.query_aligned(rows, "bitcoin_block_fee_totals", LatestRows(1), ["valid_from_utc"])


def test_metric_observations_keep_the_latest(spark):
    m = lambda v, kind="float": {"record_source_id": "s", "metric_name": "n", "metric_unit": "u", "metric_value_kind": kind, "metric_value_text": v, "metric_value_bool": None, "dimensions": {}, "provenance": None}
    rows = aligned.bucketise(log(spark, [("a", 0, m("1.5")), ("b", 0, m("7", "int"))], "fred", "fred_series_metrics"))
    r = aligned.query_aligned(rows, "fred_series_metrics", LatestRows(5)).first()
    assert (r["metric_value_int"], r["metric_value_float"], r["metric_value_string"], r["records_in_bucket"]) == (7, 7.0, "7", 2)
    bad = aligned.bucketise(log(spark, [("a", 0, m("x", "int"))], "fred", "fred_series_metrics"))
    with pytest.raises(Exception, match="does not fit its kind"):
        aligned.query_aligned(bad, "fred_series_metrics", AllRows()).collect()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), min_size=1, max_size=12))
def test_intervals_tile_the_window(spark, points):
    obs = spark.createDataFrame([(T0 + timedelta(seconds=s), "src", m, float(i), T0) for i, (m, s) in enumerate(points)], "aligned_at_utc timestamp, source_id string, metric_name string, metric_value_float double, latest_ingested_at_utc timestamp")
    got = aligned.forward_fill(obs, TimeRange("2024-01-01T00:00:10Z", "2024-01-01T00:00:30Z")).collect()
    for m in {m for m, _ in points}:
        own = sorted((r["valid_from_utc"].second, r["valid_to_utc_exclusive"].second) for r in got if r["metric_name"] == m)
        start = 10 if any(s <= 10 for n, s in points if n == m) else min((s for n, s in points if n == m and s < 30), default=None)
        if start is None:
            assert not own
        else:
            assert own[0][0] == start and own[-1][1] == 30 and all(a[1] == b[0] for a, b in zip(own, own[1:]))


def test_aligned_bars(spark):
    rows = [(T0, 42000.0, 42003.0, 41999.0, 42001.0, 0.1, 4200.0, 1), (T0 + timedelta(seconds=1), 42001.0, 42002.0, 42000.0, 42002.0, 0.2, 8400.0, 2)]
    df = spark.createDataFrame(rows, "aligned_at_utc timestamp, open_price double, high_price double, low_price double, close_price double, quantity_sum double, quote_volume_sum double, trade_count long")
    assert tuple(bars.aligned_bars(df, 2).first())[1:] == (42000.0, 42003.0, 41999.0, 42002.0, 0.3, 3, 12600.0)
    with pytest.raises(ValueError):
        bars.aligned_bars(df, 0)


def test_element_quantile(spark):
    rows = [("a", x) for x in (4.0, 1.0, 3.0, 2.0)] + [("b", 5.0)] + [("c", x) for x in (2.0, 1.0, 2.0, 2.0, 9.0, None)]
    out = bars.element_quantiles(spark.createDataFrame(rows, "k string, v double"), "k", "v", {"m": 0.5, "q": 0.75, "top": 1.0})
    assert sorted(map(tuple, out.collect())) == [("a", 3.0, 4.0, 4.0), ("b", 5.0, 5.0, 5.0), ("c", 2.0, 2.0, 9.0)]


def test_bars_count_every_trade(spark):
    from tidemark.queries.base import trades

    t = trades(spark, "/root/testdata/sf0.001")
    for seconds in (1, 60, 86400):
        assert bars.native_bars(t, AllRows(), seconds).agg(F.sum("no_of_trades")).first()[0] == t.count()
    with pytest.raises(NotImplementedError):
        bars.data_bars(t, "volume", volume_threshold=3)
    for bad in (lambda: bars.data_bars(t, "other"), lambda: bars.data_bars(t, "trade")):
        with pytest.raises(ValueError):
            bad()
