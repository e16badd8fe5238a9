import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import PRECISION
from tidemark.functions.precision import canonical_payload, without_floats
from tidemark.operators import eventlog, sinks, state
from tidemark.sources import etf, exchange_csv

KEYS = "source_id string, stream_id string, partition_id string"
BINANCE = ("binance", "binance_spot_trades")


def canonical(spark, text, stream=BINANCE):
    return spark.createDataFrame([(text,)], "t string").select(canonical_payload(F.col("t"), *stream).alias("v")).first()["v"]


def test_payloads_keep_the_registry_s_numbers(spark):
    got = canonical(spark, '{"qty":"0.01000000","price":"41000.12345678","quote_qty":"410.00123456","trade_id":"1"}')
    assert got == '{"price":"41000.12345678","qty":"0.01000000","quote_qty":"410.00123456","trade_id":1}'
    assert canonical(spark, '{"trade_id":12345678901234567890,"price":12,"a b":"q\\"é","n":null,"f":false,"o":{"z":"1"},"l":["x"]}') == '{"a b":"q\\"é","f":false,"l":["x"],"n":null,"o":{"z":"1"},"price":"12.00000000","trade_id":12345678901234567890}'
    for bad in ('{"trade_id":NaN}', '{"trade_id":1,"other":2}', '{"trade_id":true}', '{"trade_id":null}', '{"trade_id":1.5}', '{"price":0.123456789}', '{"o":{"q":1}}', "[1]", "{", None):
        with pytest.raises(Exception, match="precision|no JSON object"):
            canonical(spark, bad)
    with pytest.raises(ValueError, match="no precision rules"):
        canonical_payload(F.lit("{}"), "binance", "unknown_stream")
    assert all(len(json.loads(canonical(spark, "{}", s))) == 0 for s in PRECISION)
    plain = spark.createDataFrame([('{"trade_id":1,"price":41000.12}',)], "t string").select(without_floats(F.col("t")))
    with pytest.raises(Exception, match="a float in the payload"):
        plain.collect()


def test_trade_files_keep_their_digits(spark):
    row = ("7", "0.01000000", " 12345678901234.12345678", "1e-7", "1704067200000", "True", "false", 1)
    lines = spark.createDataFrame([row], "trade_id string, price string, quantity string, quote_quantity string, timestamp string, is_buyer_maker string, is_best_match string, row_no long")
    payload = exchange_csv.payload_events(exchange_csv.binance_trades(lines), "binance", F.lit("p")).first()["payload_json"]
    assert payload == '{"is_best_match":false,"is_buyer_maker":true,"price":"0.01000000","qty":"12345678901234.12345678","quote_qty":"1e-7","trade_id":7}'


def frame(spark, rows, columns):
    return spark.createDataFrame([("s", "t", *r) for r in rows], f"source_id string, stream_id string, partition_id string, {columns}")


def test_cursors(spark, tmp_path):
    table, ledger = state.StateTable(spark, f"{tmp_path}/c", f"{KEYS}, offset string"), f"{tmp_path}/l"
    move = lambda *rows: state.advance_cursors(table, ledger, frame(spark, rows, "offset string, expected_previous string"), "numeric")
    assert move(("a", "5", None), ("b", "1", None)) == 2
    assert move(("a", "10", "5")) == 1
    for wrong in (("a", "11", "5"), ("a", "9", "10"), ("a", "10", "10"), ("b", "2", None), ("c", "1", "0")):
        with pytest.raises(ValueError, match="cannot move"):
            move(wrong)
    with pytest.raises(ValueError, match="cannot move"):  # all or none
        move(("b", "2", "1"), ("a", "1", "10"))
    with pytest.raises(Exception, match="not numeric"):
        move(("a", "x", "10"))
    assert sorted((r["partition_id"], r["offset"], r["revision"]) for r in table.latest().collect()) == [("a", "10", 2), ("b", "1", 1)]
    assert spark.read.parquet(ledger).count() == 3 and table.rows().select("state_id").distinct().count() == 3
    assert state.offset_after(F.lit("b"), F.lit("a"), "lexicographic") is not None


def test_gaps_lead_into_quarantine_and_out_of_it(spark, tmp_path):
    done = state.StateTable(spark, f"{tmp_path}/d", f"{KEYS}, expected long, observed long, gap long, status string")
    held = state.StateTable(spark, f"{tmp_path}/q", f"{KEYS}, status string, reason string")
    counts = frame(spark, [("a", 10, 10), ("b", 10, 7)], "expected long, observed long")
    assert state.record_completeness(done, held, counts) == 1 and state.record_completeness(done, held, counts) == 1
    assert done.rows().count() == 2 and held.rows().count() == 1  # equal values are duplicates
    events = frame(spark, [("a", "1"), ("b", "2")], "source_offset string")
    assert [r["partition_id"] for r in eventlog.without_quarantined(events, held.rows()).collect()] == ["a"]
    assert state.release(held, counts, "seen to") == 1
    assert eventlog.without_quarantined(events, held.rows()).count() == 2


def test_partitions_and_policies(spark, tmp_path):
    table = state.StateTable(spark, f"{tmp_path}/p", f"{KEYS}, state string, reason string")
    go = lambda s: state.move_partitions(table, frame(spark, [("a", s, "r")], "state string, reason string"))
    for s in ("source_manifested", "canonical_written_unproved", "proved_complete", "reconcile_required"):
        assert go(s) == 1
    with pytest.raises(ValueError, match="cannot go"):
        go("empty_proved")
    with pytest.raises(ValueError, match="more than once"):
        state.move_partitions(table, frame(spark, [("z", "source_manifested", "r"), ("z", "source_manifested", "q")], "state string, reason string"))
    policies = state.StateTable(spark, f"{tmp_path}/b", state.POLICY, ("source_id", "stream_id"))
    row = lambda size, tier="hot": spark.createDataFrame([("s", "t", size, tier, 7, 90)], state.POLICY)
    assert [state.set_policies(policies, row(1)), state.set_policies(policies, row(1)), state.set_policies(policies, row(60))] == [1, 0, 1]
    assert state.bucket_sizes(policies) == {("s", "t"): 60}
    for bad in (row(0), row(1, "lukewarm")):
        with pytest.raises(ValueError, match="not a bucket policy"):
            state.set_policies(policies, bad)


def test_metrics_and_answers(spark, tmp_path):
    rows = spark.createDataFrame([("m1", "s", "x", 1.0, datetime(2024, 1, 5, tzinfo=UTC)), ("m2", "s", "y", None, datetime(2024, 2, 5, tzinfo=UTC))], "metric_id string, source_id string, metric_name string, metric_value_float double, observed_at_utc timestamp")
    assert sinks.persist_metrics(rows, f"{tmp_path}/m") == 2 and sinks.persist_metrics(rows, f"{tmp_path}/m") == 0
    with pytest.raises(ValueError, match="other values"):
        sinks.persist_metrics(rows.withColumn("metric_value_float", F.lit(2.0)), f"{tmp_path}/m")
    assert sinks.persist_metrics(rows.limit(0), f"{tmp_path}/m") == 0
    assert sinks.envelope(rows, "native", "s", most=2)["row_count"] == 2
    with pytest.raises(ValueError, match="over 1 rows"):
        sinks.envelope(rows, "native", "s", most=1)
    path = f"{tmp_path}/audit.jsonl"
    for k in range(3):
        sinks.append_audit(path, "k", {"n": "x" * 5000 * k}, datetime(2024, 1, 1, tzinfo=UTC))
    assert [r["sequence"] for r in sinks.check_audit(path)] == [0, 1, 2]
    lines = open(path).read().splitlines()
    open(path, "w").write("\n".join([*lines[:2], lines[2].replace('"n": "', '"n": "z')]) + "\n")
    with pytest.raises(ValueError, match="broken at record 2"):
        sinks.append_audit(path, "k", {}, datetime(2024, 1, 1, tzinfo=UTC))


def test_fund_records(spark):
    issuer = etf.Issuer("etf_a", {"nav": "nav", "shares": "shares"}, {"nav": "USD"}, ["shares"], "date", ["nav"])
    parsed = lambda *rows: spark.createDataFrame([("a", k, r) for k, r in enumerate(rows)], "artifact_id string, record_index long, fields map<string,string>")
    got = {r["metric_name"]: r for r in etf.normalise(parsed({"date": "01/15/2024", "nav": "$12.5", "shares": "1,000", "x": "y"}), issuer).collect()}
    assert got["nav"]["metric_value_float"] == 12.5 and got["shares"]["metric_value_int"] == 1000 and got["nav"]["metric_unit"] == "USD"
    assert got["nav"]["observed_at_utc"].hour == 0 and len({r["metric_id"] for r in got.values()}) == 2
    for bad in ({"nav": "1"}, {"date": "01/15/2024", "nav": "-"}):
        with pytest.raises(Exception, match="no day|lacks"):
            etf.normalise(parsed(bad), issuer).collect()
    for answer in ({"code": "1"}, {"code": "0", "data": {"details": []}}, {"code": "0", "data": None}):
        with pytest.raises(ValueError):
            etf.download_link(answer, "2024-01-01")


def test_a_stored_envelope_has_no_limit(spark, tmp_path, monkeypatch):
    from tidemark import queries

    monkeypatch.setattr(sinks, "MOST_ROWS", 2)
    monkeypatch.setattr(sinks.envelope, "__defaults__", ((), 2))
    rows = spark.range(5).withColumnRenamed("id", "k")
    out = sinks.stored_envelope(rows, "native", "s", f"{tmp_path}/rows")
    assert (out["row_count"], out["schema"], "rows" in out) == (5, [{"name": "k", "dtype": "bigint"}], False)
    assert sorted(r["k"] for r in spark.read.parquet(out["rows_path"]).collect()) == [0, 1, 2, 3, 4]
    assert queries.QUERIES["snk_13_envelope"](spark, "/root/testdata/sf0.001").first()["row_count"] > 2


def test_a_bundle_in_pages_is_one_and_lies_once(spark, tmp_path):
    at = datetime(2024, 3, 1, tzinfo=UTC)
    frame = lambda *rows: spark.createDataFrame(rows, "series_id string, page long, observations string")
    pages = [("A", 0, "[1]"), ("A", 1, "[2]"), ("B", 0, "[1]")]
    assert sinks.persist_bundles(frame(*pages), f"{tmp_path}/raw", at) == 2
    assert sinks.persist_bundles(frame(*pages[::-1], pages[0]), f"{tmp_path}/raw", at) == 0
    assert sinks.persist_bundles(frame(("A", 0, "[2]"), ("A", 1, "[1]")), f"{tmp_path}/raw", at) == 1
    kept = spark.read.parquet(f"{tmp_path}/raw")
    assert (kept.count(), kept.select("series_id", "bundle_sha256").distinct().count()) == (5, 3)
