import hashlib
import uuid
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import bitcoin, text
from tidemark.operators import eventlog, integrity, proofs, serving, splits
from tidemark.plans.windows import AllRows, LatestRows, TimeRange

T0 = datetime(2024, 1, 1, tzinfo=UTC)


def events(spark, rows):
    return spark.createDataFrame([("s", "t", p, o, i, h) for p, o, i, h in rows], "source_id string, stream_id string, partition_id string, source_offset string, event_id string, payload_sha256 string")


def test_proof_digests_follow_numeric_order(spark):
    e = events(spark, [("p", "10", "e10", "h10"), ("p", "2", "e2", "h2"), ("p", "1", "e1", "h1")])
    r = proofs.source_proof(e, "numeric").first()
    assert (r["row_count"], r["first_offset"], r["last_offset"]) == (3, "1", "10")
    assert r["offset_digest"] == hashlib.sha256(b"1\n2\n10\n").hexdigest()
    assert r["identity_digest"] == hashlib.sha256(b"1|e1|h1\n2|e2|h2\n10|e10|h10\n").hexdigest()
    assert proofs.source_proof(e, "lexicographic").first()["last_offset"] == "2"
    c = proofs.canonical_proof(e, "numeric").first()
    assert (c["unique_offset_count"], c["gap_count"], c["duplicate_count"]) == (3, 7, 0)
    assert proofs.canonical_proof(e, "numeric_monotonic").first()["gap_count"] == 0
    with pytest.raises(Exception, match="no whole number"):
        proofs.source_proof(events(spark, [("p", "x", "e", "h")]), "numeric").collect()


def test_proof_results(spark):
    rows = [("a", str(i), f"e{i}", f"h{i}") for i in range(3)] + [("b", "1", "e1", "h1"), ("b", "3", "e3", "h3")] + [("c", "1", "e", "h")]
    e = events(spark, rows)
    source = proofs.source_proof(e, "numeric")
    canonical = proofs.canonical_proof(e.where("partition_id <> 'c'"), "numeric")
    got = {r["partition_id"]: (r["reason"], r["state"]) for r in proofs.proof_result(source, canonical).collect()}
    assert got == {"a": ("match", "proved_complete"), "b": ("offset_gap", "quarantined"), "c": ("row_count_mismatch", "quarantined")}


def test_two_level_digest_does_not_depend_on_partitions(spark):
    e = events(spark, [("p", str(i), f"e{i}", f"h{i}") for i in range(200)])
    a = proofs.two_level_digest(e, "numeric", 16).first()
    assert a == proofs.two_level_digest(e.repartition(7), "numeric", 16).first() and a["row_count"] == 200


def test_states():
    assert proofs.next_state(None, "source_manifested") == "source_manifested"
    for a, b in ((None, "proved_complete"), ("proved_complete", "canonical_written_unproved"), ("empty_proved", "quarantined")):
        with pytest.raises(ValueError):
            proofs.next_state(a, b)
    proofs.assert_can_execute(None, "backfill")
    proofs.assert_can_execute("quarantined", "reconcile")
    for s, m in (("proved_complete", "backfill"), (None, "reconcile"), (None, "other")):
        with pytest.raises(ValueError):
            proofs.assert_can_execute(s, m)


def test_planning(spark):
    proved = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "partition_id string")
    assert proofs.resume_from(proved, date(2024, 1, 1)) == date(2024, 1, 3)
    assert proofs.resume_from(proved.limit(0), date(2024, 1, 1)) == date(2024, 1, 1)
    with pytest.raises(ValueError, match="not contiguous"):
        proofs.resume_from(proved.union(spark.createDataFrame([("2024-01-05",)], "p string")), date(2024, 1, 1))
    week = proofs.days(spark, date(2024, 1, 5), date(2024, 1, 9), business=True)
    assert [r[0] for r in proofs.missing_days(week, proved).collect()] == ["2024-01-05", "2024-01-08", "2024-01-09"]
    assert proofs.height_range(proofs.height_partition(0, 143)) == (0, 143)
    for bad in ("a-b", "5-1", "7"):
        with pytest.raises(ValueError):
            proofs.height_range(bad)


def test_append_outcomes(spark):
    rows = [("s", "t", "p", str(i), T0, f'{{"v":{v}}}') for i, v in ((1, 1), (2, 2), (2, 2), (3, 3))]
    schema = "source_id string, stream_id string, partition_id string, source_offset string, source_event_time timestamp, payload_json string"
    new = eventlog.envelope(spark.createDataFrame(rows, schema), F.lit(T0))
    log = new.where("source_offset = '1'")
    assert sorted(r["source_offset"] for r in eventlog.to_insert(new, log).collect()) == ["2", "3"]
    changed = eventlog.envelope(spark.createDataFrame([("s", "t", "p", "1", T0, '{"v":9}')], schema), F.lit(T0))
    assert eventlog.classify(changed, log).first()["outcome"] == "conflict"
    with pytest.raises(Exception, match="another payload"):
        eventlog.to_insert(changed, log).collect()
    with pytest.raises(Exception, match="JSON object"):
        eventlog.envelope(spark.createDataFrame([("s", "t", "p", "1", T0, "[1]")], schema)).collect()


def test_resets_hide_and_pages_follow(spark):
    rows = [("s", "t", "p", str(i), T0 + timedelta(hours=i), f"e{i}") for i in range(5)]
    log = spark.createDataFrame(rows, "source_id string, stream_id string, partition_id string, source_offset string, ingested_at timestamp, event_id string")
    resets = spark.createDataFrame([("s", "t", "p", T0 + timedelta(hours=1)), ("s", "t", "p", T0 + timedelta(hours=2))], "source_id string, stream_id string, partition_id string, reset_at timestamp")
    assert sorted(r["source_offset"] for r in eventlog.active(log, resets).collect()) == ["3", "4"]
    first = eventlog.page(log, 2).collect()
    second = eventlog.page(log, 2, (first[-1]["ingested_at"], first[-1]["event_id"])).collect()
    assert [r["event_id"] for r in first + second] == ["e0", "e1", "e2", "e3"]
    assert [r["event_id"] for r in eventlog.page(log, 9, (2, "e2"), "source_offset_numeric").collect()] == ["e3", "e4"]


def test_cursor_and_offsets():
    state = eventlog.advance_cursor(None, "9", "numeric", None)
    assert eventlog.advance_cursor(state, "10", "numeric", "9")["revision"] == 2
    for offset, ordering, expected in (("10", "lexicographic", "9"), ("11", "numeric", "8")):
        with pytest.raises(ValueError):
            eventlog.advance_cursor(state, offset, ordering, expected)
    with pytest.raises(ValueError):
        eventlog.compare_offsets("a", "b", "opaque")
    assert eventlog.compare_offsets("a", "a", "opaque") == 0
    assert eventlog.completeness(5, 3)["quarantine"] and not eventlog.completeness(3, 3)["quarantine"]


def test_latest_and_gaps(spark):
    s = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c")], "k string, revision long, v string")
    assert {r["k"]: r["v"] for r in eventlog.latest(s, ["k"]).collect()} == {"k": "b", "j": "c"}
    n = spark.createDataFrame([("k", x) for x in (1, 2, 2, 5, 1_000_000)], "k string, n long")
    g = proofs.gap_summary(n, ["k"], "n", 4).first()
    assert (g["gap_count"], g["duplicate_count"], g["first_missing"]) == (1_000_000 - 4, 1, [3, 4, 6, 7])


def trade(spark, rows, columns):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"row_no long, {columns}")


def test_exchange_suites(spark):
    binance = "trade_id long, price double, quantity double, timestamp long, is_buyer_maker boolean"
    def check(rows, exchange="binance", columns=binance):  # noqa: E306
        return integrity.require(integrity.report(*integrity.exchange_checks(trade(spark, rows, columns), exchange, ())))
    assert check([(100, 5e4, 0.1, 1, True), (101, 5e4, 0.2, 2, False)])["rows"] == 2
    assert check([(0, 5e4, 0.1, 1, True), (1, 5e4, 0.2, 2, False)])["rows"] == 2
    for bad in ([(100, 5e4, 0.1, 1, True), (102, 5e4, 0.2, 2, False)], [(1, -1.0, 0.1, 1, True)]):
        with pytest.raises(ValueError, match="integrity checks failed"):
            check(bad)
    okx = "trade_id long, price double, size double, timestamp long, side string"
    assert check([(5, 1.0, 1.0, 1, "buy"), (9, 1.0, 1.0, 2, "sell"), (9, 1.0, 1.0, 2, "sell")], "okx", okx)["rows"] == 3
    for bad in ([(5, 1.0, 1.0, 1, "hold")], [(9, 1.0, 1.0, 1, "buy"), (5, 1.0, 1.0, 1, "buy")], [(9, 1.0, 1.0, 1, "buy"), (9, 2.0, 1.0, 1, "buy")]):
        with pytest.raises(ValueError):
            check(bad, "okx", okx)
    assert check([(1, 1.0, 0.0, 1, "sell")], "bybit", okx)["rows"] == 1


def test_bitcoin_formulas_and_suites(spark):
    heights = [0, 209_999, 210_000, 840_000, 64 * 210_000, 70 * 210_000]
    df = spark.createDataFrame([(h,) for h in heights], "height long")
    got = df.select(bitcoin.subsidy_sats(F.col("height")), bitcoin.supply_sats(F.col("height"))).collect()
    era = lambda h: (50 * 10**8 >> h // 210_000) if h // 210_000 < 64 else 0
    assert [r[0] for r in got] == [era(h) for h in heights]
    assert [r[1] for r in got[:3]] == [50 * 10**8, 210_000 * 50 * 10**8, 210_000 * 50 * 10**8 + 25 * 10**8]
    ok = spark.createDataFrame([(0, 0, 5000000000, 50.0), (1, 0, 5000000000, 50.0)], "block_height long, halving_interval long, subsidy_sats long, subsidy_btc double")
    assert integrity.require(integrity.report(*integrity.subsidy_checks(ok)))["rows"] == 2
    supply = spark.createDataFrame([("m", 0, 5000000000, 50.0), ("m", 1, 10000000000, 100.0)], "source_chain string, block_height long, circulating_supply_sats long, circulating_supply_btc double")
    assert integrity.require(integrity.report(*integrity.supply_checks(supply)))["rows"] == 2
    rate = spark.createDataFrame([(1.0, 600, 2**32 / 600)], "difficulty double, observed_interval_seconds long, hashrate_hs double")
    assert integrity.require(integrity.report(*integrity.hashrate_checks(rate)))["rows"] == 1
    h = lambda n, p: ("main", n, f"{n:064x}", p, "1.0", n + 1)
    columns = "source_chain string, height long, block_hash string, prev_hash string, difficulty string, timestamp_ms long"
    good = spark.createDataFrame([h(100, "x"), h(101, f"{100:064x}")], columns)
    assert integrity.require(integrity.report(*integrity.header_checks(good)))["rows"] == 2
    df, checks = integrity.header_checks(spark.createDataFrame([h(100, "x"), h(101, "y")], columns))
    assert [(r["height"], r["violation"]) for r in integrity.violations(df, checks, ["height"]).collect()] == [(101, "linked")]
    times = spark.createDataFrame([("main", 1, 1000), ("main", 2, 601_000)], "source_chain string, height long, timestamp long")
    assert [r["observed_interval_seconds"] for r in bitcoin.observed_intervals(times).orderBy("height").collect()] == [600, 600]
    tx = spark.createDataFrame([(1, "h", 5, True, '{"input_value_btc_sum":"0","output_value_btc_sum":"50"}'), (1, "h", 5, False, '{"input_value_btc_sum":"1.5","output_value_btc_sum":"1.4"}')], "block_height long, block_hash string, block_timestamp long, coinbase boolean, values string")
    assert bitcoin.fee_totals(tx).first()["fee_total_btc"] == 0.1
    with pytest.raises(Exception, match="negative fee"):
        bitcoin.fee_totals(tx.withColumn("values", F.lit('{"input_value_btc_sum":"0","output_value_btc_sum":"50"}'))).collect()


def test_text_functions(spark):
    assert text.identifiers(["A b", "a-B", "1x", "", "%"]) == ["a_b", "a_b_2", "col_1x", "column_4", "column_5"]
    one = lambda f, v: spark.createDataFrame([(v,)], "t string").select(f(F.col("t"))).first()[0]
    assert [one(text.amount, v) for v in ("$1,234.5", "(12)", "-", "3.5M", "7%")] == [1234.5, -12.0, None, 3.5e6, 7.0]
    assert [str(one(text.any_date, v)) for v in ("2024-01-31", "01/31/2024", "Jan 31, 2024")] == ["2024-01-31"] * 3
    assert one(text.half_up_millis, "1704067200.2345") == 1704067200235
    assert one(text.missing_dot, ".") is None and one(text.missing_dot, "1.5") == 1.5
    assert str(one(lambda c: text.exact_number(c, 8, "price"), "41000.12345678")) == "41000.12345678"
    assert one(lambda c: text.exact_number(c, None, "id"), "1") == 1
    for v, scale in (("1.123456789", 8), ("x", 8), ("1.5", None), ("NaN", 8)):
        with pytest.raises(Exception, match="precision"):
            one(lambda c, s=scale: text.exact_number(c, s, "v"), v)


def test_serving(spark):
    assert serving.window_warnings(AllRows()) == []
    with pytest.raises(ValueError):
        serving.enforce_strict(serving.window_warnings(LatestRows(1)), True)
    matrix = {"sources": [{"source": "x", "datasets": ["a"], "rights_state": "Hosted Allowed", "legal_signoff_artifact": "doc"}, {"source": "y", "datasets": ["b"], "rights_state": "BYOK Required"}, {"source": "z", "datasets": ["c"], "rights_state": "Ingest Only"}]}
    assert serving.rights_decision(matrix, "a")["rights_state"] == "Hosted Allowed" and serving.rights_decision(matrix, "b", "key")
    for d in ("b", "c", "d"):
        with pytest.raises(PermissionError):
            serving.rights_decision(matrix, d)
    states = spark.createDataFrame([("2024-01-02", "proved_complete", T0), ("2024-01-01", "quarantined", T0)], "partition_id string, state string, recorded_at timestamp")
    pool = spark.createDataFrame([(T0 + timedelta(days=1, hours=3),), (T0,)], "snapshot_at timestamp")
    at = serving.mempool_boundary(states, pool)
    assert at == T0 + timedelta(days=1, hours=3)
    serving.reject_before_boundary(TimeRange("2024-01-03", "2024-01-04"), at)
    with pytest.raises(ValueError):
        serving.reject_before_boundary(TimeRange("2024-01-01", "2024-01-04"), at)
    fresh = serving.freshness(spark.createDataFrame([(T0,)], "aligned_at_utc timestamp"), T0 + timedelta(hours=2), timedelta(hours=1))
    assert fresh["stale"] and fresh["lag_seconds"] == 7200


def test_splits_are_exact(spark):
    df = spark.range(103).withColumn("v", F.col("id") * 2).repartition(5)
    a, b, c = splits.split_sequential(df, [7, 2, 1], ["id"])
    assert [p.count() for p in (a, b, c)] == [72, 20, 11] and a.agg(F.max("id")).first()[0] == 71
    x, y = splits.split_random(df, [1, 1], 7, ["id"])
    assert x.count() == 51 and x.join(y, "id").count() == 0
    again = splits.split_random(df, [1, 1], 7, ["id"])[0]
    assert sorted(r["id"] for r in x.collect()) == sorted(r["id"] for r in again.collect())
    s = [r["id"] for r in splits.random_slice(df, 10, ["id"], seed=3).collect()]
    assert s == list(range(s[0], s[0] + 10))
    assert splits.missing_times(df, [a, b], "id").count() == 11
    assert set(splits.train_val_test([a, b, c], "v", "id")) == {"x_train", "y_train", "x_val", "y_val", "x_test", "y_test"}
    with pytest.raises(ValueError):
        splits.bounds(5, [1, 0])


def test_state_ids(spark):
    from tidemark.functions.identity import EVENT_NAMESPACE, state_id

    got = spark.range(1).select(state_id(EVENT_NAMESPACE, F.lit("a"), F.lit(3))).first()[0]
    assert got == str(uuid.uuid5(EVENT_NAMESPACE, "a|3"))
