import io
import json
import zipfile
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.api import Admission, Busy, Empty, HistoricalData, Service, Tables
from tidemark.operators import aligned, eventlog, sinks
from tidemark.plans.windows import AllRows
from tidemark.sources import artifacts, exchange_csv, feeds
from tidemark.streaming import projector

T0 = datetime(2024, 1, 1, tzinfo=UTC)
MS = 1704067200000


def write(path, text, zipped=False):
    data = text.encode()
    if zipped:
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            z.writestr("a.csv", data)
        data = held.getvalue()
    path.write_bytes(data)
    return str(path)


@pytest.mark.parametrize("zipped", [False, True])
def test_binance_files(spark, tmp_path, zipped):
    p = write(tmp_path / "f", f"﻿1,42000.5,0.1,4200.05,{MS},True,true\n2,42001,0.2,8400.2,{MS * 1000 + 1000},False,True\n", zipped)
    rows = exchange_csv.binance_trades(exchange_csv.csv_lines(spark, p, exchange_csv.BINANCE, "sniffed"), "2024-01-01").orderBy("row_no").collect()
    assert [(r["trade_id"], r["timestamp"], r["is_buyer_maker"]) for r in rows] == [(1, MS, 1), (2, MS + 1, 0)]
    bad = write(tmp_path / "g", f"1,x,0.1,1,{MS},True,true\n")
    with pytest.raises(Exception, match="bad price in row 1"):
        exchange_csv.binance_trades(exchange_csv.csv_lines(spark, bad, exchange_csv.BINANCE, "sniffed")).collect()
    with pytest.raises(Exception, match="outside of the day"):
        exchange_csv.binance_trades(exchange_csv.csv_lines(spark, p, exchange_csv.BINANCE, "none"), "2024-01-02").collect()


def test_okx_files(spark, tmp_path):
    p = write(tmp_path / "f", f"{','.join(exchange_csv.OKX)}\nBTC-USDT,465,buy,42457.6,0.5,{MS - 8 * 3600_000}\n")
    r = exchange_csv.okx_trades(exchange_csv.csv_lines(spark, p, exchange_csv.OKX, "required"), day="2024-01-01").first()
    assert (r["trade_id"], r["side"], r["quote_quantity"]) == (465, "buy", 21228.8)
    with pytest.raises(Exception, match="bad instrument_name"):
        exchange_csv.okx_trades(exchange_csv.csv_lines(spark, p, exchange_csv.OKX, "required"), "ETH-USDT").collect()
    with pytest.raises(Exception, match="unexpected header"):
        exchange_csv.csv_lines(spark, write(tmp_path / "g", "a,b\n"), exchange_csv.OKX, "required").collect()


def test_bybit_files(spark, tmp_path):
    uid = "0f3c1a2b-1111-2222-3333-444455556666"
    lines = f"{','.join(exchange_csv.BYBIT)},RPI\n1704067200.2345,BTCUSDT,Buy,0.002,42324.9,ZeroMinusTick,{uid},1,0.002,84.6,0\n1704067201,BTCUSDT,Sell,0.1,42325,PlusTick,m-77,1,0.1,1,0\n"
    read = exchange_csv.csv_lines(spark, write(tmp_path / "f", lines), exchange_csv.BYBIT, "required", (exchange_csv.BYBIT_OPTIONAL,))
    rows = exchange_csv.bybit_trades(read, day="2024-01-01").orderBy("row_no").collect()
    assert [(r["trade_id"], r["timestamp"], r["side"]) for r in rows] == [(0, 1704067200235, "buy"), (77, 1704067201000, "sell")]
    with pytest.raises(Exception, match="trdMatchID"):
        exchange_csv.bybit_trades(read.withColumn("trdMatchID", F.lit("zzz"))).collect()


def test_artifacts(spark):
    html = "<p>x</p><table><tr><th>As Of</th><th>1 Yr</th></tr><tr><td>Jan <b>1</b></td><td>5%</td></tr></table>"
    rows = [("a", "csv", "A b,A b\n1,2\n\n"), ("b", "html", html), ("c", "json", '{"x":[{"K":1,"l":{"m":2}}]}'), ("d", "pdf", "one\n\n two "), ("e", "csv", None), ("f", "html", "no table")]
    got = {(r["artifact_id"], r["record_index"]): r["fields"] for r in artifacts.parse(spark.createDataFrame(rows, "artifact_id string, format string, content string")).collect()}
    assert got[("a", 0)] == {"a_b": "1", "a_b_2": "2"} and got[("b", 0)] == {"as_of": "Jan 1", "col_1_yr": "5%", "table": "0"}
    assert got[("c", 0)] == {"k": "1", "l": '{"m": 2}'} and got[("d", 1)] == {"line": "two"} and len(got) == 5
    with pytest.raises(Exception, match="no parser"):
        artifacts.parse(spark.createDataFrame([("a", "xls", "x")], "artifact_id string, format string, content string")).collect()


def test_feeds(spark):
    bundle = [("WALCL", "USD", "2026-03-18 15:01:00-05", json.dumps([{"realtime_start": "a", "realtime_end": "b", "date": "2026-02-01", "value": "1.5"}, {"realtime_start": "a", "realtime_end": "b", "date": "2026-03-01", "value": "."}]))]
    rows = feeds.series_observations(spark.createDataFrame(bundle, "series_id string, unit string, last_updated string, observations string")).orderBy("observed_at_utc").collect()
    assert [(r["source_id"], r["metric_value_float"]) for r in rows] == [("fred_walcl", 1.5), ("fred_walcl", None)] and len({r["metric_id"] for r in rows}) == 2
    wide = spark.createDataFrame([('{"date":"2024-01-01","GDP_20240201":"3.5","GDP_20240301":"."}',)], "row string")
    assert sorted((str(r["vintage"]), r["value"]) for r in feeds.vintages(wide).collect()) == [("2024-02-01", 3.5), ("2024-03-01", None)]

    def fetch(ids):
        if len(ids) > 2:
            raise ValueError
        return ids

    assert feeds.fetch_in_halves(fetch, list(range(7))) == list(range(7))
    assert feeds.incremental_range(date(2024, 1, 5), date(2024, 1, 1), date(2024, 1, 9), date(2024, 1, 7)) == (date(2024, 1, 6), date(2024, 1, 7))
    assert feeds.incremental_range(date(2024, 1, 7), date(2024, 1, 1), date(2024, 1, 9), date(2024, 1, 7)) is None
    waits, now = [], [0.0]
    gate = feeds.RateGate(1.0, clock=lambda: now[0], sleep=waits.append)
    gate.wait(), gate.wait()
    assert waits == [1.0]

    class Node:
        def getblockcount(self):
            return 1

        def getblockhash(self, h):
            return f"{h:064x}"

        def getblock(self, h, verbosity):
            tx = [{"txid": "c", "vin": [{"coinbase": "00"}], "vout": [{"n": 0, "value": 50.0, "scriptPubKey": {"hex": "aa", "type": "p2pk"}}]}, {"txid": "t", "vin": [{"txid": "c", "vout": 0, "prevout": {"value": 1.5}, "txinwitness": ["w"]}], "vout": [{"n": 0, "value": 1.4, "scriptPubKey": {"hex": "bb", "type": "p2pkh"}}]}]
            return {"hash": h, "merkleroot": "m", "version": 1, "nonce": 2, "difficulty": 1.0, "time": 5, "tx": tx}

    raw = feeds.blocks(spark, Node(), 0, 1)
    assert feeds.headers_of(raw).orderBy("height").first()["timestamp_ms"] == 5000
    tx = feeds.transactions_of(raw).where("block_height = 0").orderBy("transaction_index").collect()
    assert [r["coinbase"] for r in tx] == [True, False] and json.loads(tx[1]["values"]) == {"input_value_btc_sum": "1.50000000", "output_value_btc_sum": "1.40000000"}
    pool = spark.createDataFrame([(9, json.dumps({"t": {"vsize": 100, "time": 3, "fees": {"base": 0.00001}, "bip125-replaceable": True}}))], "snapshot_at_unix_ms long, mempool string")
    assert feeds.mempool_of(pool).first()["fee_rate_sat_vb"] == 10.0


def log(spark, rows, ingested=T0):
    """rows: offset, seconds, price"""
    frame = spark.createDataFrame([("binance", "binance_spot_trades", "2024-01-01", str(o), T0 + timedelta(seconds=s), json.dumps({"is_best_match": True, "is_buyer_maker": False, "price": str(p), "qty": "1", "quote_qty": str(p), "trade_id": o})) for o, s, p in rows], "source_id string, stream_id string, partition_id string, source_offset string, source_event_time timestamp, payload_json string")
    return eventlog.envelope(frame, F.lit(ingested))


def test_stream_projection_restarts_and_takes_late_events(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("log", "out", "mark"))
    log(spark, [(1, 0.1, 10.0), (3, 1.0, 30.0)]).write.mode("append").parquet(source)
    projector.align(spark, source, out, mark)
    log(spark, [(2, 0.5, 20.0)], T0 + timedelta(hours=1)).write.mode("append").parquet(source)
    projector.align(spark, source, out, mark)
    projector.align(spark, source, out, mark)
    stored = projector.projected(spark, out)
    assert stored.count() == 3 and stored.where(F.col("aligned_at_utc") == F.lit(T0)).count() == 2
    rows = aligned.query_aligned(stored, "binance_spot_trades", AllRows()).collect()
    assert [(r["open_price"], r["close_price"], r["trade_count"]) for r in rows] == [(10.0, 20.0, 2), (30.0, 30.0, 1)]
    w = projector.watermarks(spark, out).first()
    assert (w["events"], w["source_offset"]) == (3, "2") and projector.went_back(spark, out).count() == 0


def test_native_rows(spark):
    r = projector.native_rows(log(spark, [(7, 0.0, 10.5)]), "binance_spot_trades").first()
    assert (r["trade_id"], r["price"], r["is_best_match"], r["timestamp"]) == (7, 10.5, 1, MS)


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "log")
    assert sinks.append_events(log(spark, [(1, 0, 1.0), (2, 0, 2.0)]), path) == 2
    assert sinks.append_events(log(spark, [(2, 0, 2.0), (3, 0, 3.0)]), path) == 1
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="another payload"):
        sinks.append_events(log(spark, [(1, 0, 9.0)]), path)
    months = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "month string, v long")
    sinks.insert_new_partition(months, str(tmp_path / "m"), "month")
    with pytest.raises(ValueError, match="not empty"):
        sinks.insert_new_partition(months.limit(1), str(tmp_path / "m"), "month")
    assert sinks.replace_partitions(spark.createDataFrame([("2024-02", 7), ("2024-02", 8)], "month string, v long"), str(tmp_path / "m"), "month") == 2
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "m")).collect()) == [1, 7, 8]
    assert sinks.without_partition(months, {"month": "2024-01"}).count() == 1
    for form in ("parquet", "csv"):
        meta = sinks.export(months, str(tmp_path / form), form)
        assert meta["row_count"] == 2 and len(meta["sha256"]) == 64 and json.loads((tmp_path / form / "metadata.json").read_text()) == meta
    with pytest.raises(ValueError):
        sinks.export(months, str(tmp_path / "x"), "xml")
    a = sinks.persist_artifact(str(tmp_path / "art"), "src", b"data", "text/csv", T0)
    assert a == sinks.persist_artifact(str(tmp_path / "art"), "src", b"data", "text/csv", T0)


def test_audit_chain(spark, tmp_path):
    p = str(tmp_path / "audit")
    for k in range(3):
        sinks.append_audit(p, "export", {"n": k}, T0)
    assert len(sinks.check_audit(p)) == 3 and sinks.broken_links(spark.read.json(p)).count() == 0
    lines = open(p).read().splitlines()
    open(p, "w").write("\n".join([lines[0], lines[1].replace('"n": 1', '"n": 5'), lines[2]]) + "\n")
    with pytest.raises(ValueError, match="broken"):
        sinks.append_audit(p, "export", {}, T0)
    with pytest.raises(ValueError, match="retention"):
        sinks.append_audit(str(tmp_path / "b"), "x", {}, T0, 10)


@pytest.fixture(scope="module")
def tables(spark):
    events = log(spark, [(i, i * 0.5, 100.0 + i) for i in range(10)]).persist()
    native = projector.native_rows(events, "binance_spot_trades")
    okx = native.select(F.lit("BTC-USDT").alias("instrument_name"), "trade_id", F.lit("sell").alias("side"), "price", F.col("quantity").alias("size"), "quote_quantity", "timestamp", "datetime")
    metrics = spark.createDataFrame([("m1", "etf_x", "btc_units", "BTC", None, None, 10.0, None, T0, "{}", None, T0)], "metric_id string, source_id string, metric_name string, metric_unit string, metric_value_string string, metric_value_int long, metric_value_float double, metric_value_bool boolean, observed_at_utc timestamp, dimensions_json string, provenance_json string, ingested_at_utc timestamp")
    return Tables(spark, frames={"binance_spot_trades": native, "okx_spot_trades": okx, "etf_daily_metrics": metrics, "aligned_1s": aligned.bucketise(events)})


def test_facade(tables):
    h = HistoricalData(tables)
    assert [m for m in dir(h) if m.startswith("get_")].__len__() == 16
    assert h.get_binance_spot_trades(n_latest_rows=2).count() == 2 and "datetime" in h.data_columns
    assert h.get_okx_spot_trades(fields=["is_buyer_maker"]).distinct().collect()[0][0] == 1
    assert h.get_binance_spot_trades(mode="aligned_1s", start_date="2024-01-01", end_date="2024-01-01").count() == 5
    native, seconds = h.get_binance_spot_klines(kline_size=2).collect(), h.get_binance_spot_klines(mode="aligned_1s", kline_size=2).collect()
    assert [(r["open"], r["close"], r["volume"], r["no_of_trades"]) for r in native] == [(r["open"], r["close"], r["volume"], r["no_of_trades"]) for r in seconds]
    assert len(native[0]) == 19 and len(seconds[0]) == 8
    assert h.get_etf_daily_metrics(filters=[{"field": "metric_value_float", "op": "gt", "value": 5.0}], fields=["metric_name"]).first()[0] == "btc_units"
    with pytest.raises(ValueError, match="strict"):
        h.get_binance_spot_trades(n_random_rows=1, strict=True)
    with pytest.raises(ValueError, match="mode"):
        h.get_binance_spot_trades(mode="other")


def test_service(tables, tmp_path):
    s = Service(tables)
    out = s.query({"sources": ["binance_spot_trades"], "n_rows": 3})
    assert out["row_count"] == 3 and out["warnings"] and out["rows"][0]["datetime"].endswith("Z")
    assert s.query({"sources": ["binance_spot_trades"], "mode": "aligned_1s", "fields": ["aligned_at_utc", "trade_count"]})["row_count"] == 5
    with pytest.raises(Empty):
        s.query({"sources": ["binance_spot_trades"], "time_range": ("2025-01-01", "2025-01-02")})
    for bad in ({"sources": []}, {"sources": ["x"]}, {"sources": ["binance_spot_trades"], "n_rows": 1, "n_random": 1}, {"sources": ["binance_spot_trades"], "n_rows": 1, "strict": True}):
        with pytest.raises(ValueError):
            s.query(bad)
    assert s.export({"sources": ["binance_spot_trades"], "n_rows": 2}, str(tmp_path))["row_count"] == 2
    with pytest.raises(ValueError, match="exactly one window"):
        s.export({"sources": ["binance_spot_trades"]}, str(tmp_path))
    gate = Admission(1, 0)
    with gate.admitted(), pytest.raises(Busy), gate.admitted():
        pass


def test_http(tables, tmp_path):
    from tidemark.http import HISTORICAL, Application

    app = Application(tables, str(tmp_path))
    assert len(HISTORICAL) == 15

    def call(method, path, payload=None, raw=None):
        body, got = raw if raw is not None else json.dumps(payload or {}).encode(), {}
        out = app({"REQUEST_METHOD": method, "PATH_INFO": path, "CONTENT_LENGTH": str(len(body)), "wsgi.input": io.BytesIO(body)}, lambda status, headers: got.update(status=int(status[:3])))
        return got["status"], json.loads(b"".join(out))

    assert call("GET", "/health") == (200, {"status": "ok"})
    code, out = call("POST", "/v1/historical/binance/spot/trades", {"n_latest_rows": 2})
    assert code == 200 and out["row_count"] == 2 and out["warnings"] and out["rows"][0]["datetime"].endswith("Z")
    assert call("POST", "/v1/historical/etf/daily_metrics", {"fields": ["metric_name"]})[1]["rows"] == [{"metric_name": "btc_units"}]
    assert call("POST", "/v1/raw/query", {"sources": ["binance_spot_trades"], "n_rows": 1})[0] == 200
    for path, payload, want in (
        ("/v1/historical/binance/spot/trades", {"kline_size": 2}, 422), ("/v1/historical/binance/spot/trades", {"n_latest_rows": 1, "strict": True}, 409),
        ("/v1/historical/binance/spot/trades", {"start_date": "2030-01-01", "end_date": "2030-01-02"}, 404), ("/v1/raw/query", {"sources": ["nope"]}, 409), ("/v1/other", {}, 404),
    ):
        assert call("POST", path, payload)[0] == want, (path, payload)
    assert call("POST", "/v1/raw/query", raw=b"[1]")[0] == 422
    code, job = call("POST", "/v1/raw/export", {"sources": ["binance_spot_trades"], "n_rows": 2, "format": "csv"})
    app.jobs[job["export_id"]]["thread"].join(60)
    code, status = call("GET", f"/v1/raw/export/{job['export_id']}")
    assert (code, status["status"], status["artifact"]["row_count"]) == (200, "succeeded", 2)
    assert call("GET", "/v1/raw/export/none")[0] == 404
    assert call("POST", "/v1/historical/binance/spot/trades", {"n_latest_rows": 2})[0] == 200
    denied = Application(tables, str(tmp_path), {"sources": [{"source": "x", "datasets": ["binance_spot_trades"], "rights_state": "Ingest Only"}]})
    app = denied
    assert call("POST", "/v1/raw/query", {"sources": ["binance_spot_trades"]})[0] == 403
