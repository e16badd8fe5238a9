from datetime import UTC, datetime

import pytest

from tidemark.catalog import DATASETS, aligned_columns
from tidemark.operators import filters, native
from tidemark.plans import windows as w


def trades(spark, rows):
    return spark.createDataFrame(rows, "trade_id long, timestamp long, price double, quantity double, quote_quantity double, is_buyer_maker byte, is_best_match byte, datetime timestamp")


@pytest.fixture(scope="module")
def ten(spark):
    ms = 1704067200000
    return trades(spark, [(i, (ms + i * 1000) * (1000 if i == 9 else 1), 100.0 + i, 1.0, 100.0 + i, i % 2, 1, datetime.fromtimestamp(ms / 1000 + i, UTC)) for i in range(10)])


def test_resolution_and_its_errors():
    assert w.resolve() == w.AllRows() and w.resolve(n_rows=3) == w.LatestRows(3) and w.resolve(n_random=2) == w.RandomRows(2)
    assert w.resolve(month_year=(12, 2023)).as_range() == w.TimeRange("2023-12-01T00:00:00Z", "2024-01-01T00:00:00Z")
    for bad in (lambda: w.resolve(n_rows=1, n_random=1), lambda: w.Month(13, 2024), lambda: w.LatestRows(0), lambda: w.TimeRange("2024-01-02", "2024-01-01"), lambda: w.strict_date("start_date", "2024-1-1"), lambda: w.strict_date("d", "2024-02-30")):
        with pytest.raises(ValueError):
            bad()


def test_historical_end_is_inclusive_and_open_bounds_resolve(ten):
    assert w.resolve_historical(ten, "datetime", "2024-01-01", "2024-01-01") == w.TimeRange("2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")
    assert w.resolve_historical(ten, "datetime", start_date="2023-12-30").end == "2024-01-02T00:00:00Z"
    with pytest.raises(ValueError, match="no rows"):
        w.resolve_historical(ten.limit(0), "datetime", start_date="2024-01-01")
    with pytest.raises(ValueError, match="start_date <= end_date"):
        w.resolve_historical(ten, "datetime", "2024-01-02", "2024-01-01")


def test_plans():
    month, latest = w.Month(1, 2024), w.LatestRows(5)
    for name in ("bitcoin_block_fee_totals", "etf_daily_metrics", "fred_series_metrics"):
        assert w.plan_aligned(name, month).path.endswith("forward_fill") and isinstance(w.plan_aligned(name, month).window, w.TimeRange)
        assert w.plan_aligned(name, latest).path.endswith("observation")
    assert w.plan_aligned("bitcoin_block_headers", month).path == "bitcoin_stream_aligned_observation"
    assert w.plan_aligned("okx_spot_trades", month) == w.AlignedPlan("okx_spot_trades", "okx_aligned", month)
    with pytest.raises(ValueError):
        w.plan_aligned("other", month)


def test_catalogue_is_whole():
    assert len(DATASETS) == 12 and sorted(d.rank for d in DATASETS.values()) == list(range(1, 13))
    for d in DATASETS.values():
        assert set(d.default_columns) <= set(d.columns) and {d.id_column, d.time_column, d.seed_column} <= set(d.columns)
        assert "aligned_at_utc" in aligned_columns(d.name)


def test_filters_run_after_the_window(ten):
    clause = [{"field": "price", "op": "lt", "value": 108.0}]
    rows = native.query_native(ten, "binance_spot_trades", w.LatestRows(3), filters=clause).collect()
    assert [r["trade_id"] for r in rows] == [7]
    assert native.query_native(ten, "binance_spot_trades", w.AllRows(), filters=clause).count() == 8


def test_columns_timestamps_and_order(ten):
    df = native.query_native(ten, "binance_spot_trades", w.LatestRows(2), ["price", "price", "timestamp"], include_datetime=False)
    assert df.columns == ["price", "timestamp"]
    assert [r["timestamp"] for r in df.collect()] == [1704067208000, 1704067209000]
    assert native.query_native(ten, "binance_spot_trades", w.AllRows(), iso=True).first()["datetime"] == "2024-01-01T00:00:00.000Z"
    with pytest.raises(ValueError, match="Unsupported columns"):
        native.query_native(ten, "binance_spot_trades", w.AllRows(), ["nope"])
    with pytest.raises(ValueError, match="non-empty"):
        native.query_native(ten, "binance_spot_trades", w.AllRows(), [])


def test_random_rows_do_not_change(ten):
    first = native.query_native(ten, "binance_spot_trades", w.RandomRows(4)).collect()
    assert first == native.query_native(ten.repartition(5), "binance_spot_trades", w.RandomRows(4)).collect() and len(first) == 4


def test_only_needed_columns_and_the_range_reach_the_scan(spark, ten, tmp_path):
    ten.write.parquet(str(tmp_path / "t"))
    df = native.query_native(spark.read.parquet(str(tmp_path / "t")), "binance_spot_trades", w.TimeRange("2024-01-01T00:00:02Z", "2024-01-01T00:00:04Z"), ["price"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "quote_quantity" not in plan and "GreaterThanOrEqual(datetime" in plan
    assert [r["price"] for r in df.collect()] == [102.0, 103.0]


@pytest.mark.parametrize(
    "clause, message",
    [
        ({"field": "", "op": "eq", "value": 1}, "field must be"), ({"field": "price", "op": "like", "value": 1}, "op must be"), ({"field": "price", "op": "eq"}, "value must be provided"),
        ({"field": "price", "op": "in", "value": []}, "non-empty list"), ({"field": "other", "op": "eq", "value": 1}, "not available"), ({"field": "price", "op": "eq", "value": "x"}, "Invalid filter"),
    ],
)
def test_bad_filters(ten, clause, message):
    with pytest.raises(ValueError, match=message):
        filters.apply_filters(ten, [clause])


def test_fields(ten):
    assert filters.apply_fields(ten, [" price", "trade_id", "price"]).columns == ["price", "trade_id"]
    for bad in ([], [" "], ["nope"]):
        with pytest.raises(ValueError):
            filters.apply_fields(ten, bad)
    with pytest.raises(ValueError, match="scalar"):
        filters.require_scalars([{"field": "a", "op": "eq", "value": [1]}])


def test_null_passes_no_filter(spark):
    df = spark.createDataFrame([(1,), (None,)], "a long")
    for op, value in (("ne", 5), ("not_in", [5])):
        assert [r["a"] for r in filters.apply_filters(df, [{"field": "a", "op": op, "value": value}]).collect()] == [1]


def test_sides(spark):
    rows = spark.createDataFrame([("BUY",), (" sell ",)], "side string")
    from pyspark.sql import functions as F

    assert [r[0] for r in rows.select(native.maker_flag(F.col("side"))).collect()] == [0, 1]
    with pytest.raises(Exception, match="Unsupported side"):
        spark.createDataFrame([("hold",)], "side string").select(native.maker_flag(F.col("side"))).collect()
