"""Each registered query that has SQL gives the SQL's rows on the smallest tables."""

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark import cluster, queries
from tidemark.operators import eventlog

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events pages".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def shown(v):
    return f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL)
    rows = df.collect()
    if name not in queries.SQL:
        return
    found = duck.execute(queries.SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted(tuple(shown(r[columns.index(c)]) for c in order) for r in found.fetchall())
    assert sorted(tuple(shown(r[c]) for c in order) for r in rows) == want


def told(folder):
    code = "import __spark_entry__ as e; print('NAMES', *e.queries()); print('SQL', *e.oracle_sql())"
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)}, capture_output=True, text=True)


def test_entry_works_without_the_llm_folders(spark, tmp_path):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    home = Path(__file__).parent.parent
    whole = tmp_path / "repo"
    shutil.copytree(home, whole, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py"))
    for leftover in (False, True):
        if leftover:  # an empty folder is no subpackage either
            (whole / "tidemark/llm/__pycache__").mkdir(parents=True)
        out = told(whole)
        assert out.returncode == 0, out.stderr
        lines = {x.split()[0]: set(x.split()[1:]) for x in out.stdout.splitlines() if x.startswith(("NAMES", "SQL"))}
        assert lines == {"NAMES": set(queries.QUERIES), "SQL": set(queries.SQL)}
    # a broken subpackage is not a missing one
    (whole / "tidemark/llm/__init__.py").write_text("")
    (whole / "tidemark/llm/queries.py").write_text("import no_such_package\n")
    assert "no_such_package" in told(whole).stderr


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    class Context:
        master = "yarn"

        class _jsc:
            @staticmethod
            def sc():
                return Context

        @staticmethod
        def getCheckpointDir():
            return Context

        @staticmethod
        def isEmpty():
            return True

    class Session:
        sparkContext, conf = Context, type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        cluster.checkpoint_folder(Session)


def test_grid_join_has_every_metric(spark):
    kinds = spark.read.parquet(f"{SMALL}/events.parquet").select("event_type").distinct().count()
    columns = queries.QUERIES["ext_grid_join"](spark, SMALL).columns
    assert all(any(c.startswith(f"m{k}") for c in columns) for k in range(kinds)), columns


def test_subsidies_of_blocks_after_all_halvings(spark, tmp_path):
    """Heights of a larger table: 63 halvings and more, where the SQL's power of two is no bigint."""
    keys = [0, 2100, 2100 * 32, 2100 * 33, 2100 * 62, 2100 * 63, 2100 * 64, 9_000_001]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").selectExpr("o_orderkey", "timestamp_ntz'1995-01-02' as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    rows = queries.QUERIES["prj_10_bitcoin_block_subsidy_schedule"](spark, str(tmp_path)).collect()
    assert {r["block_height"]: (r["halving_interval"], r["subsidy_sats"], r["subsidy_btc"]) for r in rows} == {k: (k // 2100, 5_000_000_000 >> k // 2100, (5_000_000_000 >> k // 2100) / 1e8) for k in keys}
    assert queries.QUERIES["src_03_bitcoin_block_subsidy_schedule"](spark, str(tmp_path)).count() == len(keys)
    assert sum(r["bucket_event_count"] for r in queries.QUERIES["prj_22_bitcoin_block_subsidy_schedule_buckets"](spark, str(tmp_path)).collect()) == len(keys)
    assert queries.QUERIES["dq_07_subsidy"](spark, str(tmp_path)).first().asDict() == {"rows": len(keys), "halving": sum(k % 35 == 0 for k in keys), "subsidy": sum(k % 45 == 0 for k in keys), "btc": 0}


def test_first_lines_are_the_tables_first_of_equal_ones(spark, duck, tmp_path):
    """Lines of several files, in several tasks, with repeated numbers: the first by file and place is kept."""
    rows = [(k % 50, 1 + k * 7 % 3, 1000 - k) for k in range(600)]
    for n in range(3):
        spark.createDataFrame(rows[n * 200 : n * 200 + 200], "l_orderkey long, l_linenumber int, l_partkey long").coalesce(1).write.parquet(f"{tmp_path}/made{n}")
        part = next((tmp_path / f"made{n}").glob("part-*"))
        (tmp_path / "lineitem.parquet").mkdir(exist_ok=True)
        part.rename(tmp_path / f"lineitem.parquet/{2 - n}.parquet")
    first = {}
    for k, line, own in [r for n in (2, 1, 0) for r in rows[n * 200 : n * 200 + 200]]:
        if k not in first or line < first[k][0]:
            first[k] = (line, own)
    got = queries.QUERIES["win_09_keep_first"](spark, str(tmp_path)).collect()
    assert {r["l_orderkey"]: (r["l_linenumber"], r["l_partkey"]) for r in got} == first


def test_equal_lines_are_no_rise_of_ids(spark, tmp_path):
    """Two lines of one number and day that are equal once their faults are planted: the SQL counts every id that does not rise."""
    at = "timestamp_ntz'1995-01-02'"
    made = [(12, 1, 10.0, 5.0), (12, 1, 20.0, 5.0), (13, 1, 1.0, 1.0), (13, 1, 2.0, 1.0), (14, 1, 1.0, 1.0)]  # 12 * 8 + 1 = 97
    lines = spark.createDataFrame(made, "l_orderkey long, l_linenumber int, l_extendedprice double, l_quantity double")
    lines.selectExpr("*", "0.1D as l_tax", "0.1D as l_discount", "'R' as l_returnflag", f"{at} as l_shipdate").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("dq_02_okx", "dq_02_bybit"):
        con = duckdb.connect()
        con.sql(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
        want = con.execute(queries.SQL[name]).fetchone()
        assert tuple(queries.QUERIES[name](spark, str(tmp_path)).first()) == want
        assert want[1] == 2


def test_ingest_keeps_one_of_lines_with_the_same_number(spark, duck, tmp_path):
    """Repeated numbers with other prices, in many files: each plan of the batch must choose the same line."""
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").selectExpr("* except (l_shipdate, l_orderkey, l_linenumber)", "l_orderkey % 400 as l_orderkey", "1 as l_linenumber", "timestamp_ntz'1995-01-02' as l_shipdate")
    lines.repartition(24).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries.QUERIES["ing_01_lines_to_buckets"](spark, str(tmp_path)).collect()
    assert [(r["partition_id"], r["events"]) for r in got] == [("1995-01-02", 400)]
    rows = [("a", "2"), ("a", "1"), ("b", "3"), ("b", "3"), ("c", "4")]
    events = spark.createDataFrame(rows, "event_id string, payload_sha256 string").withColumn("ingested_at", F.expr("if(event_id = '', null, timestamp'2024-01-01')"))
    one = eventlog.one_of_each(events)
    assert sorted((r["event_id"], r["payload_sha256"]) for r in one.collect()) == [("a", "1"), ("b", "3"), ("c", "4")]
    assert [r["event_id"] for r in eventlog.to_insert(one, events.where("event_id = 'b'")).where("event_id <> 'a'").collect()] == ["c"]
    for log in ([], [("b", "9")], [("a", "1")]):
        with pytest.raises(Exception, match="another payload"):
            eventlog.to_insert(events, spark.createDataFrame([(*r, None) for r in log], events.schema)).collect()
