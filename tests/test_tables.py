"""Reading and writing tables, fixtures, the stream, and the driver's contract."""

import datetime as dt
import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from meterflow import fixtures
from meterflow.schemas import DEFAULTS
from meterflow.sources import tables

ROOT = Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"


def test_round_trip_and_defaults(spark, tmp_path):
    schema = tables.schema_of("timeseries_refs")
    rows = [("t1", "s1", "daily", "counter", "raw", False, dt.date(2024, 1, 2), None, "D", "p", "x", None, [], None), ("t2", "s1", "daily", "counter", "derived", True, None, None, None, None, None, None, ["t1", "t9"], "sum")]
    df = spark.createDataFrame(rows, schema)
    tables.write_table(df, f"file://{tmp_path}/timeseries_refs.csv")
    back = tables.load_dataset(spark, f"file://{tmp_path}")
    assert sorted(map(tuple, back["timeseries_refs"].collect())) == rows
    assert back["meters"].count() == 0 and back["meters"].schema == tables.schema_of("meters") and len(back) == 13


@pytest.mark.parametrize("cell, want", [("", True), ("TRUE", True), ("1", True), ("yes", True), ("false", False), ("0", False), ("no", False)])
def test_boolean_words(spark, cell, want):
    df = spark.createDataFrame([("a", cell)], "annotation_id string, is_resolved string")
    row = tables.typed(df, tables.schema_of("annotations"), DEFAULTS["annotations"]).first()
    assert row.is_resolved is want and row.description == "" and row.related_refs == []


def test_overlay_is_idempotent_and_strict(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    patch, gone = spark.createDataFrame([(2, "x"), (9, "y")], "k int, v string"), spark.createDataFrame([(3,)], "k int")
    once = tables.keyed_overlay(base, patch, gone, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "x"), (9, "y")]
    assert sorted(map(tuple, tables.keyed_overlay(once, patch, gone, ["k"]).collect())) == sorted(map(tuple, once.collect()))
    with pytest.raises(ValueError):
        tables.keyed_overlay(base, spark.createDataFrame([(1, 2)], "k int, z int"), gone, ["k"])


def test_fixture_dependencies():
    sql = fixtures.oracle("select * from reported")
    assert re.findall(r"(\w+) as \(", sql.split("\nselect * from reported")[0])[0] == "ev" and "{" not in sql


def test_contract(spark):
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 100
    assert entry.entry(spark).limit(1).count() == 1
    if entry.llm is not None:
        assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in queries} and "pipeline" in queries


def test_core_stands_without_the_optional_part(tmp_path):
    for path in (ROOT / "meterflow").rglob("*.py"):
        if "llm" not in path.parts:
            assert "meterflow.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text()
    count = "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op1_') for q in e.queries()), e.llm is None)"

    def run(*where):
        env = os.environ | {"PYTHONPATH": os.pathsep.join(map(str, where))}
        out = subprocess.run([sys.executable, "-c", count], cwd=where[0], env=env, capture_output=True, text=True, timeout=120)
        assert out.returncode == 0, out.stderr
        return out.stdout.split()

    bare = tmp_path / "bare"
    shutil.copytree(ROOT / "meterflow", bare / "meterflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", bare)
    n = run(bare)
    assert int(n[0]) > 120 and n[1:] == ["False", "True"]
    # a dependency of the part is missing
    (tmp_path / "hide").mkdir()
    (tmp_path / "hide/regex.py").write_text("raise ModuleNotFoundError('hidden', name='regex')")
    assert run(ROOT, tmp_path / "hide")[0] >= n[0]


def test_oracles_agree_on_the_smallest_tables(spark):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    for name in ("c9_meter_net", "d8_materialize", "e11_merge_offline", "q7_compare_reported", "t21_nearest_upstream", "v1_no_cycles"):
        got = [r.asDict() for r in entry.queries()[name](spark, DATA).collect()]
        cur = con.execute(entry.oracle_sql()[name])
        cols = [c[0] for c in cur.description]
        want = sorted(str(r) for r in cur.fetchall())
        assert sorted(str(tuple(r[c] for c in cols)) for r in got) == want, name


def test_written_tables_go_with_the_application(tmp_path):
    """Each application has a folder of its own, emptied by `release` and gone at its end; without a
    shared folder only local masters are served."""
    code = f"""
import os
from pyspark.sql import SparkSession
from meterflow.plans import stage
spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', 'file://{tmp_path}/s').getOrCreate()
one, two = stage.staged(spark.range(3), 'one'), stage.staged(spark.range(3), 'two')
stage.release(one)
(folder,) = [x for x in os.listdir('{tmp_path}/s') if x.startswith('meterflow-')]
print(len(os.listdir('{tmp_path}/s/' + folder)), two.count())
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=180)
    assert out.stdout.split() == ["1", "3"], out.stdout + out.stderr
    assert not [x for x in os.listdir(tmp_path / "s") if x.startswith("meterflow-")]
    from types import SimpleNamespace

    from meterflow.plans.stage import shared_dir

    with pytest.raises(ValueError):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077")))


def test_stream_of_readings(spark, tmp_path):
    from meterflow.streaming.flow import measured_flow_stream

    schema = "timeseries_id string, timestamp timestamp, value double, recorded_at timestamp"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def feed(*rows):
        data = [(s, dt.datetime(2024, 1, d), float(v), r and dt.datetime(2024, 2, r)) for s, d, v, r in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = measured_flow_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "2 days")
        q = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        assert q.awaitTermination(120)

    feed(("A", 1, 10, None), ("A", 2, 15, None), ("B", 1, 1, None))
    feed(("A", 3, 99, None), ("A", 2, 16, 5))
    feed(("A", 3, 30, 6), ("A", 6, 50, None), ("B", 7, 9, None))
    feed(("A", 20, 70, None))
    feed(("A", 21, 70, None))
    got = {(r.timeseries_id, r.timestamp.day): r.delta for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {("A", 2): 6, ("A", 3): 14, ("A", 6): 20, ("B", 7): 8}


def test_stream_of_arrivals_in_many_files(spark):
    """An arrival that several tasks write: no file of it makes the others late."""
    from meterflow.streaming.flow import run_once

    schema = "timeseries_id string, timestamp timestamp, value double, recorded_at timestamp"
    rows = [(s, dt.datetime(2024, 1, d), float(d * d), None) for s in "ABCDEFGH" for d in range(1, 25)] + [("A", dt.datetime(2024, 1, 2), 5.0, dt.datetime(2024, 2, 1))]
    ahead = [spark.createDataFrame([("", dt.datetime(2024, m, 1), 0.0, None)], schema) for m in (3, 4)]
    out = run_once(spark, [spark.createDataFrame(rows, schema).repartition(4, "timeseries_id"), *ahead]).where("timeseries_id <> ''")
    got = {(r.timeseries_id, r.timestamp.day): r.delta for r in out.collect()}
    want = {(s, d): 2.0 * d - 1 for s in "ABCDEFGH" for d in range(2, 25)} | {("A", 2): 4.0, ("A", 3): 4.0}
    assert got == want and out.count() == len(want)
