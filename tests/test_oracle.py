"""Every registered query with an oracle matches DuckDB at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

from conftest import SF01

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF01)
    assert r["ok"], r


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["STATION_ID", "DATE", "COUNT", "LAG_1", "LAG_7", "HOLIDAY", "PRECIP", "TEMP"]
    assert len(rows) == 189 and {r["STATION_ID"] for r in rows} == {"5-LOW"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, name):
    """The driver's rows-only check: every other query runs and keeps its schema."""
    df = QUERIES[name](spark, SF01)
    cols = df.columns
    assert df.count() >= 0 and df.columns == cols and cols


def test_python_workers_import_the_package_from_any_directory(tmp_path):
    """A session built elsewhere, from another working directory, still runs the
    pandas-function queries (the package is shipped to the workers)."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("entry", {os.path.join(root, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
print("ROWS", E.queries()["train_per_station"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
