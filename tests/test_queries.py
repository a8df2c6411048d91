"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for name in check.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    text, _, good = check.compare(spark, connection, name, QUERIES[name], SQL.get(name), SF_DIR)
    assert good, text


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_listing_queries_needs_no_session():
    import os
    import subprocess
    import sys

    root = os.path.dirname(check.__file__)
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_python_stages_run_from_any_folder(tmp_path):
    """Workers must find the package when the application starts elsewhere."""
    import os
    import subprocess
    import sys

    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(check.__file__)!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
for name in ("match_consume", "match_sink"):
    assert e.queries()[name](spark, {SF_DIR!r}).count() == 94
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=300)
