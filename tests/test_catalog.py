"""The driver's contract on the smallest tables, checked against DuckDB."""

import importlib
import os

import pandas as pd
import pytest

from panelloom.catalog import QUERIES
from panelloom.oracle import build_sql

FOLDER = "/root/testdata/sf0.001"
TABLES = ["events", "orders"]
SAMPLE = ["s3_full_scan", "j4_blocked_days", "w1_xsec_rank_vector", "w5_impute_cross_day", "w10_ts_rank", "p1_packet"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")


@pytest.fixture(scope="module")
def entry_module():
    return importlib.import_module("__spark_entry__")


def test_every_query_has_sql(entry_module):
    assert set(QUERIES) == set(build_sql())
    assert set(QUERIES) <= set(entry_module.queries()) and set(build_sql()) <= set(entry_module.oracle_sql())


def test_entry(spark, entry_module):
    df = entry_module.entry(spark)
    assert df.columns[:3] == ["stockid", "dateid", "timeid"]
    assert df.count() == 15 * 30 * 24


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, entry_module, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = connection.execute(entry_module.oracle_sql()[name]).df()
    got = entry_module.queries()[name](spark, FOLDER).toPandas()
    keys = [c for c in ("stockid", "dateid", "timeid") if c in got.columns]
    want = want[got.columns].sort_values(keys).reset_index(drop=True)
    got = got.sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=0, atol=1e-9)
