"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names and the multiset of rows)."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck_connection
from skuflow.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)  # the corpus queries have tests of their own


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(f"{SF}/lineitem.parquet"):
        pytest.skip("test data not present")
    return duck_connection(SF)


def test_every_query_is_registered_with_matching_oracle_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 65


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert str(res["status"]).startswith("ok"), res


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "true_top_saling_mark" in df.columns
