"""Every registered query against its DuckDB twin on the smallest test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from etafeat.plans.catalog import all_queries  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

CATALOG = all_queries()
SQL = {name: q.sql for name, q in CATALOG.items() if q.sql}
NAMES = sorted(CATALOG)


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    sdf = entry.queries()[name](spark, sf).toPandas()
    if name not in SQL:
        assert len(sdf) >= 0
        return
    res = compare(sdf, con.execute(SQL[name]).fetchdf())
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res.get("exact"), res


def test_every_query_has_a_twin():
    assert set(NAMES) == set(SQL)
    assert set(NAMES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert len(df.columns) > 10 and df.count() > 0
