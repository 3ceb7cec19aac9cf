"""Results must not depend on the session time zone (all times are wall-clock NTZ)."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck

ZONED = ["lag_count_1h", "target_encode_strict", "temporal_features", "route_hours", "request_capacity",
         "demand_profile", "time_split", "expected_traffic"]


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", ZONED)
def test_same_answer_in_another_zone(spark, sf, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sdf = entry.queries()[name](spark, sf).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = compare(sdf, con.execute(entry.oracle_sql()[name]).fetchdf())
    assert res.get("exact"), res
