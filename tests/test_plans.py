"""Physical-plan properties: no Python in the hot path, no cartesian products,
filters and column pruning reach the Parquet scan."""

import pytest

from etafeat.plans.catalog import all_queries

QUERIES = {name: q.fn for name, q in all_queries().items()}
BAD = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
# queries that join a one-row aggregate (a total, a span, a prior, a split cut) by nested loop
SCALAR = {"location_weights", "weighted_pick", "favourite_cuisines", "request_capacity", "demand_profile", "completeness",
          "hour_completeness", "segment_shares", "target_encode_rows", "target_encode_strict", "feature_matrix",
          "feature_validation", "feature_report", "time_split", "users_report", "routes_report", "affinity_topk",
          "orders_report", "restaurant_report"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_or_cartesian(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    assert "PythonUDF" not in plan and "EvalPython" not in plan
    assert "CartesianProduct" not in plan
    if name not in SCALAR:
        assert "BroadcastNestedLoopJoin" not in plan


def test_pushdown_and_pruning(spark, sf):
    from pyspark.sql import functions as F
    df = spark.read.parquet(f"{sf}/lineitem.parquet").filter(F.col("l_quantity") > 10).select("l_orderkey")
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_feature_matrix_shuffles_bounded(spark, sf):
    plan = plan_of(QUERIES["feature_matrix"](spark, sf))
    # every ordered feature has a small per-bucket aggregate beside its running sum
    assert plan.count("Exchange hashpartitioning") <= 28


@pytest.mark.parametrize("name", ["orders_report", "users_report", "routes_report", "restaurant_report", "distinct_counts"])
def test_reports_copy_no_rows(spark, sf, name):
    assert "Expand" not in plan_of(QUERIES[name](spark, sf))


def test_time_split_takes_its_passes_over_a_written_column(spark, sf):
    assert "lineitem" not in plan_of(QUERIES["time_split"](spark, sf))


def test_delivery_orders_read_the_lines_once(spark, sf):
    assert plan_of(QUERIES["delivery_orders"](spark, sf)).count("lineitem.parquet") == 1


def test_feature_report_deals_no_rows_of_even_keys(spark, sf):
    scans = [line for line in plan_of(QUERIES["feature_report"](spark, sf)).splitlines() if "/dealt/" in line]
    assert not [line for line in scans if "order_id" in line]
