"""Window operators: hand-made cases, equality with plain windows, repartition determinism."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from etafeat.operators import ordered
from etafeat.operators.windows import Trailing, cap_per_hour, target_encode, trailing_windows

T = dt.datetime


def test_trailing_count_ties_excluded(spark):
    times = [T(2024, 1, 1, 10), T(2024, 1, 1, 10), T(2024, 1, 1, 11), T(2024, 1, 1, 11), T(2024, 1, 1, 11),
             T(2024, 1, 1, 12, 30)]
    df = spark.createDataFrame([(i, "k", t) for i, t in enumerate(times)], "id int, k string, ts timestamp_ntz")
    out = trailing_windows(df, "k", "ts", [Trailing("n", "1h")]).orderBy("id").collect()
    assert [r.n for r in out] == [0, 0, 2, 2, 2, 0]


def test_trailing_across_bucket_edge(spark):
    # bucket of 1h: rows just before an hour boundary must count for rows after it
    times = [T(2024, 1, 1, 9, 59), T(2024, 1, 1, 10, 0), T(2024, 1, 1, 10, 58), T(2024, 1, 1, 11, 0)]
    df = spark.createDataFrame([(i, "k", t, float(i)) for i, t in enumerate(times)],
                               "id int, k string, ts timestamp_ntz, v double")
    out = trailing_windows(df, "k", "ts", [Trailing("n", "1h"), Trailing("m", "1h", "mean", "v", None)],
                           bucket="1h").orderBy("id").collect()
    assert [r.n for r in out] == [0, 1, 2, 2]
    assert out[0].m is None and out[2].m == 0.5 and out[3].m == 1.5


def test_expanding_mean_with_global_prior(spark):
    df = spark.createDataFrame([(i, "k", T(2024, 1, 1, i), float(i + 1)) for i in range(4)],
                               "id int, k string, ts timestamp_ntz, y double")
    out = target_encode(df, "k", "y", "ts", "id", "enc").orderBy("id").collect()
    assert [r.enc for r in out] == [2.5, 1.0, 1.5, 2.0]


def test_strict_ties_excluded(spark):
    df = spark.createDataFrame([(0, "k", T(2024, 1, 1), 1.0), (1, "k", T(2024, 1, 1), 3.0),
                                (2, "k", T(2024, 1, 2), 5.0)], "id int, k string, ts timestamp_ntz, y double")
    out = target_encode(df, "k", "y", "ts", "id", "enc", ties="strict", prior=0.0).orderBy("id").collect()
    assert [r.enc for r in out] == [0.0, 0.0, 2.0]


def _plain_reference(df):
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    w = Window.partitionBy("user_id").orderBy("__t").rangeBetween(-3_600_000_000, -1)
    we = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("__t", us)
              .withColumn("n", F.count(F.lit(1)).over(w))
              .withColumn("enc_sum", F.sum(F.col("value").cast("decimal(38,2)")).over(we))
              .withColumn("enc_n", F.count("value").over(we)))


def test_bucketed_equals_plain_and_partition_independent(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "ts", "value")
    ref = {r.event_id: r.n for r in _plain_reference(ev).collect()}
    results = []
    for parts in (1, 4, 17):
        d = ev.repartition(parts)
        a = trailing_windows(d, "user_id", "ts", [Trailing("n", "1h")], bucket="2h")
        b = target_encode(d, "user_id", "value", "ts", "event_id", "enc", scale=2, bucket="6h")
        got = {r.event_id: (r.n,) for r in a.collect()}
        enc = {r.event_id: r.enc for r in b.collect()}
        assert {k: v[0] for k, v in got.items()} == ref
        results.append((got, enc))
    assert results[0] == results[1] == results[2]


def test_cap_per_hour_restarts_each_hour(spark):
    rows = [(i, "r1", T(2024, 1, 1, 10, i)) for i in range(4)] + [(10, "r1", T(2024, 1, 1, 11, 0))]
    df = spark.createDataFrame(rows, "id int, rest string, ts timestamp_ntz")
    out = cap_per_hour(df, "rest", "ts", ["ts", "id"], 2).orderBy("id").collect()
    assert [r.id for r in out] == [0, 1, 10]


def test_values_keep_their_decimals(spark):
    """An open scale keeps the digits; a declared one that does not fit fails the job."""
    rows = [(i, dt.datetime(2024, 1, 1, 0, i), 0.12345 + i / 1e5) for i in range(20)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double").withColumn("k", F.lit("a"))
    got = trailing_windows(df, "k", "ts", [Trailing("m", "5m", "mean", "v", None)], bucket="2m").orderBy("ts").collect()
    for i, r in enumerate(got):
        past = [v for _, _, v in rows[max(0, i - 5):i]]
        assert r.m is None if not past else abs(r.m - sum(past) / len(past)) < 1e-14
    with pytest.raises(Exception, match="more than 2 decimals"):
        trailing_windows(df, "k", "ts", [Trailing("m", "5m", "mean", "v", None, 2)]).collect()


def test_trailing_sums_are_linear_and_keep_odd_rows(spark):
    rows = [("a", None, 1.0), (None, dt.datetime(2024, 1, 1), 2.0), (None, dt.datetime(2024, 1, 1, 0, 30), 3.0),
            ("a", dt.datetime(2024, 1, 1), None), ("a", dt.datetime(2024, 1, 1, 0, 59), 5.0), ("a", dt.datetime(2024, 1, 1, 1), 7.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    out = trailing_windows(df, "k", "ts", [Trailing("n", "1h"), Trailing("s", "1h", "sum", "v", 0.0, 1)], bucket="7m")
    got = {(r.k, str(r.ts)[11:16]): (r.n, r.s) for r in out.collect()}
    assert got == {("a", ""): (0, 0.0), (None, "00:00"): (0, 0.0), (None, "00:30"): (1, 2.0), ("a", "00:00"): (0, 0.0),
                   ("a", "00:59"): (1, 0.0), ("a", "01:00"): (2, 5.0)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe(RangeFrame, -3600" not in plan  # no sliding frame


def _timed(spark):
    rows = [(i, ["a", "b", "c", None][i % 4], None if i % 11 == 0 else T(2024, 1, 1, i % 23, i % 7), None if i % 5 == 0 else i / 2)
            for i in range(300)]
    return spark.createDataFrame(rows, "id int, k string, ts timestamp_ntz, v double")


SPECS = [Trailing("n", "1h"), Trailing("m", "3h", "mean", "v", 0.0, 1), Trailing("s", "2h", "sum", "v", None, 1)]


def test_even_and_hot_keys_give_the_same(spark, monkeypatch):
    df = _timed(spark)
    both = lambda: sorted(target_encode(trailing_windows(df, "k", "ts", SPECS), "k", "v", "ts", "id", "e", scale=1)
                          .collect(), key=lambda r: r.id)
    even = both()
    monkeypatch.setattr(ordered, "FEW", 0)
    assert not ordered.even_keys(df, ["k"])
    assert len(even) == 300 and both() == even


def test_features_of_an_even_key_share_one_exchange_and_write_nothing(spark):
    df = _timed(spark)
    out = trailing_windows(target_encode(df, "k", "v", "ts", "id", "e", scale=1), "k", "ts", SPECS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "dealt" not in plan
    assert plan.index("Generate") < plan.index("Exchange hashpartitioning")  # expiries are made after it
