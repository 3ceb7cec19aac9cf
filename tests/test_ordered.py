"""Ordered operators over hot keys: equality with plain windows, spread over partitions."""

import random
from statistics import median

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from etafeat.operators import ordered
from etafeat.operators.ordered import carry, deal, dense_ids, even_keys, group_median, group_quantile, running_sums


def frame(spark, keys):
    rng = random.Random(len(keys))
    rows = [(i, keys[rng.randrange(len(keys))], rng.randrange(40), rng.choice([None, 1, 2, -5, 10])) for i in range(500)]
    return spark.createDataFrame(rows, "id int, k string, t int, v long").repartition(5)


@pytest.mark.parametrize("keys", [["hot"], ["a", "b", None], [f"k{i}" for i in range(90)]])
@pytest.mark.parametrize("peers", [True, False])
def test_running_sums_equal_plain_windows(spark, keys, peers):
    df = frame(spark, keys)
    order = ["t"] if peers else ["t", "id"]
    w = Window.partitionBy("k").orderBy(*order)
    w = w.rangeBetween(Window.unboundedPreceding, -1) if peers else w.rowsBetween(Window.unboundedPreceding, -1)
    want = {r.id: (r.s, r.n) for r in df.withColumns({"s": F.sum("v").over(w), "n": F.sum(F.lit(1)).over(w)}).collect()}
    for parts in (1, 3, 11):
        got = running_sums(df, ["k"], order, {"s": F.col("v"), "n": F.lit(1)}, peers, parts)
        assert got.columns == [*df.columns, "s", "n"]
        assert {r.id: (r.s, r.n) for r in got.collect()} == want


def test_one_key_spans_all_partitions(spark):
    dealt = deal(spark.range(4000).select(F.lit("hot").alias("k"), "id"), ["k", "id"], 8)
    shares = [r["count"] for r in dealt.groupBy("k", "__part").count().collect()]
    assert len(shares) == 8 and max(shares) < 2 * 4000 / 8
    assert sorted(r.n or 0 for r in carry(dealt, ["k"], {"n": F.lit(1)}).collect())[0] == 0


def test_dense_ids(spark):
    df = frame(spark, ["a", "b"])
    want = {r.id: i for i, r in enumerate(sorted(df.collect(), key=lambda r: (r.t, r.id)), 7)}
    for parts in (1, 4, 9):
        got = dense_ids(df, ["t", "id"], "n", 7, parts)
        assert {r.id: r.n for r in got.collect()} == want
    assert dense_ids(df.filter("false"), ["t", "id"], "n").count() == 0


def test_quantiles(spark):
    rng = random.Random(3)
    rows = [("hot", rng.choice([0.1, 0.2, 7.5, rng.random()])) for _ in range(701)] + [
        ("even", 1.0), ("even", 4.0), ("one", 3.0), ("none", None), (None, 2.0), (None, 3.0), ("ties", 5.0), ("ties", 5.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    values = {}
    for g, x in rows:
        values.setdefault(g, []).extend([] if x is None else [x])
    for parts in (1, 5):
        got = {r.g: r.m for r in group_quantile(df, ["g"], "x", 0.5, "m", parts).collect()}
        assert got == {g: median(v) if v else None for g, v in values.items()}
    got = {r.g: r.m for r in group_median(df, "g", "x", "m").collect()}
    assert got["hot"] == round(median(values["hot"]), 6)
    for q in (0.0, 0.3, 1.0):
        want = df.groupBy("g").agg(F.percentile("x", F.lit(q)).alias("m"))
        assert {r.g: r.m for r in group_quantile(df, ["g"], "x", q, "m").collect()} == pytest.approx(
            {r.g: r.m for r in want.collect()}, nan_ok=True)


def test_running_sums_meet_their_offsets_without_a_join(spark):
    """One exchange of the rows after they are dealt; hot keys still span partitions and get what came before."""
    df = spark.range(3000).select(F.lit("hot").alias("k"), "id", F.lit(2).cast("bigint").alias("v"), F.col("v").alias("s"))
    for peers in (True, False):
        got = running_sums(df, ["k"], ["id"], {"s": F.col("v")}, peers, 7)
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
        rows = got.orderBy("id").collect()
        assert got.columns == ["k", "id", "v", "s"]
        assert [r.s for r in rows] == [None, *[2 * i for i in range(1, 3000)]]


def test_running_sums_keep_rows_without_key_or_order(spark):
    rows = [(k, t, i) for i, (k, t) in enumerate([(None, 1), (None, 2), ("a", None), ("a", None), ("a", 5), ("b", 1)] * 3)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    got = running_sums(df, ["k"], ["t"], {"s": F.when(F.col("t").isNotNull(), F.col("v"))}, True, 4).collect()
    want = {v: sum(w for k2, u, w in rows if k2 == k and t is not None and u is not None and u < t) or None for k, t, v in rows}
    assert len(got) == len(rows) and {r.v: r.s for r in got} == want


def test_even_keys_are_those_a_task_may_hold(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FEW", 10)
    many = spark.range(1000).select((F.col("id") % 100).alias("k"), F.lit(1).alias("one"))
    assert even_keys(many, ["k"], 8) and even_keys(many, ["k", "one"], 8)
    assert not even_keys(many, ["one"], 8) and not even_keys(many, [], 8)
    assert not even_keys(many.select(F.when(F.col("k") > 20, F.col("k")).alias("k")), ["k"], 8)  # a fifth has no key
    monkeypatch.setattr(ordered, "BUCKETS", 4)  # keys that share a bucket are counted one by one
    assert even_keys(many, ["k"], 8)
    assert even_keys(many.filter("false"), ["k"], 8)


@pytest.mark.parametrize("peers", [True, False])
def test_even_running_sums_take_one_exchange(spark, peers):
    df = frame(spark, ["a", "b", None])
    order = ["t"] if peers else ["t", "id"]
    sums = {"s": F.col("v"), "v": F.lit(1)}
    want = running_sums(df, ["k"], order, sums, peers)
    got = running_sums(df, ["k"], order, sums, peers, even=True)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
