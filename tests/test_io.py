"""Sources and sinks (S1-S10) and the streaming append."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from etafeat.sources import io, schemas
from etafeat.streaming import append_stream


def test_csv_round_trip_with_schema(spark):
    d = tempfile.mkdtemp(prefix="etafeat-io-")
    rows = [("1", "A", "Pune", "R", "₹ 200", 4.0, 10, "a, \"b\"", "x\ny", 30.0)]
    df = spark.createDataFrame(rows, schemas.RAW_RESTAURANTS)
    io.write_csv(df, f"{d}/raw")
    back = io.read_csv(spark, f"{d}/raw", schemas.RAW_RESTAURANTS, multi_line=True).collect()
    assert [tuple(r) for r in back] == rows


def test_write_observed_counts_while_writing(spark):
    d = tempfile.mkdtemp(prefix="etafeat-io-")
    n = io.write_observed(spark.range(123), f"{d}/t")
    assert n == 123 and spark.read.parquet(f"{d}/t").count() == 123


def test_append_and_partition_overwrite(spark):
    d = tempfile.mkdtemp(prefix="etafeat-io-")
    a = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, day string")
    io.write_parquet(a, f"{d}/t", partition_by=["day"])
    io.append_batch(spark.createDataFrame([(3, "2024-01-02")], "id int, day string"), f"{d}/t", ["day"])
    assert spark.read.parquet(f"{d}/t").count() == 3
    io.write_parquet(spark.createDataFrame([(9, "2024-01-02")], "id int, day string"), f"{d}/t",
                     partition_by=["day"])
    got = sorted(r.id for r in spark.read.parquet(f"{d}/t").collect())
    assert got == [1, 9]


def test_metrics_json(spark):
    d = tempfile.mkdtemp(prefix="etafeat-io-")
    rep = spark.range(10).agg(F.count(F.lit(1)).alias("n"),
                              F.struct(F.min("id").alias("lo"), F.max("id").alias("hi")).alias("range"))
    doc = io.write_metrics(spark, rep, f"{d}/m.json")
    assert doc == {"n": 10, "range": {"lo": 0, "hi": 9}}
    assert io.read_metrics(spark, f"{d}/m.json") == doc
    assert spark.read.json(f"{d}/m.json").select("range.hi").first()[0] == 9


def test_streaming_append_exactly_once(spark):
    d = tempfile.mkdtemp(prefix="etafeat-stream-")
    src, dst, ck = f"{d}/in", f"{d}/out", f"{d}/ck"
    schema = "id long, v double"
    spark.createDataFrame([(1, 1.0), (2, 2.0)], schema).write.parquet(f"{src}/b1")
    append_stream(spark, f"{src}/*", spark.createDataFrame([], schema).schema, dst, ck)
    spark.createDataFrame([(3, 3.0)], schema).write.parquet(f"{src}/b2")
    append_stream(spark, f"{src}/*", spark.createDataFrame([], schema).schema, dst, ck)
    append_stream(spark, f"{src}/*", spark.createDataFrame([], schema).schema, dst, ck)
    assert sorted(r.id for r in spark.read.parquet(dst).collect()) == [1, 2, 3]
    assert os.path.isdir(ck)


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("x", F.col("id") * 2)
    assert io.commit_batch(rows, path, "001") == 10
    assert io.commit_batch(rows, path, "001") == 0
    assert io.commit_batch(rows.filter("id < 3"), path, "2024-01-02") == 3
    assert io.commit_batch(rows.filter("false"), path, "none") == 0
    got = [tuple(r) for r in io.read_batches(spark, path).select("batch", "id", "x").collect()]
    assert sorted(got) == sorted([("001", i, 2 * i) for i in range(10)] + [("2024-01-02", i, 2 * i) for i in range(3)])


def test_a_broken_attempt_is_replaced_and_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    io.commit_batch(spark.range(2), path, "a")
    spark.range(5).write.parquet(f"{path}/data/part=b.b")  # data without a manifest record
    assert io.read_batches(spark, path).count() == 2
    assert io.commit_batch(spark.range(3), path, "b") == 3
    assert io.read_batches(spark, path).count() == 5
    with pytest.raises(ValueError):
        io.commit_batch(spark.range(1), path, "a/../b")
    with pytest.raises(FileNotFoundError):
        io.read_batches(spark, str(tmp_path / "nothing"))


def test_observed_points_of_one_write(spark, tmp_path):
    w = io.ObservedWrite()
    rows = w.watch(spark.range(100), "read", top=F.max("id"))
    kept = w.watch(rows.filter("id % 4 > 0"), "kept")
    w.write(w.watch(kept.groupBy((F.col("id") % 10).alias("k")).count(), "written", n_all=F.sum("count")), str(tmp_path / "t"))
    assert w.document() == {"read": {"n_rows": 100, "top": 99}, "kept": {"n_rows": 75}, "written": {"n_rows": 10, "n_all": 75}}
    assert w.drop_rate("read", "kept") == 0.25
    with pytest.raises(ValueError):
        w.watch(rows, "read")


def test_observed_write_of_no_rows(spark, tmp_path):
    w = io.ObservedWrite()
    empty = w.watch(spark.range(5).filter("id > 7"), "none", top=F.max("id"))
    w.write(empty, str(tmp_path / "t"))
    assert w.values("none") == {"n_rows": 0, "top": None} and w.drop_rate("none", "none") == 0
    assert spark.read.parquet(str(tmp_path / "t")).count() == 0


LINES = ["id,price,name", '1,2.5,"a, ""b"""', "2,,", "x,1.0,c", "4,1.0", "5,1.0,d,e", "", '6,9,"open']


def test_lenient_csv_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "in.csv").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    schema = io.StructType.fromDDL("id long, price double, name string")
    good, bad, counts = io.read_csv_lenient(spark, str(tmp_path / "in.csv"), schema, str(tmp_path / "out"))
    got = sorted(map(tuple, good.collect()))
    assert got[:2] == [(1, 2.5, 'a, "b"'), (2, None, None)] and [r[0] for r in got] == [1, 2, 6]
    assert sorted(r[0] for r in bad.collect()) == ["4,1.0", "5,1.0,d,e", "x,1.0,c"]
    assert counts == {"n_rows": 6, "n_bad": 3, "bad_share": 0.5}
    # the parts stay right when one column is read
    assert good.select("name").count() == 3 and good.agg(F.sum("id")).first()[0] == 9


def test_lenient_csv_of_an_empty_file(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id\n", encoding="utf-8")
    good, bad, counts = io.read_csv_lenient(spark, str(tmp_path / "in.csv"), io.StructType.fromDDL("id long"), str(tmp_path / "out"))
    assert good.collect() == [] and bad.collect() == [] and counts == {"n_rows": 0, "n_bad": 0, "bad_share": 0.0}


def test_csv_is_read_by_lines_unless_asked(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n" + "1,2\n" * 400_000, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        lines = io.read_csv(spark, str(tmp_path / "in.csv"))
        whole = io.read_csv(spark, str(tmp_path / "in.csv"), multi_line=True)
        parts = lambda df: df.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts(lines) > 1 and parts(whole) == 1 and lines.count() == 400_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
