"""What the operators of this subpackage share: tables, stage boundaries, components, words."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\x0c\r"  # 0x20 and 0x09-0x0D: the only white space the contracts know


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local master, where everything is one process, may do without it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="etafeat-llm-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a stage boundary that
    cuts lineage and outlives any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else. Plain ``lower`` does that on pure ASCII, and faster."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u, v)`` (long): ``(node, root)``, root the smallest node.

    Alternating large-star and small-star rounds: each node's links move to the
    smallest neighbour, until the edges are stars around the roots. Hubs are
    grouped minima (combined before the shuffle) and joins that AQE can split;
    each round is written to the shared folder. Nodes without an edge to
    another node are not in the result.
    """
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e = materialize(e, "edges")
    was = mark(e)
    while was[0]:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small, "edges")
        now = mark(e)
        if now == was:
            break
        was = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
