"""Readers and writers (S1-S10): CSV at the edges, Parquet in between, JSON metrics.

Nothing here collects data to the driver except one-row metric frames and metrics
that were observed while writing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Column of ``read_csv_lenient`` that holds a line which does not fit the schema.
BAD_LINE = "_bad_line"


def _csv(spark: SparkSession, header: bool, multi_line: bool, timestamp_format: str):
    return (spark.read.option("header", header).option("multiLine", multi_line).option("escape", '"')
            .option("timestampNTZFormat", timestamp_format).option("mode", "PERMISSIVE"))


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, header: bool = True,
             timestamp_format: str = "yyyy-MM-dd HH:mm:ss", multi_line: bool = False) -> DataFrame:
    """CSV with an explicit schema when given.

    Without a schema every column is read as text (no inference pass over the data). Files are
    split into tasks at line ends; ``multi_line`` is for quoted cells that hold line breaks and
    makes each file one task.
    """
    r = _csv(spark, header, multi_line, timestamp_format)
    return r.schema(schema).csv(path) if schema is not None else r.csv(path)


def read_csv_lenient(spark: SparkSession, path: str, schema: StructType, out: str, header: bool = True,
                     timestamp_format: str = "yyyy-MM-dd HH:mm:ss", multi_line: bool = False) -> tuple[DataFrame, DataFrame, dict]:
    """(good rows, bad lines, counts) of a CSV in one parse.

    A line is bad where a cell does not parse as its type or the number of cells differs from
    the schema's; it is kept as it stands in ``BAD_LINE``. All columns are parsed, whatever is
    read later: with pruned columns the parser would miss bad cells. The rows go to the folder
    ``out`` once, parted by good and bad, and the counts ``n_rows``, ``n_bad`` and ``bad_share``
    (0 for no rows) are observed on the way.
    """
    if BAD_LINE in schema.names:
        raise ValueError(f"{BAD_LINE} is the column of the bad lines")
    full = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    rows = (_csv(spark, header, multi_line, timestamp_format).option("columnNameOfCorruptRecord", BAD_LINE)
            .schema(full).csv(path))
    bad = F.col(BAD_LINE).isNotNull()
    w = ObservedWrite()
    rows = w.watch(rows, "read", n_rows=F.count(F.lit(1)), n_bad=F.count_if(bad))
    w.write(rows.withColumn("_bad", bad), out, partition_by=["_bad"])
    counts = w.values("read")
    counts["bad_share"] = counts["n_bad"] / counts["n_rows"] if counts["n_rows"] else 0.0
    kept = spark.read.schema(full.add("_bad", "boolean")).parquet(out)
    return kept.filter("not _bad").select(*schema.names), kept.filter("_bad").select(BAD_LINE), counts


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; replace semantics by default."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> None:
    """Parquet sink (S8); with ``partition_by`` and dynamic partition overwrite, a
    re-run replaces only the partitions it writes (S7)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def append_batch(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Incremental append of a batch (S6, X3); the header/schema is written once by Parquet."""
    write_parquet(df, path, mode="append", partition_by=partition_by)


def _committed(spark: SparkSession, path: str) -> DataFrame | None:
    """(batch, n_rows) of the batches that were written in full; None before the first."""
    try:
        return spark.read.schema("batch string, n_rows long").json(f"{path}/manifest/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def commit_batch(df: DataFrame, path: str, batch: str) -> int:
    """Append ``df`` as ``batch`` once, however often it is called (S6, S7, X3); rows added.

    A batch is a folder of its own, which an attempt that broke off leaves to the next one to
    replace; a record in the manifest, with the row count observed while writing, makes it
    visible to ``read_batches``. A batch that is in the manifest adds nothing. Batches may be
    written side by side, one batch by one writer at a time.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
        raise ValueError(f"batch names are letters, digits, _ and -, not {batch!r}")
    spark = df.sparkSession
    done = _committed(spark, path)
    if done is not None and done.filter(F.col("batch") == batch).limit(1).count():
        return 0
    n = write_observed(df, f"{path}/data/part=b.{batch}")
    spark.createDataFrame([(batch, n)], "batch string, n_rows long").coalesce(1).write.mode("overwrite").json(
        f"{path}/manifest/{batch}")
    return n


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed batches, with their ``batch``; fails where none is committed."""
    done = _committed(spark, path)
    if done is None:
        raise FileNotFoundError(f"no committed batch in {path}")
    part = F.concat(F.lit("b."), F.col("batch"))
    data = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data")
    return data.join(done.select(part.alias("part"), "batch"), "part").drop("part")


class ObservedWrite:
    """Metrics taken at named points of one plan while its result is written.

    ``watch`` marks a point, ``write`` runs the plan once, ``values`` and ``drop_rate`` read what
    was seen; the output is not scanned for it. Metrics are aggregates without DISTINCT. A point
    that stands below a shuffle counts a task twice if the task ran twice because its executor was
    lost; the last point, with no shuffle after it, is exact. A point whose rows were pruned as
    empty saw nothing: its metrics are None, counts 0.
    """

    def __init__(self):
        self._points: dict[str, tuple[Observation, list[str]]] = {}

    def watch(self, df: DataFrame, point: str, **metrics: Column) -> DataFrame:
        if point in self._points:
            raise ValueError(f"point {point} is watched already")
        metrics = {"n_rows": F.count(F.lit(1)), **metrics}
        self._points[point] = Observation(), list(metrics)
        return df.observe(self._points[point][0], *[c.alias(n) for n, c in metrics.items()])

    def write(self, df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
        w = df.write.mode("overwrite").format(fmt)
        (w.partitionBy(*partition_by) if partition_by else w).save(path)

    def values(self, point: str) -> dict:
        obs, names = self._points[point]
        got = obs.get
        return {n: got.get(n, 0 if n.startswith("n_") else None) for n in names}

    def drop_rate(self, before: str, after: str) -> float:
        """Share of the rows at ``before`` that are gone at ``after``; 0 for no rows."""
        n = self.values(before)["n_rows"]
        return 1 - self.values(after)["n_rows"] / n if n else 0.0

    def document(self) -> dict:
        return {point: self.values(point) for point in self._points}


def write_observed(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Write ``df`` and return its row count, observed while writing (S10): no second scan."""
    w = ObservedWrite()
    w.write(w.watch(df, "rows"), path, fmt)
    return w.values("rows")["n_rows"]


def metrics_row(report: DataFrame) -> dict:
    """Collect a one-row report as a plain dict (nested structs become dicts)."""
    rows = report.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a metrics frame must have exactly one row")
    return _plain(rows[0].asDict(recursive=True))


def _plain(v):
    if isinstance(v, dict):
        return {k: _plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def write_metrics(spark: SparkSession, report: DataFrame | Mapping, path: str) -> dict:
    """One JSON document per stage (S9), written by Spark to the folder ``path``, wherever that
    is; ``report`` is a one-row frame or a (nested) mapping."""
    doc = metrics_row(report) if isinstance(report, DataFrame) else _plain(dict(report))
    text = json.dumps(doc, sort_keys=True)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return doc


def read_metrics(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first().value)
