"""Embedding near-dedup (operator 1): exact metric range join.

Cosine at least ``least`` is distance at most ``r = sqrt(2 - 2 least)`` between
unit vectors. Pivots, taken apart from each other in a bounded sample, deal the
vectors of each label into cells by nearest pivot. If ``x`` is at home in cell i
and some ``y`` within ``r`` is at home in cell j, the triangle inequality gives
``d(x, j) - d(x, i) <= 2 r``: ``x`` is replicated into exactly the cells that pass
this, so every vector meets all its partners in its home cell, and cells are
joined independently. A cell too large for one task is dealt into slices, and
each pair of slices (homes, members) is a task of its own.

A task multiplies blocks of vectors, counts the partners of its homes and sends
a star over each of its local components instead of pairs: what it sends is
linear in its vectors, however dense the links are.

Defined results: vectors that are NULL, empty or zero or hold NULL or non-finite
components, and rows without label or id, link with nothing (the id, if any, is
their component). Vectors of different length do not link. Rows with equal id,
label and vector are one vector; rows that share an id but not the rest never
link directly to each other. Columns other than the three are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm.common import components, materialize, table

LEAST = 0.98
CELL = 2048  # vectors of the largest label that share a pivot, about
PIVOTS, SAMPLE = 64, 2048  # most pivots, most vectors they are chosen from
SLICE = 8192  # homes or members of a task, about
BLOCK = 512  # homes multiplied at a time
MARGIN = 1e-9  # for the rounding of distances
KEY = ["vec_id", "label", "vh"]


def usable(v: Column) -> Column:
    """Not NULL, not zero, and all components finite."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def units(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square over- or underflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` vectors of the sample, each the farthest from those before it."""
    picked = [0]
    near = 2 - 2 * sample @ sample[0]
    while len(picked) < min(n, len(sample)):
        picked.append(int(near.argmax()))
        near = np.minimum(near, 2 - 2 * sample @ sample[picked[-1]])
    return sample[picked]


def assigned(valid: DataFrame, pivots: np.ndarray, radius: float) -> DataFrame:
    """A row for each cell a vector belongs to, ``home`` where it is nearest."""
    size = pivots.shape[1] if len(pivots) else -1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, part in b.groupby(b["v"].map(len)):
                x = units(part["v"])
                if dim == size:
                    d = np.sqrt(np.maximum(0, 2 - 2 * x @ pivots.T))
                    home = d.argmin(axis=1)
                    row, cell = np.nonzero(d <= d.min(axis=1)[:, None] + 2 * radius + MARGIN)
                else:  # vectors of another length than the pivots share one cell
                    home = np.zeros(len(x), np.int64)
                    row, cell = np.arange(len(x)), home
                out = part[KEY].iloc[row].reset_index(drop=True)
                out["dim"], out["cell"], out["home"] = np.int32(dim), cell.astype(np.int32), home[row] == cell
                out["u"] = [x[i].tobytes() for i in row]
                yield out

    return valid.mapInPandas(run, "vec_id long, label int, vh long, dim int, cell int, home boolean, u binary")


def join_task(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """One task: partner counts of its homes, and a star over each local component."""
    x = np.frombuffer(b"".join(rows["u"]), np.float64).reshape(len(rows), -1)
    ids = rows["vec_id"].to_numpy()
    homes, members = np.flatnonzero(rows["as_home"]), np.flatnonzero(rows["as_member"])
    n = np.zeros(len(rows), np.int64)
    part = np.arange(len(rows))
    for at in range(0, len(homes), BLOCK):
        own = homes[at:at + BLOCK]
        near = (x[own] @ x[members].T >= least) & (ids[own][:, None] != ids[members])
        n[own] = near.sum(axis=1)
        for i in np.flatnonzero(n[own]):
            roots = np.unique(part[np.append(members[near[i]], own[i])])
            if len(roots) > 1:
                part[np.isin(part, roots)] = roots[0]
    root = np.full(len(rows), np.iinfo(np.int64).max)
    np.minimum.at(root, part, ids)
    out = rows[[*KEY, "as_home"]].assign(n_links=n, root=root[part])
    return out[out["as_home"] | (out["root"] != out["vec_id"])]


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``."""
    rows = vectors.select("vec_id", "label", F.xxhash64("embedding").alias("vh"), F.col("embedding").alias("v"))
    valid = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))).select(
        "vec_id", "label", "vh", F.col("v").cast("array<double>").alias("v")).dropDuplicates(KEY)
    valid = materialize(valid, "vectors")
    largest = valid.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    sample = valid.orderBy(F.xxhash64(*KEY), *KEY).limit(SAMPLE).select("v").toPandas()["v"]
    if len(sample):
        size = sample.map(len).mode().max()
        pivots = choose_pivots(units(sample[sample.map(len) == size]), min(PIVOTS, -(-largest // CELL)))
    else:
        pivots = np.zeros((0, 0))
    cell = ["label", "dim", "cell"]
    rows_in = materialize(assigned(valid, pivots, (2 - 2 * least) ** 0.5), "cells")
    slices = lambda n: F.ceil(n / SLICE).cast("int")
    sizes = materialize(rows_in.groupBy(*cell).agg(
        slices(F.sum(F.col("home").cast("long"))).alias("hs"), slices(F.count(F.lit(1))).alias("ms")).filter("hs > 0"), "cell-sizes")
    mine = lambda n: F.pmod(F.xxhash64("vec_id", "vh"), n).cast("int")
    dealt = rows_in.join(sizes, cell).withColumns({"h": mine(F.col("hs")), "m": mine(F.col("ms"))})
    # as a member it meets every slice of homes, as a home every slice of members
    tasks = F.array_union(
        F.transform(F.sequence(F.lit(0), F.col("hs") - 1), lambda a: F.struct(a.alias("a"), F.col("m").alias("b"))),
        F.when(F.col("home"), F.transform(F.sequence(F.lit(0), F.col("ms") - 1),
                                          lambda b: F.struct(F.col("h").alias("a"), b.alias("b")))).otherwise(F.array()))
    dealt = dealt.withColumn("task", F.explode(tasks)).select(
        *cell, "task.a", "task.b", "vec_id", "vh", "u", (F.col("home") & (F.col("h") == F.col("task.a"))).alias("as_home"),
        (F.col("m") == F.col("task.b")).alias("as_member"))
    got = dealt.groupBy(*cell, "a", "b").applyInPandas(
        lambda rows: join_task(rows, least), "vec_id long, label int, vh long, as_home boolean, n_links long, root long")
    got = materialize(got, "links")
    counts = materialize(got.filter("as_home").groupBy(*KEY).agg(F.sum("n_links").alias("n_links")), "counts")
    of = components(got.select(F.col("vec_id").alias("u"), F.col("root").alias("v")))
    of = of.select(F.col("node").alias("vec_id"), "root")
    return (rows.drop("v").join(counts, KEY, "left").join(of, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(c.low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN (SELECT x, count(*) AS n_links FROM link GROUP BY x) n ON n.x = e.vec_id
LEFT JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) c ON c.x = e.vec_id
"""
