from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from etafeat.llm import embedding_dedup as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows: list[tuple]) -> list[tuple]:
    """(vec_id, n_links, component_id, kept) by all pairs; ids are unique."""
    def ok(v, label):
        return label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = {i: np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) for i, v, l in rows if i is not None and ok(v, l)}
    label = {i: l for i, _, l in rows}
    near = {i: [j for j, y in unit.items() if j != i and label[i] == label[j] and len(x) == len(y) and x @ y >= op.LEAST]
            for i, x in unit.items()}
    out = []
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in near.get(todo.pop(), []) if j not in seen]
            seen.update(new), todo.extend(new)
        out.append((i, len(near.get(i, [])), min(seen, key=lambda x: (x is None, x)), i is not None and i == min(seen)))
    return sorted(out, key=str)


def cloud(n: int, dims: int = 16) -> list[tuple]:
    rng = np.random.default_rng(4)
    rows, base = [], rng.normal(size=(n // 8, dims))
    for i in range(n):
        v = base[rng.integers(len(base))] + rng.normal(size=dims) * rng.choice([0, 0.03, 0.12, 0.2, 0.5])
        rows.append((i * 3, (v * 10.0 ** rng.integers(-3, 4)).astype(np.float32).tolist(), int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("cell, size", [(2048, 8192), (40, 8192), (40, 16)])
def test_against_brute_force(spark, monkeypatch, cell, size):
    """Also with many pivots, and with cells dealt into slices."""
    monkeypatch.setattr(op, "CELL", cell)
    monkeypatch.setattr(op, "SLICE", size)
    rows = cloud(600)
    rows += [(10_000, None, 1), (10_001, [], 1), (10_002, [0.0] * 16, 1), (10_003, [1.0, None] * 8, 1), (10_004, [float("nan")] * 16, 1),
             (10_005, [float("inf")] * 16, 1), (10_006, rows[0][1], None), (10_007, [1.0, 2.0], 1), (10_008, [1.0, 2.0], 1), (None, rows[0][1], 1)]
    random.Random(1).shuffle(rows)
    got = op.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    assert sum(n for _, n, _, _ in want) > 300
    assert sorted(map(tuple, got), key=str) == want


def test_one_dense_group(spark):
    """All rows of a label are near copies: counts are whole, what tasks send is linear."""
    rng = np.random.default_rng(9)
    v = rng.normal(size=8)
    rows = [(i, (v + rng.normal(size=8) * 1e-3).tolist(), 1) for i in range(700)]
    got = op.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(699, 0)} and sum(r.kept for r in got) == 1


def test_no_rows_repeated_rows_and_clashing_columns(spark):
    assert op.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, [1.0, 0.0], 5), (1, [1.0, 0.0], 5), (2, [1.0, 0.01], 5), (3, [0.0, 1.0], 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("vh", "v", "cell", "home", "u", "root", "n_links", "kept"):
        df = df.withColumn(c, F.lit("mine"))
    got = sorted(map(tuple, op.near_duplicates(df).collect()))
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
