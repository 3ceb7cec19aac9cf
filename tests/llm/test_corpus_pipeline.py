"""The pipeline and the registered queries on the smallest tables."""

from __future__ import annotations

import pytest

import corpus_pipeline
from check_oracle import compare, duck
from etafeat.llm import queries
from etafeat.llm.common import components, materialize, table


def test_stages(spark, sf):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "mixing"]
    docs = table(spark, sf, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), name)
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left and left <= ids
        ids = left
        assert docs.columns == columns if name != "mixing" else set(columns) <= set(docs.columns)


def test_run_repeats(spark, sf):
    first = sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()))
    assert first and first == sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_with_sql(spark, sf, name):
    got = queries.QUERIES[name](spark, sf).toPandas()
    res = compare(got, duck(sf).execute(queries.SQL[name]).fetchdf())
    assert res.get("exact"), res


def test_components(spark):
    """A long path, a hub, and cycles."""
    edges = [(i, i + 1) for i in range(100, 400)] + [(1000, i) for i in range(1001, 1600)] + [(5, 7), (7, 9), (9, 5), (8, 8)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 100 for i in range(100, 401)} | {i: 1000 for i in range(1000, 1600)} | {5: 5, 7: 5, 9: 5}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
