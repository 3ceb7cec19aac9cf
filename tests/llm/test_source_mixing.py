from __future__ import annotations

from pyspark.sql import functions as F

from etafeat.llm import source_mixing as op


def water(sizes: dict, weights=(3, 1, 2), share=1.5, most=2) -> dict:
    """Targets by giving out the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    capped, budget = set(), share * sum(sizes.values())
    while True:
        free = budget - sum(most * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        t = {s: most * sizes[s] if s in capped else free * w[s] / sum(w[x] for x in open_) for s in names}
        over = [s for s in open_ if t[s] > most * sizes[s] + 1e-9]
        if not over:
            return t
        capped.update(over)


def check(rows: list[tuple], docs) -> None:
    got = op.mix(docs).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    want = water(sizes)
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    largest = {s: max(r.size for r in got if r.source == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    again = op.mix(docs.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.h, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_targets_and_takes(documents):
    rows = [(i, "word " * (i % 37), f"s{i % 9}" if i % 3 else "hot") for i in range(900)]
    rows += [(2000 + i, "x y z", None) for i in range(20)] + [(3000, None, "é"), (3001, "", "é"), (3002, "a b \t c\n", "Z")]
    check(rows, documents(rows))


def test_one_source_ties_and_repeated_rows(documents):
    rows = [(i, "one two three", "only") for i in range(50)]
    check(rows, documents(rows))
    got = op.mix(documents([(1, "one two", "a")] * 5 + [(2, "three four five", "b")] * 3)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == [(1, 4)] * 5 + [(2, 3)] * 3  # targets 20 and 8.5


def test_no_rows_no_words(documents):
    assert op.mix(documents([])).collect() == []
    assert [r.taken for r in op.mix(documents([(1, None, "a"), (2, "", None)])).collect()] == [0, 0]


def test_refinement_reaches_one_hash(documents, monkeypatch):
    """With two bits a pass the boundary is refined often; the result is the same."""
    docs = documents([(i, "word " * (1 + i % 11), "ab"[i % 2]) for i in range(300)])
    want = sorted(map(tuple, op.mix(docs).collect()))
    monkeypatch.setattr(op, "STEP", 5)
    assert sorted(map(tuple, op.mix(docs).collect())) == want


def test_stage(documents, spark):
    docs = documents([(i, "word " * (1 + i % 5), "ab"[i % 2]) for i in range(100)] + [(None, "no id", None)])
    docs = docs.withColumn("taken", F.lit("mine")).withColumn("h", F.lit("h")).withColumn("size", F.lit(9))
    got = op.mixed_documents(spark, docs, "")
    assert set(got.columns) == {*docs.columns, "copies"}
    taken = {(r.doc_id, r.taken) for r in op.mix(docs).collect() if r.taken}
    assert {(r.doc_id, r.taken) for r in got.collect()} == taken
    assert all(r.taken == r.copies * len(r.text.split()) for r in got.collect())


def test_equal_rows_at_the_boundary_are_split(documents, spark):
    """One repeated row holds most of a source: the target is met to half a row, in the stage too."""
    rows = [(1, "w " * 50, "a")] * 60 + [(100 + i, "w " * 50, "a") for i in range(40)] + [(1000 + i, "x " * 50, "b") for i in range(100)]
    docs = documents(rows)
    check(rows, docs)
    taken = {r.source: r.t for r in op.mix(docs).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    stage = {r.source: r.t for r in op.mixed_documents(spark, docs, "").groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert taken == stage == {"a": 10000, "b": 5000}
    rows = [(1, "w " * 7, "a")] * 333 + [(2, "w " * 7, "b")] * 100 + [(3, "w " * 7, "c")] * 50
    check(rows, documents(rows).repartition(5))


def test_stage_keeps_nested_and_clashing_columns(documents, spark):
    docs = documents([(i, "word " * (1 + i % 5), "ab"[i % 2]) for i in range(30)] + [(7, "word " * 3, "b")] * 4)
    docs = docs.withColumn("row", F.lit("mine")).withColumn("number", F.col("doc_id") * 2).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    got = op.mixed_documents(spark, docs, "")
    assert got.columns == [*docs.columns, "copies", "taken"]
    assert all(r.row == "mine" and r.number == r.doc_id * 2 and r.m == {"k": r.doc_id} and r.taken == r.copies * len(r.text.split()) for r in got.collect())
