from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from etafeat.llm import line_dedup as op

SPACES = " \t\n\x0b\x0c\r"


def brute(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, sha) of rows (doc_id, text)."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))
    order = lambda d: (d is None, d)
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(order(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == order(d)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def result(docs):
    got = op.apply_bitmaps(docs, op.keep_bitmaps(docs))
    return sorted(map(tuple, got.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()), key=str)


def test_against_brute_force(documents):
    random.seed(5)
    pool = [f"  Shared LINE number {i} \t" for i in range(12)] + ["short", "", "É" * 10, "é" * 10, "ÉCOLE école 1", "École école 1"]
    rows = [(i, "\n".join(random.choice(pool + [f"own line of {i} here"]) for _ in range(random.randint(1, 150)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, pool[0] + "\nown text of nobody"), (None, pool[0]), (7, pool[1] + "\n" + pool[1])]
    random.shuffle(rows)
    assert result(documents(rows)) == brute(rows)


def test_a_line_in_every_row_and_long_texts(documents):
    rows = [(i, f"the same line in every document\nline {i} of its own text") for i in range(400)]
    rows.append((1000, "\n".join(f"line {i % 7} repeated often" for i in range(20_000))))
    rows.append((1001, "\n".join(f"line {i % 7} repeated often" for i in range(20_000))))
    assert result(documents(rows)) == brute(rows)


def test_no_rows_and_clashing_columns(documents, spark):
    assert result(documents([])) == []
    docs = documents([(1, "one shared line here"), (2, "one shared line here\nx")])
    for c in ("doc", "row", "keep", "b", "h1", "pos", "n_lines", "kept_text"):
        docs = docs.withColumn(c, F.lit("mine"))
    got = op.drop_repeated_lines(spark, docs, "")
    assert got.columns == docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[2].text == "x" and rows[2].n_chars == 1 and rows[2].doc == "mine" and rows[1].text == "one shared line here"


def test_first_occurrences_are_streamed_over_sorted_partitions(documents, spark):
    lines = op.line_keys(documents([(i, "a line that is shared\nown line %d here" % i) for i in range(50)]))
    was = spark.conf.get(op.SORTED)
    spark.conf.set(op.SORTED, "true")
    try:
        plan = op.first_lines(lines)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(op.SORTED, was)
    assert "SortAggregate" in next(x for x in plan.splitlines() if "partial_min" in x), plan


def test_long_documents_with_sparse_repeats(documents):
    """Words without a dropped line lie between, before and after words with one."""
    own = [f"line {i} of the long text" for i in range(3000)]
    rows = [(1, "\n".join(own[i] for i in (64, 65, 1000, 2047))), (2, "\n".join(own)), (3, "\n".join(own[:130] + ["end of document three"]))]
    assert result(documents(rows)) == brute(rows)


def test_lines_of_one_key_at_100000_lines_are_linear(documents):
    rows = [(1, "the line of both documents"), (2, "\n".join(["the line of both documents", "x"] * 100_000))]
    assert result(documents(rows)) == brute(rows)
