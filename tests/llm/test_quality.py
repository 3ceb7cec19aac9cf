from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from etafeat.llm import ngrams, quality as op

LABELS = "doc_id long, quality int, toxic int"
BAD = ["blorg", "snarfle", "quonky"]


def corpus(n: int, seed: int = 1) -> list[tuple]:
    """(id, text, quality, toxic): clean, shouting and toxic texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioubcdfglmnrst") for _ in range(rng.randint(2, 11))) for _ in range(1500)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(30, 200))]
        kind = rng.choice(("clean", "clean", "clean", "junk", "toxic"))
        if kind == "junk":
            words = [w.upper() + "!!" for w in words]
        if kind == "toxic":
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(BAD) + rng.choice(("", "ish", "esque"))
        rows.append((i, " ".join(words), int(kind != "junk"), int(kind == "toxic")))
    return rows


def test_held_out_documents(documents, spark):
    rows = corpus(1200)
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows if i < 700] + [(5, None, None), (None, 0, 1), (7, 1, None)], LABELS)
    scored, _, least = op.resample(documents([r[:2] for r in rows]), labels)
    kept = {r.doc_id for r in scored.filter(F.col("key") >= least).collect()}
    new = [r for r in rows if r[0] >= 700]
    clean = [r[0] for r in new if r[2] and not r[3]]
    assert len(kept & set(clean)) >= 0.99 * len(clean)
    assert len(kept & {r[0] for r in new if not r[2] or r[3]}) <= 0.02 * (len(new) - len(clean))


def test_scores_against_plain_sums():
    rng = np.random.default_rng(0)
    texts = [t.encode() for _, t, _, _ in corpus(30)] + [b"", b" \n", b"one", "É été ÉTÉ, 12%!".encode(), b"x " * 100_000]
    every = np.concatenate([h for _, h in ngrams.features(texts)])
    known = np.unique(rng.choice(every, 200))
    models = [(known, rng.normal(size=len(known))), (known[::3], rng.normal(size=len(known[::3])))]
    got = op.scores(texts, models)
    for i, t in enumerate(texts):
        h = np.concatenate([np.empty(0, np.uint64), *[x for _, x in ngrams.features([t])]])
        want = min(sum(dict(zip(k.tolist(), w)).get(x, 0.0) for x in h.tolist()) for k, w in models)
        assert abs(got[i] - want) < 1e-6 * max(1, abs(want))


def test_kth_largest(spark):
    keys = [random.Random(i).getrandbits(50) for i in range(500)] + [7] * 40
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    for k in (1, 2, 250, 500, 520, 540):
        assert op.kth_largest(df, k) == sorted(keys, reverse=True)[k - 1]


def test_edge_rows(documents, spark):
    rows = [(1, None), (2, ""), (None, "text"), (3, "word " * 50_000), (3, "word " * 50_000)]
    none = spark.createDataFrame([], LABELS)
    scored, models, least = op.resample(documents(rows), none)
    assert models == [] and scored.filter(F.col("key") >= least).count() == len(rows)
    scored, _, least = op.resample(documents([]), none)
    assert scored.count() == 0
    only_bad = spark.createDataFrame([(3, 0, 0)], LABELS)
    assert op.resample(documents(rows), only_bad)[1] == []


def test_near_copies_count_once(documents, spark):
    rows = corpus(40) + [(100 + i, "extraordinarily complicated constellation of identical vocabulary " * 5 + f"n{i}", 0, 0) for i in range(50)]
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows], LABELS)
    got = {r.doc_id for r in op.training_rows(documents([r[:2] for r in rows]), labels).collect()}
    assert len([i for i in got if i >= 100]) == 1 and len(got) > 30


def test_stage_keeps_what_the_query_keeps(documents, spark, folder):
    rows = corpus(300, seed=4)
    docs = documents([r[:2] for r in rows]).withColumn("score", F.lit("mine")).withColumn("key", F.lit("k")).withColumn("kind", F.lit(1))
    d = folder(documents=docs, labels=spark.createDataFrame([(i, q, t) for i, _, q, t in rows], LABELS))
    want = sorted(r.doc_id for r in op.op3_quality_classifier(spark, d).collect())
    got = op.keep_good(spark, docs, d)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == want
    assert 100 < len(want) < 250
