"""Quality classifier (operator 3): importance resampling.

Two kinds of labelled text are not wanted, text of low quality and toxic text.
For each, hashed n-gram counts give a generative model of it beside that of the
target text (good quality, not toxic). Unwanted text is mostly ordinary text, so
its model is a mixture: a word comes from the target model, or at rate ``RATE``
from the unwanted one. A document's log importance is the smaller of its two log
likelihood ratios, target over mixture. Documents are drawn by Gumbel top-k: the
``k`` largest of ``BETA`` times the log importance (at most 0) plus Gumbel noise
from a hash of the row, ``k`` the number of documents at or above ``CUT``. All
rows compete; the k-th key is found by histogram descent, without sorting.

The models are fitted on at most about ``LABELLED`` labelled rows, chosen by
hash of the id. Near copies among them (equal minimum hash of their word triples)
count once, and a feature enters the models only if its document frequencies
differ by a likelihood-ratio test over all features.

Defined results: a NULL or empty text has log importance 0 and is treated as
wanted. Of several labels of a document the worst counts; labels that say
nothing (NULL) are ignored. Without labelled target rows or without unwanted
ones everything is kept. Rows with equal id and text are kept or rejected
together. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm import ngrams
from etafeat.llm.common import materialize, table

LABELLED = 20_000
RATE = 0.01
SMOOTH = 1000.0  # pseudo-count of the pooled distribution in each model
CUT = -2.0
BETA = 8.0
TARGET, JUNK, TOXIC = 0, 1, 2
KEY_BITS, STEP = 50, 10


def labelled(labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """(doc_id, kind) of about ``bound`` labelled documents at most."""
    per = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    kind = (F.when(F.col("quality") == 0, JUNK).when(F.col("toxic") == 1, TOXIC)
            .when((F.col("quality") == 1) & (F.col("toxic") == 0), TARGET))
    per = per.select("doc_id", kind.alias("kind")).filter("kind is not null")
    n = per.count()
    return per.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int((1 << 32) * min(1.0, bound / max(1, n))))


def _with_text(docs: DataFrame, ids: DataFrame) -> DataFrame:
    # ids has about LABELLED rows at most
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(F.broadcast(ids), "doc_id")


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, kind) of the labelled documents that count: near copies once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([ngrams.sketch(t.as_py()) for t in b.column("text")], np.uint64).reshape(-1, 4).view(np.int64)
            yield pa.record_batch([b.column("doc_id"), b.column("kind"), *map(pa.array, found.T.copy())], ["doc_id", "kind", *names])

    names = [f"s{i}" for i in range(4)]

    ids = materialize(labelled(labels), "labelled")
    rows = _with_text(docs, ids).select("doc_id", "text", "kind").mapInArrow(run, "doc_id long, kind int, " + ", ".join(f"{s} long" for s in names))
    rows = materialize(rows, "sketches")
    for s in names:  # the first of each group of equal sketches
        rows = rows.join(rows.groupBy(s).agg(F.min("doc_id").alias("doc_id")), [s, "doc_id"], "left_semi")
    return materialize(rows.select("doc_id", "kind").distinct(), "training")


def feature_counts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(feature, kind, docs, uses): per feature and kind the documents it is in and its occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in ngrams.slices(batch)):
            kinds = b.column("kind").to_numpy(zero_copy_only=False)
            texts = b.column("text").to_pylist()
            for i, j in ngrams.chunks(texts):
                got = ngrams.features(texts[i:j])
                if not got:
                    continue
                doc = np.concatenate([x[0] for x in got])
                h = np.concatenate([x[1] for x in got]).view(np.int64)
                order = np.lexsort((doc, h))
                doc, h = doc[order], h[order]
                new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
                at = np.flatnonzero(new)
                uses = np.diff(np.append(at, len(h)))
                yield pa.record_batch([pa.array(h[at]), pa.array(kinds[i:j][doc[at]].astype(np.int32)),
                                       pa.array(uses.astype(np.int64))], ["feature", "kind", "uses"])

    rows = _with_text(docs, ids).select("text", "kind").mapInArrow(run, "feature long, kind int, uses long")
    return rows.groupBy("feature", "kind").agg(F.count(F.lit(1)).alias("docs"), F.sum("uses").alias("uses"))


def fit(docs: DataFrame, labels: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each unwanted kind, the hashes of its significant features (sorted) and
    the log likelihood ratio that an occurrence adds."""
    ids = training_rows(docs, labels)
    n = {r.kind: r.n for r in ids.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    per = feature_counts(docs, ids).groupBy("feature").agg(*[
        F.sum(F.when(F.col("kind") == k, F.col(c)).otherwise(0)).alias(f"{c}{k}") for k in (TARGET, JUNK, TOXIC) for c in ("docs", "uses")])
    per = materialize(per, "features")
    all_uses = per.agg(*[F.sum(f"uses{k}").alias(f"u{k}") for k in (TARGET, JUNK, TOXIC)],
                       *[F.sum((F.col("docs0") + F.col(f"docs{k}") > 0).cast("long")).alias(f"f{k}") for k in (JUNK, TOXIC)]).first()
    models = []
    for kind in (JUNK, TOXIC):
        if not n.get(TARGET) or not n.get(kind):
            continue
        a, b, na, nb = F.col("docs0"), F.col(f"docs{kind}"), n[TARGET], n[kind]
        pool = (a + b) / (na + nb)

        def ll(hits: Column, of: int, rate: Column) -> Column:
            miss = of - hits
            return (F.when(hits > 0, hits * F.log(rate)).otherwise(0.0) + F.when(miss > 0, miss * F.log(1 - rate)).otherwise(0.0))

        gain = 2 * (ll(a, na, a / na) + ll(b, nb, b / nb) - ll(a, na, pool) - ll(b, nb, pool))
        ua, ub = F.col("uses0"), F.col(f"uses{kind}")
        base = SMOOTH * (ua + ub) / (all_uses["u0"] + all_uses[f"u{kind}"])
        ratio = ((ub + base) / (all_uses[f"u{kind}"] + SMOOTH)) / ((ua + base) / (all_uses["u0"] + SMOOTH))
        # chance alone reaches 2 ln F in the best of F features
        found = per.filter(gain > 2 * math.log(max(2, all_uses[f"f{kind}"])) + 4).select(
            "feature", (-F.log(1 - RATE + RATE * ratio)).alias("weight")).toPandas()
        h = found["feature"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(h)
        models.append((h[order], found["weight"].to_numpy(np.float64)[order]))
    return models


def scores(texts: list[bytes], models: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log importance of each text."""
    out = np.zeros((max(1, len(models)), len(texts)))
    quick = [np.bincount((h & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16) > 0 for h, _ in models]
    for i, j in ngrams.chunks(texts):
        for doc, h in ngrams.features(texts[i:j]):
            low = (h & np.uint64(0xFFFF)).astype(np.int64)
            for m, (known, weight) in enumerate(models):
                hit = np.flatnonzero(quick[m][low])  # most features are in no model
                at = np.searchsorted(known, h[hit])
                at[at == len(known)] = 0
                own = known[at] == h[hit] if len(known) else np.zeros(0, bool)
                out[m, i:j] += np.bincount(doc[hit][own], weights=weight[at[own]], minlength=j - i)
    return out.min(axis=0)


def log_importance(text: Column, models: list[tuple[np.ndarray, np.ndarray]]) -> Column:
    def run(texts: pa.Array) -> pa.Array:
        parts = [scores([t or b"" for t in texts.slice(at, ngrams.ROWS).to_pylist()], models)
                 for at in range(0, len(texts), ngrams.ROWS)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return F.arrow_udf(run, "double")(text.cast("binary"))


def gumbel_key(score: Column) -> Column:
    """``BETA`` times the log importance plus noise, as a long that orders like it."""
    u = (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    key = F.greatest(BETA * F.least(score, F.lit(0.0)), F.lit(-4e5)) - F.log(-F.log(u))
    return F.least(F.floor((key + 5e5) * (1 << 29)), F.lit((1 << KEY_BITS) - 1)).cast("long")


def kth_largest(keys: DataFrame, k: int) -> int:
    """The k-th largest ``key`` (0 <= key < 2^50): each pass counts at most 1024 buckets."""
    prefix = 0
    for shift in range(KEY_BITS - STEP, -1, -STEP):
        rows = (keys.filter(F.shiftright("key", shift + STEP) == prefix)
                .groupBy(F.shiftright("key", shift).alias("at")).count().collect())
        for r in sorted(rows, key=lambda r: -r["at"]):
            if k <= r["count"]:
                prefix = r["at"]
                break
            k -= r["count"]
    return prefix


def resample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list, int]:
    """Scores of all rows (doc_id, score, key), the models, and the smallest key that is kept."""
    models = fit(docs, labels)
    scored = docs.select("doc_id", "text", log_importance(F.col("text"), models).alias("score"))
    scored = materialize(scored.select("doc_id", "score", gumbel_key(F.col("score")).alias("key")), "scores")
    k = scored.filter(F.col("score") >= CUT).count()
    return scored, models, kth_largest(scored, k) if k else 1 << KEY_BITS


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents kept, with their log importance; rejected ones have no row."""
    scored, _, least = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.filter(F.col("key") >= least).select("doc_id", F.col("score").alias("log_importance"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents the classifier keeps. They are scored again in
    place, so that no text is shuffled."""
    _, models, least = resample(docs, table(spark, sf_dir, "labels"))
    return docs.filter(gumbel_key(log_importance(F.col("text"), models)) >= least)
