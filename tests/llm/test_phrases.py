from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from etafeat.llm import phrases as op

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, longest=4, top=2000):
    """Rows (lang, rank, phrase, a, l, r, n, score) of rows (text, lang), from all n-grams in memory."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            ws = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(ws)
            for i in range(len(ws)):
                for k in range(1, longest + 1):
                    if i + k <= len(ws):
                        f[lang][ws[i:i + k]] += 1
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) and 100 * b >= 80 * a
                   for q, b in cand.items()):
                continue
            score, k = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def texts(seed: int, docs: int = 120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["New", "York", "é", "日本", "-", " x"]
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; ", "\r\n", "\x0b", "!?"]
    return [("".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None]))
            for _ in range(docs)]


def mined(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    return sorted(tuple(r) for r in op.collocations(docs, **kw).collect())


@pytest.mark.parametrize("seed,min_count", [(1, 3), (2, 5)])
def test_against_all_ngrams(spark, seed, min_count):
    rows = texts(seed)
    got = mined(spark, rows, min_count=min_count)
    assert got and got == brute(rows, min_count)


def test_repeats_overlaps_and_hot_text(spark):
    rows = [("a a a a a. b a a", "en")] * 40 + [("The Hot  Line of text, the hot line", None)] * 60 + [
        (None, None), ("", "en"), (" . , ", "en"), ("only once here", "de"), ("x" * 10 ** 6 + " y", "en"),
        ("long text with words " * 20_000, "en")]
    got = mined(spark, rows)
    assert got == brute(rows, 30)
    assert not [r for r in got if r[0] == "de"]


def test_limits_and_buckets_do_not_matter(spark):
    rows = texts(3)
    docs = spark.createDataFrame(rows, "text string, lang string")
    counts = []
    for size in (1 << 25, 500):  # one bucket a core, and many
        totals, levels = op.frequent_phrases(docs, 4, 4, size)
        counts.append([sorted(r["f"] for r in x.collect()) for x in levels] + [sorted(map(tuple, totals.collect()))])
    assert counts[0] == counts[1]
    assert mined(spark, rows, min_count=4, top=5) == brute(rows, 4, top=5)


def test_cut_is_exact_beyond_64_bits(spark):
    a, l, r = 4 * 10 ** 18, 7 * 10 ** 18 + 1, 9 * 10 ** 18
    df = spark.createDataFrame([(a, [l, a], [r, a])], "f long, heads array<long>, tails array<long>")
    assert df.select(F.expr(op._cut(2)).alias("c")).first()["c"]["score"] == 2000000 * a // (l + r)


def test_relations_are_gone_after_use(spark, documents):
    before = spark.sql("SHOW DATABASES").count()
    op.collocations(documents([(1, "a b. a b")]), min_count=1).collect()
    assert spark.sql("SHOW DATABASES").count() == before


def test_empty_table_and_clashing_columns(spark, documents):
    docs = documents([(i, "one two three") for i in range(40)])
    docs = docs.withColumns({c: F.lit("own") for c in ("row", "at", "bucket", "slot", "word", "id")})
    assert sorted(tuple(r) for r in op.collocations(docs).collect()) == brute([("one two three", "en")] * 40, 30)
    assert op.collocations(docs.filter("false")).count() == 0


def test_a_bucket_sends_a_row_for_each_part():
    """Not one for each group: the groups and their counts are packed."""
    words = [f"w{i}" for i in range(300)]
    rows = pa.table({"bucket": [7, 7], "lang": ["en", None], "text": [" ".join(words * 2), "w1 w2"]})
    rows = rows.set_column(1, "lang", pa.array(["en", "de"]))
    got = op._count_words(4)(rows)
    assert got.num_rows <= 4 * 2 and set(got["bucket"].to_pylist()) == {7}
    c, size = op._unpacked(got, "c")
    assert sorted(c.tolist()) == [1] * 2 + [2] * 300 and len(op._split(got["words"])) == size.sum()
    pairs = op._count_pairs(4)(pa.table({"bucket": [7], "at": [list(range(300))], "ids": [[i % 100 + (1 << 40) for i in range(300)]]}))
    assert pairs.num_rows <= 4 and sorted(op._unpacked(pairs, "c")[0].tolist()) == [2] + [3] * 99


def test_packed_numbers_come_back():
    values = [[0, 1, 255, 1 << 33, (1 << 63) - 1], [], [5]]
    got, size = op._unpacked(pa.table({"v": [op._packed(np.array(v, np.int64)) for v in values]}), "v")
    assert got.tolist() == sum(values, []) and size.tolist() == [5, 0, 1]
