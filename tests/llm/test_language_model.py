from __future__ import annotations

import random
import zlib
from collections import Counter
from math import log10

import numpy as np

from etafeat.llm import language_model as lm


def plain(rows: list[tuple]) -> dict:
    words = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    c = Counter(w for d, t in rows if not held(d) for w in words(t))
    n, v = sum(c.values()), len(c)
    return {d: (held(d), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                sum(log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t))) for d, t in rows}


def two_languages(n: int) -> list[tuple]:
    rng = random.Random(6)
    kinds = [["the", "of", "and", *[f"thor{i}ing" for i in range(80)]], ["der", "und", "ein", *[f"sch{i}heit" for i in range(80)]]]
    return [(i, " ".join(rng.choice(kinds[i % 2]) for _ in range(rng.randint(5, 150)))) for i in range(n)]


def test_base_scores_and_held_out_gain(documents):
    rows = two_languages(400) + [(1000, None), (1001, ""), (None, "the of unseen"), (1002, "word " * 60_000), (1003, "É été ÉTÉ, the")]
    got = {r.doc_id: r for r in lm.score(documents(rows)).collect()}
    want = plain(rows)
    assert got.keys() == want.keys()
    for d, (held, n, known, total, base) in want.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-9 * max(1, abs(base)) and np.isfinite(r.score) and r.score <= 0
    held = [r for r in got.values() if r.held_out and r.n_tokens > 5 and r.doc_id is not None]
    assert len(held) > 20
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.15 * sum(r.n_tokens for r in held)


def test_probabilities_sum_to_one(documents):
    """Class softmax times word shares: over all words, the unseen of each group, and the end."""
    rng = np.random.default_rng(1)
    p = np.exp(lm.log_softmax(rng.normal(size=(lm.FEATURES, lm.K)), lm.features()[:500]))
    assert np.allclose(p.sum(axis=1), 1) and not p[:, lm.BOS].any()


def test_gradient_matches_differences():
    rng = np.random.default_rng(2)
    feature = lm.features()[rng.integers(0, lm.CONTEXTS, 40)]
    counts = rng.integers(0, 5, (40, lm.K)).astype(float)
    counts[:, lm.BOS] = 0
    w = rng.normal(size=(lm.FEATURES, lm.K)) * 0.1
    def value(x):
        p = lm.log_softmax(x, feature)
        return (counts[:, 1:] * p[:, 1:]).sum()
    seen, g = lm.gradient(w, feature, counts)
    for _ in range(20):
        i, k = rng.integers(len(seen)), rng.integers(1, lm.K)
        step = np.zeros_like(w)
        step[seen[i], k] = 1e-5
        assert abs((value(w + step) - value(w - step)) / 2e-5 - g[i, k]) < 1e-4 * max(1, abs(g[i, k]))


def test_contexts_stop_at_text_starts():
    words = lm.Words([b"a"])
    at, start = lm.numbered([b"a b b", b"", b"c"], words)
    c, context = lm.classes(at, start, words, np.full(lm.ENDINGS, 20, np.int16))
    assert c.tolist() == [lm.HEADS, 20, lm.REPEAT, lm.END, lm.END, 20, lm.END]
    k = lm.K
    assert context.tolist() == [0, lm.HEADS, lm.HEADS * k + 20, (lm.HEADS * k + 20) * k + lm.REPEAT, 0, 0, 20]


def test_small_blocks_and_flushes_change_nothing(documents, monkeypatch):
    docs = documents(two_languages(120))
    want = sorted(map(tuple, lm.score(docs).collect()))
    monkeypatch.setattr(lm, "FLUSH", 50)
    monkeypatch.setattr(lm, "BLOCKS", 3)
    got = sorted(map(tuple, lm.score(docs.repartition(5)).collect()))
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5:] for x in got], [x[5:] for x in want], rtol=1e-4)


def test_several_flushes_inside_a_block(documents, monkeypatch):
    """Over 10,000 words in one block, written in parts, and words that only held-out rows have."""
    rng = random.Random(4)
    rows = [(i, " ".join([f"w{rng.randrange(14_000)}x{rng.randrange(9)}" for _ in range(40)] + [f"only{i}"])) for i in range(2_000)]
    docs = documents(rows)
    monkeypatch.setattr(lm, "BLOCKS", 1)
    whole = {r.doc_id: r for r in lm.score(docs).collect()}
    monkeypatch.setattr(lm, "FLUSH", 1_000)
    got = {r.doc_id: r for r in lm.score(docs).collect()}
    for d, (held, n, known, total, base) in plain(rows).items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-9 * max(1, abs(base))
        assert abs(r.score - whole[d].score) < 1e-4 * abs(whole[d].score)


def test_no_rows_and_nothing_to_learn_from(documents):
    assert lm.score(documents([])).collect() == []
    rows = lm.score(documents([(None, "only held out")])).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(True, 4, 0, 0, 0.0)]


def test_hot_row_is_scored_once_and_returned_whole(documents):
    rows = two_languages(60) + [(7777, "one hot row, the and of")] * 3_000 + [(None, None)] * 50
    got = [r for r in lm.score(documents(rows).repartition(7)).collect()]
    assert len(got) == len(rows)
    for d, n in ((7777, 3_000), (None, 50)):
        same = [tuple(r) for r in got if r.doc_id == d]
        assert len(same) == n and len(set(same)) == 1
    want = plain(rows)[7777]
    assert tuple(next(r for r in got if r.doc_id == 7777))[1:5] == want[:4]


def test_endings_as_written_one_by_one():
    import pyarrow as pa
    import xxhash
    words = ["a", "été", "don't", "word,", "...", "x)!", "日本語。", "end.", "ing"]

    def one(w: bytes) -> int:
        core = w.rstrip(lm.PUNCTUATION.encode())
        return xxhash.xxh32_intdigest(core[-3:] + w[-1:] if core != w else core[-3:]) % lm.ENDINGS

    assert lm.endings(pa.array(words, pa.string())).tolist() == [one(w.encode()) for w in words]


def test_words_of_one_class_have_histories_of_their_own(documents):
    """Equal endings, so one class; only the words themselves say which head follows."""
    rng = random.Random(8)
    kinds = [f"{c}{d}ling" for c in "bcdfghjklm" for d in "aeiou"]
    after = {w: "the" if i % 2 else "of" for i, w in enumerate(kinds)}
    some = [[w for w in rng.choices(kinds, [1 + 9 * (i < 20) for i in range(50)], k=30)] for _ in range(300)]
    rows = [(i, " ".join(f"{w} {after[w]}" for w in ws)) for i, ws in enumerate(some)]
    rare = kinds[40:]
    right = " ".join(f"{w} {after[w]}" for w in rare)
    wrong = " ".join(f"{w} {'of' if after[w] == 'the' else 'the'}" for w in rare)
    got = {r.base_score: r.score for r in lm.score(documents(rows + [(None, right)])).collect() if r.doc_id is None}
    other = [r.score for r in lm.score(documents(rows + [(None, wrong)])).collect() if r.doc_id is None]
    assert list(got.values())[0] - other[0] > 1.0


def test_word_features_stop_at_text_starts():
    words = lm.Words()
    at, start = lm.numbered([b"a b c d", b"", b"c d"], words)
    f = lm.word_features(at, start, words)
    assert f.shape == (lm.HISTORIES, len(at))
    assert (f[:, 0] == f[:, 5]).all() and (f[:, 0] == f[:, 6]).all()  # nothing before any of them
    assert f[0, 3] == f[0, 7] and f[1, 3] != f[1, 7]  # c before both d, b before only one


def test_a_block_has_a_word_once(spark, monkeypatch):
    """However many runs it is numbered in, with hashes of words made in several stretches."""
    monkeypatch.setattr(lm, "FLUSH", 200)
    rows = [(i // 100, i % 3 == 0, f"the word{i % 7} X{i} ") for i in range(300)] + [(3, False, "")]
    df = spark.createDataFrame(rows, "block int, held_out boolean, text string").repartition("block").sortWithinPartitions("block")
    got = [(r.block, bytes(r.word).decode(), r.n) for r in lm.word_counts(df).collect() if r.word is not None]
    want = Counter({(b, w): 0 for b, _, t in rows for w in t.lower().split()})
    want.update((b, w) for b, held, t in rows if not held for w in t.lower().split())
    assert sorted(got) == sorted((b, w, n) for (b, w), n in want.items())
    words = lm.Words()
    lm.numbered([b"a bb ccc " * 3, b"dd"], words)
    whole = words.hashed().tolist()
    monkeypatch.setattr(lm.ngrams, "CHUNK", 2)
    assert words.hashed().tolist() == whole
