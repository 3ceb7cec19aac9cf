from __future__ import annotations

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from etafeat.llm import packing as op
from etafeat.llm.common import materialize

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return op.Encoder(JSON, RANKS)


def plain_ids(encoder, text: str) -> list[int]:
    return encoder.slow.encode(text, add_special_tokens=False).ids


def naive_best_fit(lengths: list[int], capacity: int, limit: int) -> list[tuple[int, int]]:
    """The same packing by looking at every open bin."""
    made, bins, out = 0, [], []  # bins: [free, number] in the order in which they came to that free space
    for length in lengths:
        fit = [b for b in bins if b[0] >= length]
        if fit:
            least = min(b[0] for b in fit)
            chosen = [b for b in fit if b[0] == least][-1]
            bins.remove(chosen)
        else:
            chosen = [capacity, made]
            made += 1
        out.append((chosen[1], capacity - chosen[0]))
        if chosen[0] > length:
            bins.append([chosen[0] - length, chosen[1]])
            if len(bins) > limit:
                full = min(b[0] for b in bins)
                bins.remove([b for b in bins if b[0] == full][-1])
    return out


def test_merge_table_equals_ranks():
    """Each merge is what its token's bytes come to under all earlier merges, so that merging by the
    merge table and by ranks give the same ids (between characters that both split alike)."""
    model = json.load(open(JSON, encoding="utf-8"))["model"]
    vocab = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    rank = {a + b: i for i, (a, b) in enumerate(merges)}
    assert len(rank) == len(merges) and all(vocab[a + b] == 256 + i for i, (a, b) in enumerate(merges))
    for i, pair in enumerate(merges):
        parts = list("".join(pair))
        while len(parts) > 2:
            best, at = min((rank.get(parts[k] + parts[k + 1], 1 << 30), k) for k in range(len(parts) - 1))
            if best >= i:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        assert tuple(parts) == pair, (i, pair, parts)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x2FF) | st.sampled_from(" \n\t'<|>é5"), max_size=60), st.integers(1, 20))
def test_fast_ids_and_stretches(encoder, text, length):
    assert encoder.ids(text).tolist() == plain_ids(encoder, text)
    assert "".join(encoder.stretches(text, length)) == text
    assert [i for s in encoder.stretches(text, length) for i in encoder.ids(s).tolist()] == plain_ids(encoder, text)


def test_ids_of_the_given_texts(spark, sf, encoder):
    for (text,) in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(150).collect():
        assert encoder.ids(text).tolist() == plain_ids(encoder, text)
    for text in ("日本語 テキスト", "a١ b  c", "<|endoftext|> x", "y" * 3000):
        assert encoder.ids(text).tolist() == plain_ids(encoder, text)


@pytest.mark.parametrize("limit", [1, 3, 20, 1000])
def test_bins_against_naive_best_fit(limit):
    rng = random.Random(limit)
    lengths = [rng.randint(1, 64) for _ in range(600)]
    bins = op.OpenBins(64, limit)
    assert [bins.place(n) for n in lengths] == naive_best_fit(lengths, 64, limit)


def check_packed(rows, capacity=1024):
    """No overlap, no gap, no overflow."""
    at: dict[int, list] = {}
    for r in rows:
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in at.values():
        used = 0
        for offset, length in sorted(parts):
            assert offset == used
            used += length
        assert used <= capacity
    return len(at)


def test_whole_table(spark, sf, encoder):
    got = op.op11_best_fit_packing(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = []
    for doc, text in texts.items():
        ids = np.array(plain_ids(encoder, text or "") + [2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        for number, stop in enumerate(range(first, len(ids) + 1, 1024)):
            start = max(stop - 1024, 0)
            want.append((doc, number, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    assert check_packed(got) <= -(-sum(w[3] for w in want) // 1024) + 2


def test_sequences_hold_the_ids(spark, documents, encoder):
    rows = [(i, f"word{i} " * (i * 7 % 400)) for i in range(60)]
    pieces = materialize(op.token_pieces(documents(rows), JSON, RANKS), "t")
    packed = op.pack(pieces, bucket=16)  # several buckets
    check_packed(packed.collect())
    for s in op.sequences(packed).collect():
        assert len(s["ids"]) == s["length"] <= 1024
        assert s["ids"].count(2) >= 1
    total = sum(len(plain_ids(encoder, t)) + 1 for _, t in rows)
    assert op.sequences(packed).agg(F.sum("length")).first()[0] == total


def test_odd_rows(spark, documents, folder):
    docs = documents([(None, None), (1, None), (2, ""), (3, "x"), (3, "x"), (3, "y")] + [(9, "same text")] * 300 + [
        (10, "long " * 300_000)])
    docs = docs.withColumns({"piece": F.lit("own"), "m": F.create_map(F.lit(1), F.lit(2))})
    got = op.op11_best_fit_packing(spark, folder(documents=docs)).collect()
    check_packed(got)
    count = lambda d: sum(r["doc_id"] == d for r in got)
    assert (count(None), count(1), count(2), count(3), count(9)) == (1, 1, 1, 3, 300)
    assert {r["length"] for r in got if r["doc_id"] in (None, 1, 2)} == {1}
    long = sorted((r["start"], r["length"]) for r in got if r["doc_id"] == 10)
    assert sum(n for _, n in long) == 300_002 and all(n == 1024 for _, n in long[1:])


def test_empty_table(spark, documents, folder):
    assert op.op11_best_fit_packing(spark, folder(documents=documents([(1, "x")]).filter("false"))).count() == 0
