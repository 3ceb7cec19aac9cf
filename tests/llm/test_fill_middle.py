from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from etafeat.llm import fill_middle as op

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def brute(doc_id, text):
    """(doc_id, n, form, prefix_chars, middle_chars, output, sha of output, sha of text) by string functions."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.integers(-5, 10 ** 12) | st.none(), st.text(st.sampled_from("abZ é日\n<>PSM") | st.characters(exclude_categories=["Cs"])))
def test_pieces_of_any_text(doc_id, text):
    facts, pieces = op.output_pieces(doc_id, text.encode())
    want = brute(doc_id, text)
    assert facts == want[1:5]
    assert b"".join(pieces).decode() == want[5]


def test_units_across_blocks_and_pieces(monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 5)
    monkeypatch.setattr(op, "UNITS", 3)
    monkeypatch.setattr(op, "CHARS", 4)
    for doc in range(200):
        text = ("abcdefgh ijé, 日k\n" * (doc % 7))[doc % 5:]
        facts, pieces = op.output_pieces(doc, text.encode())
        pieces = list(pieces)
        assert (facts, b"".join(pieces).decode()) == (brute(doc, text)[1:5], brute(doc, text)[5])
        assert all(0 < len(x) <= 4 for x in pieces)


ROWS = ([(i, f"Some text {i}, and  more of it;\nline é日 " * (i % 9)) for i in range(300)]
        + [(None, None), (None, "a b"), (500, None), (501, ""), (502, "x <M> y"), (503, "<P>"), (504, "<S>" * 9)]
        + [(505, "ab cd ef")] * 3 + [(505, "another text, same id")] + [(506, "hot row " * 40)] * 400
        + [(507, "q" * 700_000), (508, "a1 é" * 400_000)])


def test_digests_against_strings(spark, documents, monkeypatch):
    docs = documents(ROWS).repartition(5).withColumns(
        {"n": F.lit("own"), "key": F.lit(1), "m": F.create_map(F.lit(1), F.lit(2))})
    got = sorted((tuple(r) for r in op.digests(docs).collect()), key=repr)
    want = sorted((b[:5] + (sha(b[5]), sha(t or "")) for (d, t), b in ((r, brute(*r)) for r in ROWS)), key=repr)
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_output_texts(spark, documents):
    got = sorted((tuple(r) for r in op.transformed(documents(ROWS[:340])).collect()), key=repr)
    assert got == sorted((brute(*r) for r in ROWS[:340]), key=repr)


def test_one_exchange(spark, documents):
    plan = op.digests(documents(ROWS[:5]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_empty_table(spark, documents):
    assert op.digests(documents([(1, "x")]).filter("false")).count() == 0
