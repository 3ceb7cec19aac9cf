from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from etafeat.llm import simhash as op


def plain_fingerprint(text: str | None) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(pairs: list[tuple]) -> dict:
    """Smallest id reachable from each of (id, fingerprint) over two bits or fewer."""
    root = {i: i for i, _ in pairs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in pairs:
        for j, y in pairs:
            if (x ^ y).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in pairs}


def test_fingerprints_and_groups(documents):
    random.seed(3)
    words = [f"w{i}" for i in range(40)] + ["É", "Ünd", "The"]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE two"), (5, "one two"), (6, "a b c"), (7, "x " * 70_000)]
    for i in range(10, 130):
        base = random.Random(i // 6)
        text = [base.choice(words) for _ in range(200)]
        if i % 6:
            text[random.randrange(200)] = "changed"
        rows.append((i, " ".join(text)))
    got = {r.doc_id: r for r in op.near_duplicates(documents(rows)).collect()}
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    assert {i: r.fp & (1 << 64) - 1 for i, r in got.items()} == dict(fps)
    assert {i: r.component_id for i, r in got.items()} == groups(fps)


def test_every_pair_within_the_radius_is_linked(spark):
    """Chains and clouds of fingerprints, among them pairs at exactly two and three bits."""
    random.seed(11)
    fps = set()
    for _ in range(40):
        x = random.getrandbits(64)
        for _ in range(random.randint(1, 12)):
            fps.add(x)
            for _ in range(random.choice((1, 2, 2, 3))):
                x ^= 1 << random.randrange(64)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    of = {r.node: r.root for r in op.components(op.links(df)).collect()}
    want = groups([(f, f) for f in fps])
    back = {}
    for f in fps:
        s = f - (1 << 64) if f >> 63 else f
        back.setdefault(of.get(s, s), set()).add(f)
    per = {}
    for f, r in want.items():
        per.setdefault(r, set()).add(f)
    assert sorted(map(sorted, back.values())) == sorted(map(sorted, per.values()))


def test_masks_cover_every_pair_of_bits():
    masks = op.masks()
    assert len(masks) == 7
    assert all(any(not (m >> i & 1 or m >> j & 1) for m in masks) for i in range(64) for j in range(64))


def test_stage_keeps_one_of_a_group(documents, spark):
    same = "a text of some words that is the same in many rows"
    docs = documents([(i, same) for i in range(5, 300)] + [(1, "another text with words of its own"), (1, "another text with words of its own"),
                                                           (None, "a row without an id"), (None, None)])
    docs = docs.withColumn("fp", F.lit("mine")).withColumn("first", F.lit(1)).withColumn("root", F.lit(2))
    got = op.keep_one_per_group(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.filter("doc_id is not null").collect()) == [1, 5]
    assert got.filter("doc_id is null").count() == 2
    assert op.near_duplicates(documents([])).collect() == []
    rows = {r.doc_id: r.component_id for r in op.near_duplicates(documents([(None, "lone row"), (3, None), (4, "")])).collect()}
    assert rows == {None: None, 3: 3, 4: 3}


def test_stage_keeps_by_group_and_not_by_id(documents, spark):
    """Texts of their own that share an id stay all; copies without an id leave one; the rest does not depend on the order."""
    own = [(7, " ".join(f"word{i}of{j}" for j in range(60))) for i in range(50)]
    copies = [(None, "a text without any id that comes again and again")] * 40
    near = [(9, "both rows of this group have one text"), (7, "both rows of this group have one text")]
    rows = own + copies + near + [(3, "same id and text", "b"), (3, "same id and text", "a")]
    got = sorted(map(str, op.keep_one_per_group(spark, documents(rows), "").collect()))
    back = sorted(map(str, op.keep_one_per_group(spark, documents(rows[::-1]).repartition(3), "").collect()))
    assert got == back
    texts = [r[1] for r in rows]
    assert len(got) == len(set(texts)) and all(sum(t in g for g in got) == 1 for t in set(texts))
    assert sum("doc_id=7," in g for g in got) == 51
