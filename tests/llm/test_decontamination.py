from __future__ import annotations

import random

from pyspark.sql import functions as F

from etafeat.llm import decontamination as op

ITEMS = "item_id long, text string"
QUESTION = ("A train leaves Berlin at 9 and travels 120 km in 2 hours while another train leaves Paris and covers "
            "300 km in 5 hours so what is the mean speed of both trains?")


def brute(docs: list[tuple], items: list[tuple], need: int = op.NEED) -> set[tuple]:
    """(doc_id, item_id, kind) by comparing every window of every text in plain Python."""
    def words(text):
        out, seen = [], [c for c in map(op.classify, (text or "").encode().split()) if c[0]]
        for i, (kind, code, value) in enumerate(seen):
            if kind == op.SIGN:
                if not 0 < i < len(seen) - 1 or seen[i - 1][0] not in (op.NUM, op.UNIT) or seen[i + 1][0] != op.NUM:
                    continue
                kind = op.LITERAL
            if kind == op.UNIT and not (out and out[-1][0] == op.NUM):
                kind = op.LITERAL
            if kind:
                out.append((kind, code if kind != op.UNIT else op.CODE[op.UNIT], value))
        return out

    first = {}
    for i, t in items:
        first[t or ""] = min(first.get(t or "", i), i)
    found = set()
    for t, item in first.items():
        x = words(t)
        size = min(op.WINDOW, len(x))
        if len(x) < op.SHORTEST:
            continue
        plain = lambda ws: [(op.LITERAL, v, v) if k == op.NAME else (k, c, v) for k, c, v in ws]
        for d, text in docs:
            y = words(text)
            kinds = set()
            for shift in range(-len(x), len(y)):
                near, same, pairs, usable = set(), set(), set(), set()
                for x2, y2 in ((x, y), (plain(x), plain(y))):  # with names as slots, and as words
                    for p in range(len(x) - size + 1):
                        if 2 * sum(k == op.LITERAL for k, _, _ in x2[p:p + size]) < size:
                            continue
                        usable.add(p)
                        here = slice(p + shift, p + shift + size)
                        if not 0 <= p + shift <= len(y) - size or [c[:2] for c in x2[p:p + size]] != [c[:2] for c in y2[here]]:
                            continue
                        near.add(p)
                        if x2[p:p + size] == y2[here]:
                            same.add(p)
                        pairs |= {(i[0], i[2], j[2]) for i, j in zip(x2[p:p + size], y2[here]) if i[0] != op.LITERAL}
                if len(near) >= need:  # numbers are free
                    pairs = {x for x in pairs if x[0] != op.NUM}
                one = len({(k, a) for k, a, _ in pairs}) == len(pairs) == len({(k, b) for k, _, b in pairs})
                enough = min(need, len(usable))
                if usable and len(same) >= enough:
                    kinds.add("copy")
                elif usable and len(near) >= enough and one:
                    kinds.add("variant")
            if kinds:
                found.add((d, item, min(kinds)))
    return found


def result(spark, docs, items) -> set[tuple]:
    got = op.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect()
    assert len({(r.doc_id, r.row, r.item_id) for r in got}) == len(got)
    return {(r.doc_id, r.item_id, r.kind) for r in got}


def test_variants_of_a_question(documents, spark):
    new = QUESTION.replace("Berlin", "Madrid").replace("120", "240").replace(" 2 ", " 3 ")
    new = new.replace("300", "600").replace(" 5 ", " 6 ").replace("Paris", "Rome")
    mixed = new.replace("600 km", "240 miles").replace("Rome", "Madrid")
    rows = [(1, "Some text before. " + QUESTION + " and after"), (2, new), (3, mixed), (4, QUESTION.upper()),
            (5, "nothing of it at all in this text, though it names Berlin and 120 km"), (6, QUESTION.replace(" ", " *** ")),
            (7, None), (8, ""), (None, QUESTION), (9, "A train leaves Berlin at 9 and travels")]
    items = [(50, QUESTION), (40, QUESTION), (60, None), (61, "too short"), (62, "four plain little words")]
    rows.append((10, "here are four plain little words in a row"))
    got = result(spark, documents(rows), items)
    assert got == brute(rows, items)
    assert {(1, 40, "copy"), (2, 40, "variant"), (4, 40, "copy"), (6, 40, "copy"), (None, 40, "copy"), (10, 62, "copy")} <= got
    assert not {3, 5, 7, 8, 9} & {d for d, _, _ in got}


def test_against_brute_force(documents, spark):
    random.seed(8)
    pool = [f"w{c}" for c in "abcdefghijklmnopqrst"] + ["Anna", "Otto", "Rome", "5", "7", "12%", "3.5", "km", "kg", "--", "été", "Über", "+", "=", "(4"]
    pool = [w.replace("w", "word") for w in pool]
    text = lambda n: " ".join(random.choice(pool) for _ in range(n))
    items = [(i, text(random.choice((3, 5, 7, 12, 25)))) for i in range(25)]
    rows = []
    for i in range(60):
        parts = [text(random.randint(0, 40))]
        if i % 2:
            t = random.choice(items)[1].split()
            for k, w in enumerate(t):
                if random.random() < 0.15:
                    t[k] = random.choice(pool)
            parts += [" ".join(t), text(10)]
        rows.append((i, " ".join(parts)))
    assert result(spark, documents(rows), items) == brute(rows, items)


def test_copies_of_items_of_numbers(documents, spark):
    sequence, short = "Evaluate 3 7 12 19 28 39 52 67", "12 + 30 - 5 = 37"
    table = "the table of all values reads " + " ".join(str(i * i) for i in range(30))
    items = [(1, sequence), (2, short), (3, table), (4, "7 8 9")]
    rows = [(1, f"some words {sequence} and more"), (2, sequence.replace("19", "20")), (3, f"so {short} holds"), (4, short.replace("37", "38")),
            (5, " ".join(str(i * i) for i in range(10, 25))), (6, "7 8 9"), (7, " ".join(str(i * i + 1) for i in range(30)))]
    assert result(spark, documents(rows), items) == {(1, 1, "copy"), (3, 2, "copy"), (5, 3, "copy")}


def test_questions_with_other_numbers(documents, spark):
    """Expected by hand: equal numbers that differ in the other text, and the reverse; names must stay apart."""
    pens = "Anna buys {} red pens and {} blue pens. How many pens does Anna own by day {}?"
    hats = pens.replace("pens", "hats")
    price = "A shop sells {} pens for {} dollars each and {} books. How much does it earn by day {}?"
    sums = "Evaluate {} + {} * {} - {} / {} + {}"
    items = [(1, pens.format(3, 3, 2)), (2, price.format(12, 4, 3, 2)), (3, sums.format(3, 7, 12, 8, 4, 19)), (4, hats.format(3, 4, 2))]
    rows = [(1, "so " + pens.format(5, 7, 9)), (2, price.format(15, 15, 5, 5)), (3, "Now: " + sums.format(5, 9, 14, 6, 2, 21) + " please"),
            (4, hats.format(5, 5, 5).replace("Anna", "Otto")), (5, pens.format(5, 7, 9).replace("Anna buys", "Otto buys")),
            (6, sums.format(5, 9, 14, 6, 2, 21).replace("*", "-").replace("/", "+")), (7, "5 9 14 6 2 21 and 5 - 9 = -4"),
            (8, "(3 + 7) * 12"), (9, "- a list - of 3 - things + 4 =")]
    got = result(spark, documents(rows), items)
    assert got == {(1, 1, "variant"), (2, 2, "variant"), (3, 3, "variant"), (4, 4, "variant")} == brute(rows, items)


def test_a_passage_in_every_document_and_a_long_text(documents, spark):
    rows = [(i, f"own{i} start {QUESTION} own{i} end") for i in range(300)] + [(999, "filler " * 200_000 + QUESTION)]
    assert {d for d, _, k in result(spark, documents(rows), [(1, QUESTION)]) if k == "copy"} == {r[0] for r in rows}


def test_no_rows(documents, spark):
    assert result(spark, documents([]), [(1, QUESTION)]) == set()
    assert result(spark, documents([(1, QUESTION)]), []) == set()


def test_stage(documents, spark, folder):
    docs = documents([(1, QUESTION), (2, "clean"), (2, QUESTION), (None, None), (None, QUESTION), (3, "clean"), (3, "clean")])
    for c in ("id", "row", "item_id", "bad_id", "hash"):
        docs = docs.withColumn(c, F.lit("mine"))
    got = op.without_benchmark(spark, docs, folder(benchmark=spark.createDataFrame([(7, QUESTION)], ITEMS)))
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == [("2", "clean"), ("3", "clean"), ("3", "clean"), ("None", None)]
