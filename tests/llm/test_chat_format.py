from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from etafeat.llm import chat_format as op

SCHEMA = "conv_id long, turn long, role string, text string"


def sentences(text: str) -> list[str]:
    """Words up to one that ends in a full stop, question or exclamation mark, perhaps inside marks."""
    out = [[]]
    for word in text.split(" "):
        out[-1].append(word)
        if any(word[len(word) - k - 1:][:1] in tuple(".!?…") and all(c in "\"'”’)]" for c in word[len(word) - k:])
               for k in range(3) if len(word) > k):
            out.append([])
    return [" ".join(x) for x in out if x]


def brute(rows: list[tuple]) -> list[tuple]:
    """(conv, turn, text, parent, thread, n_quotes, n_linked) in plain Python; one row a turn."""
    parsed, said = {}, {}
    for conv, turn, _, text in rows:
        lines = []
        for raw in re.split(r"\r?\n", text or ""):
            marks = re.match(r"(?:[ \t]*>)*", raw)[0]
            lines.append((marks.count(">"), raw, " ".join(raw[len(marks):].split()).lower()))
        wrote = {i for i, (level, raw, _) in enumerate(lines) if level == 0 and re.search(op.WROTE, raw)
                 and i + 1 < len(lines) and lines[i + 1][0] > 0}
        runs = []
        for i, (level, _, body) in enumerate(lines):
            if not runs or runs[-1][0] != level:
                runs.append((level, [[]]))
            if body and i not in wrote:
                runs[-1][1][-1].append(body)
            else:
                runs[-1][1].append([])
        runs = [(level, [p for p in ps if p]) for level, ps in runs]
        quotes, own = [], []
        for level, ps in runs:
            parts = {(2, x) for p in ps for x in p + sentences(" ".join(p))} | {(1, " ".join(p)) for p in ps}
            parts = {(k, x) for k, x in parts if len(x) >= op.SHORTEST}
            whole = " ".join(x for p in ps for x in p)
            if level:
                quotes.append((level, parts | {(0, whole)} - {(0, "")}))
            else:
                own.append(whole)
                for x in {x for _, x in parts} | ({whole} if len(whole) >= op.SHORTEST else set()):
                    said[conv, x] = min(said.get((conv, x), turn), turn)
        message = " ".join(x for x in own if x)
        if message:
            said[conv, message] = min(said.get((conv, message), turn), turn)
        kept = "\n".join(raw for i, (level, raw, _) in enumerate(lines) if level == 0 and i not in wrote).strip("\n")
        parsed[conv, turn] = quotes, kept
    parent, linked = {}, {}
    for (conv, turn), (quotes, _) in parsed.items():
        found = [min([(level, kind, -said[conv, x]) for kind, x in parts if said.get((conv, x), turn) < turn], default=None)
                 for level, parts in quotes]
        found = [x for x in found if x]
        if found:
            parent[conv, turn], linked[conv, turn] = -min(found)[2], len(found)
    def thread(conv, turn):
        while (conv, turn) in parent:
            turn = parent[conv, turn]
        return turn
    return sorted((c, t, x[1], parent.get((c, t)), thread(c, t), len(x[0]), linked.get((c, t), 0)) for (c, t), x in parsed.items())


def result(df) -> list[tuple]:
    got = op.link_quotes(df).select("conv_id", "turn", "text", "parent_turn", "thread_turn", "n_quotes", "n_linked").collect()
    return sorted(map(tuple, got))


def dialogue(seed: int, conv: int, n: int) -> list[tuple]:
    """Messages that quote earlier ones, whole or in part, nested, sometimes with an attribution line."""
    rng = random.Random(seed)
    said, rows = [], []
    for t in range(n):
        own = [" ".join(rng.choice("alpha beta. gamma delta! epsilon zeta?) eta theta".split()) for _ in range(rng.randint(1, 6))) + f" {rng.randint(0, 60)}"
               for _ in range(rng.randint(1, 3))]
        own = [x for line in own for x in ([line, ""] if rng.random() < 0.2 else [line])]
        lines = []
        if said and rng.random() < 0.7:
            lines += ["On Monday Anna wrote:"] if rng.random() < 0.5 else []
            quoted = rng.choice(said)
            lines += [("> " if rng.random() < 0.5 else ">") + x.upper().replace(" ", "  ") for x in quoted[-rng.randint(1, len(quoted)):]]
            lines += [""] if rng.random() < 0.3 else []
        lines += own
        said.append(lines)
        rows.append((conv, t, rng.choice(("user", "assistant")), "\n".join(lines)))
    return rows


def test_against_brute_force(spark):
    rows = [r for c in range(12) for r in dialogue(c, c, 15)]
    rows += [(50, 0, None, None), (50, 1, "user", ""), (50, 2, "user", ">"), (50, 3, "user", "> > \n>> deep quote of nobody"), (51, 4, "user", "a\r\n> b\r\nc")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert sum(w[3] is not None for w in want) > 30
    assert result(df) == want


def test_one_conversation_with_all_rows(spark):
    first = "the very first message of this conversation"
    rows = [(1, 0, "user", first)] + [(1, t, "user", f"> {first}\nanswer number {t} to it") for t in range(1, 800)]
    got = result(spark.createDataFrame(rows, SCHEMA))
    assert [(r[3], r[4]) for r in got] == [(None, 0)] + [(0, 0)] * 799


def test_edge_rows(spark):
    rows = [(None, 1, "user", "> a quote without a conversation"), (1, None, "user", "text without turn"), (2, 0, "user", "a message said twice"),
            (2, 0, "user", "a message said twice"), (2, 1, None, "> a message said twice\nyes " + "long " * 50_000), (3, 0, "user", "a message said twice"),
            (3, 1, "user", "> a message said later"), (3, 2, "user", "a message said later")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("h1", F.lit("mine")).withColumn("parent_turn", F.lit("mine")).withColumn("units", F.lit(1))
    got = op.link_quotes(df).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): (r.parent_turn, r.thread_turn) for r in got}
    assert by == {(None, 1): (None, 1), (1, None): (None, None), (2, 0): (None, 0), (2, 1): (0, 0), (3, 0): (None, 0), (3, 1): (None, 1), (3, 2): (None, 2)}
    assert op.link_quotes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_written_conversations_are_in_reply_order(spark, tmp_path):
    rows = [(1, 0, "user", "how do i bake bread"), (1, 1, "user", "what about the weather"), (1, 2, "assistant", "> how do i bake bread\nwith flour"),
            (1, 3, "assistant", "> what about the weather\nit rains")]
    op.write_conversations(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/chat")
    text = "\n".join(r.value for r in spark.read.option("wholetext", False).text(f"{tmp_path}/chat").coalesce(1).collect())
    assert [x for x in text.split("\n") if x and "<|" not in x] == ["how do i bake bread", "with flour", "what about the weather", "it rains"]


MAIL = """We met on Monday in the old town hall. The roof has to be mended
before winter, and two firms have sent offers.

The first offer is cheaper but the work
takes until March.

Please tell me by Friday which one you prefer."""


def test_quoted_mail(spark):
    rows = [
        (1, 0, "user", MAIL),
        (1, 1, "user", "Yes!"),
        # one sentence out of a longer line, over a line break
        (1, 2, "user", "> The roof has to be mended before winter, and two\n> firms have sent offers.\nWhich firms?"),
        # a short message as a whole
        (1, 3, "user", "> Yes!\nYes to what?"),
        # two of three paragraphs in other line breaks
        (1, 4, "user", "On Monday Anna wrote:\n> The first offer is cheaper but the work takes until\n> March.\n>\n> Please tell me by\n> Friday which one you prefer.\nThe cheaper one."),
        # a short word that is nobody's whole message, and a nested quote
        (1, 5, "user", "> March.\nNot in spring?"),
        (1, 6, "user", "> > Yes!\n> Yes to what?\nTo the roof."),
    ]
    got = {r.turn: r for r in op.link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {t: r.parent_turn for t, r in got.items()} == {0: None, 1: None, 2: 0, 3: 1, 4: 0, 5: None, 6: 3}
    assert {t: r.thread_turn for t, r in got.items()} == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0, 5: 5, 6: 1}
    assert got[4].text == "The cheaper one." and (got[4].n_quotes, got[4].n_linked) == (1, 1) and (got[6].n_quotes, got[6].n_linked) == (2, 2)
    assert (got[5].n_quotes, got[5].n_linked) == (1, 0)
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
