"""Chat formatting by quotation linking (operator 10, DataFrame functions only).

A line's quote level is the number of ``>`` it starts with. Neighbouring lines of
one level form a passage. Wrapped lines are joined, and the passage, its
paragraphs (between blank lines), its lines and its sentences are normalised
(white space, case) and hashed: a quote of one sentence or of two paragraphs in
other line breaks finds its source. A quoted unit is joined, inside its
conversation, to the first message that says it itself (level zero). Units under
``SHORTEST`` characters are only linked as a whole quote of a whole message
(``> Yes!``). A message replies to the message that its outermost linked quotes
come from: whole passages before paragraphs before lines and sentences, the
latest such message first. Replies form threads; a thread is named by its first
turn. The result has no quotes and no "X wrote:" lines before them, a row per
message, and ``ORDER`` sorts it into reply-ordered conversations.

A conversation is never gathered: each (conversation, passage) has one origin, a
grouped minimum, and threads are components over reply links. A conversation or
a passage that a third of all rows share is a hash per message in these joins.

Defined results: a NULL text is an empty one. Quotes are dropped whether or not
their source is found: ``n_quotes`` counts quoted passages, ``n_linked`` those of
which a unit was found. A message only
replies to an earlier turn; one without linked quotes is a thread of its own.
Rows that share conversation and turn are one message for linking, each is
returned. Rows without a conversation or turn are formatted but not linked. Of
units said several times the first message counts. A very long text is parsed in
one row. An empty table gives an empty result. Only the four named columns are
read and returned; others, whatever their names, are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm.common import components, materialize, table

ORDER = ("conv_id", "thread_turn", "turn")
SHORTEST = 8  # characters of a part of a message that can identify it
WHOLE, PARAGRAPH, PART = 0, 1, 2
SENTENCE_END = r"""(?<=[.!?…]["'”’)\]]{0,2}) |(?<=[。！？])"""
WROTE = r"(?i)(wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$"
QUOTE = r"^(?:[ \t]*>)+"


def _lines(text: Column) -> Column:
    """Lines as (level, raw, body): body without its marks, white space collapsed, lower case."""
    def one(line: Column) -> Column:
        marks = F.regexp_extract(line, QUOTE, 0)
        body = F.trim(F.regexp_replace(F.substr(line, F.char_length(marks) + 1), r"\s+", " "))
        return F.struct(F.char_length(F.regexp_replace(marks, "[^>]", "")).alias("level"), line.alias("raw"),
                        F.lower(body).alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n", -1), one)


def _attribution(lines: Column, x: Column, i: Column) -> Column:
    """Whether line ``i`` says who wrote the quote right after it."""
    return x["raw"].rlike(WROTE) & (x["level"] == 0) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)


def _bodies(lines: Column) -> Column:
    """The lines' bodies, attribution lines blank."""
    return F.transform(lines, lambda x, i: F.when(_attribution(lines, x, i), F.lit("")).otherwise(x["body"]))


def _passages(lines: Column, bodies: Column) -> Column:
    """Runs of one level as (level, text), in order: text has a body a line."""
    first = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: (i == 1) | (
        F.element_at(lines, i)["level"] != F.element_at(lines, F.greatest(i - 1, F.lit(1)))["level"]))
    after = F.concat(F.slice(first, 2, F.size(first)), F.array(F.size(lines) + 1))
    return F.transform(F.arrays_zip(first.alias("a"), after.alias("b")), lambda r: F.struct(
        F.element_at(lines, r["a"])["level"].alias("level"),
        F.btrim(F.array_join(F.slice(bodies, r["a"], r["b"] - r["a"]), "\n"), F.lit("\n")).alias("text")))


def _joined(text: Column) -> Column:
    return F.regexp_replace(text, r"\n+", " ")


def _units(passages: Column) -> Column:
    """(level, passage, kind, h1, h2, size) of each passage, its paragraphs, lines and sentences,
    and one of level -1 for all that the message says itself."""
    def unit(level: Column, passage: Column, kind: int, text: Column) -> Column:
        return F.struct(level.alias("level"), passage.alias("passage"), F.lit(kind).alias("kind"), F.xxhash64(text).alias("h1"),
                        F.xxhash64(F.lit("unit"), text).alias("h2"), F.char_length(text).alias("size"))

    def parts(p: Column, n: Column) -> Column:
        of = lambda kind, texts: F.transform(texts, lambda x: unit(p["level"], n, kind, x))
        paragraphs = F.transform(F.split(p["text"], r"\n\n+"), _joined)
        sentences = F.flatten(F.transform(paragraphs, lambda x: F.split(x, SENTENCE_END)))
        return F.array_distinct(F.concat(of(WHOLE, F.array(_joined(p["text"]))), of(PARAGRAPH, paragraphs),
                                         of(PART, F.split(p["text"], r"\n+")), of(PART, sentences)))

    own = F.filter(passages, lambda p: (p["level"] == 0) & (p["text"] != ""))
    message = unit(F.lit(-1), F.lit(-1), WHOLE, F.array_join(F.transform(own, lambda p: _joined(p["text"])), " "))
    units = F.concat(F.array(message), F.flatten(F.transform(passages, parts)))
    return F.filter(units, lambda u: (u["size"] >= SHORTEST) | ((u["size"] > 0) & (u["level"] != 0) & (u["kind"] == WHOLE)))


def _own_text(lines: Column) -> Column:
    """The unquoted lines, without attribution lines right before a quote."""
    kept = F.filter(lines, lambda x, i: (x["level"] == 0) & ~_attribution(lines, x, i))
    return F.btrim(F.array_join(F.transform(kept, lambda x: x["raw"]), "\n"), F.lit("\n"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, text) with ``text`` freed of quotes, ``parent_turn``
    (NULL: no reply), ``thread_turn``, ``n_quotes`` and ``n_linked``."""
    lines = messages.select("conv_id", "turn", "role", _lines(F.col("text")).alias("lines"))
    bodies = lines.withColumn("bodies", _bodies(F.col("lines")))  # a column: inside a lambda it would be made anew for each passage
    parts = bodies.withColumn("passages", _passages(F.col("lines"), F.col("bodies")))
    quotes = F.filter("passages", lambda p: p["level"] > 0)
    parsed = materialize(parts.select(
        "conv_id", "turn", "role", _own_text(F.col("lines")).alias("text"), F.size(quotes).cast("long").alias("n_quotes"),
        _units(F.col("passages")).alias("units")), "messages")
    units = parsed.filter("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.explode("units").alias("u")).select("conv_id", "turn", "u.*")
    asked = materialize(units.filter("level > 0").drop("size").distinct(), "quotes")
    origin = units.filter("level <= 0").join(
        asked.select("conv_id", "h1", "h2").distinct(), ["conv_id", "h1", "h2"], "left_semi")
    origin = materialize(origin.groupBy("conv_id", "h1", "h2").agg(F.min("turn").alias("said")), "origins")
    found = asked.join(origin, ["conv_id", "h1", "h2"]).filter("said < turn")
    found = found.groupBy("conv_id", "turn", "passage").agg(
        F.min(F.struct("level", "kind", (-F.col("said")).alias("said"))).alias("best"))
    replies = materialize(found.groupBy("conv_id", "turn").agg(
        F.min("best").alias("best"), F.count(F.lit(1)).alias("n_linked")).select(
        "conv_id", "turn", (-F.col("best.said")).alias("parent_turn"), "n_linked"), "replies")
    node = lambda turn: F.xxhash64("conv_id", turn)
    of = components(replies.select(node("turn").alias("u"), node("parent_turn").alias("v")))
    named = replies.select("conv_id", "turn").unionAll(replies.select("conv_id", F.col("parent_turn").alias("turn"))).distinct()
    threads = named.withColumn("node", node("turn")).join(of, "node").select("conv_id", "turn", "root")
    first = threads.groupBy("conv_id", "root").agg(F.min("turn").alias("thread_turn"))
    threads = threads.join(first, ["conv_id", "root"]).select("conv_id", "turn", "thread_turn")
    threads = materialize(threads, "threads")
    return (parsed.drop("units").join(replies, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", "text", "parent_turn", F.coalesce("thread_turn", "turn").alias("thread_turn"),
                    "n_quotes", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked")))


def chat_line(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), text, F.lit("\n<|end|>"))


def write_conversations(messages: DataFrame, path: str) -> None:
    """The formatted messages as text files whose lines, file after file, are the
    conversations in reply order. A long conversation runs over several files."""
    linked = link_quotes(messages).select(*ORDER, chat_line(F.col("role"), F.col("text")).alias("value"))
    linked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select("value").write.text(path)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = link_quotes(table(spark, sf_dir, "conversations"))
    return got.withColumn("chat", chat_line(F.col("role"), F.col("text")))
