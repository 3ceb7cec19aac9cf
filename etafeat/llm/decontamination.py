"""Benchmark decontamination (operator 5).

Texts become templates: numbers, capitalised words and units after a number are
replaced by typed placeholders, other words are lower-cased and stripped of
punctuation at their ends. Windows of eight template words are hashed, once like that and once
with names as plain words, so that a copy in capitals is found too; document
windows that a Bloom filter of the benchmark's windows lets through (a fixed
number of bits, no false negatives) are hash-joined with those windows. Matches
are grouped by (document, item, offset between the two), which aligns them.

A document is contaminated by an item if one alignment holds ``need`` matched
windows (or all, if the item has fewer) and either that many agree in every
slot value too (a copy), or its slots are consistent (a re-parameterised
question). Names and units are identities: they must map one to one between item
and document. Numbers are parameters: two that are equal in one text may differ
in the other, so with ``need`` windows they are free; where an item has fewer
windows, they must map one to one as well. An operator sign between two numbers
is a literal word, so that expressions have templates; other lone signs are not
words.

Defined results: items with the same template and values are one, named by the
smallest id. Items of fewer template words than a window are matched by one
window of their own length; below ``SHORTEST`` words a text identifies nothing
and is not matched. Windows with fewer than half literal words are hashed with
the raw values in place of placeholders, so they are found as copies only. A
NULL or empty text matches nothing. Documents without an id are matched and
reported with a NULL id; rows that share an id and a text are reported once.
Only ``doc_id``/``item_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm import ngrams
from etafeat.llm.common import materialize, table

WINDOW, NEED, SHORTEST = 8, 6, 4
RAW = 2  # number of the family of raw words
FILTER_BITS = 1 << 24  # 2 MB whatever the benchmark's size; more items only let more windows through
MEMO = 1 << 18  # words whose classification a task remembers
UNITS = frozenset(
    b"mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms oz lb lbs "
    b"pound pounds ton tons ml l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h "
    b"hr hour hours day days week weeks month months year years cent cents dollar dollars euro euros usd eur percent "
    b"degree degrees mph kmh kb mb gb tb w kw v a hz j n pa".split())
NUMBER = re.compile(rb"[$\xe2\x82\xac\xc2\xa3+-]*(\d[\d.,:/]*)(%|[A-Za-z\xc2-\xf4\x80-\xbf]*)")
EDGE = re.compile(rb"^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+$")
NONE, LITERAL, NUM, NAME, UNIT, SIGN = 0, 1, 2, 3, 4, 5
SIGNS = frozenset([b"+", b"-", b"*", b"/", b"=", b"^", b"<", b">"] + [c.encode() for c in "×÷−"])
CODE = {NUM: 0x9E3779B97F4A7C15, NAME: 0xC2B2AE3D27D4EB4F, UNIT: 0x165667B19E3779F9}
MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def classify(word: bytes) -> tuple[int, int, int]:
    """Kind, template code and value of one word of a text."""
    if word.isalpha() and word.islower():  # ASCII
        value = xxhash.xxh64_intdigest(word)
        return (UNIT if word in UNITS else LITERAL), value, value
    if word in SIGNS:
        value = xxhash.xxh64_intdigest(word)
        return SIGN, value, value
    if m := NUMBER.fullmatch(word.rstrip(b".,;:!?)*#$&\"'").lstrip(b"([\"'")):
        unit = m[2].lower()
        return NUM, CODE[NUM] ^ (xxhash.xxh64_intdigest(unit) if unit else 0), xxhash.xxh64_intdigest(m[1].rstrip(b".,:/"))
    core = EDGE.sub(b"", word)
    if not core:
        return NONE, 0, 0
    text = core.decode("utf-8", "replace")
    value = xxhash.xxh64_intdigest(core.lower() if text.isascii() else text.lower().encode())
    if text[0].isupper() and text[1:] == text[1:].lower():
        return NAME, CODE[NAME], value
    return (UNIT if core.lower() in UNITS else LITERAL), value, value


class Classified(dict):
    """word -> row of the three columns below, filled on demand."""

    def __init__(self):
        self._columns(1 << 12)

    def _columns(self, room: int) -> None:
        for name, kind in (("kind", np.int8), ("code", np.uint64), ("value", np.uint64)):
            new, old = np.zeros(room, kind), getattr(self, name, ())
            new[:len(old)] = old
            setattr(self, name, new)

    def __missing__(self, word: bytes) -> int:
        n = len(self)
        if n == len(self.kind):
            self._columns(2 * n)
        self.kind[n], self.code[n], self.value[n] = classify(word)
        self[word] = n
        return n


def templates(texts: list[bytes], memo: Classified) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, kind, code and value of the template words of ``texts``, in order."""
    if len(memo) > MEMO:
        memo.clear()
    words = [t.split() for t in texts]
    size = [len(w) for w in words]
    at = np.fromiter(map(memo.__getitem__, chain.from_iterable(words)), np.int64, sum(size))
    doc = np.repeat(np.arange(len(texts)), size)
    kind = memo.kind[at]
    own = kind != NONE
    at, doc, kind = at[own], doc[own], kind[own]
    sign = kind == SIGN  # a sign only between two numbers, the first perhaps with its unit
    if sign.any():
        before, after = np.zeros(len(kind), bool), np.zeros(len(kind), bool)
        same = doc[1:] == doc[:-1]
        before[1:] = ((kind[:-1] == NUM) | (kind[:-1] == UNIT)) & same
        after[:-1] = (kind[1:] == NUM) & same
        kind[sign & before & after] = LITERAL
        own = kind != SIGN
        at, doc, kind = at[own], doc[own], kind[own]
    code, value = memo.code[at], memo.value[at]
    unit = kind == UNIT  # a unit only right after a number
    after = np.zeros(len(kind), bool)
    after[1:] = (kind[:-1] == NUM) & (doc[1:] == doc[:-1])
    code[unit & after] = CODE[UNIT]
    kind[unit & ~after] = LITERAL
    return doc, kind, code, value


def families(kind: np.ndarray, code: np.ndarray, value: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Kinds and codes of the template, of the one in which names are words, and of the raw words."""
    name, raw = kind == NAME, np.where(kind == NUM, (code * MULTIPLIER) ^ value, value)
    return [(kind, code), (np.where(name, LITERAL, kind), np.where(name, value, code)), (np.full_like(kind, LITERAL), raw)]


def windows(doc: np.ndarray, kind: np.ndarray, code: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the usable windows of ``size`` words, none across texts."""
    n = len(kind) - size + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = np.full(n, size + (seed << 8), np.uint64)
    for i in range(size):
        h = (h ^ (h >> np.uint64(29))) * MULTIPLIER + code[i:i + n]
    literal = np.concatenate(([0], np.cumsum(kind == LITERAL)))
    use = (2 * (literal[size:] - literal[:n]) >= size) & (doc[size - 1:] == doc[:n])
    return np.flatnonzero(use), (h ^ (h >> np.uint64(32)))[use]


def probes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = np.uint64(FILTER_BITS - 1)
    return (h & bits).astype(np.int64), ((h >> np.uint64(32)) & bits).astype(np.int64)


ROWS = "id long, row long, family int, size int, pos int, hash long, slots array<struct<at int, kind byte, value long>>"


SCHEMA = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("family", pa.int32()), ("size", pa.int32()), ("pos", pa.int32()), ("hash", pa.int64()),
                    ("slots", pa.list_(pa.struct([("at", pa.int32()), ("kind", pa.int8()), ("value", pa.int64())])))])


def hashed_windows(texts: DataFrame, sizes: list[tuple] | None = None, passing: Broadcast | None = None) -> DataFrame:
    """ROWS of the windows of ``texts(id, row, text)``: without a filter one size a text
    (the benchmark), else those of the given (family, size) that pass it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Classified()
        packed = np.frombuffer(passing.value, np.uint8) if passing else None
        for b in (part for batch in batches for part in ngrams.slices(batch)):
            ids, hashes = b.column(0).to_pylist(), b.column(1).to_pylist()
            texts = [t or b"" for t in b.column(2).to_pylist()]
            # a benchmark item is its own chunk: its length decides the size of its windows
            for i, j in ngrams.chunks(texts) if passing else ((k, k + 1) for k in range(len(texts))):
                doc, kind, code, value = templates(texts[i:j], memo)
                first = np.searchsorted(doc, np.arange(j - i))
                every = families(kind, code, value)
                own = [(f, min(WINDOW, len(kind))) for f in range(len(every))] if len(kind) >= SHORTEST else []
                usable = np.empty(0, np.int64)
                for family, size in sizes if passing else own:
                    as_kind, as_code = every[family]
                    at, h = windows(doc, as_kind, as_code, size, family)
                    if not passing and family == RAW:  # raw words only where no template has the window
                        rest = ~np.isin(at, usable)
                        at, h = at[rest], h[rest]
                    usable = at
                    if passing and len(h):
                        one, two = probes(h)
                        ok = (packed[one >> 3] >> (one & 7) & 1 & (packed[two >> 3] >> (two & 7))).astype(bool)
                        at, h = at[ok], h[ok]
                    out = []
                    for p, x in zip(at.tolist(), h.view(np.int64).tolist()):
                        slots = [{"at": k, "kind": int(as_kind[p + k]), "value": int(value[p + k].view(np.int64))}
                                 for k in range(size) if as_kind[p + k] != LITERAL]
                        d = int(doc[p])
                        out.append((ids[i + d], hashes[i + d], family, size, p - int(first[d]), x, slots))
                    for k in range(0, len(out), 4096):
                        yield pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, r)) for r in out[k:k + 4096]], SCHEMA)

    return texts.select("id", "row", F.col("text").cast("binary")).mapInArrow(run, ROWS)


def bloom(found: DataFrame) -> bytearray:
    """Bits of the hashes of ``found``: each of a few tasks sends a whole filter, a fixed size."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(FILTER_BITS, np.uint8)
        for b in batches:
            for at in probes(b["hash"].to_numpy().view(np.uint64)):
                bits[at] = 1
        yield pd.DataFrame({"bits": [np.packbits(bits, bitorder="little").tobytes()]})

    total = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in found.select("hash").coalesce(8).mapInPandas(run, "bits binary").toLocalIterator():
        total |= np.frombuffer(r.bits, np.uint8)
    return bytearray(total.tobytes())


def contaminated(docs: DataFrame, benchmark: DataFrame, need: int = NEED) -> DataFrame:
    """(doc_id, row, item_id, n_windows, n_equal, item_windows, kind), a row per document and item.

    ``n_windows`` of the item's ``item_windows`` windows match in one alignment,
    ``n_equal`` of them with equal values; ``kind`` is ``copy`` or ``variant``.
    ``row`` is the hash of the document's text.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    items = items.groupBy("text").agg(F.min("id").alias("id")).select("id", F.xxhash64("text").alias("row"), "text")
    items = materialize(hashed_windows(items), "item-windows")
    sizes = [(r["family"], r["size"]) for r in items.select("family", "size").distinct().collect()]  # WINDOW - SHORTEST + 1 a family
    template = F.col("family") != RAW
    count = items.groupBy(F.col("id").alias("item_id")).agg(
        F.count_distinct("pos").alias("item_windows"), F.count_distinct(F.when(template, F.col("pos"))).alias("item_templates"))
    items = items.select(F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), "hash", template.alias("template"),
                         F.col("slots").alias("item_slots")).join(count, "item_id")
    passing = spark.sparkContext.broadcast(bytes(bloom(items)))
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), "text")
    rows = hashed_windows(texts, sizes, passing).drop("family").distinct()
    hits = rows.join(items, "hash").filter(F.size("slots") == F.size("item_slots"))
    pairs = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    same_kinds = F.forall(pairs, lambda x: (x["i"]["at"] == x["d"]["at"]) & (x["i"]["kind"] == x["d"]["kind"]))
    equal = F.forall(pairs, lambda x: x["i"]["value"] == x["d"]["value"])
    mapping = F.transform(pairs, lambda x: F.struct(
        x["i"]["kind"].alias("kind"), x["i"]["value"].alias("item"), x["d"]["value"].alias("doc")))
    hits = hits.select("id", "row", "item_id", "item_windows", "item_templates", "template", (F.col("pos") - F.col("item_pos")).alias("offset"),
                       "item_pos", same_kinds.alias("kinds"), equal.alias("equal"), mapping.alias("mapping")).filter("kinds")
    key = ["id", "row", "item_id", "item_windows", "item_templates", "offset"]
    # an alignment has at most the item's windows; its slots are a set of at most the item's words
    found = lambda which: F.size(F.collect_set(F.when(which, F.col("item_pos")))).cast("long")
    aligned = hits.groupBy(*key).agg(
        found(F.lit(True)).alias("n_windows"), found(F.col("equal")).alias("n_equal"),
        found(F.col("template")).alias("t_windows"), found(F.col("template") & F.col("equal")).alias("t_equal"),
        F.array_distinct(F.flatten(F.collect_set("mapping"))).alias("slots"))
    def one_to_one(slots: Column) -> Column:
        values = lambda side: F.size(F.array_distinct(F.transform(slots, lambda x: F.struct(x["kind"], x[side]))))
        return (values("item") == F.size(slots)) & (values("doc") == F.size(slots))

    consistent = (one_to_one(F.filter("slots", lambda x: x["kind"] != NUM))
                  & ((F.col("t_windows") >= need) | one_to_one(F.col("slots"))))
    enough = lambda n, of: (F.col(of) > 0) & (F.col(n) >= F.least(F.lit(need), F.col(of)))
    aligned = aligned.withColumn("kind", F.when(
        enough("n_equal", "item_windows") | enough("t_equal", "item_templates"), "copy").when(
        enough("t_windows", "item_templates") & consistent, "variant")).filter("kind is not null")
    best = aligned.groupBy("id", "row", "item_id", "item_windows").agg(
        F.max(F.struct("n_equal", "n_windows", "kind")).alias("b"))
    return best.select(F.col("id").alias("doc_id"), "row", "item_id", F.col("b.n_windows").alias("n_windows"),
                       F.col("b.n_equal").alias("n_equal"), "item_windows", F.col("b.kind").alias("kind"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each contaminated document and item it holds; clean documents have none."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that hold no benchmark item."""
    bad = contaminated(docs, table(spark, sf_dir, "benchmark")).select(
        F.col("doc_id").alias("bad_id"), "row").distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"])
                     & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["row"]), "left_anti")
