"""Phrase collocation mining (operator 13), by the set-oriented relational method SETM.

Documents are dealt into buckets of about ``BUCKET_BYTES`` of text. Occurrence
relations R1, R2, R3 say which frequent word or phrase starts where; they are
written as tables, bucketed by ``bucket``, a row holding a document's sorted
positions and ids. Positions skip a number between pieces, so the next position
is the next word of the same piece or nothing. For every length:

1. merge-join the relation with itself at adjacent positions, inside the bucket;
2. count the groups, first in the bucket, then over all buckets (a group is one
   entry a bucket there, however often it occurs): groups are dealt by hash into as
   many parts as there are buckets, and a row holds what a bucket has in a part;
3. groups of at least ``min_count`` are frequent; each gets a number;
4. semi-join: the frequent groups that a bucket holds go back to the bucket and
   filter its occurrences there, before the next length is joined.

Only (bucket, part, groups, counts) rows are exchanged, never occurrences: a word
that is a third of all text is one entry a bucket. Groups and counts are packed
numbers, which take a fraction of a row for each group. A part holds about as many
entries as a bucket, at every size. A phrase of k words is joined from
its first and last k - 1 words, both of which must be frequent. The bucket is
what a task holds: its words as Arrow arrays, positions and ids as numpy arrays. The bucketed tables are joined without an exchange.

A phrase's parts are frequent when it is, so the counts of all cuts are in the
tables of the shorter lengths; and what a phrase lies in is bounded by the
phrases one word longer. Counts are exact; products are DECIMAL.

Defined results: a NULL text is empty, a NULL language is ``und``; rows are
documents of their own, also repeated rows. Ties of the score go to the more
frequent, then to the smaller phrase in bytes. A text is split inside one row,
so a task holds the words of a document at once. Languages without a candidate,
and empty tables, give no rows. Input columns other than ``text`` and ``lang``
are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from etafeat.llm import ngrams
from etafeat.llm.common import materialize, shared_dir, table

MIN_COUNT = 30
LONGEST = 4
TOP = 2000
INSIDE = (100, 80)  # a candidate goes if 100 * f(longer) >= 80 * a
BUCKET_BYTES = 8 << 20

_BREAK = "."
_SEPARATORS = "[.,;:!?\n-\r]"


def _tokens(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document of each token, its code, words by code): the words and breaks of ``texts`` in their order.

    A break has the code -1, so that codes either side of it are not adjacent.
    """
    lower = pc.ascii_lower(pa.array(texts.combine_chunks(), pa.large_string()))
    found = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, _SEPARATORS, f" {_BREAK} "))
    coded = found.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    for no_word in (_BREAK, ""):  # a text that starts or ends with white space has an empty token there
        code = words.index(no_word).as_py()
        if code >= 0:
            codes = np.where(codes == code, -1, codes)
    return np.repeat(np.arange(len(texts)), found.value_lengths().to_numpy()), codes, words


def _adjacent(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Merge-join of a relation with itself: (document, position, x, y) of each pair at adjacent positions."""
    at = _flat(rows, "at")
    ids = _flat(rows, "ids")
    doc = np.repeat(np.arange(rows.num_rows), rows.column("at").combine_chunks().value_lengths().to_numpy())
    pair = np.flatnonzero((at[1:] == at[:-1] + 1) & (doc[1:] == doc[:-1]))
    return doc[pair], at[pair], ids[pair], ids[pair + 1]


def _flat(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _code(known: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One number for each (x, y), whose members are all in the sorted ``known``."""
    return np.searchsorted(known, x) * np.int64(len(known)) + np.searchsorted(known, y)


def _packed(v: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones, so that the codec of shuffles and files removes what they share."""
    return np.ascontiguousarray(v.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(rows: pa.Table | pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of ``_packed`` values, and how many each row has."""
    each = [np.frombuffer(b, np.uint8).reshape(8, -1).T.copy().view("<i8").ravel() for b in rows.column(name).to_pylist()]
    return np.concatenate([np.zeros(0, np.int64), *each]), np.array([len(v) for v in each], np.int64)


def _split(words: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The words of space-joined texts; no word holds a space."""
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    return pc.split_pattern(words.cast(pa.large_string()), " ").flatten()


def _joined(words: pa.Array, edges: np.ndarray) -> pa.Array:
    """``words`` between ``edges``, space-joined; NULL where there are none."""
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), words.cast(pa.string())), " ")
    return pc.if_else(pa.array(np.diff(edges) > 0), text, pa.scalar(None, pa.string()))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Edges of the stretches of equal rows of numbers that are not below zero."""
    new = np.zeros(len(columns[0]), bool)
    for v in columns:
        new |= np.diff(v, prepend=-1) != 0
    return np.append(np.flatnonzero(new), len(new))


def _relation(bucket: int, doc: np.ndarray, at: np.ndarray, ids: np.ndarray) -> pa.Table:
    """One row for each document with occurrences: its positions and ids."""
    edges = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc)).astype("int32")
    if len(edges) == 1:
        edges = np.zeros(1, "int32")
    lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(v)) for v in (at.astype("int32"), ids.astype("int64"))]
    return pa.table({"bucket": np.full(len(edges) - 1, bucket, "int64"), "at": lists[0], "ids": lists[1]})


def _count_words(parts: int):
    """Words of a bucket, counted: a row for each language and part."""
    def run(rows: pa.Table) -> pa.Table:
        doc, codes, words = _tokens(rows.column("text"))
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False)[doc].astype("int64")
        real = codes >= 0
        groups, c = np.unique(lang[real] * len(words) + codes[real], return_counts=True)
        lang, code = groups // max(len(words), 1), groups % max(len(words), 1)
        salt = ngrams.hashed(pa.array(langs.dictionary, pa.string()))
        part = _part(salt[lang], ngrams.hashed(words.cast(pa.string()))[code], parts)
        order = np.lexsort((part, lang))
        edges = _runs(lang[order], part[order])
        first = order[edges[:-1]]
        return pa.table({"bucket": np.full(len(first), rows.column("bucket")[0].as_py(), "int64"), "part": part[first],
                         "lang": langs.dictionary.take(pa.array(lang[first])).cast(pa.string()),
                         "words": _joined(words.take(pa.array(code[order])), edges),
                         "c": pa.array([_packed(c[order[i:j]]) for i, j in zip(edges[:-1], edges[1:])], pa.binary())})
    return run


def _count_pairs(parts: int):
    """Adjacent pairs of a bucket, counted: a row for each part."""
    def run(rows: pa.Table) -> pa.Table:
        _, _, x, y = _adjacent(rows)
        known = np.unique(np.concatenate([x, y]))
        groups, c = np.unique(_code(known, x, y), return_counts=True)
        x, y = known[groups // max(len(known), 1)], known[groups % max(len(known), 1)]
        part = _part(x.astype(np.uint64), y.astype(np.uint64), parts)
        order = np.argsort(part, kind="stable")
        edges = _runs(part[order])
        columns = {name: pa.array([_packed(v[order[i:j]]) for i, j in zip(edges[:-1], edges[1:])], pa.binary())
                   for name, v in (("x", x), ("y", y), ("c", c))}
        first = order[edges[:-1]]
        return pa.table({"bucket": np.full(len(first), rows.column("bucket")[0].as_py(), "int64"), "part": part[first], **columns})
    return run


def _part(x: np.ndarray, y: np.ndarray, parts: int) -> np.ndarray:
    return (ngrams.mixed(ngrams.mixed(x + ngrams.MIX) * ngrams.PRIME + y) % np.uint64(parts)).astype("int64")


def _sum(c: np.ndarray, order: np.ndarray, edges: np.ndarray, part: int, parts: int, min_count: int) -> tuple[np.ndarray, ...]:
    """Counts of the groups between ``edges`` of ``order``, their numbers (-1 if not frequent), and each row's group's number."""
    f = np.add.reduceat(c[order], edges[:-1])
    often = f >= min_count
    number = np.where(often, (np.cumsum(often) - 1) * parts + part, -1)
    ids = np.empty(len(c), np.int64)
    ids[order] = np.repeat(number, np.diff(edges))
    return f, number, ids


def _total_words(parts: int, min_count: int):
    """Words of a part over all buckets: the frequent ones go back to each bucket that holds them, and once into a
    row ``level`` a language with their counts; that row has the count of all words, too."""
    def run(rows: pa.Table) -> pa.Table:
        part, bucket = rows.column("part")[0].as_py(), rows.column("bucket").to_numpy()
        c, size = _unpacked(rows, "c")
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        of_row = langs.indices.to_numpy(zero_copy_only=False).astype("int64")
        coded = _split(rows.column("words")).dictionary_encode()
        code, lang = coded.indices.to_numpy(zero_copy_only=False).astype("int64"), np.repeat(of_row, size)
        order = np.lexsort((code, lang))
        edges = _runs(lang[order], code[order])
        f, number, ids = _sum(c, order, edges, part, parts, min_count)
        group = order[edges[:-1]]
        out = []

        def add(at: int, name: int, level: bool, kept: np.ndarray, number: np.ndarray, f: np.ndarray, n: int) -> None:
            out.append((at, langs.dictionary[name].as_py(), level, code[kept], _packed(number), _packed(f), n))

        for b, name, i, j in zip(bucket.tolist(), of_row.tolist(), (np.cumsum(size) - size).tolist(), np.cumsum(size).tolist()):
            kept = i + np.flatnonzero(ids[i:j] >= 0)
            if len(kept):
                add(b, name, False, kept, ids[kept], kept[:0], 0)
        for name in range(len(langs.dictionary)):
            of = (lang[group] == name) & (number >= 0)
            add(int(bucket[part % len(bucket)]), name, True, group[of], number[of], f[of], int(f[lang[group] == name].sum()))
        edges = np.cumsum([0, *[len(r[3]) for r in out]])
        words = _joined(coded.dictionary.take(pa.array(np.concatenate([r[3] for r in out]))), edges)
        return pa.table({"bucket": [r[0] for r in out], "lang": pa.array([r[1] for r in out], pa.string()), "level": [r[2] for r in out],
                         "words": words, "id": pa.array([r[4] for r in out], pa.binary()),
                         "f": pa.array([r[5] for r in out], pa.binary()), "n": pa.array([r[6] for r in out], pa.int64())})
    return run


def _total_pairs(parts: int, min_count: int):
    """Pairs of a part over all buckets, as ``_total_words``."""
    def run(rows: pa.Table) -> pa.Table:
        part, bucket = rows.column("part")[0].as_py(), rows.column("bucket").to_numpy()
        (x, size), (y, _), (c, _) = (_unpacked(rows, name) for name in "xyc")
        order = np.lexsort((y, x))
        edges = _runs(x[order], y[order])
        f, number, ids = _sum(c, order, edges, part, parts, min_count)
        out = []
        for b, i, j in zip(bucket.tolist(), (np.cumsum(size) - size).tolist(), np.cumsum(size).tolist()):
            kept = i + np.flatnonzero(ids[i:j] >= 0)
            if len(kept):
                out.append((b, False, _packed(x[kept]), _packed(y[kept]), _packed(ids[kept]), b""))
        group = order[edges[:-1]][number >= 0]
        if len(group):
            out.append((int(bucket[part % len(bucket)]), True, _packed(x[group]), _packed(y[group]),
                        _packed(number[number >= 0]), _packed(f[number >= 0])))
        types = [pa.int64(), pa.bool_(), *[pa.binary()] * 4]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["bucket", "level", "x", "y", "id", "f"])
    return run


def _frequent(words: bool):
    """Rows (id, lang, word, f) or (id, x, y, f) of the rows ``level``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (ids, size), (f, _) = _unpacked(b, "id"), _unpacked(b, "f")
            if words:
                lang = b.column("lang").take(pa.array(np.repeat(np.arange(b.num_rows), size)))
                named = [lang, _split(b.column("words")).cast(pa.string())]
            else:
                named = [pa.array(_unpacked(b, "x")[0]), pa.array(_unpacked(b, "y")[0])]
            yield pa.record_batch([pa.array(ids), *named, pa.array(f)], ["id", *(["lang", "word"] if words else ["x", "y"]), "f"])
    return run


def _keep_words(rows: pa.Table, frequent: pa.Table) -> pa.Table:
    """R1 of a bucket: the words of its texts that are in its frequent words."""
    if not rows.num_rows or not frequent.num_rows:
        return _relation(0, *[np.zeros(0, "int64")] * 3)
    doc, codes, words = _tokens(rows.column("text"))
    number = np.full(len(words) + 1, -1, "int64")  # by code of a word in the language at hand; the last is a break
    langs = rows.column("lang").combine_chunks().dictionary_encode()
    lang = langs.indices.to_numpy(zero_copy_only=False)[doc]
    ids = np.full(len(codes), -1, "int64")
    for i, name in enumerate(langs.dictionary.to_pylist()):
        of = frequent.filter(pc.equal(frequent.column("lang"), name))
        code = pc.index_in(_split(of.column("words")), words).to_numpy()
        number[:] = -1
        number[code] = _unpacked(of, "id")[0]
        here = lang == i
        ids[here] = number[codes[here]]
    start = np.flatnonzero(np.diff(doc, prepend=-1))
    at = np.arange(len(doc)) - np.repeat(start, np.diff(np.append(start, len(doc))))
    kept = ids >= 0
    return _relation(rows.column("bucket")[0].as_py(), doc[kept], at[kept], ids[kept])


def _keep_pairs(rows: pa.Table, frequent: pa.Table) -> pa.Table:
    """The next relation of a bucket: its adjacent pairs that are in its frequent pairs."""
    if not rows.num_rows or not frequent.num_rows:
        return _relation(0, *[np.zeros(0, "int64")] * 3)
    doc, at, x, y = _adjacent(rows)
    known = np.unique(np.concatenate([x, y]))
    wanted = _code(known, _unpacked(frequent, "x")[0], _unpacked(frequent, "y")[0])
    order = np.argsort(wanted)
    codes = _code(known, x, y)
    place = np.minimum(np.searchsorted(wanted[order], codes), len(order) - 1)
    kept = wanted[order][place] == codes
    ids = _unpacked(frequent, "id")[0][order][place[kept]]
    return _relation(rows.column("bucket")[0].as_py(), doc[kept], at[kept], ids)


class _Relations:
    """Bucketed tables in a database of their own, in the shared folder; gone after use."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name = f"llm_phrases_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{shared_dir(spark)}/{self.name}'")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.bucketBy(self.buckets, "bucket").saveAsTable(f"{self.name}.{name}")
        return self.spark.table(f"{self.name}.{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {self.name}.{name}")

    def close(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.name} CASCADE")


def _bucket_numbers(spark: SparkSession, buckets: int) -> DataFrame:
    """(slot, bucket): for each slot a number that Spark's bucketing puts into that slot, so that
    one ``bucket`` value is one bucket. A written table of 16 bytes per ``BUCKET_BYTES`` of text,
    which the planner broadcasts or merges by its size."""
    numbers = spark.range(64 * buckets).groupBy(F.pmod(F.hash("id"), F.lit(buckets)).alias("slot"))
    return materialize(numbers.agg(F.min("id").alias("bucket")), "bucket-numbers")


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST,
                     bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, list[DataFrame]]:
    """Totals (lang, n) and, for each length 1..``longest``, the frequent phrases: (id, x, y, f), x and y
    being the ids of the first and last words but one; words are (id, lang, word, f)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, -(-size // bucket_bytes))
    store = _Relations(spark, buckets)
    try:
        slot = F.pmod(F.xxhash64("text", F.spark_partition_id()), F.lit(buckets)).cast("int")
        here = store.write(texts.withColumn("slot", slot).join(_bucket_numbers(spark, buckets), "slot").drop("slot")
                           .repartition(buckets, "bucket"), "texts")
        levels = []
        for length in range(1, longest + 1):
            words = length == 1
            local = here.groupBy("bucket").applyInArrow(
                (_count_words if words else _count_pairs)(buckets),
                "bucket long, part long, " + ("lang string, words string" if words else "x binary, y binary") + ", c binary")
            known = local.groupBy("part").applyInArrow(
                (_total_words if words else _total_pairs)(buckets, min_count),
                "bucket long, " + ("lang string, level boolean, words string, id binary, f binary, n long" if words
                                   else "level boolean, x binary, y binary, id binary, f binary"))
            known = store.write(known.repartition(buckets, "bucket"), f"known{length}")
            level = known.filter("level")
            if words:
                totals = materialize(level.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
            group = ["lang", "words"] if words else ["x", "y"]
            levels.append(materialize(level.select("id", *group, "f").mapInArrow(
                _frequent(words), "id long, " + ("lang string, word string" if words else "x long, y long") + ", f long"), "frequent"))
            if length == longest:
                break
            rows = here.groupBy("bucket").cogroup(
                known.filter("not level").select("bucket", *group, "id").groupBy("bucket")).applyInArrow(
                _keep_words if words else _keep_pairs, "bucket long, at array<int>, ids array<long>")
            here = store.write(rows, f"r{length}")
            store.drop(f"known{length}", "texts" if words else f"r{length - 1}")
    finally:
        store.close()
    return totals, levels


def _cut(words: int) -> str:
    """The lowest-scoring cut as a struct (score, k, l, r): ties go to the smallest k."""
    return f"""array_min(transform(sequence(1, {words - 1}), k -> named_struct(
        'score', (cast(2000000 as decimal(7,0)) * cast(f as decimal(19,0)))
                 div (cast(heads[k - 1] as decimal(19,0)) + cast(tails[{words} - k - 1] as decimal(19,0))),
        'k', k, 'l', heads[k - 1], 'r', tails[{words} - k - 1])))"""


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    totals, levels = frequent_phrases(docs, min_count, longest)
    # heads and tails: the counts of a phrase's first 1, 2, ... words and of its last 1, 2, ... words
    known = levels[0].select("id", "lang", F.array("word").alias("words"), F.array("f").alias("heads"),
                             F.array("f").alias("tails"))
    found = []
    for words, level in enumerate(levels[1:], 2):
        x = known.select(F.col("id").alias("x"), "lang", F.col("words").alias("xw"), "heads")
        y = known.select(F.col("id").alias("y"), F.element_at("words", -1).alias("last"), "tails")
        phrases = level.join(x, "x").join(y, "y").select(
            "id", "f", "lang", F.array_append("xw", F.col("last")).alias("words"),
            F.array_append("heads", F.col("f")).alias("heads"), F.array_append("tails", F.col("f")).alias("tails"))
        kept = phrases
        if words < longest:
            known = materialize(phrases, "phrases")
            longer = levels[words]
            around = (longer.select(F.col("x").alias("id"), F.col("f").alias("longer"))
                      .unionAll(longer.select("y", "f")).groupBy("id").agg(F.max("longer").alias("longer")))
            exact = lambda c, by: F.col(c).cast("decimal(19,0)") * F.lit(by)
            kept = known.join(around, "id", "left").filter(
                F.col("longer").isNull() | (exact("longer", INSIDE[0]) < exact("f", INSIDE[1])))
        found.append(kept.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"),
                                 F.expr(_cut(words)).alias("cut")))
    every = found[0]
    for f in found[1:]:
        every = every.unionAll(f)
    every = every.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                             "n", "score")


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)),
freq AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, k AS m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM freq WHERE k >= 2),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, h.f AS l, t.f AS r, (2000000::HUGEINT * c.a) // (h.f::HUGEINT + t.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c
  JOIN freq h ON h.lang = c.lang AND h.phrase = array_to_string(c.ws[1:c.k], ' ')
  JOIN freq t ON t.lang = c.lang AND t.phrase = array_to_string(c.ws[c.k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT lang, array_to_string(ws[i:i + n - 1], ' ') AS phrase, a AS longer
  FROM (SELECT *, unnest(range(1, m)) AS i FROM (SELECT *, unnest(range(2, m)) AS n FROM cand)) WHERE i + n - 1 <= m),
dropped AS (
  SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inside s ON s.lang = c.lang AND s.phrase = c.phrase
  WHERE 100::HUGEINT * s.longer >= 80::HUGEINT * c.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM lowest ANTI JOIN dropped USING (lang, phrase))
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
