"""Line dedup (operator 8, DataFrame functions only).

Every line of at least ``min_chars`` characters that occurs in two documents or
more stays only in the first of them. Line keys are 128-bit hashes, parsed once
and written, then range partitioned by (key, document, position): a key that a
third of all rows share spans as many range partitions as it needs, and no task
holds it whole. Inside the sorted partitions a sort aggregate streams over the
rows, one key in memory at a time, and leaves a first occurrence per key and
partition; only those meet again, so that a key which runs over the edge of a
partition has one first. The result is a bitmap per document, not text: 64 lines
a word, as far as the last word with a dropped line.

Defined results: a NULL or empty text is one empty line. Rows that share
``doc_id`` are one document (a line cannot be dropped in favour of another row
of the same document). Rows with a NULL ``doc_id`` count as one document that
comes after all others. An empty table gives an empty result. A very long text is
split and joined in linear time. Input columns other than the two named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm.common import SPACES, lower_ascii, materialize, table

LAST_DOC = (1 << 63) - 1
SORTED = "spark.sql.execution.replaceHashWithSortAgg"  # aggregate sorted input without a hash table


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(h1, h2, doc, row, pos) of every line whose key has ``min_chars`` code points."""
    text = F.coalesce("text", F.lit(""))
    lines = docs.select(F.coalesce("doc_id", F.lit(LAST_DOC)).alias("doc"), F.xxhash64(text).alias("row"),
                        F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    key = lower_ascii(F.btrim("line", F.lit(SPACES)))
    return (lines.select("doc", "row", "pos", key.alias("key")).filter(F.char_length("key") >= min_chars)
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"), "doc", "row", "pos"))


def first_lines(lines: DataFrame) -> DataFrame:
    """(h1, h2, first): the first document of every key that two documents or more hold.

    With ``SORTED`` set, Spark aggregates the sorted partitions as a stream. The order
    matters to ``min_by``, not to ``min``: for that alone the sort would be left out.
    """
    order = ["h1", "h2", "doc", "pos"]
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    return (ordered.groupBy("h1", "h2").agg(F.min_by("doc", "doc").alias("first"), F.max("doc").alias("last"))
            .filter("first < last").select("h1", "h2", "first"))


def _write_first_lines(lines: DataFrame) -> DataFrame:
    conf = lines.sparkSession.conf
    was = conf.get(SORTED)
    conf.set(SORTED, "true")
    try:
        return materialize(first_lines(lines), "first-lines")
    finally:
        conf.set(SORTED, was)


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc, row, keep): documents that lose lines, with their keep bitmap.

    Element ``i div 64`` of ``keep`` holds the keep bits of line ``i`` and its
    neighbours; lines after the last element stay. ``row`` is the hash of the row's text.
    """
    lines = materialize(line_keys(docs, min_chars), "lines")
    first = _write_first_lines(lines)  # a table of its own, so that AQE can split hot keys in the join
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = (lines.join(first, ["h1", "h2"]).filter("doc > first")
             .groupBy("doc", "row", F.expr("pos div 64").cast("int").alias("word"))
             .agg(F.bitwise_not(F.bit_or(bit)).alias("bits")))
    words = words.groupBy("doc", "row").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))

    def filled(w: Column, i: Column) -> Column:  # with words that keep all their lines before it
        before = F.coalesce(F.get("words", i - 1)["word"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(-1).cast("long"), w["word"] - before - 1), F.array(w["bits"]))

    return words.select("doc", "row", F.flatten(F.transform("words", filled)).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``; its other columns are
    unchanged, and input columns of these three names are replaced."""
    own = [F.col(f"d.`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    text = F.coalesce(F.col("d.text"), F.lit(""))
    got = docs.alias("d").join(
        bitmaps.alias("b"), (F.coalesce("d.doc_id", F.lit(LAST_DOC)) == F.col("b.doc"))
        & (F.xxhash64(text) == F.col("b.row")), "left")
    lines = _lines(F.col("d.text"))
    kept = F.filter(lines, lambda _, i: F.coalesce(
        F.get(F.col("b.keep"), F.shiftright(i, 6)), F.lit(-1)).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("long"), i % 64)) != 0)
    n_dropped = F.coalesce(F.aggregate("b.keep", F.lit(0).cast("long"),
                                       lambda s, x: s + F.bit_count(F.bitwise_not(x))), F.lit(0))
    return got.select(*own, F.size(lines).cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"),
                      F.when(F.col("b.keep").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("kept_text"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_bitmaps(docs, keep_bitmaps(docs)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without the lines an earlier document already holds."""
    got = apply_bitmaps(docs, keep_bitmaps(docs))
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return got.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keys AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
firsts AS (
  SELECT k, min(doc_id) AS first FROM keys WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT keys.*, coalesce(doc_id > first, false) AS dropped FROM keys LEFT JOIN firsts USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
