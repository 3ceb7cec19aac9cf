"""Mixing sources to target weights (operator 7).

Sizes are words. Each source gets a target (see ``targets``); a source is taken
whole as often as its target holds it, and the rest of the target is filled by
the documents whose hash lies below the source's threshold. Thresholds come
from histograms of words by (source, hash bucket): one pass of 1024 buckets
finds the bucket in which the budget ends, and only that bucket is refined, ten
bits a pass, until it holds one hash value. Nothing is sorted, a histogram has
at most 1024 rows a source however many documents it has, and a larger budget
always takes a superset of what a smaller one takes.

The hash covers id and text. Where the budget ends among rows that are equal in
both, the same descent runs over those rows' numbers in the written table, so that
as many of them are taken as come nearest to the target, however many there are.

Defined results: a NULL or empty text has size 0. A NULL source is a source of
its own, after all others. A document is taken whole or not, a very long one too.
Of equal rows any may be the ones that are taken; how many does not depend on the
run. An empty table gives an empty result. Only ``doc_id``, ``source`` and ``text``
are read; other columns, whatever their names, reach the stage's result unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from etafeat.llm.common import SPACES, materialize, table

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2  # of all words in the mix; times a source or document may repeat
BITS, STEP = 60, 10


def n_words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def row_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Sixty bits of the row's id and text."""
    text = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("\x1f"),
                    F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target), a row per source.

    Sources in code point order, NULL last, weigh ``weights`` in turn and share
    ``share`` times all words by weight; none gets more than ``most`` times its
    size, and what that leaves goes to the others by weight. That is
    ``min(most * size, level * weight)`` with one level for all: ordered by
    size/weight, it is what remains after the sources that reach their cap.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights) + 1)
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * most)
    upto = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    left = (F.sum("source_size").over(every).cast("double") * share - F.sum("cap").over(upto) + F.col("cap"))
    level = left / (F.sum("weight").over(every) - F.sum("weight").over(upto) + F.col("weight"))
    per = per.withColumn("level", level)
    level = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(every)
    return per.withColumn("level", level).select(
        "source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def boundary(rows: DataFrame, budgets: DataFrame, key: str) -> DataFrame:
    """(source, below, left): rows of ``rows`` (source, size, ``key``) with a key under
    ``below`` are within the source's budget, and ``left`` of it remains for the rows at
    ``below`` itself. ``budgets`` is (source, rest); a budget of 0 or less takes nothing.
    """
    cut = budgets.select("source", "rest", F.lit(0).cast("long").alias("prefix"),
                         F.when(F.col("rest") <= 0, F.lit(0).cast("long")).alias("below"), F.lit(0.0).alias("left"))
    for shift in range(BITS - STEP, -1, -STEP):
        # of each source that is open still: its boundary bucket, dealt into 1024
        todo = cut.filter("below is null").select(F.col("source").alias("s"), "prefix", "rest")
        inside = rows.select("source", "size", F.col(key).alias("key")).join(
            todo, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("key", shift + STEP) == F.col("prefix")))
        by = (inside.groupBy("s", "rest", F.shiftright("key", shift).alias("at"))
              .agg(F.sum("size").alias("words"), F.min("key").alias("least"), F.max("key").alias("most")))
        upto = F.sum("words").over(Window.partitionBy("s").orderBy("at"))
        ends = (by.withColumn("over", F.col("rest") - (upto - F.col("words")))
                .filter("over >= 0 and over < words")
                .select("s", "at", "over", F.when(F.col("least") == F.col("most"), F.col("least")).alias("one")))
        full = F.shiftleft(F.col("prefix") + 1, shift + STEP)  # all of the bucket fits
        cut = materialize(cut.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", F.coalesce("over", "rest").alias("rest"), F.coalesce("at", "prefix").alias("prefix"),
            F.coalesce("below", F.when(F.col("at").isNull(), full).otherwise(F.col("one"))).alias("below"),
            F.coalesce("over", "left").alias("left")), "cuts")
        if cut.filter("below is null").isEmpty():
            break
    return cut.select("source", "below", "left")


def thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, whole, below, upto): how often each source is taken whole; once more go the
    rows whose hash is under ``below``, and of those at ``below`` the ones numbered under ``upto``."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    cuts = boundary(sized, plan, "h").select(F.col("source").alias("c_source"), "below", "left")
    here = F.col("source").eqNullSafe(F.col("c_source"))
    equal = materialize(sized.join(cuts.filter("left > 0"), here & (F.col("h") == F.col("below"))).select(
        "source", "size", "number"), "equal")
    ends = boundary(equal, cuts.filter("left > 0").select(F.col("c_source").alias("source"), F.col("left").alias("rest")), "number")
    last = equal.select(F.col("source").alias("e_source"), "size", "number")
    # the row in which the budget ends: in if that comes nearer to the budget
    ends = ends.join(last, F.col("source").eqNullSafe(F.col("e_source")) & (F.col("number") == F.col("below")), "left").select(
        F.col("source").alias("e_source"), (F.col("below") + F.coalesce(2 * F.col("left") >= F.col("size"), F.lit(False)).cast("long")).alias("upto"))
    return (plan.join(cuts, here).join(ends, F.col("source").eqNullSafe(F.col("e_source")), "left")
            .select("source", "whole", "below", F.coalesce("upto", F.lit(0)).alias("upto")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
        carried: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, h, size, source_size, target, taken): a row per row of ``docs``, with its
    columns ``carried`` in a struct ``row`` if any are named."""
    row = [F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row")] if carried else []
    sized = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), row_hash().alias("h"),
                                    F.monotonically_increasing_id().alias("number"), *row), "sized")
    plan = materialize(targets(sized, weights, share, most), "targets")
    cuts = thresholds(sized, plan)
    per = plan.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        "s", "source_size", "target", "whole", "below", "upto")
    per = materialize(per, "per-source")  # of known size, so that Spark need not deal all rows by source
    more = (F.col("h") < F.col("below")) | ((F.col("h") == F.col("below")) & (F.col("number") < F.col("upto")))
    return sized.join(per, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "h", "size", "source_size", "target",
        (F.col("size") * (F.col("whole") + more.cast("long"))).alias("taken"), *(["row"] if carried else []))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents the mix takes, with ``copies`` (how often) and
    ``taken`` (words). An input column of either name is replaced."""
    own = [c for c in docs.columns if c not in ("copies", "taken")]
    return mix(docs, carried=own).filter("taken > 0").select(
        *[F.col(f"row.`{c}`") for c in own], F.expr("taken div size").alias("copies"), "taken")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')), 1, 15) AS h FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source),
level AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - sum(source_size * 2.0::DOUBLE) OVER w + source_size * 2.0::DOUBLE)
           / (sum(weight) OVER () - sum(weight) OVER w + weight) AS lv
  FROM per WINDOW w AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
plan AS (
  SELECT source, source_size,
         least(cap, max(CASE WHEN lv <= cap / weight THEN lv END) OVER () * weight) AS target FROM level),
rest AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM plan),
ranked AS (
  SELECT s.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h ROWS UNBOUNDED PRECEDING) - s.size AS before
  FROM sized s JOIN rest p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN rest > 0 AND before <= rest AND 2 * (rest - before) >= size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked
"""
