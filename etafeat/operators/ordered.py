"""Ordered work over hot keys: running sums, dense numbers and exact quantiles.

A window over a key holds all rows of the key in one task. Here rows are range
partitioned by (key, order) instead, so a key that holds all rows spans all
partitions: each partition's share of a key is summed on its own, and what the
key's earlier partitions hold is carried to it as an offset. Three steps:

1. ``deal``: range partition and write, with the partition's number. The written
   table fixes which row is where, whatever is lost or run again later;
2. totals per (key, partition): at most one row per key and partition it spans;
3. running totals of those, as one row more at the head of each (key, partition),
   and one window inside it over both: one exchange, no join.

Rows that are equal in (key, order) are in one partition: peers are never split.

Where ``even_keys`` finds that no key holds more rows than a task may, none of this
is needed: one plain window over the key, one exchange, nothing written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etafeat.functions.columns import round_half_even
from etafeat.session import materialize

_PART = "__part"
FEW = 250_000      # rows of one key that a task may hold in any case
BUCKETS = 65_536   # keys are counted by hash first, so that counting shuffles a bounded table


def deal(df: DataFrame, by: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """``df`` as a written table in ``parts`` ranges of ``by``, numbered by ``__part``.

    ``parts`` defaults to the session's shuffle partitions.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *by).withColumn(_PART, F.spark_partition_id()), "dealt")


def even_keys(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> bool:
    """Whether no key holds more rows than a task's fair share of ``df`` (or than ``FEW``, if that is more)."""
    if not keys:
        return False
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    sizes = df.groupBy(bucket.alias("b")).count()
    large = F.collect_list(F.when(F.col("count") > FEW, F.struct("b", "count")))
    seen = sizes.agg(F.sum("count").alias("rows"), large.alias("large")).first()
    limit = max(FEW, (seen.rows or 0) // n)
    full = [r.b for r in seen.large if r["count"] > limit]  # fewer than ``n``
    if not full:
        return True
    return df.filter(bucket.isin(full)).groupBy(*keys).count().filter(F.col("count") > limit).isEmpty()


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
    return on


def carry(dealt: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """(keys, __part, name...): what a key's earlier partitions hold in all, one row per (key, partition)."""
    totals = dealt.groupBy(*keys, _PART).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, _PART, *[F.sum(name).over(earlier).alias(name) for name in sums])


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column],
                 peers: bool = True, parts: int | None = None, even: bool = False) -> DataFrame:
    """``df`` with a running sum under each name of ``sums``, over the key's earlier rows.

    ``peers``: ``order`` is one integer column, and rows that are equal in it have the same
    sum, of all rows strictly before them; otherwise ``order`` must be unique in the key and
    each row follows the one before it. Sums are NULL where nothing came before. Exact if the summed type is.
    ``even``: no key is too large for one task (``even_keys``), so that a plain window does.
    """
    own = {f"__own_{name}": c for name, c in sums.items()}
    kept = [c for c in df.columns if c not in sums]
    if even:
        whole = Window.partitionBy(*keys).orderBy(*order)
        before = (whole.rangeBetween if peers else whole.rowsBetween)(Window.unboundedPreceding, -1)
        return df.select(*[F.col(f"`{c}`") for c in kept], *[F.sum(c).over(before).alias(name) for name, c in sums.items()])
    dealt = deal(df.withColumns(own).select(*[F.col(f"`{c}`") for c in kept], *own), [*keys, *order], parts)
    offsets = carry(dealt, keys, {f"__off_{name}": F.col(f"__own_{name}") for name in sums})
    offsets = offsets.filter(reduce(or_, [F.col(f"__off_{name}").isNotNull() for name in sums]))
    # an offset's row has no order value and sorts first; rows without one are in a key's first partition, which has no offset
    rows = dealt.withColumn("__row", F.lit(1)).unionByName(offsets.withColumn("__row", F.lit(0)), allowMissingColumns=True)
    inside = Window.partitionBy(*keys, _PART).orderBy(*(order if peers else ["__row", *order]))
    before = (inside.rangeBetween if peers else inside.rowsBetween)(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"__in_{name}": F.sum(f"__own_{name}").over(before) for name in sums}
                            | {f"__at_{name}": F.max(f"__off_{name}").over(before) for name in sums}).filter("__row = 1")
    both = [F.when(F.col(f"__in_{n}").isNotNull() | F.col(f"__at_{n}").isNotNull(),
                   F.coalesce(F.col(f"__in_{n}"), F.lit(0)) + F.coalesce(F.col(f"__at_{n}"), F.lit(0))).alias(n)
            for n in sums]
    return rows.select(*[F.col(f"`{c}`") for c in kept], *both)


def dense_ids(df: DataFrame, order: Sequence[str | Column], name: str, start: int = 0,
              parts: int | None = None) -> DataFrame:
    """``df`` with gapless numbers from ``start`` in ``order``, which must be unique.

    Only one row per partition meets in one place; the rows are numbered where they are.
    """
    dealt = deal(df, order, parts)
    before = carry(dealt, [], {"__before": F.lit(1)})
    inside = F.row_number().over(Window.partitionBy(_PART).orderBy(*order))
    number = F.coalesce("__before", F.lit(0)) + inside + F.lit(start - 1)
    return dealt.join(before, _PART).withColumn(name, number.cast("bigint")).select(*df.columns, name)


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, float],
                    parts: int | None = None) -> DataFrame:
    """Exact quantiles (linear interpolation) per group: (keys, name...), one row for each group of ``df``.

    Rows are counted per (group, value) first, map-side too; the counts' running
    sums then say which values hold the wanted ranks. No task or buffer holds a
    group, one path at every size. A group without a value has NULL; NaN counts as
    the largest value.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_sums(counts, keys, [value], {"__before": F.col("__n")}, peers=False, parts=parts)
    size = ranked.groupBy(*keys).agg(F.sum("__n").alias("__size"))
    before = F.coalesce("__before", F.lit(0))
    held = lambda rank: F.max(F.when((before <= rank) & (rank < before + F.col("__n")), F.col(f"r.`{value}`")))
    pos = {name: (F.col("__size") - 1) * F.lit(float(q)) for name, q in wanted.items()}
    found = (ranked.alias("r").join(size.alias("s"), _same("r", "s", keys))
             .groupBy(*[F.col(f"r.`{k}`").alias(k) for k in keys], "__size")
             .agg(*[held(end(p)).alias(f"__{side}_{name}") for name, p in pos.items()
                    for side, end in (("lo", F.floor), ("hi", F.ceil))]))

    def between(name: str) -> Column:
        p, lo, hi = pos[name], F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        return F.when(lo == hi, lo).otherwise((F.ceil(p) - p) * lo + (p - F.floor(p)) * hi).alias(f"__q_{name}")

    found = found.select(*keys, *[between(name) for name in wanted])
    return (df.select(*keys).distinct().alias("g").join(found.alias("f"), _same("g", "f", keys), "left")
            .select(*[F.col(f"g.`{k}`") for k in keys], *[F.col(f"__q_{name}").alias(name) for name in wanted]))


def group_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float, name: str,
                   parts: int | None = None) -> DataFrame:
    """One quantile per group, see ``group_quantiles``."""
    return group_quantiles(df, keys, value, {name: q}, parts)


def group_median(df: DataFrame, keys: str | Sequence[str], value: str, name: str = "__median", digits: int = 6) -> DataFrame:
    """Exact median per group, rounded to ``digits``."""
    by = [keys] if isinstance(keys, str) else list(keys)
    found = group_quantile(df, by, value, 0.5, name)
    return found.withColumn(name, round_half_even(name, digits))
