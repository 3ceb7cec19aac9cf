"""Schema checks, key and range gates, stage reports and distribution guards.

Every gate or report is a single aggregate over the table (one pass), and only
a bounded number of example rows ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


# ------------------------------------------------------------------- columns

def normalize_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim, lower-case and turn spaces into ``_`` in every column name."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def schema_diff(df: DataFrame, required: Iterable[str]) -> dict[str, list[str]]:
    """Required columns that ``df`` lacks and columns it has beyond them, by normalised name."""
    have, want = [normalize_name(c) for c in df.columns], list(required)
    return {"absent": [c for c in want if c not in have], "extra": [c for c in have if c not in want]}


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise ``KeyError`` if any required column is absent (P3); extra ones are fine."""
    diff = schema_diff(df, required)
    if diff["absent"]:
        raise KeyError(f"{len(diff['absent'])} column(s) absent: {', '.join(diff['absent'])} "
                       f"(the input has {len(df.columns)} columns)")


# --------------------------------------------------------------------- gates

def gate_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row: for every named predicate, how many rows violate it.

    A check is a boolean Column that must hold; NULL counts as a violation.
    """
    return df.agg(*[F.sum(F.when(F.coalesce(c, F.lit(False)), 0).otherwise(1)).cast("bigint").alias(n)
                    for n, c in checks.items()])


def enforce(df: DataFrame, checks: dict[str, Column], key: str | None = None, examples: int = 5) -> None:
    """Raise with counts and up to ``examples`` offending keys when any check fails."""
    row = gate_counts(df, checks).collect()[0].asDict()
    bad = {n: v for n, v in row.items() if v}
    if not bad:
        return
    detail = {}
    if key is not None:
        for n in bad:
            ok = F.coalesce(checks[n], F.lit(False))
            detail[n] = [r[0] for r in df.filter(~ok).select(key).limit(examples).collect()]
    raise ValueError(f"gate failed: {bad}; examples: {detail}")


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys with more than one row and their counts."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def uniqueness(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: total rows, distinct keys, duplicated rows (rows - distinct)."""
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(F.sum("__n").cast("bigint").alias("n_rows"),
                       F.count(F.lit(1)).cast("bigint").alias("n_keys")) \
                  .withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))


def require_unique(df: DataFrame, key: str | Sequence[str], examples: int = 5) -> None:
    r = uniqueness(df, key).collect()[0]
    if r.n_duplicates:
        ex = duplicate_keys(df, key).orderBy(F.col("n_rows").desc()).limit(examples).collect()
        raise ValueError(f"found {r.n_duplicates} duplicate key rows (rows {r.n_rows}, unique {r.n_keys}); "
                         f"examples: {[tuple(x) for x in ex]}")


# ------------------------------------------------------------------- reports

def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Value counts and their share of all rows (A3, A4); NULL is a value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("__total"))
    return (counts.crossJoin(F.broadcast(total))
                  .withColumn("share", F.col("n") / F.col("__total")).drop("__total"))


def null_shares(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL count and share, one pass, one row per column."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.sum(F.col(c).isNull().cast("int")).alias(f"__null_{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', CAST(`__null_{i}` AS BIGINT)" for i, c in enumerate(cols))
    return (one.selectExpr(f"stack({len(cols)}, {stack}) AS (column, n_null)", "__n AS n_rows")
               .withColumn("null_share", F.col("n_null") / F.col("n_rows")))


def group_null_ratio(df: DataFrame, group: str, value: str, top: int = 5) -> DataFrame:
    """Share of NULL ``value`` per group, non-zero only, highest ``top`` (A5, O3)."""
    return (df.groupBy(group)
              .agg((F.sum(F.col(value).isNull().cast("int")) / F.count(F.lit(1))).alias("null_ratio"))
              .filter(F.col("null_ratio") > 0)
              .orderBy(F.col("null_ratio").desc(), F.col(group))
              .limit(top))


def distinct_counts(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row: for each name the number of distinct non-NULL values of its column.

    Every column is grouped by itself, with partial aggregation; several DISTINCT aggregates in
    one pass would copy each row once a column. ``df`` is read once a column, one column at a
    time: give a table, or a frame that was written.
    """
    parts = [df.select(F.col(c)).distinct().agg(F.count(c).alias("n")).select(F.lit(name).alias("name"), "n")
             for name, c in columns.items()]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in columns])


def report_with_distinct(df: DataFrame, distinct: Mapping[str, str], *aggregates: Column) -> DataFrame:
    """One row of ``aggregates`` over ``df``, with the distinct counts of ``distinct`` beside them."""
    return df.agg(*aggregates).crossJoin(distinct_counts(df, distinct))  # one row each


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = 14) -> DataFrame:
    """A mergeable sketch per column (and group ``by``): 2^``size`` registers, relative error
    about 0.65 / sqrt(2^size), 0.5 % for 14. Sketches of parts add up by ``sketch_counts``."""
    # a sketch takes integers, text and binary; other types go by their text
    value = {c: F.col(c) if df.schema[c].dataType.typeName() in ("long", "integer", "string", "binary")
             else F.col(c).cast("string") for c in columns}
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(value[c], size).alias(c) for c in columns])


def sketch_counts(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct counts of all groups of ``distinct_sketches`` taken together, or per ``by``."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def share_guard(df: DataFrame, col: str, max_share: float = 0.6, min_share: float = 0.02) -> DataFrame:
    """Category-share guard (A25): per value its share and whether it is within bounds."""
    return value_shares(df, col).withColumn(
        "within_bounds", (F.col("share") <= max_share) & (F.col("share") >= min_share))


def spread_per_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Distinct ``value`` count per ``group``, and the share of groups with only one value."""
    per = df.groupBy(group).agg(F.count_distinct(value).alias("n_distinct"))
    return per.agg(F.count(F.lit(1)).alias("n_groups"),
                   (F.sum((F.col("n_distinct") == 1).cast("int")) / F.count(F.lit(1))).alias("single_value_share"),
                   F.avg("n_distinct").alias("mean_distinct"))


def completeness(df: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows present vs rows expected from a spine (A26): one row with both counts and the ratio."""
    have = df.agg(F.count(F.lit(1)).alias("n_rows"))
    want = expected.agg(F.count(F.lit(1)).alias("n_expected"))
    return have.crossJoin(want).withColumn("ratio", F.col("n_rows") / F.col("n_expected"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
