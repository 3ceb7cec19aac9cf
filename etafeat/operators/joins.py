"""Join helpers: suffixing, key gates. Join strategies are left to the planner and AQE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left",
                   suffix: str = "") -> DataFrame:
    """Fact ⟕ dimension; right-hand columns that clash get ``suffix`` (or are dropped).

    With an empty suffix a clashing right column is dropped, which is the same
    as keeping the first of two duplicated names.
    """
    keys = [on] if isinstance(on, str) else list(on)
    clash = [c for c in dim.columns if c in fact.columns and c not in keys]
    if suffix:
        dim = dim.withColumnsRenamed({c: f"{c}{suffix}" for c in clash})
    else:
        dim = dim.drop(*clash)
    dup = [c for c in dim.columns if c in fact.columns and c not in keys]
    dim = dim.drop(*dup)
    return fact.join(dim, keys, how)


def first_of_duplicates(df: DataFrame) -> DataFrame:
    """Keep the first column of every duplicated name (by position)."""
    seen, idx = set(), []
    for i, c in enumerate(df.columns):
        if c not in seen:
            seen.add(c)
            idx.append(i)
    if len(idx) == len(df.columns):
        return df
    renamed = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
    return renamed.select(*[F.col(f"__c{i}").alias(df.columns[i]) for i in idx])


def missing_keys(df: DataFrame, key: str, known: DataFrame, known_key: str | None = None) -> DataFrame:
    """Distinct keys of ``df`` absent from ``known`` (left anti join)."""
    kk = known_key or key
    right = known.select(F.col(kk).alias(key)).distinct()
    return df.select(key).distinct().join(right, key, "left_anti")


def require_known(df: DataFrame, key: str, known: DataFrame, known_key: str | None = None,
                  what: str = "key", examples: int = 5) -> None:
    """Fail fast when ``df`` has keys missing from ``known``; the error names them."""
    bad = missing_keys(df, key, known, known_key).filter(F.col(key).isNotNull())
    sample = [r[0] for r in bad.orderBy(key).limit(examples).collect()]
    if sample:
        raise ValueError(f"unknown {what}: {sample} (add them to the reference table)")


def semi(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def anti(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(other.select(*keys).distinct(), keys, "left_anti")
