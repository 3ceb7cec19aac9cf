"""Time-ordered window operators: trailing windows, target encoding, capacity caps.

Scale notes
-----------
A plain ``OVER (PARTITION BY key ORDER BY ts)`` sends every row of a key to one
task, and a sliding frame is summed again for each row. The ordered operators
here use running sums over range partitions (``ordered.running_sums``):

* trailing sums, counts and means turn each row into ``+v`` after ``t`` and
  ``-v`` after ``t + length``; the value at ``t`` is the running sum of both.
  Linear in the rows; a key that holds all rows spans all partitions;
* target encoding is the same without the expiry;
* where no key holds more rows than a task may (``ordered.even_keys``), both are a
  plain window over the key, and expiries are made where the key's rows have met;
* trailing minima and maxima keep a sliding frame inside (key, time bucket),
  with the last ``length`` of each bucket copied into the next.

All give exactly the answer of the single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etafeat.functions.columns import epoch_micros, floor_hour
from etafeat.operators.ordered import even_keys, running_sums

_HOUR_US = 3_600_000_000


def _micros(length: timedelta | str | int) -> int:
    """``timedelta``, ``"90s"``/``"15m"``/``"3h"``/``"2d"`` or micros -> micros."""
    if isinstance(length, timedelta):
        return int(length.total_seconds() * 1_000_000)
    if isinstance(length, int):
        return length
    units = {"us": 1, "ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": _HOUR_US, "d": 24 * _HOUR_US}
    s = length.strip().lower()
    for u in sorted(units, key=len, reverse=True):
        if s.endswith(u):
            return int(float(s[: -len(u)]) * units[u])
    raise ValueError(f"cannot parse window length {length!r}")


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


# Scales up to this use 64-bit scaled integers; larger ones, and sums over the
# whole table, use DECIMAL(38).
LONG_SCALE_MAX = 3
# Decimals kept of values without a declared scale: half a unit of the last is
# below a double's own rounding for values of one and more.
OPEN_SCALE = 15


def scaled(c: Column | str, scale: int | None) -> Column:
    """Exact integer-like form of a value with at most ``scale`` decimals.

    ``x * 10^scale`` as BIGINT when the scale is small, otherwise DECIMAL; a
    value with more decimals than that fails the job instead of losing them.
    ``None`` keeps the double.
    """
    x = F.col(c) if isinstance(c, str) else c
    if scale is None:
        return x.cast("double")
    shifted = x * F.lit(float(10 ** scale))
    fits = x.isNull() | (F.abs(shifted - F.rint(shifted)) <= F.greatest(F.lit(1e-6), F.abs(shifted) * 1e-12))
    told = F.raise_error(F.concat(F.lit(f"value with more than {scale} decimals: "), x.cast("string")))
    if scale <= LONG_SCALE_MAX:
        return F.when(fits, F.rint(shifted).cast("bigint")).otherwise(told.cast("bigint"))
    return F.when(fits, x.cast(f"decimal(38,{scale})")).otherwise(told.cast(f"decimal(38,{scale})"))


def unscaled(total: Column, scale: int | None) -> Column:
    """Sum of ``scaled`` values back to a double (exact division, correctly rounded)."""
    if scale is None:
        return total.cast("double")
    if scale <= LONG_SCALE_MAX:
        return total.cast("double") / F.lit(float(10 ** scale))
    return total.cast("double")


def exact_sum(c: Column | str, scale: int | None) -> Column:
    """Sum that does not depend on row order when ``scale`` is given, as a double."""
    return unscaled(F.sum(scaled(c, scale)), scale)


def exact_mean(c: Column | str, scale: int | None) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    if scale is None:
        return F.avg(x)
    return exact_sum(x, scale) / F.count(x)


@dataclass(frozen=True)
class Trailing:
    """One trailing feature: ``agg`` of ``value`` over ``[t - length, t)``."""

    out: str
    length: timedelta | str | int
    agg: str = "count"           # count | sum | mean | min | max
    value: str | None = None
    fill: float | None = 0.0     # value for an empty history (None keeps NULL)
    scale: int | None = None     # decimals of ``value`` for exact sums


def trailing_windows(df: DataFrame, key: str | Sequence[str], ts: str,
                     specs: Sequence[Trailing], bucket: timedelta | str | int | None = None,
                     source: DataFrame | None = None) -> DataFrame:
    """Add trailing time-window features over ``[t - length, t)`` per key.

    The start is included; every row at exactly ``t`` (the row itself and its
    ties) is excluded, like pandas ``rolling(length, closed="left")``. A row
    without a time has an empty history and is in nobody's. ``bucket`` only
    concerns minima and maxima. ``source`` is the frame whose keys are counted
    (default ``df``): pass the base fact when ``df`` is an enriched copy of it.
    """
    sums = [s for s in specs if s.agg in ("count", "sum", "mean")]
    frames = [s for s in specs if s.agg in ("min", "max")]
    if len(sums) + len(frames) != len(specs):
        raise ValueError(f"unknown aggregate in {[s.agg for s in specs]}")
    if sums:
        df = _running_windows(df, _keys(key), ts, sums, even_keys(df if source is None else source, _keys(key)))
    return _sliding_windows(df, _keys(key), ts, frames, bucket) if frames else df


def _running_windows(df: DataFrame, keys: list[str], ts: str, specs: Sequence[Trailing], even: bool) -> DataFrame:
    """Trailing counts, sums and means as running sums of arrivals and expiries."""
    lengths = sorted({_micros(s.length) for s in specs})
    measures: dict[tuple, tuple[str, Column, int]] = {}  # (value, scale, length) -> name, contribution, length
    names: dict[str, list[str]] = {}
    for s in specs:
        size = _micros(s.length)
        scale = OPEN_SCALE if s.scale is None else s.scale
        wanted = []
        if s.agg != "sum":
            one = F.lit(1).cast("bigint") if s.value is None else F.col(s.value).isNotNull().cast("bigint")
            wanted.append((("n", s.value, size), one))
        if s.agg != "count":
            v = F.col(s.value).cast(f"decimal(38,{scale})") if s.scale is None else scaled(s.value, scale)
            wanted.append((("s", s.value, scale, size), v))
            if s.agg == "sum":
                wanted.insert(0, (("n", s.value, size), F.col(s.value).isNotNull().cast("bigint")))
        for k, c in wanted:
            measures.setdefault(k, (f"__m{len(measures)}", c, size))
        names[s.out] = [measures[k][0] for k, _ in wanted]

    # one row for the arrival, one for each length's expiry; the two cancel out of every sum
    steps = F.array(F.lit(0).cast("bigint"), *[F.lit(n).cast("bigint") for n in lengths])
    own = F.col("__step") == 0
    keep = set(keys)
    moved = {m: F.when(own & F.col("__t0").isNotNull(), F.col(m)).when(F.col("__step") == n, -F.col(m)).alias(m)
             for m, _, n in measures.values()}
    met = df.repartition(*keys) if even else df  # expiries of even keys are made after the exchange
    x = met.withColumn("__t0", epoch_micros(ts)).withColumns({m: c for m, c, _ in measures.values()})
    x = x.withColumn("__step", F.explode(F.when(F.col("__t0").isNull(), F.slice(steps, 1, 1)).otherwise(steps)))
    x = x.select(*[F.col(c) if c in keep else F.when(own, F.col(c)).alias(c) for c in df.columns], own.alias("__own"),
                 (F.col("__t0") + F.col("__step")).alias("__t"), *moved.values())
    got = running_sums(x, keys, ["__t"], {m: F.col(m) for m in moved}, even=even).filter("__own")
    total = {m: F.when(F.col("__t").isNotNull(), F.coalesce(F.col(m), F.lit(0))) for m in moved}
    cols = []
    for s in specs:
        scale = OPEN_SCALE if s.scale is None else s.scale
        n = F.coalesce(total[names[s.out][0]], F.lit(0))
        if s.agg == "count":
            e = n if s.fill is not None else F.when(n > 0, n)
            e = e.cast("bigint")
        else:
            e = unscaled(total[names[s.out][1]], scale)
            e = F.when(n > 0, e / n if s.agg == "mean" else e)
            if s.fill is not None:
                e = F.coalesce(e, F.lit(s.fill).cast("double"))
        cols.append(e.alias(s.out))
    return got.select(*[F.col(c) for c in df.columns if c not in names], *cols)


def _sliding_windows(df: DataFrame, keys: list[str], ts: str, specs: Sequence[Trailing], bucket) -> DataFrame:
    """Trailing minima and maxima; all specs share one shuffle on (key, bucket)."""
    longest = max(_micros(s.length) for s in specs)
    b_us = max(longest, _micros(bucket)) if bucket is not None else 4 * longest
    values = sorted({s.value for s in specs})
    t = F.col("__t")
    x = df.withColumn("__t", epoch_micros(ts)).withColumn("__b0", F.floor(t / F.lit(b_us)))
    # Rows in the last ``longest`` of their bucket are also emitted into the next
    # bucket as context rows, which keep only what the frames need.
    tail = t >= (F.col("__b0") + 1) * F.lit(b_us) - F.lit(longest)
    x = x.withColumn("__shift", F.explode(F.when(tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    own = F.col("__shift") == 0
    keep = set(keys) | set(values)
    both = x.select(*[F.col(c) if c in keep else F.when(own, F.col(c)).alias(c) for c in df.columns],
                    "__t", (F.col("__b0") + F.col("__shift")).alias("__b"), own.alias("__own"))
    base = Window.partitionBy(*keys, "__b").orderBy("__t")
    cols = {}
    for s in specs:
        e = getattr(F, s.agg)(s.value).over(base.rangeBetween(-_micros(s.length), -1))
        cols[s.out] = e if s.fill is None else F.coalesce(e, F.lit(s.fill).cast("double"))
    return both.withColumns(cols).filter("__own").drop("__t", "__b", "__own")


def target_encode(df: DataFrame, key: str | Sequence[str], target: str, ts: str,
                  order_id: str, out: str, ties: str = "rows", prior: float | str = "global",
                  scale: int | None = None, bucket: timedelta | str | int | None = None,
                  history: DataFrame | None = None) -> DataFrame:
    """Leakage-aware target encoding: mean target of the same key's earlier rows.

    ``ties="rows"``: earlier in ``(ts, order_id)`` order (a unique order).
    ``ties="strict"``: only strictly earlier timestamps (no same-time leakage).
    Empty history gets ``prior``: ``"global"`` (mean target of all rows) or a number.
    ``bucket`` is of no effect any more. ``history`` is the frame the global prior comes from
    and whose keys are counted (default ``df``): pass the base fact when ``df`` is an enriched copy of it.
    """
    if ties not in ("rows", "strict"):
        raise ValueError("ties must be 'rows' or 'strict'")
    timed = F.col("__t").isNotNull()  # a row without a time is in nobody's history, and has none
    order = ["__t"] if ties == "strict" else ["__t", order_id]
    v = scaled(target, scale)
    rows = df if history is None else history
    got = running_sums(df.withColumn("__t", epoch_micros(ts)), _keys(key), order,
                       {"__s": F.when(timed, v), "__c": F.when(timed, F.col(target).isNotNull().cast("bigint"))},
                       peers=ties == "strict", even=even_keys(rows, _keys(key)))
    mean = F.when((F.col("__c") > 0) & timed, unscaled(F.col("__s"), scale) / F.col("__c"))
    if prior == "global":
        whole = F.sum(v if scale is None else v.cast(
            f"decimal(38,{0 if scale <= LONG_SCALE_MAX else scale})"))  # no 64-bit sum over all rows
        got = got.crossJoin(F.broadcast(rows.agg((unscaled(whole, scale) / F.count(target)).alias("__prior"))))  # one row
        fill = F.col("__prior")
    else:
        fill = F.lit(float(prior))
    return got.withColumn(out, F.coalesce(mean, fill)).drop("__t", "__s", "__c", "__prior")


def cap_per_hour(df: DataFrame, entity: str | Sequence[str], ts: str, order: Sequence[str | Column],
                 n: int, hour_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per (entity, hour of ``ts``) in ``order``.

    ``row_number() <= n`` lets Spark apply a group limit before the shuffle,
    so a hot (entity, hour) never ships more than ``n`` rows per map task.
    """
    keys = _keys(entity)
    hour = floor_hour(ts)
    w = Window.partitionBy(*keys, hour).orderBy(*order)
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")
    return out.withColumn(hour_col, hour) if hour_col else out


def share_of_group(df: DataFrame, value: str, group: str | Sequence[str] | None, out: str) -> DataFrame:
    """``value / sum(value)`` within ``group`` (or overall) on an aggregated table."""
    if group is None:
        total = df.agg(F.sum(value).alias("__tot"))
        return df.crossJoin(F.broadcast(total)).withColumn(out, F.col(value) / F.col("__tot")).drop("__tot")
    w = Window.partitionBy(*_keys(group))
    return df.withColumn(out, F.col(value) / F.sum(value).over(w))


def rank_limit(df: DataFrame, group: str | Sequence[str], order: Sequence[str | Column], k: int,
               rank_col: str | None = None) -> DataFrame:
    """Top-``k`` rows per group (``row_number() <= k``; a group limit runs map-side)."""
    w = Window.partitionBy(*_keys(group)).orderBy(*order)
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    return out.withColumnRenamed("__rn", rank_col) if rank_col else out.drop("__rn")
