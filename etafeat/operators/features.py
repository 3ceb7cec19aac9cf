"""Feature-matrix operators.

Profiles are grouped aggregates joined back on the key: partial aggregation
handles hot keys, and AQE splits a skewed join partition. Sums use exact
decimals when the value has a known number of decimals, so the result does not
depend on partitioning or row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from etafeat import config
from etafeat.functions.columns import (cyclical, epoch_micros, hour_in, parse_route,
                                       round_half_even)
from etafeat.operators.joins import join_dimension
from etafeat.operators.windows import Trailing, exact_sum, target_encode, trailing_windows

S = config.DEFAULT


# ------------------------------------------------------------ exact aggregates

def dmean(x: Column | str, scale: int | None) -> Column:
    """Mean; with ``scale`` the sum is exact (scaled integers or DECIMAL)."""
    c = F.col(x) if isinstance(x, str) else x
    if scale is None:
        return F.avg(c)
    return exact_sum(c, scale) / F.count(c)


def dstd(x: Column | str, scale: int | None) -> Column:
    """Sample standard deviation; NULL for fewer than two values.

    With ``scale`` the moments are exact: in units of the last decimal, sums of
    values and squares are whole numbers, and so is the sum of squares about the
    whole part m of the mean, S2 - 2 m S1 + n m^2. Only what is left of the mean
    beyond m is corrected in doubles, so large values with a small spread keep it.
    """
    c = F.col(x) if isinstance(x, str) else x
    if scale is None:
        return F.stddev_samp(c)
    whole = "decimal(38,0)"
    d = (c.cast(f"decimal(28,{scale})") * F.lit(10 ** scale).cast("decimal(10,0)")).cast("decimal(28,0)")
    n = F.count(c)
    s1, s2 = F.sum(d).cast(whole), F.sum((d * d).cast(whole)).cast(whole)
    m = F.call_function("div", s1, n.cast("decimal(19,0)")).cast("decimal(19,0)")
    about = s2 - ((m * s1).cast(whole) * 2).cast(whole) + ((m * m).cast(whole) * n.cast("decimal(19,0)")).cast(whole)
    rest = (s1 - (m * n.cast("decimal(19,0)")).cast(whole)).cast("double")
    var = (about.cast("double") - rest * rest / n) / (n - F.lit(1))
    return F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0))) / F.lit(float(10 ** scale)))


def rate(cond: Column) -> Column:
    """Share of rows where ``cond`` holds (NULL counts as false)."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("double") / F.count(F.lit(1))


def first_value(x: str, order: str) -> Column:
    """First non-null ``x`` in ``order`` (pandas ``first`` skips nulls per column)."""
    return F.min_by(F.col(x), F.when(F.col(x).isNotNull(), F.col(order)))


# ------------------------------------------------------------------- temporal

def temporal_features(df: DataFrame, ts: str = "order_created_at",
                      rush_hours: Sequence[int] = config.FEATURE_RUSH_HOURS) -> DataFrame:
    """hour, day_of_week (Mon=0), month, is_weekend, is_rush_hour and sin/cos of hour and weekday."""
    t = F.col(ts)
    df = df.withColumns({
        "hour": F.hour(t),
        "day_of_week": F.weekday(t),
        "month": F.month(t),
    })
    hs, hc = cyclical(F.col("hour"), 24)
    ds, dc = cyclical(F.col("day_of_week"), 7)
    return df.withColumns({
        "is_weekend": (F.col("day_of_week") >= 5).cast("int"),
        "is_rush_hour": hour_in(t, rush_hours).cast("int"),
        "hour_sin": hs, "hour_cos": hc, "day_sin": ds, "day_cos": dc,
    })


# ------------------------------------------------------------------- profiles

@dataclass(frozen=True)
class Scales:
    """Decimals of the fact's measures, for exact sums; None where they are not known
    (a value with more decimals than declared fails the job)."""

    target: int | None = 1
    basket: int | None = 2
    distance: int | None = 2
    traffic: int | None = None


def entity_profile(df: DataFrame, key: str, aggs: dict[str, Column], digits: int | None = 2,
                   source: DataFrame | None = None) -> DataFrame:
    """Grouped profile of ``key``, rounded half-even, joined back (left) onto every row.

    ``source`` is the frame to aggregate (default ``df``): pass the base fact
    when ``df`` is an enriched copy, so the enriched plan is referenced once.
    """
    prof = (source if source is not None else df).groupBy(key).agg(*[e.alias(n) for n, e in aggs.items()])
    if digits is not None:
        prof = prof.select(key, *[
            (round_half_even(n, digits) if isinstance(prof.schema[n].dataType, NumericType)
             and prof.schema[n].dataType.typeName() in ("double", "float") else F.col(n)).alias(n)
            for n in aggs])
    return df.join(prof, key, "left")


def user_profile_aggs(target: str, sc: Scales) -> dict[str, Column]:
    return {
        "user_avg_delivery_time": dmean(target, sc.target),
        "user_std_delivery_time": dstd(target, sc.target),
        "user_order_count": F.count(target),
        "user_avg_basket": dmean("basket_value", sc.basket),
        "user_completion_rate": rate(F.col("order_status") == "completed"),
        "user_avg_distance": dmean("distance_km", sc.distance),
    }


def restaurant_profile_aggs(target: str, ts: str, sc: Scales) -> dict[str, Column]:
    return {
        "rest_avg_delivery_time": dmean(target, sc.target),
        "rest_std_delivery_time": dstd(target, sc.target),
        "rest_completion_rate": rate(F.col("order_status") == "completed"),
        "rest_order_volume": F.count(ts),
        "rest_avg_basket": dmean("basket_value", sc.basket),
    }


def route_profile_aggs(target: str, order: str, sc: Scales) -> dict[str, Column]:
    return {
        "route_avg_traffic": dmean("traffic_level", sc.traffic),
        "route_std_traffic": dstd("traffic_level", sc.traffic),
        "route_historical_delivery_time": dmean(target, sc.target),
        "route_distance": first_value("distance_km", order),
        "route_base_eta": first_value("base_eta_minutes", order),
    }


def check_route_keys(df: DataFrame, key: str = "route_key", examples: int = 5) -> None:
    """Fail when any route key lacks ``_to_``; the error shows up to five of them."""
    bad = df.filter(~F.col(key).contains("_to_")).select(key)
    sample = [r[0] for r in bad.limit(examples).collect()]
    if sample:
        raise ValueError(f"route_key must contain '_to_'; malformed: {sample}")


def route_parts(df: DataFrame, key: str = "route_key") -> DataFrame:
    """Add city (overwritten), origin_area and dest_area parsed from the route key."""
    p = parse_route(key)
    return df.withColumns({"dest_area": p["dest_area"], "city": p["city"], "origin_area": p["origin_area"]})


def interaction_features(df: DataFrame, high_value: float = S.high_value) -> DataFrame:
    return df.withColumns({
        "rush_traffic_interaction": F.col("is_rush_hour") * F.col("traffic_level"),
        "distance_rain_interaction": F.col("distance_km") * F.col("rain"),
        "restaurant_complexity": F.col("rest_order_volume") * F.col("num_items"),
        "traffic_squared": F.pow(F.col("traffic_level"), 2),
        "is_high_value": (F.col("basket_value") > high_value).cast("int"),
    })


def lag_features(df: DataFrame, ts: str, target: str, sc: Scales, source: DataFrame | None = None) -> DataFrame:  # noqa: D401
    """Restaurant orders in the last hour; route mean target (3h) and traffic (2h); empty -> 0."""
    out = trailing_windows(df, "restaurant_id", ts, [Trailing("rest_orders_last_1h", "1h")], source=source)
    return trailing_windows(out, "route_key", ts, [
        Trailing("route_avg_delivery_last_3h", "3h", "mean", target, 0.0, sc.target),
        Trailing("traffic_ma_2h", "2h", "mean", "traffic_level", 0.0, sc.traffic),
    ], source=source)


# ----------------------------------------------------------------- validation

def feature_columns(df: DataFrame, excluded: Sequence[str] = config.NON_FEATURE_COLUMNS) -> list[str]:
    return [c for c in df.columns if c not in set(excluded)]


def numeric_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in cols if isinstance(types[c], NumericType)]


def feature_quality(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One pass: infinite count per numeric feature, target minimum, null share per feature.

    Returns one row per feature: feature, n_inf, null_share, plus target_min.
    """
    num = set(numeric_columns(df, features))
    aggs = [F.min(target).alias("__target_min"), F.count(F.lit(1)).alias("__n")]
    for c in features:
        aggs.append(F.sum(F.col(c).isNull().cast("int")).alias(f"n__{c}"))
        if c in num:
            aggs.append(F.sum((F.abs(F.col(c).cast("double")) == float("inf")).cast("int")).alias(f"i__{c}"))
    one = df.agg(*aggs)
    stack = ", ".join(
        f"'{c}', CAST(`n__{c}` AS BIGINT), CAST({f'`i__{c}`' if c in num else '0'} AS BIGINT)" for c in features)
    return one.selectExpr(f"stack({len(features)}, {stack}) AS (feature, n_null, n_inf)",
                          "__target_min AS target_min", "__n AS n_rows") \
              .withColumn("null_share", F.col("n_null") / F.col("n_rows"))


def validate_features(df: DataFrame, features: Sequence[str], target: str,
                      max_null: float = S.max_null_share, min_target: float = S.min_target) -> dict:
    """Raise on infinities, an impossible target or a feature with too many NULLs."""
    rows = feature_quality(df, features, target).collect()  # one row per feature
    if not rows:
        return {}
    inf = [r.feature for r in rows if r.n_inf]
    if inf:
        raise ValueError(f"infinite values in numeric features: {inf}")
    tmin = rows[0].target_min
    if tmin is not None and tmin < min_target:
        raise ValueError(f"impossible {target}: minimum {tmin} < {min_target}")
    worst = max(rows, key=lambda r: r.null_share)
    if worst.null_share > max_null:
        raise ValueError(f"feature {worst.feature} has {worst.null_share:.1%} missing values")
    return {"checked_numeric": len(numeric_columns(df, features)), "worst_null": worst.feature,
            "worst_null_share": worst.null_share, "target_min": tmin}


# ---------------------------------------------------------------------- split

def exact_quantile(df: DataFrame, x: Column, q: float, buckets: int = 4096) -> float | None:
    """Exact ``q`` quantile of an integer column, with linear interpolation.

    Histogram descent: each pass counts the values of the interval that holds the
    wanted rank in at most ``buckets`` equal parts and goes on in the one where
    it lies, until a part is one value. Six passes cover 64 bits; no task or
    driver sees more than ``buckets`` rows, at any size.
    """
    v = df.select(x.cast("bigint").alias("v")).filter("v is not null")
    head = v.agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not head.n:
        return None
    pos = (head.n - 1) * q
    rank, lo, hi = int(pos), head.lo, head.hi
    inside = rank  # of the values in [lo, hi]
    while True:
        width = (hi - lo) // buckets + 1
        part = F.floor((F.col("v") - lo) / F.lit(width)) if width > 1 else F.col("v") - lo
        counts = sorted(v.filter((F.col("v") >= lo) & (F.col("v") <= hi)).groupBy(part.cast("bigint").alias("b")).count().collect())
        for b, n in counts:
            if inside < n:
                break
            inside -= n
        lo, hi = lo + b * width, min(hi, lo + (b + 1) * width - 1)
        if width == 1:
            break
    if pos == rank:
        return float(lo)
    after = lo if inside + 1 < n else v.filter(F.col("v") > lo).agg(F.min("v")).first()[0]
    return (rank + 1 - pos) * lo + (pos - rank) * after


def split_point(df: DataFrame, ts: str, q: float = S.split_quantile, method: str = "exact") -> DataFrame:
    """One-row frame with ``__cut``: the ``q`` quantile of ``ts`` in micros (linear interpolation).

    ``exact``: histogram descent (see ``exact_quantile``); ``percentile``: Spark's
    exact percentile in one aggregate (memory grows with distinct times);
    ``approx``: ``percentile_approx`` (rank error 1/10000).
    """
    m = epoch_micros(ts)
    if method == "exact":
        cut = exact_quantile(df, m, q)
        return df.sparkSession.range(1).select(F.lit(cut).cast("double").alias("__cut"))
    agg = F.percentile(m, F.lit(q)) if method == "percentile" else \
        F.percentile_approx(m, F.lit(q), 10000).cast("double")
    return df.agg(agg.alias("__cut"))


def time_split(df: DataFrame, ts: str, q: float = S.split_quantile, method: str = "exact",
               label: str = "split", source: DataFrame | None = None) -> DataFrame:
    """Label rows ``train`` (time < q-quantile) or ``val`` (>=), rows without a time neither;
    the cut comes from ``source``."""
    cut = split_point(source if source is not None else df, ts, q, method)
    return (df.crossJoin(F.broadcast(cut))
              .withColumn(label, F.when(epoch_micros(ts) < F.col("__cut"), "train")
                          .when(epoch_micros(ts) >= F.col("__cut"), "val"))
              .drop("__cut"))


# ---------------------------------------------------------------- composition

def feature_matrix(orders: DataFrame, restaurants: DataFrame, users: DataFrame,
                   ts: str = "order_created_at", target: str = "actual_delivery_time_min",
                   order_id: str = "order_id", scales: Scales = Scales(), validate: bool = False,
                   check_keys: bool = False) -> DataFrame:
    """orders ⟕ restaurants ⟕ users -> temporal, profiles, route, interactions, lags,
    encodings; returns order_id, the features, the target and the split label."""
    # Time-ordered features need their own shuffles (by key, or by ranges of key and time
    # where a key is too large); they run on a 7-column projection of the fact, those of one
    # key after another, and come back in one join to the fact itself, before it is enriched,
    # so that no wide row is shuffled for them.
    narrow = orders.select(order_id, "restaurant_id", "user_id", "route_key", ts, target, "traffic_level")
    narrow = target_encode(narrow, "restaurant_id", target, ts, order_id, "restaurant_id_encoded",
                           scale=scales.target, history=orders)
    narrow = lag_features(narrow, ts, target, scales, source=orders).drop("restaurant_id", "route_key", "traffic_level")
    narrow = target_encode(narrow, "user_id", target, ts, order_id, "user_id_encoded", scale=scales.target,
                           history=orders)
    timed = narrow.select(order_id, "rest_orders_last_1h", "route_avg_delivery_last_3h", "traffic_ma_2h",
                          "restaurant_id_encoded", "user_id_encoded")
    df = orders.join(timed, order_id)
    # Aggregates read the base fact; the enriched frame flows through each step once. What is
    # joined by one key is joined in a row: the frame is shuffled once for each key.
    by_user, by_rest = user_profile_aggs(target, scales), restaurant_profile_aggs(target, ts, scales)
    df = join_dimension(df, restaurants, "restaurant_id", "left", suffix="_restaurant")
    df = entity_profile(df, "restaurant_id", by_rest, source=orders)
    df = join_dimension(df, users, "user_id", "left", suffix="_user")
    df = entity_profile(df, "user_id", by_user, source=orders)
    profiles = [*by_user, *by_rest]
    df = temporal_features(df, ts)
    df = df.select(*[c for c in df.columns if c not in profiles], *profiles)
    if check_keys:
        check_route_keys(orders)
    df = route_parts(df)
    df = entity_profile(df, "route_key", route_profile_aggs(target, order_id, scales), source=orders)
    df = interaction_features(df)
    late = timed.columns[1:]
    feats = [c for c in feature_columns(df) if c not in late] + late
    if validate:
        validate_features(df, feats, target)
    df = time_split(df, ts, source=orders)
    return df.select(order_id, *[c for c in feats if c != "split"], target, "split")
