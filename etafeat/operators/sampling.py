"""Location weights, area profiles, budget mix and reproducible sampling.

Random choices are keyed hash draws, so a pick depends only on the row's key
and the seed, never on partitioning or row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from etafeat import config
from etafeat.functions.columns import title_case, token_array, unit_hash
from etafeat.operators.ordered import group_median

_BUCKETS = 1024


def _keys(k: str | Sequence[str] | None) -> list[str]:
    if k is None:
        return []
    return [k] if isinstance(k, str) else list(k)


def location_weights(restaurants: DataFrame, city: str = "city", area: str = "area") -> DataFrame:
    """Per (city, area): restaurant count, the city's share of all restaurants and
    the area's share within its city (U3, A4, A8)."""
    per_area = restaurants.groupBy(city, area).agg(F.count(F.lit(1)).alias("n_restaurants"))
    per_city = per_area.groupBy(city).agg(F.sum("n_restaurants").alias("n_city"))
    total = per_city.agg(F.sum("n_city").alias("n_total"))
    return (per_area.join(per_city, city).crossJoin(F.broadcast(total))
            .withColumn("city_share", F.col("n_city") / F.col("n_total"))
            .withColumn("area_share", F.col("n_restaurants") / F.col("n_city"))
            .drop("n_total"))


def area_profile(restaurants: DataFrame, city: str = "city", area: str = "area",
                 price: str = "avg_menu_price", cuisines: str = "cuisines_str") -> DataFrame:
    """Per (city, area): exact median price and the sorted set of local cuisines."""
    med = group_median(restaurants, [city, area], price, "median_price")
    toks = (restaurants.select(city, area, F.explode(token_array(cuisines)).alias("cuisine"))
            .distinct()
            .groupBy(city, area).agg(F.array_sort(F.collect_list("cuisine")).alias("cuisines")))
    return med.join(toks, [city, area], "left").withColumn(
        "cuisines", F.coalesce(F.col("cuisines"), F.array().cast("array<string>")))


def budget_mix(profile: DataFrame, median: str = "median_price") -> DataFrame:
    """One row per (area, segment, weight) from the local median price.

    <=250: budget .7 / mid .3; <=500: budget .2 / mid .6 / premium .2;
    otherwise mid .2 / premium .5 / luxury .3; no price data: mid 1.0.
    """
    def arr(pairs):
        return F.array(*[F.struct(F.lit(s).alias("segment"), F.lit(w).alias("weight")) for s, w in pairs])

    m = F.col(median)
    expr = F.when(m.isNull(), arr([(config.BUDGET_DEFAULT, 1.0)]))
    for bound, pairs in config.BUDGET_MIX:
        expr = expr.when(m <= bound, arr(pairs)) if bound is not None else expr.otherwise(arr(pairs))
    cols = [c for c in profile.columns if c != "cuisines"]
    return profile.select(*cols, F.explode(expr).alias("mix")).select(*cols, "mix.segment", "mix.weight")


def cumulative_options(options: DataFrame, group: str | Sequence[str] | None, value: str,
                       weight: str) -> DataFrame:
    """Options with their ``[lo, hi)`` share of the cumulative weight, in ``value`` order.

    With integer weights the bounds are exact ratios. The last option's ``hi``
    is opened to 2.0 so rounding can never leave a draw without an option.
    """
    g = _keys(group)
    w_cum = Window.partitionBy(*g).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(*g)
    w_last = Window.partitionBy(*g).orderBy(F.col(value).desc())
    o = options.select(*g, value, F.col(weight).alias("__w"))
    o = o.withColumns({"__cum": F.sum("__w").over(w_cum), "__tot": F.sum("__w").over(w_all),
                       "__last": F.row_number().over(w_last) == 1})
    return o.select(*g, value,
                    ((F.col("__cum") - F.col("__w")) / F.col("__tot")).alias("lo"),
                    F.when(F.col("__last"), F.lit(2.0)).otherwise(F.col("__cum") / F.col("__tot")).alias("hi"))


def weighted_pick(df: DataFrame, key: str, options: DataFrame, value: str, weight: str,
                  group: str | Sequence[str] | None = None, seed: int = config.DEFAULT.seed,
                  salt: str = "pick", out: str | None = None) -> DataFrame:
    """Reproducible weighted choice with replacement per row.

    ``u = unit_hash(key)``; the option whose ``[lo, hi)`` holds ``u`` wins.
    The interval lookup is an equi join on (group, bucket of u) followed by the
    exact range test: each option is listed in the buckets it overlaps, so the
    join never degenerates to a nested loop and a hot group spreads over the
    buckets.
    """
    g = _keys(group)
    out = out or value
    cum = cumulative_options(options, g, value, weight)
    b = F.lit(_BUCKETS)
    spans = cum.select(*g, value, "lo", "hi",
                       F.explode(F.sequence(F.floor(F.col("lo") * b).cast("int"),
                                            F.least(F.floor(F.col("hi") * b), b - 1).cast("int")))
                       .alias("__bucket"))
    draws = df.withColumn("__u", unit_hash(key, seed, salt)).withColumn(
        "__bucket", F.floor(F.col("__u") * b).cast("int"))
    hit = draws.join(spans, [*g, "__bucket"], "inner").filter(
        (F.col("__u") >= F.col("lo")) & (F.col("__u") < F.col("hi")))
    return hit.drop("__bucket", "lo", "hi").withColumnRenamed(value, out).drop("__u") \
        if out != value else hit.drop("__bucket", "lo", "hi", "__u")


def weighted_sample(df: DataFrame, group: str | Sequence[str], k: int, key: str,
                    weight: str | None = None, seed: int = config.DEFAULT.seed,
                    salt: str = "sample") -> DataFrame:
    """``k`` rows per group without replacement (U7), Efraimidis-Spirakis keys.

    Rank by ``-ln(u) / w`` (or ``-ln(u)`` unweighted), ties by ``key``; the
    per-group limit is applied before the shuffle.
    """
    u = unit_hash(key, seed, salt)
    score = -F.ln(u) if weight is None else -F.ln(u) / F.col(weight)
    w = Window.partitionBy(*_keys(group)).orderBy(F.col("__es"), F.col(key))
    return (df.withColumn("__es", score).withColumn("__rank", F.row_number().over(w))
              .filter(F.col("__rank") <= k).drop("__es"))


def favourite_cuisines(users: DataFrame, profile: DataFrame, k: int = config.DEFAULT.max_fav_cuisines,
                       seed: int = config.DEFAULT.seed, city: str = "city", area: str = "home_area") -> DataFrame:
    """Up to ``k`` distinct local cuisines per user, drawn without replacement,
    as a title-cased display string (empty when the area has none) (U7).

    Each user row gets its area's cuisine list (broadcast when small); every
    cuisine gets the key ``-ln(u(user|cuisine))`` and the ``k`` smallest are
    kept, all inside the row with array functions: no explode, no shuffle,
    no per-user window, whatever the number of users.
    """
    prof = profile.select(F.col("city").alias(city), F.col("area").alias(area), F.col("cuisines").alias("__local"))
    u = users.join(prof, [city, area], "left")
    uid = F.col("user_id").cast("string")
    keyed = F.transform(F.coalesce(F.col("__local"), F.array().cast("array<string>")),
                        lambda c: F.struct((-F.ln(unit_hash(F.concat_ws("|", uid, c), seed, "fav"))).alias("k"),
                                           c.alias("cuisine")))
    picked = F.slice(F.array_sort(keyed), 1, k)
    fav = F.array_join(F.transform(picked, lambda s: title_case(s["cuisine"])), ", ")
    return u.withColumn("fav_cuisines", F.coalesce(fav, F.lit(""))).drop("__local")
