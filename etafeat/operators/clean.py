"""Restaurant cleaning (U1) and deterministic geo jitter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etafeat import config
from etafeat.functions.columns import (composite_key, canonical, clip, display_tokens, hash_mod, positive_or_null,
                                       price_band, round_half_even, to_double, token_array, unit_hash)
from etafeat.operators.ordered import group_median
from etafeat.operators.quality import duplicate_keys, normalize_columns, require_columns

S = config.DEFAULT


def unknown_cities(df: DataFrame, anchors: Mapping[str, tuple[float, float]], city: str = "city",
                   examples: int = 5) -> str | None:
    """None if every city has an anchor, else how many do not and a few of them."""
    known = F.array(*[F.lit(k) for k in anchors])
    bad = df.select(city).distinct().filter(~F.array_contains(known, F.col(city)))
    n = bad.count()
    return f"{n} without an anchor, such as {sorted(r[0] for r in bad.limit(examples).collect())}" if n else None


def geo_jitter(df: DataFrame, key_cols: Sequence[str], anchors: Mapping[str, tuple[float, float]],
               city: str = "city", span: float = S.geo_jitter, lat: str = "lat", lon: str = "lon",
               correlated: bool = False, default_anchor: tuple[float, float] | None = None,
               bounds: config.Bounds | None = None) -> DataFrame:
    """Coordinates within ±span/2 of the city anchor, fixed by SHA-256 of the key.

    key = lower(k1_k2_...); m = sha256(key) mod 10^6; lat jitter from m mod 1000,
    lon jitter from (m div 1000) mod 1000 (``correlated`` uses m mod 1000 for
    both). Unknown cities fail unless ``default_anchor`` is given.
    """
    if default_anchor is None:
        bad = unknown_cities(df, anchors, city)
        if bad:
            raise ValueError(f"cities: {bad}")
    lat_map = F.create_map(*[x for k, v in anchors.items() for x in (F.lit(k), F.lit(float(v[0])))])
    lon_map = F.create_map(*[x for k, v in anchors.items() for x in (F.lit(k), F.lit(float(v[1])))])
    a_lat = F.try_element_at(lat_map, F.col(city))
    a_lon = F.try_element_at(lon_map, F.col(city))
    if default_anchor is not None:
        a_lat = F.coalesce(a_lat, F.lit(float(default_anchor[0])))
        a_lon = F.coalesce(a_lon, F.lit(float(default_anchor[1])))
    key = composite_key(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in key_cols])  # a NULL part stays a part
    m = hash_mod(key, 10 ** 6)
    lo = m % 1000
    hi = lo if correlated else F.floor(m / 1000) % 1000
    out = df.withColumns({
        lat: a_lat + (lo / F.lit(1000.0) - F.lit(0.5)) * F.lit(span),
        lon: a_lon + (hi / F.lit(1000.0) - F.lit(0.5)) * F.lit(span),
    })
    if bounds is not None:
        out = out.withColumn("__in_bounds", F.col(lat).between(bounds.lat_min, bounds.lat_max)
                             & F.col(lon).between(bounds.lon_min, bounds.lon_max))
    return out


def delivery_fee(key: Column | str, seed: int = S.seed, lo: float = 20.0, hi: float = 40.0,
                 variation: float = 10.0) -> Column:
    """Fee = U(lo, hi) + U(-variation, variation), clipped to 15..80, 2 decimals (keyed draws)."""
    base = F.lit(lo) + F.lit(hi - lo) * unit_hash(key, seed, "fee")
    noise = (F.lit(2.0) * unit_hash(key, seed, "fee_noise") - F.lit(1.0)) * F.lit(variation)
    return round_half_even(clip(base + noise, S.fee_min, S.fee_max), 2)


def dedupe_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order`` (then all columns), a deterministic keep-first.

    A grouped ``min`` of a struct, so hot keys are reduced map-side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ordered = list(order) + [c for c in rest if c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in ordered])).alias("__row"))
    return best.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def _gates(df: DataFrame, anchors: Mapping[str, tuple[float, float]], aliases: Mapping[str, str],
           unique: bool, cities: bool) -> None:
    """Input gates: duplicate ids, and cities without an anchor among rows that survive
    the delivery-time filter. Only counts and a few examples reach the driver."""
    if unique:
        extra = duplicate_keys(df, "restaurant_id")
        n = extra.count()
        if n:
            raise ValueError(f"duplicate keys in restaurant_id: {n} ids occur again, such as "
                             f"{[r[0] for r in extra.limit(5).collect()]}")
    if cities:
        rows = df.filter(to_double("base_delivery_time_min") > 0).select(canonical("city", aliases).alias("city"))
        bad = unknown_cities(rows, anchors)
        if bad:
            raise ValueError(f"cities: {bad}")


def clean_restaurants(raw: DataFrame, anchors: Mapping[str, tuple[float, float]] = config.CITY_ANCHORS,
                      aliases: Mapping[str, str] = config.CITY_ALIASES, settings: config.Settings = S,
                      on_duplicate: str = "raise", geo: bool = True) -> DataFrame:
    """Raw restaurant listings -> clean table (16 columns).

    names -> renames -> unique ids -> canonical city (raw kept) -> price repair
    (non-positive -> NULL -> city median -> cap) -> band -> cuisines (clean
    tokens and display string) -> drop missing/non-positive delivery times ->
    coordinates -> delivery fee -> one row per id.
    """
    require_columns(raw, config.RAW_RESTAURANT_COLUMNS)
    df = normalize_columns(raw).withColumnsRenamed(config.RESTAURANT_RENAMES)
    _gates(df, anchors, aliases, unique=on_duplicate == "raise", cities=geo)
    df = df.withColumns({
        "city_raw": F.col("city").cast("string"),
        "city": canonical("city", aliases),
        "area": F.trim(F.col("area").cast("string")),
        "name": F.trim(F.col("name").cast("string")),
        "avg_menu_price": positive_or_null(to_double("price")),
        "avg_rating": to_double("avg_rating"),
        "num_ratings": F.col("num_ratings").try_cast("bigint"),
        "base_delivery_time_min": to_double("base_delivery_time_min"),
    }).drop("price")
    med = group_median(df, "city", "avg_menu_price")
    df = (df.join(med, "city", "left")
            .withColumn("avg_menu_price", clip(F.coalesce(F.col("avg_menu_price"), F.col("__median")),
                                               settings.price_min, settings.price_max))
            .drop("__median"))
    tokens = token_array("cuisines_raw")
    df = df.withColumns({
        "price_band": price_band("avg_menu_price"),
        "cuisines_str": display_tokens(tokens),
    }).withColumn("cuisines", F.col("cuisines_str")).drop("cuisines_raw")
    df = df.filter(F.col("base_delivery_time_min").cast("double") > 0)
    if geo:
        df = geo_jitter(df, ["city", "area", "name"], anchors, span=settings.geo_jitter,
                        default_anchor=(0.0, 0.0))  # unknown cities were rejected by _gates
    df = df.withColumn("delivery_fee", delivery_fee("restaurant_id", settings.seed))
    if on_duplicate == "keep_first":
        df = dedupe_first(df, "restaurant_id", ["name", "area"])
    cols = ["restaurant_id", "area", "city", "name", "avg_rating", "num_ratings", "address",
            "base_delivery_time_min", "city_raw", "avg_menu_price", "price_band", "cuisines_str",
            "cuisines", "lat", "lon", "delivery_fee"]
    return df.select(*[c for c in cols if c in df.columns])
