"""Route network, geometry, hourly calendar and expected conditions.

Random draws of the original generator are replaced by keyed hash draws
(``unit_hash``), so every value is reproducible and independent of partitioning.
Noise is an optional input column; without it the expected value is returned.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from etafeat import config
from etafeat.functions.columns import (clip, composite_key, hour_between, is_weekend,
                                       round_half_even, unit_hash)
from etafeat.operators.windows import rank_limit


def area_index(restaurants: DataFrame, users: DataFrame, city: str = "city",
               r_area: str = "area", u_city: str = "city", u_area: str = "home_area") -> DataFrame:
    """Position of every area in the sorted union of restaurant and user areas per city."""
    areas = (restaurants.select(F.col(city).alias("city"), F.col(r_area).alias("area"))
             .union(users.select(F.col(u_city).alias("city"), F.col(u_area).alias("area")))
             .distinct())
    w = Window.partitionBy("city").orderBy("area")
    return areas.withColumn("area_idx", F.row_number().over(w) - 1)


def route_network(restaurants: DataFrame, users: DataFrame, max_km: float = 15.0, cap: int = 200,
                  allow_same_area: bool = False, city: str = "city", r_area: str = "area",
                  u_city: str = "city", u_area: str = "home_area") -> DataFrame:
    """Directed (restaurant area -> user area) pairs per city, nearest ``cap`` kept.

    Distance is ``2 * |index difference|`` (km) over the sorted area list; pairs
    above ``max_km`` are dropped; ties are broken alphabetically. The pair join
    is an equi join on city with a residual distance filter (no cartesian).
    """
    idx = area_index(restaurants, users, city, r_area, u_city, u_area)
    origins = (restaurants.select(F.col(city).alias("city"), F.col(r_area).alias("area")).distinct()
               .join(idx, ["city", "area"]).select("city", F.col("area").alias("origin_area"),
                                                   F.col("area_idx").alias("o_idx")))
    dests = (users.select(F.col(u_city).alias("city"), F.col(u_area).alias("area")).distinct()
             .join(idx, ["city", "area"]).select("city", F.col("area").alias("dest_area"),
                                                 F.col("area_idx").alias("d_idx")))
    # Band join: each origin lists the few indexes within reach (|Δ| * 2 <= max_km)
    # and meets destinations by equality, so no city emits all of its area pairs.
    reach = int(max_km // 2)
    origins = origins.withColumn("d_idx", F.explode(F.sequence(F.col("o_idx") - reach, F.col("o_idx") + reach)))
    pairs = origins.join(dests, ["city", "d_idx"])
    if not allow_same_area:
        pairs = pairs.filter(F.col("origin_area") != F.col("dest_area"))
    pairs = (pairs.withColumn("grid_km", (F.abs(F.col("o_idx") - F.col("d_idx")) * 2).cast("double"))
                  .filter(F.col("grid_km") <= max_km))
    top = rank_limit(pairs, "city", [F.col("grid_km"), F.col("origin_area"), F.col("dest_area")], cap)
    return (top.withColumn("route_key", F.concat_ws("_", "city", "origin_area", F.lit("to"), "dest_area")
                           .alias("route_key"))
               .select("route_key", "city", "origin_area", "dest_area", "grid_km"))


def route_geometry(routes: DataFrame, seed: int = config.DEFAULT.seed, key: str = "route_key",
                   grid_km: str = "grid_km") -> DataFrame:
    """Distance and road mix per route from keyed draws.

    distance = grid + U(1, 3); highway U(0.2, 0.5); arterial U(0.3, 0.6);
    residential = 1 - highway - arterial; each rounded to 2 decimals.
    """
    u = lambda salt: unit_hash(key, seed, salt)
    hw = round_half_even(F.lit(0.2) + F.lit(0.3) * u("highway"), 2)
    art = round_half_even(F.lit(0.3) + F.lit(0.3) * u("arterial"), 2)
    res = round_half_even(F.lit(1.0) - hw - art, 2)
    return routes.withColumns({
        "distance_km": round_half_even(F.col(grid_km) + F.lit(1.0) + F.lit(2.0) * u("distance"), 2),
        "highway_pct": hw, "arterial_pct": art, "residential_pct": res,
    })


def base_eta(distance_km: Column | str, highway: Column | str, arterial: Column | str,
             residential: Column | str) -> Column:
    """Minutes at the mixed road speed: km / (hw*50 + art*30 + res*20) * 60."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    v_hw, v_art, v_res = config.ROAD_SPEEDS
    speed = c(highway) * v_hw + c(arterial) * v_art + c(residential) * v_res
    return F.try_divide(c(distance_km), speed) * F.lit(60.0)


def calendar_hours(end: str | datetime = config.DEFAULT.end_time, days: int = config.DEFAULT.days) -> Column:
    """Array of hourly timestamps from ``end - (days - 1) days`` to ``end``, both included."""
    if days <= 0:
        raise ValueError(f"days must be positive, got {days}")
    end_dt = end if isinstance(end, datetime) else datetime.fromisoformat(str(end))
    start_dt = end_dt - timedelta(days=days - 1)
    # wall-clock text -> timestamp_ntz: independent of the session and system time zones
    return F.sequence(F.lit(start_dt.isoformat(sep=" ")).cast("timestamp_ntz"),
                      F.lit(end_dt.isoformat(sep=" ")).cast("timestamp_ntz"), F.expr("INTERVAL 1 HOUR"))


def calendar(spark: SparkSession, end: str | datetime = config.DEFAULT.end_time,
             days: int = config.DEFAULT.days) -> DataFrame:
    """The hours of ``calendar_hours``, a row each."""
    return spark.range(1).select(F.explode(calendar_hours(end, days)).alias("timestamp"))


def route_hours(routes: DataFrame, hours: Column) -> DataFrame:
    """A row for every route and hour: each route's row lists the hours itself, without a join."""
    return routes.withColumn("timestamp", F.explode(hours))


def _baseline(city: Column, table: Mapping[str, float], default: float) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in (kv[0], float(kv[1]))])
    return F.coalesce(F.try_element_at(m, F.lower(city)), F.lit(float(default)))


def expected_weather(df: DataFrame, ts: str = "timestamp", city: str = "city",
                     distance: str = "distance_km", residential: str = "residential_pct",
                     draw: Column | None = None, noise: Column | None = None,
                     baselines: Mapping[str, float] = config.WEATHER_BASELINES) -> DataFrame:
    """temperature, rain and rain_exposure_factor per row.

    temperature = baseline + (2 at 12-16h else -1) + noise, 1 decimal;
    rain probability = (0.15 in Jun-Sep else 0.05) * (1 + km/5 + 0.3*residential),
    clipped to 0..0.8; ``rain = draw < p`` with ``draw`` a (0,1) column
    (default: keyed by route and hour).
    """
    t = F.col(ts)
    lo, hi = config.MIDDAY_HOURS
    diurnal = F.when(F.hour(t).between(lo, hi), F.lit(2.0)).otherwise(F.lit(-1.0))
    temp = _baseline(F.col(city), baselines, config.DEFAULT_TEMPERATURE) + diurnal
    if noise is not None:
        temp = temp + noise
    season = F.when(F.month(t).isin(list(config.MONSOON_MONTHS)), F.lit(0.15)).otherwise(F.lit(0.05))
    exposure = F.col(distance) / F.lit(5.0)
    p = clip(season * (F.lit(1.0) + exposure + F.col(residential) * F.lit(0.3)), 0.0, 0.8)
    if draw is None:
        draw = unit_hash(F.concat_ws("|", F.col("route_key"), t.cast("string")), config.DEFAULT.seed, "rain")
    return df.withColumns({
        "temperature": round_half_even(temp, 1),
        "rain": (draw < p).cast("int"),
        "rain_exposure_factor": round_half_even(exposure, 2),
    })


def expected_traffic(df: DataFrame, ts: str = "timestamp", city: str = "city",
                     distance: str = "distance_km", highway: str = "highway_pct",
                     noise: Column | None = None, digits: int | None = None,
                     baselines: Mapping[str, float] = config.TRAFFIC_BASELINES) -> DataFrame:
    """traffic_level: baseline + 0.35*highway at peak - 0.1 at weekend + km/10*0.1 (+ noise),
    clipped to 0.05..1."""
    t = F.col(ts)
    level = _baseline(F.col(city), baselines, config.DEFAULT_TRAFFIC)
    level = level + F.when(hour_between(t, config.TRAFFIC_PEAK_RANGES), F.col(highway) * F.lit(0.35)).otherwise(0.0)
    level = level - F.when(is_weekend(t), F.lit(0.1)).otherwise(0.0)
    level = level + F.col(distance) / F.lit(10.0) * F.lit(0.1)
    if noise is not None:
        level = level + noise
    level = clip(level, 0.05, 1.0)
    return df.withColumn("traffic_level", round_half_even(level, digits) if digits is not None else level)


def _chunks(df: DataFrame, key: str, ts: str, start: str | None, chunk_hours: int,
            checks: Column | None) -> tuple[DataFrame, DataFrame]:
    """``df`` with its chunk number ``__chunk``, and the table of chunks (``__key``, ``__bad``) that hold a bad row."""
    if start is not None:
        t0 = F.lit(start).cast("timestamp_ntz")
        base = df
    else:
        firsts = df.groupBy(F.col(key).alias("__first")).agg(F.min(ts).alias("__t0"))
        base = df.join(firsts, F.col(key).eqNullSafe(F.col("__first"))).drop("__first")
        t0 = F.col("__t0")
    chunk = F.floor(F.timestamp_diff("HOUR", t0, F.col(ts)) / F.lit(chunk_hours))
    bad_row = checks if checks is not None else (
        F.greatest(*[F.col(c).isNull() for c in df.columns])
        | ~F.col("traffic_level").between(0.0, 1.0))
    marked = base.withColumn("__chunk", chunk).drop("__t0")
    return marked, marked.filter(bad_row).select(F.col(key).alias("__key"), F.col("__chunk").alias("__bad")).distinct()


def _in_chunk(key: str) -> Column:
    return F.col(key).eqNullSafe(F.col("__key")) & F.col("__chunk").eqNullSafe(F.col("__bad"))


def quarantine_chunks(df: DataFrame, key: str = "route_key", ts: str = "timestamp",
                      start: str | None = None, chunk_hours: int = 24,
                      checks: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, quarantined): a whole (route, chunk) is quarantined
    when any of its rows has a NULL or a traffic level outside 0..1 (W7).

    Chunks are ``chunk_hours`` long, counted from ``start`` (the calendar
    start) or from the route's first hour. The bad chunks are a grouped table,
    combined before its shuffle; rows meet it in a semi and an anti join, so no
    task holds a chunk. Every row is in one of the two halves; rows without a key
    or a time form chunks of their own.
    """
    marked, bad = _chunks(df, key, ts, start, chunk_hours, checks)
    return tuple(marked.join(bad, _in_chunk(key), how).drop("__chunk") for how in ("left_anti", "left_semi"))


def flag_chunks(df: DataFrame, key: str = "route_key", ts: str = "timestamp", start: str | None = None,
                chunk_hours: int = 24, checks: Column | None = None, flag: str = "quarantined") -> DataFrame:
    """Both halves of ``quarantine_chunks`` as one frame: all rows, with ``flag``."""
    marked, bad = _chunks(df, key, ts, start, chunk_hours, checks)
    return (marked.join(bad.withColumn(flag, F.lit(True)), _in_chunk(key), "left")
            .select(*df.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag)))


def conditions(route_hours_df: DataFrame) -> DataFrame:
    """Weather, traffic and base ETA for every (route, hour) in one projection."""
    base = route_hours_df.withColumn("base_eta_minutes", base_eta("distance_km", "highway_pct",
                                                                  "arterial_pct", "residential_pct"))
    return expected_traffic(expected_weather(base)).select(
        "route_key", "timestamp", "temperature", "rain", "rain_exposure_factor", "traffic_level",
        "distance_km", "highway_pct", "base_eta_minutes")


def conditions_table(route_hours_df: DataFrame, seed: int = config.DEFAULT.seed) -> DataFrame:
    """Weather and traffic for every (route, hour), joined on both keys."""
    base = route_hours_df.withColumn("base_eta_minutes", base_eta("distance_km", "highway_pct",
                                                                  "arterial_pct", "residential_pct"))
    weather = expected_weather(base).select("route_key", "timestamp", "temperature", "rain",
                                            "rain_exposure_factor")
    traffic = expected_traffic(base).select("route_key", "timestamp", "traffic_level", "distance_km",
                                            "highway_pct", "base_eta_minutes")
    return weather.join(traffic, ["route_key", "timestamp"], "inner")


def route_key_of(city: Column | str, origin: Column | str, dest: Column | str) -> Column:
    return composite_key(city, origin, F.lit("to"), dest)
