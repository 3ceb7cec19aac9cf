"""The five stages as functions: clean -> users -> routes -> orders -> features.

Each stage returns lazy DataFrames; ``run_*`` helpers write them (Parquet
between stages, CSV at the edges) and a JSON metrics document. Random draws
of the original generator are keyed hash draws, so re-runs reproduce the same
tables under any partitioning.
"""

from __future__ import annotations

import logging
import os
from datetime import datetime, timedelta
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat import config
from etafeat.functions.columns import format_id, round_half_even, token_count, unit_hash
from etafeat.operators import clean as cl
from etafeat.operators import demand as dm
from etafeat.operators import quality as qa
from etafeat.operators import features as fx
from etafeat.operators import routes as rt
from etafeat.operators import sampling as sm
from etafeat.session import materialize
from etafeat.sources import io

S = config.DEFAULT
DROP_WARNING = 0.2  # share of rows that cleaning may drop without a warning
log = logging.getLogger(__name__)


# ------------------------------------------------------------------- stage 1

def clean_stage(raw: DataFrame, settings: config.Settings = S,
                anchors: Mapping[str, tuple[float, float]] = config.CITY_ANCHORS) -> DataFrame:
    return cl.clean_restaurants(raw, anchors=anchors, settings=settings)


def _nulls(*cols: str) -> dict:
    return {f"n_no_{c}": F.count_if(F.col(c).isNull()) for c in cols}


def _range(name: str, col: str, mean: bool = False) -> dict:
    got = {f"{name}_min": F.min(col), f"{name}_max": F.max(col)}
    return got | ({f"{name}_mean": F.avg(col)} if mean else {})


def _distinct(df: DataFrame, **columns: str) -> dict:
    """Distinct counts of a written table: each reads its one column."""
    return io.metrics_row(qa.distinct_counts(df, columns))


def restaurants_metrics(settings: config.Settings = S) -> dict:
    price = F.col("avg_menu_price")
    return (_nulls("lat", "lon") | _range("fee", "delivery_fee", mean=True)
            | {"price_mean": F.avg(price), "price_std": F.stddev_samp(price),
               "n_bad_time": F.count_if(F.col("base_delivery_time_min") <= 0),
               "n_price_outliers": F.count_if(~price.between(settings.price_min, settings.price_max))})


def restaurants_document(seen: dict, distinct: dict) -> dict:
    """Report of stage 1 with its pass/fail verdict."""
    doc = {"total_restaurants": seen["n_rows"], **distinct, "avg_menu_price_mean": seen["price_mean"],
           "avg_menu_price_std": seen["price_std"],
           "missing_coordinates": {"lat": seen["n_no_lat"], "lon": seen["n_no_lon"]},
           "invalid_delivery_time": seen["n_bad_time"], "price_outliers": seen["n_price_outliers"],
           "delivery_fee_stats": {k: seen[f"fee_{k}"] for k in ("min", "max", "mean")}}
    faults = [seen["n_no_lat"], seen["n_no_lon"], seen["n_bad_time"], seen["n_price_outliers"]]
    return doc | {"passed": doc["total_restaurants"] == doc["unique_restaurant_ids"] and not any(faults)}


def users_metrics() -> dict:
    return (_nulls("city", "home_area", "budget_segment", "fav_cuisines") | _range("lat", "home_lat") | _range("lon", "home_lon")
            | {"favourites": F.avg(token_count("fav_cuisines"))})


def users_document(seen: dict, distinct: dict, segments: dict) -> dict:
    return {"total_users": seen["n_rows"], **distinct, "budget_segments": segments, "avg_fav_cuisines": seen["favourites"],
            "geographic_bounds_check": {f"{c}_{m}": seen[f"{c}_{m}"] for c in ("lat", "lon") for m in ("min", "max")},
            "missing_values": {c: seen[f"n_no_{c}"] for c in ("city", "home_area", "budget_segment", "fav_cuisines")}}


def routes_metrics() -> dict:
    return {"avg_base_eta": F.avg("base_eta_minutes"), "avg_traffic_level": F.avg("traffic_level"), "avg_rain": F.avg("rain"),
            "avg_temperature": F.avg("temperature"), "avg_distance_km": F.avg("distance_km")}


def orders_metrics() -> dict:
    status, took = F.col("order_status"), F.col("actual_delivery_time_min")
    return (_nulls("basket_value", "actual_delivery_time_min", "route_key") | _range("took", "actual_delivery_time_min", mean=True)
            | _range("made", "order_created_at")
            | {"basket": F.avg("basket_value"), "eta": F.avg("base_eta_minutes"), "gap": F.avg(took - F.col("base_eta_minutes"))}
            | {f"n_{s}": F.count_if(status == s) for s in ("completed", "delayed", "cancelled")})


def orders_document(seen: dict, distinct: dict) -> dict:
    rate = {f"{s}_rate": seen[f"n_{s}"] / seen["n_rows"] if seen["n_rows"] else 0.0 for s in ("delayed", "cancelled")}
    rate["completion_rate"] = seen["n_completed"] / seen["n_rows"] if seen["n_rows"] else 0.0
    return {"total_orders": seen["n_rows"], **distinct, **rate, "avg_basket_value": seen["basket"],
            "avg_delivery_time": seen["took_mean"], "avg_base_eta": seen["eta"], "eta_vs_actual_gap": seen["gap"],
            "missing_values": {"basket_value": seen["n_no_basket_value"], "delivery_time": seen["n_no_actual_delivery_time_min"],
                               "route_key": seen["n_no_route_key"]},
            "delivery_time_range": {"min": seen["took_min"], "max": seen["took_max"]},
            "date_range": {"start": seen["made_min"], "end": seen["made_max"]}}


# ------------------------------------------------------------------- stage 2

def users_stage(spark: SparkSession, restaurants: DataFrame, n_users: int, settings: config.Settings = S,
                correlated_jitter: bool = False) -> DataFrame:
    """Users with city and home area drawn by restaurant density, a budget segment
    from the local median price, favourite local cuisines and home coordinates."""
    w = sm.location_weights(restaurants)
    users = spark.range(1, n_users + 1).select(format_id("U", "id", 5).alias("user_id"))
    users = sm.weighted_pick(users, "user_id", w.select("city", "n_city").distinct(), "city", "n_city",
                             seed=settings.seed, salt="city")
    users = sm.weighted_pick(users, "user_id", w.select("city", "area", "n_restaurants"), "area",
                             "n_restaurants", group="city", seed=settings.seed, salt="area", out="home_area")
    prof = sm.area_profile(restaurants)
    mix = sm.budget_mix(prof).select("city", F.col("area").alias("home_area"), "segment",
                                     (F.col("weight") * 10).cast("bigint").alias("w10"))
    users = sm.weighted_pick(users, "user_id", mix, "segment", "w10", group=["city", "home_area"],
                             seed=settings.seed, salt="budget", out="budget_segment")
    users = sm.favourite_cuisines(users, prof, settings.max_fav_cuisines, settings.seed)
    users = cl.geo_jitter(users, ["city", "home_area", "user_id"], config.CITY_ANCHORS, lat="home_lat",
                          lon="home_lon", correlated=correlated_jitter, default_anchor=config.DEFAULT_ANCHOR,
                          span=settings.geo_jitter)
    return users.select("user_id", "city", "home_area", "budget_segment", "fav_cuisines", "home_lat", "home_lon")


# ------------------------------------------------------------------- stage 3

def routes_stage(spark: SparkSession, restaurants: DataFrame, users: DataFrame,
                 settings: config.Settings = S) -> tuple[DataFrame, DataFrame]:
    """(routes_eta, quarantined): every route-hour with weather, traffic and base ETA."""
    net = rt.route_network(restaurants, users, settings.max_route_km, settings.routes_per_city)
    geo = rt.route_geometry(net, settings.seed)
    cond = rt.conditions(rt.route_hours(geo, rt.calendar_hours(settings.end_time, settings.days)))
    start = datetime.fromisoformat(str(settings.end_time)) - timedelta(days=settings.days - 1)
    return rt.quarantine_chunks(cond, start=str(start))


# ------------------------------------------------------------------- stage 4

def orders_stage(requests: DataFrame, restaurants: DataFrame, routes_eta: DataFrame,
                 settings: config.Settings = S) -> DataFrame:
    """Order requests -> accepted orders with conditions, basket, delivery time, status.

    requests: order_id (unique), user_id, restaurant_id, route_key, ts, num_items
    (+ optional ``eta_noise`` minutes). Requests without a (route, hour) row drop
    out and use no capacity; then at most ``capacity_per_hour`` per restaurant and
    hour, in order of time, ties by order id.
    """
    if "order_id" not in requests.columns:
        raise ValueError("requests need an order_id: two orders may agree in all else")
    req = requests if "eta_noise" in requests.columns else requests.withColumn("eta_noise", F.lit(0.0))
    cond = routes_eta.select("route_key", "timestamp", "distance_km", "traffic_level", "rain", "temperature",
                             "base_eta_minutes")
    acc = dm.accept_orders(req, cond, "restaurant_id", "ts", [F.col("ts"), F.col("order_id")],
                           settings.capacity_per_hour)
    acc = acc.join(restaurants.select("restaurant_id", "avg_menu_price"), "restaurant_id", "left")
    key = F.col("order_id").cast("string")
    actual = F.col("base_eta_minutes") + F.col("eta_noise")
    return acc.select(
        "order_id", "user_id", "restaurant_id", "route_key",
        F.col("ts").alias("order_created_at"),
        dm.price_basket("avg_menu_price", "num_items", "ts").alias("basket_value"), "num_items",
        F.col("distance_km"), "rain", "temperature", "traffic_level",
        round_half_even("base_eta_minutes", 1).alias("base_eta_minutes"),
        dm.delivery_time(actual).alias("actual_delivery_time_min"),
        dm.order_status(unit_hash(key, settings.seed, "status"), actual).alias("order_status"),
    )


# ------------------------------------------------------------------- stage 5

def features_stage(orders: DataFrame, restaurants: DataFrame, users: DataFrame, validate: bool = True) -> DataFrame:
    return fx.feature_matrix(orders, restaurants, users, validate=validate, check_keys=validate)


def run_features(orders: DataFrame, restaurants: DataFrame, users: DataFrame, out_dir: str,
                 metrics_path: str | None = None) -> dict:
    """Write train/val Parquet (features + target) and the stage document, seen while writing."""
    fm = features_stage(orders, restaurants, users)
    feats = [c for c in fm.columns if c not in ("order_id", "actual_delivery_time_min", "split")]
    t = "actual_delivery_time_min"
    w = io.ObservedWrite()
    fm = w.watch(fm.select(*feats, t, "split"), "matrix", n_train=F.count_if(F.col("split") == "train"),
                 n_val=F.count_if(F.col("split") == "val"), mean=F.avg(t), std=F.stddev_samp(t))
    w.write(fm, os.path.join(out_dir, "features"), partition_by=["split"])
    seen = w.values("matrix")
    doc = {"final_rows": seen["n_rows"], "train_rows": seen["n_train"], "val_rows": seen["n_val"], "target_mean": seen["mean"],
           "target_std": seen["std"], "features_created": len(feats)}
    return io.write_metrics(fm.sparkSession, doc, metrics_path) if metrics_path else doc


def run_pipeline(spark: SparkSession, raw_csv: str, requests: DataFrame | None, out_dir: str, n_users: int,
                 settings: config.Settings = S,
                 anchors: Mapping[str, tuple[float, float]] = config.CITY_ANCHORS) -> dict:
    """All five stages. Each stage's output is written as Parquet and read back
    by the next, so a later stage never re-plans (or re-runs) an earlier one;
    its document is observed while it is written and stands beside it as JSON.

    ``requests`` (order_id, user_id, restaurant_id, route_key, ts, num_items) drive stage
    4; without them the run stops after the route conditions.
    """
    def stage(df: DataFrame, name: str, metrics: dict) -> tuple[DataFrame, dict]:
        path, w = os.path.join(out_dir, f"{name}.parquet"), io.ObservedWrite()
        w.write(w.watch(df, name, **metrics), path)
        return spark.read.parquet(path), w.values(name)

    def document(name: str, doc: dict) -> None:
        docs[name] = io.write_metrics(spark, doc, os.path.join(out_dir, f"{name}.json"))

    docs = {"restaurants": run_clean(spark, raw_csv, out_dir, settings, anchors)}
    rest = spark.read.parquet(os.path.join(out_dir, "restaurants_clean.parquet"))
    users, seen = stage(users_stage(spark, rest, n_users, settings), "users", users_metrics())
    segments = users.groupBy("budget_segment").count().collect()  # four segments
    document("users", users_document(seen, _distinct(users, unique_user_ids="user_id", cities_covered="city"),
                                     {str(r[0]): r[1] for r in segments}))
    good, bad = routes_stage(spark, rest, users, settings)
    routes, seen = stage(good, "routes_eta", routes_metrics())
    docs["routes_quarantined"] = io.write_observed(bad, os.path.join(out_dir, "routes_quarantine.parquet"))
    document("routes", {"total_rows_generated": seen.pop("n_rows"), **seen, "quarantined_rows": docs["routes_quarantined"],
                        **_distinct(routes, total_routes="route_key", total_timestamps="timestamp")})
    if requests is None:
        return docs
    orders, seen = stage(orders_stage(requests, rest, routes, settings), "orders", orders_metrics())
    qa.require_unique(orders, "order_id")
    document("orders", orders_document(seen, _distinct(orders, unique_users="user_id", unique_restaurants="restaurant_id",
                                                       unique_routes="route_key")))
    docs["features"] = run_features(orders, rest, users, out_dir, os.path.join(out_dir, "features.json"))
    return docs


def run_clean(spark: SparkSession, raw_csv: str, out_dir: str, settings: config.Settings = S,
              anchors: Mapping[str, tuple[float, float]] = config.CITY_ANCHORS, multi_line: bool = True) -> dict:
    """Stage 1 end to end: CSV in; Parquet + CSV + metrics out, with the share of rows dropped.

    Addresses may hold line breaks, so each file is one task unless ``multi_line`` is off.
    """
    w = io.ObservedWrite()
    raw = w.watch(io.read_csv(spark, raw_csv, multi_line=multi_line), "raw")
    raw = materialize(raw, "raw-restaurants")  # cleaning reads it several times: each row is seen once
    path = os.path.join(out_dir, "restaurants_clean.parquet")
    w.write(w.watch(clean_stage(raw, settings, anchors), "clean", **restaurants_metrics(settings)), path)
    clean, drop = spark.read.parquet(path), w.drop_rate("raw", "clean")
    if drop > DROP_WARNING:
        log.warning("cleaning dropped %.1f%% of %d rows", 100 * drop, w.values("raw")["n_rows"])
    io.write_csv(clean, os.path.join(out_dir, "restaurants_clean.csv"))
    doc = restaurants_document(w.values("clean"), _distinct(clean, unique_restaurant_ids="restaurant_id", cities_covered="city"))
    doc |= {"rows_read": w.values("raw")["n_rows"], "rows_written": doc["total_restaurants"], "drop_rate": drop}
    return io.write_metrics(spark, doc, os.path.join(out_dir, "restaurants_clean.json"))
