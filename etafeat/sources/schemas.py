"""Explicit schemas of the pipeline tables (typed at the edges, never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


RAW_RESTAURANTS = _s(("id", StringType()), ("area", StringType()), ("city", StringType()),
                     ("restaurant", StringType()), ("price", StringType()), ("avg_ratings", DoubleType()),
                     ("total_ratings", LongType()), ("food_type", StringType()), ("address", StringType()),
                     ("delivery_time", DoubleType()))

RESTAURANTS_CLEAN = _s(("restaurant_id", StringType()), ("area", StringType()), ("city", StringType()),
                       ("name", StringType()), ("avg_rating", DoubleType()), ("num_ratings", LongType()),
                       ("address", StringType()), ("base_delivery_time_min", DoubleType()),
                       ("city_raw", StringType()), ("avg_menu_price", DoubleType()), ("price_band", StringType()),
                       ("cuisines_str", StringType()), ("cuisines", StringType()), ("lat", DoubleType()),
                       ("lon", DoubleType()), ("delivery_fee", DoubleType()))

USERS = _s(("user_id", StringType()), ("city", StringType()), ("home_area", StringType()),
           ("budget_segment", StringType()), ("fav_cuisines", StringType()), ("home_lat", DoubleType()),
           ("home_lon", DoubleType()))

ROUTES_ETA = _s(("route_key", StringType()), ("timestamp", TimestampNTZType()), ("temperature", DoubleType()),
                ("rain", IntegerType()), ("rain_exposure_factor", DoubleType()), ("traffic_level", DoubleType()),
                ("distance_km", DoubleType()), ("highway_pct", DoubleType()), ("base_eta_minutes", DoubleType()))

ORDERS = _s(("order_id", StringType()), ("user_id", StringType()), ("restaurant_id", StringType()),
            ("route_key", StringType()), ("order_created_at", TimestampNTZType()), ("basket_value", DoubleType()),
            ("num_items", IntegerType()), ("distance_km", DoubleType()), ("rain", IntegerType()),
            ("temperature", DoubleType()), ("traffic_level", DoubleType()), ("base_eta_minutes", DoubleType()),
            ("actual_delivery_time_min", DoubleType()), ("order_status", StringType()))

TOKENS = ArrayType(StringType())
