"""Feature-stage queries (U20-U27) over the delivery binding, with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from etafeat.functions.columns import round_half_even
from etafeat.operators import features as fx
from etafeat.operators.joins import join_dimension
from etafeat.plans import bindings as b
from etafeat.plans.registry import query
from etafeat.session import materialize, table

ORDERS_CTE = b.with_ctes(b.SQL_PLACES, b.SQL_ORDERS)
DIMS_CTE = b.with_ctes(b.SQL_RESTAURANTS, b.SQL_USERS, b.SQL_ORDERS)
TRIG = ("hour_sin", "hour_cos", "day_sin", "day_cos")


def _trig_rounded(df):
    """Sine/cosine can differ in the last bit between math libraries: compare at 12 digits."""
    return df.withColumns({c: round_half_even(c, 12) for c in TRIG if c in df.columns})


def _r(x: str, d: int = 2) -> str:
    return b.sql_round(x, d)


def _dmean(x: str, s: int) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,{s}))) AS DOUBLE) / COUNT({x})"


def _dstd(x: str, s: int) -> str:
    """sqrt((n S2 - S1^2) / (n (n - 1))) of whole numbers of 128 bits, beside centred moments in Spark."""
    d = f"CAST(round({x} * {10 ** s}) AS HUGEINT)"
    n = f"CAST(COUNT({x}) AS HUGEINT)"
    return (f"CASE WHEN COUNT({x}) > 1 THEN sqrt(CAST({n} * SUM({d} * {d}) - SUM({d}) * SUM({d}) AS DOUBLE)"
            f" / CAST({n} * ({n} - 1) AS DOUBLE)) / {10 ** s}.0 END")


_RATE = "CAST(SUM(CASE WHEN order_status = 'completed' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*)"
_T = "actual_delivery_time_min"

SQL_USER_PROFILE = f"""SELECT user_id,
  {_r(_dmean(_T, 1))} AS user_avg_delivery_time, {_r(_dstd(_T, 1))} AS user_std_delivery_time,
  COUNT({_T}) AS user_order_count, {_r(_dmean('basket_value', 2))} AS user_avg_basket,
  {_r(_RATE)} AS user_completion_rate, {_r(_dmean('distance_km', 2))} AS user_avg_distance
FROM delivery_orders GROUP BY user_id"""

SQL_REST_PROFILE = f"""SELECT restaurant_id,
  {_r(_dmean(_T, 1))} AS rest_avg_delivery_time, {_r(_dstd(_T, 1))} AS rest_std_delivery_time,
  {_r(_RATE)} AS rest_completion_rate, COUNT(order_created_at) AS rest_order_volume,
  {_r(_dmean('basket_value', 2))} AS rest_avg_basket
FROM delivery_orders GROUP BY restaurant_id"""

SQL_ROUTE_PROFILE = f"""SELECT route_key,
  {_r(_dmean('traffic_level', 2))} AS route_avg_traffic, {_r(_dstd('traffic_level', 2))} AS route_std_traffic,
  {_r(_dmean(_T, 1))} AS route_historical_delivery_time,
  {_r("arg_min(distance_km, order_id) FILTER (WHERE distance_km IS NOT NULL)")} AS route_distance,
  {_r("arg_min(base_eta_minutes, order_id) FILTER (WHERE base_eta_minutes IS NOT NULL)")} AS route_base_eta
FROM delivery_orders GROUP BY route_key"""


def _orders(spark, sf):
    return b.delivery_orders(spark, sf)


@query("delivery_orders", ORDERS_CTE + "SELECT * FROM delivery_orders",
       "J1/J5 lookups, U9 base ETA, U11 weather, U12 traffic, U15 basket, U16 status, U19 delivery time")
def delivery_orders(spark, sf):
    return _orders(spark, sf)


@query("join_dimensions", DIMS_CTE + """
SELECT d.order_id, d.restaurant_id, d.user_id, r.name, r.city, r.area, r.avg_menu_price, r.price_band,
       u.city AS city_user, u.home_area, u.budget_segment
FROM delivery_orders d LEFT JOIN restaurants_b r ON d.restaurant_id = r.restaurant_id
LEFT JOIN users u ON d.user_id = u.user_id
""", "J1, P10, P11, U20: fact ⟕ restaurants ⟕ users with suffixes")
def join_dimensions(spark, sf):
    o = _orders(spark, sf).select("order_id", "restaurant_id", "user_id")
    df = join_dimension(o, b.restaurants(spark, sf), "restaurant_id", suffix="_restaurant")
    return join_dimension(df, b.users(spark, sf), "user_id", suffix="_user")


@query("temporal_features", """
SELECT event_id,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) - 1 >= 5 AS INTEGER) AS is_weekend,
  CAST(hour(ts) IN (7, 8, 9, 12, 13, 18, 19, 20, 21, 22) AS INTEGER) AS is_rush_hour,
  round_even(sin(6.283185307179586 * hour(ts) / 24.0) * 1e12, 0) / 1e12 AS hour_sin,
  round_even(cos(6.283185307179586 * hour(ts) / 24.0) * 1e12, 0) / 1e12 AS hour_cos,
  round_even(sin(6.283185307179586 * (isodow(ts) - 1) / 7.0) * 1e12, 0) / 1e12 AS day_sin,
  round_even(cos(6.283185307179586 * (isodow(ts) - 1) / 7.0) * 1e12, 0) / 1e12 AS day_cos
FROM events
""", "D-1..D-3, M5, U21 on events.ts")
def temporal_features(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts")
    return _trig_rounded(fx.temporal_features(ev, "ts")).drop("ts")


@query("user_profile", ORDERS_CTE + SQL_USER_PROFILE, "A2, A9, A10, U22: user profile, 2 decimals")
def user_profile(spark, sf):
    o = _orders(spark, sf)
    return o.groupBy("user_id").agg(*[round_half_even(e, 2).alias(n) if n != "user_order_count" else e.alias(n)
                                      for n, e in fx.user_profile_aggs(_T, fx.Scales()).items()])


@query("restaurant_profile", ORDERS_CTE + SQL_REST_PROFILE, "A9, A11, U22: restaurant profile")
def restaurant_profile(spark, sf):
    o = _orders(spark, sf)
    aggs = fx.restaurant_profile_aggs(_T, "order_created_at", fx.Scales())
    return o.groupBy("restaurant_id").agg(*[
        e.alias(n) if n == "rest_order_volume" else round_half_even(e, 2).alias(n) for n, e in aggs.items()])


@query("route_profile", ORDERS_CTE + SQL_ROUTE_PROFILE, "A12, A13: route profile with first non-null values")
def route_profile(spark, sf):
    o = _orders(spark, sf)
    aggs = fx.route_profile_aggs(_T, "order_id", fx.Scales(traffic=2))
    return o.groupBy("route_key").agg(*[round_half_even(e, 2).alias(n) for n, e in aggs.items()])


@query("route_parse", ORDERS_CTE + """
SELECT route_key,
  CASE WHEN strpos(route_key, '_to_') > 0 THEN substr(route_key, strpos(route_key, '_to_') + 4)
       ELSE 'UNKNOWN' END AS dest_area,
  CASE WHEN strpos(split_part(route_key, '_to_', 1), '_') > 0
       THEN substr(split_part(route_key, '_to_', 1), 1, strpos(split_part(route_key, '_to_', 1), '_') - 1)
       ELSE split_part(route_key, '_to_', 1) END AS city,
  CASE WHEN strpos(split_part(route_key, '_to_', 1), '_') > 0
       THEN substr(split_part(route_key, '_to_', 1), strpos(split_part(route_key, '_to_', 1), '_') + 1)
       ELSE 'UNKNOWN' END AS origin_area,
  CAST(strpos(route_key, '_to_') = 0 AS INTEGER) AS missing_to,
  CAST(length(route_key) - length(replace(route_key, '_', '')) < 2 AS INTEGER) AS few_underscores,
  CAST(strpos(route_key, '__') > 0 AS INTEGER) AS double_underscore
FROM (SELECT DISTINCT route_key FROM delivery_orders)
""", "C7, C8, C9, W5: route key parse and structural checks")
def route_parse(spark, sf):
    o = _orders(spark, sf).select("route_key").distinct()
    k = F.col("route_key")
    return fx.route_parts(o).select(
        "route_key", "dest_area", "city", "origin_area",
        (~k.contains("_to_")).cast("int").alias("missing_to"),
        (F.regexp_count(k, F.lit("_")) < 2).cast("int").alias("few_underscores"),
        k.contains("__").cast("int").alias("double_underscore"))


@query("interactions", ORDERS_CTE + f"""
SELECT d.order_id,
  CAST(hour(d.order_created_at) IN (7, 8, 9, 12, 13, 18, 19, 20, 21, 22) AS INTEGER) * d.traffic_level
    AS rush_traffic_interaction,
  d.distance_km * d.rain AS distance_rain_interaction,
  v.rest_order_volume * d.num_items AS restaurant_complexity,
  pow(d.traffic_level, 2) AS traffic_squared,
  CAST(d.basket_value > 1500 AS INTEGER) AS is_high_value
FROM delivery_orders d JOIN (SELECT restaurant_id, COUNT(order_created_at) AS rest_order_volume
                             FROM delivery_orders GROUP BY restaurant_id) v USING (restaurant_id)
""", "M4, M8, P7, U23")
def interactions(spark, sf):
    o = _orders(spark, sf)
    o = fx.temporal_features(o)
    o = fx.entity_profile(o, "restaurant_id", {"rest_order_volume": F.count("order_created_at")})
    return fx.interaction_features(o).select(
        "order_id", "rush_traffic_interaction", "distance_rain_interaction", "restaurant_complexity",
        "traffic_squared", "is_high_value")


@query("time_split", ORDERS_CTE + """
SELECT split, COUNT(*) AS n_rows, MIN(order_created_at) AS first_ts, MAX(order_created_at) AS last_ts
FROM (SELECT order_created_at,
             CASE WHEN epoch_us(order_created_at) < (SELECT quantile_cont(epoch_us(order_created_at), 0.7)
                                                      FROM delivery_orders) THEN 'train' ELSE 'val' END AS split
      FROM delivery_orders)
GROUP BY split
""", "A17, W8, U27: 0.7 time quantile, train < cut <= val")
def time_split(spark, sf):
    # the quantile takes several passes: over a written column, not over the joins again
    o = materialize(_orders(spark, sf).select("order_created_at"), "order_times")
    return (fx.time_split(o, "order_created_at").groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("order_created_at").alias("first_ts"),
                 F.max("order_created_at").alias("last_ts")))


def _win(key: str, length: str) -> str:
    return (f"PARTITION BY {key} ORDER BY order_created_at RANGE BETWEEN INTERVAL '{length}' PRECEDING"
            f" AND INTERVAL '1 microsecond' PRECEDING")


def _enc(key: str) -> str:
    w = (f"PARTITION BY {key} ORDER BY order_created_at, order_id "
         f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    return (f"COALESCE(CAST(SUM(CAST({_T} AS DECIMAL(38,1))) OVER ({w}) AS DOUBLE) / COUNT({_T}) OVER ({w}),"
            f" (SELECT {_dmean(_T, 1)} FROM delivery_orders))")


FEATURE_SQL = DIMS_CTE.rstrip() + f""",
up AS ({SQL_USER_PROFILE}),
rp AS ({SQL_REST_PROFILE}),
ro AS ({SQL_ROUTE_PROFILE}),
j AS (
  SELECT d.*, r.name, r.area, r.avg_menu_price, r.price_band,
         u.city AS city_user, u.home_area, u.budget_segment,
         CAST(hour(d.order_created_at) AS INTEGER) AS hour,
         CAST(isodow(d.order_created_at) - 1 AS INTEGER) AS day_of_week,
         CAST(month(d.order_created_at) AS INTEGER) AS month,
         CAST(isodow(d.order_created_at) - 1 >= 5 AS INTEGER) AS is_weekend,
         CAST(hour(d.order_created_at) IN (7, 8, 9, 12, 13, 18, 19, 20, 21, 22) AS INTEGER) AS is_rush_hour,
         split_part(d.route_key, '_to_', 1) AS origin_part,
         substr(d.route_key, strpos(d.route_key, '_to_') + 4) AS dest_area
  FROM delivery_orders d LEFT JOIN restaurants_b r ON d.restaurant_id = r.restaurant_id
  LEFT JOIN users u ON d.user_id = u.user_id
),
f AS (
  SELECT j.*,
    round_even(sin(6.283185307179586 * hour / 24.0) * 1e12, 0) / 1e12 AS hour_sin,
    round_even(cos(6.283185307179586 * hour / 24.0) * 1e12, 0) / 1e12 AS hour_cos,
    round_even(sin(6.283185307179586 * day_of_week / 7.0) * 1e12, 0) / 1e12 AS day_sin,
    round_even(cos(6.283185307179586 * day_of_week / 7.0) * 1e12, 0) / 1e12 AS day_cos,
    CASE WHEN strpos(origin_part, '_') > 0 THEN substr(origin_part, 1, strpos(origin_part, '_') - 1)
         ELSE origin_part END AS city,
    CASE WHEN strpos(origin_part, '_') > 0 THEN substr(origin_part, strpos(origin_part, '_') + 1)
         ELSE 'UNKNOWN' END AS origin_area,
    up.user_avg_delivery_time, up.user_std_delivery_time, up.user_order_count, up.user_avg_basket,
    up.user_completion_rate, up.user_avg_distance,
    rp.rest_avg_delivery_time, rp.rest_std_delivery_time, rp.rest_completion_rate, rp.rest_order_volume,
    rp.rest_avg_basket,
    ro.route_avg_traffic, ro.route_std_traffic, ro.route_historical_delivery_time, ro.route_distance,
    ro.route_base_eta
  FROM j LEFT JOIN up ON j.user_id = up.user_id LEFT JOIN rp ON j.restaurant_id = rp.restaurant_id
  LEFT JOIN ro ON j.route_key = ro.route_key
)
SELECT order_id, basket_value, num_items, distance_km, rain, temperature, traffic_level, base_eta_minutes,
  name, city, area, avg_menu_price, price_band, city_user, home_area, budget_segment,
  hour, day_of_week, month, is_weekend, is_rush_hour, hour_sin, hour_cos, day_sin, day_cos,
  user_avg_delivery_time, user_std_delivery_time, user_order_count, user_avg_basket, user_completion_rate,
  user_avg_distance, rest_avg_delivery_time, rest_std_delivery_time, rest_completion_rate, rest_order_volume,
  rest_avg_basket, dest_area, origin_area, route_avg_traffic, route_std_traffic,
  route_historical_delivery_time, route_distance, route_base_eta,
  is_rush_hour * traffic_level AS rush_traffic_interaction,
  distance_km * rain AS distance_rain_interaction,
  rest_order_volume * num_items AS restaurant_complexity,
  pow(traffic_level, 2) AS traffic_squared,
  CAST(basket_value > 1500 AS INTEGER) AS is_high_value,
  CAST(COUNT(*) OVER ({_win('restaurant_id', '1 hour')}) AS BIGINT) AS rest_orders_last_1h,
  COALESCE(CAST(SUM(CAST({_T} AS DECIMAL(38,1))) OVER ({_win('route_key', '3 hours')}) AS DOUBLE)
           / COUNT({_T}) OVER ({_win('route_key', '3 hours')}), 0.0) AS route_avg_delivery_last_3h,
  COALESCE(CAST(SUM(CAST(traffic_level AS DECIMAL(38,2))) OVER ({_win('route_key', '2 hours')}) AS DOUBLE)
           / COUNT(traffic_level) OVER ({_win('route_key', '2 hours')}), 0.0) AS traffic_ma_2h,
  {_enc('restaurant_id')} AS restaurant_id_encoded,
  {_enc('user_id')} AS user_id_encoded,
  {_T},
  CASE WHEN epoch_us(order_created_at) < (SELECT quantile_cont(epoch_us(order_created_at), 0.7)
                                          FROM delivery_orders) THEN 'train' ELSE 'val' END AS split
FROM f
"""


def build_feature_matrix(spark, sf, validate: bool = False):
    orders = materialize(_orders(spark, sf), "delivery_orders")
    fm = fx.feature_matrix(orders, b.restaurants(spark, sf), b.users(spark, sf), scales=fx.Scales(traffic=2),
                           validate=validate, check_keys=validate)
    return _trig_rounded(fm)


@query("feature_matrix", FEATURE_SQL, "U20-U27 end to end: the model-ready matrix with its split label")
def feature_matrix(spark, sf):
    return build_feature_matrix(spark, sf)


FEATURE_NAMES = (
    "basket_value num_items distance_km rain temperature traffic_level base_eta_minutes name city area "
    "avg_menu_price price_band city_user home_area budget_segment hour day_of_week month is_weekend "
    "is_rush_hour hour_sin hour_cos day_sin day_cos user_avg_delivery_time user_std_delivery_time "
    "user_order_count user_avg_basket user_completion_rate user_avg_distance rest_avg_delivery_time "
    "rest_std_delivery_time rest_completion_rate rest_order_volume rest_avg_basket dest_area origin_area "
    "route_avg_traffic route_std_traffic route_historical_delivery_time route_distance route_base_eta "
    "rush_traffic_interaction distance_rain_interaction restaurant_complexity traffic_squared is_high_value "
    "rest_orders_last_1h route_avg_delivery_last_3h traffic_ma_2h restaurant_id_encoded user_id_encoded").split()
TEXT_FEATURES = {"name", "city", "area", "price_band", "city_user", "home_area", "budget_segment", "dest_area",
                 "origin_area"}


def _quality_sql() -> str:
    parts = []
    for c in FEATURE_NAMES:
        inf = ("0" if c in TEXT_FEATURES else
               f"SUM(CASE WHEN abs(CAST({c} AS DOUBLE)) = CAST('inf' AS DOUBLE) THEN 1 ELSE 0 END)")
        parts.append(
            f"SELECT '{c}' AS feature, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null, "
            f"CAST({inf} AS BIGINT) AS n_inf, MIN({_T}) AS target_min, CAST(COUNT(*) AS BIGINT) AS n_rows, "
            f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / COUNT(*) AS null_share FROM fm")
    return f"WITH fm AS ({FEATURE_SQL})\n" + "\nUNION ALL\n".join(parts)


@query("feature_validation", _quality_sql(), "U26, A18, A19, P9: one-pass quality table of the matrix")
def feature_validation(spark, sf):
    fm = build_feature_matrix(spark, sf)
    feats = [c for c in fm.columns if c not in ("order_id", _T, "split")]
    return fx.feature_quality(fm, feats, _T)
