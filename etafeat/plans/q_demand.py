"""Order-stage queries: affinity, request enrichment with capacity, outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from etafeat.functions.columns import floor_hour, round_half_even, unit_hash
from etafeat.operators import demand as dm
from etafeat.operators import routes as rt
from etafeat.plans import bindings as b
from etafeat.plans.q_clean import clean_restaurants
from etafeat.plans.q_sampling import SQL_FAVS, users_with_favs
from etafeat.plans.registry import query
from etafeat.session import materialize, table

_SCORE = """pow(greatest(CAST(r.num_ratings AS DOUBLE), 10.0), 0.6) * pow(coalesce(r.avg_rating, 3.5) / 5.0, 1.2)
    * CASE WHEN len(list_filter(CASE WHEN coalesce(u.fav_cuisines, '') = '' THEN []
                                     ELSE list_transform(string_split(u.fav_cuisines, ','), lambda x: trim(x)) END,
                                lambda f: contains(coalesce(r.cuisines, ''), f))) > 0 THEN 1.4 ELSE 1.0 END
    * CASE WHEN r.area = u.home_area THEN 1.1 ELSE 1.0 END"""


@query("affinity_topk", SQL_FAVS + f""",
a_all AS (SELECT city, area FROM cleaned UNION SELECT city, home_area FROM user_favs),
a_idx AS (SELECT city, area, ROW_NUMBER() OVER (PARTITION BY city ORDER BY area) - 1 AS ix FROM a_all),
a_pairs AS (
  SELECT o.city, o.area AS origin_area, d.area AS dest_area, abs(o.ix - d.ix) * 2 AS km
  FROM (SELECT DISTINCT r.city, r.area, i.ix FROM cleaned r JOIN a_idx i ON r.city = i.city AND r.area = i.area) o
  JOIN (SELECT DISTINCT u.city, u.home_area AS area, i.ix FROM user_favs u
        JOIN a_idx i ON u.city = i.city AND u.home_area = i.area) d
    ON o.city = d.city AND o.area <> d.area AND abs(o.ix - d.ix) * 2 <= 15
),
a_net AS (SELECT city, origin_area, dest_area FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY city ORDER BY km, origin_area, dest_area) AS rn FROM a_pairs)
  WHERE rn <= 200),
scored AS (
  SELECT u.user_id, r.restaurant_id, r.city || '_' || r.area || '_to_' || u.home_area AS route_key,
         {_SCORE} AS score
  FROM user_favs u JOIN cleaned r ON u.city = r.city
  JOIN a_net n ON n.city = r.city AND n.origin_area = r.area AND n.dest_area = u.home_area
)
SELECT user_id, restaurant_id, route_key, CAST(rk AS INTEGER) AS rank, {b.sql_round('score', 6)} AS score,
       {b.sql_round('score / total', 9)} AS probability
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, restaurant_id) AS rk,
             SUM(score) OVER (PARTITION BY user_id) AS total FROM scored)
WHERE rk <= 3
""", "U14, F10, J4, J9, W6, M4: top-3 restaurants per user by affinity, with choice probability, exact without all pairs")
def affinity_topk(spark, sf):
    # stage boundaries: cleaned restaurants and users are read by several branches
    rest = materialize(clean_restaurants(spark, sf), "restaurants_clean")
    users = materialize(users_with_favs(spark, sf, rest), "users")
    routes = rt.route_network(rest.select("city", "area"), users.select("city", "home_area"))
    top = dm.restaurant_affinity(users, rest, routes, k=3)
    return top.withColumns({"score": round_half_even("score", 6), "probability": round_half_even("probability", 9)})


def _self_routes(spark, sf):
    pl = b.places(spark, sf)
    return pl.select(F.concat_ws("_", "city", "area", F.lit("to"), "area").alias("route_key"), "city",
                     F.lit(0.0).alias("grid_km")).distinct()


@query("request_capacity", f"""
WITH {b.SQL_PLACES},
routes AS (SELECT DISTINCT city || '_' || area || '_to_' || area AS route_key, city, 0.0 AS grid_km FROM places),
geometry AS (
  SELECT route_key, city,
         {b.sql_round(f"grid_km + 1.0 + 2.0 * {b.sql_unit('route_key', 'distance')}", 2)} AS distance_km,
         {b.sql_round(f"0.2 + 0.3 * {b.sql_unit('route_key', 'highway')}", 2)} AS highway_pct,
         {b.sql_round(f"0.3 + 0.3 * {b.sql_unit('route_key', 'arterial')}", 2)} AS arterial_pct
  FROM routes
),
hours AS (SELECT unnest(generate_series((SELECT min(date_trunc('hour', ts)) FROM events),
                                        (SELECT max(date_trunc('hour', ts)) FROM events), INTERVAL 1 HOUR)) AS h),
cond AS (
  SELECT g.route_key, h.h,
         {b.sql_round("26.0 + CASE WHEN hour(h.h) BETWEEN 12 AND 16 THEN 2.0 ELSE -1.0 END", 1)} AS temperature,
         {b.sql_clip("0.5 + CASE WHEN hour(h.h) BETWEEN 7 AND 10 OR hour(h.h) BETWEEN 18 AND 21"
                     " THEN g.highway_pct * 0.35 ELSE 0.0 END"
                     " - CASE WHEN isodow(h.h) - 1 >= 5 THEN 0.1 ELSE 0.0 END + g.distance_km / 10.0 * 0.1",
                     0.05, 1.0)} AS traffic_level
  FROM geometry g CROSS JOIN hours h
),
req AS (
  SELECT e.event_id, e.user_id, e.ts, p.city || '_' || p.area || '_to_' || p.area AS route_key
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN places p ON c.c_nationkey = p.n_nationkey
),
enriched AS (
  SELECT r.*, c.temperature, c.traffic_level, date_trunc('hour', r.ts) AS hr
  FROM req r JOIN cond c ON r.route_key = c.route_key AND date_trunc('hour', r.ts) = c.h
)
SELECT event_id, user_id, ts, route_key, temperature, traffic_level FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, hr ORDER BY ts, event_id) AS rn FROM enriched)
WHERE rn <= 1
""", "U17, U18, J5, F9, D-4: requests get their (route, hour) conditions, then one per user-hour")
def request_capacity(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts")
    span = ev.agg(F.min(floor_hour("ts")).alias("lo"), F.max(floor_hour("ts")).alias("hi"))
    geo = rt.route_geometry(_self_routes(spark, sf)).crossJoin(span)  # one row
    cond = rt.route_hours(geo, F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR")))
    cond = rt.expected_traffic(rt.expected_weather(cond))
    cond = cond.select("route_key", "timestamp", "temperature", "traffic_level")
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    req = (ev.join(cust, ev.user_id == cust.c_custkey)
             .join(b.places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
             .select("event_id", "user_id", "ts",
                     F.concat_ws("_", "city", "area", F.lit("to"), "area").alias("route_key")))
    out = dm.accept_orders(req, cond, "user_id", "ts", [F.col("ts"), F.col("event_id")], capacity=1)
    return out.select("event_id", "user_id", "ts", "route_key", "temperature", "traffic_level")


@query("order_outcomes", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  {b.sql_round(b.sql_clip(
      "l_extendedprice / l_quantity * l_quantity"
      " * CASE WHEN hour(l_shipdate) BETWEEN 19 AND 22 THEN 1.15 ELSE 1.0 END"
      " * CASE WHEN isodow(l_shipdate) - 1 >= 5 THEN 1.10 ELSE 1.0 END * (1.0 + 0.0)", 80.0, 2500.0), 2)}
    AS basket_value,
  CASE WHEN {b.sql_unit("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)", 'status')} < 0.92
       THEN 'completed'
       WHEN {b.sql_unit("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)", 'status')} < 0.97
       THEN 'delayed'
       WHEN l_quantity > 30.0 THEN 'cancelled' ELSE 'delayed' END AS order_status,
  greatest(15.0, {b.sql_round('l_quantity * 1.5 + (l_discount * 100.0 - 5.0)', 1)}) AS delivery_minutes
FROM lineitem
""", "U15, U16, U19, M7, M11: basket value, status rule and floored delivery time per line")
def order_outcomes(spark, sf):
    li = table(spark, sf, "lineitem")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        dm.price_basket(F.col("l_extendedprice") / F.col("l_quantity"), "l_quantity", "l_shipdate")
          .alias("basket_value"),
        dm.order_status(unit_hash(key, b.SEED, "status"), "l_quantity").alias("order_status"),
        dm.delivery_time(F.col("l_quantity") * F.lit(1.5), F.col("l_discount") * F.lit(100.0) - F.lit(5.0))
          .alias("delivery_minutes"))
