"""Bindings of the delivery domain to the test tables, with SQL twins.

* restaurant = ``supplier``: city = region name, area = nation name, menu price
  = account balance repaired like a menu price (non-positive -> city median,
  capped 50..3000).
* user = ``customer``: city = region, home area = nation (as written), budget segment =
  market segment.
* delivery order = ``orders`` with at least one line: restaurant = supplier of
  the first line (lowest line number, then supplier key); items = line count;
  route ``region_suppliernation_to_customernation``; route geometry and the
  hour's weather and traffic from the route operators, with keyed hash draws
  in place of random numbers; delivery noise = (largest line quantity - 25.5)/5.

Everything is computed by Spark from the tables, so work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from etafeat import config
from etafeat.functions.columns import clip, positive_or_null, price_band, round_half_even, unit_hash
from etafeat.operators.demand import delivery_time, order_status, price_basket
from etafeat.operators.ordered import group_median
from etafeat.operators.routes import base_eta, expected_traffic, expected_weather, route_geometry
from etafeat.session import table

SEED = config.DEFAULT.seed
PRICE_MIN, PRICE_MAX = config.DEFAULT.price_min, config.DEFAULT.price_max


def places(spark: SparkSession, sf: str) -> DataFrame:
    """nation key -> (city = lower region name, area = nation name as written). 25 rows."""
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select("n_nationkey", F.lower("r_name").alias("city"), F.col("n_name").alias("area")))


def price_repair(df: DataFrame, price: str, group: str, out: str = "avg_menu_price",
                 lo: float = PRICE_MIN, hi: float = PRICE_MAX) -> DataFrame:
    """Non-positive -> NULL; NULL -> group median; cap to [lo, hi].

    The medians come from running sums over (group, value) counts; no task holds a group.
    """
    cleaned = df.withColumn(out, positive_or_null(price))
    med = group_median(cleaned, group, out)
    return (cleaned.join(med, group, "left")
                   .withColumn(out, clip(F.coalesce(F.col(out), F.col("__median")), lo, hi))
                   .drop("__median"))


def restaurants(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    df = (s.join(places(spark, sf), s.s_nationkey == F.col("n_nationkey"))
           .select(F.col("s_suppkey").alias("restaurant_id"), F.col("s_name").alias("name"),
                   "city", "area", "s_acctbal"))
    df = price_repair(df, "s_acctbal", "city")
    return df.withColumn("price_band", price_band("avg_menu_price")).drop("s_acctbal")


def users(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (c.join(places(spark, sf), c.c_nationkey == F.col("n_nationkey"))
             .select(F.col("c_custkey").alias("user_id"), "city", F.col("area").alias("home_area"),
                     F.lower("c_mktsegment").alias("budget_segment")))


def routes(spark: SparkSession, sf: str, seed: int = SEED) -> DataFrame:
    """Every pair of nations as a route with its geometry: at most 25 x 25 rows whatever the data volume."""
    pl = places(spark, sf)
    ends = F.collect_list(F.struct(F.col("n_nationkey").alias("c_nation"), F.col("area").alias("dest_area")))
    pairs = (pl.withColumn("ends", ends.over(Window.partitionBy(F.lit(0)))).withColumn("end", F.explode("ends"))
             .select(F.col("n_nationkey").alias("s_nation"), "end.c_nation", "city",
                     F.concat(F.col("city"), F.lit("_"), F.col("area"), F.lit("_to_"), F.col("end.dest_area"))
                      .alias("route_key"),
                     (F.abs(F.col("n_nationkey") - F.col("end.c_nation")) * 2).cast("double").alias("grid_km")))
    return route_geometry(pairs.filter("route_key is not null"), seed).drop("grid_km")


def delivery_orders(spark: SparkSession, sf: str, seed: int = SEED) -> DataFrame:
    lines = (table(spark, sf, "lineitem")
             .groupBy("l_orderkey")
             # first line = lowest (line number, supplier); a bigint order keeps a hash aggregate
             .agg(F.min_by("l_suppkey", F.col("l_linenumber").cast("bigint") * F.lit(1 << 32)
                           + F.col("l_suppkey")).alias("restaurant_id"),
                  F.count(F.lit(1)).cast("int").alias("num_items"),
                  F.max("l_quantity").alias("max_qty")))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    sup = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("s_nation"))
    cust = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("c_nation"))
    # the narrowest side first: customers meet orders before the lines do
    f = (o.join(cust, o.o_custkey == cust.c_custkey)
          .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
          .join(sup, F.col("restaurant_id") == F.col("s_suppkey")))
    # Geometry is an attribute of the route, not of the order: it is drawn once per pair
    # of nations and joined to the orders by broadcast, which are read once.
    f = f.join(F.broadcast(routes(spark, sf, seed)), ["s_nation", "c_nation"])
    f = f.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), "restaurant_id", "route_key",
        "city", F.col("o_orderdate").alias("order_created_at"), "o_totalprice", "num_items", "max_qty",
        "distance_km", "highway_pct", "arterial_pct", "residential_pct")
    oid = F.col("order_id")
    f = expected_weather(f, ts="order_created_at", draw=unit_hash(oid, seed, "rain"))
    f = expected_traffic(f, ts="order_created_at", digits=2)
    eta = base_eta("distance_km", "highway_pct", "arterial_pct", "residential_pct")
    actual = eta + (F.col("max_qty") - F.lit(25.5)) / F.lit(5.0)
    unit_price = F.col("o_totalprice") / (F.lit(100.0) * F.col("num_items"))
    variance = (unit_hash(oid, seed, "basket") - F.lit(0.5)) * F.lit(0.6)
    return f.select(
        "order_id", "user_id", "restaurant_id", "route_key", "order_created_at",
        price_basket(unit_price, "num_items", "order_created_at", variance).alias("basket_value"),
        "num_items", "distance_km", "rain", "temperature", "traffic_level",
        round_half_even(eta, 1).alias("base_eta_minutes"),
        delivery_time(actual).alias("actual_delivery_time_min"),
        order_status(unit_hash(oid, seed, "status"), actual).alias("order_status"),
    )


# ------------------------------------------------------------------ SQL twins

def sql_unit(key_sql: str, salt: str, seed: int = SEED) -> str:
    return (f"((CAST(CAST(('0x' || substr(sha256('{seed}|{salt}|' || CAST({key_sql} AS VARCHAR)), 1, 13))"
            f" AS BIGINT) AS DOUBLE) + 1.0) / 4503599627370497.0)")


def sql_round(x: str, digits: int) -> str:
    s = float(10 ** digits)
    return f"(round_even(({x}) * {s}, 0) / {s})"


def sql_clip(x: str, lo: float, hi: float) -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL THEN least(greatest(({x}), {lo}), {hi}) END)"


SQL_PLACES = """places AS (
  SELECT n.n_nationkey, lower(r.r_name) AS city, n.n_name AS area
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

SQL_RESTAURANTS = SQL_PLACES + f""",
rest_raw AS (
  SELECT s.s_suppkey AS restaurant_id, s.s_name AS name, p.city, p.area,
         CASE WHEN s.s_acctbal > 0 THEN s.s_acctbal END AS price
  FROM supplier s JOIN places p ON s.s_nationkey = p.n_nationkey
),
rest_median AS (SELECT city, {sql_round('median(price)', 6)} AS med FROM rest_raw GROUP BY city),
restaurants AS (
  SELECT r.restaurant_id, r.name, r.city, r.area,
         {sql_clip('coalesce(r.price, m.med)', PRICE_MIN, PRICE_MAX)} AS avg_menu_price
  FROM rest_raw r LEFT JOIN rest_median m ON r.city = m.city
),
restaurants_b AS (
  SELECT *, CASE WHEN avg_menu_price IS NULL OR avg_menu_price < 0 THEN NULL
                 WHEN avg_menu_price <= 250 THEN 'budget' WHEN avg_menu_price <= 500 THEN 'mid'
                 WHEN avg_menu_price <= 800 THEN 'premium' ELSE 'luxury' END AS price_band
  FROM restaurants
)"""

SQL_USERS = """users AS (
  SELECT c.c_custkey AS user_id, p.city, p.area AS home_area, lower(c.c_mktsegment) AS budget_segment
  FROM customer c JOIN places p ON c.c_nationkey = p.n_nationkey
)"""

_U = lambda salt, key="route_key": sql_unit(key, salt)
_HW = sql_round(f"0.2 + 0.3 * {_U('highway')}", 2)
_ART = sql_round(f"0.3 + 0.3 * {_U('arterial')}", 2)

SQL_ORDERS = f"""lines AS (
  SELECT l_orderkey, arg_min(l_suppkey, {{'n': l_linenumber, 's': l_suppkey}}) AS restaurant_id,
         CAST(count(*) AS INTEGER) AS num_items, max(l_quantity) AS max_qty
  FROM lineitem GROUP BY l_orderkey
),
o1 AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id, l.restaurant_id,
         sp.city || '_' || sp.area || '_to_' || cp.area AS route_key, sp.city,
         o.o_orderdate AS order_created_at, o.o_totalprice, l.num_items, l.max_qty,
         CAST(abs(sp.n_nationkey - cp.n_nationkey) * 2 AS DOUBLE) AS grid_km
  FROM orders o JOIN lines l ON o.o_orderkey = l.l_orderkey
  JOIN supplier s ON l.restaurant_id = s.s_suppkey JOIN places sp ON s.s_nationkey = sp.n_nationkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN places cp ON c.c_nationkey = cp.n_nationkey
),
o2 AS (
  SELECT *, {sql_round(f"grid_km + 1.0 + 2.0 * {_U('distance')}", 2)} AS distance_km,
         {_HW} AS highway_pct, {_ART} AS arterial_pct, {sql_round(f"1.0 - {_HW} - {_ART}", 2)} AS residential_pct
  FROM o1
),
o3 AS (
  SELECT *,
    {sql_round("26.0 + CASE WHEN hour(order_created_at) BETWEEN 12 AND 16 THEN 2.0 ELSE -1.0 END", 1)} AS temperature,
    CAST({_U('rain', 'order_id')} < {sql_clip(
        "CASE WHEN month(order_created_at) IN (6, 7, 8, 9) THEN 0.15 ELSE 0.05 END"
        " * (1.0 + distance_km / 5.0 + residential_pct * 0.3)", 0.0, 0.8)} AS INTEGER) AS rain,
    {sql_round(sql_clip(
        "0.5 + CASE WHEN hour(order_created_at) BETWEEN 7 AND 10 OR hour(order_created_at) BETWEEN 18 AND 21"
        " THEN highway_pct * 0.35 ELSE 0.0 END"
        " - CASE WHEN isodow(order_created_at) - 1 >= 5 THEN 0.1 ELSE 0.0 END"
        " + distance_km / 10.0 * 0.1", 0.05, 1.0), 2)} AS traffic_level,
    distance_km / (highway_pct * 50.0 + arterial_pct * 30.0 + residential_pct * 20.0) * 60.0 AS eta_raw
  FROM o2
),
delivery_orders AS (
  SELECT order_id, user_id, restaurant_id, route_key, order_created_at,
    {sql_round(sql_clip(
        "o_totalprice / (100.0 * num_items) * num_items"
        " * CASE WHEN hour(order_created_at) BETWEEN 19 AND 22 THEN 1.15 ELSE 1.0 END"
        " * CASE WHEN isodow(order_created_at) - 1 >= 5 THEN 1.10 ELSE 1.0 END"
        f" * (1.0 + ({_U('basket', 'order_id')} - 0.5) * 0.6)", 80.0, 2500.0), 2)} AS basket_value,
    num_items, distance_km, rain, temperature, traffic_level,
    {sql_round('eta_raw', 1)} AS base_eta_minutes,
    greatest(15.0, {sql_round('eta_raw + (max_qty - 25.5) / 5.0', 1)}) AS actual_delivery_time_min,
    CASE WHEN {_U('status', 'order_id')} < 0.92 THEN 'completed'
         WHEN {_U('status', 'order_id')} < 0.97 THEN 'delayed'
         WHEN eta_raw + (max_qty - 25.5) / 5.0 > 30.0 THEN 'cancelled' ELSE 'delayed' END AS order_status
  FROM o3
)"""


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",\n".join(blocks) + "\n"
