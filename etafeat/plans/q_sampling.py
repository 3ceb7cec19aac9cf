"""User-stage queries: location weights, area profiles, budget mix, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from etafeat.operators import sampling as sm
from etafeat.plans import bindings as b
from etafeat.plans.q_clean import SQL_CLEAN, clean_restaurants, sql_title, sql_tokens
from etafeat.plans.registry import query
from etafeat.session import table

_LN_U = lambda key, salt: f"(-ln({b.sql_unit(key, salt)}))"

SQL_REST_AREAS = f"""WITH {b.SQL_PLACES},
r AS (SELECT p.city, p.area FROM supplier s JOIN places p ON s.s_nationkey = p.n_nationkey),
pa AS (SELECT city, area, COUNT(*) AS n_restaurants FROM r GROUP BY city, area),
pc AS (SELECT city, CAST(SUM(n_restaurants) AS BIGINT) AS n_city FROM pa GROUP BY city),
t AS (SELECT CAST(SUM(n_city) AS BIGINT) AS n_total FROM pc)
"""


def _rest(spark, sf):
    return b.restaurants(spark, sf).select("restaurant_id", "city", "area")


@query("location_weights", SQL_REST_AREAS + """
SELECT pa.city, pa.area, pa.n_restaurants, pc.n_city, pc.n_city / t.n_total AS city_share,
       pa.n_restaurants / pc.n_city AS area_share
FROM pa JOIN pc ON pa.city = pc.city CROSS JOIN t
""", "U3, A4, A8, F7: city share and area share within city")
def location_weights(spark, sf):
    return sm.location_weights(_rest(spark, sf))


SQL_AREA_PROFILE = f"""WITH cleaned AS ({SQL_CLEAN}),
ap AS (
  SELECT city, area, {b.sql_round('median(avg_menu_price)', 6)} AS median_price,
         list_sort(list_distinct(flatten(list({sql_tokens('cuisines_str')})))) AS cuisines
  FROM cleaned GROUP BY city, area
)
"""


@query("area_profile", SQL_AREA_PROFILE + "SELECT * FROM ap",
       "U4, A7, A14: median price and sorted distinct cuisines per (city, area)")
def area_profile(spark, sf):
    return sm.area_profile(clean_restaurants(spark, sf))


@query("budget_mix", SQL_AREA_PROFILE + """
SELECT city, area, median_price, m.segment, m.weight
FROM ap, (SELECT 1) d,
  LATERAL (SELECT unnest(CASE
    WHEN median_price IS NULL THEN [{'segment': 'mid', 'weight': 1.0}]
    WHEN median_price <= 250.0 THEN [{'segment': 'budget', 'weight': 0.7}, {'segment': 'mid', 'weight': 0.3}]
    WHEN median_price <= 500.0 THEN [{'segment': 'budget', 'weight': 0.2}, {'segment': 'mid', 'weight': 0.6},
                                     {'segment': 'premium', 'weight': 0.2}]
    ELSE [{'segment': 'mid', 'weight': 0.2}, {'segment': 'premium', 'weight': 0.5},
          {'segment': 'luxury', 'weight': 0.3}] END, recursive := true)) m
""", "U5, M7: segment mix from the local median price")
def budget_mix(spark, sf):
    return sm.budget_mix(sm.area_profile(clean_restaurants(spark, sf)))


def _cum_sql(src: str, group: str | None, value: str, weight: str) -> str:
    part = f"PARTITION BY {group} " if group else ""
    return f"""(SELECT {group + ', ' if group else ''}{value},
    (cum - w) / tot AS lo, CASE WHEN last THEN 2.0 ELSE cum / tot END AS hi
  FROM (SELECT {group + ', ' if group else ''}{value}, CAST({weight} AS BIGINT) AS w,
          CAST(SUM({weight}) OVER ({part}ORDER BY {value} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum,
          CAST(SUM({weight}) OVER ({part.strip()}) AS BIGINT) AS tot,
          ROW_NUMBER() OVER ({part}ORDER BY {value} DESC) = 1 AS last
        FROM {src}))"""


@query("weighted_pick", SQL_REST_AREAS + f""",
oc AS {_cum_sql('pc', None, 'city', 'n_city')},
oa AS {_cum_sql('pa', 'city', 'area', 'n_restaurants')},
u AS (SELECT c_custkey, {b.sql_unit('c_custkey', 'city')} AS uc, {b.sql_unit('c_custkey', 'area')} AS ua
      FROM customer),
pc1 AS (SELECT u.c_custkey, u.ua, oc.city FROM u JOIN oc ON u.uc >= oc.lo AND u.uc < oc.hi)
SELECT pc1.c_custkey, pc1.city, oa.area
FROM pc1 JOIN oa ON pc1.city = oa.city AND pc1.ua >= oa.lo AND pc1.ua < oa.hi
""", "U6, J11, F10: city by restaurant share, then area within city, keyed draws")
def weighted_pick(spark, sf):
    w = sm.location_weights(_rest(spark, sf))
    cities = w.select("city", "n_city").distinct()
    areas = w.select("city", "area", "n_restaurants")
    c = table(spark, sf, "customer").select("c_custkey")
    c = sm.weighted_pick(c, "c_custkey", cities, "city", "n_city", salt="city")
    c = sm.weighted_pick(c, "c_custkey", areas, "area", "n_restaurants", group="city", salt="area")
    return c.select("c_custkey", "city", "area")


@query("weighted_sample", f"""
SELECT p_brand, p_partkey, CAST(rnk AS INTEGER) AS __rank FROM (
  SELECT p_brand, p_partkey, ROW_NUMBER() OVER (PARTITION BY p_brand
           ORDER BY {_LN_U('p_partkey', 'sample')} / p_retailprice, p_partkey) AS rnk
  FROM part) WHERE rnk <= 5
""", "U7: 5 parts per brand without replacement, weight = retail price")
def weighted_sample(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice")
    return sm.weighted_sample(p, "p_brand", 5, "p_partkey", "p_retailprice").select(
        "p_brand", "p_partkey", F.col("__rank").cast("int").alias("__rank"))


SQL_FAVS = SQL_AREA_PROFILE + f""",
{b.SQL_PLACES},
users AS (SELECT c.c_custkey AS user_id, places.city, places.area AS home_area
          FROM customer c JOIN places ON c.c_nationkey = places.n_nationkey),
cand AS (SELECT users.user_id, unnest(ap.cuisines) AS cuisine
         FROM users JOIN ap ON users.city = ap.city AND users.home_area = ap.area),
ranked AS (SELECT user_id, cuisine, ROW_NUMBER() OVER (PARTITION BY user_id
             ORDER BY {_LN_U("CAST(user_id AS VARCHAR) || '|' || cuisine", 'fav')},
                      CAST(user_id AS VARCHAR) || '|' || cuisine) AS rnk
           FROM cand),
favs AS (SELECT user_id, string_agg({sql_title('cuisine', 'f')}, ', ' ORDER BY rnk) AS fav
         FROM ranked WHERE rnk <= 5 GROUP BY user_id),
user_favs AS (SELECT users.user_id, users.city, users.home_area, coalesce(favs.fav, '') AS fav_cuisines
              FROM users LEFT JOIN favs ON users.user_id = favs.user_id)
"""


@query("favourite_cuisines", SQL_FAVS + """
SELECT user_id, fav_cuisines FROM user_favs
""", "U7 per user: up to 5 local cuisines without replacement, display string")
def favourite_cuisines(spark, sf):
    return users_with_favs(spark, sf).select("user_id", "fav_cuisines")


def users_with_favs(spark, sf, restaurants=None):
    prof = sm.area_profile(restaurants if restaurants is not None else clean_restaurants(spark, sf))
    users = b.users(spark, sf).select("user_id", "city", "home_area")
    return sm.favourite_cuisines(users, prof)
