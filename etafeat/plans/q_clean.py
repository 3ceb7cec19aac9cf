"""Cleaning-stage queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat import config
from etafeat.functions.columns import (display_tokens, hash_mod, positive_or_null, price_band,
                                       round_half_even, title_case, token_array)
from etafeat.operators import clean as cl
from etafeat.operators import quality as qa
from etafeat.operators.joins import missing_keys
from etafeat.operators.windows import scaled, unscaled
from etafeat.plans import bindings as b
from etafeat.plans.registry import query
from etafeat.session import table

# Test binding: the five regions take the first five city anchors, in order.
REGIONS = ("africa", "america", "asia", "europe", "middle east")
BINDING_ANCHORS = dict(zip(REGIONS, list(config.CITY_ANCHORS.values())[:5]))


def raw_restaurants(spark: SparkSession, sf: str) -> DataFrame:
    """Raw listing per supplier, with raw-file column names.

    rating = 5 - 40 * mean line discount (1 decimal), ratings = line count,
    food type = sorted distinct part types supplied, delivery time = mean line
    quantity, price = account balance as text. Lines are pre-aggregated per
    (supplier, part) before the part join.
    """
    sp = (table(spark, sf, "lineitem")
          .groupBy("l_suppkey", "l_partkey")
          .agg(F.count(F.lit(1)).alias("n"),
               F.sum(scaled("l_discount", 2)).alias("sd"),
               F.sum(scaled("l_quantity", 2)).alias("sq")))
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    per = (sp.join(part, sp.l_partkey == part.p_partkey)
             .groupBy("l_suppkey")
             .agg(F.sum("n").alias("total"), F.sum("sd").alias("sd"), F.sum("sq").alias("sq"),
                  F.array_join(F.array_sort(F.collect_set(F.lower("p_type"))), ", ").alias("food_type")))
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    s = (table(spark, sf, "supplier")
         .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    raw = s.join(per, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    return raw.select(
        F.col("s_suppkey").cast("string").alias("ID"),
        F.col("n_name").alias("Area"),
        F.col("r_name").alias("City"),
        F.col("s_name").alias("Restaurant"),
        F.col("s_acctbal").cast("string").alias("Price"),
        round_half_even(F.lit(5.0) - F.lit(40.0) * unscaled(F.col("sd"), 2) / F.col("total"), 1).alias("Avg ratings"),
        F.col("total").cast("bigint").alias("Total ratings"),
        F.col("food_type").alias("Food type"),
        F.concat(F.col("s_name"), F.lit(", "), F.col("n_name")).alias("Address"),
        (unscaled(F.col("sq"), 2) / F.col("total")).alias("Delivery time"),
    )


def sql_hash_mod(key_sql: str, modulus: int = 10 ** 6) -> str:
    h = f"sha256({key_sql})"
    acc = "CAST(0 AS BIGINT)"
    for i in range(8):
        acc = f"(({acc} * 4294967296 + CAST(('0x' || substr({h}, {i * 8 + 1}, 8)) AS BIGINT)) % {modulus})"
    return acc


def sql_title(x: str, var: str = "t") -> str:
    """Python ``str.title`` in DuckDB: upper-case letters that follow a non-letter."""
    s = f"lower({x})"
    return (f"array_to_string(list_transform(range(1, length({s}) + 1), lambda {var}i: CASE WHEN {var}i = 1 OR NOT "
            f"regexp_matches(substr({s}, {var}i - 1, 1), '\\p{{L}}') THEN upper(substr({s}, {var}i, 1)) "
            f"ELSE substr({s}, {var}i, 1) END), '')")


def sql_tokens(x: str) -> str:
    return (f"coalesce(list_filter(list_transform(string_split({x}, ','), lambda tk: lower(trim(tk))),"
            f" lambda tk: tk <> ''), [])")


def sql_display(tokens: str) -> str:
    return f"coalesce(array_to_string(list_transform({tokens}, lambda tt: {sql_title('trim(tt)', 'q')}), ', '), '')"


def sql_canonical(x: str) -> str:
    k = f"lower(trim({x}))"
    cases = " ".join(f"WHEN '{a.replace(chr(39), chr(39) * 2)}' THEN '{c}'" for a, c in config.CITY_ALIASES.items())
    return f"(CASE {k} {cases} ELSE {k} END)"


def sql_anchor(city: str, idx: int) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v[idx]}" for k, v in BINDING_ANCHORS.items())
    return f"(CASE {city} {cases} END)"


SQL_RAW = f"""sp AS (
  SELECT l_suppkey, l_partkey, count(*) AS n, sum(CAST(l_discount AS DECIMAL(38,2))) AS sd,
         sum(CAST(l_quantity AS DECIMAL(38,2))) AS sq
  FROM lineitem GROUP BY l_suppkey, l_partkey
),
per AS (
  SELECT l_suppkey, sum(n) AS total, sum(sd) AS sd, sum(sq) AS sq,
         array_to_string(list_sort(list_distinct(list(lower(p_type)))), ', ') AS food_type
  FROM sp JOIN part ON sp.l_partkey = part.p_partkey GROUP BY l_suppkey
),
raw AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS restaurant_id, n.n_name AS area_raw, r.r_name AS city_in,
         s.s_name AS name_raw, CAST(s.s_acctbal AS VARCHAR) AS price,
         {b.sql_round('5.0 - 40.0 * CAST(per.sd AS DOUBLE) / per.total', 1)} AS avg_rating,
         CAST(per.total AS BIGINT) AS num_ratings, per.food_type AS cuisines_raw,
         s.s_name || ', ' || n.n_name AS address, CAST(per.sq AS DOUBLE) / per.total AS base_delivery_time_min
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN per ON s.s_suppkey = per.l_suppkey
)"""

SQL_CLEAN = "WITH " + SQL_RAW + f""",
c1 AS (
  SELECT restaurant_id, trim(area_raw) AS area, {sql_canonical('city_in')} AS city, trim(name_raw) AS name,
         avg_rating, num_ratings, address, base_delivery_time_min, CAST(city_in AS VARCHAR) AS city_raw,
         CASE WHEN TRY_CAST(price AS DOUBLE) > 0 THEN TRY_CAST(price AS DOUBLE) END AS p, cuisines_raw
  FROM raw
),
med AS (SELECT city, {b.sql_round('median(p)', 6)} AS m FROM c1 GROUP BY city),
c2 AS (
  SELECT c1.*, {b.sql_clip('coalesce(c1.p, med.m)', 50.0, 3000.0)} AS avg_menu_price
  FROM c1 LEFT JOIN med ON c1.city = med.city
),
c3 AS (
  SELECT *, {sql_display(sql_tokens('cuisines_raw'))} AS cuisines_str,
         {sql_hash_mod("lower(concat_ws('_', city, area, name))")} AS hm
  FROM c2 WHERE base_delivery_time_min > 0
)
SELECT restaurant_id, area, city, name, avg_rating, num_ratings, address, base_delivery_time_min, city_raw,
  avg_menu_price,
  CASE WHEN avg_menu_price IS NULL OR avg_menu_price < 0 THEN NULL WHEN avg_menu_price <= 250 THEN 'budget'
       WHEN avg_menu_price <= 500 THEN 'mid' WHEN avg_menu_price <= 800 THEN 'premium' ELSE 'luxury' END
    AS price_band,
  cuisines_str, cuisines_str AS cuisines,
  {sql_anchor('city', 0)} + ((hm % 1000) / 1000.0 - 0.5) * 0.06 AS lat,
  {sql_anchor('city', 1)} + (((hm // 1000) % 1000) / 1000.0 - 0.5) * 0.06 AS lon,
  {b.sql_round(b.sql_clip(f"20.0 + 20.0 * {b.sql_unit('restaurant_id', 'fee')} + "
                          f"(2.0 * {b.sql_unit('restaurant_id', 'fee_noise')} - 1.0) * 10.0", 15.0, 80.0), 2)}
    AS delivery_fee
FROM c3
"""


@query("clean_restaurants", SQL_CLEAN,
       "U1 end to end: P1-P3, C1-C4, W1, W2, A6, M1, M3, U2 geo, fee, unique-id gate")
def clean_restaurants(spark, sf):
    return cl.clean_restaurants(raw_restaurants(spark, sf), anchors=BINDING_ANCHORS)


@query("price_repair", """
WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS p FROM customer),
m AS (SELECT c_nationkey, """ + b.sql_round("median(p)", 6) + """ AS med FROM c GROUP BY c_nationkey)
SELECT c.c_custkey, c.c_nationkey, """ + b.sql_clip("coalesce(c.p, m.med)", 50.0, 3000.0) + """ AS price
FROM c LEFT JOIN m ON c.c_nationkey = m.c_nationkey
""", "W2, A6, M1: non-positive -> NULL -> nation median -> cap 50..3000")
def price_repair(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return b.price_repair(c, "c_acctbal", "c_nationkey", out="price", lo=50.0, hi=3000.0).drop("c_acctbal")


@query("price_band", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
  CASE WHEN l_extendedprice / 100.0 IS NULL OR l_extendedprice / 100.0 < 0 THEN NULL
       WHEN l_extendedprice / 100.0 <= 250 THEN 'budget' WHEN l_extendedprice / 100.0 <= 500 THEN 'mid'
       WHEN l_extendedprice / 100.0 <= 800 THEN 'premium' ELSE 'luxury' END AS band
FROM lineitem
""", "M3: right-closed bands on line price / 100")
def price_band_q(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return li.withColumn("band", price_band(F.col("l_extendedprice") / F.lit(100.0)))


@query("null_ratio_top5", """
SELECT c_nationkey, SUM(CASE WHEN c_acctbal > 0 THEN 0 ELSE 1 END) / COUNT(*) AS null_ratio
FROM customer GROUP BY c_nationkey
HAVING SUM(CASE WHEN c_acctbal > 0 THEN 0 ELSE 1 END) > 0
ORDER BY null_ratio DESC, c_nationkey LIMIT 5
""", "A5, O3: price missing ratio per nation after W2, non-zero, top 5")
def null_ratio_top5(spark, sf):
    c = table(spark, sf, "customer").withColumn("price", positive_or_null("c_acctbal"))
    return qa.group_null_ratio(c, "c_nationkey", "price", 5)


@query("title_case", f"""
SELECT p_partkey, {sql_title('p_name')} AS title
FROM part
""", "C5: Python-style title case")
def title_case_q(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return p.select("p_partkey", title_case("p_name").alias("title"))


@query("token_arrays", "WITH " + SQL_RAW + f"""
SELECT restaurant_id, CAST(len({sql_tokens('cuisines_raw')}) AS INTEGER) AS n_tokens,
       {sql_display(sql_tokens('cuisines_raw'))} AS display
FROM raw
""", "C3, C4: CSV cell -> clean token array -> display string")
def token_arrays(spark, sf):
    raw = raw_restaurants(spark, sf)
    t = token_array(F.col("Food type"))
    return raw.select(F.col("ID").alias("restaurant_id"), F.size(t).alias("n_tokens"),
                      display_tokens(t).alias("display"))


@query("unique_key_gate", """
SELECT 'supplier' AS relation, CAST(COUNT(*) AS BIGINT) AS n_rows,
       CAST(COUNT(DISTINCT s_suppkey) AS BIGINT) AS n_keys,
       CAST(COUNT(*) - COUNT(DISTINCT s_suppkey) AS BIGINT) AS n_duplicates FROM supplier
UNION ALL
SELECT 'lineitem', CAST(COUNT(*) AS BIGINT), CAST(COUNT(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT),
       CAST(COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) FROM lineitem
""", "U29, A1: unique-key gate as counts (supplier key unique; lineitem line key not)")
def unique_key_gate(spark, sf):
    s = qa.uniqueness(table(spark, sf, "supplier"), "s_suppkey").withColumn("relation", F.lit("supplier"))
    li = qa.uniqueness(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]) \
        .withColumn("relation", F.lit("lineitem"))
    return s.unionByName(li).select("relation", "n_rows", "n_keys", "n_duplicates")


@query("unknown_member_gate", """
SELECT 'orders without lines' AS problem, o_orderkey AS member FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL
SELECT 'lines with unknown part', l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
""", "W9, J12, X2: members missing from the anchor table (left anti)")
def unknown_member_gate(spark, sf):
    o = missing_keys(table(spark, sf, "orders"), "o_orderkey",
                     table(spark, sf, "lineitem"), "l_orderkey").select(
        F.lit("orders without lines").alias("problem"), F.col("o_orderkey").alias("member"))
    li = table(spark, sf, "lineitem").select("l_partkey")
    p = li.join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_anti")
    return o.unionByName(p.select(F.lit("lines with unknown part").alias("problem"),
                                  F.col("l_partkey").alias("member")))


@query("dedupe_first", """
SELECT l_orderkey, l_linenumber, arg_min(l_suppkey, (l_suppkey, l_partkey, l_quantity, l_extendedprice)) AS l_suppkey,
       arg_min(l_partkey, (l_suppkey, l_partkey, l_quantity, l_extendedprice)) AS l_partkey,
       arg_min(l_quantity, (l_suppkey, l_partkey, l_quantity, l_extendedprice)) AS l_quantity,
       arg_min(l_extendedprice, (l_suppkey, l_partkey, l_quantity, l_extendedprice)) AS l_extendedprice
FROM lineitem GROUP BY l_orderkey, l_linenumber
""", "O4, A13: one row per line key, deterministic keep-first")
def dedupe_first(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
                                             "l_quantity", "l_extendedprice")
    return cl.dedupe_first(li, ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_partkey", "l_quantity",
                                                                  "l_extendedprice"])


@query("geo_jitter", f"""
SELECT s_suppkey, lower(r_name) AS city,
  {sql_anchor('lower(r_name)', 0)} + (({sql_hash_mod("lower(concat_ws('_', lower(r_name), n_name, s_name))")} % 1000)
    / 1000.0 - 0.5) * 0.06 AS lat,
  {sql_anchor('lower(r_name)', 1)} + ((({sql_hash_mod("lower(concat_ws('_', lower(r_name), n_name, s_name))")}
    // 1000) % 1000) / 1000.0 - 0.5) * 0.06 AS lon,
  {sql_hash_mod("lower(concat_ws('_', lower(r_name), n_name, s_name))")} AS hash_mod
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""", "M9, U2: SHA-256 mod 10^6 -> deterministic jitter around the city anchor")
def geo_jitter(spark, sf):
    s = (table(spark, sf, "supplier").join(table(spark, sf, "nation"),
                                           F.col("s_nationkey") == F.col("n_nationkey"))
         .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
         .select("s_suppkey", F.lower("r_name").alias("city"), "n_name", "s_name"))
    out = cl.geo_jitter(s, ["city", "n_name", "s_name"], BINDING_ANCHORS)
    key = F.lower(F.concat_ws("_", "city", "n_name", "s_name"))
    return out.select("s_suppkey", "city", "lat", "lon", hash_mod(key).alias("hash_mod"))
