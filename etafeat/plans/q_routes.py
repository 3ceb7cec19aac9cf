"""Route-stage queries (U8-U13, D-5, J3, J7, J8, O2, X1, W7, A26).

Binding: city = part type, area = part brand (both sides), so each city has
25 areas and the nearest-200 cap binds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from etafeat.functions.columns import floor_hour
from etafeat.operators import quality as qa
from etafeat.operators import routes as rt
from etafeat.operators.demand import demand_profile
from etafeat.plans import bindings as b
from etafeat.plans.registry import query
from etafeat.session import table

END, DAYS = "2024-03-31 23:00:00", 7


def _areas(spark, sf):
    return table(spark, sf, "part").select(F.lower("p_type").alias("city"), F.col("p_brand").alias("area"))


def network(spark, sf):
    a = _areas(spark, sf)
    return rt.route_network(a, a.withColumnRenamed("area", "home_area"))


SQL_NETWORK = """areas AS (SELECT DISTINCT lower(p_type) AS city, p_brand AS area FROM part),
idx AS (SELECT city, area, ROW_NUMBER() OVER (PARTITION BY city ORDER BY area) - 1 AS area_idx FROM areas),
pairs AS (
  SELECT o.city, o.area AS origin_area, d.area AS dest_area, CAST(abs(o.area_idx - d.area_idx) * 2 AS DOUBLE) AS grid_km
  FROM idx o JOIN idx d ON o.city = d.city AND o.area <> d.area
  WHERE abs(o.area_idx - d.area_idx) * 2 <= 15
),
network AS (
  SELECT city || '_' || origin_area || '_to_' || dest_area AS route_key, city, origin_area, dest_area, grid_km
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY city ORDER BY grid_km, origin_area, dest_area) AS rn FROM pairs)
  WHERE rn <= 200
)"""

_HW = b.sql_round(f"0.2 + 0.3 * {b.sql_unit('route_key', 'highway')}", 2)
_ART = b.sql_round(f"0.3 + 0.3 * {b.sql_unit('route_key', 'arterial')}", 2)
SQL_GEOMETRY = SQL_NETWORK + f""",
geometry AS (
  SELECT route_key, city, {b.sql_round(f"grid_km + 1.0 + 2.0 * {b.sql_unit('route_key', 'distance')}", 2)} AS distance_km,
         {_HW} AS highway_pct, {_ART} AS arterial_pct, {b.sql_round(f"1.0 - {_HW} - {_ART}", 2)} AS residential_pct
  FROM network
),
hours AS (SELECT unnest(generate_series(TIMESTAMP '2024-03-25 23:00:00', TIMESTAMP '{END}', INTERVAL 1 HOUR))
          AS "timestamp"),
rh AS (
  SELECT g.*, h."timestamp",
         distance_km / (highway_pct * 50.0 + arterial_pct * 30.0 + residential_pct * 20.0) * 60.0 AS base_eta_minutes
  FROM geometry g CROSS JOIN hours h
)"""

_TS = '"timestamp"'
SQL_WEATHER = f"""
  {b.sql_round(f"26.0 + CASE WHEN hour({_TS}) BETWEEN 12 AND 16 THEN 2.0 ELSE -1.0 END", 1)} AS temperature,
  CAST({b.sql_unit(f"route_key || '|' || CAST({_TS} AS VARCHAR)", 'rain')} < {b.sql_clip(
      f"CASE WHEN month({_TS}) IN (6, 7, 8, 9) THEN 0.15 ELSE 0.05 END"
      " * (1.0 + distance_km / 5.0 + residential_pct * 0.3)", 0.0, 0.8)} AS INTEGER) AS rain,
  {b.sql_round('distance_km / 5.0', 2)} AS rain_exposure_factor"""
SQL_TRAFFIC = b.sql_clip(
    f"0.5 + CASE WHEN hour({_TS}) BETWEEN 7 AND 10 OR hour({_TS}) BETWEEN 18 AND 21"
    " THEN highway_pct * 0.35 ELSE 0.0 END"
    f" - CASE WHEN isodow({_TS}) - 1 >= 5 THEN 0.1 ELSE 0.0 END + distance_km / 10.0 * 0.1", 0.05, 1.0)


def geometry(spark, sf):
    return rt.route_geometry(network(spark, sf))


def route_hours_df(spark, sf):
    g = geometry(spark, sf).withColumn(
        "base_eta_minutes", rt.base_eta("distance_km", "highway_pct", "arterial_pct", "residential_pct"))
    return rt.route_hours(g, rt.calendar_hours(END, DAYS))


@query("route_network", "WITH " + SQL_NETWORK + "\nSELECT * FROM network",
       "U8, X1, F8, J7, O2: directed area pairs per city within 15 km, nearest 200")
def route_network(spark, sf):
    return network(spark, sf)


@query("base_eta", "WITH " + SQL_GEOMETRY + """
SELECT route_key, distance_km, highway_pct, arterial_pct, residential_pct,
       distance_km / (highway_pct * 50.0 + arterial_pct * 30.0 + residential_pct * 20.0) * 60.0 AS base_eta_minutes
FROM geometry""", "U9, M10: route geometry from keyed draws and base ETA at mixed road speed")
def base_eta(spark, sf):
    g = geometry(spark, sf)
    return g.select("route_key", "distance_km", "highway_pct", "arterial_pct", "residential_pct",
                    rt.base_eta("distance_km", "highway_pct", "arterial_pct", "residential_pct")
                    .alias("base_eta_minutes"))


@query("route_hours", "WITH " + SQL_GEOMETRY + """
SELECT route_key, "timestamp" FROM rh""", "U10, D-5, J8: routes x 145 hourly calendar (7 days, both ends)")
def route_hours(spark, sf):
    return route_hours_df(spark, sf).select("route_key", "timestamp")


@query("expected_weather", "WITH " + SQL_GEOMETRY + f"""
SELECT route_key, "timestamp", {SQL_WEATHER} FROM rh""",
       "U11, M6: temperature, rain (keyed draw vs probability), exposure per route-hour")
def expected_weather(spark, sf):
    return rt.expected_weather(route_hours_df(spark, sf)).select(
        "route_key", "timestamp", "temperature", "rain", "rain_exposure_factor")


@query("expected_traffic", "WITH " + SQL_GEOMETRY + f"""
SELECT route_key, "timestamp", {SQL_TRAFFIC} AS traffic_level FROM rh""",
       "U12, M1, M6: peak, weekend and distance effects on the city baseline, clipped 0.05..1")
def expected_traffic(spark, sf):
    return rt.expected_traffic(route_hours_df(spark, sf)).select("route_key", "timestamp", "traffic_level")


@query("conditions_join", "WITH " + SQL_GEOMETRY + f""",
joined AS (
  SELECT route_key, "timestamp", {SQL_WEATHER}, {SQL_TRAFFIC} AS traffic_level, distance_km, highway_pct, base_eta_minutes
  FROM rh)
SELECT *, bool_or(traffic_level IS NULL OR traffic_level < 0.0 OR traffic_level > 1.0 OR distance_km IS NULL
                  OR highway_pct IS NULL OR base_eta_minutes IS NULL) OVER (
         PARTITION BY route_key, date_diff('hour', TIMESTAMP '2024-03-25 23:00:00', "timestamp") // 24) AS quarantined
FROM joined""", "J3, W7, U10-U12: weather ⋈ traffic on (route, hour); bad route-day chunks are flagged, all rows returned")
def conditions_join(spark, sf):
    return rt.flag_chunks(rt.conditions_table(route_hours_df(spark, sf)), start="2024-03-25 23:00:00")


@query("completeness", "WITH " + SQL_GEOMETRY + """
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
       CAST((SELECT COUNT(*) FROM network) * (SELECT COUNT(*) FROM hours) AS BIGINT) AS n_expected,
       COUNT(*) / ((SELECT COUNT(*) FROM network) * (SELECT COUNT(*) FROM hours)) AS ratio
FROM rh""", "A26: route-hour rows against routes x hours")
def completeness(spark, sf):
    cond = rt.conditions(route_hours_df(spark, sf).drop("base_eta_minutes"))
    spine = rt.route_hours(network(spark, sf), rt.calendar_hours(END, DAYS))
    return qa.completeness(cond, spine)


@query("demand_profile", """
WITH h AS (SELECT DISTINCT date_trunc('hour', ts) AS "timestamp" FROM events),
w AS (SELECT "timestamp",
        round_even((CASE WHEN hour("timestamp") IN (12, 13, 18, 19, 20, 21, 22) THEN 2.5 ELSE 1.0 END
        * CASE WHEN isodow("timestamp") - 1 >= 5 THEN 1.4 ELSE 1.0 END) * 1000000.0, 0) / 1000000.0 AS weight
      FROM h)
SELECT "timestamp", weight,
       weight / (SELECT CAST(SUM(CAST(weight AS DECIMAL(38,6))) AS DOUBLE) FROM w) AS probability FROM w
""", "U13, F10, D-3, D-4: order weight per hour of activity and its probability")
def demand_profile_q(spark, sf):
    hours = table(spark, sf, "events").select(floor_hour("ts").alias("timestamp")).distinct()
    return demand_profile(hours)



@query("event_quarantine", """
WITH firsts AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id),
chunks AS (
  SELECT e.event_id, e.user_id, e.ts, e.value, date_diff('hour', date_trunc('hour', f.t0), e.ts) // 24 AS chunk,
         e.value IS NULL OR e.value < 1.0 OR e.value > 400.0 AS bad
  FROM events e LEFT JOIN firsts f ON e.user_id IS NOT DISTINCT FROM f.user_id)
SELECT event_id, user_id, ts, value, bool_or(bad) OVER (PARTITION BY user_id, chunk) AS quarantined FROM chunks
""", "W7: readings outside their range put the user's whole day aside; all events are returned, those without a user too")
def event_quarantine(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    first = ev.groupBy(F.col("user_id").alias("of")).agg(floor_hour(F.min("ts")).alias("t0"))
    base = ev.join(first, F.col("user_id").eqNullSafe(F.col("of")), "left")
    # hours since the user's own first hour, as times from one start
    base = base.withColumn("at", F.timestamp_add("HOUR", F.timestamp_diff("HOUR", "t0", "ts"),
                                                 F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")))
    bad = F.col("value").isNull() | ~F.col("value").between(1.0, 400.0)
    return rt.flag_chunks(base, key="user_id", ts="at", start="2000-01-01 00:00:00", checks=bad).select(
        "event_id", "user_id", "ts", "value", "quarantined")


@query("hour_completeness", """
WITH have AS (SELECT DISTINCT event_type, date_trunc('hour', ts) AS h FROM events),
span AS (SELECT date_diff('hour', min(h), max(h)) + 1 AS n FROM have)
SELECT (SELECT count(*) FROM have)::BIGINT AS n_rows,
       ((SELECT count(DISTINCT event_type) FROM have) * (SELECT n FROM span))::BIGINT AS n_expected,
       (SELECT count(*) FROM have) / ((SELECT count(DISTINCT event_type) FROM have) * (SELECT n FROM span)) AS ratio
""", "A26: hours that hold an event of each type, against all hours of the table's own range")
def hour_completeness(spark, sf):
    have = table(spark, sf, "events").select("event_type", floor_hour("ts").alias("h")).distinct()
    span = have.agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    spine = have.select("event_type").distinct().crossJoin(span)  # one row
    return qa.completeness(have, rt.route_hours(spine, F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))))
