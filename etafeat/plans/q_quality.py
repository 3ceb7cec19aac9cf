"""Stage reports, guards and checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from etafeat.functions.columns import round_half_even, token_count
from etafeat.operators import quality as qa
from etafeat.operators.features import dmean, dstd, rate
from etafeat.plans import bindings as b
from etafeat.plans.q_clean import SQL_CLEAN, clean_restaurants
from etafeat.plans.q_features import FEATURE_SQL, ORDERS_CTE, build_feature_matrix
from etafeat.plans.q_routes import SQL_GEOMETRY, SQL_TRAFFIC, SQL_WEATHER, route_hours_df
from etafeat.plans.q_sampling import SQL_FAVS, users_with_favs
from etafeat.plans.registry import query
from etafeat.session import ensure_checkpoint_dir, materialize, table
from etafeat.sources import io
from etafeat.operators import routes as rt


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/etafeat/{name}-{uuid.uuid4().hex}"


def _dmean_sql(x: str, s: int) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,{s}))) AS DOUBLE) / COUNT({x})"


def _dstd_sql(x: str) -> str:
    """DuckDB's own deviation (Welford's recurrence), beside exact moments in Spark; both to 6 digits."""
    return b.sql_round(f"stddev_samp(CAST({x} AS DOUBLE))", 6)


@query("restaurant_report", f"WITH cleaned AS ({SQL_CLEAN})" + f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_restaurants,
  CAST(COUNT(DISTINCT restaurant_id) AS BIGINT) AS unique_restaurant_ids,
  CAST(COUNT(DISTINCT city) AS BIGINT) AS cities_covered,
  {_dmean_sql('avg_menu_price', 6)} AS avg_menu_price_mean,
  {_dstd_sql('avg_menu_price')} AS avg_menu_price_std,
  CAST(SUM(CASE WHEN lat IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_lat,
  CAST(SUM(CASE WHEN lon IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_lon,
  CAST(SUM(CASE WHEN base_delivery_time_min <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_delivery_time,
  CAST(SUM(CASE WHEN avg_menu_price < 50 OR avg_menu_price > 3000 THEN 1 ELSE 0 END) AS BIGINT) AS price_outliers,
  MIN(delivery_fee) AS fee_min, MAX(delivery_fee) AS fee_max, {_dmean_sql('delivery_fee', 2)} AS fee_mean
FROM cleaned""", "U28, A1, A2, A18: cleaned-restaurant report in one pass")
def restaurant_report(spark, sf):
    df = materialize(clean_restaurants(spark, sf), "restaurant_report")
    return qa.report_with_distinct(
        df, {"unique_restaurant_ids": "restaurant_id", "cities_covered": "city"},
        F.count(F.lit(1)).alias("total_restaurants"),
        dmean("avg_menu_price", 6).alias("avg_menu_price_mean"),
        round_half_even(dstd("avg_menu_price", 6), 6).alias("avg_menu_price_std"),
        F.sum(F.col("lat").isNull().cast("bigint")).alias("missing_lat"),
        F.sum(F.col("lon").isNull().cast("bigint")).alias("missing_lon"),
        F.sum((F.col("base_delivery_time_min") <= 0).cast("bigint")).alias("invalid_delivery_time"),
        F.sum(((F.col("avg_menu_price") < 50) | (F.col("avg_menu_price") > 3000)).cast("bigint"))
         .alias("price_outliers"),
        F.min("delivery_fee").alias("fee_min"), F.max("delivery_fee").alias("fee_max"),
        dmean("delivery_fee", 2).alias("fee_mean"))


@query("orders_report", ORDERS_CTE + f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_orders,
  CAST(COUNT(DISTINCT user_id) AS BIGINT) AS unique_users,
  CAST(COUNT(DISTINCT restaurant_id) AS BIGINT) AS unique_restaurants,
  CAST(COUNT(DISTINCT route_key) AS BIGINT) AS unique_routes,
  {_dmean_sql('basket_value', 2)} AS avg_basket_value,
  CAST(SUM(CASE WHEN order_status = 'completed' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS completion_rate,
  CAST(SUM(CASE WHEN order_status = 'delayed' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS delayed_rate,
  CAST(SUM(CASE WHEN order_status = 'cancelled' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS cancelled_rate,
  {_dmean_sql('actual_delivery_time_min', 1)} AS avg_delivery_time,
  {_dmean_sql('base_eta_minutes', 1)} AS avg_base_eta,
  {_dmean_sql('actual_delivery_time_min - base_eta_minutes', 1)} AS eta_vs_actual_gap,
  CAST(SUM(CASE WHEN basket_value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_basket_value,
  CAST(SUM(CASE WHEN actual_delivery_time_min IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_delivery_time,
  CAST(SUM(CASE WHEN route_key IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_route_key,
  MIN(actual_delivery_time_min) AS delivery_time_min, MAX(actual_delivery_time_min) AS delivery_time_max,
  MIN(order_created_at) AS date_start, MAX(order_created_at) AS date_end
FROM delivery_orders""", "U28, A1-A4, A9, A18, A21, A22: orders report in one pass")
def orders_report(spark, sf):
    o = materialize(b.delivery_orders(spark, sf), "orders_report")
    t, base = F.col("actual_delivery_time_min"), F.col("base_eta_minutes")
    st = F.col("order_status")
    return qa.report_with_distinct(
        o, {"unique_users": "user_id", "unique_restaurants": "restaurant_id", "unique_routes": "route_key"},
        F.count(F.lit(1)).alias("total_orders"),
        dmean("basket_value", 2).alias("avg_basket_value"),
        rate(st == "completed").alias("completion_rate"),
        rate(st == "delayed").alias("delayed_rate"),
        rate(st == "cancelled").alias("cancelled_rate"),
        dmean(t, 1).alias("avg_delivery_time"),
        dmean(base, 1).alias("avg_base_eta"),
        dmean(t - base, 1).alias("eta_vs_actual_gap"),
        F.sum(F.col("basket_value").isNull().cast("bigint")).alias("missing_basket_value"),
        F.sum(t.isNull().cast("bigint")).alias("missing_delivery_time"),
        F.sum(F.col("route_key").isNull().cast("bigint")).alias("missing_route_key"),
        F.min(t).alias("delivery_time_min"), F.max(t).alias("delivery_time_max"),
        F.min("order_created_at").alias("date_start"), F.max("order_created_at").alias("date_end"))


@query("users_report", SQL_FAVS + """
SELECT CAST(COUNT(*) AS BIGINT) AS total_users, CAST(COUNT(DISTINCT user_id) AS BIGINT) AS unique_user_ids,
  CAST(COUNT(DISTINCT city) AS BIGINT) AS cities_covered,
  CAST(SUM(CASE WHEN fav_cuisines = '' THEN 0 ELSE len(string_split(fav_cuisines, ',')) END) AS DOUBLE)
    / COUNT(*) AS avg_fav_cuisines,
  CAST(SUM(CASE WHEN city IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_city,
  CAST(SUM(CASE WHEN home_area IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_home_area,
  CAST(SUM(CASE WHEN fav_cuisines IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_fav_cuisines
FROM user_favs""", "U28, A1, A18, A23: users report with mean favourite count")
def users_report(spark, sf):
    u = materialize(users_with_favs(spark, sf), "users_report")
    return qa.report_with_distinct(
        u, {"unique_user_ids": "user_id", "cities_covered": "city"},
        F.count(F.lit(1)).alias("total_users"),
        (F.sum(token_count("fav_cuisines")).cast("double") / F.count(F.lit(1))).alias("avg_fav_cuisines"),
        F.sum(F.col("city").isNull().cast("bigint")).alias("missing_city"),
        F.sum(F.col("home_area").isNull().cast("bigint")).alias("missing_home_area"),
        F.sum(F.col("fav_cuisines").isNull().cast("bigint")).alias("missing_fav_cuisines"))


@query("segment_shares", """
WITH c AS (SELECT lower(c_mktsegment) AS segment, COUNT(*) AS n FROM customer GROUP BY 1)
SELECT segment, n, n / (SELECT SUM(n) FROM c) AS share,
       (n / (SELECT SUM(n) FROM c) <= 0.6 AND n / (SELECT SUM(n) FROM c) >= 0.02) AS within_bounds
FROM c""", "A3, A4, A25: value counts, shares and the share guard")
def segment_shares(spark, sf):
    c = table(spark, sf, "customer").select(F.lower("c_mktsegment").alias("segment"))
    return qa.share_guard(c, "segment")


@query("routes_report", "WITH " + SQL_GEOMETRY + f""",
cond AS (SELECT route_key, "timestamp", base_eta_minutes, distance_km, {SQL_WEATHER},
                {SQL_TRAFFIC} AS traffic_level FROM rh)
SELECT CAST(COUNT(DISTINCT route_key) AS BIGINT) AS total_routes,
  CAST(COUNT(DISTINCT "timestamp") AS BIGINT) AS total_timestamps,
  {b.sql_round('AVG(base_eta_minutes)', 9)} AS avg_base_eta, {b.sql_round('AVG(traffic_level)', 9)} AS avg_traffic_level,
  CAST(SUM(rain) AS DOUBLE) / COUNT(*) AS avg_rain,
  {_dmean_sql('temperature', 1)} AS avg_temperature, {_dmean_sql('distance_km', 2)} AS avg_distance_km,
  CAST(COUNT(*) AS BIGINT) AS total_rows_generated
FROM cond""", "U28, S4, S10: route-hour report over the whole table")
def routes_report(spark, sf):
    c = materialize(rt.conditions(route_hours_df(spark, sf).drop("base_eta_minutes")), "routes_report")
    return qa.report_with_distinct(
        c, {"total_routes": "route_key", "total_timestamps": "timestamp"},
        round_half_even(F.avg("base_eta_minutes"), 9).alias("avg_base_eta"),
        round_half_even(F.avg("traffic_level"), 9).alias("avg_traffic_level"),
        (F.sum("rain").cast("double") / F.count(F.lit(1))).alias("avg_rain"),
        dmean("temperature", 1).alias("avg_temperature"),
        dmean("distance_km", 2).alias("avg_distance_km"),
        F.count(F.lit(1)).alias("total_rows_generated"))


@query("feature_report", f"WITH fm AS ({FEATURE_SQL})" + """
SELECT CAST(COUNT(*) AS BIGINT) AS final_rows,
  CAST(SUM(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS train_rows,
  CAST(SUM(CASE WHEN split = 'val' THEN 1 ELSE 0 END) AS BIGINT) AS val_rows,
  """ + _dmean_sql("actual_delivery_time_min", 1) + """ AS target_mean,
  """ + _dstd_sql("actual_delivery_time_min") + """ AS target_std
FROM fm""", "U28, U27: matrix size, split sizes, target mean and std")
def feature_report(spark, sf):
    fm = build_feature_matrix(spark, sf)
    t = "actual_delivery_time_min"
    return fm.agg(F.count(F.lit(1)).alias("final_rows"),
                  F.sum((F.col("split") == "train").cast("bigint")).alias("train_rows"),
                  F.sum((F.col("split") == "val").cast("bigint")).alias("val_rows"),
                  dmean(t, 1).alias("target_mean"), round_half_even(dstd(t, 1), 6).alias("target_std"))


_LINES_SQL = """WITH lines AS (SELECT l_orderkey, CAST(COUNT(*) AS BIGINT) AS n_lines, MAX(l_quantity) AS max_qty,
                       MIN(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey),
j AS (SELECT o.*, l.n_lines, l.max_qty, l.first_ship FROM orders o LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey)
"""
_NULL_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
              "n_lines", "max_qty", "first_ship"]


@query("null_report", _LINES_SQL + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null, "
    f"CAST(COUNT(*) AS BIGINT) AS n_rows, SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / COUNT(*) AS null_share "
    f"FROM j" for c in _NULL_COLS) + ")", "A18: NULL count and share per column of orders ⟕ line summary")
def null_report(spark, sf):
    lines = (table(spark, sf, "lineitem").groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_quantity").alias("max_qty"),
                  F.min("l_shipdate").alias("first_ship")))
    o = table(spark, sf, "orders")
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")
    return qa.null_shares(j, _NULL_COLS)


@query("corr_checks", ORDERS_CTE + f"""
SELECT split_part(route_key, '_', 1) AS city, CAST(COUNT(*) AS BIGINT) AS n,
       {b.sql_round('corr(distance_km, base_eta_minutes)', 9)} AS corr_distance_eta,
       {b.sql_round('corr(traffic_level, actual_delivery_time_min)', 9)} AS corr_traffic_target
FROM delivery_orders GROUP BY 1""", "A20: correlations per city over the whole table")
def corr_checks(spark, sf):
    o = b.delivery_orders(spark, sf).withColumn("city", F.split("route_key", "_").getItem(0))
    return o.groupBy("city").agg(
        F.count(F.lit(1)).alias("n"),
        round_half_even(F.corr("distance_km", "base_eta_minutes"), 9).alias("corr_distance_eta"),
        round_half_even(F.corr("traffic_level", "actual_delivery_time_min"), 9).alias("corr_traffic_target"))


@query("spread_per_group", f"WITH cleaned AS ({SQL_CLEAN}),"
       + """ per AS (SELECT area, COUNT(DISTINCT price_band) AS n_distinct FROM cleaned GROUP BY area)
SELECT CAST(COUNT(*) AS BIGINT) AS n_groups,
       SUM(CASE WHEN n_distinct = 1 THEN 1 ELSE 0 END) / COUNT(*) AS single_value_share,
       AVG(n_distinct) AS mean_distinct
FROM per""", "A24: distinct price bands per area and the share of single-band areas")
def spread_per_group(spark, sf):
    return qa.spread_per_group(clean_restaurants(spark, sf), "area", "price_band")


_GATES = {
    "supplier": {"name_length": "length(s_name) BETWEEN 1 AND 18", "balance_in_range": "s_acctbal BETWEEN 0 AND 9000",
                 "name_case": "s_name LIKE 'Supplier#%'"},
    "customer": {"segment_allowed": "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY', 'HOUSEHOLD')",
                 "segment_case": "c_mktsegment = upper(c_mktsegment)", "balance_in_range": "c_acctbal BETWEEN 0 AND 9000"},
    "orders": {"price_positive": "o_totalprice > 0", "status_allowed": "o_orderstatus IN ('O', 'F')",
               "priority_length": "length(o_orderpriority) <= 10"},
}


@query("quality_gates", " UNION ALL ".join(
    f"SELECT '{t}' AS source, '{g}' AS gate, CAST(count(*) FILTER (WHERE NOT coalesce({c}, false)) AS BIGINT) AS violations,"
    f" CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for t, checks in _GATES.items() for g, c in checks.items()),
    "C11, U29, W1: case, length, range and allowed-set checks with their violations, one pass a table")
def quality_gates(spark, sf):
    out = None
    for name, checks in _GATES.items():
        one = qa.gate_counts(table(spark, sf, name), {g: F.expr(c) for g, c in checks.items()} | {"n_rows": F.lit(False)})
        pairs = ", ".join(f"'{g}', {g}" for g in checks)
        rows = one.selectExpr("n_rows", f"stack({len(checks)}, {pairs}) AS (gate, violations)").select(
            F.lit(name).alias("source"), "gate", "violations", "n_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("stable_deviation", f"""
SELECT l_returnflag, {b.sql_round('stddev_samp(l_linenumber / 1000.0)', 9)} AS deviation, COUNT(*) AS n_lines
FROM lineitem GROUP BY l_returnflag
""", "A2, A10-A12: deviation of values near 1e9 that differ by thousandths; the twin never sees the large part")
def stable_deviation(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", (F.lit(1e9) + F.col("l_linenumber") / 1000.0).alias("v"))
    return li.groupBy("l_returnflag").agg(round_half_even(dstd("v", 3), 9).alias("deviation"),
                                          F.count(F.lit(1)).alias("n_lines"))


@query("append_events", """
SELECT event_id, user_id, event_type, ts, value, coalesce(CAST(least((day(ts) - 1) // 10, 2) AS VARCHAR), 'undated') AS batch
FROM events
""", "S6, S7, X3: every batch of events is appended twice and read back once")
def append_events(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    third = F.coalesce(F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)).cast("string"), F.lit("undated"))
    path = _folder(spark, "append")
    for batch in ("0", "1", "1", "2", "undated", "0", "2"):  # repeats add nothing
        io.commit_batch(ev.filter(third == batch), path, batch)
    return io.read_batches(spark, path)


_COUNTED = ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"]


@query("distinct_counts", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS n_distinct, true AS sketch_close FROM lineitem" for c in _COUNTED) + ")",
    "A1, U28: exact distinct counts without row expansion; merged sketches within 2 % of them")
def distinct_counts(spark, sf):
    li = table(spark, sf, "lineitem").select(*_COUNTED)
    exact = qa.distinct_counts(li, {c: c for c in _COUNTED})
    # one sketch a year, merged: the estimate of the whole from parts
    parts = qa.distinct_sketches(li.withColumn("part", F.year("l_shipdate")), _COUNTED, by=["part"])
    est = qa.sketch_counts(parts, _COUNTED)
    long = lambda df, v: df.selectExpr(
        f"stack({len(_COUNTED)}, " + ", ".join(f"'{c}', {c}" for c in _COUNTED) + f") AS (column, {v})")
    return long(exact, "n_distinct").join(long(est, "estimate"), "column").select(
        "column", "n_distinct", (F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.02 * F.col("n_distinct")).alias("sketch_close"))


_DAMAGE = "CASE WHEN o_orderkey % 11 = 0 THEN 'type' WHEN o_orderkey % 11 = 1 THEN 'short' WHEN o_orderkey % 11 = 2 THEN 'long' END"
_LINE = """CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END || CAST(o_orderkey AS VARCHAR(30)) || ',' ||
  CASE WHEN o_orderkey % 11 = 1 THEN '' ELSE CAST(o_custkey AS VARCHAR(30)) || ',' END ||
  CASE WHEN o_orderkey % 11 = 3 THEN '"say ""' || o_orderpriority || '"", please"' ELSE o_orderpriority END ||
  CASE WHEN o_orderkey % 11 = 2 THEN ',more' ELSE '' END"""


@query("lenient_csv", f"""
WITH lines AS (SELECT *, {_LINE} AS line, {_DAMAGE} AS damage FROM orders),
n AS (SELECT COUNT(*) AS n_rows, COUNT(damage) AS n_bad FROM lines)
SELECT CASE WHEN damage IS NULL THEN o_orderkey END AS order_key, CASE WHEN damage IS NULL THEN o_custkey END AS cust_key,
  CASE WHEN damage IS NULL THEN CASE WHEN o_orderkey % 11 = 3 THEN 'say "' || o_orderpriority || '", please' ELSE o_orderpriority END END
    AS priority,
  CASE WHEN damage IS NOT NULL THEN line END AS bad_line, n_rows, n_bad FROM lines, n""",
    "S1, S2, P6: orders written as lines with damaged ones, read back leniently: good rows, bad lines, both counts")
def lenient_csv(spark, sf):
    path = _folder(spark, "lines")
    table(spark, sf, "orders").select(F.expr(_LINE).alias("value")).write.text(f"{path}/raw")
    schema = StructType.fromDDL("order_key long, cust_key long, priority string")
    good, bad, counts = io.read_csv_lenient(spark, f"{path}/raw", schema, f"{path}/read", header=False)
    rows = good.unionByName(bad.withColumnRenamed(io.BAD_LINE, "bad_line"), allowMissingColumns=True)
    return rows.withColumn("n_rows", F.lit(counts["n_rows"])).withColumn("n_bad", F.lit(counts["n_bad"]))


@query("observed_metrics", """
WITH kept AS (SELECT * FROM lineitem WHERE l_discount BETWEEN 0.0 AND 0.08),
big AS (SELECT l_orderkey, SUM(CAST(l_quantity AS DECIMAL(20,2))) AS quantity FROM kept GROUP BY l_orderkey)
SELECT (SELECT COUNT(*) FROM lineitem) AS read_rows, (SELECT COUNT(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem) AS read_undated,
  (SELECT COUNT(*) FROM kept) AS kept_rows, 1 - (SELECT COUNT(*) FROM kept) / (SELECT COUNT(*) FROM lineitem) AS drop_rate,
  COUNT(*) AS written_rows, CAST(MIN(quantity) AS DOUBLE) AS quantity_min, CAST(MAX(quantity) AS DOUBLE) AS quantity_max,
  CAST(SUM(quantity) AS DOUBLE) AS quantity_sum FROM big""",
    "S9, S10, W1: rows read, kept and written, drop rate and ranges observed in one write, as a nested document read back")
def observed_metrics(spark, sf):
    path = _folder(spark, "observed")
    w = io.ObservedWrite()
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_shipdate")
    li = w.watch(li, "read", n_undated=F.count_if(F.col("l_shipdate").isNull()))
    kept = w.watch(li.filter(F.col("l_discount").between(0.0, 0.08)), "kept")
    q = F.col("quantity").cast("double")
    big = kept.groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("decimal(20,2)")).alias("quantity"))
    big = w.watch(big, "written", quantity_min=F.min(q), quantity_max=F.max(q), quantity_sum=F.sum("quantity").cast("double"))
    w.write(big, f"{path}/data")
    io.write_metrics(spark, w.document() | {"drop_rate": w.drop_rate("read", "kept")}, f"{path}/metrics")
    point = "struct<n_rows:bigint"
    doc = spark.read.schema(f"read {point},n_undated:bigint>, kept {point}>, written {point},quantity_min:double,"
                            "quantity_max:double,quantity_sum:double>, drop_rate double").json(f"{path}/metrics")
    return doc.selectExpr("read.n_rows AS read_rows", "read.n_undated AS read_undated", "kept.n_rows AS kept_rows", "drop_rate",
                          "written.n_rows AS written_rows", "written.quantity_min", "written.quantity_max", "written.quantity_sum")
