"""Trailing windows and target encoding on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from etafeat.functions.columns import round_half_even
from etafeat.operators.ordered import dense_ids, group_quantiles
from etafeat.operators.windows import Trailing, target_encode, trailing_windows
from etafeat.plans import bindings as b
from etafeat.plans.registry import query
from etafeat.session import table


def _frame(length: str) -> str:
    return (f"PARTITION BY {{k}} ORDER BY ts RANGE BETWEEN INTERVAL '{length}' PRECEDING "
            f"AND INTERVAL '1 microsecond' PRECEDING")


def _mean_sql(value: str, key: str, length: str, scale: int = 2) -> str:
    w = _frame(length).format(k=key)
    return (f"COALESCE(CAST(SUM(CAST({value} AS DECIMAL(38,{scale}))) OVER ({w}) AS DOUBLE)"
            f" / COUNT({value}) OVER ({w}), 0.0)")


@query("lag_count_1h", f"""
SELECT event_id, user_id, ts,
       CAST(COUNT(*) OVER ({_frame('1 hour').format(k='user_id')}) AS BIGINT) AS n_last_1h
FROM events
""", "F1, F4, U24: events of the same user in [t-1h, t)")
def lag_count_1h(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return trailing_windows(ev, "user_id", "ts", [Trailing("n_last_1h", "1h")])


@query("lag_count_1d", f"""
SELECT event_id, user_id, ts,
       CAST(COUNT(*) OVER ({_frame('1 day').format(k='user_id')}) AS BIGINT) AS n_last_1d
FROM events
""", "F1, F4: events of the same user in [t-1d, t)")
def lag_count_1d(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return trailing_windows(ev, "user_id", "ts", [Trailing("n_last_1d", "1d")])


@query("lag_mean_3h", f"""
SELECT event_id, user_id, ts, {_mean_sql('value', 'user_id', '3 hours')} AS value_mean_3h
FROM events
""", "F2, F4: mean value of the same user in [t-3h, t), empty -> 0")
def lag_mean_3h(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = trailing_windows(ev, "user_id", "ts", [Trailing("value_mean_3h", "3h", "mean", "value", 0.0, 2)])
    return out.drop("value")


@query("lag_mean_2h", f"""
SELECT event_id, event_type, ts, {_mean_sql('value', 'event_type', '2 hours')} AS value_mean_2h
FROM events
""", "F3, F4: mean value per event type in [t-2h, t); five hot keys")
def lag_mean_2h(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    out = trailing_windows(ev, "event_type", "ts", [Trailing("value_mean_2h", "2h", "mean", "value", 0.0, 2)])
    return out.drop("value")


@query("lag_mean_fine", f"""
SELECT event_id, user_id, ts, ROUND(COALESCE(AVG(value / 7) OVER ({_frame('3 hours').format(k='user_id')}), 0.0), 6) AS mean_3h,
       MAX(value) OVER ({_frame('3 hours').format(k='user_id')}) AS max_3h
FROM (SELECT * REPLACE (date_trunc('minute', ts) AS ts) FROM events)
""", "F2-F4: values with many decimals, many equal times; and a trailing maximum")
def lag_mean_fine(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"),
                                           "value", (F.col("value") / 7).alias("part"))
    out = trailing_windows(ev, "user_id", "ts", [Trailing("mean_3h", "3h", "mean", "part"),
                                                 Trailing("max_3h", "3h", "max", "value", None)], bucket="1h")
    return out.select("event_id", "user_id", "ts", F.round("mean_3h", 6).alias("mean_3h"), "max_3h")


_PRIOR_ORDERS = "(SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(38,2))) AS DOUBLE) / COUNT(o_totalprice) FROM orders)"


@query("target_encode_rows", f"""
SELECT o_orderkey, o_custkey, o_orderdate,
       COALESCE(
         CAST(SUM(CAST(o_totalprice AS DECIMAL(38,2))) OVER w AS DOUBLE) / COUNT(o_totalprice) OVER w,
         {_PRIOR_ORDERS}) AS cust_price_encoded
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""", "F5, A16, U25: expanding mean of earlier orders of the customer, empty -> global mean")
def target_encode_rows(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = target_encode(o, "o_custkey", "o_totalprice", "o_orderdate", "o_orderkey",
                        "cust_price_encoded", ties="rows", scale=2, bucket="365d")
    return out.drop("o_totalprice")


_PRIOR_EVENTS = "(SELECT CAST(SUM(CAST(value AS DECIMAL(38,2))) AS DOUBLE) / COUNT(value) FROM events)"


@query("target_encode_strict", f"""
SELECT event_id, user_id, ts,
       COALESCE(
         CAST(SUM(CAST(value AS DECIMAL(38,2))) OVER w AS DOUBLE) / COUNT(value) OVER w,
         {_PRIOR_EVENTS}) AS user_value_encoded
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts
             RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '1 microsecond' PRECEDING)
""", "F6: expanding mean over strictly earlier timestamps (tie-safe)")
def target_encode_strict(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = target_encode(ev, "user_id", "value", "ts", "event_id", "user_value_encoded",
                        ties="strict", scale=2, bucket="1d")
    return out.drop("value")


@query("lag_features_orders", f"""
SELECT o_orderkey, o_custkey, o_orderdate,
       CAST(COUNT(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate
            RANGE BETWEEN INTERVAL '30 days' PRECEDING AND INTERVAL '1 microsecond' PRECEDING) AS BIGINT)
         AS orders_last_30d,
       COALESCE(CAST(SUM(CAST(o_totalprice AS DECIMAL(38,2))) OVER w90 AS DOUBLE)
                / COUNT(o_totalprice) OVER w90, 0.0) AS price_mean_90d
FROM orders
WINDOW w90 AS (PARTITION BY o_custkey ORDER BY o_orderdate
               RANGE BETWEEN INTERVAL '90 days' PRECEDING AND INTERVAL '1 microsecond' PRECEDING)
""", "F1-F4 on day-grain times: same-day ties are excluded")
def lag_features_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = trailing_windows(o, "o_custkey", "o_orderdate", [
        Trailing("orders_last_30d", "30d"),
        Trailing("price_mean_90d", "90d", "mean", "o_totalprice", 0.0, 2),
    ])
    return out.drop("o_totalprice")



@query("dense_ids", """
SELECT l_orderkey, l_linenumber, n, CASE WHEN n < 100000 THEN 'O' || lpad(CAST(n AS VARCHAR), 5, '0')
                                         ELSE 'O' || CAST(n AS VARCHAR) END AS line_id
FROM (SELECT l_orderkey, l_linenumber, ROW_NUMBER() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                                          l_quantity, l_extendedprice) AS n FROM lineitem)
""", "F8, F11, C10: gapless padded numbers of all lines in time order, without a window over the table")
def dense_line_ids(spark, sf):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    li = table(spark, sf, "lineitem").select(*order)
    return dense_ids(li, order, "n", 1).select("l_orderkey", "l_linenumber", "n", F.format_string("O%05d", "n").alias("line_id"))


@query("price_quartiles", f"""
SELECT l_returnflag, {b.sql_round('quantile_cont(l_extendedprice, 0.25)', 6)} AS q1, {b.sql_round('median(l_extendedprice)', 6)} AS q2,
       {b.sql_round('quantile_cont(l_extendedprice, 0.75)', 6)} AS q3 FROM lineitem GROUP BY l_returnflag
""", "A6, A7: exact quartiles of three hot groups by running counts")
def price_quartiles(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    found = group_quantiles(li, ["l_returnflag"], "l_extendedprice", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return found.withColumns({name: round_half_even(name, 6) for name in ("q1", "q2", "q3")})
