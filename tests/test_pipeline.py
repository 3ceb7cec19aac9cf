"""The five stages chained on a small hand-made world."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from etafeat.plans import pipeline
from etafeat.session import materialize
from etafeat.sources import io, schemas

RAW = [
    ("1", "Koramangala", "Bengaluru", "Dosa Hut", "200", 4.1, 100, "South Indian, Chinese", "a", 30.0),
    ("2", "Indiranagar", "bangalore", "Pizza Co", "450", None, 5, "Pizza", "b", 25.0),
    ("3", "HSR", "BLR", "Thai Box", "900", 3.9, 50, "Thai, Asian", "c", 40.0),
    ("4", "Bandra", "Bombay", "Vada Pav", "120", 4.5, 2000, "Street Food", "d", 20.0),
    ("5", "Andheri", "mumbai", "Biryani", "350", 4.0, 10, "Biryani, North Indian", "e", 35.0),
]


def test_stages_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="etafeat-pipe-")
    io.write_csv(spark.createDataFrame(RAW, schemas.RAW_RESTAURANTS), f"{d}/raw")
    doc = pipeline.run_clean(spark, f"{d}/raw", d)
    assert doc["rows_written"] == 5 and doc["passed"] is True
    rest = spark.read.parquet(f"{d}/restaurants_clean.parquet")

    users = materialize(pipeline.users_stage(spark, rest, 200), "test_users")
    u = users.collect()
    assert len(u) == 200 and len({r.user_id for r in u}) == 200
    assert {r.city for r in u} <= {"bangalore", "mumbai"}
    assert all(r.budget_segment in {"budget", "mid", "premium", "luxury"} for r in u)
    assert all(8 <= r.home_lat <= 37 and 68 <= r.home_lon <= 97 for r in u)

    routes, bad = pipeline.routes_stage(spark, rest, users)
    routes = materialize(routes, "test_routes")
    assert bad.count() == 0 and routes.count() == routes.select("route_key").distinct().count() * 145

    r = routes.select("route_key", "timestamp").limit(1).collect()[0]
    parts = r.route_key.split("_to_")
    city, origin = parts[0].split("_", 1)
    rid = rest.filter((F.col("city") == city) & (F.col("area") == origin)).select("restaurant_id").first()[0]
    uid = users.first().user_id
    reqs = spark.createDataFrame(
        [(f"o{m}", uid, rid, r.route_key, r.timestamp + dt.timedelta(minutes=m // 4), 2) for m in range(8)]
        + [("o9", uid, rid, "nowhere_a_to_b", r.timestamp, 1)],
        "order_id string, user_id string, restaurant_id string, route_key string, ts timestamp_ntz, num_items int")
    orders = materialize(pipeline.orders_stage(reqs, rest, routes), "test_orders")
    o = orders.collect()
    # capacity 5 per restaurant-hour, ties by order id; routeless dropped; equal times keep their own ids
    assert sorted(x.order_id for x in o) == ["o0", "o1", "o2", "o3", "o4"]
    assert all(x.actual_delivery_time_min >= 15 and 80 <= x.basket_value <= 2500 for x in o)

    out = pipeline.run_features(orders, rest, users, d, os.path.join(d, "features.json"))
    assert out["final_rows"] == 5 and out["train_rows"] + out["val_rows"] == 5
    assert io.read_metrics(spark, os.path.join(d, "features.json")) == out


def test_run_pipeline_writes_every_stage(spark):
    d = tempfile.mkdtemp(prefix="etafeat-run-")
    raw = RAW + [("6", "Bandra", "Bombay", "No Time", "120", 4.5, 2000, "Street Food", "d", -1.0)]
    io.write_csv(spark.createDataFrame(raw, schemas.RAW_RESTAURANTS), f"{d}/raw")
    first = pipeline.run_clean(spark, f"{d}/raw", d)
    rest = spark.read.parquet(f"{d}/restaurants_clean.parquet")
    users = materialize(pipeline.users_stage(spark, rest, 50), "test_run_users")
    routes = materialize(pipeline.routes_stage(spark, rest, users)[0], "test_run_routes")
    r = routes.orderBy("route_key", "timestamp").first()
    city, origin = r.route_key.split("_to_")[0].split("_", 1)
    rid = rest.filter((F.col("city") == city) & (F.col("area") == origin)).first().restaurant_id
    uid = users.orderBy("user_id").first().user_id
    reqs = spark.createDataFrame([(f"o{m}", uid, rid, r.route_key, r.timestamp + dt.timedelta(minutes=m), 2) for m in range(3)],
                                 "order_id string, user_id string, restaurant_id string, route_key string, ts timestamp_ntz, num_items int")
    docs = pipeline.run_pipeline(spark, f"{d}/raw", reqs, d, 50)
    doc = docs["restaurants"]
    assert doc == first and doc["rows_written"] == 5 == doc["unique_restaurant_ids"] and doc["passed"]
    assert doc["rows_read"] == 6 and abs(doc["drop_rate"] - 1 / 6) < 1e-12 and docs["routes_quarantined"] == 0
    u = users.collect()
    doc = docs["users"]
    assert doc["total_users"] == 50 == doc["unique_user_ids"] == sum(doc["budget_segments"].values())
    assert doc["geographic_bounds_check"]["lat_min"] == min(x.home_lat for x in u)
    assert abs(doc["avg_fav_cuisines"] - sum(len([c for c in x.fav_cuisines.split(",") if c]) for x in u) / 50) < 1e-9
    n = routes.count()
    doc = docs["routes"]
    assert doc["total_rows_generated"] == n == doc["total_routes"] * doc["total_timestamps"]
    doc, o = docs["orders"], spark.read.parquet(f"{d}/orders.parquet").collect()
    assert doc["total_orders"] == 3 and doc["unique_routes"] == 1
    assert abs(doc["completion_rate"] + doc["delayed_rate"] + doc["cancelled_rate"] - 1) < 1e-12
    assert doc["delivery_time_range"]["max"] == max(x.actual_delivery_time_min for x in o)
    assert docs["features"]["final_rows"] == 3
    for name in ("users", "routes", "orders", "features"):
        assert io.read_metrics(spark, f"{d}/{name}.json") == docs[name]
    for name in ("restaurants_clean", "users", "routes_eta"):
        assert spark.read.parquet(f"{d}/{name}.parquet").count() > 0
