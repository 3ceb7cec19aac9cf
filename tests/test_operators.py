"""Stage operators on small hand-written frames."""

import datetime as dt
import itertools
import math

import pytest
from pyspark.sql import functions as F

from etafeat import config
from etafeat.operators import clean as cl
from etafeat.operators import demand as dm
from etafeat.operators import features as fx
from etafeat.operators import quality as qa
from etafeat.operators import routes as rt
from etafeat.operators import sampling as sm
from etafeat.operators.joins import require_known

T = dt.datetime

RAW_COLS = "ID string, Area string, City string, Restaurant string, Price string, `Avg ratings` double, " \
           "`Total ratings` bigint, `Food type` string, Address string, `Delivery time` double"


def raw_rows():
    return [
        ("1", " Koramangala ", "Bengaluru", "Dosa Hut", "200", 4.1, 100, "South Indian, chinese", "a", 30.0),
        ("2", "Koramangala", "bangalore", "Pizza Co", "0", None, 5, "pizza", "b", 25.0),
        ("3", "Indiranagar", "BLR", "Thai Box", "₹ 900", 3.9, 50, "['thai', 'asian']", "c", 40.0),
        ("4", "Bandra", "Bombay", "Vada Pav", "-5", 4.5, 2000, None, "d", 20.0),
        ("5", "Bandra", "mumbai", "Late", "400", 4.0, 10, "snacks", "e", None),
        ("6", "Kothrud", "Pune", "Misal", "abc", 4.2, 7, "maharashtrian", "f", 15.0),
    ]


def test_clean_restaurants_hand_rows(spark):
    raw = spark.createDataFrame(raw_rows(), RAW_COLS)
    out = {r.restaurant_id: r for r in cl.clean_restaurants(raw).collect()}
    assert set(out) == {"1", "2", "3", "4", "6"}             # missing delivery time dropped
    assert out["1"].city == "bangalore" and out["1"].city_raw == "Bengaluru" and out["1"].area == "Koramangala"
    # bangalore prices 200, NULL, NULL(₹ text) -> median 200 fills both
    assert out["2"].avg_menu_price == 200.0 and out["3"].avg_menu_price == 200.0
    # the median is taken before invalid delivery times are dropped (row 5 still counts)
    assert out["4"].avg_menu_price == 400.0 and out["4"].price_band == "mid"
    assert out["6"].avg_menu_price is None and out["6"].price_band is None  # all-null city stays null
    assert out["1"].cuisines_str == "South Indian, Chinese"
    # a raw list literal is split on commas like any cell, then title-cased piece by piece
    assert out["3"].cuisines == "['Thai', 'Asian']" == ", ".join(p.strip().title() for p in "['thai', 'asian']".split(","))
    assert out["4"].cuisines_str == ""
    for r in out.values():
        a_lat, a_lon = config.CITY_ANCHORS[r.city]
        assert abs(r.lat - a_lat) <= 0.03 and abs(r.lon - a_lon) <= 0.03
        assert 15 <= r.delivery_fee <= 80


def test_clean_rejects_duplicates_and_unknown_city(spark):
    rows = raw_rows()
    with pytest.raises(ValueError, match="duplicate"):
        cl.clean_restaurants(spark.createDataFrame(rows + [rows[0]], RAW_COLS))
    bad = [("9", "x", "Atlantis", "n", "100", 4.0, 1, "a", "z", 10.0)]
    with pytest.raises(ValueError, match="atlantis"):
        cl.clean_restaurants(spark.createDataFrame(bad, RAW_COLS)).collect()


def test_require_columns_names_missing(spark):
    df = spark.createDataFrame([(1,)], "ID int")
    with pytest.raises(KeyError, match="area"):
        qa.require_columns(df, config.RAW_RESTAURANT_COLUMNS)


def test_unknown_member_gate_names_key(spark):
    fact = spark.createDataFrame([("a",), ("zz",)], "k string")
    dim = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError, match="zz"):
        require_known(fact, "k", dim)


def test_one_row_group_std_is_null(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", 2.0), ("b", 3.0)], "k string, y double")
    got = {r.k: r.s for r in df.groupBy("k").agg(fx.dstd("y", 1).alias("s")).collect()}
    assert got["a"] is None and abs(got["b"] - math.sqrt(0.5)) < 1e-12


def test_time_split_quantile(spark):
    ts = [T(2024, 1, 1, 0), T(2024, 1, 1, 1), T(2024, 1, 1, 5), T(2024, 1, 2, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    cut = fx.split_point(df, "t").collect()[0][0]
    assert dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=cut) == T(2024, 1, 1, 6, 54)
    labels = [r.split for r in fx.time_split(df, "t").orderBy("t").collect()]
    assert labels == ["train", "train", "train", "val"]


def test_calendar_145_hours(spark):
    cal = rt.calendar(spark, "2024-03-31 23:00:00", 7).collect()
    assert len(cal) == 145 and cal[0][0] == T(2024, 3, 25, 23) and cal[-1][0] == T(2024, 3, 31, 23)
    with pytest.raises(ValueError):
        rt.calendar(spark, "2024-03-31 23:00:00", 0)


def test_route_network_equals_all_pairs(spark):
    areas = [("c1", f"a{i:02d}") for i in range(20)] + [("c2", "x"), ("c2", "y")]
    r = spark.createDataFrame(areas, "city string, area string")
    u = r.withColumnRenamed("area", "home_area")
    got = {(x.city, x.origin_area, x.dest_area) for x in rt.route_network(r, u, 15.0, 200).collect()}
    want = set()
    for city in ("c1", "c2"):
        names = sorted(a for c, a in areas if c == city)
        pairs = [(2 * abs(i - j), o, d) for (i, o), (j, d) in itertools.product(enumerate(names), repeat=2)
                 if o != d and 2 * abs(i - j) <= 15]
        want |= {(city, o, d) for _, o, d in sorted(pairs)[:200]}
    assert got == want


def test_base_eta_and_conditions(spark):
    df = spark.createDataFrame([("delhi_a_to_b", "delhi", 10.0, 0.5, 0.3, 0.2, T(2024, 7, 1, 8))],
                               "route_key string, city string, distance_km double, highway_pct double, "
                               "arterial_pct double, residential_pct double, timestamp timestamp_ntz")
    r = rt.expected_traffic(rt.expected_weather(df.withColumn(
        "eta", rt.base_eta("distance_km", "highway_pct", "arterial_pct", "residential_pct")))).collect()[0]
    assert abs(r.eta - 10.0 / (0.5 * 50 + 0.3 * 30 + 0.2 * 20) * 60) < 1e-12
    assert r.temperature == 23.0                   # delhi 24, -1 outside midday
    assert abs(r.traffic_level - min(1.0, 0.65 + 0.5 * 0.35 + 0.1)) < 1e-12  # peak Monday
    assert r.rain_exposure_factor == 2.0


def test_capacity_ignores_routeless_requests(spark):
    reqs = spark.createDataFrame(
        [(i, "r1", "k1" if i != 1 else "nope", T(2024, 1, 1, 10, i)) for i in range(8)]
        + [(20, "r1", "k1", T(2024, 1, 1, 11, 0))],
        "id int, restaurant_id string, route_key string, ts timestamp_ntz")
    cond = spark.createDataFrame([("k1", T(2024, 1, 1, 10), 0.5), ("k1", T(2024, 1, 1, 11), 0.6)],
                                 "route_key string, timestamp timestamp_ntz, traffic_level double")
    out = dm.accept_orders(reqs, cond, "restaurant_id", "ts", [F.col("ts"), F.col("id")], capacity=5)
    assert sorted(r.id for r in out.collect()) == [0, 2, 3, 4, 5, 20]


def test_order_status_and_delivery_rules(spark):
    df = spark.createDataFrame([(0.5, 40.0), (0.95, 40.0), (0.99, 40.0), (0.99, 20.0)], "p double, m double")
    got = [r[0] for r in df.select(dm.order_status("p", "m")).collect()]
    assert got == ["completed", "delayed", "cancelled", "delayed"]
    d = spark.createDataFrame([(10.0, 1.04), (20.0, 0.05)], "b double, n double")
    assert [r[0] for r in d.select(dm.delivery_time("b", "n")).collect()] == [15.0, 20.0]


def test_price_basket(spark):
    df = spark.createDataFrame([(100.0, 3, T(2024, 3, 30, 20)), (10.0, 1, T(2024, 3, 25, 9))],
                               "p double, n int, ts timestamp_ntz")
    got = [r[0] for r in df.select(dm.price_basket("p", "n", "ts")).collect()]
    assert got == [round(100 * 3 * 1.15 * 1.10, 2), 80.0]


def test_weighted_pick_shares_and_determinism(spark):
    opts = spark.createDataFrame([("a", 1), ("b", 3)], "v string, w bigint")
    users = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    p1 = sm.weighted_pick(users, "k", opts, "v", "w").repartition(7)
    p2 = sm.weighted_pick(users.repartition(3), "k", opts, "v", "w")
    c = {r.v: r["count"] for r in p1.groupBy("v").count().collect()}
    assert sum(c.values()) == 4000 and 0.7 < c["b"] / 4000 < 0.8
    assert sorted(map(tuple, p1.collect())) == sorted(map(tuple, p2.collect()))


def test_weighted_sample_without_replacement(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("string").alias("k"))
    out = sm.weighted_sample(df, "g", 5, "k").collect()
    assert len(out) == 15 and len({r.k for r in out}) == 15


def _brute_affinity(users, rests, routes, k):
    res = {}
    for u in users:
        favs = [f.strip() for f in u["fav_cuisines"].split(",")] if u["fav_cuisines"] else []
        cand = []
        for r in rests:
            if r["city"] != u["city"] or (r["city"], r["area"], u["home_area"]) not in routes:
                continue
            s = max(r["num_ratings"], 10) ** 0.6 * ((r["avg_rating"] if r["avg_rating"] is not None else 3.5) / 5) ** 1.2
            s *= 1.4 if any(f in (r["cuisines"] or "") for f in favs) else 1.0
            s *= 1.1 if r["area"] == u["home_area"] else 1.0
            cand.append((-s, r["restaurant_id"]))
        res[u["user_id"]] = [rid for _, rid in sorted(cand)[:k]]
    return res


def test_affinity_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    cuisines = ["Thai", "North Indian", "Indian", "Chinese", "Pizza", "Sushi", "Thai Curry"]
    areas = ["a", "b", "c", "d"]
    rests = [{"restaurant_id": f"r{i:03d}", "city": "c1", "area": rnd.choice(areas),
              "num_ratings": rnd.choice([1, 5, 50, 500, 5000]), "avg_rating": rnd.choice([None, 2.0, 3.5, 4.7]),
              "cuisines": ", ".join(rnd.sample(cuisines, rnd.randint(0, 3)))} for i in range(60)]
    users = [{"user_id": f"u{i}", "city": "c1", "home_area": rnd.choice(areas),
              "fav_cuisines": ", ".join(rnd.sample(cuisines, rnd.randint(0, 3)))} for i in range(40)]
    routes = {("c1", o, d) for o in areas for d in areas if (o, d) != ("a", "b")}
    rdf = spark.createDataFrame(rests, "restaurant_id string, city string, area string, num_ratings bigint, "
                                       "avg_rating double, cuisines string")
    udf = spark.createDataFrame(users, "user_id string, city string, home_area string, fav_cuisines string")
    tdf = spark.createDataFrame(sorted(routes), "city string, origin_area string, dest_area string")
    got = {}
    for r in dm.restaurant_affinity(udf, rdf, tdf, k=3).orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append(r.restaurant_id)
    want = {u: v for u, v in _brute_affinity(users, rests, routes, 3).items() if v}
    assert got == want


def test_gate_counts_and_enforce(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 1.5), (3, None)], "id int, t double")
    checks = {"traffic_in_range": F.col("t").between(0, 1)}
    assert qa.gate_counts(df, checks).collect()[0].traffic_in_range == 2
    with pytest.raises(ValueError, match="traffic_in_range"):
        qa.enforce(df, checks, key="id")


def test_quarantine_whole_chunk(spark):
    rows = [("k", T(2024, 1, 1) + dt.timedelta(hours=h), 0.5) for h in range(48)]
    rows[30] = ("k", T(2024, 1, 2, 6), 1.5)
    df = spark.createDataFrame(rows, "route_key string, timestamp timestamp_ntz, traffic_level double")
    good, bad = rt.quarantine_chunks(df, start="2024-01-01 00:00:00")
    assert good.count() == 24 and bad.count() == 24


def test_location_weights_shares(spark):
    df = spark.createDataFrame([("c1", "a"), ("c1", "a"), ("c1", "b"), ("c2", "x")], "city string, area string")
    w = {(r.city, r.area): (r.city_share, r.area_share) for r in sm.location_weights(df).collect()}
    assert w[("c1", "a")] == (0.75, 2 / 3) and w[("c2", "x")] == (0.25, 1.0)


def test_budget_mix(spark):
    prof = spark.createDataFrame([("c", "a", 200.0), ("c", "b", 400.0), ("c", "d", None)],
                                 "city string, area string, median_price double")
    got = {}
    for r in sm.budget_mix(prof).collect():
        got.setdefault(r.area, {})[r.segment] = r.weight
    assert got["a"] == {"budget": 0.7, "mid": 0.3} and got["d"] == {"mid": 1.0}
    assert abs(sum(got["b"].values()) - 1.0) < 1e-12


def test_exact_quantile_matches_percentile(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    m = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    for q in (0.0, 0.3, 0.7, 0.999, 1.0):
        want = ev.agg(F.percentile(m, F.lit(q))).collect()[0][0]
        got = fx.exact_quantile(ev, m, q, buckets=16)   # many passes
        assert abs(got - want) <= 1e-6 * max(1.0, abs(want)), (q, got, want)
    dup = spark.createDataFrame([(v,) for v in [1.0] * 50 + [2.0] * 3 + [9.0]], "v double")
    assert fx.exact_quantile(dup, F.col("v"), 0.5, buckets=2) == 1.0
    assert fx.exact_quantile(dup, F.col("v"), 0.5) == 1.0


def test_choice_probability_sums_over_all_pairs(spark):
    """``probability`` against the sum of a user's scores over every candidate restaurant."""
    import random
    rnd = random.Random(11)
    cuisines = ["Thai", "North Indian", "Indian", "Chinese", "Thai Curry"]
    rests = [(f"r{i}", "c", rnd.choice("ab"), rnd.choice([1, 50, 900]), rnd.choice([None, 2.0, 4.5]),
              ", ".join(rnd.sample(cuisines, rnd.randint(0, 3)))) for i in range(30)]
    users = [(f"u{i}", "c", rnd.choice("ab"), f) for i, f in enumerate(
        ["", None, "Indian", "Thai, Chinese", "Thai, Thai", "Thai,,Chinese", "Sushi", "Thai Curry, Indian, Chinese"])]
    routes = [("c", "a", "a"), ("c", "b", "a"), ("c", "b", "b")]
    got = dm.restaurant_affinity(
        spark.createDataFrame(users, "user_id string, city string, home_area string, fav_cuisines string"),
        spark.createDataFrame(rests, "restaurant_id string, city string, area string, num_ratings bigint, "
                                     "avg_rating double, cuisines string"),
        spark.createDataFrame(routes, "city string, origin_area string, dest_area string"), k=40).collect()
    for user, city, home, favs in users:
        favs = [f.strip() for f in favs.split(",")] if favs else []
        want = {}
        for rid, _, area, n, rating, text in rests:
            if ("c", area, home) in routes:
                s = max(n, 10) ** 0.6 * ((3.5 if rating is None else rating) / 5) ** 1.2
                want[rid] = s * (1.4 if any(f in text for f in favs) else 1.0) * (1.1 if area == home else 1.0)
        mine = {r.restaurant_id: r.probability for r in got if r.user_id == user}
        assert mine == pytest.approx({r: s / sum(want.values()) for r, s in want.items()})


def test_quarantine_keeps_every_row(spark):
    rows = [(i, k, f"2024-01-0{1 + i % 3} 05:00:00", t) for i, (k, t) in enumerate(
        [("a", 0.5), ("a", 7.0), (None, 0.1), (None, 0.2), ("b", 0.3), ("hot", 0.4)] * 50)]
    df = spark.createDataFrame(rows, "id int, k string, t string, level double").withColumn(
        "t", F.col("t").cast("timestamp_ntz"))
    checks = ~F.col("level").between(0.0, 1.0)
    args = dict(key="k", ts="t", start="2024-01-01 00:00:00", checks=checks)
    flagged = {r.id: r.quarantined for r in rt.flag_chunks(df, **args).collect()}
    good, aside = rt.quarantine_chunks(df, **args)
    assert {r.id for r in good.collect()} == {i for i, q in flagged.items() if not q}
    assert {r.id for r in aside.collect()} == {i for i, q in flagged.items() if q}
    bad = {(r[1], r[2]) for r in rows if r[3] > 1}
    assert flagged == {r[0]: (r[1], r[2]) in bad for r in rows}


def test_substring_matches_by_grams(spark):
    import random
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("aab é-") for _ in range(rnd.randint(0, 25))) for _ in range(60)] + [
        "Thai Curry, Indian", "", None, "Thai"]
    favs = ["a", "ab", "aab", "b é", "Thai", "Thai Curry", "hai", "zzz", "é", "- a", "a" * 9]
    rests = spark.createDataFrame(list(enumerate(texts)), "restaurant_id int, cuisines string")
    got = {tuple(r) for r in dm.cuisine_matches(rests, spark.createDataFrame([(f,) for f in favs], "fav string")).collect()}
    assert got == {(i, f) for i, t in enumerate(texts) for f in favs if f in (t or "")}


def test_posting_rows_are_linear_in_the_text(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(3000))  # no comma: one piece
    for n in (500, 1000, 3000):
        posted = dm.postings(spark.createDataFrame([(long[:n],)], "piece string"), "piece").count()
        assert posted <= dm.GRAM * n


def test_distinct_counts_and_sketches(spark):
    from etafeat.operators import quality as qa
    rows = spark.range(20_000).selectExpr("id % 7 AS a", "CASE WHEN id % 3 > 0 THEN CAST(id AS string) END AS b", "id / 2.0 AS c",
                                          "id % 4 AS part")
    got = qa.distinct_counts(rows, {"a": "a", "b": "b", "c": "c"})
    assert got.first().asDict() == {"a": 7, "b": 13333, "c": 20_000}
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert qa.distinct_counts(rows.filter("false"), {"a": "a"}).first().asDict() == {"a": 0}
    parts = qa.distinct_sketches(rows, ["a", "b", "c"], by=["part"])
    whole = qa.sketch_counts(parts, ["a", "b", "c"]).first()
    assert whole.a == 7 and abs(whole.b / 13333 - 1) < 0.02 and abs(whole.c / 20_000 - 1) < 0.02
    assert whole == qa.sketch_counts(qa.distinct_sketches(rows, ["a", "b", "c"]), ["a", "b", "c"]).first()
