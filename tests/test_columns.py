"""Hand-computed edge cases for the Column functions (FIXTURES §2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from etafeat.functions import columns as C


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_price_band_edges(spark):
    prices = [0.0, -1.0, 250.0, 250.01, 500.0, 800.0, 801.0, None]
    got = one(spark, [(p,) for p in prices], "p double", C.price_band("p"))
    assert got == ["budget", None, "budget", "mid", "mid", "premium", "luxury", None]


def test_title_case_like_python(spark):
    words = ["north indian", "mom's pizza", "north-indian", "7up", "ÉCLAIR au chocolat"]
    got = one(spark, [(w,) for w in words], "w string", C.title_case("w"))
    assert got == [w.title() for w in words]


def test_round_half_even_scaled(spark):
    got = one(spark, [(0.125,), (1.005,), (0.005,), (2.675,)], "x double", C.round_half_even("x", 2))
    assert got == [0.12, 1.0, 0.0, 2.68]


def test_parse_route(spark):
    rows = spark.createDataFrame([("delhi_a_to_b_to_c",), ("pune_x",), ("mumbai_to_y",)], "k string") \
        .select(C.parse_route("k").alias("p")).select("p.*").collect()
    assert tuple(rows[0]) == ("delhi", "a", "b_to_c")
    assert tuple(rows[1]) == ("pune", "x", "UNKNOWN")
    assert tuple(rows[2]) == ("mumbai", "UNKNOWN", "y")


def test_route_key_problems(spark):
    got = one(spark, [("a_b_to_c",), ("abc",), ("a__b_to_c",)], "k string", C.route_key_problems("k"))
    assert got[0] == [] and "missing _to_" in got[1] and "double _" in got[2]


def test_hash_mod_matches_python_bigint(spark):
    import hashlib
    keys = ["bangalore_koramangala_U00001", "x", "delhi_a_b"]
    got = one(spark, [(k,) for k in keys], "k string", C.hash_mod("k", 10 ** 6))
    assert got == [750037, 915265, 730732]
    assert got == [int(hashlib.sha256(k.encode()).hexdigest(), 16) % 10 ** 6 for k in keys]


def test_unit_hash_in_open_interval(spark):
    got = one(spark, [(i,) for i in range(200)], "i long", C.unit_hash("i", 42, "t"))
    assert all(0.0 < u < 1.0 for u in got) and len(set(got)) == 200


def test_canonical_alias(spark):
    got = one(spark, [(" Bengaluru ",), ("BOMBAY",), ("Goa",), (None,)], "c string", C.canonical("c"))
    assert got == ["bangalore", "mumbai", "goa", None]


def test_token_array_and_display(spark):
    got = spark.createDataFrame([("North Indian, ,chinese",), (None,)], "c string").select(
        C.token_array("c").alias("t")).select("t", C.display_tokens("t").alias("d")).collect()
    assert got[0].t == ["north indian", "chinese"] and got[0].d == "North Indian, Chinese"
    assert got[1].t == [] and got[1].d == ""


def test_display_text_list_literal(spark):
    got = one(spark, [("['north indian', 'chinese']",), ("thai, sushi",)], "c string", C.display_text("c"))
    assert got == ["North Indian, Chinese", "Thai, Sushi"]


def test_clip_keeps_null(spark):
    got = one(spark, [(1.0,), (None,), (5000.0,)], "x double", C.clip("x", 50, 3000))
    assert got == [50.0, None, 3000.0]


def test_to_double_lenient(spark):
    got = one(spark, [("12.5",), ("₹ 200",), ("nan",), (None,)], "x string", C.to_double("x"))
    assert got == [12.5, None, None, None]


def test_floor_hour_and_weekday(spark):
    t = dt.datetime(2024, 3, 31, 10, 20, 5)
    r = spark.createDataFrame([(t,)], "t timestamp_ntz").select(
        C.floor_hour("t").alias("h"), F.weekday("t").alias("w")).collect()[0]
    assert r.h == dt.datetime(2024, 3, 31, 10) and r.w == 6


def test_format_id_keeps_wide_numbers(spark):
    got = one(spark, [(1,), (123456,)], "n long", C.format_id("U", "n", 5))
    assert got == ["U00001", "U123456"]


def test_token_count(spark):
    got = one(spark, [("",), ("a, b",), ("a",)], "s string", C.token_count("s"))
    assert got == [0, 2, 1]


@pytest.mark.parametrize("bad", [0, 2 ** 31])
def test_hash_mod_rejects_bad_modulus(bad):
    with pytest.raises(ValueError):
        C.hash_mod("k", bad)
