"""Order-side operators: demand weights, affinity, basket, status, delivery time,
request enrichment (U13-U19)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etafeat import config
from etafeat.functions.columns import (clip, col_, floor_hour, hour_in, is_weekend,
                                       round_half_even)
from etafeat.operators.windows import cap_per_hour, exact_sum, rank_limit

S = config.DEFAULT


def demand_profile(hours: DataFrame, ts: str = "timestamp", peak_weight: float = S.peak_weight,
                   weekend_multiplier: float = S.weekend_multiplier) -> DataFrame:
    """Order weight per hour (2.5 at peak hours, x1.4 at weekends) and its probability.

    Weights are rounded to 6 decimals and totalled as an exact DECIMAL, so the
    probabilities do not depend on summation order.
    """
    t = F.col(ts)
    w = (F.when(hour_in(t, config.ORDER_PEAK_HOURS), F.lit(peak_weight)).otherwise(F.lit(1.0))
         * F.when(is_weekend(t), F.lit(weekend_multiplier)).otherwise(F.lit(1.0)))
    weighted = hours.withColumn("weight", round_half_even(w, 6))
    total = weighted.agg(exact_sum("weight", 6).alias("__total"))
    return (weighted.crossJoin(F.broadcast(total))
            .withColumn("probability", F.col("weight") / F.col("__total")).drop("__total"))


def price_basket(price: Column | str, items: Column | str, ts: Column | str,
                 variance: Column | float = 0.0, lo: float = S.basket_min, hi: float = S.basket_max) -> Column:
    """price x items x 1.15 (19-22h) x 1.10 (weekend) x (1 + variance), clipped, 2 decimals."""
    t = col_(ts)
    lo_h, hi_h = config.DINNER_HOURS
    v = col_(price) * col_(items)
    v = v * F.when(F.hour(t).between(lo_h, hi_h), F.lit(1.15)).otherwise(F.lit(1.0))
    v = v * F.when(is_weekend(t), F.lit(1.10)).otherwise(F.lit(1.0))
    var = variance if isinstance(variance, Column) else F.lit(float(variance))
    v = v * (F.lit(1.0) + var)
    return round_half_even(clip(v, lo, hi), 2)


def order_status(p: Column | str, minutes: Column | str, completed_below: float = S.delayed_p,
                 delayed_below: float = S.cancel_p, cancel_after: float = S.cancel_minutes) -> Column:
    """p < 0.92 completed; p < 0.97 delayed; otherwise cancelled if minutes > 30, else delayed."""
    p, m = col_(p), col_(minutes)
    return (F.when(p < completed_below, F.lit("completed"))
            .when(p < delayed_below, F.lit("delayed"))
            .when(m > cancel_after, F.lit("cancelled"))
            .otherwise(F.lit("delayed")))


def delivery_time(base: Column | str, noise: Column | str | float = 0.0,
                  floor_minutes: float = S.min_delivery_minutes) -> Column:
    """max(floor, round(base + noise, 1))."""
    n = noise if not isinstance(noise, (int, float)) else F.lit(float(noise))
    return F.greatest(F.lit(float(floor_minutes)), round_half_even(col_(base) + col_(n), 1))


def _fav_list(c: Column | str) -> Column:
    """Favourite cuisines as trimmed pieces of the comma list; empty or NULL text -> []."""
    x = col_(c)
    return F.when(F.coalesce(x, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.split(x, ","), lambda t: F.trim(t)))


def affinity_base(num_ratings: Column | str, rating: Column | str) -> Column:
    """max(num_ratings, 10)^0.6 * (coalesce(rating, 3.5) / 5)^1.2."""
    return (F.pow(F.greatest(col_(num_ratings).cast("double"), F.lit(10.0)), F.lit(0.6))
            * F.pow(F.coalesce(col_(rating), F.lit(3.5)) / F.lit(5.0), F.lit(1.2)))


GRAM = 3


def grams(text: Column | str, size: int) -> Column:
    """The distinct pieces of ``size`` characters of a text, at most as many as it has characters."""
    x = col_(text)
    last = F.char_length(x) - F.lit(size - 1)
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(x, i, F.lit(size)))))


def postings(texts: DataFrame, text: str) -> DataFrame:
    """(gram, text): every text under its grams of 1..``GRAM`` characters; rows grow with the texts' length."""
    every = None
    for size in range(1, GRAM + 1):
        part = texts.select(text, F.explode(grams(text, size)).alias("gram"))
        every = part if every is None else every.unionAll(part)
    return every


def cuisine_matches(restaurants: DataFrame, favs: DataFrame) -> DataFrame:
    """(restaurant_id, fav) where the fav text occurs in the restaurant's cuisines.

    A fav has no comma, so it can only occur inside one comma-separated piece.
    Each distinct piece is posted under its short grams, and a distinct fav looks
    only under the rarest of its own longest grams; what it finds there is verified.
    Nothing grows with the number of users, nor faster than the texts.
    """
    pieces = (restaurants.select("restaurant_id", F.explode(F.split(F.coalesce("cuisines", F.lit("")), ","))
                                 .alias("piece")).distinct())
    posted = postings(pieces.select("piece").distinct(), "piece")
    held = posted.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    wanted = favs.select("fav").distinct()
    size = F.least(F.char_length("fav"), F.lit(GRAM))
    own = wanted.select("fav", F.explode(F.coalesce(*[F.when(size == n, grams("fav", n)) for n in range(1, GRAM + 1)])).alias("gram"))
    rarest = own.join(held, "gram").groupBy("fav").agg(F.min(F.struct("n", "gram")).alias("g")).select("fav", "g.gram")
    hits = posted.join(rarest, "gram").filter(F.col("piece").contains(F.col("fav"))).select("piece", "fav")
    return pieces.join(hits, "piece").select("restaurant_id", "fav").distinct()


def choice_totals(sets: DataFrame, cand: DataFrame, matches: DataFrame, same_area_bonus: float,
                  cuisine_bonus: float) -> DataFrame:
    """(city, dest_area, favs, total): the sum of a user's scores over all their candidates.

    It depends on the user's city, area and favourites only: all candidates' weights plus
    the bonus share of those that match any favourite. Candidates that match the same
    cuisines are one class with one weight, and a set of favourites meets the classes by
    equality of a cuisine, so no user is paired with a restaurant.

    sets: city, dest_area, favs (distinct); cand: city, dest_area, restaurant_id, base, same
    matches: restaurant_id, fav
    """
    keys = ["city", "dest_area"]
    w = F.col("base") * F.when(F.col("same"), F.lit(same_area_bonus)).otherwise(F.lit(1.0))
    weighted = cand.withColumn("w", w)
    everyone = weighted.groupBy(*keys).agg(F.sum("w").alias("all"))
    kinds = matches.groupBy("restaurant_id").agg(F.array_sort(F.collect_set("fav")).alias("kinds"))
    classes = weighted.join(kinds, "restaurant_id").groupBy(*keys, "kinds").agg(F.sum("w").alias("w"))
    met = (sets.withColumn("fav", F.explode("favs"))
           .join(classes.withColumn("fav", F.explode("kinds")), [*keys, "fav"])
           .select(*keys, "favs", "kinds", "w").distinct()
           .groupBy(*keys, "favs").agg(F.sum("w").alias("matched")))
    # an empty favourite is part of every text
    matched = F.when(F.array_contains("favs", ""), F.col("all")).otherwise(F.coalesce("matched", F.lit(0.0)))
    return (sets.join(everyone, keys).join(met, [*keys, "favs"], "left")
            .select(*keys, "favs", (F.col("all") + F.lit(cuisine_bonus - 1.0) * matched).alias("total")))


def restaurant_affinity(users: DataFrame, restaurants: DataFrame, routes: DataFrame, k: int = 3,
                        same_area_bonus: float = 1.1, cuisine_bonus: float = 1.4) -> DataFrame:
    """Top-``k`` restaurants per user by affinity score.

    score = base * 1.4 if any favourite occurs in the restaurant's cuisines
                  * 1.1 if the restaurant is in the user's area,
    base = max(num_ratings, 10)^0.6 * (coalesce(rating, 3.5)/5)^1.2, over the
    restaurants of the user's city that have a route to the user's area.

    Exact without users x restaurants: a restaurant in a user's top k is in the
    top k by ``base`` of its own bonus class, and every class is covered by one
    of four bounded lists per (city, user area[, fav]): all candidates, same
    area, matching a fav, matching a fav in the same area. Each user gathers at
    most k * (2 + 2 * favs) candidates, scores them exactly and keeps k.
    ``probability`` is the score's share in all of the user's scores (``choice_totals``).

    users: user_id, city, home_area, fav_cuisines (comma list)
    restaurants: restaurant_id, city, area, num_ratings, avg_rating, cuisines
    routes: city, origin_area, dest_area
    """
    rest = restaurants.select("restaurant_id", "city", "area", "num_ratings", "avg_rating", "cuisines")
    cand = (rest.join(routes.select("city", F.col("origin_area").alias("area"), "dest_area").distinct(),
                      ["city", "area"])
                .withColumn("base", affinity_base("num_ratings", "avg_rating"))
                .select("city", "dest_area", "restaurant_id", "base", (F.col("area") == F.col("dest_area"))
                        .alias("same")))
    u = users.select("user_id", "city", F.col("home_area").alias("dest_area"),
                     _fav_list("fav_cuisines").alias("favs"))
    uf = u.select("user_id", "city", "dest_area", F.explode("favs").alias("fav")).filter(F.col("fav") != "")
    matches = cuisine_matches(restaurants, uf)
    cand_f = cand.join(matches, "restaurant_id")

    # Each list is ranked by its class's exact final score, so ties match the final ranking.
    one = F.lit(1.0)
    cls = lambda m, a: (F.col("base") * (F.lit(cuisine_bonus) if m else one)
                        * (F.lit(same_area_bonus) if a else one)).alias("cls")
    lists = {
        "all": rank_limit(cand.withColumn("cls", cls(False, False)), ["city", "dest_area"],
                          [F.col("cls").desc(), "restaurant_id"], k),
        "same": rank_limit(cand.filter("same").withColumn("cls", cls(False, True)), ["city", "dest_area"],
                           [F.col("cls").desc(), "restaurant_id"], k),
        "fav": rank_limit(cand_f.withColumn("cls", cls(True, False)), ["city", "dest_area", "fav"],
                          [F.col("cls").desc(), "restaurant_id"], k),
        "fav_same": rank_limit(cand_f.filter("same").withColumn("cls", cls(True, True)),
                               ["city", "dest_area", "fav"], [F.col("cls").desc(), "restaurant_id"], k),
    }
    keys = ["city", "dest_area"]
    picked = None
    for name, lst in lists.items():
        on = keys + (["fav"] if name.startswith("fav") else [])
        left = uf if name.startswith("fav") else u
        part = left.join(lst.select(*on, "restaurant_id"), on).select("user_id", "restaurant_id")
        picked = part if picked is None else picked.unionByName(part)
    pairs = picked.distinct()

    scored = (pairs.join(u, "user_id")
                   .join(rest.withColumnRenamed("city", "__rcity"), "restaurant_id")
                   .withColumn("base", affinity_base("num_ratings", "avg_rating")))
    match = F.exists("favs", lambda f: F.coalesce(F.col("cuisines"), F.lit("")).contains(f))
    score = (F.col("base") * F.when(match, F.lit(cuisine_bonus)).otherwise(F.lit(1.0))
             * F.when(F.col("area") == F.col("dest_area"), F.lit(same_area_bonus)).otherwise(F.lit(1.0)))
    top = rank_limit(scored.withColumn("score", score), "user_id", [F.col("score").desc(), F.col("restaurant_id")],
                     k, "rank")
    sets = u.select("city", "dest_area", "favs").distinct()
    totals = choice_totals(sets, cand, matches, same_area_bonus, cuisine_bonus)
    return top.join(totals, ["city", "dest_area", "favs"]).select(
        "user_id", "restaurant_id", F.concat_ws("_", "city", "area", F.lit("to"), "dest_area").alias("route_key"),
        F.col("rank").cast("int").alias("rank"), "score", (F.col("score") / F.col("total")).alias("probability"))


def enrich_requests(requests: DataFrame, conditions: DataFrame, route: str = "route_key",
                    ts: str = "ts") -> DataFrame:
    """Attach the (route, hour) conditions to each request; requests without a row drop out."""
    hour = floor_hour(ts)
    cond = conditions.withColumnRenamed("timestamp", "__hour")
    return (requests.withColumn("__hour", hour)
            .join(cond, [route, "__hour"], "inner")
            .drop("__hour"))


def accept_orders(requests: DataFrame, conditions: DataFrame, entity: str, ts: str, order: list,
                  capacity: int = S.capacity_per_hour, route: str = "route_key") -> DataFrame:
    """Enrich, then keep the first ``capacity`` per (entity, hour).

    Enrichment runs first, so a request without a route row never uses capacity.
    """
    return cap_per_hour(enrich_requests(requests, conditions, route, ts), entity, ts, order, capacity)
