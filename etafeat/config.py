"""Pipeline settings.

Values marked FIXED VALUES must stay equal to the behaviour being matched
(city spellings, anchors, baselines, hour sets, thresholds). Everything else
is a tunable default.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the matched behaviour; keep in this order)
# ---------------------------------------------------------------------------

# City spellings and their canonical city.
CITY_ALIASES: dict[str, str] = {
    "bangalore": "bangalore",
    "bengaluru": "bangalore",
    "blr": "bangalore",
    "b'lore": "bangalore",
    "mumbai": "mumbai",
    "bombay": "mumbai",
    "delhi": "delhi",
    "new delhi": "delhi",
    "hyderabad": "hyderabad",
    "pune": "pune",
    "kolkata": "kolkata",
    "calcutta": "kolkata",
    "chennai": "chennai",
    "madras": "chennai",
    "ahmedabad": "ahmedabad",
    "surat": "surat",
}

# City anchor coordinates (lat, lon).
CITY_ANCHORS: dict[str, tuple[float, float]] = {
    "bangalore": (12.9716, 77.5946),
    "mumbai": (19.0760, 72.8777),
    "delhi": (28.6139, 77.2090),
    "hyderabad": (17.3850, 78.4867),
    "pune": (18.5204, 73.8567),
    "kolkata": (22.5726, 88.3639),
    "chennai": (13.0827, 80.2707),
    "ahmedabad": (23.0225, 72.5714),
    "surat": (21.1702, 72.8311),
}
# Anchor used for users whose city has no anchor.
DEFAULT_ANCHOR: tuple[float, float] = (20.0, 78.0)

# Mean temperature per city, and the default for other cities.
WEATHER_BASELINES: dict[str, float] = {
    "bangalore": 26, "mumbai": 29, "delhi": 24, "hyderabad": 28, "pune": 24,
    "kolkata": 28, "chennai": 30, "ahmedabad": 27, "surat": 28,
}
DEFAULT_TEMPERATURE = 26.0

# Base congestion per city (0..1), and the default for other cities.
TRAFFIC_BASELINES: dict[str, float] = {
    "bangalore": 0.7, "mumbai": 0.7, "delhi": 0.65, "hyderabad": 0.55, "pune": 0.5,
    "kolkata": 0.6, "chennai": 0.55, "ahmedabad": 0.4, "surat": 0.4,
}
DEFAULT_TRAFFIC = 0.5

# Three distinct hour sets, each used by one stage.
ORDER_PEAK_HOURS = (12, 13, 18, 19, 20, 21, 22)          # demand weight 2.5
FEATURE_RUSH_HOURS = (7, 8, 9, 12, 13, 18, 19, 20, 21, 22)  # is_rush_hour feature
TRAFFIC_PEAK_RANGES = ((7, 10), (18, 21))                 # traffic peak, inclusive
DINNER_HOURS = (19, 22)                                   # basket premium, inclusive
MIDDAY_HOURS = (12, 16)                                   # temperature +2, inclusive
MONSOON_MONTHS = (6, 7, 8, 9)                             # rain probability 0.15

# Price bands: right-closed, lowest edge included.
PRICE_BAND_EDGES = (0.0, 250.0, 500.0, 800.0)
PRICE_BAND_LABELS = ("budget", "mid", "premium", "luxury")

# Budget segment mix by local median price: (upper bound, [(segment, weight)]).
BUDGET_MIX = (
    (250.0, (("budget", 0.7), ("mid", 0.3))),
    (500.0, (("budget", 0.2), ("mid", 0.6), ("premium", 0.2))),
    (None, (("mid", 0.2), ("premium", 0.5), ("luxury", 0.3))),
)
BUDGET_DEFAULT = "mid"

# Columns that are not model features.
NON_FEATURE_COLUMNS = (
    "order_id", "order_created_at", "route_key", "order_status",
    "user_id", "restaurant_id", "actual_delivery_time_min",
)

# Raw restaurant columns (after name normalisation) and their renames.
RAW_RESTAURANT_COLUMNS = (
    "id", "area", "city", "restaurant", "price", "avg_ratings",
    "total_ratings", "food_type", "address", "delivery_time",
)
RESTAURANT_RENAMES = {
    "id": "restaurant_id",
    "restaurant": "name",
    "avg_ratings": "avg_rating",
    "total_ratings": "num_ratings",
    "food_type": "cuisines_raw",
    "delivery_time": "base_delivery_time_min",
}

# Road-type speeds in km/h: highway, arterial, residential.
ROAD_SPEEDS = (50.0, 30.0, 20.0)

# ---------------------------------------------------------------------------
# Tunable settings
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Bounds:
    lat_min: float = 8.0
    lat_max: float = 37.0
    lon_min: float = 68.0
    lon_max: float = 97.0


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    price_min: float = 50.0
    price_max: float = 3000.0
    fee_min: float = 15.0
    fee_max: float = 80.0
    geo_jitter: float = 0.06
    bounds: Bounds = field(default_factory=Bounds)
    max_fav_cuisines: int = 5
    days: int = 7
    end_time: str = "2024-03-31 23:00:00"
    max_route_km: float = 15.0
    routes_per_city: int = 200
    capacity_per_hour: int = 5
    weekend_multiplier: float = 1.4
    peak_weight: float = 2.5
    cancel_p: float = 0.97
    delayed_p: float = 0.92
    cancel_minutes: float = 30.0
    min_delivery_minutes: float = 15.0
    basket_min: float = 80.0
    basket_max: float = 2500.0
    high_value: float = 1500.0
    split_quantile: float = 0.7
    max_null_share: float = 0.3
    min_target: float = 5.0


DEFAULT = Settings()
