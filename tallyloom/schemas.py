"""Declared schemas and the fixed business values of the trip data set."""

from __future__ import annotations

from pyspark.sql import types as T

TRIPS = T.StructType([
    T.StructField("trip_id", T.LongType()),
    T.StructField("vendor_id", T.ShortType()),
    T.StructField("pickup_zone_id", T.IntegerType()),
    T.StructField("dropoff_zone_id", T.IntegerType()),
    T.StructField("pickup_ts", T.LongType()),  # epoch seconds, UTC
    T.StructField("dropoff_ts", T.LongType()),
    T.StructField("passenger_count", T.ShortType()),
    T.StructField("trip_distance_km", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("payment_type", T.StringType()),
])

ZONES = T.StructType([
    T.StructField("zone_id", T.IntegerType()),
    T.StructField("borough", T.StringType()),
    T.StructField("zone_name", T.StringType()),
])

CAMPAIGNS = T.StructType([
    T.StructField("zone_id", T.IntegerType()),
    T.StructField("campaign_budget", T.DoubleType()),
])

BOROUGH_HOUR = T.StructType([
    T.StructField("borough", T.StringType()),
    T.StructField("pickup_hour", T.LongType()),
    T.StructField("trips", T.LongType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("avg_fare", T.DoubleType()),
    T.StructField("avg_tip_pct", T.DoubleType()),
    T.StructField("avg_speed_kmh", T.DoubleType()),
    T.StructField("max_distance_km", T.DoubleType()),
    T.StructField("n_vendors", T.LongType()),
])

TOP_ZONES = T.StructType([
    T.StructField("borough", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("zone_id", T.IntegerType()),
    T.StructField("zone_revenue", T.DoubleType()),
    T.StructField("zone_trips", T.LongType()),
])

# Cleaning bounds (inclusive) and the length of the ranking.
MIN_DISTANCE_KM = 0.1
MAX_DISTANCE_KM = 200.0
MIN_FARE = 2.5
MIN_DURATION_S = 60
MAX_DURATION_S = 21_600
TOP_N = 5

# Zone domain, boroughs and their weights.
N_ZONES = 265
BOROUGH_WEIGHTS = {
    "Manhattan": 0.35,
    "Brooklyn": 0.25,
    "Queens": 0.20,
    "Bronx": 0.13,
    "Staten Island": 0.05,
    "EWR": 0.02,
}

# The zone that takes the injected skew, and its default share.
HOT_ZONE = 132
HOT_SHARE = 0.30

# Size presets as (rows, files).
SCALES = {
    "xs": (200_000, 8),
    "s": (2_000_000, 16),
    "m": (10_000_000, 32),
    "l": (30_000_000, 64),
    "xl": (80_000_000, 128),
    "xxl": (300_000_000, 512),
}

# Tip rates and payment types with their weights.
TIP_WEIGHTS = {0.0: 0.25, 0.10: 0.15, 0.15: 0.25, 0.20: 0.25, 0.25: 0.10}
PAYMENT_WEIGHTS = {"card": 0.7, "cash": 0.2, "wallet": 0.1}


def scale(name: str) -> tuple[int, int]:
    """(rows, files) of a size preset."""
    if name not in SCALES:
        raise ValueError(f"unknown scale {name!r}; choose one of {', '.join(SCALES)}")
    return SCALES[name]
