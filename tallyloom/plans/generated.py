"""The trip pipeline on trips generated from the orders: one trip per order key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.scalar import settled_mean
from tallyloom.operators import ranking
from tallyloom.plans import trips
from tallyloom.plans.star import table
from tallyloom.sources import files, synthetic


def made_trips(spark: SparkSession, sf: str, **options) -> DataFrame:
    ids = files.spread_small(table(spark, sf, "orders").select("o_orderkey"))
    return synthetic.trips(ids, id_column="o_orderkey", **options)


def made_zones(spark: SparkSession) -> DataFrame:
    return synthetic.zones(synthetic.zone_ids(spark))


def gen_trips(spark: SparkSession, sf: str) -> DataFrame:
    return made_trips(spark, sf)


def gen_zones(spark: SparkSession, sf: str) -> DataFrame:
    """One zone per supplier."""
    ids = table(spark, sf, "supplier").select("s_suppkey")
    return synthetic.zones(ids, id_column="s_suppkey")


def gen_trips_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """Trips per pickup zone with 30% of them forced into the hot zone."""
    return made_trips(spark, sf, skew=True, columns=["pickup_zone_id"]).groupBy("pickup_zone_id").agg(
        F.count(F.lit(1)).alias("n"))


def gen_hot_zones(spark: SparkSession, sf: str) -> DataFrame:
    """The three fullest zones at a hot share of 85%."""
    made = made_trips(spark, sf, skew=True, hot_share=0.85, columns=["pickup_zone_id"])
    counts = made.groupBy("pickup_zone_id").agg(
        F.count(F.lit(1)).alias("n"))
    return ranking.top_k(counts, "n", "pickup_zone_id", 3)


def gen_dirty_rate(spark: SparkSession, sf: str) -> DataFrame:
    made = made_trips(spark, sf, columns=["trip_distance_km", "fare_amount"])
    dirty = (F.col("trip_distance_km") == 0) & (F.col("fare_amount") == -1)
    either = (F.col("trip_distance_km") == 0) | (F.col("fare_amount") == -1)
    return made.agg(F.count(F.lit(1)).alias("n"), F.count_if(dirty).alias("dirty"),
                    F.count_if(either).alias("either"),
                    F.try_divide(F.count_if(dirty), F.count(F.lit(1))).alias("share"))


def settled(result: DataFrame) -> DataFrame:
    """Float noise removed, so that engines summing in another order agree."""
    return result.withColumns({
        "total_revenue": F.round("total_revenue", 2),
        "avg_fare": settled_mean(F.col("avg_fare"), F.col("trips"), 2),
        "avg_tip_pct": F.round("avg_tip_pct", 6),
        "avg_speed_kmh": F.round("avg_speed_kmh", 6)})


def trips_borough_hour(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly result by way of mergeable state."""
    state = trips.borough_hour_state(made_trips(spark, sf), made_zones(spark))
    return settled(trips.borough_hour_from_state(state))


def trips_top_zones(spark: SparkSession, sf: str) -> DataFrame:
    state = trips.zone_hour_state(made_trips(spark, sf))
    result = trips.top_zones_from_state(state, made_zones(spark))
    return result.withColumn("zone_revenue", F.round("zone_revenue", 2)).withColumn(
        "rank", F.col("rank").cast("bigint"))


def trips_direct(spark: SparkSession, sf: str) -> DataFrame:
    """The same borough result row by row: clean, derive, join, aggregate."""
    joined = trips.prepared(made_trips(spark, sf), made_zones(spark))
    return settled(trips.borough_hour(joined))
