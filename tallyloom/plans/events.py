"""The pipeline on the event stream table, and events as a table of repeated runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.scalar import epoch_seconds, hour_of_day, settled_mean
from tallyloom.operators import groups, measure, quality
from tallyloom.plans.star import is_small, regions, table

MEASURES = groups.Measures(
    counts={"n": "event_id"},
    sums={"amount": "value"},
    means={"avg_value": "value"},
    maxes={"max_value": "value"},
    distincts={"n_types": "event_type"},
)


def events_region_hour(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    kept = quality.clean(events, [quality.Rule("value", F.col("value"), 0.1, 200.0)])
    hourly = kept.withColumn("hour", hour_of_day(epoch_seconds(kept, "ts")))
    users = regions(spark, sf, "customer", "c_custkey", "c_nationkey")
    small = is_small(spark, sf, "customer", "c_custkey", "c_nationkey")
    result = groups.aggregate_by_dimension(hourly, users, "user_id", "c_custkey", ["hour"],
                                           ["r_name"], MEASURES, broadcast=small)
    return result.select(
        "r_name", "hour", "n", F.round("amount", 2).alias("amount"),
        settled_mean(F.col("avg_value"), F.col("n"), 2).alias("avg_value"), "max_value", "n_types",
    ).orderBy("r_name", "hour")


# Measurements: series = event type, level = day, repetition = (ts, event_id), value = value.

SERIES, LEVEL = "event_type", "level"


def all_runs(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    first_day = F.to_date(F.lit("2024-01-01"))
    return events.withColumn(
        LEVEL, (F.datediff("ts", first_day) + 1).cast("bigint")).withColumn(
        "outcome", F.when(F.col(SERIES) == "error", F.lit("failed")).otherwise(F.lit("ok")))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return measure.successful(all_runs(spark, sf), "outcome")


def summary(spark: SparkSession, sf: str) -> DataFrame:
    """Values have two decimals, so rounding the median only removes float noise."""
    found = measure.summarise(runs(spark, sf), [SERIES, LEVEL], ["ts", "event_id"], "value")
    median = F.round("median", 6)
    return found.withColumns({"median": median, "per_unit": F.try_divide("runs", median)})


def measure_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summary(spark, sf)


def measure_speedup(spark: SparkSession, sf: str) -> DataFrame:
    return measure.speedup(summary(spark, sf), [SERIES], LEVEL)


def measure_throughput(spark: SparkSession, sf: str) -> DataFrame:
    return measure.throughput(summary(spark, sf), [SERIES], LEVEL)


def measure_best(spark: SparkSession, sf: str) -> DataFrame:
    return measure.best(runs(spark, sf), [SERIES, LEVEL], "value")


# Jobs: a user's events of one type in ten days are a run; its rows are the events, its compute
# time their values, its wall time also the time they span; its cores follow from the user.

CORES, VALUES = "cores", ("rows", "compute_s", "wall_s", "rows_per_s")


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("ts", "user_id", "event_type", "value")
    at = events.withColumn("at", epoch_seconds(events, "ts"))
    days = F.floor((F.col("at") - F.lit(1_704_067_200)) / 864_000).alias("days")
    runs = at.groupBy(SERIES, "user_id", days).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("value"), 2).alias("compute_s"),
        (F.max("at") - F.min("at")).alias("_span"))
    return runs.withColumns({
        CORES: F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("user_id") % 4).cast("int")),
        "wall_s": F.col("compute_s") + F.col("_span"),
        "rows_per_s": F.try_divide("rows", "compute_s")}).drop("_span")


def job_summary(spark: SparkSession, sf: str) -> DataFrame:
    found = measure.summarise_values(jobs(spark, sf), [SERIES, CORES], ["days", "user_id"], VALUES)
    return found.withColumns({f"{v}_median": F.round(f"{v}_median", 6) for v in VALUES})


def measure_values(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, compute time, wall time and rows per second side by side, also per core."""
    return job_summary(spark, sf).withColumn(
        "rows_per_s_core", F.try_divide("rows_per_s_median", F.col(CORES)))


def measure_cost_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return measure.cost_ratio(job_summary(spark, sf), SERIES, CORES, "click", "rows_median",
                              "compute_s_median", CORES)


def measure_largest(spark: SparkSession, sf: str) -> DataFrame:
    return measure.largest_level(runs(spark, sf), SERIES, LEVEL).orderBy("rows", SERIES)
