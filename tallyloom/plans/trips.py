"""The trip pipeline: clean, derive, enrich, aggregate by hour, rank the zones."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import schemas as S
from tallyloom.functions.scalar import epoch_seconds, hour_of_day
from tallyloom.operators import diff, groups, quality, ranking, rollup
from tallyloom.operators.enrich import attach
from tallyloom.sources import files

# The names of the results and what they are computed from.
MEASURES = groups.Measures(
    counts={"trips": "trip_id"},
    sums={"total_revenue": "total_amount"},
    means={"avg_fare": "fare_amount", "avg_tip_pct": "tip_pct", "avg_speed_kmh": "speed_kmh"},
    maxes={"max_distance_km": "trip_distance_km"},
    distincts={"n_vendors": "vendor_id"},
)


def seconds(df: DataFrame) -> F.Column:
    """Length of the trip; the two times may be epoch seconds or timestamps."""
    return epoch_seconds(df, "dropoff_ts") - epoch_seconds(df, "pickup_ts")


def rules(trips: DataFrame) -> list[quality.Rule]:
    return [
        quality.Rule("distance", F.col("trip_distance_km"), S.MIN_DISTANCE_KM,
                     S.MAX_DISTANCE_KM),
        quality.Rule("fare", F.col("fare_amount"), S.MIN_FARE),
        quality.Rule("duration", seconds(trips), S.MIN_DURATION_S, S.MAX_DURATION_S,
                     floating=False),
    ]


def clean(trips: DataFrame) -> DataFrame:
    return quality.clean(trips, rules(trips))


def derive(trips: DataFrame) -> DataFrame:
    """Duration, speed, total, tip share and hour; null where a divisor is zero."""
    length = seconds(trips)
    return trips.withColumns({
        "duration_min": length / 60.0,
        "speed_kmh": F.try_divide(F.col("trip_distance_km"), length / 3600.0),
        "total_amount": F.col("fare_amount") + F.col("tip_amount"),
        "tip_pct": F.try_divide(F.col("tip_amount"), F.col("fare_amount")) * 100.0,
        "pickup_hour": hour_of_day(epoch_seconds(trips, "pickup_ts")),
    })


def enrich(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return attach(trips, zones.select("zone_id", "borough"), "pickup_zone_id", "zone_id")


def prepared(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Stages up to the join, row by row: clean, derive, enrich."""
    return enrich(trips.transform(clean).transform(derive), zones)


def borough_hour(joined: DataFrame) -> DataFrame:
    return (groups.aggregate(joined, ["borough", "pickup_hour"], MEASURES)
            .select(*S.BOROUGH_HOUR.names).orderBy("borough", "pickup_hour"))


def top_zones(joined: DataFrame, n: int = S.TOP_N) -> DataFrame:
    totals = joined.groupBy("borough", F.col("pickup_zone_id").alias("zone_id")).agg(
        F.sum("total_amount").alias("zone_revenue"), F.count("trip_id").alias("zone_trips"))
    return _ranked(totals, n)


def _ranked(totals: DataFrame, n: int) -> DataFrame:
    return (ranking.top_per_group(totals, ["borough"], "zone_revenue", "zone_id", n)
            .select(*S.TOP_ZONES.names).orderBy("borough", "rank"))


# One scan for both results: state at (zone, hour) grain, from which each is derived.

STATE_KEYS = ["pickup_zone_id", "pickup_hour"]


def zone_hour_state(trips: DataFrame, part: str | None = None) -> DataFrame:
    """Mergeable state per (zone, hour), or per (part, zone, hour).

    At most zones x 24 x vendors rows per part, however many trips: the raw rows are neither joined nor
    shuffled, only partial aggregates are.
    """
    rows = trips.transform(clean).transform(derive)
    keys = STATE_KEYS if part is None else [part, *STATE_KEYS]
    return groups.partial(rows, keys, MEASURES)


def borough_hour_state(trips: DataFrame, zones: DataFrame, part: str | None = None) -> DataFrame:
    """Mergeable state per (borough, hour), or per (part, borough, hour).

    For the hourly result alone: it is coarser than :func:`zone_hour_state`, and finishing it
    reuses its partitioning.
    """
    rows = trips.transform(clean).transform(derive)
    fact_by = ["pickup_hour"] if part is None else [part, "pickup_hour"]
    return groups.partial_by_dimension(rows, zones.select("zone_id", "borough"), "pickup_zone_id",
                                       "zone_id", fact_by, ["borough"], MEASURES)


def _hours(state: DataFrame) -> DataFrame:
    return (rollup.answer(state, ["borough", "pickup_hour"], MEASURES)
            .select(*S.BOROUGH_HOUR.names).orderBy("borough", "pickup_hour"))


def borough_hour_from_state(state: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """The hourly result from zone state and its zones, or from borough state alone."""
    return _hours(state if zones is None else enrich(state, zones))


def top_zones_from_state(state: DataFrame, zones: DataFrame, n: int = S.TOP_N) -> DataFrame:
    totals = enrich(state, zones).groupBy(
        "borough", F.col("pickup_zone_id").alias("zone_id")).agg(
        F.sum("total_revenue").alias("zone_revenue"), F.sum("trips").alias("zone_trips"))
    return _ranked(totals, n)


def with_day(trips: DataFrame, name: str = "day") -> DataFrame:
    """Add the pickup date (UTC), the usual part column of a stored rollup."""
    days = F.floor(epoch_seconds(trips, "pickup_ts") / 86_400).cast("int")
    return trips.withColumn(name, F.date_from_unix_date(days))


def run(spark: SparkSession, trips_path: str, zones_path: str, out: str) -> dict:
    """The whole job, one scan of the trips. Returns the run record and stores it as JSON.

    Writes ``out``/state (Parquet), ``out``/agg and ``out``/top_zones (CSV) and
    ``out``/record (JSON).
    """
    clock = [time.perf_counter()]

    def lap() -> float:
        clock.append(time.perf_counter())
        return round(clock[-1] - clock[-2], 3)

    trips = files.read_parquet(spark, trips_path, schema=S.TRIPS)
    zones = files.read_parquet(spark, zones_path, schema=S.ZONES)
    fresh = zone_hour_state(trips)
    with files.planned_splits(trips) as plan:
        record = {**plan, "scan_partitions": files.scan_partitions(trips)}
        files.write_parquet(fresh, f"{out}/state")
    state = files.read_parquet(spark, f"{out}/state", schema=fresh.schema)
    record["state_s"] = lap()
    files.write_csv(borough_hour_from_state(state, zones), f"{out}/agg")
    record["agg_s"] = lap()
    files.write_csv(top_zones_from_state(state, zones), f"{out}/top_zones")
    record["top_zones_s"] = lap()
    record["compute_s"] = round(clock[-1] - clock[0], 3)
    record["rows_in"] = files.row_count(spark, trips_path)
    # rows of the join: kept trips whose zone is known
    record["rows_kept"] = enrich(state, zones).agg(
        F.coalesce(F.sum("trips"), F.lit(0)).cast("bigint")).first()[0]
    record["shuffle_partitions"] = int(spark.conf.get("spark.sql.shuffle.partitions"))
    record["default_parallelism"] = spark.sparkContext.defaultParallelism
    files.write_json(spark.createDataFrame([record]), f"{out}/record")
    return record


def compare_runs(spark: SparkSession, outs: dict[str, str]) -> DataFrame:
    """Compare the stored results of several runs with those of the first.

    ``outs`` maps a name to the ``out`` folder of :func:`run`. Pass the report to
    ``diff.require_same`` to stop on any difference.
    """
    results = {"agg": (S.BOROUGH_HOUR, ["borough", "pickup_hour"]),
               "top_zones": (S.TOP_ZONES, ["borough", "rank"])}
    reports = []
    for result, (schema, keys) in results.items():
        tables = {name: files.read_csv(spark, f"{out}/{result}", schema)
                  for name, out in outs.items()}
        reports.append(diff.diff_gate(tables, keys).select(F.lit(result).alias("result"), "*"))
    return reports[0].unionByName(reports[1])
