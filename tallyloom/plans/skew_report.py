"""What does a hot key cost, and which join pays it back? Measured on the trips."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom import schemas as S
from tallyloom.operators import ranking, skew
from tallyloom.sources import files, synthetic

KEY, DIM_KEY, AMOUNT = "pickup_zone_id", "zone_id", "campaign_budget"


KINDS = ("plain", "salted", "selective", "preaggregated")


def join(kind: str, trips: DataFrame, campaigns: DataFrame, salts: int = skew.SALTS) -> DataFrame:
    """Budget and row count per zone, by one of the joins."""
    keys, rows = trips.select(KEY), trips.select(KEY, "trip_id")
    if kind == "preaggregated":
        return skew.preaggregated_totals(keys, campaigns, KEY, DIM_KEY, AMOUNT, "budget", "n")
    if kind == "plain":
        joined = skew.plain_join(rows, campaigns, KEY, DIM_KEY, ["trip_id"])
    elif kind == "salted":
        joined = skew.salted_join(rows, campaigns, KEY, DIM_KEY, ["trip_id"], salts)
    else:
        joined = skew.selective_salted_join(rows, campaigns, KEY, DIM_KEY, ["trip_id"])
    return skew.totals(joined, KEY, AMOUNT, "budget", "n")


def joins(trips: DataFrame, campaigns: DataFrame, salts: int = skew.SALTS) -> dict[str, DataFrame]:
    return {kind: join(kind, trips, campaigns, salts) for kind in KINDS}


def seconds(build: Callable[[], DataFrame]) -> float:
    """One discarded warm-up, then one timed run that computes every column.

    Building counts too: the selective join finds its hot keys there.
    """
    for _ in range(2):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def run(spark: SparkSession, trips_path: str, out: str, *, per_zone: int = 200,
        salts: int = skew.SALTS, cores: int | None = None) -> dict:
    """Profile the pickup zones, time the joins, and store the report as JSON.

    ``predicted_ceiling`` is the most that balancing the hottest key can gain on ``cores``.
    """
    cores = cores or spark.sparkContext.defaultParallelism
    trips = files.read_parquet(spark, trips_path, schema=S.TRIPS)
    campaigns = synthetic.campaigns(synthetic.campaign_ids(spark, per_zone))
    hottest = ranking.top_k(skew.key_profile(trips, KEY, cores), "rows", KEY, 1).first()
    report = {"cores": cores, "salts": salts, "per_zone": per_zone,
              "hot_key": hottest[KEY], "hot_rows": hottest["rows"],
              "hot_share": round(hottest["share"], 4),
              "predicted_ceiling": round(hottest["gain_bound"], 3)}
    for kind in KINDS:
        report[f"{kind}_s"] = seconds(lambda kind=kind: join(kind, trips, campaigns, salts))
    report["speedup"] = round(report["plain_s"] / report["salted_s"], 3)
    files.write_json(spark.createDataFrame([report]), out)
    return report
