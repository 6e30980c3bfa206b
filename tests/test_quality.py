import math

from pyspark.sql import functions as F

from tallyloom import schemas as S
from tallyloom.operators import quality
from tallyloom.plans import trips

GOOD = dict(trip_id=1, vendor_id=1, pickup_zone_id=1, dropoff_zone_id=2, pickup_ts=1000,
            dropoff_ts=2000, passenger_count=1, trip_distance_km=5.0, fare_amount=10.0,
            tip_amount=1.0, payment_type="card")


def make(spark, *changes):
    return spark.createDataFrame(
        [tuple({**GOOD, "trip_id": i, **c}.values()) for i, c in enumerate(changes)], S.TRIPS)


def test_bounds_are_inclusive(spark):
    inside = [dict(trip_distance_km=0.1), dict(trip_distance_km=200.0), dict(fare_amount=2.5),
              dict(dropoff_ts=1060), dict(dropoff_ts=22_600)]
    outside = [dict(trip_distance_km=0.09), dict(trip_distance_km=200.01),
               dict(fare_amount=2.49), dict(dropoff_ts=1059), dict(dropoff_ts=22_601)]
    df = make(spark, *inside, *outside)
    assert [r.trip_id for r in trips.clean(df).orderBy("trip_id").collect()] == [0, 1, 2, 3, 4]


def test_null_and_nan_are_rejected_and_counted(spark):
    bad = [dict(trip_distance_km=None), dict(trip_distance_km=math.nan), dict(fare_amount=None),
           dict(fare_amount=math.nan), dict(pickup_ts=None), dict(dropoff_ts=None)]
    df = make(spark, {}, *bad)
    assert trips.clean(df).count() == 1
    row = quality.account(df, trips.rules(df)).first()
    assert tuple(row) == (7, 1, 6)
    per_rule = {r.rule: r.rejected for r in quality.rejects(df, trips.rules(df)).collect()}
    assert per_rule == {"distance": 2, "fare": 2, "duration": 2}


def test_a_row_may_fail_several_rules(spark):
    df = make(spark, dict(trip_distance_km=0.0, fare_amount=-1.0))
    assert [r.rejected for r in quality.rejects(df, trips.rules(df)).collect()] == [1, 1, 0]
    assert tuple(quality.account(df, trips.rules(df)).first()) == (1, 0, 1)


def test_upper_bound_alone_rejects_nan(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,), (9.0,)], "x double")
    rule = quality.Rule("x", F.col("x"), high=5.0)
    assert quality.clean(df, [rule]).count() == 1


def test_derive_without_clean_does_not_divide_by_zero(spark):
    df = make(spark, dict(dropoff_ts=1000, fare_amount=0.0))
    row = trips.derive(df).first()
    assert row.speed_kmh is None and row.tip_pct is None
    assert row.duration_min == 0.0 and row.total_amount == 1.0


def test_derived_values(spark):
    row = trips.derive(make(spark, dict(pickup_ts=86_400 + 3 * 3600 + 59,
                                        dropoff_ts=86_400 + 4 * 3600 + 59))).first()
    assert (row.duration_min, row.speed_kmh, row.total_amount, row.tip_pct, row.pickup_hour) == (
        60.0, 5.0, 11.0, 10.0, 3)


def test_times_may_be_timestamps(spark, conf):
    conf("spark.sql.session.timeZone", "America/New_York")
    df = make(spark, {}).withColumn("pickup_ts", F.expr("timestamp_ntz'2024-07-01 23:30:00'")
                                    ).withColumn("dropoff_ts",
                                                 F.expr("timestamp_ntz'2024-07-02 00:30:00'"))
    row = trips.derive(df).first()
    assert (row.pickup_hour, row.duration_min) == (23, 60.0)
    df = make(spark, {}).withColumn("pickup_ts", F.timestamp_seconds(F.lit(7200))
                                    ).withColumn("dropoff_ts", F.timestamp_seconds(F.lit(10800)))
    row = trips.derive(df).first()
    assert (row.pickup_hour, row.duration_min) == (2, 60.0)
