import math

import pytest
from pyspark.sql import functions as F

from tallyloom import schemas as S
from tallyloom.functions.uniforms import Uniforms
from tallyloom.operators import diff
from tallyloom.sources import files, synthetic
from tests.support.plans import plan

N = 100_000


@pytest.fixture(scope="module")
def trips(spark):
    path = files.fresh_path(spark, "test-trips")
    files.write_parquet(synthetic.trips(spark.range(0, N, 1, 8)), path)
    return files.read_parquet(spark, path, schema=S.TRIPS)


def test_schema_and_exact_totals(spark, trips):
    made = synthetic.trips(spark.range(10))
    assert made.columns == S.TRIPS.names
    assert [f.dataType for f in made.schema] == [f.dataType for f in S.TRIPS]
    assert trips.count() == N and trips.select("trip_id").distinct().count() == N
    assert synthetic.trip_ids(spark, "xxl").agg(F.max("id")).first()[0] == 299_999_999
    assert files.scan_partitions(synthetic.trip_ids(spark, "xs")) == 8


def test_ranges(trips):
    row = trips.agg(
        *[F.struct(F.min(c).alias("a"), F.max(c).alias("b")).alias(c) for c in (
            "vendor_id", "pickup_zone_id", "dropoff_zone_id", "passenger_count")],
        F.min("pickup_ts").alias("first"), F.max("pickup_ts").alias("last"),
        F.min(F.col("dropoff_ts") - F.col("pickup_ts")).alias("short"),
        F.max(F.col("dropoff_ts") - F.col("pickup_ts")).alias("long"),
        F.countDistinct("pickup_zone_id").alias("zones")).first()
    assert tuple(row.vendor_id) == (1, 3) and tuple(row.passenger_count) == (1, 6)
    assert tuple(row.pickup_zone_id) == (1, 265) == tuple(row.dropoff_zone_id)
    assert row.zones == 265
    start = synthetic.FIRST_SECOND
    assert start <= row.first and row.last < start + 30 * 86_400 + 60
    assert 5 <= row.short and row.long <= 28_800


def test_distributions(trips):
    clean = trips.filter("fare_amount > 0")
    log = clean.filter("trip_distance_km > 0").agg(
        F.avg(F.log("trip_distance_km")), F.stddev(F.log("trip_distance_km"))).first()
    assert math.isclose(log[0], 0.7, abs_tol=0.02) and math.isclose(log[1], 0.85, abs_tol=0.02)
    pay = {r.payment_type: r["count"] / N for r in
           trips.groupBy("payment_type").count().collect()}
    assert all(math.isclose(pay[k], v, abs_tol=0.01) for k, v in S.PAYMENT_WEIGHTS.items())
    humps = {r.h: r["count"] for r in trips.groupBy(
        F.floor(F.col("pickup_ts") % 86_400 / 3600).alias("h")).count().collect()}
    assert humps[8] > 1.5 * humps[13] and humps[18] > 1.5 * humps[13]
    rate = clean.filter("tip_amount = 0").count() / clean.count()
    assert math.isclose(rate, 0.25, abs_tol=0.01)
    cents = F.abs(F.col("fare_amount") * 100 - F.round(F.col("fare_amount") * 100))
    assert clean.agg(F.max(cents)).first()[0] < 1e-6


def test_dirty_rows_are_dirty_in_both_columns(trips):
    either = trips.filter("trip_distance_km = 0 or fare_amount = -1")
    both = trips.filter("trip_distance_km = 0 and fare_amount = -1")
    assert math.isclose(both.count() / N, 0.04, abs_tol=0.004)
    assert either.count() - both.count() <= N // 5000  # tiny distances that round to zero


@pytest.mark.parametrize("share", [0.30, 0.85])
def test_hot_share(spark, share):
    made = synthetic.trips(spark.range(0, N, 1, 8), skew=True, hot_share=share)
    hot = made.filter(F.col("pickup_zone_id") == S.HOT_ZONE).count() / N
    assert math.isclose(hot, share + (1 - share) / 265, abs_tol=0.01)
    assert made.select("pickup_zone_id").distinct().count() == 265


def test_rows_do_not_depend_on_partitioning(spark):
    one = synthetic.trips(spark.range(0, 3000, 1, 1))
    many = synthetic.trips(spark.range(0, 3000, 1, 13))
    assert diff.diff_rows(one, many).count() == 0
    assert diff.diff_rows(one, synthetic.trips(spark.range(3000), seed=1)).count() > 2900


def test_streams_are_uniform_and_uncorrelated(spark):
    u = Uniforms("id", seed=5)
    # ids beyond 32 bits, and regular gaps
    ids = spark.range(5 << 33, (5 << 33) + 8 * 20_000, 8)
    drawn = u.prepared(ids).select(*[u.stream(k).alias(f"u{k}") for k in range(6)])
    stats = drawn.agg(*[F.avg(c) for c in drawn.columns],
                      *[F.corr("u0", c) for c in drawn.columns[1:]],
                      F.min("u0"), F.max("u0")).first()
    assert all(abs(v - 0.5) < 0.01 for v in stats[:6])
    assert all(abs(v) < 0.03 for v in stats[6:11])
    assert 0 < stats[11] < 0.001 and 0.999 < stats[12] < 1


def test_zones_and_campaigns(spark):
    zones = synthetic.zones(synthetic.zone_ids(spark))
    assert zones.dtypes == [(f.name, f.dataType.simpleString()) for f in S.ZONES]
    assert zones.count() == 265
    assert zones.orderBy("zone_id").first().zone_name == "Zone 001"
    assert {r.borough for r in zones.collect()} == set(S.BOROUGH_WEIGHTS)
    camps = synthetic.campaigns(synthetic.campaign_ids(spark, 3))
    assert camps.dtypes == [(f.name, f.dataType.simpleString()) for f in S.CAMPAIGNS]
    per_zone = camps.groupBy("zone_id").count()
    assert per_zone.count() == 265 and per_zone.filter("count <> 3").count() == 0


def test_write_data_set_refuses_to_overwrite(spark):
    out = files.fresh_path(spark, "test-data")
    synthetic.write_data_set(spark, "xs", f"{out}/trips", f"{out}/zones")
    assert files.row_count(spark, f"{out}/trips") == 200_000
    with pytest.raises(Exception, match="(?i)already exists"):
        synthetic.write_data_set(spark, "xs", f"{out}/trips", f"{out}/zones")


def test_unknown_scale():
    with pytest.raises(ValueError, match="huge"):
        S.scale("huge")


def streams_in(df):
    import re

    return sorted({int(k or 1) - 1 for k in re.findall(r"_b#\d+L(?: \* (\d+))?\)", plan(df))})


def test_only_the_streams_of_asked_columns_are_computed(spark):
    ids = spark.range(10)
    assert streams_in(synthetic.trips(ids)) == [0, *range(2, 16)]
    assert streams_in(synthetic.trips(ids, skew=True)) == list(range(16))
    for columns, skew, wanted in ((["pickup_zone_id"], True, [0, 1]), (["pickup_zone_id"], False, [0]),
                                  (["trip_id"], True, []), (["payment_type"], True, [14]),
                                  (["trip_distance_km", "fare_amount"], False, [4, 5, 7, 8, 9, 15]),
                                  (["dropoff_ts"], False, [2, 3, 4, 5, 6, 7, 8, 9])):
        made = synthetic.trips(ids, skew=skew, columns=columns)
        assert made.columns == columns and streams_in(made) == wanted


def test_registered_counts_draw_no_more_than_they_need(spark, sf):
    from tallyloom.plans import generated

    assert streams_in(generated.gen_trips_skewed(spark, sf)) == [0, 1]
    assert streams_in(generated.gen_hot_zones(spark, sf)) == [0, 1]
    assert streams_in(generated.gen_dirty_rate(spark, sf)) == [4, 5, 7, 8, 9, 15]


def test_a_column_is_the_same_whatever_else_is_asked_for(spark):
    whole = synthetic.trips(spark.range(500), skew=True)
    for name in S.TRIPS.names:
        alone = synthetic.trips(spark.range(500), skew=True, columns=["trip_id", name] if
                                name != "trip_id" else [name])
        assert diff.diff_rows(whole.select(*alone.columns), alone).count() == 0
    with pytest.raises(ValueError, match="km"):
        synthetic.trips(spark.range(1), columns=["km"])
