"""The whole pipeline against DuckDB on the written files."""

import json

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom import schemas as S
from tallyloom.operators import diff, rollup
from tallyloom.plans import skew_report
from tallyloom.plans import trips as plan
from tallyloom.sources import files, synthetic
from tests.support.plans import plan as plan_text


@pytest.fixture(scope="module")
def data(spark):
    out = files.fresh_path(spark, "test-pipeline")
    files.write_parquet(synthetic.trips(spark.range(0, 60_000, 1, 6), skew=True),
                        f"{out}/trips")
    files.write_parquet(synthetic.zones(synthetic.zone_ids(spark)).filter("zone_id <> 17"),
                        f"{out}/zones")
    return out


@pytest.fixture(scope="module")
def tables(spark, data):
    return (files.read_parquet(spark, f"{data}/trips", schema=S.TRIPS),
            files.read_parquet(spark, f"{data}/zones", schema=S.ZONES))


JOINED = """
    SELECT *, fare_amount + tip_amount AS total
    FROM '{0}/trips/*.parquet' JOIN '{0}/zones/*.parquet' ON pickup_zone_id = zone_id
    WHERE trip_distance_km BETWEEN 0.1 AND 200 AND fare_amount >= 2.5
      AND dropoff_ts - pickup_ts BETWEEN 60 AND 21600"""
HOURS = """
    SELECT borough, pickup_ts // 3600 % 24 AS pickup_hour, count(trip_id) AS trips,
           sum(total) AS total_revenue, avg(fare_amount) AS avg_fare,
           avg(100 * tip_amount / fare_amount) AS avg_tip_pct,
           avg(3600 * trip_distance_km / (dropoff_ts - pickup_ts)) AS avg_speed_kmh,
           max(trip_distance_km) AS max_distance_km, count(DISTINCT vendor_id) AS n_vendors
    FROM joined GROUP BY ALL"""
ZONES = """
    SELECT borough, zone_id, sum(total) AS zone_revenue, count(*) AS zone_trips,
           row_number() OVER (PARTITION BY borough ORDER BY sum(total) DESC, zone_id) AS rank
    FROM joined GROUP BY borough, zone_id QUALIFY rank <= 5"""


@pytest.fixture(scope="module")
def expected(data, tables):
    """The two results and the number of joined rows, as DuckDB finds them in the files."""
    with duckdb.connect() as con:
        con.execute(f"CREATE TABLE joined AS {JOINED.format(data)}")
        return (con.sql(HOURS).df(), con.sql(ZONES).df(),
                con.sql("SELECT count(*) FROM joined").fetchall()[0][0])


def check(spark, got, want: pd.DataFrame, schema, keys):
    want = spark.createDataFrame(want[schema.names], schema)
    assert got.columns == schema.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in schema]
    diff.require_same(diff.diff_tables(want, got, keys))


def test_direct_results(spark, tables, expected):
    joined = plan.prepared(*tables)
    check(spark, plan.borough_hour(joined), expected[0], S.BOROUGH_HOUR,
          ["borough", "pickup_hour"])
    check(spark, plan.top_zones(joined), expected[1], S.TOP_ZONES, ["borough", "rank"])
    keys = [(r.borough, r.pickup_hour) for r in plan.borough_hour(joined).collect()]
    assert keys == sorted(keys)


def test_results_from_state(spark, tables, expected):
    state = plan.zone_hour_state(tables[0])
    check(spark, plan.borough_hour_from_state(state, tables[1]), expected[0], S.BOROUGH_HOUR,
          ["borough", "pickup_hour"])
    check(spark, plan.top_zones_from_state(state, tables[1]), expected[1], S.TOP_ZONES,
          ["borough", "rank"])


def test_daily_rollup(spark, tables, expected):
    path = files.fresh_path(spark, "test-daily")
    daily = plan.with_day(tables[0])
    early = F.col("day") < "2024-01-12"
    for some in (daily.filter(early), daily.filter(~early)):
        rollup.store_slices(plan.zone_hour_state(some, "day"), path, "day")
    stored = rollup.load(spark, path, plan.zone_hour_state(daily, "day").schema)
    assert stored.select("day").distinct().count() in (30, 31)
    check(spark, plan.borough_hour_from_state(stored, tables[1]), expected[0], S.BOROUGH_HOUR,
          ["borough", "pickup_hour"])
    check(spark, plan.top_zones_from_state(stored, tables[1]), expected[1], S.TOP_ZONES,
          ["borough", "rank"])


def test_run_writes_results_and_record(spark, data, tables, expected):
    out = files.fresh_path(spark, "test-run")
    record = plan.run(spark, f"{data}/trips", f"{data}/zones", out)
    assert (record["rows_in"], record["rows_kept"]) == (60_000, expected[2])
    assert record["scan_partitions"] >= 1 and record["compute_s"] > 0
    check(spark, files.read_csv(spark, f"{out}/agg", S.BOROUGH_HOUR), expected[0],
          S.BOROUGH_HOUR, ["borough", "pickup_hour"])
    check(spark, files.read_csv(spark, f"{out}/top_zones", S.TOP_ZONES), expected[1],
          S.TOP_ZONES, ["borough", "rank"])
    stored = json.loads(spark.read.text(f"{out}/record").first()[0])
    assert stored == record


def test_partials_per_file(spark, data, tables, expected):
    by_file = files.with_file_name(files.read_parquet(spark, f"{data}/trips", schema=S.TRIPS))
    state = plan.zone_hour_state(by_file, "file")
    assert state.select("file").distinct().count() == 6
    check(spark, plan.borough_hour_from_state(state, tables[1]), expected[0], S.BOROUGH_HOUR,
          ["borough", "pickup_hour"])


def test_stored_runs_are_compared(spark, data, tables):
    outs = {n: files.fresh_path(spark, f"test-{n}") for n in ("first", "same", "other")}
    plan.run(spark, f"{data}/trips", f"{data}/zones", outs["first"])
    joined = plan.prepared(*tables)
    for name, rows in (("same", joined), ("other", joined.filter("trip_id <> 5000"))):
        files.write_csv(plan.borough_hour(rows), f"{outs[name]}/agg")
        files.write_csv(plan.top_zones(rows), f"{outs[name]}/top_zones")
    diff.require_same(plan.compare_runs(spark, {n: outs[n] for n in ("first", "same")}))
    with pytest.raises(diff.TablesDiffer, match=r"\[first vs other\] trips"):
        diff.require_same(plan.compare_runs(spark, outs))


def test_skew_report(spark, data, tables):
    camps = synthetic.campaigns(synthetic.campaign_ids(spark, 2))
    diff.require_same(diff.diff_gate(skew_report.joins(tables[0], camps, 4),
                                     ["pickup_zone_id"]))
    out = files.fresh_path(spark, "test-skew-report")
    report = skew_report.run(spark, f"{data}/trips", out, per_zone=3, cores=4)
    assert report["hot_key"] == S.HOT_ZONE and abs(report["hot_share"] - 0.303) < 0.02
    assert abs(report["predicted_ceiling"] - 4 * report["hot_share"]) < 0.01
    assert json.loads(spark.read.text(out).first()[0]) == report


def test_empty_trips(spark, tables):
    joined = plan.prepared(tables[0].limit(0), tables[1])
    assert plan.borough_hour(joined).count() == plan.top_zones(joined).count() == 0


def test_plan_prunes_pushes_and_broadcasts(tables):
    text = plan_text(plan.borough_hour(plan.prepared(*tables)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    scan = next(line for line in text.splitlines()
                if "FileScan" in line and "trip_distance_km" in line)
    for wanted in ("GreaterThanOrEqual(trip_distance_km,0.1)",
                   "LessThanOrEqual(trip_distance_km,200.0)",
                   "GreaterThanOrEqual(fare_amount,2.5)", "IsNotNull(pickup_zone_id)"):
        assert wanted in scan
    columns = scan.split("ReadSchema: struct<")[1]
    assert "passenger_count" not in columns and "payment_type" not in columns
    assert columns.count(":") == 8


def test_state_neither_joins_nor_shuffles_rows(tables):
    text = plan_text(plan.zone_hour_state(tables[0]))
    assert "Join" not in text
    before_shuffle = text[text.rindex("Exchange"):]
    assert "partial_sum" in before_shuffle


def test_borough_state_merges_and_costs_no_more_exchanges(spark, tables, expected):
    state = plan.borough_hour_state(*tables)
    out = plan.borough_hour_from_state(state)
    check(spark, out, expected[0], S.BOROUGH_HOUR, ["borough", "pickup_hour"])
    exchanges = lambda df: plan_text(df).count("Exchange hash")
    assert exchanges(out) <= exchanges(plan.borough_hour(plan.prepared(*tables)))
    by_day = plan.borough_hour_state(plan.with_day(tables[0]), tables[1], "day")
    check(spark, plan.borough_hour_from_state(by_day), expected[0], S.BOROUGH_HOUR,
          ["borough", "pickup_hour"])


def test_run_records_the_planned_scan(spark, data):
    record = plan.run(spark, f"{data}/trips", f"{data}/zones", files.fresh_path(spark, "test-run"))
    assert record["source_files"] == 6 and record["cores"] == spark.sparkContext.defaultParallelism
    assert record["scan_partitions"] >= 6  # small files: one task each
    assert record["split_bytes"] >= 4 * 2 ** 20 and record["source_bytes"] > 0
