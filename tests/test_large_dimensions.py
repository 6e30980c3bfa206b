"""The same answers when nothing may be broadcast, as with dimensions beyond the limit."""

import pytest

import __spark_entry__ as entry
from tallyloom.plans import events, star
from tests.support.oracle import compare, connect
from tests.support.plans import plan

NAMES = ["region_month_agg", "top_per_region", "events_region_hour", "dim_join",
         "rollup_partial", "rollup_top", "skew_join_preagg"]


@pytest.fixture
def nothing_fits(conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(star, "is_small", lambda *a: False)
    monkeypatch.setattr(events, "is_small", lambda *a: False)


@pytest.mark.parametrize("name", NAMES)
def test_sort_merge_answers_equal_sql(spark, sf, nothing_fits, name):
    df = entry.queries()[name](spark, sf)
    assert "BroadcastHashJoin" not in plan(df)
    report = compare(df, connect(sf), entry.oracle_sql()[name])
    assert report["ok"], report


def test_rows_are_reduced_before_they_meet_a_large_dimension(spark, sf, nothing_fits):
    text = plan(star.region_month_agg(spark, sf)).splitlines()
    depth = lambda word: [i for i, line in enumerate(text) if word in line]
    suppliers = next(i for i, line in enumerate(text)
                     if "SortMergeJoin" in line and "s_suppkey" in line)
    orders = next(i for i, line in enumerate(text)
                  if "SortMergeJoin" in line and "o_orderkey" in line)
    assert any(suppliers < i < orders for i in depth("HashAggregate"))


def test_the_size_check_decides(spark, sf, monkeypatch):
    assert star.suppliers_small(spark, sf)
    assert "BroadcastHashJoin" in plan(star.dim_join(spark, sf))
    monkeypatch.setattr(star, "BROADCAST_BYTES", 64)
    assert not star.suppliers_small(spark, sf)


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(star.region_month_agg(spark, sf))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "l_tax" in line)
    for wanted in ("GreaterThanOrEqual(l_quantity,2.0)", "LessThanOrEqual(l_quantity,48.0)",
                   "GreaterThanOrEqual(l_extendedprice,1500.0)"):
        assert wanted in scan
    assert "l_partkey" not in scan and "l_linestatus" not in scan
    assert "WindowGroupLimit" in plan(star.top_per_region(spark, sf))


def test_counting_keys_twice_scans_once(spark, sf):
    """The profile's total reuses the counts."""
    df = star.key_profile(30)(spark, sf)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
