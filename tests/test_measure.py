import math
import random
import statistics

import pytest

from tallyloom.operators import measure
from tests.support.plans import plan

SCHEMA = "config string, level bigint, rep bigint, outcome string, value double"


def make_runs(seed, groups):
    rng = random.Random(seed)
    rows = []
    for (config, level), n in groups.items():
        for rep in range(n):
            rows.append((config, level, rep, "ok", round(rng.lognormvariate(0, 2), 2) + 0.01))
    rng.shuffle(rows)
    return rows


def brute(rows, warmups=True):
    out = {}
    for key in {(r[0], r[1]) for r in rows}:
        mine = sorted((r for r in rows if (r[0], r[1]) == key), key=lambda r: r[2])
        values = [r[4] for r in mine[1 if warmups else 0:]]
        if values:
            out[key] = (len(values), statistics.median(values), min(values), max(values))
    return out


def as_dict(summary):
    return {(r.config, r.level): (r.runs, r["median"], r["min"], r["max"])
            for r in summary.collect()}


def close(a, b):
    return a.keys() == b.keys() and all(math.isclose(x, y, rel_tol=1e-12)
                                        for k in a for x, y in zip(a[k], b[k]))


GROUPS = {("a", 1): 1, ("a", 2): 2, ("a", 3): 3, ("b", 1): 4, ("b", 2): 501, ("b", 3): 500}


@pytest.mark.parametrize("warmups", [True, False])
def test_summary_equals_brute_force(spark, warmups):
    rows = make_runs(1, GROUPS)
    df = spark.createDataFrame(rows, SCHEMA)
    out = measure.summarise(df, ["config", "level"], ["rep"], "value", warmups=warmups)
    assert close(as_dict(out), brute(rows, warmups))


@pytest.mark.parametrize("n", [8000, 8001])
def test_median_of_large_groups_is_exact(spark, n):
    rows = make_runs(n, {("hot", 1): n, ("cold", 1): 7, (None, 2): 300})
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = measure.summarise(df, ["config", "level"], ["rep"], "value")
    assert close(as_dict(out), brute(rows))


@pytest.mark.parametrize("values", [
    [5.0] * 3000 + [9.0],                                  # copies
    [1.0] * 1500 + [2.0] * 1500,                           # the middle between two values
    [1.0] * 1500 + [2.0] * 1501,
    [i * 1e-9 for i in range(1500)] + [1e300] * 1501,      # far outliers
    [-1.7e308] + [float(i) for i in range(2000)] + [1.7e308],
    [i * 1e-6 for i in range(1000)] + [1e6 + i for i in range(1001)],  # two far groups
    [10.0 ** (i / 10 - 300) for i in range(6001)],                     # even in log scale
    [math.inf] + [float(i) for i in range(2000)] + [-math.inf],
    [0.0, 5e-324, 5e-324, 5e-324, 0.0],
])
def test_median_of_awkward_groups(spark, values):
    rows = [("a", 1, i, "ok", v) for i, v in enumerate(values)]
    out = measure.summarise(spark.createDataFrame(rows, SCHEMA), ["config", "level"], ["rep"],
                            "value")
    assert close(as_dict(out), brute(rows))


def test_no_window_sees_a_whole_group(spark, monkeypatch, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    seen = []
    real = measure.cut_lineage

    def spy(df):
        stored = real(df)
        seen.append(max(r["count"] for r in stored.groupBy("_part").count().collect()))
        return stored

    monkeypatch.setattr(measure, "cut_lineage", spy)
    rows = [("a", 1, i, "ok", float((i * 7919) % 10007)) for i in range(10_007)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    out = measure.summarise(df, ["config", "level"], ["rep"], "value")
    assert close(as_dict(out), brute(rows))
    assert len(seen) == 1 and seen[0] <= 10_007 // 4  # one pass, over eight ranges


def test_failed_null_and_nan_runs_are_left_out(spark):
    rows = [("a", 1, 0, "ok", 9.0), ("a", 1, 1, "ok", 1.0), ("a", 1, 2, "failed", 100.0),
            ("a", 1, 3, "ok", None), ("a", 1, 4, "ok", math.nan), ("a", 1, 5, "ok", 3.0)]
    df = measure.successful(spark.createDataFrame(rows, SCHEMA), "outcome")
    out = measure.summarise(df, ["config", "level"], ["rep"], "value")
    assert as_dict(out) == {("a", 1): (2, 2.0, 1.0, 3.0)}
    assert out.first().per_unit == 1.0


SUMMARY = [("s", 1, 10, 8.0, 6.0, 10.0), ("s", 2, 10, 4.0, 3.0, 5.0), ("s", 4, 10, 2.5, 2.0, 3.0),
           ("t", 2, 5, 1.0, 1.0, 1.0)]


def summary(spark):
    return spark.createDataFrame(
        SUMMARY, "config string, level bigint, runs bigint, median double, min double, "
                 "max double")


def test_speedup_against_the_first_level(spark):
    out = {(r.config, r.level): (r.speedup, r.speedup_low, r.speedup_high)
           for r in measure.speedup(summary(spark), ["config"], "level").collect()}
    assert out[("s", 1)] == (1.0, 0.8, 8 / 6)
    assert out[("s", 4)] == (8 / 2.5, 8 / 3, 4.0)
    assert out[("t", 2)] == (1.0, 1.0, 1.0)


def test_throughput_and_efficiency(spark):
    out = {(r.config, r.level): (r.efficiency, r.throughput_x)
           for r in measure.throughput(summary(spark), ["config"], "level").collect()}
    assert out[("s", 4)] == (8 / 2.5 / 4, 6.0 * 4 / 2.0)
    assert out[("s", 1)] == (1.0, 1.0)


def test_cost_ratio(spark):
    out = measure.cost_ratio(summary(spark), "config", "level", "s", "runs", "median", "level")
    found = {(r.config, r.level): r.cost_ratio for r in out.collect()}
    assert found[("s", 2)] == 1.0
    assert len(found) == summary(spark).count()
    assert found[("t", 2)] == (10 / (4.0 * 2)) / (5 / (1.0 * 2))


def test_best_and_largest(spark):
    rows = [("a", 1, i, "ok", float(i)) for i in range(3)] + [
        ("a", 2, i, "ok", 1.0) for i in range(3)] + [("b", 5, 0, "ok", 7.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {(r.config, r.level): r.best
            for r in measure.best(df, ["config", "level"], "value").collect()} == {
        ("a", 1): 0.0, ("a", 2): 1.0, ("b", 5): 7.0}
    assert {r.config: (r.rows, r.largest_level)
            for r in measure.largest_level(df, "config", "level").collect()} == {
        "a": (6, 1), "b": (1, 5)}


def test_several_values_are_ranked_together(spark):
    rng = random.Random(7)
    rows = [(c, level, rep, round(rng.random(), 3) + 0.5, rng.choice([None, math.nan, 2.0, 5.0]),
             100 * level)
            for c, level, n in (("a", 1, 40), ("a", 2, 41), (None, 4, 9), ("c", 1, 1))
            for rep in range(n)]
    df = spark.createDataFrame(
        rows, "config string, level bigint, rep bigint, wall double, compute double, rows bigint")
    out = measure.summarise_values(df, ["config", "level"], ["rep"], ["wall", "compute", "rows"])
    found = {(r.config, r.level): r for r in out.collect()}
    assert set(found) == {("a", 1), ("a", 2), (None, 4)}  # ("c", 1) had its warm-up only
    for key, r in found.items():
        mine = [x for x in rows if x[:2] == key and x[2] > 0]
        assert r.runs == len(mine)
        for i, name in ((3, "wall"), (4, "compute"), (5, "rows")):
            values = [x[i] for x in mine if x[i] is not None and not math.isnan(x[i])]
            got = r[f"{name}_median"], r[f"{name}_min"], r[f"{name}_max"]
            assert got == pytest.approx((statistics.median(values), min(values), max(values)))


def test_a_value_that_was_never_measured_is_null(spark):
    df = spark.createDataFrame([("a", 1, 0, 1.0, None), ("a", 1, 1, 2.0, None)],
                               "config string, level bigint, rep bigint, x double, y double")
    row = measure.summarise_values(df, ["config", "level"], ["rep"], ["x", "y"]).first()
    assert (row.runs, row.x_median, row.y_median) == (1, 2.0, None)
    assert measure.summarise_values(df.limit(0), ["config"], ["rep"], ["x"]).count() == 0
