import math

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import diff

SCHEMA = "k int, n bigint, x double, s string"
ROWS = [(1, 10, 1.0, "a"), (2, 20, 2.0, "b"), (3, 30, 0.0, None)]


def table(spark, rows=ROWS, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def report(spark, rows, **options):
    out = diff.diff_tables(table(spark), table(spark, rows), ["k"], **options)
    assert out.schema.names == diff.REPORT.names
    return {r.column: r for r in out.collect()}


def test_equal_tables(spark):
    found = report(spark, ROWS)
    assert set(found) == {"n", "x", "s"}
    assert all(r.compared == 3 and r.mismatches == 0 for r in found.values())
    assert found["x"].worst_rel_error == 0.0 and found["n"].worst_rel_error is None
    diff.require_same(diff.diff_tables(table(spark), table(spark, ROWS[::-1]), ["k"]))


def test_float_tolerance_is_relative_to_the_other_side(spark):
    close = [(1, 10, 1.0 + 1e-10, "a"), (2, 20, 2.0 - 1e-10, "b"), (3, 30, 0.0, None)]
    assert report(spark, close)["x"].mismatches == 0
    far = [(1, 10, 1.0 + 1e-8, "a"), *ROWS[1:]]
    found = report(spark, far)["x"]
    assert found.mismatches == 1 and math.isclose(found.worst_rel_error, 1e-8, rel_tol=1e-6)


def test_error_is_absolute_where_the_other_side_is_zero(spark):
    left, right = table(spark, [(1, 1, 0.5, "a")]), table(spark, [(1, 1, 0.0, "a")])
    row = diff.diff_tables(left, right, ["k"]).filter("column = 'x'").first()
    assert (row.mismatches, row.worst_rel_error) == (1, 0.5)


def test_integers_and_text_are_exact(spark):
    found = report(spark, [(1, 11, 1.0, "a"), (2, 20, 2.0, "B"), (3, 30, 0.0, "")])
    assert (found["n"].mismatches, found["s"].mismatches, found["x"].mismatches) == (1, 2, 0)


def test_missing_and_duplicate_keys(spark):
    found = report(spark, [(1, 10, 1.0, "a"), (4, 1, 1.0, "z"), (3, 30, 0.0, None),
                           (3, 30, 0.0, None)])
    row = found["n"]
    assert (row.compared, row.left_only, row.right_only, row.duplicate_keys) == (1, 1, 1, 1)
    with pytest.raises(diff.TablesDiffer, match="duplicate_keys=1"):
        diff.require_same(diff.diff_tables(table(spark), table(spark, ROWS * 2), ["k"])
                          .withColumn("duplicate_keys", F.lit(1)))


def test_null_nan_and_infinity(spark):
    nan, inf = math.nan, math.inf
    left = [(1, 1, nan, "a"), (2, 1, inf, "a"), (3, None, None, None), (4, 1, 1.0, "a"),
            (5, 1, 1.0, "a")]
    right = [(1, 1, nan, "a"), (2, 1, inf, "a"), (3, None, None, None), (4, 1, None, "a"),
             (5, 1, inf, "a")]
    count = lambda **o: diff.diff_tables(table(spark, left), table(spark, right), ["k"], **o
                                         ).filter("column = 'x'").first().mismatches
    assert count() == 3  # NaN, null against a value, a value against infinity
    assert count(nan_equal=True) == 2
    assert count(null_equal=False) == 4


def test_null_keys_pair_up(spark):
    rows = [(None, 1, 1.0, "a")]
    diff.require_same(diff.diff_tables(table(spark, rows), table(spark, rows), ["k"]))


def test_schema_differences_are_reported(spark):
    other = table(spark).withColumnRenamed("s", "t")
    row = diff.diff_tables(table(spark), other, ["k"]).first()
    assert row.kind == "schema" and "'t'" in row.column
    other = table(spark).withColumn("n", F.col("n").cast("int"))
    assert diff.diff_tables(table(spark), other, ["k"]).first().column == (
        "column n: bigint != int")
    with pytest.raises(diff.TablesDiffer):
        diff.require_same(diff.diff_tables(table(spark), other, ["k"]))


def test_gate_compares_each_with_the_first(spark):
    wrong = table(spark, [(1, 10, 1.0, "it's"), *ROWS[1:]])
    gate = diff.diff_gate({"a": table(spark), "b": table(spark), "it's": wrong}, ["k"])
    bad = [(r.other, r.column, r.mismatches) for r in diff.differences(gate).collect()]
    assert bad == [("it's", "s", 1)]


def test_key_only_tables(spark):
    keys = table(spark).select("k")
    row = diff.diff_tables(keys, keys.filter("k > 1"), ["k"]).first()
    assert (row.kind, row.compared, row.left_only) == ("keys", 2, 1)


def test_a_hot_duplicate_key_makes_no_pairs(spark):
    hot = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("n"))
    row = diff.diff_tables(hot, hot, ["k"]).first()
    assert (row.compared, row.duplicate_keys) == (0, 1)
    assert diff.diff_rows(hot, hot).count() == 0


def test_diff_rows_counts_copies(spark):
    left = table(spark, [ROWS[0], ROWS[0], ROWS[2]])
    right = table(spark, [ROWS[0], ROWS[1], ROWS[2]])
    found = {(r.k, r.surplus) for r in diff.diff_rows(left, right).collect()}
    assert found == {(1, 1), (2, -1)}


def test_answer_does_not_depend_on_partitioning(spark):
    fact = spark.range(5000).select((F.col("id") % 13).alias("g"),
                                    (F.rand(3) * 1e6).alias("x")).checkpoint()
    query = lambda df: df.groupBy("g").agg(F.count("*").alias("n"), F.sum("x").alias("x"))
    diff.require_same(diff.repartition_invariance(query, fact, [1, 7, 32], ["g"]))
