import pytest
from pyspark.sql import functions as F

from tallyloom.operators import diff, ranking, skew
from tallyloom.sources import files
from tests.support.plans import final_plan, plan


def skewed(spark, rows=4000, hot=0.6):
    return spark.range(0, rows, 1, 4).select(
        F.when(F.col("id") % 100 < int(hot * 100), F.lit(3)).otherwise(F.col("id") % 11)
        .alias("k"), "id")


def small_side(spark, per_key=5, keys=9):
    return spark.range(keys * per_key).select(
        (F.col("id") % keys).alias("key"), (F.col("id") + 1).cast("double").alias("amount"))


def all_joins(big, small, tasks=8):
    total = lambda joined: skew.totals(joined, "k", "amount", "total", "n")
    return {
        "plain": total(skew.plain_join(big, small, "k", "key")),
        "salted": total(skew.salted_join(big, small, "k", "key", ["id"], 7)),
        "selective": total(skew.selective_salted_join(
            big, small, "k", "key", ["id"], skew.salt_counts(big, "k", tasks))),
        "preaggregated": skew.preaggregated_totals(big, small, "k", "key", "amount", "total",
                                                   "n"),
    }


def test_all_joins_agree(spark):
    results = all_joins(skewed(spark), small_side(spark))
    assert results["plain"].count() == 9  # keys 9 and 10 have no match
    diff.require_same(diff.diff_gate(results, ["k"]))


def test_joined_rows_are_the_same(spark):
    big, small = skewed(spark, 500), small_side(spark)
    plain = skew.plain_join(big, small, "k", "key")
    for other in (skew.salted_join(big, small, "k", "key", ["id"], 4),
                  skew.selective_salted_join(big, small, "k", "key", ["id"])):
        assert other.columns == plain.columns
        assert diff.diff_rows(plain, other).count() == 0


@pytest.mark.parametrize("written_out", [0, 32])
def test_hot_keys_in_the_plan_or_broadcast(spark, monkeypatch, written_out):
    monkeypatch.setattr(skew, "WRITTEN_OUT", written_out)
    big, small = skewed(spark, 500), small_side(spark)
    joined = skew.selective_salted_join(big, small, "k", "key", ["id"])
    assert ("BroadcastHashJoin" in plan(joined)) == (written_out == 0)
    assert diff.diff_rows(skew.plain_join(big, small, "k", "key"), joined).count() == 0


def test_null_keys_and_empty_sides(spark):
    big = skewed(spark, 200).withColumn("k", F.when(F.col("id") % 2 == 0, F.col("k")))
    results = all_joins(big, small_side(spark))
    diff.require_same(diff.diff_gate(results, ["k"]))
    for left, right in ((big.limit(0), small_side(spark)), (big, small_side(spark).limit(0))):
        assert all(r.count() == 0 for r in all_joins(left, right).values())


def test_profile_and_hottest(spark):
    big = skewed(spark)
    profile = skew.key_profile(big, "k", 8)
    assert profile.agg(F.sum("rows")).first()[0] == 4000
    assert abs(profile.agg(F.sum("share")).first()[0] - 1) < 1e-12
    top = ranking.top_k(profile, "rows", "k", 1).first()
    assert top.k == 3 and top.share > 0.6
    assert top.gain_bound == top.share * 8
    assert profile.filter("share < 0.125").agg(F.max("gain_bound")).first()[0] == 1.0


def test_hot_keys_are_bounded_and_cut_by_share(spark):
    hot = skew.salt_counts(skewed(spark), "k", 8).collect()
    assert [(r["_hot_key"], r["_salts"]) for r in hot] == [(3, 21)]
    even = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert skew.salt_counts(even, "k", 8).count() == 0
    # never more than the number of tasks
    assert skew.salt_counts(even, "k", 64).count() == 0
    assert skew.salt_counts(even, "k", 101).count() == 100


def test_salt_spreads_copies_of_one_row(spark):
    copies = spark.range(0, 1600, 1, 4).withColumn("k", F.lit(1))
    sizes = [r["count"] for r in copies.groupBy(skew.salt(["id"], 16)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 160


def test_salt_is_the_same_under_another_partitioning(spark):
    rows = skewed(spark)
    salted = lambda df: df.select("id", skew.salt(["id"], 16).alias("s"))
    assert diff.diff_rows(salted(rows), salted(rows.repartition(7))).count() == 0


def test_replicate(spark):
    out = skew.replicate(spark.range(3), 4)
    assert out.count() == 12 and out.select(skew.SALT).distinct().count() == 4


def test_plain_join_is_sort_merge_and_may_be_split(spark, conf):
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    big = skewed(spark, 20000, 0.9).withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
    joined = skew.plain_join(big, small_side(spark), "k", "key")
    total = skew.totals(joined.withColumn("amount", F.col("amount") + F.length("pad")),
                        "k", "amount", "total", "n")
    assert "SortMergeJoin" in plan(total)
    assert "skew=true" in final_plan(total)


def test_plain_join_sorts_a_key_of_very_many_rows_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(skew, "KEY_ROWS", 1000)
    big = skewed(spark, 20_000, 0.85).withColumn("k", F.when(F.col("id") % 50 != 7, F.col("k")))
    small = small_side(spark)
    whole = skew.plain_join(big, small, "k", "key")
    cut = skew.plain_join(big, small, "k", "key", ["id"])
    assert "SortMergeJoin" in plan(cut) and skew.SALT in plan(cut)
    assert cut.columns == whole.columns
    assert diff.diff_rows(whole, cut).count() == 0
    pieces = {r["_hot_key"]: r["_salts"] for r in skew.salt_counts(big, "k", 20).collect()}
    most = (big.filter("k = 3").groupBy(skew.salt(["id"], pieces[3])).count()
            .agg(F.max("count")).first()[0])
    assert most < 1000 < big.filter("k = 3").count()
    # other keys are joined whole, and so is a table of few rows
    assert set(pieces) == {3}
    assert skew.SALT not in plan(skew.plain_join(big.limit(1500), small, "k", "key", ["id"]))


def test_preaggregated_join_builds_no_pairs(spark):
    text = plan(skew.preaggregated_totals(skewed(spark), small_side(spark), "k", "key", "amount",
                                          "total", "n"))
    join = text.index("Join")
    assert text.count("HashAggregate") == 4 and text.index("HashAggregate") > join


def test_hot_keys_are_found_among_very_many_without_counting_all(spark):
    """More keys than the state tracks, met in the worst order: hot ones last."""
    n, tasks = 400_000, 8
    rows = spark.range(0, n, 1, 4).select(
        F.when(F.col("id") < n * 7 // 10, F.col("id")).when(F.col("id") % 2 == 0, F.lit(-1))
        .otherwise(-2 - F.col("id") % 3).alias("k"))
    hot = {r["_hot_key"]: r["_salts"] for r in skew.salt_counts(rows, "k", tasks).collect()}
    assert hot == {-1: 5}  # 15% of the rows; the three others have 5% each
    state = skew.heavy_state(rows, "k", tasks)
    text = plan(state)
    assert "hashpartitioning(k" not in text  # one state a task, no key is shuffled


def test_heavy_hitter_states_of_slices_merge(spark):
    rows = skewed(spark, 20_000, 0.4).withColumn("part", F.col("id") % 3)
    slices = skew.heavy_state(rows, "k", 8, ["part"])
    path = files.fresh_path(spark, "test-heavy")
    files.write_parquet(slices, path)
    found, total = skew.heavy_keys(spark.read.parquet(path), 8)
    assert total == 20_000 and 3 in found
    assert skew.heavy_keys(slices.limit(0), 8) == ([], 0)


def test_hot_keys_may_be_strings_or_dates(spark):
    rows = skewed(spark, 2_000)
    for kind in ("string", "date"):
        key = F.col("k").cast("string") if kind == "string" else F.date_add(
            F.lit("2024-01-01").cast("date"), F.col("k").cast("int"))
        df = rows.select(key.alias("k"))
        hot = skew.salt_counts(df, "k", 8)
        assert hot.schema["_hot_key"].dataType == df.schema["k"].dataType
        assert [r["_salts"] for r in hot.collect()] == [21]
    assert skew.salt_counts(rows.limit(0), "k", 8).count() == 0
