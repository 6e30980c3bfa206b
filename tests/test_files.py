import pytest
from pyspark.sql import functions as F

from tallyloom.functions import sizing
from tallyloom.operators import diff
from tallyloom.operators.enrich import attach
from tallyloom.session import MIB, split_bytes
from tallyloom.sources import files
from tests.support.plans import plan

SCHEMA = "k int, x double, s string, n bigint"
ROWS = [(1, 0.1 + 0.2, 'a "quoted", value', 1), (2, None, "", 2), (3, 1e-300, None, None),
        (4, -1.5, "ümlaut", 2 ** 62)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def same(a, b):
    return diff.diff_rows(a, b).count() == 0


def test_csv(spark, df):
    path = files.fresh_path(spark, "test-csv")
    files.write_csv(df, path)
    assert same(df, files.read_csv(spark, path, SCHEMA))


def test_csv_with_a_bad_line_is_an_error(spark):
    path = files.fresh_path(spark, "test-bad")
    spark.createDataFrame([("k,n",), ("1,2",), ("x,3",)], "value string").coalesce(1
                                                                          ).write.text(path)
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        files.read_csv(spark, path, "k int, n bigint").collect()


def test_json(spark, df):
    path = files.fresh_path(spark, "test-json")
    files.write_json(df, path)
    assert same(df, files.read_json(spark, path, SCHEMA))


def test_parquet_many_parts_and_columns(spark, df):
    first, second = (files.fresh_path(spark, "test-part") for _ in range(2))
    files.write_parquet(df, first)
    files.write_parquet(df, second)
    both = files.read_parquet(spark, first, second, schema=SCHEMA, columns=["k", "n"])
    assert both.columns == ["k", "n"] and both.count() == 8
    assert files.row_count(spark, first, second) == 8
    with pytest.raises(Exception, match="(?i)already exists"):
        files.write_parquet(df, first)


def test_count_decodes_no_column(spark, sf):
    text = plan(spark.read.parquet(f"{sf}/lineitem.parquet").groupBy().count())
    assert "ReadSchema: struct<>" in text


def test_position_in_file_is_unique_and_stable(spark, sf):
    items = files.with_row_number_in_file(spark.read.parquet(f"{sf}/lineitem.parquet"))
    rows = items.count()
    assert items.select("row_in_file").distinct().count() == rows
    again = files.with_row_number_in_file(spark.read.parquet(f"{sf}/lineitem.parquet"))
    assert same(items.repartition(3), again)


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = files.shared_folder(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    if named is not None:
        assert folder == named
    assert files.fresh_path(spark, "x") != files.fresh_path(spark, "x")


def test_small_scans_are_spread_and_large_ones_are_not(spark, sf, conf):
    items = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    assert "RoundRobinPartitioning" in plan(files.spread_small(items))
    conf("spark.sql.files.maxPartitionBytes", "1k")
    assert "RoundRobinPartitioning" not in plan(files.spread_small(items))


def test_measured_size(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "ü")], "k int, s string")
    assert sizing.measured_bytes(df) == 3 * (16 + 32) + 5
    assert sizing.measured_bytes(df.limit(0)) == 0
    assert sizing.measured_bytes(df.withColumn("a", F.array("k"))) is None
    assert sizing.as_bytes("134217728b") == 128 * MIB == sizing.as_bytes("128m")


def test_dimension_is_broadcast_only_within_its_limit(spark, sf):
    fact = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_suppkey", "l_quantity")
    dim = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", "s_name")
    small = attach(fact, dim, "l_suppkey", "s_suppkey")
    assert "BroadcastHashJoin" in plan(small)
    large = attach(fact, dim, "l_suppkey", "s_suppkey", limit=100)
    assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
    assert same(small, large)
    # small on disk, large in memory: the free look at the sources is not enough
    wide = dim.select("s_suppkey", F.repeat("s_name", 10_000).alias("s_name"))
    disk = sizing.scanned_bytes(wide)
    assert sizing.measured_bytes(wide) > 2 * disk
    assert not sizing.fits_broadcast(wide, 2 * disk)


def test_unmatched_and_null_keys_drop_out(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (9,)], "a int")
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "b int, label string")
    for broadcast in (True, False):
        out = attach(fact, dim, "a", "b", broadcast=broadcast)
        assert out.columns == ["a", "b", "label"]
        assert sorted(r.label for r in out.collect()) == ["x", "y"]


def test_split_size():
    assert split_bytes(10 * MIB, 8) == 16 * MIB
    assert split_bytes(100 * 1024 ** 4, 8000) == 512 * MIB
    assert 16 * MIB < split_bytes(3000 * MIB, 8) < 512 * MIB


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    def session(master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None,
                                  setCheckpointDir=lambda folder: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default),
                               sparkContext=context)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            files.shared_folder(session(master))
    assert files.shared_folder(session("local[4]"))


def test_split_size_counts_the_cost_of_files():
    assert split_bytes(320 * MIB, 8, smallest=MIB, files=32, open_cost=4 * MIB) == 448 * MIB // 24 - 4 * MIB


@pytest.mark.parametrize("n_files, rows", [(32, 2_000_000), (2, 4_000_000)])
def test_planned_splits_give_every_core_three_tasks_or_every_file_one(spark, n_files, rows):
    path = files.fresh_path(spark, "test-splits")
    cores = spark.sparkContext.defaultParallelism
    made = spark.range(0, rows, 1, n_files).select(F.xxhash64("id").alias("a"),
                                                   F.xxhash64("id", F.lit(1)).alias("b"))
    made.write.option("parquet.block.size", MIB).parquet(path)
    df = files.read_parquet(spark, path, schema="a bigint, b bigint")
    before = spark.conf.get(files.SPLIT)
    with files.planned_splits(df) as record:
        assert record["source_files"] == n_files and record["cores"] == cores
        assert record["source_bytes"] > 16 * rows // 2
        assert files.scan_partitions(df) >= min(3 * cores, n_files)
        if n_files < 3 * cores:  # large files are cut
            assert files.scan_partitions(df) > n_files
        assert df.agg(F.count("a")).first()[0] == rows
    assert spark.conf.get(files.SPLIT) == before
    with pytest.raises(ZeroDivisionError), files.planned_splits(df):
        1 / 0
    assert spark.conf.get(files.SPLIT) == before
