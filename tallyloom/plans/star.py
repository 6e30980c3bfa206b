"""The pipeline on the star schema: lineitem as trips, supplier as zone, region as borough."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.scalar import settled_mean
from tallyloom.functions.sizing import BROADCAST_BYTES, fits_broadcast
from tallyloom.operators import diff, groups, quality, ranking, rollup, skew
from tallyloom.operators.enrich import attach
from tallyloom.schemas import TOP_N
from tallyloom.sources import files, synthetic

CORES = 8  # parallelism that the skew report is about
HOT_SUPPLIER = 16  # key that takes the injected skew

MEASURES = groups.Measures(
    counts={"n": "l_orderkey"},
    sums={"revenue": "total"},
    means={"avg_price": "l_extendedprice", "avg_rate": "rate", "avg_tax_pct": "tax_pct"},
    maxes={"max_quantity": "l_quantity"},
    distincts={"n_flags": "l_returnflag"},
)
GROUP = ["r_name", "ship_month"]


# Declared, so that building a query opens no file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return files.read_parquet(spark, f"{sf}/{name}.parquet", schema=SCHEMAS[name])


def lines(spark: SparkSession, sf: str, how: str = "inner") -> DataFrame:
    """Line items with their order's date; only the columns the pipeline reads.

    ``how="left"`` keeps line items without an order, to be accounted for.
    """
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return items.join(orders, items["l_orderkey"] == orders["o_orderkey"], how)


def lag_days() -> Column:
    return F.datediff("l_shipdate", "o_orderdate")


def rules() -> list[quality.Rule]:
    return [
        quality.Rule("quantity", F.col("l_quantity"), 2.0, 48.0),
        quality.Rule("price", F.col("l_extendedprice"), 1500.0),
        quality.Rule("lag", lag_days(), 1, 2000, floating=False),
    ]


def derive(rows: DataFrame) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rows.withColumns({
        "lag": lag_days().cast("bigint"),
        "rate": F.try_divide(F.col("l_quantity"), lag_days().cast("double")),
        "total": net * (1 + F.col("l_tax")),
        "tax_pct": F.try_divide(F.col("l_extendedprice") * F.col("l_tax"),
                                F.col("l_extendedprice")) * 100,
        "ship_month": F.month("l_shipdate").cast("bigint"),
    })


def kept(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean(lines(spark, sf), rules()).transform(derive)


def regions(spark: SparkSession, sf: str, name: str, key: str, nation: str) -> DataFrame:
    """(key, r_name) for a table that points to a nation."""
    nations = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    names = table(spark, sf, "region").select("r_regionkey", "r_name")
    named = nations.join(names, nations["n_regionkey"] == names["r_regionkey"], "inner")
    rows = table(spark, sf, name).select(key, nation)
    return rows.join(named, rows[nation] == named["n_nationkey"], "inner").select(key, "r_name")


def supplier_regions(spark: SparkSession, sf: str) -> DataFrame:
    return regions(spark, sf, "supplier", "s_suppkey", "s_nationkey")


def is_small(spark: SparkSession, sf: str, name: str, key: str, nation: str) -> bool:
    """Whether the table's regions may be broadcast.

    Measured on the table itself, whose two columns have a fixed width, so its rows are
    counted from the footers. The lookup gives each row one region name and adds none.
    """
    return fits_broadcast(table(spark, sf, name).select(key, nation), BROADCAST_BYTES // 2)


def suppliers_small(spark: SparkSession, sf: str) -> bool:
    return is_small(spark, sf, "supplier", "s_suppkey", "s_nationkey")


def shown(result: DataFrame) -> DataFrame:
    return result.select(
        "r_name", "ship_month", "n", F.round("revenue", 2).alias("revenue"),
        settled_mean(F.col("avg_price"), F.col("n"), 2).alias("avg_price"),
        F.round("avg_rate", 6).alias("avg_rate"),
        settled_mean(F.col("avg_tax_pct"), F.col("n"), 6).alias("avg_tax_pct"),
        "max_quantity", "n_flags")


def region_month(spark: SparkSession, sf: str) -> DataFrame:
    return groups.aggregate_by_dimension(
        kept(spark, sf), supplier_regions(spark, sf), "l_suppkey", "s_suppkey",
        ["ship_month"], ["r_name"], MEASURES, broadcast=suppliers_small(spark, sf))


def region_month_agg(spark: SparkSession, sf: str) -> DataFrame:
    return shown(region_month(spark, sf)).orderBy(*GROUP)


def ranked(totals: DataFrame) -> DataFrame:
    """Top suppliers per region from (l_suppkey, revenue, n), ranked on whole cents."""
    scored = totals.withColumn("revenue", F.round("revenue", 2))
    top = ranking.top_per_group(scored, ["r_name"], "revenue", "l_suppkey", TOP_N)
    return top.select("r_name", F.col("rank").cast("bigint").alias("rank"), "l_suppkey",
                      "revenue", "n")


def top_per_region(spark: SparkSession, sf: str) -> DataFrame:
    # one row per supplier before the dimension is attached
    totals = kept(spark, sf).groupBy("l_suppkey").agg(
        F.sum("total").alias("revenue"), F.count("l_orderkey").alias("n"))
    named = attach(totals, supplier_regions(spark, sf), "l_suppkey", "s_suppkey",
                   broadcast=suppliers_small(spark, sf))
    return ranked(named).orderBy("r_name", "rank")


def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean(lines(spark, sf), rules()).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
        lag_days().cast("bigint").alias("lag"))


def derive_columns(spark: SparkSession, sf: str) -> DataFrame:
    return kept(spark, sf).select("l_orderkey", "l_linenumber", "l_suppkey", "lag", "rate",
                                  "total", "tax_pct", "ship_month")


def has_order() -> quality.Rule:
    return quality.Rule("order", F.col("o_orderkey").isNotNull().cast("int"), 1, 1, floating=False)


def scan_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return quality.account(lines(spark, sf, "left"), [*rules(), has_order()])


def reject_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    return quality.rejects(lines(spark, sf, "left"), [*rules(), has_order()])


def source_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the source from its footers: the count reads no column."""
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("rows_in"))


def dim_projection(spark: SparkSession, sf: str) -> DataFrame:
    return supplier_regions(spark, sf)


def dim_join(spark: SparkSession, sf: str) -> DataFrame:
    per_key = groups.Measures(counts={"n": "*"}, sums={"quantity": "l_quantity"})
    return groups.aggregate_by_dimension(
        table(spark, sf, "lineitem").select("l_suppkey", "l_quantity"),
        supplier_regions(spark, sf), "l_suppkey", "s_suppkey", [], ["r_name"], per_key,
        broadcast=suppliers_small(spark, sf))


# Skew


def skewed_lines(spark: SparkSession, sf: str, percent: int, *extra: str) -> DataFrame:
    """Line items whose key is the hot supplier for about ``percent`` of the orders."""
    items = table(spark, sf, "lineitem")
    if "row_in_file" in extra:
        items = files.with_row_number_in_file(items)
    hot = F.col("l_orderkey") % 100 < percent
    return items.select(
        F.when(hot, F.lit(HOT_SUPPLIER)).otherwise(F.col("l_suppkey")).cast("bigint")
        .alias("key"), *extra)


def key_profile(percent: int) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return skew.key_profile(skewed_lines(spark, sf, percent), "key", CORES)
    return query


def top_keys(spark: SparkSession, sf: str) -> DataFrame:
    profile = skew.key_profile(skewed_lines(spark, sf, 30), "key", CORES)
    return ranking.top_k(profile.select("key", "rows"), "rows", "key", 3)


def supplier_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """One campaign per part, dealt out to the suppliers in turn."""
    suppliers = table(spark, sf, "supplier").agg(F.count(F.lit(1))).scalar()
    return synthetic.campaigns(table(spark, sf, "part").select("p_partkey"),
                               id_column="p_partkey", keys=suppliers, first_key=0)


def campaign_dim(spark: SparkSession, sf: str) -> DataFrame:
    return supplier_campaigns(spark, sf)


def salt_replicate(spark: SparkSession, sf: str) -> DataFrame:
    return skew.replicate(supplier_campaigns(spark, sf), skew.SALTS).withColumnRenamed(
        skew.SALT, "salt")


def skew_join(kind: str, percent: int = 30) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        keys = skewed_lines(spark, sf, percent)
        small = supplier_campaigns(spark, sf)
        if kind == "preagg":
            return skew.preaggregated_totals(keys, small, "key", "zone_id", "campaign_budget",
                                             "budget", "n")
        rows = skewed_lines(spark, sf, percent, "row_in_file")
        if kind == "plain":
            joined = skew.plain_join(rows, small, "key", "zone_id", ["row_in_file"])
        elif kind == "salted":
            joined = skew.salted_join(rows, small, "key", "zone_id", ["row_in_file"])
        else:
            hot = skew.salt_counts(keys, "key", skew.task_target(keys))
            joined = skew.selective_salted_join(rows, small, "key", "zone_id",
                                                ["row_in_file"], hot)
        return skew.totals(joined, "key", "campaign_budget", "budget", "n")
    return query


# Rollups


def with_order_dates(rows: DataFrame) -> DataFrame:
    month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    return rows.withColumns({"order_month": month.cast("bigint"),
                             "order_year": F.year("o_orderdate").cast("bigint")})


def region_slices(spark: SparkSession, sf: str, part: str = "order_month") -> DataFrame:
    """Partials per (part, region, ship month)."""
    return groups.partial_by_dimension(
        with_order_dates(kept(spark, sf)), supplier_regions(spark, sf), "l_suppkey",
        "s_suppkey", [part, "ship_month"], ["r_name"], MEASURES,
        broadcast=suppliers_small(spark, sf))


def rollup_partial(spark: SparkSession, sf: str) -> DataFrame:
    """One line per slice and group: its state rows, one for each flag, side by side."""
    by = ["order_month", *GROUP]
    return region_slices(spark, sf).groupBy(*by).agg(
        F.sum("n").alias("n"), F.round(F.sum("revenue"), 2).alias("revenue"),
        F.round(F.sum("avg_price_sum"), 2).alias("sum_price"),
        F.sum("avg_price_n").alias("n_price"), F.round(F.sum("avg_rate_sum"), 6).alias("sum_rate"),
        F.max("max_quantity").alias("max_quantity"), *flag_columns())


def flag_columns() -> list[Column]:
    """The few flags of a group written out, and their number, from merged state rows."""
    value = MEASURES.value_state("n_flags")
    return [F.concat_ws(",", F.sort_array(F.collect_list(value))).alias("flags"),
            F.count(value).alias("n_flags")]


def rollup_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Slices stored by order year, read back and merged."""
    path = files.fresh_path(spark, "rollup")
    slices = region_slices(spark, sf, "order_year")
    rollup.store_slices(slices, path, "order_year")
    return shown(rollup.answer(rollup.load(spark, path, slices.schema), GROUP, MEASURES)).orderBy(*GROUP)


def rollup_distinct_merge(spark: SparkSession, sf: str) -> DataFrame:
    state = rollup.compact(region_slices(spark, sf), GROUP, MEASURES)
    return state.groupBy(*GROUP).agg(*flag_columns())


def rollup_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per region, month and flag, read off the merged state."""
    return groups.frequencies(region_slices(spark, sf), GROUP, MEASURES, "n_flags")


WIDE = groups.Measures(counts={"n": "*"}, distincts={"n_flags": "l_returnflag"},
                       bitmaps={"n_orders": "l_orderkey", "n_suppliers": "l_suppkey"})


def rollup_many_values(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct orders and suppliers per region, merged from monthly slices as bitmaps."""
    slices = groups.partial_by_dimension(
        with_order_dates(kept(spark, sf)), supplier_regions(spark, sf), "l_suppkey", "s_suppkey",
        ["order_month"], ["r_name"], WIDE, broadcast=suppliers_small(spark, sf))
    return rollup.answer(slices, ["r_name"], WIDE)


def rollup_top(spark: SparkSession, sf: str) -> DataFrame:
    per_supplier = groups.Measures(counts={"n": "l_orderkey"}, sums={"revenue": "total"})
    slices = rollup.slices(with_order_dates(kept(spark, sf)), "order_month", ["l_suppkey"],
                           per_supplier)
    totals = rollup.answer(slices, ["l_suppkey"], per_supplier)
    named = attach(totals, supplier_regions(spark, sf), "l_suppkey", "s_suppkey",
                   broadcast=suppliers_small(spark, sf))
    return ranked(named).orderBy("r_name", "rank")


def union_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Four slices by ship date, each scanned with its own pushed filter, put together."""
    items = table(spark, sf, "lineitem").select(
        "l_shipdate", "l_linestatus", "l_quantity", "l_extendedprice")
    year = F.to_timestamp_ntz
    first, second = year(F.lit("1997-01-01")), year(F.lit("1999-01-01"))
    day = F.col("l_shipdate")
    parts = [items.filter(day < first), items.filter((day >= first) & (day < second)),
             items.filter(day >= second), items.filter(day.isNull())]
    whole = reduce(DataFrame.unionByName, parts)
    return whole.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"))


# Comparison


def supplier_totals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("price"),
        F.max("l_quantity").alias("max_quantity"), F.max("l_returnflag").alias("last_flag"))


def perturbed_totals(totals: DataFrame) -> DataFrame:
    """A copy with small and large errors, a missing key and a renamed key."""
    key = F.col("l_suppkey")
    price = (F.when(key % 10 == 3, F.col("price") * (1 + 1e-6))
             .when(key % 10 == 4, F.col("price") * (1 + 1e-12)).otherwise(F.col("price")))
    return totals.filter(key % 25 != 7).select(
        F.when(key % 25 == 9, -key).otherwise(key).alias("l_suppkey"),
        F.when(key % 10 == 5, F.col("n") + 1).otherwise(F.col("n")).alias("n"),
        price.alias("price"),
        F.when(key % 10 == 8, F.lit(0.0)).otherwise(F.col("max_quantity"))
        .alias("max_quantity"),
        F.when(key % 10 == 6, F.lit("?")).otherwise(F.col("last_flag")).alias("last_flag"))


def _shown_report(report: DataFrame) -> DataFrame:
    return report.withColumn("worst_rel_error", F.round("worst_rel_error", 12))


def table_diff(spark: SparkSession, sf: str) -> DataFrame:
    totals = supplier_totals(spark, sf)
    return _shown_report(diff.diff_tables(totals, perturbed_totals(totals), ["l_suppkey"]))


def row_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Keyless comparison: line items against a copy that lost and changed some rows."""
    items = table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag")
    changed = items.filter(F.col("l_quantity") != 13).withColumn(
        "l_returnflag", F.when(F.col("l_quantity") == 7, F.lit("?"))
        .otherwise(F.col("l_returnflag")))
    return diff.diff_rows(items, changed)


def table_diff_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The direct result, the result merged from slices and a wrong copy, in one comparison."""
    direct = region_month(spark, sf)
    merged = rollup.answer(region_slices(spark, sf), GROUP, MEASURES)
    wrong = direct.withColumn("n", F.when(F.col("ship_month") == 5, F.col("n") + 1)
                              .otherwise(F.col("n"))).withColumn(
        "revenue", F.when(F.col("ship_month") == 6, F.col("revenue") * 1.5)
        .otherwise(F.col("revenue")))
    return _shown_report(diff.diff_gate(
        {"direct": direct, "merged": merged, "wrong": wrong}, GROUP))


def repartition_invariance(spark: SparkSession, sf: str) -> DataFrame:
    dim = supplier_regions(spark, sf)
    small = suppliers_small(spark, sf)

    def query(fact: DataFrame) -> DataFrame:
        return groups.aggregate_by_dimension(
            fact, dim, "l_suppkey", "s_suppkey", ["ship_month"], ["r_name"], MEASURES,
            broadcast=small)

    tasks = skew.task_target(dim)
    rows = kept(spark, sf).select("l_orderkey", "l_suppkey", "total", "l_extendedprice", "rate",
                                  "tax_pct", "l_quantity", "l_returnflag", "ship_month")
    report = diff.repartition_invariance(query, rows, [2 * tasks + 1, 3 * tasks + 2], GROUP)
    return report.groupBy("column", "kind").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("compared").alias("compared"),
        F.sum("mismatches").alias("mismatches"), F.sum("left_only").alias("left_only"),
        F.sum("right_only").alias("right_only"),
        F.sum("duplicate_keys").alias("duplicate_keys"))


# Sinks and sources

RESULT_SCHEMA = ("r_name string, ship_month bigint, n bigint, revenue double, avg_price double, "
                 "avg_rate double, avg_tax_pct double, max_quantity double, n_flags bigint")


def roundtrip(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    """The flagship result, written to the shared folder and read back."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        path = files.fresh_path(spark, kind)
        result = region_month_agg(spark, sf)
        if kind == "csv":
            files.write_csv(result, path)
            return files.read_csv(spark, path, RESULT_SCHEMA)
        if kind == "json":
            files.write_json(result, path)
            return files.read_json(spark, path, RESULT_SCHEMA)
        files.write_parquet(result, path)
        return files.read_parquet(spark, path, schema=RESULT_SCHEMA)
    return query
