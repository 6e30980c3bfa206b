"""Summaries of repeated measurements, as Spark jobs over a table of runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.files import cut_lineage

def successful(runs: DataFrame, outcome: str, ok: str = "ok") -> DataFrame:
    """Runs that ended well."""
    return runs.filter(F.col(outcome) == ok)


def _measured(runs: DataFrame, value: str) -> DataFrame:
    """Rows whose value is a measurement: not null, not NaN."""
    return runs.withColumn(value, F.col(value).cast("double")).filter(
        F.col(value).isNotNull() & ~F.isnan(value))


def _without_first(runs: DataFrame, by: Sequence[str], repetition: Sequence[str]) -> DataFrame:
    first = runs.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(
        F.min(F.struct(*repetition)).alias("_first"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_first.{c}"))
                                       for c in repetition])
    return (runs.join(first, [runs[c].eqNullSafe(first[f"_by_{c}"]) for c in by]).filter(~same)
            .select(*runs.columns))


def _statistics(valid: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Number, exact median, minimum and maximum of the values of each group.

    No task ever sorts a whole group. Distinct values are counted, and the counts dealt by ranges
    of (group, value), so that a large group is spread over many tasks. The totals of these ranges
    say in which of them the middle ranks lie, and only those are ranked. That takes the same
    passes for any values and any size. The dealt counts are stored, which runs a job.
    """
    cells = valid.groupBy(*by, F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    dealt = cut_lineage(cells.repartitionByRange(*by, "_value")
                        .withColumn("_part", F.spark_partition_id()))
    whole = Window.partitionBy(*by)
    ranges = dealt.groupBy(*by, "_part").agg(
        F.sum("_n").alias("_rows"), F.min("_value").alias("_lo"), F.max("_value").alias("_hi"))
    ranges = ranges.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_at"), "_rows",
        (F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(whole).alias("_total"),
        F.min("_lo").over(whole).alias("_least"), F.max("_hi").over(whole).alias("_most"))
    lower, upper = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1
    middle = ranges.filter((F.col("_before") < upper) & (F.col("_before") + F.col("_rows") >= lower))
    ranked = dealt.join(middle, [dealt[c].eqNullSafe(middle[f"_by_{c}"]) for c in by]
                        + [dealt["_part"] == middle["_at"]])
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*by, "_part").orderBy("_value"))
    ranked = ranked.withColumn("_upto", upto)

    def at(rank) -> F.Column:
        held = (F.col("_upto") - F.col("_n") < rank) & (rank <= F.col("_upto"))
        return F.max(F.when(held, F.col("_value")))

    summary = ranked.groupBy(*by).agg(
        F.max("_total").alias("runs"), at(lower).alias("_low"), at(upper).alias("_high"),
        F.min("_least").alias("min"), F.max("_most").alias("max"))
    # halves cannot overflow; equal ones need no halves, which would underflow
    median = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(
        F.col("_low") * 0.5 + F.col("_high") * 0.5)
    return summary.select(*by, "runs", median.alias("median"), "min", "max")


def summarise(runs: DataFrame, by: Sequence[str], repetition: Sequence[str], value: str, *,
              warmups: bool = True) -> DataFrame:
    """Runs, exact median, minimum and maximum per configuration, and runs per unit of value.

    ``by`` names the configuration. The first repetition of each configuration, in the order
    of ``repetition`` (which must be unique within it), is a warm-up and left out. Null and
    NaN values are not measurements; infinite ones are.
    """
    valid = _measured(runs, value)
    if warmups:
        valid = _without_first(valid, by, repetition)
    return _statistics(valid, by, value).withColumn(
        "per_unit", F.try_divide(F.col("runs"), F.col("median")))


def summarise_values(runs: DataFrame, by: Sequence[str], repetition: Sequence[str],
                     values: Sequence[str], *, warmups: bool = True) -> DataFrame:
    """Several values of the same runs side by side: ``<value>_median``, ``_min`` and ``_max``.

    ``runs`` counts the runs of the configuration after the warm-up. The values are ranked in one
    go, as (configuration, name of the value). A null or NaN is no measurement of that value; a
    configuration without any has nulls there.
    """
    kept = _without_first(runs, by, repetition) if warmups else runs
    named = [F.struct(F.lit(v).alias("_measure"), F.col(v).cast("double").alias("_measured"))
             for v in values]
    long = kept.select(*by, F.explode(F.array(*named)).alias("_one")).select(*by, "_one.*")
    found = _statistics(_measured(long, "_measured"), [*by, "_measure"], "_measured")
    counts = kept.groupBy(*by).agg(F.count(F.lit(1)).alias("runs")).withColumn(
        "_measure", F.lit(None).cast("string"))
    wide = [F.max(F.when(F.col("_measure") == v, F.col(s))).alias(f"{v}_{s}")
            for v in values for s in ("median", "min", "max")]
    return (found.drop("runs").unionByName(counts, allowMissingColumns=True)
            .groupBy(*by).agg(F.max("runs").alias("runs"), *wide))


def speedup(summary: DataFrame, series: Sequence[str], level: str) -> DataFrame:
    """How much faster each level is than the first level of its series.

    The bounds compare the same base with the slowest and the fastest run of the level. Runs
    on the summary, which has one row per configuration.
    """
    by_level = Window.partitionBy(*series).orderBy(level)
    base = F.first("median").over(by_level)
    return summary.withColumn("_base", base).select(
        *series, level,
        F.try_divide(F.col("_base"), F.col("median")).alias("speedup"),
        F.try_divide(F.col("_base"), F.col("max")).alias("speedup_low"),
        F.try_divide(F.col("_base"), F.col("min")).alias("speedup_high"))


def throughput(summary: DataFrame, series: Sequence[str], level: str) -> DataFrame:
    """Parallel efficiency and aggregate throughput against the first level.

    ``level`` counts the workers. Efficiency is speedup over workers; throughput is workers
    times the best run of the first level over the best run of this one.
    """
    by_level = Window.partitionBy(*series).orderBy(level)
    return (summary.withColumn("_base", F.first("median").over(by_level))
            .withColumn("_best", F.first("min").over(by_level))
            .select(
                *series, level,
                F.try_divide(F.try_divide(F.col("_base"), F.col("median")),
                             F.col(level)).alias("efficiency"),
                F.try_divide(F.col("_best") * F.col(level), F.col("min"))
                .alias("throughput_x")))


def best(runs: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The fastest repetition of every configuration."""
    return runs.groupBy(*by).agg(F.min(value).alias("best"))


def cost_ratio(rates: DataFrame, series: str, level: str, reference: str, rows: str,
               seconds: str, cores: str) -> DataFrame:
    """Rows per second and core, and how often the reference series beats each other one.

    Compared level by level, where the reference has at most one row; a level that it lacks stays,
    with a null ratio.
    """
    per_core = rates.withColumn("rows_per_s_core", F.try_divide(
        F.col(rows), F.col(seconds) * F.col(cores)))
    base = F.max(F.when(F.col(series) == reference, F.col("rows_per_s_core"))).over(
        Window.partitionBy(level))
    return per_core.withColumn("_reference", base).select(
        series, level, "rows_per_s_core",
        F.try_divide(F.col("_reference"), F.col("rows_per_s_core")).alias("cost_ratio"))


def largest_level(runs: DataFrame, series: str, level: str) -> DataFrame:
    """Per series its rows and the level with most of them (the lower level on a tie)."""
    sizes = runs.groupBy(series, level).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.groupBy(series).agg(
        F.sum("_n").alias("rows"),
        F.max_by(level, F.struct(F.col("_n"), -F.col(level))).alias("largest_level"))
