"""Compare result tables: integers and text exactly, floats within a tolerance."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: relative and absolute tolerance of float columns.
TOLERANCE = 1e-9

REPORT = T.StructType([
    T.StructField("baseline", T.StringType()),
    T.StructField("other", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("compared", T.LongType()),
    T.StructField("mismatches", T.LongType()),
    T.StructField("worst_rel_error", T.DoubleType()),
    T.StructField("left_only", T.LongType()),
    T.StructField("right_only", T.LongType()),
    T.StructField("duplicate_keys", T.LongType()),
])


class TablesDiffer(AssertionError):
    """Raised by :func:`require_same`."""


def _is_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def _equal(x: str, y: str, floating: bool, rtol: float, atol: float, null_equal: bool,
           nan_equal: bool) -> str:
    """SQL condition that two values count as equal; never null."""
    if floating:
        nan = "isnan({0}) AND isnan({1})".format(x, y) if nan_equal else "false"
        same = (f"CASE WHEN isnan({x}) OR isnan({y}) THEN {nan} "
                f"WHEN {x} = {y} THEN true "
                f"ELSE NOT isnan({x} - {y}) AND abs({x} - {y}) <= "
                f"{atol!r}D + {rtol!r}D * abs({y}) AND abs({y}) < double('infinity') END")
    else:
        same = f"{x} = {y}"
    null = f"{x} IS NULL AND {y} IS NULL" if null_equal else "false"
    return f"CASE WHEN {x} IS NULL OR {y} IS NULL THEN {null} ELSE {same} END"


def _relative_error(x: str, y: str) -> str:
    """|x - y| over |y|, or over 1 where y is 0; null where either is null or NaN."""
    return (f"CASE WHEN isnan({x}) OR isnan({y}) THEN NULL WHEN {x} = {y} THEN 0D "
            f"ELSE abs({x} - {y}) / CASE WHEN {y} = 0 THEN 1D ELSE abs({y}) END END")


def _text(value: str) -> str:
    """A SQL text literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _schema_problem(left: DataFrame, right: DataFrame) -> str | None:
    if left.columns != right.columns:
        return f"columns {left.columns} != {right.columns}"
    for a, b in zip(left.schema.fields, right.schema.fields):
        if a.dataType != b.dataType and not (_is_float(a.dataType) and _is_float(b.dataType)):
            return (f"column {a.name}: {a.dataType.simpleString()} != "
                    f"{b.dataType.simpleString()}")
    return None


def diff_gate(tables: Mapping[str, DataFrame], keys: Sequence[str], *,
              rtol: float = TOLERANCE, atol: float = TOLERANCE,
              null_equal: bool = True, nan_equal: bool = False) -> DataFrame:
    """Compare the first table with each other one, in the ``REPORT`` schema.

    One row per other table and value column. All tables are tagged, unioned and grouped by
    key once: each is read once, nothing is joined, and a key that occurs many times is
    combined before the shuffle instead of producing pairs. Keys that occur more than once in
    a table are counted in ``duplicate_keys`` and not compared.

    Where columns or types differ, that table gets a single row of kind ``schema`` whose
    ``column`` tells the difference.
    """
    names = list(tables)
    base = tables[names[0]]
    spark = base.sparkSession
    problems = {n: _schema_problem(base, tables[n]) for n in names[1:]}
    reports = [
        spark.createDataFrame([(names[0], n, p, "schema", *[None] * 6)], REPORT)
        for n, p in problems.items() if p]
    good = [n for n in names[1:] if not problems[n]]
    if good:
        reports.append(_diff(names[0], {n: tables[n] for n in [names[0], *good]}, keys,
                             rtol, atol, null_equal, nan_equal))
    return reduce(DataFrame.unionAll, reports)


def _diff(baseline: str, tables: Mapping[str, DataFrame], keys: Sequence[str], rtol: float,
          atol: float, null_equal: bool, nan_equal: bool) -> DataFrame:
    names = list(tables)
    fields = [f for f in tables[baseline].schema.fields if f.name not in keys]
    tagged = reduce(DataFrame.unionByName, [
        df.withColumn("_table", F.lit(i)) for i, df in enumerate(tables.values())])

    paired = tagged.groupBy(*keys).agg(
        *[F.expr(f"count_if(_table = {i}) AS n{i}") for i in range(len(names))],
        *[F.expr(f"max(CASE WHEN _table = {i} THEN `{f.name}` END) AS v{i}_{j}")
          for i in range(len(names)) for j, f in enumerate(fields)])

    # the expressions are SQL text: hundreds of them are built, each in one call to the JVM
    aggregates, rows = [], []
    for i, name in enumerate(names[1:], start=1):
        aggregates += [
            f"count_if(n0 = 1 AND n{i} = 1) AS compared{i}",
            f"count_if(n0 > 0 AND n{i} = 0) AS left_only{i}",
            f"count_if(n0 = 0 AND n{i} > 0) AS right_only{i}",
            f"count_if(n0 > 1 OR n{i} > 1) AS duplicates{i}",
        ]
        columns = [] if fields else [("CAST(NULL AS STRING)", "'keys'", "0L")]
        for j, f in enumerate(fields):
            x, y, floating = f"v0_{j}", f"v{i}_{j}", _is_float(f.dataType)
            same = _equal(x, y, floating, rtol, atol, null_equal, nan_equal)
            aggregates.append(f"count_if(n0 = 1 AND n{i} = 1 AND NOT {same}) AS bad{i}_{j}")
            if floating:
                aggregates.append(f"max(CASE WHEN n0 = 1 AND n{i} = 1 THEN "
                                  f"{_relative_error(x, y)} END) AS worst{i}_{j}")
            columns.append((_text(f.name), "'float'" if floating else "'exact'",
                            f"bad{i}_{j}"))
        for column, kind, bad in columns:
            worst = (f"CAST({bad.replace('bad', 'worst')} AS DOUBLE)" if kind == "'float'"
                     else "CAST(NULL AS DOUBLE)")
            rows.append(
                f"named_struct('baseline', {_text(baseline)}, 'other', {_text(name)}, "
                f"'column', {column}, 'kind', {kind}, 'compared', compared{i}, "
                f"'mismatches', {bad}, 'worst_rel_error', {worst}, "
                f"'left_only', left_only{i}, 'right_only', right_only{i}, "
                f"'duplicate_keys', duplicates{i})")
    return paired.agg(*map(F.expr, aggregates)).select(
        F.expr(f"inline(array({', '.join(rows)}))"))


def diff_tables(left: DataFrame, right: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Compare two tables; see :func:`diff_gate`."""
    return diff_gate({"left": left, "right": right}, keys, **options)


def diff_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, for tables without a key.

    ``surplus`` is copies on the left minus copies on the right. Exact values only.
    """
    both = left.withColumn("_sign", F.lit(1)).unionByName(
        right.withColumn("_sign", F.lit(-1)))
    return (both.groupBy(*left.columns).agg(F.sum("_sign").alias("surplus"))
            .filter(F.col("surplus") != 0))


def differences(report: DataFrame) -> DataFrame:
    """The rows of a report that say two tables are not the same."""
    counts = ("mismatches", "left_only", "right_only", "duplicate_keys")
    return report.filter(reduce(
        lambda a, b: a | b, [F.col(c) > 0 for c in counts], F.col("kind") == "schema"))


def require_same(report: DataFrame) -> None:
    """Raise when a report shows any difference; at most one row per column is fetched."""
    found = differences(report).collect()
    if found:
        raise TablesDiffer("\n".join(
            f"[{r.baseline} vs {r.other}] {r.column} ({r.kind}): mismatches={r.mismatches} "
            f"worst={r.worst_rel_error} left_only={r.left_only} right_only={r.right_only} "
            f"duplicate_keys={r.duplicate_keys}" for r in found))


def repartition_invariance(query: Callable[[DataFrame], DataFrame], fact: DataFrame,
                           partition_counts: Sequence[int], keys: Sequence[str],
                           **options) -> DataFrame:
    """Run one query over several partitionings of its input and compare the answers.

    Partial results are then combined in another order, as they are when a lost executor's
    tasks run again elsewhere: integers must stay equal and floats within the tolerance.
    """
    tables = {"as stored": query(fact)}
    for n in partition_counts:
        tables[f"{n} partitions"] = query(fact.repartition(n))
    return diff_gate(tables, keys, **options)
