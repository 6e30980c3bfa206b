"""Grouped measures that can be computed directly or in mergeable parts.

The state of a group holds only what merges without loss: sums, counts, maxima and the distinct
values. It is long: every distinct value is a row of its own, so no row grows with a group, and
merging is ordinary aggregation. Columns of many whole numbers can be kept as bitmaps instead, one
row for each 32,768 neighbouring numbers. Means and distinct counts are rebuilt from the state at
the end, so merging is independent of order and grouping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.sizing import BROADCAST_BYTES, fits_broadcast
from tallyloom.operators.enrich import attach


VALUE_OF = "_value_of"      # the measure whose distinct value a state row holds
VALUE_ROWS = "_value_rows"  # rows that had this value
BUCKET, BITS = "_bucket", "_bits"


@dataclass(frozen=True)
class Measures:
    """Output name -> input column, per kind of measure. ``"*"`` counts rows.

    ``distincts`` and ``bitmaps`` both count distinct values. The state of the first has a row for
    each value, that of the second, for whole numbers only, one for each 32,768 neighbouring
    numbers: smaller where the numbers lie close together, larger where they are scattered.
    """

    counts: Mapping[str, str] = field(default_factory=dict)
    sums: Mapping[str, str] = field(default_factory=dict)
    means: Mapping[str, str] = field(default_factory=dict)
    maxes: Mapping[str, str] = field(default_factory=dict)
    distincts: Mapping[str, str] = field(default_factory=dict)
    bitmaps: Mapping[str, str] = field(default_factory=dict)

    def sum_state(self, name: str) -> str:
        return f"{name}_sum"

    def count_state(self, name: str) -> str:
        return f"{name}_n"

    def value_state(self, name: str) -> str:
        return f"{name}_value"

    def added(self) -> list[str]:
        """State columns that merge by addition."""
        return [*self.counts, *self.sums,
                *(f(n) for n in self.means for f in (self.sum_state, self.count_state)),
                *([VALUE_ROWS] if self.distincts else [])]

    def tagged(self) -> bool:
        """Whether state rows must say which measure they belong to."""
        return len(self.distincts) > 1 or bool(self.bitmaps)

    def value_keys(self) -> list[str]:
        """State columns that, with the group, tell rows of distinct values apart."""
        return [*([VALUE_OF] if self.tagged() else []), *map(self.value_state, self.distincts)]


def _count(column: str, where: Column | None = None) -> Column:
    value = F.lit(1) if column == "*" else F.col(column)
    return F.count(value if where is None else F.when(where, value))


def aggregate(df: DataFrame, by: Sequence[str], m: Measures) -> DataFrame:
    """All measures per group in one aggregation over the rows."""
    return df.groupBy(*by).agg(
        *[_count(c).alias(n) for n, c in m.counts.items()],
        *[F.sum(c).alias(n) for n, c in m.sums.items()],
        *[F.avg(c).alias(n) for n, c in m.means.items()],
        *[F.max(c).alias(n) for n, c in m.maxes.items()],
        *[F.countDistinct(c).alias(n) for n, c in {**m.distincts, **m.bitmaps}.items()],
    )


def partial(df: DataFrame, by: Sequence[str], m: Measures) -> DataFrame:
    """Mergeable state: a row per group and distinct value, by hash aggregation alone.

    The rows of the first distinct column also carry the sums, counts and maxima, so with one such
    column a row is read once. Each further one passes the rows once more through the map side of
    the same aggregation; bitmaps take a second aggregation.
    """
    state = _value_rows(df, by, m)
    return state.unionByName(_bitmap_rows(df, by, m), allowMissingColumns=True) if m.bitmaps else state


def _value_rows(df: DataFrame, by: Sequence[str], m: Measures) -> DataFrame:
    first, *others = m.distincts or [None]

    def tag(name: str | None) -> Column:
        return F.struct(F.lit(name).cast("string").alias(VALUE_OF), *[
            (F.col(c) if n == name else F.lit(None).cast(df.schema[c].dataType))
            .alias(m.value_state(n)) for n, c in m.distincts.items()])

    if others:
        rows = df.withColumn("_tag", F.explode(F.array(*map(tag, m.distincts))))
        owner = F.col(f"_tag.{VALUE_OF}") == first
    else:
        rows, owner = df.withColumn("_tag", tag(first)), None
    for key in m.value_keys():
        rows = rows.withColumn(key, F.col(f"_tag.{key}"))
    held = reduce(lambda a, b: a | b, [F.col(m.value_state(n)).isNotNull() for n in m.distincts],
                  F.lit(False))
    if others:
        rows = rows.filter(owner | held)

    def mine(column: str) -> Column:
        return F.col(column) if owner is None else F.when(owner, F.col(column))

    return rows.groupBy(*by, *m.value_keys()).agg(
        *[_count(c, owner).alias(n) for n, c in m.counts.items()],
        *[F.sum(mine(c)).alias(n) for n, c in m.sums.items()],
        *[F.sum(mine(c)).alias(m.sum_state(n)) for n, c in m.means.items()],
        *[_count(c, owner).alias(m.count_state(n)) for n, c in m.means.items()],
        *([F.count_if(held).alias(VALUE_ROWS)] if m.distincts else []),
        *[F.max(mine(c)).alias(n) for n, c in m.maxes.items()],
    )


def _bitmap_rows(df: DataFrame, by: Sequence[str], m: Measures) -> DataFrame:
    tags = [F.struct(F.lit(n).alias(VALUE_OF), F.col(c).cast("bigint").alias("_number"))
            for n, c in m.bitmaps.items()]
    numbers = (df.select(*by, F.explode(F.array(*tags)).alias("_tag"))
               .select(*by, "_tag.*").filter("_number IS NOT NULL"))
    return numbers.groupBy(*by, VALUE_OF, F.bitmap_bucket_number("_number").alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias(BITS))


def merge(state: DataFrame, by: Sequence[str], m: Measures) -> DataFrame:
    """State rows combined into coarser (or the same) groups; the result is state again."""
    rows = state.filter(F.col(BUCKET).isNull()) if m.bitmaps else state
    merged = rows.groupBy(*by, *m.value_keys()).agg(
        *[F.sum(n).alias(n) for n in m.added()], *[F.max(n).alias(n) for n in m.maxes])
    if not m.bitmaps:
        return merged
    bits = state.filter(F.col(BUCKET).isNotNull()).groupBy(*by, VALUE_OF, BUCKET).agg(
        F.bitmap_or_agg(BITS).alias(BITS))
    return merged.unionByName(bits, allowMissingColumns=True)


def frequencies(state: DataFrame, by: Sequence[str], m: Measures, name: str) -> DataFrame:
    """The distinct values of one measure in each group, as ``value``, and the rows that have it."""
    value = F.col(m.value_state(name))
    own = F.col(VALUE_OF) == name if m.tagged() else F.lit(True)
    return (state.filter(own & value.isNotNull())
            .groupBy(*by, value.alias("value")).agg(F.sum(VALUE_ROWS).alias("rows")))


def finish(state: DataFrame, by: Sequence[str], m: Measures) -> DataFrame:
    """The measures of :func:`aggregate`, rebuilt from state.

    A mean is merged sum over merged count. State is first merged to one row per distinct value,
    so counting values is counting rows, with combining before the shuffle: no task holds the
    values of a group, nor all parts of it.
    """
    rows = merge(state, by, m) if m.distincts or m.bitmaps else state
    bits = {n: F.sum(F.when(F.col(VALUE_OF) == n, F.bitmap_count(BITS))) for n in m.bitmaps}
    return rows.groupBy(*by).agg(
        *[F.sum(n).alias(n) for n in (*m.counts, *m.sums)],
        *[F.try_divide(F.sum(m.sum_state(n)), F.sum(m.count_state(n))).alias(n) for n in m.means],
        *[F.max(n).alias(n) for n in m.maxes],
        *[F.count(m.value_state(n)).alias(n) for n in m.distincts],
        *[F.coalesce(b, F.lit(0)).alias(n) for n, b in bits.items()],
    )


def partial_by_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                         fact_by: Sequence[str], dim_by: Sequence[str], m: Measures, *,
                         broadcast: bool | None = None,
                         limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mergeable state per (dimension columns, fact columns).

    A dimension that fits is broadcast and the joined rows are reduced. A larger one never
    meets the raw rows: these are first reduced to one state row per key and fact group, so a
    key holding a third of the table costs the join no more than any other key.
    """
    by = [*dim_by, *fact_by]
    if broadcast is None:
        broadcast = fits_broadcast(dim, limit)
    if broadcast:
        return partial(attach(fact, dim, fact_key, dim_key, broadcast=True), by, m)
    state = partial(fact, [fact_key, *fact_by], m)
    return merge(attach(state, dim, fact_key, dim_key, broadcast=False), by, m)


def aggregate_by_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                           fact_by: Sequence[str], dim_by: Sequence[str], m: Measures, *,
                           broadcast: bool | None = None,
                           limit: int = BROADCAST_BYTES) -> DataFrame:
    """Measures per (dimension columns, fact columns); joins as in
    :func:`partial_by_dimension`."""
    by = [*dim_by, *fact_by]
    if broadcast is None:
        broadcast = fits_broadcast(dim, limit)
    if broadcast:
        return aggregate(attach(fact, dim, fact_key, dim_key, broadcast=True), by, m)
    state = partial(fact, [fact_key, *fact_by], m)
    return finish(attach(state, dim, fact_key, dim_key, broadcast=False), by, m)
