"""Row rules: keep what passes, count what does not."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Inclusive bounds on one expression. A null or NaN value never passes."""

    name: str
    value: Column
    low: float | None = None
    high: float | None = None
    floating: bool = True

    def passes(self) -> Column:
        if self.low is not None and self.high is not None:
            return self.value.between(self.low, self.high)
        if self.high is not None:
            # NaN sorts above every number, so an upper bound already rejects it
            return self.value <= F.lit(self.high)
        if self.low is None:
            raise ValueError(f"rule {self.name!r} has no bound")
        enough = self.value >= F.lit(self.low)
        return enough & ~F.isnan(self.value) if self.floating else enough

    def fails(self) -> Column:
        return ~F.coalesce(self.passes(), F.lit(False))


def clean(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every rule. Simple bounds are pushed into the Parquet scan."""
    return df.filter(reduce(lambda a, b: a & b, (r.passes() for r in rules)))


def account(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: rows in, rows kept, rows rejected by any rule. One pass over the rule columns."""
    any_fails = reduce(lambda a, b: a | b, (r.fails() for r in rules))
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~any_fails).alias("rows_kept"),
        F.count_if(any_fails).alias("rows_rejected"),
    )


def rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the rows that fail it; a row may fail several rules."""
    counts = df.agg(*[F.count_if(r.fails()).alias(r.name) for r in rules])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("rejected")) for r in rules])))
