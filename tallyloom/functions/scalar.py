"""Column helpers built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clip(value: Column, low: float, high: float) -> Column:
    """The value, held between two bounds."""
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def cents(value: Column) -> Column:
    """Round half up to two decimals with plain IEEE steps, so that every engine agrees."""
    return F.floor(value * 100 + 0.5) / 100


def settled_mean(mean: Column, count: Column, digits: int) -> Column:
    """A mean whose sum is rounded, not the mean itself.

    The sum of values with few decimals is never near a rounding edge, while their mean often
    is exactly on one, where the order of a float sum would decide.
    """
    return F.round(mean * count, digits) / count


def hour_of_day(epoch_s: Column) -> Column:
    """UTC hour 0..23 (bigint) of an epoch-second column; also right before 1970."""
    return F.floor(F.pmod(epoch_s, F.lit(86_400)) / 3600)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Epoch seconds (bigint) of a column that holds seconds, a timestamp or a date.

    Does not depend on the session time zone: a timestamp without zone is read as UTC.
    """
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(col)
    if isinstance(kind, T.TimestampNTZType):
        day = F.unix_date(F.to_date(col)).cast("bigint") * 86_400
        return day + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("bigint") * 86_400
    if isinstance(kind, T.IntegralType):
        return col.cast("bigint")
    raise TypeError(f"column {name!r} of type {kind.simpleString()} is not a point in time")


def weighted_choice(u: Column, weights: dict) -> Column:
    """Pick a key of ``weights`` by its cumulative weight from a uniform in (0, 1)."""
    *head, last = weights
    picked, edge = None, 0.0
    for value in head:
        edge += weights[value]
        bound = u < F.lit(round(edge, 10))
        picked = (F.when(bound, F.lit(value)) if picked is None
                  else picked.when(bound, F.lit(value)))
    return F.lit(last) if picked is None else picked.otherwise(F.lit(last))


def uniform_int(u: Column, low: int, count: int, kind: str = "int") -> Column:
    """Uniform integer in ``low .. low + count - 1``."""
    return (F.floor(u * count) + low).cast(kind)
