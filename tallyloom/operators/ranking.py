"""Top entries, per group and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(totals: DataFrame, group: Sequence[str], score: str, tie_break: str,
                  n: int) -> DataFrame:
    """The ``n`` rows of each group with the highest score, with ``rank`` 1..n.

    Equal scores are ranked by the tie-break, ascending. Spark cuts every partition of the
    input to n rows per group before the shuffle (WindowGroupLimit).
    """
    order = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(tie_break).asc())
    return totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def top_k(df: DataFrame, score: str, tie_break: str, k: int) -> DataFrame:
    """The ``k`` rows with the highest score overall; ties by the tie-break, ascending."""
    return df.orderBy(F.col(score).desc(), F.col(tie_break).asc()).limit(k)
