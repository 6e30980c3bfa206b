"""A stored table of mergeable partial aggregates, one slice per source part.

New data adds its own slice; older data is never read again. Writing a slice a second time
replaces it, so a job that failed half way can simply be run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyloom.operators.groups import Measures, finish, merge, partial
from tallyloom.sources.files import write_parquet


def slices(df: DataFrame, part: str, by: Sequence[str], m: Measures) -> DataFrame:
    """Partial aggregates per (source part, group)."""
    return partial(df, [part, *by], m)


def store_slices(partials: DataFrame, path: str, part: str) -> None:
    """Add slices to the stored rollup, replacing the parts that ``partials`` contains.

    Rows of a part are brought together before writing, so a part is one file unless it is
    large; adaptive execution splits those.
    """
    write_parquet(partials.hint("rebalance", part), path, mode="overwrite",
                  partition_by=[part])


def load(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored rollup; a filter on the part column prunes directories.

    ``schema`` is that of the slices, so no footer is opened to infer one.
    """
    return spark.read.schema(schema).parquet(path)


def compact(partials: DataFrame, by: Sequence[str], m: Measures) -> DataFrame:
    """Slices merged into one state row per group, still mergeable."""
    return merge(partials, by, m)


def answer(partials: DataFrame, by: Sequence[str], m: Measures) -> DataFrame:
    """Final measures per group over all slices."""
    return finish(partials, by, m)
