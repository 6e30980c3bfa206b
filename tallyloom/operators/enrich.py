"""Attach a dimension to a fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.sizing import BROADCAST_BYTES, fits_broadcast


def attach(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, *,
           broadcast: bool | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join that keeps both key columns; a null or unmatched key drops out.

    The dimension is broadcast only when its measured size is within ``limit``; pass
    ``broadcast`` to reuse an earlier answer. Beyond the limit it is a sort-merge join, whose
    hot partitions adaptive execution splits.
    """
    if broadcast is None:
        broadcast = fits_broadcast(dim, limit)
    side = F.broadcast(dim) if broadcast else dim.hint("merge")
    return fact.join(side, fact[fact_key] == dim[dim_key], "inner")
