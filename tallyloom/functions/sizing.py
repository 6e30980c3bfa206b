"""How large is a table that might be broadcast?"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024


def as_bytes(setting: str) -> int:
    """Bytes of a size setting such as ``134217728b`` or ``128m``."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", setting.strip().lower()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the sources below ``df``, from the optimizer's statistics; runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _is_flat(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def measured_bytes(df: DataFrame) -> int | None:
    """Exact in-memory size bound of ``df``: one distributed aggregate, one row to the driver.

    None when a nested column makes the size per row unknown.
    """
    if not all(_is_flat(f.dataType) for f in df.schema.fields):
        return None
    varying = [F.coalesce(F.sum(F.octet_length(f.name).cast("bigint")), F.lit(0))
               for f in df.schema.fields
               if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    text = sum(varying[1:], varying[0]) if varying else F.lit(0).cast("bigint")
    rows, text_bytes = df.agg(F.count(F.lit(1)), text).first()
    # an in-memory row takes 8 bytes per field, the null bits, and its slot in the hash table
    return rows * (8 * len(df.columns) + 32) + text_bytes


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES, *,
                   check_sources: bool = True) -> bool:
    """True only when the size is proven to be within ``limit``.

    The free look at the source sizes comes first, so that the measuring job only ever runs
    over sources that are small themselves. ``check_sources=False`` skips it for a table that
    was already cut from its lineage, whose sources are unknown.
    """
    if check_sources and scanned_bytes(df) > limit:
        return False
    size = measured_bytes(df)
    return size is not None and size <= limit
