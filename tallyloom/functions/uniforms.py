"""Uniform numbers that are a function of the row id.

A row gets the same numbers whichever task computes it, so a lost executor or another
partitioning changes nothing. Only 64-bit integer arithmetic is used, no text and no digest:
it stays in generated code, cannot overflow, and any SQL engine can repeat it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 32-bit mask, odd multiplier of the mixing step, step between seeds.
MASK = 0xFFFFFFFF
MULTIPLIER = 73_244_475
SEED_STEP = 0x9E3779B9


def seed_words(seed: int) -> tuple[int, int]:
    return SEED_STEP * (2 * seed + 1) & MASK, SEED_STEP * (2 * seed + 2) & MASK


def _fold(x: str, shift: int) -> str:
    return f"(shiftright({x}, {shift}) ^ {x})"


def _mix(x: str, shift: int) -> str:
    return f"(({_fold(x, shift)} * {MULTIPLIER}L) & {MASK}L)"


@dataclass(frozen=True)
class Uniforms:
    """Numbered streams of uniforms in (0, 1) for one id column.

    Two well-mixed 32-bit words a and b are computed once per row; stream k mixes a + (k+1) b.
    """

    id_column: str
    seed: int = 0

    def prepared(self, ids: DataFrame) -> DataFrame:
        """The ids with the two words that every stream starts from."""
        first, second = seed_words(self.seed)
        row = f"CAST(`{self.id_column}` AS BIGINT)"
        high = f"(shiftright({row}, 32) & {MASK}L)"
        return (ids.withColumn("_s", F.expr(_mix(f"(({row} & {MASK}L) ^ {first}L)", 16)))
                .withColumn("_a", F.expr(_mix("_s", 15)))
                .withColumn("_t", F.expr(f"({_fold('_a', 16)} ^ {high} ^ {second}L)"))
                .withColumn("_b", F.expr(_mix("_t", 16))))

    def stream(self, number: int) -> Column:
        start = f"((_a + _b * {number + 1}L) & {MASK}L)"
        word = _fold(_mix(_mix(start, 16), 15), 16)
        return F.expr(f"(CAST({word} AS DOUBLE) + 0.5D) / {float(2 ** 32)!r}D")


def normal_pair(u: Column, v: Column) -> tuple[Column, Column]:
    """Two independent standard normals from two uniforms (Box and Muller, 1958)."""
    radius = F.sqrt(F.log(u) * -2.0)
    angle = v * (2.0 * math.pi)
    return radius * F.cos(angle), radius * F.sin(angle)
