"""Exact deduplication by a tree-merge of digest runs, in DataFrame operations only.

Every row belongs to one of 256 runs, by a hash of its id. A run is first reduced to one row per
digest. Then the runs exchange in binomial rounds: in each round a group of sixteen runs swaps
rows so that every member holds one sixteenth of the group's digests, and merges the sixteen
sorted inputs into one. After two rounds each of the 256 runs holds all there is about its share
of the digests. The answers go back down the same tree. However many copies a text has, a run
gets at most sixteen rows of it per round, and sends as many back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import col, stored

RUN_BITS = 8
ROUND_BITS = 4


def _merged(rows: DataFrame, owner: Column, best) -> DataFrame:
    """One row per owner and digest: count, identifier that stays, range of the second digest."""
    return rows.groupBy(owner.alias("owner"), "digest").agg(
        best("keep").alias("keep"), F.sum("size").alias("size"),
        F.min("low").alias("low"), F.max("high").alias("high"))


def _owner(run: str, rounds: int) -> Column:
    """The run after so many rounds: its low bits are replaced by those of the digest."""
    low = (1 << (ROUND_BITS * rounds)) - 1
    share = F.conv(F.hex(F.substring("digest", 1, 1)), 16, 10).cast("int")
    return F.col(run).bitwiseAND(F.lit(255 - low)).bitwiseOR(share.bitwiseAND(F.lit(low)))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
           largest: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null is the empty text. The smallest (or largest) id of a
    group stays. Groups are formed by SHA-256 and verified at every level by length and a second,
    independent hash: texts that differ in those under one digest are an error, never merged.
    Rows that repeat both id and text are one document: they share its verdict and each count in
    group_size. A null id never stays before another; a group of null ids keeps null. An empty
    table gives an empty result. Other columns are not looked at.
    """
    best = F.max if largest else F.min
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    leaves = stored(docs.select(
        col(doc_id).cast("long").alias("doc_id"),
        F.pmod(F.xxhash64(col(doc_id)), F.lit(1 << RUN_BITS)).cast("int").alias("run"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.struct(F.octet_length(whole).alias("n"), F.xxhash64(whole).alias("h")).alias("second"),
    ), "digests")
    level = stored(_merged(leaves.select(
        "run", "digest", F.col("doc_id").alias("keep"), F.lit(1).cast("long").alias("size"),
        F.col("second").alias("low"), F.col("second").alias("high")), F.col("run"), best), "runs")
    levels = [level]
    for rounds in range(1, RUN_BITS // ROUND_BITS + 1):
        level = _merged(level, _owner("owner", rounds), best)
        levels.append(level)
    same = F.col("low") == F.col("high")
    answer = levels.pop().select("owner", "digest", "keep", F.when(
        same, F.col("size")).otherwise(F.raise_error(F.lit("one digest, different texts"))
                                       .cast("long")).alias("size"))
    for rounds in range(RUN_BITS // ROUND_BITS, 0, -1):
        below = levels.pop().select(F.col("owner").alias("run"), "digest",
                                    _owner("owner", rounds).alias("owner"))
        answer = below.join(answer, ["owner", "digest"]).select(
            F.col("run").alias("owner"), "digest", "keep", "size")
    answer = answer.withColumnRenamed("owner", "run")
    return leaves.join(answer, ["run", "digest"]).select(
        "doc_id", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
