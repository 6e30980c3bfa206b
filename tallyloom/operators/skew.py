"""Skewed keys: how bad is it, and joins that stay balanced.

Preference: broadcast the small side; aggregate both sides before joining when only totals are
wanted; a plain join that adaptive execution may split; salting of the hot keys; salting of
all keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

SALT = "_salt"
SALTS = 16  # fixed value: default number of salts of the uniform salted join


def key_profile(df: DataFrame, key: str, cores: int) -> DataFrame:
    """Rows and share of every key, and the most that splitting the key can gain.

    A job cannot end before the task that holds its largest key, so balancing a key gains at
    most ``share * cores``, and nothing when that is below 1. The total is a scalar subquery
    over the same counts, so the keys are counted once.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("total")).scalar()
    share = F.col("rows") / total
    return counts.select(
        key, "rows", share.alias("share"),
        F.greatest(share * cores, F.lit(1.0)).alias("gain_bound"))


def task_target(df: DataFrame) -> int:
    """Reduce tasks of a shuffle in this session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


PIECES_PER_TASK = 4
WRITTEN_OUT = 32          # hot keys that become an expression; more are broadcast
TRACKED_PER_TASK = 16     # keys a heavy-hitter state tracks for each task they may overload
MOST_TRACKED = 1_000_000  # fixed value: the most that Spark's state can track
KEY_ROWS = 1 << 20        # rows of one key that a plain join sorts in one piece


def heavy_state(df: DataFrame, key: str, tasks: int, by: Sequence[str] = ()) -> DataFrame:
    """Mergeable heavy-hitter state per group of ``by``: ``rows`` and a ``sketch`` of the key.

    Of bounded size whatever the number of keys: no key is shuffled. States of slices may be
    stored and merged later by :func:`heavy_keys`. Null keys join nothing and are not counted.
    The key is a number, a string, a date or a timestamp.
    """
    tracked = min(TRACKED_PER_TASK * tasks, MOST_TRACKED)
    sketch = F.call_function("approx_top_k_accumulate", F.col(key), F.lit(tracked))
    one = [] if by else [F.lit(1).alias("_all")]  # a group, so that empty tasks make no state
    return df.filter(F.col(key).isNotNull()).groupBy(*by, *one).agg(
        F.count(F.lit(1)).alias("rows"), sketch.alias("sketch")).select(*by, "rows", "sketch")


def heavy_keys(states: DataFrame, tasks: int) -> tuple[list, int]:
    """Candidates for hot keys, at most 2 * ``tasks``, and the number of rows, over all states.

    A key with a share above 1/tasks is always among them: a state errs by less than a quarter of
    that share, as it tracks sixteen keys for each task.
    """
    tracked = min(TRACKED_PER_TASK * tasks, MOST_TRACKED)
    merged = F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(tracked))
    return _likely(states.groupBy(F.lit(1)).agg(F.sum("rows").alias("rows"),
                                                merged.alias("sketch")), tasks)


def _likely(state: DataFrame, tasks: int) -> tuple[list, int]:
    likely = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(2 * tasks))
    found = state.select("rows", likely.alias("items")).first()
    return ([r["item"] for r in found["items"]], found["rows"]) if found else ([], 0)


def salt_counts(df: DataFrame, key: str, tasks: int) -> DataFrame:
    """The hot keys, and into how many pieces each should be cut.

    Hot means more rows than a balanced task would get, a share above 1/tasks. Shares add up
    to 1, so there are fewer than ``tasks`` hot keys whatever the size of the data. A key is
    cut into a few pieces per balanced task, because pieces are dealt to tasks by hash.

    One pass keeps bounded state to find the candidates, a second counts these alone, so no
    count of all keys is ever made. The counts run here; the few keys come back as a local table,
    so that every use sees the same ones.
    """
    tasks = min(tasks, MOST_TRACKED // TRACKED_PER_TASK)
    keys = df.select(key)
    likely, total = _likely(heavy_state(keys, key, tasks), tasks)
    counted = (keys.filter(F.col(key).isin(likely)).groupBy(key).count().collect()
               if likely else [])
    hot = [(r[key], math.ceil(r["count"] / total * tasks * PIECES_PER_TASK))
           for r in counted if r["count"] * tasks > total]
    schema = StructType([StructField("_hot_key", df.schema[key].dataType),
                         StructField("_salts", IntegerType())])
    columns = [pa.array(c, f.type) for c, f in zip(zip(*hot) if hot else ((), ()),
                                                   to_arrow_schema(schema))]
    return df.sparkSession.createDataFrame(
        pa.Table.from_arrays(columns, names=schema.names), schema)


def salt(stable: Sequence[str], salts: int | Column) -> Column:
    """Salt 0..salts-1 from columns that identify the row; the same again on a second run."""
    return F.pmod(F.xxhash64(*stable), F.lit(salts) if isinstance(salts, int) else salts
                  ).cast("int")


def replicate(df: DataFrame, salts: int | Column) -> DataFrame:
    """Every row once per salt."""
    last = F.lit(salts - 1) if isinstance(salts, int) else salts - 1
    return df.withColumn(SALT, F.explode(F.sequence(F.lit(0), last)))


def plain_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
               stable: Sequence[str] = ()) -> DataFrame:
    """Sort-merge inner join, one row per matching pair.

    A task sorts all rows of its keys, and adaptive execution, which goes by compressed bytes,
    leaves very many short rows of one key together. Where ``stable`` identifies a row of the big
    side (see :func:`salted_join`), keys of more than ``KEY_ROWS`` rows are sorted in pieces, the
    more of them the more rows; all other keys, and so all of a smaller table, are joined whole.
    """
    fair = big.select(big_key).count() // KEY_ROWS if stable else 0
    if fair > 1:
        return selective_salted_join(big, small, big_key, small_key, stable,
                                     salt_counts(big, big_key, fair))
    return big.join(small.hint("merge"), big[big_key] == small[small_key], "inner")


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                stable: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Join on (key, salt): every key of the big side is cut into ``salts`` pieces.

    ``stable`` must differ between rows of one key, such as a row id or the row's position in
    its file. The small side is replicated ``salts`` times.
    """
    left = big.withColumn(SALT, salt(stable, salts))
    right = replicate(small, salts)
    on = (left[big_key] == right[small_key]) & (left[SALT] == right[SALT])
    return left.join(right.hint("merge"), on, "inner").drop(left[SALT]).drop(right[SALT])


def selective_salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                          stable: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """Like :func:`salted_join`, but only hot keys are cut, each in proportion to its share.

    Only the small side's rows of hot keys are replicated. ``hot`` is the result of
    :func:`salt_counts`, by default for the session's number of reduce tasks; it has fewer
    rows than there are tasks by construction, which bounds its broadcast. A few keys are written
    into the plan instead.
    """
    if hot is None:
        hot = salt_counts(big.select(big_key), big_key, task_target(big))

    few = hot.limit(WRITTEN_OUT + 1).collect()

    def marked(side: DataFrame, key: str) -> DataFrame:
        if len(few) > WRITTEN_OUT:
            joined = side.join(F.broadcast(hot), side[key] == hot["_hot_key"], "left")
            return joined.withColumn("_salts", F.coalesce("_salts", F.lit(1))).drop("_hot_key")
        salts = F.lit(1)
        for r in few:
            salts = F.when(F.col(key) == F.lit(r["_hot_key"]), F.lit(r["_salts"])).otherwise(salts)
        return side.withColumn("_salts", salts)

    pieces = F.col("_salts")
    left = marked(big, big_key).withColumn(SALT, salt(stable, pieces)).drop("_salts")
    right = replicate(marked(small, small_key), pieces).drop("_salts")
    on = (left[big_key] == right[small_key]) & (left[SALT] == right[SALT])
    return left.join(right.hint("merge"), on, "inner").drop(left[SALT]).drop(right[SALT])


def totals(joined: DataFrame, key: str, amount: str, total: str, count: str) -> DataFrame:
    """Sum and row count per key of a joined table.

    Grouping by a struct of the key keeps Spark from reusing the join's partitioning, so
    partial sums are shuffled once more (a few rows per task) and adaptive execution is free
    to split a hot join partition.
    """
    grouped = joined.groupBy(F.struct(F.col(key).alias("key")).alias("_group")).agg(
        F.sum(amount).alias(total), F.count(F.lit(1)).alias(count))
    return grouped.select(F.col("_group.key").alias(key), total, count)


def preaggregated_totals(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                         amount: str, total: str, count: str) -> DataFrame:
    """The same totals without building the joined rows.

    Each side is reduced to one row per key before the join: a key with n rows on the big side
    contributes its amounts n times.
    """
    left = big.groupBy(big_key).agg(F.count(F.lit(1)).alias("_left_n"))
    right = small.groupBy(small_key).agg(F.sum(amount).alias("_right_sum"),
                                         F.count(F.lit(1)).alias("_right_n"))
    return left.join(right, left[big_key] == right[small_key], "inner").select(
        big_key,
        (F.col("_right_sum") * F.col("_left_n")).alias(total),
        (F.col("_left_n") * F.col("_right_n")).alias(count))
