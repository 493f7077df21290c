"""First and largest rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "_rank") -> DataFrame:
    """The first ``k`` rows of each group, numbered from 1 in ``rank``.

    Spark trims each task to k rows per group before the shuffle, so a group
    that holds most of the table still sends only k rows per task.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col(rank) <= k)


def largest_rows(
    df: DataFrame, group: str, value: str, ties: Sequence[Column], k: int, spread: Sequence[str], rank: str = "rank"
) -> DataFrame:
    """The ``k`` rows with the largest value in each of a few groups.

    The maxima of many slots of a group (by a hash of ``spread``) belong to
    different rows, so their k-th largest bounds the group's k-th largest value
    from below. Rows under that bound are dropped before anything is sorted.
    """
    slot = F.pmod(F.xxhash64(*spread), F.lit(max(64, 16 * k))).alias("_slot")
    maxima = df.groupBy(group, slot).agg(F.max(value).alias("_bound"))
    bounds = first_rows(maxima, [group], [F.desc("_bound")], k).where(F.col("_rank") == k).drop("_rank", "_slot")
    near = df.join(bounds, group, "left").where(F.col("_bound").isNull() | (F.col(value) >= F.col("_bound")))
    return first_rows(near.drop("_bound"), [group], [F.desc(value), *ties], k, rank)


def sample_lists(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], item: Column, k: int, name: str = "sample_locations"
) -> DataFrame:
    """The first ``k`` items of each group as an array, in the given order."""
    kept = first_rows(df, keys, order, k)
    entry = F.struct(F.col("_rank"), item.alias("item"))
    return kept.groupBy(*keys).agg(F.array_sort(F.collect_list(entry))["item"].alias(name))
