"""Shards along a Hilbert curve through several metadata columns.

Every dimension is quantised to a few bits, a row's cell gets its index on the
curve, rows are sorted by index and runs of equal row count are cut. Cells that
are close on the curve are close in every dimension, so each shard covers
narrow ranges of all of them and readers can skip shards by any.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runnel.sources.staging import stage


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer cells, one row per cell, one column per dimension.

    Goes down the curve's orthants from the largest: the parity of the upper
    bits gives the orthant's place, and its frame (a swap with the first axis or
    a mirroring of it) is undone before the next level.
    """
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        high, below = 1 << level, (1 << level) - 1
        for i in range(n):
            upper = (x[i] & high) != 0
            swap = (x[0] ^ x[i]) & below
            x0 = np.where(upper, x[0] ^ below, x[0] ^ swap)
            x[i] = x[i] if i == 0 else np.where(upper, x[i], x[i] ^ swap)
            x[0] = x0
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & (1 << level)) != 0, (1 << level) - 1, 0)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | (((x[i] ^ flip) >> level) & 1)
    return index


def log_level(value: Column, bits: int) -> Column:
    """Cell of a size: its binary magnitude, small sizes in the first cell."""
    top = (1 << bits) - 1
    level = F.floor(F.log2(F.greatest(value.cast("double"), F.lit(1.0))))
    return F.coalesce(F.least(level, F.lit(top)), F.lit(0)).cast("int")


def hash_level(value: Column, bits: int) -> Column:
    """Cell of a name; null is a name of its own."""
    return F.pmod(F.xxhash64(value), F.lit(1 << bits)).cast("int")


def hilbert_shards(
    docs: DataFrame, dimensions: Sequence[Column], bits: int, shards: int, key: str, carry: Sequence[Column] = (), partitions: int | None = None
) -> DataFrame:
    """key, the carried columns, curve (index), shard and slot of every row; shard sizes differ by one row at most.

    Rows are range-partitioned by curve index and key hash, so a cell that
    holds a third of all rows is spread; a row's rank is its place in its range
    plus the sizes of the ranges before, one number per range. Dimensions are
    integers of ``bits`` bits; nulls count as 0. Null and repeated keys are kept,
    each row by itself; rows equal in everything may change places. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession

    @F.pandas_udf("long")
    def curve(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(), bits))

    cells = F.struct(*[F.coalesce(d.cast("int"), F.lit(0)).alias(f"d{i}") for i, d in enumerate(dimensions)])
    carried = [c.alias(f"c{i}") for i, c in enumerate(carry)]
    rows = docs.select(F.col(key).alias("k"), *carried, curve(cells).alias("curve"))
    names = [f"c{i}" for i in range(len(carry))]
    order = ["curve", "tie", "k", *names]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Stored once: the ranges come from a sample, so ranks must not be taken from two runs.
    placed = stage(
        rows.withColumn("tie", F.xxhash64("k"))
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "curve",
    )
    part, place = F.shiftright("place", 33), F.expr("place & ((1L << 33) - 1)")
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row per range: a table as long as the number of partitions.
    before = sizes.select(
        "part",
        (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    ranked = placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn("rank", F.col("before") + place)
    shard = F.expr(f"(rank * {shards}) div total")
    first = F.expr(f"(shard * total + {shards} - 1) div {shards}")
    return (
        ranked.withColumn("shard", shard)
        .withColumn("slot", F.col("rank") - first)
        .select(F.col("k").alias(key), *names, "curve", F.col("shard").cast("int").alias("shard"), "slot")
    )
