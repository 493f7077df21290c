"""Quantile sketches per group that can be stored, merged and asked later.

A sketch is a table of rows (group..., column, bucket, n): how many values fall into
each bucket of a logarithmic scale. Buckets depend on the value alone, so the sketch of
a union is the sum of the sketches, whatever the order, the tasks or the partitions, and
Spark's partial aggregation builds it in one scan. A quantile is off by at most
``error`` of its own size, and the values between it and the exact one lie in one bucket, so its rank
is wrong by less than that bucket's count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runnel.functions.values import quoted

#: Sizes below this share a bucket with 0.
LEAST = 1e-12


def _base(error: float) -> float:
    return math.log((1 + error) / (1 - error))


def quantile_sketch(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), error: float = 0.005) -> DataFrame:
    """(by..., column, error, bucket, n) of the present values, in one scan; infinite values have end buckets of their own.

    A column has at most some 2 * 700 / error / 2 + 3 buckets, however many rows there are.
    """
    values = [f"struct('{c}' as `column`, cast({quoted(c)} as double) as v)" for c in columns]
    long = df.select(*by, F.inline(F.expr(f"array({', '.join(values)})"))).where("v is not null and not isnan(v)")
    size = F.ceil(F.log(F.greatest(F.abs("v"), F.lit(LEAST)) / LEAST) / _base(error)) + 1
    bucket = F.when(F.abs("v") <= LEAST, 0).when(F.abs("v") == float("inf"), 1 << 40).otherwise(size)
    signed = F.when(F.col("v") < 0, -bucket).otherwise(bucket).cast("long").alias("bucket")
    counted = long.groupBy(*by, "column", signed).agg(F.count("*").alias("n"))
    return counted.select(*by, "column", F.lit(error).alias("error"), "bucket", "n")


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One sketch per group and column from those of several tables, or of finer groups."""
    return sketches.groupBy(*by, "column", "error", "bucket").agg(F.sum("n").alias("n"))


def sketched_quantiles(sketches: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, probability, value, low, high, rank_error) from sketches.

    The element at position p * (n - 1), rounded down, lies between ``low`` and ``high``; ``value``
    is within ``error`` of it. ``rank_error`` is the largest share of ranks by which it may be off.
    """
    key = [*by, "column", "error"]
    upto = F.sum("n").over(Window.partitionBy(*key).orderBy("bucket"))
    total = F.sum("n").over(Window.partitionBy(*key))
    # One row per bucket here.
    placed = sketches.select(*key, "bucket", "n", upto.alias("upto"), total.alias("total"))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    rank = F.floor(F.col("probability") * (F.col("total") - 1))
    asked = placed.select("*", wanted).where((rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n")))
    base = F.log((1 + F.col("error")) / (1 - F.col("error")))
    size = F.abs("bucket")
    top = F.lit(LEAST) * F.exp((size - 1) * base)
    middle = top * (1 - F.col("error"))
    sign = F.signum(F.col("bucket").cast("double"))

    def signed(value):
        return F.when(size == 0, F.lit(0.0)).when(size == 1 << 40, sign * float("inf")).otherwise(sign * value)

    below = top * F.exp(-base)
    low = F.when(size == 0, -LEAST).otherwise(F.least(signed(below), signed(top)))
    high = F.when(size == 0, LEAST).otherwise(F.greatest(signed(below), signed(top)))
    return asked.select(*by, "column", "probability", signed(middle).alias("value"), low.alias("low"), high.alias("high"), (F.col("n") / F.col("total")).alias("rank_error"))
