"""Summaries of numeric columns: moments, quantiles, histograms, correlations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runnel.functions.values import min_max_scaled, nan_to_null, nan_to_null_column, quoted
from runnel.operators.order_stats import HISTOGRAM_ROWS, quantiles
from runnel.schema import MONTHS


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _by_name(columns: Sequence[str], position: str) -> Column:
    names = ", ".join(f"'{c}'" for c in columns)
    return F.expr(f"get(array({names}), cast({position} as int))")


def _literal_rows(spark, names: Sequence[str], rows: dict[str, list[float | None]], key: str) -> DataFrame:
    schema = T.StructType(
        [T.StructField(key, T.StringType()), *[T.StructField(n, T.DoubleType()) for n in names]]
    )
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], schema)


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(position, count, mean, std, min, max) of the present values of every column, in one scan.

    Each task sends one row per column with its own mean and squared deviations;
    these are merged around the mean of all tasks, so large offsets do not cancel.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(columns)
        n, mean, squares, low, high = np.zeros(k), np.zeros(k), np.zeros(k), np.full(k, np.inf), np.full(k, -np.inf)
        rows = 0
        for batch in batches:
            rows += len(batch)
            for i, column in enumerate(batch.columns):
                v = column.drop_null().to_numpy(zero_copy_only=False)
                v = v[~np.isnan(v)]
                if len(v):
                    own = v.mean()
                    total, apart = n[i] + len(v), own - mean[i]
                    squares[i] += ((v - own) ** 2).sum() + apart * apart * n[i] * len(v) / total
                    mean[i] += apart * len(v) / total
                    n[i] = total
                    low[i], high[i] = min(low[i], v.min()), max(high[i], v.max())
        if rows:
            none = n == 0
            arrays = [pa.array(np.arange(k)), pa.array(n.astype(np.int64)), pa.array(mean), pa.array(squares), pa.array(low, mask=none), pa.array(high, mask=none)]
            yield pa.RecordBatch.from_arrays(arrays, names=["position", "n", "mean", "squares", "low", "high"])

    table = df.selectExpr(*[f"cast({quoted(c)} as double) as c{i}" for i, c in enumerate(columns)])
    tasks = table.mapInArrow(run, "position long, n long, mean double, squares double, low double, high double")
    # A column has as many rows here as there are tasks.
    whole = Window.partitionBy("position")
    centre = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(whole), F.sum("n").over(whole))
    merged = (
        tasks.withColumn("centre", centre)
        .groupBy("position")
        .agg(
            F.sum("n").alias("count"),
            F.first("centre").alias("mean"),
            F.sum(F.col("squares") + F.col("n") * (F.col("mean") - F.col("centre")) ** 2).alias("squares"),
            F.min("low").alias("min"),
            F.max("high").alias("max"),
        )
    )
    std = F.sqrt(F.try_divide("squares", F.nullif(F.col("count") - 1, F.lit(0))))
    return merged.select(F.col("position").cast("int").alias("position"), "count", "mean", std.alias("std"), "min", "max")


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, budget: int = HISTOGRAM_ROWS
) -> DataFrame:
    """Per column: count, mean, sample deviation, minimum, quartiles, maximum.

    Pass a stored table: the quartiles are exact and take a few scans.
    """
    columns = list(columns or numeric_columns(df))
    moments = _moments(df, columns)
    quartiles = quantiles(df, columns, (0.25, 0.5, 0.75), budget)
    named = moments.withColumn("column", _by_name(columns, "position"))
    at = _literal_rows(df.sparkSession, ["p25", "p50", "p75"], quartiles, "column")
    # Both sides hold one row per column of the table.
    return (
        named.join(F.broadcast(at), "column")
        .select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max", "position")
        .orderBy("position")
    )


def month_distribution(
    df: DataFrame, columns: Sequence[str], labels: Sequence[str] = MONTHS, budget: int = HISTOGRAM_ROWS
) -> DataFrame:
    """Per month: count, mean, extremes, quartiles and the 1.5 IQR fences.

    Quartiles are linear between neighbours. Pass a stored table.
    """
    quartiles = quantiles(df, columns, (0.25, 0.5, 0.75), budget)
    rows = {m: quartiles[c] for m, c in zip(labels, columns, strict=True)}
    at = _literal_rows(df.sparkSession, ["p25", "p50", "p75"], rows, "month")
    spread = F.col("p75") - F.col("p25")
    by_month = _moments(df, columns).withColumn("month", _by_name(labels, "position"))
    return by_month.join(F.broadcast(at), "month").select(
        "month", "count", "mean", "min", "max", "p25", "p50", "p75",
        (F.col("p25") - 1.5 * spread).alias("lower_fence"),
        (F.col("p75") + 1.5 * spread).alias("upper_fence"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the finite minimum and maximum: bin 1..n, its edges, count.

    Empty bins give no row; the maximum belongs to the last bin. Infinite values
    have a row of their own each, without a bin, and the value as both edges.
    """
    present = df.select(nan_to_null(column).cast("double").alias("v")).where("v is not null")
    infinite = F.abs("v") == F.lit(float("inf"))
    values = present.where(~infinite)
    outside = present.where(infinite).groupBy("v").agg(F.count("*").alias("count"))
    extent = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    placed = values.select("v", extent.alias("e")).select(
        (F.least(F.floor(F.coalesce(min_max_scaled("v", "e.low", "e.high"), F.lit(0.0)) * bins),
                 F.lit(bins - 1)) + 1).cast("int").alias("bin"),
        F.col("e.low").alias("low"),
        ((F.col("e.high") - F.col("e.low")) / bins).alias("width"),
    )
    binned = (
        placed.groupBy("bin", "low", "width")
        .agg(F.count("*").alias("count"))
        .select(
            "bin",
            (F.col("low") + (F.col("bin") - 1) * F.col("width")).alias("bin_start"),
            (F.col("low") + F.col("bin") * F.col("width")).alias("bin_end"),
            "count",
        )
    )
    return binned.union(outside.select(F.lit(None).cast("int"), "v", "v", "count"))


def extremes(df: DataFrame, column: str) -> DataFrame:
    """Minimum, maximum and whether their ratio calls for a log scale (> 100)."""
    v = nan_to_null(column)
    return df.agg(F.min(v).alias("min"), F.max(v).alias("max")).select(
        "min", "max", F.coalesce(F.try_divide("max", "min") > 100, F.lit(False)).alias("log_scale")
    )


def row_of_maximum(df: DataFrame, column: str, ties: Sequence[str]) -> DataFrame:
    """The row with the largest value; the smallest ``ties`` columns win, ``POSITION`` among them the first row of the input."""
    return df.where(nan_to_null(column).isNotNull()).orderBy(F.desc(column), *ties).limit(1)


_PAIR_SUMS = ["n", "mean_a", "mean_b", "apart_a", "apart_b", "joint", "raw_a", "raw_b", "size_a", "size_b"]


def _pair_moments(k: int):
    """Arrow batches of one task to one row of moments per column pair.

    A batch is moved by its own means before it is multiplied; batches are merged
    by their means and deviations, so neither large offsets nor drifting ones cancel.
    """
    left, right = np.tril_indices(k)
    names = ["a", "b", *_PAIR_SUMS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Entry [i, j] is about column i over the rows where i and j are present.
        n, mean, apart, joint, raw = (np.zeros((k, k)) for _ in range(5))
        size = np.zeros(k)
        rows = 0
        for batch in batches:
            if not len(batch):
                continue
            rows += len(batch)
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            present = np.isfinite(values)
            values = np.where(present, values, 0.0)
            w = present.astype(float)
            centre = values.sum(0) / np.maximum(w.sum(0), 1)
            d = (values - centre) * w
            own = w.T @ w
            some = np.maximum(own, 1)
            total, squares = d.T @ w, (d * d).T @ w
            near = total / some
            whole = np.maximum(n + own, 1)
            step = np.where(own > 0, centre[:, None] + near - mean, 0.0)
            share = n * own / whole
            apart += np.maximum(squares - total * near, 0) + step * step * share
            joint += d.T @ d - total * near.T + step * step.T * share
            raw += squares
            mean += step * own / whole
            n += own
            size = np.maximum(size, np.abs(values).max(0))
        if rows:
            arrays = [left, right, n[left, right], mean[left, right], mean[right, left], apart[left, right], apart[right, left]]
            arrays += [joint[left, right], raw[left, right], raw[right, left], size[left], size[right]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=names)

    return run, "a bigint, b bigint, " + ", ".join(f"{c} double" for c in _PAIR_SUMS)


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson r of every column pair over the rows where both are present.

    Long form (column_a, column_b, r), both triangles and the diagonal; r is
    NULL where a column does not vary. NULL, NaN and infinite values count as
    absent. One scan: each task multiplies its batches as matrices and sends one
    row per pair, which are merged around the pair's mean of all tasks, so large
    offsets do not cancel. A spread within the rounding of the column's largest
    value counts as none, whatever the order of the rows.
    """
    columns = list(columns or numeric_columns(df))
    table = df.selectExpr(*[f"cast({quoted(c)} as double) as {quoted(c)}" for c in columns])
    run, schema = _pair_moments(len(columns))
    # A pair has as many rows here as there are tasks.
    whole = Window.partitionBy("a", "b")
    tasks = table.mapInArrow(run, schema).withColumns(
        {f"off_{c}": F.col(f"mean_{c}") - F.try_divide(F.sum(F.col("n") * F.col(f"mean_{c}")).over(whole), F.sum("n").over(whole)) for c in "ab"}
    )

    def merged(apart: str, one: str, other: str) -> Column:
        between = F.when(F.col("n") > 0, F.col("n") * F.col(f"off_{one}") * F.col(f"off_{other}")).otherwise(0.0)
        return F.sum(F.col(apart) + between)

    sums = tasks.groupBy("a", "b").agg(
        F.sum("n").alias("n"),
        merged("apart_a", "a", "a").alias("va"), merged("apart_b", "b", "b").alias("vb"), merged("joint", "a", "b").alias("vab"),
        F.sum("raw_a").alias("raw_a"), F.sum("raw_b").alias("raw_b"),
        F.max("size_a").alias("size_a"), F.max("size_b").alias("size_b"),
    )

    def spread(c: str) -> Column:
        # What rounding leaves of a constant column counts as no spread.
        v, rounding = F.col(f"v{c}"), F.col(f"size_{c}") * 2.0**-50
        return F.when((v > F.col(f"raw_{c}") * 1e-12) & (v > F.col("n") * rounding * rounding), v)

    r = nan_to_null_column(F.col("vab") / F.sqrt(spread("a") * spread("b")))
    pairs = sums.select("a", "b", F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))
    one, other = "named_struct('a', a, 'b', b)", "named_struct('a', b, 'b', a)"
    both = f"inline(case when a = b then array({one}) else array({one}, {other}) end)"
    mirrored = pairs.selectExpr("r", both)
    return mirrored.select(_by_name(columns, "a").alias("column_a"), _by_name(columns, "b").alias("column_b"), "r")


def trend_surface(
    df: DataFrame, x: str = "X", y: str = "Y", value: str = "i_mid", nodes: int = 20, min_points: int = 0
) -> DataFrame:
    """Mean ``log1p`` of the value at the nodes of a regular grid over x and y.

    Each point belongs to its nearest node; nodes without points are 0. At or
    below ``min_points`` points there are no rows.
    """
    clean = df.select(*[nan_to_null(c).alias(a) for c, a in ((x, "x"), (y, "y"), (value, "v"))]).dropna()
    extent = clean.agg(
        F.struct(
            F.min("x").alias("x0"), F.max("x").alias("x1"),
            F.min("y").alias("y0"), F.max("y").alias("y1"), F.count("*").alias("n"),
        )
    ).scalar()

    def node(c: str, low: str, high: str) -> Column:
        share = F.coalesce(min_max_scaled(c, f"e.{low}", f"e.{high}"), F.lit(0.0))
        return F.floor(share * (nodes - 1) + 0.5).cast("int")

    means = (
        clean.select("*", extent.alias("e"))
        .groupBy(node("x", "x0", "x1").alias("x_node"), node("y", "y0", "y1").alias("y_node"))
        .agg(F.avg(F.log1p("v")).alias("mean"))
    )
    grid = df.sparkSession.range(nodes * nodes).select(
        (F.col("id") % nodes).cast("int").alias("x_node"),
        F.floor(F.col("id") / nodes).cast("int").alias("y_node"),
        extent.alias("e"),
    )

    def at(low: str, high: str, index: str) -> Column:
        return F.col(f"e.{low}") + F.col(index) * (F.col(f"e.{high}") - F.col(f"e.{low}")) / (nodes - 1)

    return (
        grid.where(F.col("e.n") > min_points)
        .join(means, ["x_node", "y_node"], "left")
        .select(
            "x_node",
            "y_node",
            at("x0", "x1", "x_node").alias("x"),
            at("y0", "y1", "y_node").alias("y"),
            F.coalesce("mean", F.lit(0.0)).alias("level"),
        )
    )
