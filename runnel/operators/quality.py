"""Completeness of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runnel.functions.values import quoted
from runnel.operators.reshape import stacked
from runnel.schema import DEFAULT_ROLES, SiteRoles


def _missing(field: T.StructField) -> str:
    c = quoted(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return f"({c} is null or isnan({c}))"
    return f"{c} is null"


def missing_by_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, in one pass over the table."""
    columns = list(columns or df.columns)
    schema = df.schema
    counts = df.agg(*[F.expr(f"count_if({_missing(schema[c])}) as {quoted(c)}") for c in columns])
    return counts.selectExpr(f"{stacked(columns, columns)} as (column, missing)")


def missing_total(df: DataFrame) -> DataFrame:
    return missing_by_column(df).agg(F.sum("missing").alias("missing"))


def table_shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every given column is present; NaN counts as missing."""
    return df.dropna(subset=list(columns))


def clean_sites(df: DataFrame, roles: SiteRoles = DEFAULT_ROLES) -> DataFrame:
    """Sites with a coordinate and a numeric mid estimate.

    The top-sites map worked on this frame and handed it on to later panels;
    here callers pass the result on where they want that.
    """
    number = df.withColumn(roles.mid, F.col(roles.mid).try_cast("double"))
    return drop_missing(number, [roles.mid, roles.x, roles.y])


def completeness(df: DataFrame, roles: SiteRoles = DEFAULT_ROLES, target: float = 90.0) -> DataFrame:
    """Mean share (percent) of rows with coordinates and with a mid estimate.

    With the quality band, the distance to ``target`` and whether it is met; 0
    for an empty table.
    """
    schema = df.schema

    def share(*columns: str) -> Column:
        absent = " or ".join(_missing(schema[c]) for c in columns)
        return F.expr(f"coalesce(try_divide(count_if(not ({absent})), count(*)) * 100, 0D)")

    # Band limits.
    band = F.when(F.col("score") < 50, "low").when(F.col("score") < 80, "medium").otherwise("high")
    return (
        df.agg(
            F.count("*").alias("rows"),
            share(roles.x, roles.y).alias("coordinate_quality"),
            share(roles.mid).alias("concentration_quality"),
        )
        .withColumn("score", (F.col("coordinate_quality") + F.col("concentration_quality")) / 2)
        .select(
            "*",
            band.alias("band"),
            (F.col("score") - target).alias("delta"),
            (F.col("score") >= target).alias("on_target"),
        )
    )
