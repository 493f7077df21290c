"""Wide months to long rows, totals and means per month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.functions.text import month_title
from runnel.functions.values import quoted
from runnel.schema import MONTHS


def stacked(labels: Sequence[str], *columns: Sequence[str]) -> str:
    """Generator text: one row (label, values) per label, without a shuffle."""
    rows = [", ".join([f"'{label}'", *map(quoted, row)]) for label, *row in zip(labels, *columns, strict=True)]
    return f"stack({len(rows)}, {', '.join(rows)})"


def months_long(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str],
    labels: Sequence[str] = MONTHS,
    name: str = "month",
    value: str = "value",
) -> DataFrame:
    """One row per input row and month; rows with a missing value are kept."""
    return df.selectExpr(*map(quoted, ids), f"{stacked(labels, columns)} as ({quoted(name)}, {quoted(value)})")


def month_pairs(df: DataFrame, ids: Sequence[str], months: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row (ids, month, pollution, runoff) per input row and month."""
    return df.selectExpr(*map(quoted, ids), f"{stacked(*zip(*months))} as (month, pollution, runoff)")


def _per_month(df: DataFrame, aggregate: str, columns: Sequence[str], labels: Sequence[str], value: str) -> DataFrame:
    """Aggregate every month column to one row, then turn that row into month rows."""
    wide = df.agg(*[F.expr(f"{aggregate.format(quoted(c))} as {quoted(m)}") for c, m in zip(columns, labels)])
    long = months_long(wide, [], labels, labels, "label", value)
    order = F.array_position(F.array(*[F.lit(label) for label in labels]), F.col("label")) - 1
    return long.select(month_title("label").alias("month"), order.cast("int").alias("month_index"), value)


def monthly_totals(df: DataFrame, columns: Sequence[str], labels: Sequence[str] = MONTHS) -> DataFrame:
    """Sum per month column, in calendar order; 0 for a column without values. NaN counts as missing."""
    return _per_month(df, "coalesce(sum(nanvl({}, cast(null as double))), 0D)", columns, labels, "total").orderBy("month_index")


def monthly_means(df: DataFrame, columns: Sequence[str], labels: Sequence[str] = MONTHS) -> DataFrame:
    """Mean per month column over the present values, in calendar order."""
    return _per_month(df, "avg(nanvl({}, cast(null as double)))", columns, labels, "average").orderBy("month_index")
