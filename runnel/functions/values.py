"""Numeric column expressions: missing values, density, grid cells, scaling.

Arguments named in upper-level operators as columns are SQL text here, a column
name or an expression. Wide tables need hundreds of terms; as text each
expression is built in one step.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return f"`{name}`"


def greater_sql(c: str, bound: float) -> str:
    return f"({c} > {float(bound)!r}D and not isnan({c}))"


def greater(c: str, bound: float) -> Column:
    """``c > bound`` where NaN compares false (Spark orders NaN above all)."""
    return F.expr(greater_sql(c, bound))


def positive_sql(c: str) -> str:
    return greater_sql(c, 0.0)


def positive(c: str) -> Column:
    return greater(c, 0.0)


def nan_to_null_sql(c: str) -> str:
    return f"nanvl({c}, cast(null as double))"


def nan_to_null(c: str) -> Column:
    return F.expr(nan_to_null_sql(c))


def nan_to_null_column(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def all_present(columns: Iterable[str]) -> Column:
    """True when no column is NULL; a field that could not be parsed is NULL."""
    return F.expr(" and ".join(f"{quoted(c)} is not null" for c in dict.fromkeys(columns)))


def to_number_sql(c: str) -> str:
    return f"try_cast(replace({c}, ',', '') as double)"


def to_number(c: str) -> Column:
    """Text to double; thousands commas are dropped, bad text becomes NULL."""
    return F.expr(to_number_sql(c))


def parse_float_sql(c: str) -> str:
    suffix = f"right(trim(trailing ' \\t\\r' from {c}), 1) in ('d', 'D', 'f', 'F') and not lower({c}) like '%inf%'"
    return f"""case when not (contains({c}, 'x') or contains({c}, 'X') or ({suffix}))
        then try_cast({c} as double) end"""


def parse_float(c: str) -> Column:
    """Text to double, strictly: NULL unless the whole text is one number.

    Java type suffixes and hexadecimal floats, which a cast lets through, count
    as bad text.
    """
    return F.expr(parse_float_sql(c))


def density(amount: str, area_m2: str) -> Column:
    """Amount per square kilometre; 0 where the area is not positive."""
    return F.expr(f"case when {positive_sql(area_m2)} then {amount} / ({area_m2} / 1000000D) else 0D end")


def grid_index(c: str, size: float) -> Column:
    """Number of the grid cell, truncated toward zero; NULL off the grid."""
    return F.expr(f"try_cast({c} / {float(size)!r}D as bigint)")


def grid_corner_sql(index: str, size: float) -> str:
    return f"round({index} * {float(size)!r}D, 4)"


def clamp(c: str, low: float, high: float) -> Column:
    """The value moved into [low, high]; NULL stays NULL."""
    return F.expr(f"case when ({c}) is not null then greatest({float(low)!r}D, least({float(high)!r}D, {c})) end")


def capped_share(value: str, reference: str) -> Column:
    """``min(value / reference, 1)``; 1 when the reference is zero."""
    return F.expr(f"least(coalesce(try_divide({value}, {reference}), 1D), 1D)")


def min_max_scaled_sql(value: str, low: str, high: str) -> str:
    return f"try_divide({value} - {low}, {high} - {low})"


def min_max_scaled(value: str, low: str, high: str) -> Column:
    """Position between low and high; NULL when they are equal."""
    return F.expr(min_max_scaled_sql(value, low, high))


def scaled_size(value: str, largest: str, factor: float) -> Column:
    """Marker size ``value / largest * factor + 5``."""
    return F.expr(f"try_divide({value}, {largest}) * {float(factor)!r}D + 5D")


def radius_divisor_sql(largest: str) -> str:
    """Divisor of the marker radius, by magnitude of the largest value."""
    # Upper limits and divisors.
    return f"""case when not {largest} > 0 then 5000D when {largest} < 10 then 0.5D when {largest} < 100 then 5D
        when {largest} < 1000 then 50D when {largest} < 10000 then 500D else 5000D end"""


def risk_score(high: str, weight: str, area: str) -> Column:
    return F.expr(f"try_divide({high} * {weight}, {area})")
