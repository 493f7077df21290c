"""Tables behind maps and charts: top sites, heat weights, months, severity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.functions.text import display_name, fixed, month_full_name, month_index, month_title, ramp_color, site_key
from runnel.functions.values import (
    capped_share,
    clamp,
    min_max_scaled,
    nan_to_null,
    positive,
    radius_divisor_sql,
    risk_score,
    scaled_size,
)
from runnel.operators.groups import largest_rows
from runnel.operators.order_stats import HISTOGRAM_ROWS, number_sql, quantiles
from runnel.operators.quality import clean_sites, drop_missing
from runnel.operators.reshape import months_long
from runnel.schema import DEFAULT_ROLES, SiteRoles

# Class names by the quantiles below, lowest first.
CONCENTRATION_CLASSES = ("Low", "Moderate", "High", "Very High", "Critical")
CONCENTRATION_QUANTILES = (0.25, 0.5, 0.75, 0.9)


def top_sites(df: DataFrame, k: int = 20, roles: SiteRoles = DEFAULT_ROLES, ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` sites with the largest mid estimate; ties by x, y, then ``ties``."""
    wanted = clean_sites(df, roles).select(roles.x, roles.y, roles.mid, *ties)
    return wanted.orderBy(F.desc(roles.mid), roles.x, roles.y, *ties).limit(k)


def map_view(points: DataFrame, roles: SiteRoles = DEFAULT_ROLES, empty: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Centre, extent and zoom level of a map over the points."""
    x, y = nan_to_null(roles.x), nan_to_null(roles.y)
    extent = points.agg(
        F.coalesce(F.avg(y), F.lit(float(empty[0]))).alias("center_y"),
        F.coalesce(F.avg(x), F.lit(float(empty[1]))).alias("center_x"),
        F.min(x).alias("min_x"),
        F.max(x).alias("max_x"),
        F.min(y).alias("min_y"),
        F.max(y).alias("max_y"),
    )
    width, height = F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")
    # Extents in degrees and their zoom levels.
    zoom = (
        F.when((height < 5) & (width < 5), 8)
        .when((height < 10) & (width < 10), 6)
        .when((height > 50) | (width > 50), 2)
        .otherwise(3)
    )
    return extent.withColumn("zoom", zoom)


def _with_extremes(df: DataFrame, column: str) -> DataFrame:
    """Every row with the column's minimum and maximum, as field ``_e``."""
    v = nan_to_null(column)
    extent = df.agg(F.struct(F.min(v).alias("low"), F.max(v).alias("high"))).scalar()
    return df.withColumn("_e", extent)


def scaled_markers(top: DataFrame, roles: SiteRoles = DEFAULT_ROLES, ties: Sequence[str] = ()) -> DataFrame:
    """Marker radius proportional to the value, and the popup text."""
    return _with_extremes(top, roles.mid).select(
        roles.y,
        roles.x,
        roles.mid,
        *ties,
        F.expr(f"greatest(0.5D, {roles.mid} / {radius_divisor_sql('_e.high')})").alias("radius"),
        F.concat(F.lit("Pollution: "), fixed(roles.mid, 2), F.lit(" particles/km²")).alias("popup"),
    )


def colored_markers(top: DataFrame, roles: SiteRoles = DEFAULT_ROLES, ties: Sequence[str] = ()) -> DataFrame:
    """Marker intensity, colour, clamped radius, severity and popup texts.

    Intensity, colour and severity are NULL when all values are equal; the
    radius is the largest one when all are zero.
    """
    t = F.col("intensity")
    placed = _with_extremes(top, roles.mid).withColumn(
        "intensity", min_max_scaled(roles.mid, "_e.low", "_e.high")
    )
    return placed.select(
        roles.y,
        roles.x,
        roles.mid,
        *ties,
        "intensity",
        ramp_color("intensity").alias("color"),
        F.coalesce(clamp(f"5D + try_divide({roles.mid}, _e.high) * 20D", 5, 25), F.lit(25.0)).alias("radius"),
        F.when(t > 0.8, "Critical").when(t > 0.5, "High").when(t.isNotNull(), "Moderate").alias("severity"),
        F.concat(fixed(roles.mid, 2), F.lit(" particles/km²")).alias("concentration"),
        F.concat(fixed(roles.y, 3), F.lit(", "), fixed(roles.x, 3)).alias("coordinates"),
    )


def heat_points(df: DataFrame, roles: SiteRoles = DEFAULT_ROLES, keep: Sequence[str] = ()) -> DataFrame:
    """Heat layer rows with the mid estimate as weight."""
    rows = drop_missing(df, [roles.x, roles.y, roles.mid]).where(positive(roles.mid))
    return rows.select(roles.y, roles.x, F.col(roles.mid).alias("weight"), *keep)


def heat_points_capped(
    df: DataFrame, roles: SiteRoles = DEFAULT_ROLES, keep: Sequence[str] = (), budget: int = HISTOGRAM_ROWS
) -> DataFrame:
    """Heat layer rows weighted by ``min(mid / q95, 1)``.

    The quantile counts zeros too. Pass a stored table.
    """
    clean = drop_missing(df, [roles.x, roles.y, roles.mid])
    (q95,) = quantiles(clean, [roles.mid], [0.95], budget)[roles.mid]
    rows = clean.where(positive(roles.mid))
    weight = capped_share(roles.mid, number_sql(q95))
    return rows.select(roles.y, roles.x, weight.alias("weight"), *keep)


def heat_center(df: DataFrame, roles: SiteRoles = DEFAULT_ROLES) -> DataFrame:
    """Mean position of the heat layer; (30, 0) for an empty one."""
    clean = drop_missing(df, [roles.x, roles.y, roles.mid])
    return clean.agg(
        F.coalesce(F.avg(roles.y), F.lit(30.0)).alias("center_y"),
        F.coalesce(F.avg(roles.x), F.lit(0.0)).alias("center_x"),
    )


def nonzero_sites(df: DataFrame, roles: SiteRoles = DEFAULT_ROLES) -> DataFrame:
    """Sites whose three annual estimates are not all zero; missing is not zero."""
    zero = F.lit(True)
    for c in (roles.mid, roles.low, roles.high):
        zero = zero & F.col(c).eqNullSafe(0.0)
    return df.where(~zero)


def top_sites_by_month(
    df: DataFrame, k: int = 20, roles: SiteRoles = DEFAULT_ROLES, ties: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` largest monthly values of each month, with labels.

    ``rank`` counts from 1 per month; ties by x, y, then ``ties``. Missing
    values are never among the largest.
    """
    ids = [roles.x, roles.y, roles.mid, roles.weight, roles.area, *ties]
    long = months_long(nonzero_sites(df, roles), ids, roles.pollution_columns, roles.labels, value="monthly_input")
    present = long.where(nan_to_null("monthly_input").isNotNull())
    order = [roles.x, roles.y, *ties]
    return (
        largest_rows(present, "month", "monthly_input", [F.col(c) for c in order], k, spread=order)
        .select(
            *ids,
            "month",
            "monthly_input",
            "rank",
            month_index("month").alias("month_index"),
            month_full_name("month").alias("month_name"),
            site_key(roles.x, roles.y, "_").alias("river_id"),
            display_name(roles.x, roles.y).alias("river_display"),
        )
        .orderBy("month_index", "rank")
    )


def axis_limit(top: DataFrame, column: str = "monthly_input") -> DataFrame:
    """Upper axis limit: 1.1 times the largest value."""
    return top.agg((F.max(nan_to_null(column)) * 1.1).alias("axis_limit"))


def severity_table(
    df: DataFrame, roles: SiteRoles = DEFAULT_ROLES, runoff: str = "runoff_jul", keep: Sequence[str] = ()
) -> DataFrame:
    """Area against high estimate with runoff, weight and marker size.

    ``on_log_axes`` marks the rows that logarithmic axes can show.
    """
    return _with_extremes(df, roles.weight).select(
        roles.area,
        roles.high,
        runoff,
        roles.weight,
        *keep,
        scaled_size(roles.weight, "_e.high", 20).alias("marker_size"),
        F.coalesce(positive(roles.area) & positive(roles.high), F.lit(False)).alias("on_log_axes"),
    )


def weight_vs_runoff(
    df: DataFrame, roles: SiteRoles = DEFAULT_ROLES, runoff: str = "runoff_jul", keep: Sequence[str] = ()
) -> DataFrame:
    return df.select(roles.weight, runoff, roles.mid, *keep)


def risk_table(df: DataFrame, roles: SiteRoles = DEFAULT_ROLES, keep: Sequence[str] = ()) -> DataFrame:
    """High estimate x weight / area, and the marker size it gives."""
    scored = df.select(
        roles.high, roles.weight, *keep, risk_score(roles.high, roles.weight, roles.area).alias("risk")
    )
    return _with_extremes(scored, "risk").select(
        roles.high, roles.weight, *keep, "risk", scaled_size("risk", "_e.high", 30).alias("marker_size")
    )


def area_vs_weight(df: DataFrame, roles: SiteRoles = DEFAULT_ROLES, keep: Sequence[str] = ()) -> DataFrame:
    return drop_missing(df, [roles.mid]).select(roles.area, roles.weight, roles.mid, *keep)


def runoff_long(df: DataFrame, roles: SiteRoles = DEFAULT_ROLES, keep: Sequence[str] = ()) -> DataFrame:
    """One row per site and month with a runoff value; month as title text."""
    long = months_long(df, [roles.x, roles.y, *keep], roles.runoff_columns, roles.labels, "Month", "Runoff")
    return drop_missing(long, ["Runoff"]).withColumn("Month", month_title("Month"))


def concentration_class(value: Column | str, limits: Sequence[float | None]) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    label = F.lit(CONCENTRATION_CLASSES[-1])
    for limit, name in reversed(list(zip(limits, CONCENTRATION_CLASSES))):
        label = F.when(v <= F.lit(limit), name).otherwise(label)
    return label


def concentration_points(
    df: DataFrame, roles: SiteRoles = DEFAULT_ROLES, keep: Sequence[str] = (), budget: int = HISTOGRAM_ROWS
) -> DataFrame:
    """Sites with log value, marker size and one of five quantile classes.

    Pass a stored table (or a sample); the quantiles are exact.
    """
    clean = drop_missing(df, [roles.x, roles.y, roles.mid])
    *limits, q95 = quantiles(clean, [roles.mid], [*CONCENTRATION_QUANTILES, 0.95], budget)[roles.mid]
    # The share is unbounded when q95 is 0: positive values get the largest size.
    share = f"try_divide({roles.mid}, {number_sql(q95)})"
    size = F.when(F.expr(f"{share} is null") & positive(roles.mid), 20.0).otherwise(
        clamp(f"{share} * 15D + 3D", 3, 20)
    )
    return clean.select(
        roles.x,
        roles.y,
        roles.mid,
        *keep,
        F.log1p(roles.mid).alias("log_concentration"),
        size.alias("size_factor"),
        concentration_class(roles.mid, limits).alias("concentration_category"),
    )


def hover_text(points: DataFrame, roles: SiteRoles = DEFAULT_ROLES) -> DataFrame:
    """Concentration points with their label lines."""
    return points.withColumns(
        {
            "location_text": F.concat(fixed(roles.x, 2), F.lit("°E, "), fixed(roles.y, 2), F.lit("°N")),
            "concentration_text": F.concat(fixed(roles.mid, 2), F.lit(" particles/km²")),
            "log_text": fixed("log_concentration", 2),
        }
    )


def class_counts(points: DataFrame, column: str = "concentration_category") -> DataFrame:
    """Points per class and the legend label."""
    return (
        points.groupBy(column)
        .agg(F.count("*").alias("points"))
        .withColumn("label", F.concat(column, F.lit(" ("), F.col("points").cast("string"), F.lit(" points)")))
    )
