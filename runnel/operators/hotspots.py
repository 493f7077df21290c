"""Grid cells with several polluted sites and a high score."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.functions.text import grid_key, site_key
from runnel.functions.values import all_present, density, greater, grid_corner_sql, grid_index
from runnel.operators.groups import sample_lists
from runnel.schema import DEFAULT_ROLES, SiteRoles
from runnel.sources.positions import POSITION, input_order

CELL = ("cell_x", "cell_y")


def grid_points(
    sites: DataFrame,
    grid_size: float = 0.1,
    pollution_threshold: float = 0.01,
    roles: SiteRoles = DEFAULT_ROLES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Sites above the threshold with their grid cell and density.

    Cells truncate toward zero, so the cells around 0 are twice as wide.
    """
    readable = sites.where(
        all_present([roles.x, roles.y, roles.mid, roles.area]) & greater(roles.mid, pollution_threshold)
    )
    points = readable.select(
        F.col(roles.x).alias("x"),
        F.col(roles.y).alias("y"),
        grid_index(roles.x, grid_size).alias("cell_x"),
        grid_index(roles.y, grid_size).alias("cell_y"),
        F.col(roles.mid).alias("pollution"),
        density(roles.mid, roles.area).alias("density"),
        *keep,
    )
    return points.dropna(subset=list(CELL))


def cell_name(grid_size: float) -> Column:
    """Key of the cell columns' grid cell."""
    return grid_key(grid_corner_sql("cell_x", grid_size), grid_corner_sql("cell_y", grid_size))


def hotspots(
    sites: DataFrame,
    grid_size: float = 0.1,
    pollution_threshold: float = 0.01,
    min_locations: int = 2,
    min_score: float = 0.1,
    samples: int = 5,
    roles: SiteRoles = DEFAULT_ROLES,
    order: Sequence[Column] | Literal["input"] | None = None,
    digits: int = 6,
) -> DataFrame:
    """Grid cells with at least ``min_locations`` sites and a score above ``min_score``.

    The score is total pollution x sites x mean density / 1000, compared before
    rounding. Samples are the first sites by ``order`` (default: x, y); ``"input"``
    takes the order of the files, of sites read with their position.
    """
    points = grid_points(sites, grid_size, pollution_threshold, roles, [POSITION] if order == "input" else [])
    cells = (
        points.groupBy(*CELL)
        .agg(
            F.count("*").alias("locations_count"),
            F.sum("pollution").alias("total"),
            F.avg("density").alias("mean_density"),
            F.max("pollution").alias("largest"),
        )
        .withColumn("score", F.col("total") * F.col("locations_count") * F.col("mean_density") / 1000.0)
        .where((F.col("locations_count") >= min_locations) & (F.col("score") > min_score))
    )
    # Only points of hot cells are ranked for the samples.
    hot = points.join(cells.select(*CELL), list(CELL), "left_semi")
    listed = sample_lists(hot, CELL, input_order(order, [F.col("x"), F.col("y")]), site_key("x", "y"), samples)
    return cells.join(listed, list(CELL)).select(
        cell_name(grid_size).alias("grid"),
        "locations_count",
        F.round("total", digits).alias("total_pollution"),
        F.round("mean_density", digits).alias("average_density"),
        F.round("largest", digits).alias("max_pollution"),
        F.round("score", digits).alias("hotspot_score"),
        "sample_locations",
    )
