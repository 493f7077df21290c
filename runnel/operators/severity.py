"""Severity classes from order-statistic thresholds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.functions.text import site_key
from runnel.functions.values import all_present, density, positive
from runnel.operators.groups import sample_lists
from runnel.operators.order_stats import HISTOGRAM_ROWS, nth_values
from runnel.operators.seasonal import with_seasonal_variance
from runnel.schema import DEFAULT_ROLES, SiteRoles
from runnel.sources.positions import input_order

# The fractions behind low, medium, high and critical.
FRACTIONS = (0.25, 0.50, 0.75, 0.90)


@dataclass(frozen=True)
class Thresholds:
    """Sorted-list elements at int(n * p); ``critical`` is reported, not used."""

    count: int
    low: float | None
    medium: float | None
    high: float | None
    critical: float | None

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [tuple(asdict(self).values())],
            "count bigint, low double, medium double, high double, critical double",
        )


def severity_features(
    sites: DataFrame, roles: SiteRoles = DEFAULT_ROLES, keep: Sequence[str] = (), variance: bool = True
) -> DataFrame:
    """Polluted sites with density and, on request, seasonal variance.

    A site counts when all its fields can be read; its months only matter
    because an unreadable one drops the site.
    """
    fields = [roles.x, roles.y, roles.mid, roles.high, roles.area, *roles.pollution_columns]
    readable = sites.where(positive(roles.mid) & all_present(fields))
    if variance:
        readable = with_seasonal_variance(readable, roles)
    return readable.select(
        F.col(roles.x).alias("x"),
        F.col(roles.y).alias("y"),
        F.col(roles.mid).alias("pollution"),
        density(roles.mid, roles.area).alias("density"),
        *(["variance"] if variance else []),
        *keep,
    )


def severity_thresholds(features: DataFrame, budget: int = HISTOGRAM_ROWS) -> Thresholds:
    """Thresholds over the ``pollution`` column of the features (runs jobs)."""
    count, values = nth_values(features, "pollution", FRACTIONS, budget)
    return Thresholds(count, *values)


def severity_class(pollution: Column | str, t: Thresholds) -> Column:
    """LOW, MEDIUM, HIGH or CRITICAL; a value equal to a threshold is below it."""
    v = F.col(pollution) if isinstance(pollution, str) else pollution
    return (
        F.when(v <= F.lit(t.low), "LOW")
        .when(v <= F.lit(t.medium), "MEDIUM")
        .when(v <= F.lit(t.high), "HIGH")
        .otherwise("CRITICAL")
    )


def classify_severity(features: DataFrame, thresholds: Thresholds) -> DataFrame:
    return features.withColumn("category", severity_class("pollution", thresholds))


def severity_report(
    features: DataFrame,
    thresholds: Thresholds | None = None,
    samples: int = 10,
    order: Sequence[Column] | Literal["input"] | None = None,
    digits: int = 6,
) -> DataFrame:
    """Count, mean pollution, mean density and sample sites per class.

    Pass stored features: they are scanned for the thresholds, the means and
    the samples. Samples are the first sites by ``order`` (default: x, y); ``"input"``
    takes the order of the files, of features that keep ``POSITION``.
    """
    classed = classify_severity(features, thresholds or severity_thresholds(features))
    means = classed.groupBy("category").agg(
        F.count("*").alias("count"),
        F.round(F.avg("pollution"), digits).alias("avg_pollution"),
        F.round(F.avg("density"), digits).alias("avg_density"),
    )
    listed = sample_lists(
        classed, ["category"], input_order(order, [F.col("x"), F.col("y")]), site_key("x", "y"), samples
    )
    return means.join(listed, "category")
