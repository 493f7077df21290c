"""Operators on metric readings, for stored and for streaming DataFrames.

A reading is a row (source, reading_id, ts) with the metrics ``cpu_percent``,
``memory_percent``, ``cpu_temp`` and ``gpu_temp``. Status, alerts and gauges
work row by row and so run on streams as they are; the history needs a window
and is kept for streams by :mod:`runnel.streaming.history`.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from runnel.operators.groups import first_rows


class Gauge(NamedTuple):
    """Gauge of one metric: value when absent, reference, band limits, threshold."""

    default: float
    reference: float
    low: float
    high: float
    threshold: float


# Warning and critical limits per metric.
STATUS_LIMITS = {"cpu_percent": (70, 90), "memory_percent": (70, 90), "cpu_temp": (70, 85)}

# Alert limits per metric.
ALERT_LIMITS = {"cpu_temp": 70, "gpu_temp": 75}

# Gauge settings per metric.
GAUGES = {
    "cpu_percent": Gauge(0, 50, 30, 70, 90),
    "memory_percent": Gauge(0, 60, 40, 80, 85),
    "cpu_temp": Gauge(45, 50, 50, 70, 80),
    "gpu_temp": Gauge(40, 55, 55, 75, 85),
}

HISTORY = 50
WARNING_LINE = 70.0


def status(value: Column | str, warning: float, critical: float) -> Column:
    """Good, warning or critical; NULL without a value."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v < warning, "good").when(v < critical, "warning").when(v.isNotNull(), "critical")


def with_status(readings: DataFrame) -> DataFrame:
    """Readings with one status column per limited metric."""
    return readings.withColumns({f"{m}_status": status(m, *limits) for m, limits in STATUS_LIMITS.items()})


def alerts(readings: DataFrame) -> DataFrame:
    """Readings with a temperature above its alert limit."""
    hot = F.lit(False)
    for metric, limit in ALERT_LIMITS.items():
        hot = hot | (F.col(metric) > limit)
    return readings.where(hot)


def gauges(readings: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per reading and metric: value, delta to reference, band, flag."""
    entries = []
    for metric, g in GAUGES.items():
        value = F.coalesce(F.col(metric), F.lit(float(g.default)))
        band = F.when(value < g.low, "lightgreen").when(value < g.high, "yellow").otherwise("lightcoral")
        entries.append(
            F.struct(
                F.lit(metric).alias("metric"),
                value.alias("value"),
                (value - g.reference).alias("delta"),
                band.alias("band"),
                (value > g.threshold).alias("over_threshold"),
            )
        )
    return readings.select(*ids, F.inline(F.array(*entries)))


def latest_readings(readings: DataFrame, source: str, order: Sequence[str], keep: int = HISTORY) -> DataFrame:
    """The last ``keep`` readings of each source by ``order``."""
    newest_first = [F.desc(c) for c in order]
    return first_rows(readings, [source], newest_first, keep, rank="_age").drop("_age")


def metric_history(readings: DataFrame, source: str, order: Sequence[str], keep: int = HISTORY) -> DataFrame:
    """The kept readings as rows (source, reading_index, metric, value, over_line).

    The index counts from 0 for the oldest kept reading; a source with a
    single reading has no history.
    """
    numbered = first_rows(readings, [source], [F.desc(c) for c in order], keep, rank="_age").withColumn(
        "_kept", F.count("*").over(Window.partitionBy(source))
    )
    long = (
        numbered.where(F.col("_kept") >= 2)
        .withColumn("reading_index", (F.col("_kept") - F.col("_age")).cast("int"))
        .unpivot([source, "reading_index"], list(GAUGES), "metric", "value")
    )
    return long.withColumn("over_line", F.col("value") > WARNING_LINE)
