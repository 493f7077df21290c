"""Limits of metrics as a table: per source and metric, from a time on.

A limit holds from ``valid_from`` until the next one of its source and metric. A row
without a source holds for every source that has none of its own at that time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runnel.streaming.readings import ALERT_LIMITS, STATUS_LIMITS

#: Limits that are sent to every task at most; more of them meet the readings in a shuffle.
SMALL = 100_000


def default_limits(spark: SparkSession, source_type: str = "bigint") -> DataFrame:
    """The fixed limits as a table that holds for all sources at all times."""
    rows = [(None, m, None, float(w), float(c)) for m, (w, c) in STATUS_LIMITS.items()]
    rows += [(None, m, None, float(limit), None) for m, limit in ALERT_LIMITS.items() if m not in STATUS_LIMITS]
    return spark.createDataFrame(rows, f"source {source_type}, metric string, valid_from timestamp_ntz, warning double, critical double")


def validity(limits: DataFrame) -> DataFrame:
    """Limits with ``valid_until``, which is the next limit's start and no longer included.

    No start means from ever. Of several limits with one start the one with the largest
    values holds.
    """
    key = ["source", "metric"]
    newest = Window.partitionBy(*key, "valid_from").orderBy(F.desc("warning"), F.desc("critical"))
    once = limits.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
    return once.withColumn("valid_until", F.lead("valid_from").over(Window.partitionBy(*key).orderBy(F.asc_nulls_first("valid_from"))))


def with_limits(readings: DataFrame, limits: DataFrame, metrics: Sequence[str], ids: Sequence[str], source: str = "source", ts: str = "ts") -> DataFrame:
    """(ids..., metric, value, warning, critical): a row per reading and metric, with the limits that held at its time.

    ``ids`` identify a reading and contain source and time. Readings without limits have NULL. Each reading meets the few
    limits of its own source and metric, and the general ones; a reading of a busy source is joined like any other,
    in tasks that Spark may split.
    """
    periods = validity(limits.select("source", "metric", "valid_from", "warning", "critical"))
    if periods.count() <= SMALL:
        periods = F.broadcast(periods)
    long = readings.unpivot(list(ids), list(metrics), "metric", "value")

    def held(table: DataFrame, own: bool) -> DataFrame:
        prefix = "own" if own else "all"
        chosen = table.where(F.col("source").isNotNull() if own else F.col("source").isNull())
        return chosen.select(
            *([F.col("source").alias("_source")] if own else []), F.col("metric").alias("_metric"), F.col("valid_from").alias("_from"), F.col("valid_until").alias("_until"),
            F.struct("warning", "critical").alias(prefix),
        )

    now = (F.col("_from").isNull() | (F.col("_from") <= F.col(ts))) & (F.col("_until").isNull() | (F.col(ts) < F.col("_until")))
    mine = (F.col("_metric") == F.col("metric")) & (F.col("_source") == F.col(source)) & now
    rest = (F.col("_metric") == F.col("metric")) & now
    met = long.join(held(periods, True), mine, "left").drop("_source", "_metric", "_from", "_until")
    met = met.join(held(periods, False), rest, "left").drop("_metric", "_from", "_until")
    found = F.coalesce("own", "all")
    return met.select(*ids, "metric", "value", found["warning"].alias("warning"), found["critical"].alias("critical"))
