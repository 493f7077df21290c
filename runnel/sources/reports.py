"""Report files: lines of ``"KEY"<TAB>{json}``."""

from __future__ import annotations

import uuid
from typing import Literal, NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from runnel.functions.text import json_object
from runnel.functions.values import parse_float_sql
from runnel.sources.staging import delete_path

HOTSPOT_POINT_SCHEMA = "latitude double, longitude double, hotspot_score double, grid string"


def report_lines(df: DataFrame, key: Column, order: list[str | Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """One text column ``value``: the rows as report lines, in order."""
    fields = [f for f in df.schema.fields if f.name not in drop]
    line = F.concat(F.lit('"'), key, F.lit('"\t'), json_object(fields))
    return df.orderBy(*order).select(line.alias("value"))


def write_report(
    df: DataFrame, path: str, key: Column, order: list[str | Column], drop: tuple[str, ...] = ()
) -> None:
    """Write report lines, replacing what the path holds.

    The lines are range-sorted, so reading the part files by name gives the
    whole report in order.
    """
    report_lines(df, key, order, drop).write.mode("overwrite").text(path)


def write_text_file(lines: DataFrame, path: str) -> None:
    """Write ordered lines as one text file at ``path``, which is there whole or not at all.

    Spark writes sorted parts next to it; the file system joins them, a buffer at a time, and
    renames the result. Readers see the file before or the one after. For
    results of many gigabytes take ``write_report``, whose parts stay apart.
    """
    spark, made = lines.sparkSession, uuid.uuid4().hex
    parts, whole = f"{path}.{made}.parts", f"{path}.{made}.part"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    try:
        lines.write.text(parts)
        out = system.create(hadoop.fs.Path(whole))
        try:
            found = sorted((s.getPath() for s in system.listStatus(hadoop.fs.Path(parts)) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
            for part in found:
                piece = system.open(part)
                try:
                    hadoop.io.IOUtils.copyBytes(piece, out, conf, False)
                finally:
                    piece.close()
        finally:
            out.close()
        system.delete(target, True)
        if not system.rename(hadoop.fs.Path(whole), target):
            raise OSError(f"cannot rename the report to {path}")
    finally:
        delete_path(spark, parts)
        delete_path(spark, whole)


def write_report_file(df: DataFrame, path: str, key: Column, order: list[str | Column], drop: tuple[str, ...] = ()) -> None:
    """Write report lines as one ordered text file, replacing what the path holds."""
    write_text_file(report_lines(df, key, order, drop), path)


#: Why a report line, or a part of it, is left out.
REASONS = ("no tab", "bad json", "missing key", "bad coordinate")


class HotspotPoints(NamedTuple):
    points: DataFrame
    rejects: DataFrame


def _once(df: DataFrame, *columns: str | Column) -> DataFrame:
    """A select whose columns are worked out once a row.

    Spark puts a column's text in place of its name in later filters and moves these below joins and
    aggregates, so costly columns would be worked out again there, for every use of every name. It does not
    with what a generator makes.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def parse_hotspot_lines(lines: DataFrame, observation: Observation | None = None) -> HotspotPoints:
    """Sample points of hotspot report lines, and the lines that have faults.

    A line without a tab or with bad JSON gives no points. A bad coordinate
    ends its line; points before it are kept. Rejects carry the line and a
    ``reason``. An ``observation`` counts, while the points are read, the ``lines`` and those of each
    reason, under its name with ``_`` for spaces.
    """
    schema = "grid string, hotspot_score double, sample_locations array<string>, _bad string"
    parts = F.split(F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")), "\t")
    parsed = _once(
        lines,
        "value",
        F.size(parts).alias("n_parts"),
        F.from_json(F.get(parts, F.lit(1)), schema, {"columnNameOfCorruptRecord": "_bad"}).alias("j"),
    )

    first, second = parse_float_sql("get(xy, 0)"), parse_float_sql("get(xy, 1)")
    good = f"size(xy) = 2 and ({first}) is not null and ({second}) is not null"
    point = f"case when {good} then named_struct('latitude', {second}, 'longitude', {first}) end"
    placed = _once(parsed, "value", "n_parts", "j", F.expr(f"transform(transform(j.sample_locations, t -> split(t, ',')), xy -> {point})").alias("pairs"))
    first_bad = F.array_position(F.transform("pairs", lambda p: p.isNull()), F.lit(True))
    tested = _once(
        placed,
        "value",
        F.col("j.grid").alias("grid"),
        F.col("j.hotspot_score").alias("hotspot_score"),
        F.when(first_bad > 0, F.slice("pairs", F.lit(1), (first_bad - 1).cast("int")))
        .otherwise(F.col("pairs"))
        .alias("pairs"),
        F.when(F.col("n_parts") < 2, "no tab")
        .when(F.col("j._bad").isNotNull() | F.col("j").isNull(), "bad json")
        .when(F.col("j.sample_locations").isNull(), "missing key")
        .when(
            (F.size("j.sample_locations") > 0)
            & (F.col("j.hotspot_score").isNull() | F.col("j.grid").isNull()),
            "missing key",
        )
        .when(first_bad > 0, "bad coordinate")
        .alias("reason"),
    )
    watched = tested
    if observation is not None:
        # The rejects come from a scan of their own; the counters belong to that of the points.
        by_reason = [F.count_if(F.col("reason") == r).alias(r.replace(" ", "_")) for r in REASONS]
        watched = tested.observe(observation, F.count("*").alias("lines"), *by_reason)
    kept = F.col("reason").isNull() | (F.col("reason") == "bad coordinate")
    points = watched.where(kept).select("grid", "hotspot_score", F.inline("pairs"))
    rejects = tested.where(F.col("reason").isNotNull()).select(F.col("value").alias("line"), "reason")
    return HotspotPoints(points.select("latitude", "longitude", "hotspot_score", "grid"), rejects)


def read_hotspot_points(
    spark: SparkSession, path: str | list[str], on_error: Literal["empty", "raise", "skip"] = "empty",
    observation: Observation | None = None,
) -> DataFrame:
    """Sample points of a stored hotspot report.

    ``on_error`` says what a missing file or a line with a missing JSON key
    does: give no points at all, raise, or (keys only) skip that line. An ``observation``
    counts the lines that are left out, by reason, while the points are read.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        if on_error == "raise":
            raise
        return spark.createDataFrame([], HOTSPOT_POINT_SCHEMA)
    found = parse_hotspot_lines(lines, observation)
    if on_error == "skip":
        return found.points
    missing_key = found.rejects.where(F.col("reason") == "missing key")
    if on_error == "raise":
        bad = missing_key.first()
        if bad is not None:
            raise ValueError(f"report line without its keys: {bad['line']}")
        return found.points
    faults = missing_key.agg(F.count("*")).scalar()
    return found.points.where(faults == 0)
