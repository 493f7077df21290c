"""Site files: by header name, or by position with a width check."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runnel.functions.values import nan_to_null, parse_float, parse_float_sql, quoted, to_number_sql
from runnel.schema import MONTHS, SITE_COLUMNS, SITE_SCHEMA
from runnel.sources.positions import POSITION, input_position
from runnel.sources.types import infer_types, with_types


def repair_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns to numbers: commas dropped, bad text missing.

    Columns that are numeric already stay as they are.
    """
    text = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: nan_to_null(to_number_sql(quoted(c))) for c in text})


def coerce_number(df: DataFrame, column: str) -> DataFrame:
    """One column to double; text that is no number becomes missing."""
    return df.withColumn(column, nan_to_null(f"try_cast({quoted(column)} as double)"))


def _by_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files as text columns, by name: files with unlike headers are read apart and put together."""
    reader = spark.read.option("header", True).option("escape", '"')
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    first = lines.where("block = 0").withColumn("place", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "place").alias("header"))
    # One row per header, with its files.
    kinds = first.groupBy("header").agg(F.collect_list("file").alias("files")).orderBy("header").collect()
    if len(kinds) < 2:
        return reader.csv(path)
    tables = [reader.csv(sorted(kind.files)) for kind in kinds]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def read_sites(
    spark: SparkSession,
    path: str | list[str],
    missing_months: Literal["error", "skip"] = "error",
    on_error: Literal["raise", "empty"] = "raise",
    further: Literal["infer", "text"] | Mapping[str, str] = "infer",
    observation: Observation | None = None,
) -> DataFrame:
    """Read site files by header name, each file by its own header.

    Site columns come back as doubles with NULL for missing, bad and NaN text;
    the monthly mid estimates may carry thousands commas. A further column gets the
    narrowest type that all its values in all files have (boolean, bigint,
    double, timestamp_ntz or string), found in one scan when this is called; name the types, or ask for
    ``"text"``, to do without that scan. A missing month column is an error unless ``missing_months="skip"``;
    a missing file is one unless ``on_error="empty"``. An ``observation`` counts, while the
    result is read, its rows and the texts of each site column that are no number (``bad_<column>``).
    """
    try:
        raw = _by_header(spark, path)
    except AnalysisException as error:
        if on_error == "raise" or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SITE_SCHEMA)
    month_columns = [f"i_mid_{m}" for m in MONTHS]
    absent = [c for c in month_columns if c not in raw.columns]
    if absent and missing_months == "error":
        raise ValueError(f"month columns not in the file: {', '.join(absent)}")
    known = [c for c in SITE_COLUMNS if c in raw.columns]
    numbers = {c: to_number_sql(c) if c in month_columns else f"try_cast({c} as double)" for c in known}
    if observation is not None:
        bad = [F.expr(f"count_if({c} is not null and ({n}) is null)").alias(f"bad_{c}") for c, n in numbers.items()]
        raw = raw.observe(observation, F.count("*").alias("rows"), *bad)
    others = [c for c in raw.columns if c not in SITE_COLUMNS]
    if further == "infer":
        # The scan for the types carries no counters.
        further = infer_types(_by_header(spark, path), others)
    typed = raw if further == "text" else with_types(raw, {c: t for c, t in further.items() if c in others})
    typed = typed.withColumns({c: nan_to_null(n) for c, n in numbers.items()})
    return typed.select(*[F.col(c).alias(c, metadata=SITE_SCHEMA[c].metadata) if c in known else c for c in raw.columns])


def read_sites_positional(spark: SparkSession, path: str | list[str], position: bool = False, observation: Observation | None = None) -> DataFrame:
    """Read site files by position, one line per record.

    Lines that start with ``X`` and lines with fewer than 55 fields are left
    out; fields past the 55th are ignored. A field that is no number is NULL
    and a field that says ``nan`` is NaN: the analyses drop a row for the
    first, but only skip the value for the second. ``position`` adds the row's place in
    the input as ``POSITION``. An ``observation`` counts, while the result is read,
    ``lines``, and those that are ``header``, ``narrow``, ``wide`` (with further fields) and, among the kept ones, ``bad_number``.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*SITE_COLUMNS, "_line")])
    raw = (
        spark.read.schema(schema)
        .option("columnNameOfCorruptRecord", "_line")
        # The width check needs whole lines, also when few columns are used.
        .option("columnPruning", False)
        .option("escape", '"')
        .csv(path)
    )
    # _line is set where the width is not 55; quoted text may hold commas.
    separators = F.regexp_count(F.regexp_replace("_line", r'"([^"]|"")*"', ""), F.lit(","))
    wide_enough = F.col("_line").isNull() | (separators >= len(SITE_COLUMNS) - 1)
    first = F.coalesce(F.col(SITE_COLUMNS[0]), F.lit(""))
    header = first.startswith("X")
    kept = wide_enough & ~header
    place = [POSITION] if position else []
    if position:
        raw = raw.select("*", input_position().alias(POSITION))
    if observation is not None:
        bad = F.expr(" or ".join(f"({parse_float_sql(c)}) is null" for c in SITE_COLUMNS))
        raw = raw.observe(
            observation,
            F.count("*").alias("lines"),
            F.count_if(header).alias("header"),
            F.count_if(~wide_enough & ~header).alias("narrow"),
            F.count_if(kept & F.col("_line").isNotNull()).alias("wide"),
            F.count_if(kept & bad).alias("bad_number"),
        )
    return raw.where(kept).select(*[parse_float(c).alias(c, metadata=SITE_SCHEMA[c].metadata) for c in SITE_COLUMNS], *place)
