"""What the modules that bind operators to the test tables share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def registry(queries: dict[str, Query]) -> Callable[[Query], Query]:
    """A decorator that enters a query under its name."""

    def query(function: Query) -> Query:
        queries[function.__name__] = function
        return function

    return query


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Double columns (or those named) rounded."""
    chosen = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in chosen})


def joined(df: DataFrame, name: str = "sample_locations") -> DataFrame:
    """An array column as one text."""
    return df.withColumn(name, F.array_join(name, ";"))
