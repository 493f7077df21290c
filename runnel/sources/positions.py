"""Where rows stood in the files they were read from.

A scan reads each file in splits and each split from its start on, so the file, the
split's start and the row's place in the partition put all rows of a scan in
input order, whatever the size of the splits. Line numbers follow from the
number of rows in each split: the splits are counted first, and a running sum over one row per split says
what stands before each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runnel.sources.staging import stage

#: The column that holds a row's place.
POSITION = "_position"
#: Splits that are sent to every task at most; beyond, rows meet their split in a shuffle.
SPLITS = 100_000


def input_position() -> Column:
    """Place of a row of a file scan, to be selected before any row is dropped; it can be ordered by, its parts are not stable."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )


def input_order(order: str | list[Column] | None, otherwise: list[Column]) -> list[Column]:
    """Sort columns of an ``order`` argument: ``"input"`` is the place in the input."""
    if isinstance(order, str):
        if order != "input":
            raise ValueError(f"no such order: {order}")
        return [F.col(POSITION)]
    return list(order or otherwise)


def number_lines(scan: DataFrame, name: str = "line") -> DataFrame:
    """A scan with ``POSITION`` and all its rows, with the number of each row, from 0, over all files by path.

    Runs a job that counts the rows of each split. Numbers do not depend on the size of the splits.
    """
    at = [F.col(f"{POSITION}.file").alias("_file"), F.col(f"{POSITION}.start").alias("_start")]
    counts = scan.select(*at, F.col(f"{POSITION}.row").alias("_row")).groupBy("_file", "_start").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    # One row per split.
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = stage(counts, "splits").select("_file", "_start", "_first", before.alias("_before"))
    if splits.count() <= SPLITS:
        splits = F.broadcast(splits)
    number = F.col("_before") + F.col(f"{POSITION}.row") - F.col("_first")
    return scan.select("*", *at).join(splits, ["_file", "_start"]).withColumn(name, number).drop("_file", "_start", "_first", "_before")
