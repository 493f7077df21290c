"""Bounded history of a stream of readings.

Every micro-batch is trimmed to the last readings per source, joined to the
kept ones and trimmed again, so a batch costs its own rows plus at most
``keep`` rows per source. The kept readings of batch n are the table
``batch=n`` under the history path: a repeated batch overwrites its own table
and reads the one before it, and a lost executor loses nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from runnel.sources.staging import delete_path
from runnel.streaming.readings import HISTORY, latest_readings


def _table(path: str, batch: int) -> str:
    return f"{path.rstrip('/')}/batch={batch}"


def history_writer(
    readings: DataFrame, path: str, source: str, order: Sequence[str], keep: int = HISTORY
) -> DataStreamWriter:
    """A stream writer that keeps the last ``keep`` readings per source at ``path``."""

    def keep_latest(rows: DataFrame, batch: int) -> None:
        merged = latest_readings(rows, source, order, keep)
        if batch > 0:
            before = rows.sparkSession.read.schema(rows.schema).parquet(_table(path, batch - 1))
            merged = latest_readings(before.unionByName(merged), source, order, keep)
        merged.write.mode("overwrite").parquet(_table(path, batch))
        if batch > 1:
            delete_path(rows.sparkSession, _table(path, batch - 2))

    return readings.writeStream.foreachBatch(keep_latest)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The readings kept after the newest batch that was written to its end."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    marks = system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch=*/_SUCCESS"))
    batches = [int(m.getPath().getParent().getName().removeprefix("batch=")) for m in marks or []]
    if not batches:
        raise ValueError(f"no finished batch under {path}")
    return spark.read.parquet(_table(path, max(batches)))
