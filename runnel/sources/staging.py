"""Staged tables: a derived DataFrame written once, for operators that scan
their input several times (quantiles, extremes, the batch report).

Tables go to the shared folder named by ``spark.checkpoint.dir``, so a lost
executor costs a re-read and not a recomputation of the whole lineage.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_staged: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a folder in the warehouse if none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, remembered for ``release_staged``."""
    path = f"{shared_folder(spark).rstrip('/')}/runnel/{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _staged else None
    if spark is not None and spark.sparkContext._jsc is not None:
        release_staged(spark)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet and return the stored table.

    Select the needed columns first; only they are written. The table stays
    until ``release_staged`` or the end of the program.
    """
    return _written(df, staging_path(df.sparkSession, name))


def free_exchanges(spark: SparkSession) -> None:
    """Has Spark remove the shuffle files that no plan refers to any more.

    Spark's cleaner does so when the driver's memory is collected, which a driver
    with little to do may put off for half an hour. Call it after a large exchange was staged.
    """
    spark.sparkContext._jvm.System.gc()


@contextmanager
def staged(df: DataFrame, name: str = "table") -> Iterator[DataFrame]:
    """A staged table that is deleted at the end of the block."""
    path = staging_path(df.sparkSession, name)
    try:
        yield _written(df, path)
    finally:
        delete_path(df.sparkSession, path)
        paths = _staged.get(df.sparkSession.sparkContext.applicationId, [])
        if path in paths:
            paths.remove(path)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release_staged(spark: SparkSession) -> int:
    """Delete the tables this application staged; returns how many."""
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)
