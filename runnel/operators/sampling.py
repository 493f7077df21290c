"""Row samples and previews."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PREFIX = 4  # hexadecimal digits of the hash that the histogram counts


def require_rows(df: DataFrame, what: str = "table") -> None:
    """Raise when there is no row."""
    if df.isEmpty():
        raise ValueError(f"the {what} is empty")


def sample_rows(df: DataFrame, key: Sequence[str], size: int = 1500, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows (all when fewer), the same ones on every run.

    Rows are picked in the order of a seeded hash of their unique ``key``. A
    count per hash prefix finds how far that order must be read, so only about
    ``size`` rows are sorted and not ``size`` per task. They end in one task, so
    ``size`` must fit there.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    hashed = df.withColumn("_hash", digest)
    prefix = F.substring("_hash", 1, _PREFIX)
    counts = hashed.groupBy(prefix.alias("prefix")).count().toArrow().sort_by("prefix")
    reached = pc.greater_equal(pc.cumulative_sum(counts["count"]), size).index(True).as_py()
    near = hashed if reached < 0 else hashed.where(prefix <= counts["prefix"][reached].as_py())
    return near.orderBy("_hash").limit(size).drop("_hash")


def sample_share(df: DataFrame, key: Sequence[str], size: int = 1000, seed: int = 42) -> DataFrame:
    """The share of the rows that makes ``size`` of them (all when fewer); an empty table is an error.

    The same rows for every partitioning, as in ``sample_rows``.
    """
    require_rows(df)
    return sample_rows(df, key, size, seed)


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by a declared order."""
    return df.orderBy(*order).limit(n)
