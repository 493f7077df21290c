"""The driver's test tables in the roles of a site table and of readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel.schema import ESTIMATES, MONTHS, SITE_COLUMNS

#: Cents per unit of the estimates. A prime, so that rounded means do not tie.
SCALE = 4_999_999.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One site per part, with an extra ``site_id``.

    Monthly estimates are the part's sales per ship month (exact sums of
    cents), runoff is the quantity, weight and area come from the part. One
    part in 17 lacks its mid estimate, one in 13 has zero estimates and one in
    ten sizes has no area. Sites share coordinates once there are 800 parts.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        F.month("l_shipdate").alias("month"),
        F.floor(F.col("l_extendedprice") * 100 + 0.5).alias("cents"),
        F.col("l_quantity").cast("bigint").alias("pieces"),
    )

    def per_month(value: str) -> list[Column]:
        # FILTER keeps the generated update code of the 24 sums short.
        return [
            F.expr(f"coalesce(sum({value}) filter (where month = {i}), 0)").alias(f"{value}_{m}")
            for i, m in enumerate(MONTHS, 1)
        ]

    totals = lines.groupBy("l_partkey").agg(
        F.sum("cents").alias("cents"), *per_month("cents"), *per_month("pieces")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    k, year = "l_partkey", f"cast(cents as double) / {SCALE!r}D"
    factor = {"mid": "", "low": " * 0.5D", "high": " * 2D"}
    values = {
        "X": f"cast({k} * 7919 % 200 - 100 as double) / 10D",
        "Y": f"cast({k} * 104729 % 160 - 80 as double) / 10D",
        "mpw": "p_retailprice",
        "area": "cast(case when p_size % 10 = 0 then 0 else p_size end as double) * 1000000D",
    }
    for e in ESTIMATES:
        annual = f"case when {k} % 13 = 0 then 0D else {year}{factor[e]} end"
        values[f"i_{e}"] = f"case when {k} % 17 != 0 then {annual} end" if e == "mid" else annual
        for m in MONTHS:
            values[f"i_{e}_{m}"] = f"cast(cents_{m} as double) / {SCALE!r}D{factor[e]}"
    for m in MONTHS:
        values[f"runoff_{m}"] = f"cast(pieces_{m} as double)"
    return totals.join(parts, F.expr(f"{k} = p_partkey")).selectExpr(
        f"{k} as site_id", *[f"{values[c]} as `{c}`" for c in SITE_COLUMNS]
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric reading per event; the user is the source."""
    return reading_columns(table(spark, sf_dir, "events"))


def reading_columns(events: DataFrame) -> DataFrame:
    v = F.col("value")
    return events.select(
        F.col("user_id").alias("source"),
        F.col("event_id").alias("reading_id"),
        "ts",
        F.least(v / 1.0007, F.lit(100.0)).alias("cpu_percent"),
        F.when(F.col("event_id") % 11 != 0, F.least(v / 1.2503, F.lit(100.0))).alias("memory_percent"),
        F.least(v / 2.0 + 30.0, F.lit(95.0)).alias("cpu_temp"),
        F.least(v * 0.6 + 25.0, F.lit(95.0)).alias("gpu_temp"),
    )
