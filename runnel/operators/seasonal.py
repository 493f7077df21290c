"""Monthly statistics over all sites, and variation within a site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.functions.values import all_present, positive, positive_sql, quoted
from runnel.operators.reshape import months_long
from runnel.schema import DEFAULT_ROLES, SiteRoles


def seasonal_stats(sites: DataFrame, roles: SiteRoles = DEFAULT_ROLES, digits: int | None = 6) -> DataFrame:
    """Mean, extremes, population deviation, count and sum per month.

    Only positive values count; a month without any gives no row. Sites with
    an unreadable coordinate or month are left out whole.
    """
    fields = [roles.x, roles.y, *roles.pollution_columns]
    readable = sites.where(all_present(fields))
    long = months_long(readable, [], roles.pollution_columns, roles.labels, value="v")
    stats = (
        long.where(positive("v"))
        .groupBy("month")
        .agg(
            F.avg("v").alias("average_pollution"),
            F.max("v").alias("max_pollution"),
            F.min("v").alias("min_pollution"),
            F.stddev_pop("v").alias("std_deviation"),
            F.count("v").alias("active_locations"),
            F.sum("v").alias("total_pollution"),
        )
    )
    if digits is None:
        return stats
    return stats.select(
        *[c if c in ("month", "active_locations") else F.round(c, digits).alias(c) for c in stats.columns]
    )


def with_seasonal_variance(sites: DataFrame, roles: SiteRoles = DEFAULT_ROLES) -> DataFrame:
    """Sites with ``variance``: the population variance of their positive months.

    It is 0 for a site with fewer than two of them.
    """

    def total(term: str) -> str:
        names = [quoted(c) for c in roles.pollution_columns]
        return " + ".join(f"case when {positive_sql(v)} then {term.format(v=v)} else 0D end" for v in names)

    # Count and mean are columns of their own, so each is computed once.
    centred = sites.withColumn("_n", F.expr(total("1D"))).withColumn(
        "_mean", F.expr(f"try_divide({total('{v}')}, _n)")
    )
    squares = total("({v} - _mean) * ({v} - _mean)")
    variance = F.expr(f"case when _n > 1 then ({squares}) / _n else 0D end")
    return centred.withColumn("variance", variance).drop("_n", "_mean")
