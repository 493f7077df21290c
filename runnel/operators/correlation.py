"""Runoff and pollution: correlation per site and strength classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.functions.text import site_key
from runnel.functions.values import all_present, positive, positive_sql, quoted
from runnel.operators.groups import sample_lists
from runnel.schema import DEFAULT_ROLES, SiteRoles

# Lower limits of the strength classes, strongest first.
STRENGTHS = ((0.7, "STRONG"), (0.4, "MODERATE"), (0.2, "WEAK"))


def pair_sums(sites: DataFrame, roles: SiteRoles = DEFAULT_ROLES) -> DataFrame:
    """Per input row: count and moment sums of the months with both sides positive.

    The sums are plain expressions over the month columns, so no row is
    multiplied by twelve before the grouping.
    """
    fields = [roles.x, roles.y, *roles.pollution_columns, *roles.runoff_columns]
    masked = []
    for label, p, r in roles.months:
        both = f"{positive_sql(quoted(p))} and {positive_sql(quoted(r))}"
        masked.append(f"case when {both} then {quoted(p)} else 0D end as `p_{label}`")
        masked.append(f"case when {both} then {quoted(r)} else 0D end as `r_{label}`")

    def total(term: str) -> str:
        return " + ".join(term.format(p=f"`p_{label}`", r=f"`r_{label}`") for label in roles.labels)

    x, y = quoted(roles.x), quoted(roles.y)
    return (
        sites.where(all_present(fields))
        .selectExpr(f"{x} as x", f"{y} as y", *masked)
        .selectExpr(
            "x",
            "y",
            f"cast({total('signum({p})')} as bigint) as n",
            f"{total('{p}')} as sp",
            f"{total('{r}')} as sr",
            f"{total('{p} * {p}')} as spp",
            f"{total('{r} * {r}')} as srr",
            f"{total('{p} * {r}')} as spr",
        )
    )


def site_correlations(sites: DataFrame, roles: SiteRoles = DEFAULT_ROLES, min_pairs: int = 3) -> DataFrame:
    """Pearson r per site over the pooled month pairs of its rows.

    Rows with fewer than ``min_pairs`` pairs add nothing; a site whose
    variance product is not positive gives no row.
    """
    # The row test sits inside the sums: as a filter over twelve months of
    # expressions it would be pushed down and cost long planning times.
    sums = [
        F.expr(f"sum({c}) filter (where n >= {int(min_pairs)}) as {c}")
        for c in ("n", "sp", "sr", "spp", "srr", "spr")
    ]
    pooled = pair_sums(sites, roles).groupBy("x", "y").agg(*sums)
    spread = F.expr("(n * spp - sp * sp) * (n * srr - sr * sr)")
    return (
        pooled.withColumn("spread", spread)
        .where(positive("spread"))
        .selectExpr(
            "x",
            "y",
            "round((n * spr - sp * sr) / sqrt(spread), 4) as correlation",
            "n as data_points",
            "round(sp / n, 6) as avg_pollution",
            "round(sr / n, 6) as avg_runoff",
        )
    )


def correlation_strength(r: Column | str) -> Column:
    size = F.abs(F.col(r) if isinstance(r, str) else r)
    label = F.lit("NEGLIGIBLE")
    for limit, name in reversed(STRENGTHS):
        label = F.when(size >= limit, name).otherwise(label)
    return label


def correlation_report(correlations: DataFrame, samples: int = 5) -> DataFrame:
    """Sites, signs and means per strength class, from the rounded site values.

    A site whose r rounds to zero counts in neither sign. Samples are the
    first sites by key text.
    """
    classed = correlations.select(
        "*", correlation_strength("correlation").alias("strength"), site_key("x", "y").alias("location")
    )
    means = classed.groupBy("strength").agg(
        F.count("*").alias("total_locations"),
        F.count_if(F.col("correlation") > 0).alias("positive_correlations"),
        F.count_if(F.col("correlation") < 0).alias("negative_correlations"),
        F.round(F.avg("correlation"), 4).alias("avg_correlation"),
        F.round(F.avg("avg_pollution"), 6).alias("avg_pollution"),
        F.round(F.avg("avg_runoff"), 6).alias("avg_runoff"),
    )
    listed = sample_lists(classed, ["strength"], [F.col("location")], F.col("location"), samples)
    return means.join(listed, "strength")
