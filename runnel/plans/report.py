"""The batch report: all analyses over one site table, one report file each.

    python -m runnel.plans.report SITES.csv OUT_FOLDER [--positional]
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel.operators.correlation import correlation_report, site_correlations
from runnel.operators.hotspots import hotspots
from runnel.operators.seasonal import seasonal_stats
from runnel.operators.severity import severity_features, severity_report
from runnel.schema import DEFAULT_ROLES, POSITIONAL, SiteRoles
from runnel.sources.reports import write_report, write_report_file, write_text_file
from runnel.sources.sites import read_sites_positional
from runnel.sources.staging import staged


@dataclass(frozen=True)
class Analysis:
    """How one report is made and written."""

    run: Callable[[DataFrame, SiteRoles], DataFrame]
    key: Column
    order: Sequence[str]
    drop: tuple[str, ...] = ()
    #: Columns it reads besides those of the roles in ``used_columns``.
    columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Outcome:
    name: str
    path: str
    error: str | None = None


def analyses() -> dict[str, Analysis]:
    """The registered analyses; add an entry to a copy to extend the report."""
    return {
        "seasonal_analysis": Analysis(seasonal_stats, F.col("month"), ["month"], ("month",)),
        "hotspot_analysis": Analysis(
            lambda sites, roles: hotspots(sites, 0.1, 0.01, roles=roles), F.lit("HOTSPOT"), ["grid"]
        ),
        "severity_classification": Analysis(
            lambda sites, roles: severity_report(severity_features(sites, roles, variance=False)),
            F.col("category"), ["category"], ("category",),
        ),
        "correlation_analysis": Analysis(
            lambda sites, roles: correlation_report(site_correlations(sites, roles)),
            F.col("strength"), ["strength"], ("strength",),
        ),
    }


def used_columns(roles: SiteRoles) -> list[str]:
    single = [roles.x, roles.y, roles.mid, roles.high, roles.area]
    return list(dict.fromkeys([*single, *roles.pollution_columns, *roles.runoff_columns]))


def run_report(
    sites: DataFrame,
    folder: str,
    roles: SiteRoles = DEFAULT_ROLES,
    registry: Mapping[str, Analysis] | None = None,
    one_file: bool = False,
) -> list[Outcome]:
    """Run every analysis and write its report under ``folder``.

    The columns in use are staged once and the analyses run side by side. A
    failing analysis leaves the error text in place of its report and does not
    stop the others. A report is a folder of ordered parts, or with ``one_file`` the
    text file ``<analysis>.txt``, put in place when it is complete.
    """
    chosen = registry or analyses()
    columns = dict.fromkeys([*used_columns(roles), *(c for a in chosen.values() for c in a.columns)])

    def run(name: str, table: DataFrame) -> Outcome:
        analysis, path = chosen[name], f"{folder.rstrip('/')}/{name}{'.txt' if one_file else ''}"
        try:
            (write_report_file if one_file else write_report)(analysis.run(table, roles), path, analysis.key, analysis.order, analysis.drop)
            return Outcome(name, path)
        except Exception as error:  # noqa: BLE001 - reported in the file
            text = table.sparkSession.createDataFrame([(f"Error:\n{error}",)], "value string")
            write_text_file(text, path) if one_file else text.write.mode("overwrite").text(path)
            return Outcome(name, path, str(error))

    with (
        staged(sites.select(*columns), "report-sites") as table,
        ThreadPoolExecutor(max(1, len(chosen))) as pool,
    ):
        started = [pool.submit(inheritable_thread_target(sites.sparkSession)(run), name, table) for name in chosen]
        return [s.result() for s in started]


def main(arguments: list[str]) -> int:
    names = [a for a in arguments if not a.startswith("--")]
    if len(names) != 2:
        print(__doc__)
        return 1
    spark = SparkSession.builder.appName("runnel-report").getOrCreate()
    roles = SiteRoles(months=POSITIONAL) if "--positional" in arguments else DEFAULT_ROLES
    try:
        sites = read_sites_positional(spark, names[0])
        outcomes = run_report(sites, names[1], roles, one_file=True)
    except AnalysisException as error:
        print(f"cannot read {names[0]}: {error}")
        return 1
    for outcome in outcomes:
        print(f"{outcome.name}: {outcome.error or outcome.path}")
    return int(any(o.error for o in outcomes))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
