"""Every operator bound to the test tables, as (spark, sf_dir) -> DataFrame.

Results are rounded where sums depend on the order of addition. Operators that
scan their input several times get a staged table of the columns they use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runnel.functions.text import fixed, month_label, month_title, site_key
from runnel.functions.values import clamp, density, to_number_sql
from runnel.operators import (
    correlation,
    hotspots,
    panels,
    quality,
    reshape,
    sampling,
    seasonal,
    severity,
    stats,
)
from runnel.operators.order_stats import quantiles
from runnel.plans import report, tables
from runnel.plans.binding import Query, joined, registry, rounded
from runnel.schema import DEFAULT_ROLES, POSITIONAL, SITE_COLUMNS, SiteRoles, describe_columns
from runnel.sources import reports, sites as site_files
from runnel.sources.staging import stage, staging_path
from runnel.streaming import history, readings

ROLES = DEFAULT_ROLES
POSITIONAL_ROLES = SiteRoles(months=POSITIONAL)
MID_MONTHS = ROLES.pollution_columns
_registry: dict[str, Query] = {}
query = registry(_registry)


def registered() -> dict[str, Query]:
    return dict(_registry)


def staged(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    sites = tables.sites(spark, sf_dir)
    return stage(sites.select(*columns) if columns else sites, "sites")


def coordinates(*more: str) -> list[str]:
    return ["site_id", "X", "Y", *more]


# Monthly statistics ---------------------------------------------------------


@query
def seasonal_stats(spark: SparkSession, d: str) -> DataFrame:
    return seasonal.seasonal_stats(tables.sites(spark, d))


@query
def seasonal_stats_positional(spark: SparkSession, d: str) -> DataFrame:
    return seasonal.seasonal_stats(tables.sites(spark, d), POSITIONAL_ROLES)


@query
def seasonal_variance(spark: SparkSession, d: str) -> DataFrame:
    varied = seasonal.with_seasonal_variance(tables.sites(spark, d), ROLES)
    return varied.select("site_id", F.round("variance", 6).alias("variance"))


@query
def monthly_totals(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reshape.monthly_totals(tables.sites(spark, d), MID_MONTHS), 5)


@query
def monthly_mean_runoff(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reshape.monthly_means(tables.sites(spark, d), ROLES.runoff_columns))


@query
def months_long(spark: SparkSession, d: str) -> DataFrame:
    named = reshape.months_long(
        tables.sites(spark, d), ["site_id"], MID_MONTHS, MID_MONTHS, name="name", value="monthly_input"
    )
    labelled = named.withColumn("month", month_label("name"))
    return labelled.select("site_id", "month", month_title("month").alias("title"), "monthly_input")


@query
def month_pairs(spark: SparkSession, d: str) -> DataFrame:
    return reshape.month_pairs(tables.sites(spark, d), ["site_id"], ROLES.months)


# Hotspots -------------------------------------------------------------------


@query
def grid_points(spark: SparkSession, d: str) -> DataFrame:
    points = hotspots.grid_points(tables.sites(spark, d), 0.5, keep=["site_id"])
    return points.select("site_id", hotspots.cell_name(0.5).alias("grid"), site_key("x", "y").alias("location"), "pollution", "density")


@query
def site_density(spark: SparkSession, d: str) -> DataFrame:
    return tables.sites(spark, d).select("site_id", density("i_mid", "area").alias("density"))


@query
def hotspot_cells(spark: SparkSession, d: str) -> DataFrame:
    return joined(hotspots.hotspots(tables.sites(spark, d), grid_size=0.5))


@query
def hotspot_cells_fine(spark: SparkSession, d: str) -> DataFrame:
    return joined(hotspots.hotspots(tables.sites(spark, d), grid_size=0.1, pollution_threshold=0.01))


# Severity -------------------------------------------------------------------


def _severity_features(spark: SparkSession, d: str, *keep: str) -> DataFrame:
    return stage(severity.severity_features(tables.sites(spark, d), keep=keep, variance=False), "features")


@query
def severity_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return severity.severity_thresholds(_severity_features(spark, d)).frame(spark)


@query
def severity_sites(spark: SparkSession, d: str) -> DataFrame:
    features = stage(severity.severity_features(tables.sites(spark, d), keep=["site_id"]), "features")
    classed = severity.classify_severity(features, severity.severity_thresholds(features))
    return rounded(classed.select("site_id", "pollution", "density", "variance", "category"), 6, "variance")


@query
def severity_report(spark: SparkSession, d: str) -> DataFrame:
    return joined(severity.severity_report(_severity_features(spark, d)))


# Correlation ----------------------------------------------------------------


@query
def correlation_sites(spark: SparkSession, d: str) -> DataFrame:
    return correlation.site_correlations(tables.sites(spark, d))


@query
def correlation_report(spark: SparkSession, d: str) -> DataFrame:
    return joined(correlation.correlation_report(correlation.site_correlations(tables.sites(spark, d))))


@query
def correlation_report_positional(spark: SparkSession, d: str) -> DataFrame:
    sites = correlation.site_correlations(tables.sites(spark, d), POSITIONAL_ROLES)
    return joined(correlation.correlation_report(sites))


@query
def correlation_matrix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.correlation_matrix(staged(spark, d), list(SITE_COLUMNS)))


# Summaries and quality ------------------------------------------------------


@query
def numeric_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.numeric_summary(staged(spark, d), list(SITE_COLUMNS)).drop("position"), 5)


@query
def missing_by_column(spark: SparkSession, d: str) -> DataFrame:
    return quality.missing_by_column(tables.sites(spark, d))


@query
def missing_total(spark: SparkSession, d: str) -> DataFrame:
    return quality.missing_total(tables.sites(spark, d))


@query
def described_columns(spark: SparkSession, d: str) -> DataFrame:
    missing = quality.missing_by_column(tables.sites(spark, d), SITE_COLUMNS)
    return describe_columns(spark).join(missing, "column")


@query
def table_shape(spark: SparkSession, d: str) -> DataFrame:
    return quality.table_shape(tables.sites(spark, d).select(*SITE_COLUMNS))


@query
def completeness(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.completeness(tables.sites(spark, d)))


@query
def clean_sites(spark: SparkSession, d: str) -> DataFrame:
    return quality.clean_sites(tables.sites(spark, d)).select(*coordinates("i_mid"))


@query
def quantile_95(spark: SparkSession, d: str) -> DataFrame:
    (q95,) = quantiles(staged(spark, d, "i_mid"), ["i_mid"], [0.95])["i_mid"]
    return spark.createDataFrame([("i_mid", round(q95, 6))], "column string, q95 double")


@query
def quantile_vector(spark: SparkSession, d: str) -> DataFrame:
    at = panels.CONCENTRATION_QUANTILES
    values = quantiles(staged(spark, d, "i_mid", "i_high"), ["i_mid", "i_high"], at)
    rows = [(c, p, round(v, 6)) for c, found in values.items() for p, v in zip(at, found)]
    return spark.createDataFrame(rows, "column string, probability double, value double")


@query
def month_distribution(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.month_distribution(staged(spark, d, *MID_MONTHS), MID_MONTHS))


@query
def high_estimate_histogram(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.histogram(tables.sites(spark, d), "i_high", 30))


@query
def high_estimate_extremes(spark: SparkSession, d: str) -> DataFrame:
    return stats.extremes(tables.sites(spark, d), "i_high")


@query
def largest_site(spark: SparkSession, d: str) -> DataFrame:
    sites = tables.sites(spark, d).select(*coordinates("i_mid"))
    return stats.row_of_maximum(sites, "i_mid", ["X", "Y", "site_id"])


@query
def trend_surface(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.trend_surface(tables.sites(spark, d), min_points=100))


# Panels ---------------------------------------------------------------------


def _top(spark: SparkSession, d: str) -> DataFrame:
    return panels.top_sites(tables.sites(spark, d), ties=["site_id"])


@query
def top_sites(spark: SparkSession, d: str) -> DataFrame:
    return _top(spark, d)


@query
def top_sites_view(spark: SparkSession, d: str) -> DataFrame:
    return rounded(panels.map_view(_top(spark, d)))


@query
def top_sites_scaled(spark: SparkSession, d: str) -> DataFrame:
    return rounded(panels.scaled_markers(_top(spark, d), ties=["site_id"]))


@query
def top_sites_colored(spark: SparkSession, d: str) -> DataFrame:
    return rounded(panels.colored_markers(_top(spark, d), ties=["site_id"]), 6, "intensity", "radius")


@query
def heat_points(spark: SparkSession, d: str) -> DataFrame:
    return panels.heat_points(tables.sites(spark, d), keep=["site_id"])


@query
def heat_points_capped(spark: SparkSession, d: str) -> DataFrame:
    sites = staged(spark, d, *coordinates("i_mid"))
    return rounded(panels.heat_points_capped(sites, keep=["site_id"]), 6, "weight")


@query
def heat_center(spark: SparkSession, d: str) -> DataFrame:
    return rounded(panels.heat_center(tables.sites(spark, d)))


@query
def nonzero_sites(spark: SparkSession, d: str) -> DataFrame:
    return panels.nonzero_sites(tables.sites(spark, d)).select(*coordinates("i_mid", "i_low", "i_high"))


@query
def top_sites_by_month(spark: SparkSession, d: str) -> DataFrame:
    return panels.top_sites_by_month(tables.sites(spark, d), 20, ties=["site_id"])


@query
def top_sites_by_month_short(spark: SparkSession, d: str) -> DataFrame:
    return panels.top_sites_by_month(tables.sites(spark, d), 15, ties=["site_id"])


@query
def month_axis_limit(spark: SparkSession, d: str) -> DataFrame:
    top = panels.top_sites_by_month(tables.sites(spark, d), 15, ties=["site_id"])
    return rounded(panels.axis_limit(top))


@query
def severity_table(spark: SparkSession, d: str) -> DataFrame:
    return rounded(panels.severity_table(tables.sites(spark, d), keep=["site_id"]), 6, "marker_size")


@query
def weight_vs_runoff(spark: SparkSession, d: str) -> DataFrame:
    return panels.weight_vs_runoff(tables.sites(spark, d), keep=["site_id"])


@query
def risk_table(spark: SparkSession, d: str) -> DataFrame:
    scored = panels.risk_table(tables.sites(spark, d), keep=["site_id"])
    return scored.withColumns({"risk": F.round("risk", 9), "marker_size": F.round("marker_size", 6)})


@query
def area_vs_weight(spark: SparkSession, d: str) -> DataFrame:
    return panels.area_vs_weight(tables.sites(spark, d), keep=["site_id"])


@query
def runoff_long(spark: SparkSession, d: str) -> DataFrame:
    return panels.runoff_long(tables.sites(spark, d), keep=["site_id"])


def _concentration(spark: SparkSession, d: str) -> DataFrame:
    return panels.concentration_points(staged(spark, d, *coordinates("i_mid")), keep=["site_id"])


@query
def concentration_points(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_concentration(spark, d), 6, "log_concentration", "size_factor")


@query
def concentration_counts(spark: SparkSession, d: str) -> DataFrame:
    return panels.class_counts(_concentration(spark, d))


@query
def concentration_labels(spark: SparkSession, d: str) -> DataFrame:
    texts = panels.hover_text(_concentration(spark, d))
    return texts.select("site_id", "location_text", "concentration_text", "log_text")


# Samples --------------------------------------------------------------------


@query
def sample_share(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sample_share(staged(spark, d, *coordinates("i_mid")), ["site_id"], 1000, seed=42)


@query
def sample_rows(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sample_rows(staged(spark, d, *coordinates("i_mid")), ["site_id"], 1500)


@query
def first_sites(spark: SparkSession, d: str) -> DataFrame:
    return sampling.head(tables.sites(spark, d).select(*coordinates("i_mid")), 20, ["X", "Y", "site_id"])


# Files ----------------------------------------------------------------------


def _comma_text(c: str) -> Column:
    """A value as text with thousands commas."""
    return F.format_number(F.col(c) * 1000, 4)


@query
def sites_by_name_file(spark: SparkSession, d: str) -> DataFrame:
    """Sites written with comma numbers and bad text, read back by name."""
    month_text = {c: F.when(F.col("site_id") % 7 == 0, "n/a").otherwise(_comma_text(c)) for c in MID_MONTHS}
    path = staging_path(spark, "sites-csv")
    named = tables.sites(spark, d).withColumns(month_text)
    named.write.option("header", True).option("escape", '"').csv(path)
    back = site_files.read_sites(spark, path)
    return back.select(F.col("site_id").cast("bigint").alias("site_id"), "X", "Y", "i_mid", *MID_MONTHS, "area")


@query
def sites_positional_file(spark: SparkSession, d: str) -> DataFrame:
    """Lines of 54, 55 and 56 fields, a header and bad numbers, read by position."""
    k = F.col("site_id")
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SITE_COLUMNS]
    cells[5] = F.when(k % 11 == 0, "abc").when(k % 11 == 1, "nan").otherwise(cells[5])
    narrow, wide = F.concat_ws(",", *cells[:54]), F.concat_ws(",", *cells)
    line = F.when(k % 5 == 0, narrow).when(k % 5 == 1, F.concat(wide, F.lit(",extra"))).otherwise(wide)
    header = spark.createDataFrame([(",".join(SITE_COLUMNS),)], "line string")
    path = staging_path(spark, "sites-lines")
    tables.sites(spark, d).select(line.alias("line")).unionAll(header).write.text(path)
    back = site_files.read_sites_positional(spark, path)
    return seasonal.seasonal_stats(back)


@query
def sites_unlike_files(spark: SparkSession, d: str) -> DataFrame:
    """Sites in two folders whose columns stand in opposite orders, read back by name."""
    folder = staging_path(spark, "sites-unlike")
    named = tables.sites(spark, d)
    for part, columns in enumerate((named.columns, named.columns[::-1])):
        named.where(F.col("site_id") % 2 == part).select(*columns).write.option("header", True).csv(f"{folder}/{part}")
    back = site_files.read_sites(spark, [f"{folder}/0", f"{folder}/1"])
    return back.select(F.col("site_id").cast("bigint").alias("site_id"), "X", "Y", "i_mid", "area", "mpw")


@query
def monthly_totals_file(spark: SparkSession, d: str) -> DataFrame:
    """Monthly totals of a positional file in which some January fields say nan."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SITE_COLUMNS]
    cells[5] = F.when(F.col("site_id") % 11 == 1, "nan").otherwise(cells[5])
    path = staging_path(spark, "sites-nan")
    tables.sites(spark, d).select(F.concat_ws(",", *cells).alias("line")).write.text(path)
    return rounded(reshape.monthly_totals(site_files.read_sites_positional(spark, path), MID_MONTHS), 5)


@query
def numeric_repair(spark: SparkSession, d: str) -> DataFrame:
    """Comma numbers repaired, and one column coerced."""
    text = tables.sites(spark, d).select(
        "site_id",
        _comma_text("i_mid_jan").alias("i_mid_jan"),
        F.when(F.col("site_id") % 3 == 0, "unknown").otherwise(F.col("i_mid").cast("string")).alias("i_mid"),
    )
    repaired = site_files.repair_numbers(text, ["i_mid_jan"])
    coerced = site_files.coerce_number(repaired, "i_mid")
    return coerced.withColumn("scaled", clamp(to_number_sql("i_mid_jan"), 0, 5000))


@query
def hotspot_points_file(spark: SparkSession, d: str) -> DataFrame:
    """The hotspot report written and its sample points read back."""
    path = staging_path(spark, "hotspot-report")
    cells = hotspots.hotspots(tables.sites(spark, d), grid_size=0.5)
    reports.write_report(cells, path, F.lit("HOTSPOT"), ["grid"])
    return reports.read_hotspot_points(spark, path)


@query
def report_faulty_lines(spark: SparkSession, d: str) -> DataFrame:
    """Hotspot lines with faults: the points that are kept, and the rejected lines with their reasons."""
    k, x, y = F.col("site_id").cast("string"), F.col("X").cast("string"), F.col("Y").cast("string")
    head = F.concat(F.lit('"HOTSPOT"\t{"grid": "g'), k, F.lit('", "hotspot_score": 1.5, "sample_locations": ["'), x, F.lit(","), y, F.lit('", "'))
    tail = F.concat(y, F.lit(","), x, F.lit('"]}'))
    line = (
        F.when(F.col("site_id") % 4 == 0, F.concat(F.lit('"HOTSPOT" {"grid": "g'), k, F.lit('"}')))
        .when(F.col("site_id") % 4 == 1, F.concat(F.lit('"HOTSPOT"\t{"grid": "g'), k))
        .when(F.col("site_id") % 4 == 2, F.concat(head, tail))
        .otherwise(F.concat(head, F.lit('far,1.0", "'), tail))
    )
    found = reports.parse_hotspot_lines(tables.sites(spark, d).select(line.alias("value")))
    points = found.points.select(F.lit("point").alias("kind"), F.col("grid").alias("name"), "latitude", "longitude")
    named = F.regexp_extract("line", '"grid": "(g[0-9]+)', 1)
    rejects = found.rejects.select("reason", named, F.lit(None).cast("double"), F.lit(None).cast("double"))
    return points.union(rejects)


@query
def report_extension(spark: SparkSession, d: str) -> DataFrame:
    """A report with an analysis of its own, which reads a column that no other does."""
    weights = report.Analysis(
        lambda df, roles: df.groupBy((F.col("X") > 0).cast("string").alias("side")).agg(F.round(F.sum("mpw"), 4).alias("weight"), F.count("*").alias("n")),
        F.col("side"), ["side"], ("side",), ("mpw",),
    )
    outcomes = report.run_report(tables.sites(spark, d), staging_path(spark, "extended-report"), registry=report.analyses() | {"weights": weights})
    path = next(o.path for o in outcomes if o.name == "weights")
    lines = spark.read.text(path).select(F.split("value", "\t").alias("p"), F.monotonically_increasing_id().alias("place"))
    fields = F.from_json(F.col("p")[1], "weight double, n bigint")
    return lines.select(F.trim(F.col("p")[0], F.lit('"')).alias("side"), fields.alias("j"), "place").select(
        "side", "j.weight", "j.n", F.row_number().over(Window.orderBy("place")).alias("line")
    )


@query
def batch_report(spark: SparkSession, d: str) -> DataFrame:
    """All four reports written; key and leading count of every line read back."""
    folder = staging_path(spark, "batch-report")
    outcomes = report.run_report(tables.sites(spark, d), folder)
    lines = None
    for o in outcomes:
        text = spark.read.text(o.path).select(F.lit(o.name).alias("analysis"), "value")
        lines = text if lines is None else lines.unionAll(text)
    parts = F.split("value", "\t")
    fields = F.from_json(
        parts[1],
        "grid string, active_locations bigint, locations_count bigint, count bigint, total_locations bigint",
    )
    return lines.select("analysis", F.trim(parts[0], F.lit('"')).alias("key"), fields.alias("j")).select(
        "analysis",
        F.coalesce("j.grid", "key").alias("key"),
        F.coalesce("j.active_locations", "j.locations_count", "j.count", "j.total_locations").alias("locations"),
    )


# Readings -------------------------------------------------------------------

ORDER = ["ts", "reading_id"]


@query
def readings_status(spark: SparkSession, d: str) -> DataFrame:
    return readings.with_status(tables.readings(spark, d)).drop("ts")


@query
def readings_alerts(spark: SparkSession, d: str) -> DataFrame:
    return readings.alerts(tables.readings(spark, d)).select("source", "reading_id", "cpu_temp", "gpu_temp")


@query
def readings_gauges(spark: SparkSession, d: str) -> DataFrame:
    return readings.gauges(tables.readings(spark, d), ["source", "reading_id"])


@query
def readings_latest(spark: SparkSession, d: str) -> DataFrame:
    return readings.latest_readings(tables.readings(spark, d), "source", ORDER).select("source", "reading_id")


@query
def readings_history(spark: SparkSession, d: str) -> DataFrame:
    return readings.metric_history(tables.readings(spark, d), "source", ORDER)


@query
def readings_history_stream(spark: SparkSession, d: str) -> DataFrame:
    """The kept readings after streaming all events."""
    events = tables.table(spark, d, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    path = staging_path(spark, "history")
    writer = history.history_writer(tables.reading_columns(stream), f"{path}/kept", "source", ORDER)
    run = writer.option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    run.awaitTermination()
    return history.read_history(spark, f"{path}/kept").select("source", "reading_id")


@query
def readings_text(spark: SparkSession, d: str) -> DataFrame:
    """Metric values as label text."""
    shown = {m: F.concat(fixed(m, 1), F.lit("%")) for m in ("cpu_percent", "memory_percent")}
    return tables.readings(spark, d).select("reading_id", *[c.alias(m) for m, c in shown.items()])
