"""Operators on files, streams and limits bound to the test tables.

The files are written from the tables by the query itself and read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from runnel.operators import hotspots, severity, sketches, stats
from runnel.operators.sampling import head
from runnel.plans import report, tables
from runnel.plans.binding import Query, joined, registry, rounded
from runnel.schema import SITE_COLUMNS
from runnel.sources import reports, sites as site_files
from runnel.sources.positions import POSITION, number_lines
from runnel.sources.staging import stage, staging_path
from runnel.streaming import keyed, limits, readings

_registry: dict[str, Query] = {}
query = registry(_registry)
ORDER = ["ts", "reading_id"]


def registered() -> dict[str, Query]:
    return dict(_registry)


# Types of further columns -----------------------------------------------------


def _unlike_types(spark: SparkSession, d: str) -> DataFrame:
    """Sites in two folders with further columns; in the second, two of them hold wider values than in the first."""
    k = F.col("site_id")
    text = k.cast("string")
    further = {
        "ratio": F.format_string("%.3f", F.col("mpw") / 7),
        "seen": F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit(" 0"), (k % 10).cast("string"), F.lit(":30:00")),
        "flag": F.when(k % 3 == 0, "True").otherwise("False"),
        "gaps": F.when(k % 5 == 0, "NA").otherwise(text),
        "widened": F.when(k % 2 == 0, text).otherwise(F.concat(text, F.lit(".5"))),
        "torn": F.when(k % 2 == 0, text).otherwise(F.concat(F.lit("n"), text)),
        "none": F.lit("n/a"),
    }
    folder = staging_path(spark, "sites-typed")
    sites = tables.sites(spark, d).withColumns(further)
    for part in (0, 1):
        sites.where(k % 2 == part).write.option("header", True).csv(f"{folder}/{part}")
    return site_files.read_sites(spark, [f"{folder}/0", f"{folder}/1"])


@query
def sites_inferred_types(spark: SparkSession, d: str) -> DataFrame:
    """Name, type and number of values of the columns beyond the 55."""
    back = _unlike_types(spark, d)
    others = [f for f in back.schema.fields if f.name not in SITE_COLUMNS]
    counts = back.agg(*[F.count(f.name).alias(f.name) for f in others])
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("present")) for f in others]
    return counts.select(F.inline(F.array(*rows)))


@query
def inferred_columns_summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary of all numeric columns reaches those whose type was found."""
    back = _unlike_types(spark, d)
    numeric = [c for c in stats.numeric_columns(back) if c not in SITE_COLUMNS]
    return rounded(stats.numeric_summary(stage(back.select(*numeric), "further"), numeric).drop("position"), 5)


# Order of the input ------------------------------------------------------------


def _lines(spark: SparkSession, d: str) -> str:
    """A folder of positional site files, written by falling site_id."""
    path = staging_path(spark, "sites-ordered")
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SITE_COLUMNS]
    tables.sites(spark, d).repartitionByRange(5, F.desc("site_id")).sortWithinPartitions(F.desc("site_id")).select(F.concat_ws(",", *cells)).write.text(path)
    return path


def _in_order(spark: SparkSession, d: str) -> DataFrame:
    return site_files.read_sites_positional(spark, _lines(spark, d), position=True)


@query
def hotspot_cells_input_order(spark: SparkSession, d: str) -> DataFrame:
    return joined(hotspots.hotspots(_in_order(spark, d), grid_size=0.5, order="input"))


@query
def severity_report_input_order(spark: SparkSession, d: str) -> DataFrame:
    features = stage(severity.severity_features(_in_order(spark, d), keep=[POSITION], variance=False), "features")
    return joined(severity.severity_report(features, order="input"))


@query
def largest_area_first_in_input(spark: SparkSession, d: str) -> DataFrame:
    """Of the many sites with the largest area the first of the files."""
    return stats.row_of_maximum(_in_order(spark, d).select("X", "Y", "area", "i_high", POSITION), "area", [POSITION]).drop(POSITION)


@query
def first_sites_in_input(spark: SparkSession, d: str) -> DataFrame:
    numbered = number_lines(_in_order(spark, d).select("X", "Y", "i_mid", POSITION))
    return head(numbered, 20, [POSITION]).drop(POSITION)


@query
def numbered_sites(spark: SparkSession, d: str) -> DataFrame:
    """Every line's number over all files."""
    return number_lines(_in_order(spark, d).select("X", "Y", POSITION)).drop(POSITION)


# Reports ------------------------------------------------------------------------


@query
def batch_report_fields(spark: SparkSession, d: str) -> DataFrame:
    """Every field of every line of all four reports, each report read from its one file."""
    outcomes = report.run_report(tables.sites(spark, d), staging_path(spark, "report-files"), one_file=True)
    fields = None
    for o in outcomes:
        # A single split: its rows come in the file's order.
        lines = spark.read.text(o.path).withColumn("place", F.monotonically_increasing_id())
        numbered = lines.select(F.lit(o.name).alias("analysis"), F.row_number().over(Window.orderBy("place")).alias("line"), F.split("value", "\t").alias("p"))
        keyed_ = numbered.select("analysis", "line", F.trim(F.col("p")[0], F.lit('"')).alias("key"), F.explode(F.from_json(F.col("p")[1], "map<string,string>")).alias("field", "v"))
        fields = keyed_ if fields is None else fields.unionAll(keyed_)
    listed = F.col("field") == "sample_locations"
    as_text = F.when(listed, F.array_join(F.from_json("v", "array<string>"), ";")).when(F.col("field") == "grid", F.col("v"))
    number = F.when(~listed & (F.col("field") != "grid"), F.round(F.col("v").cast("double"), 6))
    return fields.select("analysis", "line", "key", "field", number.alias("number"), as_text.alias("text"))


def _hotspot_lines(spark: SparkSession, d: str, missing: bool) -> str:
    """Hotspot report lines with a point each; with ``missing``, every seventh lacks a key."""
    k, x, y = F.col("site_id").cast("string"), F.col("X").cast("string"), F.col("Y").cast("string")
    whole = F.concat(F.lit('"HOTSPOT"\t{"grid": "g'), k, F.lit('", "hotspot_score": 2.5, "sample_locations": ["'), x, F.lit(","), y, F.lit('"]}'))
    lacking = F.concat(F.lit('"HOTSPOT"\t{"grid": "g'), k, F.lit('", "sample_locations": ["'), x, F.lit(","), y, F.lit('"]}'))
    path = staging_path(spark, "hotspot-lines")
    line = F.when(F.lit(missing) & (F.col("site_id") % 7 == 0), lacking).otherwise(whole)
    tables.sites(spark, d).select(line).write.text(path)
    return path


@query
def report_missing_keys(spark: SparkSession, d: str) -> DataFrame:
    """Points read from whole lines, from lines with a missing key in each mode, and from a missing file."""
    good, bad = _hotspot_lines(spark, d, False), _hotspot_lines(spark, d, True)

    def counted(case: str, path: str, on_error: str) -> DataFrame:
        try:
            points = reports.read_hotspot_points(spark, path, on_error)
            return points.agg(F.lit(case).alias("case"), F.count("*").alias("points"), F.round(F.sum("latitude"), 4).alias("latitudes"), F.lit(None).cast("string").alias("error"))
        except Exception as error:  # noqa: BLE001 - the kind of error is the result
            return spark.createDataFrame([(case, None, None, type(error).__name__)], "case string, points bigint, latitudes double, error string")

    cases = [("whole", good, "raise"), ("skip", bad, "skip"), ("empty", bad, "empty"), ("raise", bad, "raise"), ("no file", f"{bad}/none", "empty"), ("no file, raise", f"{bad}/none", "raise")]
    out = None
    for case in cases:
        rows = counted(*case)
        out = rows if out is None else out.unionAll(rows)
    return out


def _counted(spark: SparkSession, source: str, df: DataFrame, observation: Observation) -> DataFrame:
    """The counters of one pass over a table."""
    df.write.format("noop").mode("overwrite").save()
    rows = [(source, reason, n) for reason, n in observation.get.items()]
    return spark.createDataFrame(rows, "source string, reason string, n bigint")


@query
def rejected_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines and fields that three readers leave out, by reason, each counted while the rows are read."""
    k = F.col("site_id")
    cells: list[Column] = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SITE_COLUMNS]
    cells[2] = F.coalesce(F.col("i_mid").cast("string"), F.lit("0"))
    cells[5] = F.when(k % 11 == 0, "abc").when(k % 11 == 1, "nan").otherwise(cells[5])
    wide = F.concat_ws(",", *cells)
    line = F.when(k % 5 == 0, F.concat_ws(",", *cells[:54])).when(k % 5 == 1, F.concat(wide, F.lit(",extra"))).otherwise(wide)
    header = F.lit(",".join(SITE_COLUMNS))
    positional, named, hot = (staging_path(spark, f"rejects-{n}") for n in ("positional", "named", "hotspots"))
    tables.sites(spark, d).select(F.explode(F.when(k % 101 == 0, F.array(header, line)).otherwise(F.array(line))).alias("line")).write.text(positional)
    text = {c: F.when(k % 7 == 0, "n/a").otherwise(F.format_number(F.col(c) * 1000, 4)) for c in ("i_mid_jan", "i_mid_feb")}
    tables.sites(spark, d).withColumns(text).select(*SITE_COLUMNS).write.option("header", True).option("escape", '"').csv(named)
    faulty = (
        F.when(k % 4 == 0, '"HOTSPOT" {}')
        .when(k % 4 == 1, '"HOTSPOT"\t{"grid": "g')
        .when(k % 4 == 2, '"HOTSPOT"\t{"grid": "g", "hotspot_score": 1, "sample_locations": ["1,2", "far,1"]}')
        .otherwise('"HOTSPOT"\t{"grid": "g", "sample_locations": ["1,2"]}')
    )
    tables.sites(spark, d).select(faulty.alias("line")).write.text(hot)

    one, two, three = Observation(), Observation(), Observation()
    first = _counted(spark, "positional", site_files.read_sites_positional(spark, positional, observation=one), one)
    by_name = _counted(spark, "named", site_files.read_sites(spark, named, further="text", observation=two), two)
    points = _counted(spark, "hotspots", reports.read_hotspot_points(spark, hot, "skip", three), three)
    return first.unionAll(by_name.where("reason in ('rows', 'bad_i_mid_jan', 'bad_i_mid_feb', 'bad_X', 'bad_area')")).unionAll(points)


# Quantiles of groups --------------------------------------------------------------


@query
def sketched_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of sites by hemisphere from stored sketches of two halves, merged."""
    sites = tables.sites(spark, d).select("site_id", "i_high", "mpw", (F.col("Y") >= 0).alias("north"))
    halves = [stage(sketches.quantile_sketch(sites.where(F.col("site_id") % 2 == part), ["i_high", "mpw"], ["north"]), "sketch") for part in (0, 1)]
    merged = sketches.merged_sketches(halves[0].unionAll(halves[1]), ["north"])
    return rounded(sketches.sketched_quantiles(merged, (0.1, 0.5, 0.9, 1.0), ["north"]))


# Readings ------------------------------------------------------------------------


@query
def readings_keyed_state(spark: SparkSession, d: str) -> DataFrame:
    """The kept readings of all sources after a stream was stopped midway and started again."""
    events = tables.table(spark, d, "events")
    folder = staging_path(spark, "keyed")
    rows = tables.reading_columns(events)
    early = F.col("reading_id") % 2 == 0
    for chosen in (early, ~early):
        rows.where(chosen).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        keyed.start_history(stream, f"{folder}/state", "source", ORDER, salts=4).awaitTermination()
    return keyed.read_history(spark, f"{folder}/state", "source", ORDER).select("source", "reading_id")


@query
def readings_limits(spark: SparkSession, d: str) -> DataFrame:
    """Status of each metric by limits that change over time, some of them for single sources."""
    rows = tables.readings(spark, d)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    users = rows.select("source").distinct().where(F.col("source") % 3 == 0)
    own = users.select(
        "source", F.explode(F.sequence(F.lit(0), (F.col("source") % 4).cast("int"))).alias("step")
    ).select(
        "source", F.lit("cpu_percent").alias("metric"), F.timestamp_add("DAY", F.col("step") * 5 + (F.col("source") % 5).cast("int"), start).alias("valid_from"),
        (F.lit(20.0) + F.col("step") * 10).alias("warning"), (F.lit(40.0) + F.col("step") * 10).alias("critical"),
    )
    table = limits.default_limits(spark).where("metric != 'gpu_temp'").unionByName(own)
    found = limits.with_limits(rows, table, ["cpu_percent", "memory_percent", "cpu_temp"], ["source", "reading_id", "ts"])
    return found.select("source", "reading_id", "metric", "warning", "critical", readings.status("value", F.col("warning"), F.col("critical")).alias("status"))
