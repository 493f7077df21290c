"""Types, places and rejects of file rows, and reports in one file."""

import json
from pathlib import Path

import pytest
from conftest import months
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from runnel.operators import hotspots, severity, stats
from runnel.operators.sampling import head
from runnel.plans import report
from runnel.schema import MONTHS, SITE_COLUMNS
from runnel.sources import positions, reports, sites as site_files, types
from runnel.sources.positions import POSITION

HEADER = ",".join(SITE_COLUMNS)


def line(**cells):
    return ",".join(str(cells.get(c, 0)) for c in SITE_COLUMNS)


# Types ------------------------------------------------------------------------

CASES = {
    "whole": (["1", " -2 ", "+3", "007"], "bigint"),
    "huge": (["1", "99999999999999999999", "3", "4"], "double"),
    "real": (["1", "2.5", "1e3", "inf"], "double"),
    "gaps": (["1", "NA", "", "null"], "bigint"),
    "nothing": (["nan", "N/A", "", "None"], "double"),
    "flag": (["True", "false", "TRUE", "NA"], "boolean"),
    "flag_or_number": (["True", "1", "0", "1"], "string"),
    "day": (["2024-02-29", "2024-03-01 10:11", "2024-03-01T10:11:12.5", "NA"], "timestamp_ntz"),
    "no_day": (["2024-02-30", "2024-03-01", "2024-03-02", "2024-03-03"], "string"),
    "day_or_number": (["2024-02-29", "2024", "1", "2"], "string"),
    "java": (["1d", "2", "3", "4"], "string"),
    "hex": (["0x10", "2", "3", "4"], "string"),
    "word": (["a", "2", "3", "4"], "string"),
}


def texts(spark):
    rows = list(zip(*(v for v, _ in CASES.values())))
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in CASES))


def test_types_of_values(spark):
    df = texts(spark)
    found = types.infer_types(df, list(CASES))
    assert found == {c: t for c, (_, t) in CASES.items()}
    back = types.with_types(df, found)
    assert {f.name: f.dataType.simpleString() for f in back.schema.fields} == found
    whole, real, day, flag, gaps = (set(r[c] for r in back.collect()) for c in ("whole", "real", "day", "flag", "gaps"))
    assert whole == {1, -2, 3, 7} and real == {1.0, 2.5, 1000.0, float("inf")} and flag == {True, False, None} and gaps == {1, None}
    assert sorted(str(x) for x in day) == ["2024-02-29 00:00:00", "2024-03-01 10:11:00", "2024-03-01 10:11:12.500000", "None"]
    assert types.infer_types(df.where("false"), ["whole"]) == {"whole": "double"} and types.infer_types(df, []) == {}


def test_types_merge_in_any_grouping(spark):
    df = texts(spark).withColumn("file", F.monotonically_increasing_id() % 3)
    names = list(CASES)
    whole = sorted(map(tuple, types.type_bits(df, names).collect()))
    apart = types.type_bits(df, names, by=[F.col("file")])
    assert apart.count() > len(names) and sorted(map(tuple, types.merged_bits(apart).collect())) == whole


def test_types_need_one_scan(spark):
    plan = types.type_bits(texts(spark), list(CASES))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") == 1


def test_further_columns_of_files(spark, tmp_path):
    for name, value in (("a", "5"), ("b", "x")):
        (tmp_path / f"{name}.csv").write_text(f"{HEADER},code,size\n{line(X=1)},{value},2\n")
    path = str(tmp_path)
    typed = site_files.read_sites(spark, path)
    assert typed.schema["code"].dataType.simpleString() == "string" and typed.schema["size"].dataType.simpleString() == "bigint"
    assert "size" in stats.numeric_columns(typed)
    assert site_files.read_sites(spark, path, further="text").schema["size"].dataType.simpleString() == "string"
    given = site_files.read_sites(spark, path, further={"code": "double", "size": "double", "absent": "bigint"})
    assert sorted((r["code"] is None, r["size"]) for r in given.collect()) == [(False, 2.0), (True, 2.0)]


# Places ------------------------------------------------------------------------


@pytest.fixture
def ordered(tmp_path):
    """Five files, three sites a cell, the first ones of the input far from first by coordinates."""
    rows = []
    for f in range(5):
        part = [line(X=f"{60 - f * 10 - i % 10}.0{i % 7}", Y=f"{i % 3}.5", i_mid=500 + (f * 100 + i) % 7, i_high=9, area=1000000 * (i % 4), **months("i_mid", [1] * 12)) for i in range(100)]
        (tmp_path / f"part-{f}.csv").write_text("\n".join(part) + "\n")
        rows += part
    return str(tmp_path), [[float(x) for x in r.split(",")] for r in rows]


@pytest.mark.parametrize("split", ["128m", "3k"])
def test_order_of_the_input_for_any_split_size(spark, ordered, split):
    path, rows = ordered
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        sites = site_files.read_sites_positional(spark, path, position=True)
        assert (sites.rdd.getNumPartitions() > 20) == (split == "3k")
        numbered = positions.number_lines(sites.select("X", "Y", POSITION)).select("line", "X", "Y")
        assert sorted(map(tuple, numbered.collect())) == [(i, r[0], r[1]) for i, r in enumerate(rows)]
        kept = positions.number_lines(sites).where("area > 0 and X > 30").orderBy("line").select("line")
        assert [r.line for r in kept.collect()] == [i for i, r in enumerate(rows) if r[-1] > 0 and r[0] > 30]
        assert [(r.X, r.Y) for r in head(sites.select("X", "Y", POSITION), 7, [POSITION]).collect()] == [(r[0], r[1]) for r in rows[:7]]

        top = stats.row_of_maximum(sites, "i_mid", [POSITION]).first()
        first = max(range(len(rows)), key=lambda i: (rows[i][2], -i))
        assert (top.X, top.Y) == (rows[first][0], rows[first][1])

        cells = {}
        for r in rows:
            cells.setdefault((int(r[0] / 5), int(r[1] / 5)), []).append(f"{r[0]},{r[1]}")
        got = hotspots.hotspots(sites, grid_size=5, order="input").collect()
        assert sorted(r.sample_locations for r in got) == sorted(v[:5] for v in cells.values()) and len(got) > 5

        features = severity.severity_features(sites, keep=[POSITION], variance=False)
        report_rows = {r.category: r.sample_locations for r in severity.severity_report(features, order="input").collect()}
        assert report_rows["LOW"] == [f"{r[0]},{r[1]}" for r in rows if r[2] <= 501][:10]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_order_argument(spark):
    assert len(positions.input_order(None, [F.col("x")])) == 1 and len(positions.input_order([F.col("a"), F.col("b")], [])) == 2
    with pytest.raises(ValueError, match="no such order"):
        positions.input_order("file", [])


def test_numbers_when_splits_are_many(spark, ordered, monkeypatch):
    monkeypatch.setattr(positions, "SPLITS", 2)
    path, rows = ordered
    numbered = positions.number_lines(site_files.read_sites_positional(spark, path, position=True))
    assert sorted(r.line for r in numbered.collect()) == list(range(len(rows)))


# Rejects ------------------------------------------------------------------------


def test_rejected_site_lines_are_counted_while_read(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("\n".join([HEADER, line(X=1), line(X=2) + ",more", line(X="abc"), "1,2,3", "", line(i_mid="nan"), HEADER]) + "\n")
    seen = Observation()
    sites = site_files.read_sites_positional(spark, str(path), observation=seen)
    assert sites.count() == 4
    assert seen.get == {"lines": 7, "header": 2, "narrow": 1, "wide": 1, "bad_number": 1}


def test_bad_numbers_by_column(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("\n".join([HEADER, line(i_mid_jan='"1,000"'), line(i_mid_jan="x", area="y"), line(i_mid_jan="")]) + "\n")
    seen = Observation()
    assert site_files.read_sites(spark, str(path), observation=seen).agg(F.sum("i_mid_jan")).first()[0] == 1000
    assert seen.get["rows"] == 3 and {c for c, n in seen.get.items() if n == 1} == {"bad_i_mid_jan", "bad_area"}


def test_report_faults_are_counted_without_a_second_scan(spark, tmp_path):
    good = '"HOTSPOT"\t' + json.dumps({"grid": "g", "hotspot_score": 1.0, "sample_locations": ["1,2", "3,4"]})
    path = tmp_path / "r.txt"
    path.write_text("\n".join([good, "no tab here", '"HOTSPOT"\t{bad', '"HOTSPOT"\t{"grid": "g"}', good.replace("3,4", "3,x"), good]) + "\n")
    seen = Observation()
    points = reports.read_hotspot_points(spark, str(path), "skip", seen)
    assert points._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert points.count() == 5
    assert seen.get == {"lines": 6, "no_tab": 1, "bad_json": 1, "missing_key": 1, "bad_coordinate": 1}


def test_missing_key_and_missing_file(spark, tmp_path):
    path = tmp_path / "r.txt"
    path.write_text('"HOTSPOT"\t{"grid": "g", "sample_locations": ["1,2"]}\n')
    assert reports.read_hotspot_points(spark, str(path)).count() == 0
    with pytest.raises(ValueError, match="without its keys"):
        reports.read_hotspot_points(spark, str(path), "raise")
    with pytest.raises(AnalysisException):
        reports.read_hotspot_points(spark, f"{path}.none", "raise")
    assert reports.read_hotspot_points(spark, f"{path}.none").count() == 0


# One file ------------------------------------------------------------------------


def test_report_is_one_ordered_file(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n")).repartition(4)
    path = tmp_path / "out" / "numbers.txt"
    for _ in range(2):  # the second run replaces the first
        reports.write_report_file(df, f"file:{path}", F.lit("N"), ["n"])
        assert path.read_text().splitlines() == [f'"N"\t{{"n": {i}}}' for i in range(1000)]
    assert [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == ["numbers.txt"]


def test_failed_write_leaves_the_old_file(spark, tmp_path):
    path = tmp_path / "r.txt"
    reports.write_text_file(spark.createDataFrame([("old",)], "value string"), str(path))
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).cast("string").alias("value"))
    with pytest.raises(Exception, match="broken"):
        reports.write_text_file(bad, str(path))
    assert path.read_text() == "old\n" and not list(tmp_path.glob("*.part*"))


def test_batch_report_files(spark, sites, tmp_path):
    table = sites(*[{"X": i / 50, "Y": 1.0, "i_mid": 5.0 + i, "i_high": 9.0, "area": 1e6, **months("i_mid", range(1, 13)), **months("runoff", range(i, i + 12))} for i in range(1, 9)])
    broken = report.analyses() | {"broken": report.Analysis(lambda df, roles: df.select(F.raise_error(F.lit("no luck")).alias("k")), F.col("k"), ["k"])}
    outcomes = {o.name: o for o in report.run_report(table, str(tmp_path), registry=broken, one_file=True)}
    assert sorted(p.name for p in tmp_path.glob("*.txt")) == sorted(f"{n}.txt" for n in broken)
    text = Path(outcomes["broken"].path).read_text()
    assert text.startswith("Error:\n") and "no luck" in text and outcomes["broken"].error
    keys = [ln.split("\t")[0].strip('"') for ln in (tmp_path / "seasonal_analysis.txt").read_text().splitlines()]
    assert keys == sorted(MONTHS) and all(o.error is None for n, o in outcomes.items() if n != "broken")


def test_command_writes_files(spark, tmp_path):
    path = tmp_path / "sites.csv"
    path.write_text("\n".join([HEADER, line(X=1, i_mid=3, area=1e6)]) + "\n")
    assert report.main([str(path), str(tmp_path / "out")]) == 0
    assert {p.name for p in (tmp_path / "out").glob("*.txt")} == {f"{n}.txt" for n in report.analyses()}
