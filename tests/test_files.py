import json
from pathlib import Path

import pytest
from conftest import months
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from runnel.operators import hotspots, seasonal, severity
from runnel.plans import report
from runnel.schema import MONTHS, SITE_COLUMNS
from runnel.sources import reports, sites as site_files
from runnel.sources.staging import release_staged, shared_folder, stage, staged

HEADER = ",".join(SITE_COLUMNS)


def line(**cells):
    return ",".join(str(cells.get(c, 0)) for c in SITE_COLUMNS)


def write(tmp_path, *lines):
    path = tmp_path / "sites.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def xs(df):
    return sorted(r["X"] for r in df.select("X").collect())


def test_positional_widths(spark, tmp_path):
    cells = line(X=1.5).split(",")
    path = write(
        tmp_path,
        HEADER,
        ",".join(cells[:54]),
        line(X=2, area=5),
        line(X=3, area=5) + ",extra",
        line(X=4, area="") + ",extra,more",
        "",
        line(X=5, i_mid='"1,234.5"', area=7),
        ",".join(['"6,0"', *cells[1:54]]),  # 54 fields and a quoted comma
    )
    df = site_files.read_sites_positional(spark, path)
    assert xs(df) == [2.0, 3.0, 4.0, 5.0]
    by_x = {r["X"]: r for r in df.collect()}
    assert by_x[4.0]["area"] is None and by_x[5.0]["i_mid"] is None and by_x[5.0]["area"] == 7.0
    # Also when only one column is read.
    assert df.agg(F.max("X")).first()[0] == 5.0 and df.select("Y").count() == 4


def test_bad_number_drops_a_row_only_where_it_is_used(spark, tmp_path):
    good = {"i_mid": 5, "area": 1e6, **months("i_mid", [1] * 12)}
    path = write(
        tmp_path,
        HEADER,
        line(X=1.01, **good),
        line(X=1.02, **{**good, "i_mid_jan": "abc"}),
        line(X=1.03, **{**good, "i_mid_jan": "nan"}),
        line(X=1.04, **{**good, "i_low_jan": "abc"}),
    )
    df = site_files.read_sites_positional(spark, path)
    stats = {r["month"]: r["active_locations"] for r in seasonal.seasonal_stats(df).collect()}
    assert stats == {**{m: 3 for m in MONTHS}, "jan": 2}
    (cell,) = hotspots.hotspots(df, grid_size=0.1).collect()
    assert cell["locations_count"] == 4
    assert sorted(r["x"] for r in severity.severity_features(df).collect()) == [1.01, 1.03, 1.04]


def test_by_name_repairs_months(spark, tmp_path):
    names = [c for c in SITE_COLUMNS if c not in ("i_mid_feb", "mpw")]
    rows = [
        ",".join(names) + ",note",
        ",".join({"X": "1", "i_mid_jan": '"1,234.5"', "i_mid": '"1,0"'}.get(c, "0") for c in names) + ",hi",
        ",".join({"X": "2", "i_mid_jan": "x", "area": "nan", "Y": ""}.get(c, "0") for c in names) + ",",
    ]
    path = write(tmp_path, *rows)
    with pytest.raises(ValueError, match="i_mid_feb"):
        site_files.read_sites(spark, path)
    df = site_files.read_sites(spark, path, missing_months="skip")
    assert df.columns == [*names, "note"]
    a, b = df.orderBy("X").collect()
    assert a["i_mid_jan"] == 1234.5 and a["i_mid"] is None and a["note"] == "hi"
    assert b["i_mid_jan"] is None and b["area"] is None and b["Y"] is None
    assert df.schema["X"].metadata["comment"] == "longitude"


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException):
        site_files.read_sites(spark, str(tmp_path / "none.csv"))
    empty = site_files.read_sites(spark, str(tmp_path / "none.csv"), on_error="empty")
    assert empty.columns == list(SITE_COLUMNS) and empty.isEmpty()


def test_repair_and_coerce(spark):
    df = spark.createDataFrame([("1,5", 2.0, "7"), ("x", 3.0, "nan")], "a string, b double, c string")
    fixed = site_files.coerce_number(site_files.repair_numbers(df, ["a", "b"]), "c")
    assert [tuple(r) for r in fixed.collect()] == [(15.0, 2.0, 7.0), (None, 3.0, None)]


def hotspot_line(grid="g", score=1.5, places=("1.0,2.0",), **more):
    record = {"grid": grid, "hotspot_score": score, "sample_locations": list(places), **more}
    return f'"HOTSPOT"\t{json.dumps(record)}'


def points(df):
    return sorted((r["grid"], r["latitude"], r["longitude"], r["hotspot_score"]) for r in df.collect())


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_report_lines_with_faults(spark):
    found = reports.parse_hotspot_lines(
        lines(
            spark,
            hotspot_line("a", places=["1.0,2.0", "3.0,4.0"], locations_count=2),
            "no tab here",
            '"HOTSPOT"\t{bad json',
            hotspot_line("b", places=["5,6", "7;8", "9,10"]),
            hotspot_line("c", places=["1,2,3", "5,6"]),
            hotspot_line("d", places=[]),
            f"  {hotspot_line('e')}\tignored",
        )
    )
    assert points(found.points) == [("a", 2.0, 1.0, 1.5), ("a", 4.0, 3.0, 1.5), ("b", 6.0, 5.0, 1.5), ("e", 2.0, 1.0, 1.5)]
    assert sorted(r["reason"] for r in found.rejects.collect()) == [
        "bad coordinate", "bad coordinate", "bad json", "no tab",
    ]


def test_report_missing_key(spark, tmp_path):
    path = tmp_path / "report.txt"
    path.write_text(hotspot_line("a") + '\n"HOTSPOT"\t{"grid": "b"}\n')
    assert reports.read_hotspot_points(spark, str(path)).collect() == []
    assert points(reports.read_hotspot_points(spark, str(path), on_error="skip")) == [("a", 2.0, 1.0, 1.5)]
    with pytest.raises(ValueError, match="without its keys"):
        reports.read_hotspot_points(spark, str(path), on_error="raise")
    gone = reports.read_hotspot_points(spark, str(tmp_path / "none"))
    assert gone.columns == ["latitude", "longitude", "hotspot_score", "grid"] and gone.isEmpty()
    with pytest.raises(AnalysisException):
        reports.read_hotspot_points(spark, str(tmp_path / "none"), on_error="raise")


def sample_sites(sites):
    return sites(
        *[
            {
                "X": (i % 9) / 100, "Y": 0.05, "i_mid": float(i), "i_high": 2.0 * i, "area": 1e6,
                **months("i_mid", [i + m for m in range(12)]), **months("runoff", [1 + m for m in range(12)]),
            }
            for i in range(40)
        ]
    )


def read_report(spark, path):
    found = []
    for r in spark.read.text(path).collect():
        key, _, record = r["value"].partition("\t")
        found.append((json.loads(key), json.loads(record)))
    return found


def test_batch_report(spark, sites, tmp_path):
    outcomes = report.run_report(sample_sites(sites), str(tmp_path / "out"))
    assert [o.error for o in outcomes] == [None] * 4
    seasonal_rows = read_report(spark, str(tmp_path / "out/seasonal_analysis"))
    assert sorted(k for k, _ in seasonal_rows) == sorted(MONTHS)
    assert list(dict(seasonal_rows)["jan"]) == [
        "average_pollution", "max_pollution", "min_pollution", "std_deviation", "active_locations", "total_pollution",
    ]
    ((key, cell),) = read_report(spark, str(tmp_path / "out/hotspot_analysis"))
    assert key == "HOTSPOT" and cell["grid"] == "grid_0.0_0.0" and len(cell["sample_locations"]) == 5
    classes = dict(read_report(spark, str(tmp_path / "out/severity_classification")))
    assert sum(c["count"] for c in classes.values()) == 39
    # Lines are in key order across the part files.
    parts = sorted((tmp_path / "out/severity_classification").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert [row.split("\t")[0] for row in text.splitlines()] == ['"CRITICAL"', '"HIGH"', '"LOW"', '"MEDIUM"']


def test_a_failing_analysis_does_not_stop_the_report(spark, sites, tmp_path):
    def fail(_sites, _roles):
        raise RuntimeError("no luck")

    registry = {**report.analyses()}
    registry = {"broken": report.Analysis(fail, F.col("x"), ["x"]), "seasonal_analysis": registry["seasonal_analysis"]}
    broken, fine = report.run_report(sample_sites(sites), str(tmp_path / "out"), registry=registry)
    assert broken.error == "no luck" and fine.error is None
    text = "\n".join(r["value"] for r in spark.read.text(broken.path).collect())
    assert text.startswith("Error:") and "no luck" in text


def test_report_command(spark, tmp_path, capsys):
    assert report.main([]) == 1
    assert report.main([str(tmp_path / "none.csv"), str(tmp_path / "out")]) == 1
    assert "cannot read" in capsys.readouterr().out
    path = write(tmp_path, HEADER, *[line(X=i, i_mid=i, area=1, **months("i_mid", [i] * 12)) for i in range(1, 9)])
    assert report.main([path, str(tmp_path / "out"), "--positional"]) == 0


def test_staging(spark):
    df = stage(spark.range(3), "numbers")
    assert df.count() == 3 and shared_folder(spark) in df.inputFiles()[0]
    assert release_staged(spark) >= 1
    assert release_staged(spark) == 0
    with staged(spark.range(3)) as table:
        (file, *_) = table.inputFiles()
        assert table.count() == 3
    assert not Path(file.removeprefix("file://")).exists() and release_staged(spark) == 0


def test_files_with_unlike_column_order(spark, tmp_path):
    names = list(SITE_COLUMNS)
    for folder, columns in (("a", names), ("b", names[::-1])):
        (tmp_path / folder).mkdir()
        values = {"X": "1" if folder == "a" else "2", "Y": "54", "area": "7"}
        (tmp_path / folder / "part.csv").write_text(",".join(columns) + "\n" + ",".join(values.get(c, "0") for c in columns) + "\n")
    df = site_files.read_sites(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    rows = sorted((r["X"], r["Y"], r["area"]) for r in df.collect())
    assert rows == [(1.0, 54.0, 7.0), (2.0, 54.0, 7.0)] and df.columns == names


def test_report_stages_the_columns_an_added_analysis_names(spark, sites, tmp_path):
    from runnel.plans.report import Analysis, run_report

    by_weight = Analysis(lambda df, roles: df.agg(F.sum("mpw").alias("total")).select(F.lit("all").alias("k"), "total"), F.col("k"), ["k"], ("k",), ("mpw",))
    (outcome,) = run_report(sites({"mpw": 2.0}, {"mpw": 3.0}), str(tmp_path / "out"), registry={"weights": by_weight})
    assert outcome.error is None and spark.read.text(outcome.path).first()["value"] == '"all"\t{"total": 5.0}'


def test_staged_table_may_be_released_inside_its_block(spark):
    from runnel.sources.staging import release_staged, staged

    with staged(spark.range(3)) as table:
        assert table.count() == 3
        release_staged(spark)
