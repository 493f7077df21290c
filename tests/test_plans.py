"""Physical plans: pruned scans, pushed filters, no Python and no cross joins."""

import pytest

from runnel.operators import correlation, hotspots, panels, quality, seasonal, severity, stats
from runnel.operators.order_stats import _Bracket, _bracketed
from runnel.sources import reports
from runnel.streaming import readings


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from runnel.schema import SITE_COLUMNS, SITE_SCHEMA

    path = str(tmp_path_factory.mktemp("sites") / "table")
    rows = [tuple(float(i + j) for j in range(len(SITE_COLUMNS))) for i in range(50)]
    spark.createDataFrame(rows, SITE_SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_hotspots_read_four_columns_and_push_the_threshold(stored):
    text = formatted(hotspots.hotspots(stored))
    assert "GreaterThan(i_mid,0.01)" in text
    assert "ReadSchema: struct<X:double,Y:double,i_mid:double,area:double>" in text
    assert "i_high" not in text


def test_quantile_scans_push_their_brackets(stored):
    brackets = [_Bracket(0, 2.0, 4.0, 0, 3, [1]), _Bracket(0, 8.0, 9.0, 0, 3, [5])]
    text = formatted(_bracketed(stored, ["i_mid"], brackets, 16))
    assert "ReadSchema: struct<i_mid:double>" in text
    assert "Or(And(GreaterThanOrEqual(i_mid,2.0),LessThanOrEqual(i_mid,4.0))" in text


def test_thresholds_are_literals(stored):
    features = severity.severity_features(stored, variance=False)
    text = plan(severity.classify_severity(features, severity.severity_thresholds(features)))
    assert "Join" not in text and "Exchange" not in text


def test_no_operator_uses_python_or_a_nested_loop(stored):
    frames = {
        "seasonal": seasonal.seasonal_stats(stored),
        "hotspots": hotspots.hotspots(stored),
        "severity": severity.severity_report(severity.severity_features(stored)),
        "correlation": correlation.correlation_report(correlation.site_correlations(stored)),
        "surface": stats.trend_surface(stored),
        "histogram": stats.histogram(stored, "i_high"),
        "months": panels.top_sites_by_month(stored),
        "markers": panels.colored_markers(panels.top_sites(stored)),
        "risk": panels.risk_table(stored),
        "missing": quality.missing_by_column(stored),
    }
    for name, df in frames.items():
        text = plan(df)
        for word in ("Python", "InArrow", "InPandas", "NestedLoop", "CartesianProduct"):
            assert word not in text, name


def test_summary_scans_once_for_its_moments(stored):
    # The Arrow kernel of the moments; no row per value.
    text = plan(stats.numeric_summary(stored))
    assert text.count("MapInArrow") == 1 and "Generate" not in text and "Python" not in text


def test_hotspot_samples_rank_points_of_hot_cells_only(stored):
    text = plan(hotspots.hotspots(stored))
    window = text.index("Window")
    assert "LeftSemi" in text[window:] and "hint" not in text.lower()


def test_top_k_does_not_sort_the_table(stored):
    assert "TakeOrderedAndProject" in plan(panels.top_sites(stored))
    assert plan(readings.latest_readings(stored, "X", ["Y"])).count("WindowGroupLimit") == 2


def test_correlations_shuffle_sites_once(stored):
    report = correlation.correlation_report(correlation.site_correlations(stored))
    report.collect()
    final = plan(report)
    assert "ReusedExchange" in final


def test_a_report_line_is_parsed_once(spark):
    # The filter on the reason is neither put in place of its columns nor moved below the join.
    keys = spark.range(9).selectExpr("id % 5 as k").groupBy("k").count()
    lines = keys.join(spark.range(5).withColumnRenamed("id", "k"), "k").selectExpr("concat('\"HOTSPOT\"\t{\"grid\": \"g', k, '\"') as value")
    found = reports.parse_hotspot_lines(lines)
    for df in found:
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [r["reason"] for r in found.rejects.collect()] == ["bad json"] * 5
