import math

import numpy as np
import pandas as pd
import pytest
from conftest import months
from pyspark.sql import functions as F

from runnel.operators import panels, quality, reshape, sampling, stats
from runnel.operators.groups import largest_rows
from runnel.schema import DEFAULT_ROLES, MONTHS, SITE_COLUMNS

NAN = float("nan")


def test_months_long_keeps_missing(sites):
    df = sites({"X": 1.0, **months("i_mid", range(12)), "i_mid_mar": None})
    long = reshape.months_long(df, ["X"], DEFAULT_ROLES.pollution_columns)
    rows = {r["month"]: r["value"] for r in long.collect()}
    assert list(rows) == list(MONTHS) and rows["mar"] is None and rows["dec"] == 11.0
    assert "Exchange" not in long._jdf.queryExecution().executedPlan().toString()


def test_month_pairs(sites):
    df = sites({"X": 1.0, **months("i_mid", range(12)), **months("runoff", range(20, 32))})
    rows = reshape.month_pairs(df, ["X"], DEFAULT_ROLES.months).collect()
    assert tuple(rows[2]) == (1.0, "mar", 2.0, 22.0) and len(rows) == 12


def test_monthly_totals_and_means(sites):
    df = sites({**months("i_mid", range(12)), "i_mid_feb": None}, months("i_mid", [1] * 12))
    totals = reshape.monthly_totals(df, DEFAULT_ROLES.pollution_columns).collect()
    assert [tuple(r) for r in totals[:3]] == [("Jan", 0, 1.0), ("Feb", 1, 1.0), ("Mar", 2, 3.0)]
    means = reshape.monthly_means(df, DEFAULT_ROLES.pollution_columns).collect()
    assert [r["average"] for r in means[:3]] == [0.5, 1.0, 1.5]
    empty = reshape.monthly_totals(df.limit(0), DEFAULT_ROLES.pollution_columns).collect()
    assert {r["total"] for r in empty} == {0.0}


def test_top_sites_and_markers(sites):
    df = sites(*[{"X": float(i), "Y": 1.0, "i_mid": v} for i, v in enumerate([5.0, None, 9.0, 9.0, NAN, 1.0])])
    top = panels.top_sites(df, 3)
    assert [(r["X"], r["i_mid"]) for r in top.collect()] == [(2.0, 9.0), (3.0, 9.0), (0.0, 5.0)]
    assert panels.top_sites(df).count() == 4
    colored = {r["X"]: r for r in panels.colored_markers(panels.top_sites(df)).collect()}
    assert colored[2.0]["color"] == "#ff0000" and colored[2.0]["radius"] == 25.0
    assert colored[0.0]["intensity"] == 0.5 and colored[0.0]["severity"] == "Moderate"
    assert colored[5.0]["severity"] == "Moderate" and colored[5.0]["color"] == "#00ff00"
    flat = panels.colored_markers(panels.top_sites(df, 2)).collect()
    assert {r["intensity"] for r in flat} == {None} and {r["severity"] for r in flat} == {None}
    none = panels.colored_markers(panels.top_sites(sites({"X": 1.0}))).first()
    assert (none["radius"], none["color"]) == (25.0, None)
    scaled = {r["X"]: r for r in panels.scaled_markers(top).collect()}
    assert scaled[2.0]["radius"] == 18.0 and scaled[0.0]["popup"] == "Pollution: 5.00 particles/km²"


@pytest.mark.parametrize("width, zoom", [(1.0, 8), (6.0, 6), (20.0, 3), (60.0, 2)])
def test_map_zoom(sites, width, zoom):
    view = panels.map_view(sites({"X": 0.0, "Y": 0.0}, {"X": width, "Y": 1.0})).first()
    assert view["zoom"] == zoom and view["center_x"] == width / 2


def test_heat_layers(sites):
    df = sites(
        {"X": 1.0, "i_mid": 0.0},
        {"X": 2.0, "i_mid": 4.0},
        {"X": 3.0, "i_mid": 10.0},
        {"X": 4.0, "i_mid": None},
        {"X": None, "i_mid": 100.0},
    )
    assert {r["X"]: r["weight"] for r in panels.heat_points(df).collect()} == {2.0: 4.0, 3.0: 10.0}
    q95 = np.quantile([0, 4, 10], 0.95)
    capped = {r["X"]: r["weight"] for r in panels.heat_points_capped(df).collect()}
    assert capped == {2.0: pytest.approx(4 / q95), 3.0: 1.0}
    assert panels.heat_center(df).first()["center_x"] == 2.0
    assert tuple(panels.heat_center(df.limit(0)).first()) == (30.0, 0.0)
    zeros = sites(*[{"X": 1.0, "i_mid": 0.0}] * 50, {"X": 2.0, "i_mid": 3.0})
    assert panels.heat_points_capped(zeros).first()["weight"] == 1.0


def test_nonzero_sites_keep_missing(sites):
    df = sites(
        {"X": 1.0, "i_mid": 0.0, "i_low": 0.0, "i_high": 0.0},
        {"X": 2.0, "i_mid": 0.0, "i_low": 0.0, "i_high": None},
        {"X": 3.0, "i_mid": 0.0, "i_low": 0.0, "i_high": 1.0},
    )
    assert [r["X"] for r in panels.nonzero_sites(df).collect()] == [2.0, 3.0]


def test_top_by_month(sites):
    rows = [{"X": i / 8, "Y": 1.0, "i_high": 1.0, **months("i_mid", [i, -i] + [1] * 10)} for i in range(30)]
    df = sites(*rows, {"X": 99.0, "i_high": 1.0, "i_mid_jan": None})
    top = panels.top_sites_by_month(df, 15)
    rows = top.collect()
    assert len(rows) == 180 and [r["month_index"] for r in rows] == sorted(r["month_index"] for r in rows)
    jan = [r for r in rows if r["month"] == "jan"]
    assert [r["monthly_input"] for r in jan[:2]] == [29.0, 28.0] and jan[0]["month_name"] == "January"
    assert jan[0]["river_id"] == "3.625_1.0" and jan[0]["river_display"] == "3.63°E, 1.0°N"
    assert [r["X"] for r in rows if r["month"] == "mar"] == [i / 8 for i in range(15)]
    assert panels.axis_limit(top).first()[0] == pytest.approx(29 * 1.1)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_severity_tables(sites):
    df = sites(
        {"X": 1.0, "area": 2.0, "i_high": 4.0, "mpw": 10.0, "runoff_jul": 1.0, "i_mid": None},
        {"X": 2.0, "area": 0.0, "i_high": 4.0, "mpw": 5.0, "runoff_jul": 2.0, "i_mid": 1.0},
    )
    table = panels.severity_table(df).collect()
    assert [(r["marker_size"], r["on_log_axes"]) for r in table] == [(25.0, True), (15.0, False)]
    risk = panels.risk_table(df).collect()
    assert [(r["risk"], r["marker_size"]) for r in risk] == [(20.0, 35.0), (None, None)]
    assert panels.area_vs_weight(df).collect()[0]["mpw"] == 5.0
    assert panels.weight_vs_runoff(df).columns == ["mpw", "runoff_jul", "i_mid"]
    long = panels.runoff_long(df.withColumn("runoff_jan", F.lit(None).cast("double")))
    assert long.count() == 22 and {r["Month"] for r in long.collect()} == {m.title() for m in MONTHS[1:]}


def test_concentration_classes(sites):
    df = sites(*[{"X": float(i), "i_mid": float(v)} for i, v in enumerate(range(20, 0, -1))], {"X": 50.0, "i_mid": None})
    rows = {r["i_mid"]: r for r in panels.concentration_points(df).collect()}
    limits = np.quantile(range(1, 21), [0.25, 0.5, 0.75, 0.9])
    for v, r in rows.items():
        i = int(np.searchsorted(limits, v))
        assert r["concentration_category"] == panels.CONCENTRATION_CLASSES[i]
        assert r["log_concentration"] == pytest.approx(math.log1p(v))
    zeros = panels.concentration_points(sites(*[{"X": 1.0}] * 50, {"X": 2.0, "i_mid": 3.0}))
    assert {r["i_mid"]: r["size_factor"] for r in zeros.collect()} == {0.0: None, 3.0: 20.0}
    counts = panels.class_counts(panels.concentration_points(df)).collect()
    assert {r["concentration_category"]: r["points"] for r in counts}["Low"] == 5
    assert "Low (5 points)" in {r["label"] for r in counts}
    text = panels.hover_text(panels.concentration_points(df)).where("i_mid = 20").first()
    assert text["location_text"] == "0.00°E, 0.00°N" and text["log_text"] == "3.04"


def test_numeric_summary(spark):
    df = spark.createDataFrame([(1.0, 5, "a"), (2.0, 5, "b"), (4.0, 5, None), (None, 5, None)], "v double, n int, s string")
    assert stats.numeric_columns(df) == ["v", "n"]
    v, n = stats.numeric_summary(df).collect()
    assert tuple(v)[:9] == ("v", 3, pytest.approx(7 / 3), pytest.approx(1.5275252316519), 1.0, 1.5, 2.0, 3.0, 4.0)
    assert (n["count"], n["std"], n["p50"]) == (4, 0.0, 5.0)


def test_month_distribution(sites):
    df = sites(*[months("i_mid", [i] * 12) for i in (1, 2, 3, 10)])
    row = stats.month_distribution(df, DEFAULT_ROLES.pollution_columns).where("month = 'may'").first()
    q1, q3 = np.quantile([1, 2, 3, 10], [0.25, 0.75])
    assert (row["p25"], row["p75"]) == (q1, q3)
    assert row["upper_fence"] == pytest.approx(q3 + 1.5 * (q3 - q1))


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 29, 30, 30)] + [(None,), (NAN,)], "v double")
    rows = {r["bin"]: r for r in stats.histogram(df, "v").collect()}
    assert {b: r["count"] for b, r in rows.items()} == {1: 1, 2: 1, 3: 1, 30: 3}
    assert (rows[2]["bin_start"], rows[2]["bin_end"]) == (1.0, 2.0)
    flat = spark.createDataFrame([(5.0,)] * 4, "v double")
    assert [r["count"] for r in stats.histogram(flat, "v").collect()] == [4]


def test_extremes_and_largest(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 500.5), (0.5, 500.5), (3.0, NAN)], "x double, v double")
    assert tuple(stats.extremes(df, "v").first()) == (5.0, 500.5, True)
    assert stats.row_of_maximum(df, "v", ["x"]).first()["x"] == 0.5


def test_correlation_matrix(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(1e9, 1, 200)
    b = a * -2 + rng.normal(0, 1, 200)
    rows = [
        (float(x), float(y) if i % 5 else None, 7.1, NAN if i % 3 else float(i)) for i, (x, y) in enumerate(zip(a, b))
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    got = {(r["column_a"], r["column_b"]): r["r"] for r in stats.correlation_matrix(df).collect()}
    want = pd.DataFrame(rows, columns=list("abcd"), dtype=float).corr()
    assert len(got) == 16
    for (i, j), r in got.items():
        if "c" in (i, j):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[i, j], abs=1e-6)


def test_trend_surface(sites):
    df = sites(*[{"X": float(i % 20), "Y": float(i // 20), "i_mid": float(i)} for i in range(400)])
    rows = {(r["x_node"], r["y_node"]): r for r in stats.trend_surface(df).collect()}
    assert len(rows) == 400
    assert rows[3, 2]["level"] == pytest.approx(math.log1p(43)) and rows[3, 2]["x"] == 3.0
    sparse = sites(*[{"X": 0.0 if i else 19.0, "Y": 0.0 if i else 19.0, "i_mid": 1.0} for i in range(101)])
    assert sum(r["level"] > 0 for r in stats.trend_surface(sparse).collect()) == 2
    assert stats.trend_surface(sparse.limit(100), min_points=100).collect() == []
    assert len(stats.trend_surface(sparse.limit(3)).collect()) == 400


def correlations(df):
    return {(r["column_a"], r["column_b"]): r["r"] for r in stats.correlation_matrix(df).collect()}


def test_correlation_does_not_hang_on_row_order(spark):
    rng = np.random.default_rng(3)
    a = 1e9 + rng.normal(size=5000)
    rows = [(float(x), float(x + 0.03 * e), float(e)) for x, e in zip(a, rng.normal(size=5000))]
    missing = [(None, None, float(i)) for i in range(300)]
    want = np.corrcoef(a - 1e9, np.array([r[1] for r in rows]) - 1e9)[0, 1]
    for given in (missing + rows, rows + missing):
        for parts in (1, 5):
            got = correlations(spark.createDataFrame(given, "a double, b double, c double").coalesce(parts))
            assert got["a", "b"] == pytest.approx(want, abs=1e-7) and got["a", "a"] == pytest.approx(1.0)


def test_correlation_leaves_infinite_values_out(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.5, 6.0), (3.0, 5.0, 7.5), (math.inf, None, 8.0), (4.0, 9.0, 1.0)]
    got = correlations(spark.createDataFrame(rows, "a double, b double, c double"))
    assert got["c", "a"] == pytest.approx(-0.4876, abs=1e-4) and got["b", "a"] == pytest.approx(0.9579, abs=1e-4)


def test_months_without_nan(sites):
    df = sites({**months("i_mid", range(12))}, {**months("i_mid", range(12)), "i_mid_jan": NAN})
    assert reshape.monthly_totals(df, DEFAULT_ROLES.pollution_columns).first()["total"] == 0.0
    assert reshape.monthly_means(df, DEFAULT_ROLES.pollution_columns).first()["average"] == 0.0


def test_histogram_reports_infinity_apart(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, math.inf, -math.inf, NAN]], "v double")
    rows = {r["bin"]: r["count"] for r in stats.histogram(df, "v", 3).collect() if r["bin"] is not None}
    outside = {r["bin_start"]: r["count"] for r in stats.histogram(df, "v", 3).collect() if r["bin"] is None}
    assert rows == {1: 1, 2: 1, 3: 2} and outside == {math.inf: 1, -math.inf: 1}


def test_quality(sites):
    df = sites({"X": 1.0, "i_mid": None}, {"X": NAN, "i_mid": 2.0}, {"X": 3.0, "i_mid": 2.0}, {"X": 4.0, "i_mid": NAN})
    missing = {r["column"]: r["missing"] for r in quality.missing_by_column(df).collect()}
    assert missing["X"] == 1 and missing["i_mid"] == 2 and missing["Y"] == 0 and len(missing) == 55
    assert quality.missing_total(df).first()[0] == 3
    assert tuple(quality.table_shape(df).first()) == (4, 55)
    score = quality.completeness(df).first()
    assert (score["score"], score["band"], score["delta"], score["on_target"]) == (62.5, "medium", -27.5, False)
    assert quality.completeness(df.limit(0)).first()["score"] == 0.0
    assert [r["X"] for r in quality.clean_sites(df).collect()] == [3.0]
    assert quality.drop_missing(df, ["X"]).count() == 3
    assert list(df.columns) == list(SITE_COLUMNS)


def test_samples(spark):
    df = spark.range(5000).withColumn("v", F.rand(1)).repartition(7)
    first = sorted(r["id"] for r in sampling.sample_rows(df, ["id"], 1500).collect())
    again = sorted(r["id"] for r in sampling.sample_rows(df.repartition(3), ["id"], 1500).collect())
    assert len(set(first)) == 1500 and first == again
    other = {r["id"] for r in sampling.sample_rows(df, ["id"], 1500, seed=7).collect()}
    assert other != set(first) and abs(sum(first) / 1500 - 2500) < 200
    assert sampling.sample_rows(df.limit(10), ["id"], 1500).count() == 10
    share = sorted(r["id"] for r in sampling.sample_share(df, ["id"], 1000).collect())
    assert len(share) == 1000 and share == sorted(r["id"] for r in sampling.sample_share(df.repartition(3), ["id"], 1000).collect())
    assert sampling.sample_share(df, ["id"], 10000).count() == 5000
    with pytest.raises(ValueError):
        sampling.sample_share(df.limit(0), ["id"])
    with pytest.raises(ValueError):
        sampling.require_rows(df.limit(0))
    assert [r["id"] for r in sampling.head(df, 3, ["id"]).collect()] == [0, 1, 2]


def test_empty_tables(sites):
    df = sites().limit(0)
    assert panels.top_sites(df).collect() == []
    assert panels.heat_points_capped(df).collect() == []
    assert panels.hover_text(panels.concentration_points(df)).collect() == []
    assert panels.top_sites_by_month(df).collect() == []
    assert stats.histogram(df, "i_mid").collect() == []
    assert stats.month_distribution(df, DEFAULT_ROLES.pollution_columns).collect() == []
    assert {r["r"] for r in stats.correlation_matrix(df, ["X", "Y"]).collect()} <= {None}
    assert panels.map_view(df).first()["center_y"] == 0.0
    assert tuple(quality.table_shape(df).first()) == (0, 55)


def test_largest_rows_with_ties_and_small_groups(spark):
    df = spark.createDataFrame(
        [("a", i, float(i % 5)) for i in range(4000)] + [("b", i, float(i)) for i in range(3)], "g string, i int, v double"
    )
    got = largest_rows(df, "g", "v", [F.col("i")], 10, spread=["i"]).collect()
    assert [r["i"] for r in sorted(got, key=lambda r: r["rank"]) if r["g"] == "a"] == [4 + 5 * n for n in range(10)]
    assert sorted(r["i"] for r in got if r["g"] == "b") == [0, 1, 2]


def test_correlation_takes_one_scan_and_bears_drifting_values(spark):
    tracker = spark.sparkContext.statusTracker()
    rng = np.random.default_rng(12)
    # Sorted far from zero: every batch and every task has a mean of its own.
    a = np.sort(1e7 + rng.normal(0, 1e5, 30_000))
    b = a + rng.normal(0, 1e5, 30_000)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "c": np.where(np.arange(30_000) < 20, 5.0, np.nan)})).repartitionByRange(7, "a")
    spark.sparkContext.setJobGroup("one-scan", "correlations")
    result = stats.correlation_matrix(df)
    assert not list(tracker.getJobIdsForGroup("one-scan"))
    got = {(r["column_a"], r["column_b"]): r["r"] for r in result.collect()}
    assert result._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert got["a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9) and got["c", "c"] is None and got["a", "c"] is None
