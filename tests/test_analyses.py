import statistics

import pytest
from conftest import months

from runnel.operators import correlation, hotspots, seasonal, severity
from runnel.schema import POSITIONAL, SiteRoles

NAN = float("nan")


def test_seasonal_counts_positive_values(sites):
    df = sites(
        {"X": 1.0, "Y": 1.0, **months("i_mid", [1, 0, -3] + [0] * 9)},
        {"X": 2.0, "Y": 1.0, **months("i_mid", [3, NAN, 2] + [0] * 9)},
        {"X": None, "Y": 1.0, **months("i_mid", [100] * 12)},
        {"X": 3.0, "Y": 1.0, **months("i_mid", [100] * 12), "i_mid_dec": None},
    )
    rows = {r["month"]: r.asDict() for r in seasonal.seasonal_stats(df).collect()}
    assert set(rows) == {"jan", "mar"}
    jan = rows["jan"]
    assert (jan["average_pollution"], jan["std_deviation"], jan["active_locations"]) == (2.0, 1.0, 2)
    assert jan["total_pollution"] == 4.0 and rows["mar"]["min_pollution"] == 2.0


def test_seasonal_total_is_mean_times_count(sites):
    df = sites(*[{"X": float(i), **months("i_mid", [i + m / 7 for m in range(12)])} for i in range(1, 30)])
    for r in seasonal.seasonal_stats(df).collect():
        assert r["total_pollution"] == pytest.approx(r["average_pollution"] * r["active_locations"], abs=1e-4)


def test_seasonal_presets_differ(sites):
    df = sites({"X": 1.0, "i_high": 7.0, **months("i_mid", [2] * 12), **months("i_high", [3] * 12)})
    by_position = seasonal.seasonal_stats(df, SiteRoles(months=POSITIONAL)).collect()
    assert {r["month"]: r["max_pollution"] for r in by_position}["jan"] == 7.0
    assert {r["max_pollution"] for r in seasonal.seasonal_stats(df).collect()} == {2.0}


def test_seasonal_variance(sites):
    values = [1.0, 2.0, 4.5, 0.0, -1.0, NAN] + [0.0] * 6
    df = sites({"X": 1.0, **months("i_mid", values)}, {"X": 2.0, **months("i_mid", [5] + [0] * 11)})
    got = {r["X"]: r["variance"] for r in seasonal.with_seasonal_variance(df).collect()}
    assert got[1.0] == pytest.approx(statistics.pvariance([1.0, 2.0, 4.5]))
    assert got[2.0] == 0.0


def test_hotspot_rules(sites):
    df = sites(
        {"X": -43.21, "Y": 5.01, "i_mid": 100.0, "area": 1e6},
        {"X": -43.25, "Y": 5.02, "i_mid": 300.0, "area": 0.0},
        {"X": 10.0, "Y": 10.0, "i_mid": 1000.0, "area": 1e6},  # alone in its cell
        {"X": 20.0, "Y": 20.0, "i_mid": 0.02, "area": 1e6},  # score too low
        {"X": 20.01, "Y": 20.0, "i_mid": 0.02, "area": 1e6},
        {"X": 20.01, "Y": 20.0, "i_mid": 0.01, "area": 1e6},  # not above the threshold
        {"X": -43.22, "Y": 5.03, "i_mid": NAN, "area": 1e6},
        {"X": -43.23, "Y": 5.03, "i_mid": 50.0, "area": None},
    )
    (row,) = hotspots.hotspots(df).collect()
    assert row["grid"] == "grid_-43.2_5.0"
    assert row["locations_count"] == 2 and row["total_pollution"] == 400.0
    assert row["average_density"] == 50.0
    assert row["hotspot_score"] == 400.0 * 2 * 50 / 1000
    assert row["sample_locations"] == ["-43.25,5.02", "-43.21,5.01"]


def test_hotspot_invariants(sites):
    df = sites(
        *[{"X": (i % 40) / 16 - 1, "Y": (i % 7) / 16, "i_mid": float(i), "area": 1e5 * (i % 4)} for i in range(400)]
    )
    rows = hotspots.hotspots(df, grid_size=0.5).collect()
    assert rows
    for r in rows:
        score = r["total_pollution"] * r["locations_count"] * r["average_density"] / 1000
        assert r["hotspot_score"] == pytest.approx(score, rel=1e-4)
        assert r["hotspot_score"] > 0.1 and r["locations_count"] >= 2
        assert len(r["sample_locations"]) == min(5, r["locations_count"])
        for place in r["sample_locations"]:
            x, y = (int(float(v) / 0.5) * 0.5 for v in place.split(","))
            assert r["grid"] == f"grid_{x}_{y}"


def features(spark, values):
    return spark.createDataFrame([(float(i), 0.0, float(v), 1.0) for i, v in enumerate(values)],
                                 "x double, y double, pollution double, density double")


def test_severity_four_values(spark):
    t = severity.severity_thresholds(features(spark, [1, 2, 3, 4]))
    assert (t.count, t.low, t.medium, t.high, t.critical) == (4, 2.0, 3.0, 4.0, 4.0)
    rows = severity.severity_report(features(spark, [1, 2, 3, 4]), t).collect()
    assert {r["category"]: r["count"] for r in rows} == {"LOW": 2, "MEDIUM": 1, "HIGH": 1}


def test_severity_ties_go_low(spark):
    values = [1, 1, 1, 1, 1, 2, 3, 4]
    rows = severity.severity_report(features(spark, values)).collect()
    assert {r["category"]: r["count"] for r in rows} == {"LOW": 5, "HIGH": 2, "CRITICAL": 1}


@pytest.mark.parametrize("n", [1, 3, 101, 1000])
def test_severity_counts_follow_ranks(spark, n):
    values = [((i * 7919) % 100003) / 7 for i in range(1, n + 1)]
    t = severity.severity_thresholds(features(spark, values))
    ordered = sorted(values)
    assert [t.low, t.medium, t.high, t.critical] == [ordered[int(n * p)] for p in severity.FRACTIONS]
    counts = {r["category"]: r["count"] for r in severity.severity_report(features(spark, values), t).collect()}
    assert counts.get("LOW", 0) + counts.get("MEDIUM", 0) == int(0.5 * n) + 1
    assert counts.get("CRITICAL", 0) == n - int(0.75 * n) - 1


def test_severity_features(sites):
    df = sites(
        {"X": 1.0, "i_mid": 2.0, "area": 1e6},
        {"X": 2.0, "i_mid": 0.0, "area": 1e6},
        {"X": 3.0, "i_mid": NAN, "area": 1e6},
        {"X": 4.0, "i_mid": 2.0, "area": 1e6, "i_mid_may": None},
        {"X": 5.0, "i_mid": 2.0, "area": 1e6, "i_high": None},
        {"X": 6.0, "i_mid": 2.0, "area": 1e6, "i_low_may": None},
    )
    got = severity.severity_features(df).orderBy("x").collect()
    assert [r["x"] for r in got] == [1.0, 6.0]
    assert got[0]["density"] == 2.0 and got[0]["variance"] == 0.0


def test_severity_of_nothing(spark):
    empty = features(spark, [])
    assert severity.severity_thresholds(empty).low is None
    assert severity.severity_report(empty).collect() == []


def pearson(pairs):
    return statistics.correlation([p for p, _ in pairs], [r for _, r in pairs])


def test_correlation_pools_rows_of_a_site(sites):
    a, ra = [1, 2, 3, 4] + [0] * 8, [2, 1, 4, 9] + [0] * 8
    b, rb = [5, 1, 2] + [0] * 9, [1, 8, 2] + [0] * 9
    two, rtwo = [9, 9] + [0] * 10, [1, 2] + [0] * 10
    df = sites(
        {"X": 1.5, "Y": 2.0, **months("i_mid", a), **months("runoff", ra)},
        {"X": 1.5, "Y": 2.0, **months("i_mid", b), **months("runoff", rb)},
        {"X": 1.5, "Y": 2.0, **months("i_mid", two), **months("runoff", rtwo)},
        {"X": 9.0, "Y": 2.0, **months("i_mid", two), **months("runoff", rtwo)},
    )
    (row,) = correlation.site_correlations(df).collect()
    pairs = list(zip(a[:4], ra[:4])) + list(zip(b[:3], rb[:3]))
    assert row["data_points"] == 7
    assert row["correlation"] == pytest.approx(pearson(pairs), abs=5e-5)
    assert row["avg_pollution"] == pytest.approx(sum(p for p, _ in pairs) / 7, abs=1e-6)


def test_correlation_signs_and_constants(sites):
    up, down = list(range(1, 13)), list(range(12, 0, -1))
    square = [1, 2] * 6
    flat = [1, 1, 2, 2] * 3
    df = sites(
        {"X": 1.0, **months("i_mid", up), **months("runoff", up)},
        {"X": 2.0, **months("i_mid", up), **months("runoff", down)},
        {"X": 3.0, **months("i_mid", square), **months("runoff", flat)},
        {"X": 4.0, **months("i_mid", [2] * 12), **months("runoff", up)},
        {"X": 5.0, **months("i_mid", up), **months("runoff", [NAN] * 12)},
        {"X": 6.0, **months("i_mid", up), **months("runoff", up), "runoff_dec": None},
    )
    got = correlation.site_correlations(df)
    assert {r["x"]: r["correlation"] for r in got.collect()} == {1.0: 1.0, 2.0: -1.0, 3.0: 0.0}
    rows = {r["strength"]: r for r in correlation.correlation_report(got).collect()}
    strong, none = rows["STRONG"], rows["NEGLIGIBLE"]
    assert (strong["total_locations"], strong["positive_correlations"], strong["negative_correlations"]) == (2, 1, 1)
    assert strong["avg_correlation"] == 0.0 and strong["sample_locations"] == ["1.0,0.0", "2.0,0.0"]
    assert (none["total_locations"], none["positive_correlations"], none["negative_correlations"]) == (1, 0, 0)


def test_strength_limits(spark):
    df = spark.createDataFrame([(v,) for v in (-0.7, 0.6999, 0.4, -0.3999, 0.2, 0.1999, 0.0)], "r double")
    got = [r[0] for r in df.select(correlation.correlation_strength("r")).collect()]
    assert got == ["STRONG", "MODERATE", "MODERATE", "WEAK", "WEAK", "NEGLIGIBLE", "NEGLIGIBLE"]


def test_no_row_leaves_the_cluster_for_a_hot_cell(spark, sites):
    """Half of the rows in one cell: the plan trims samples before the shuffle."""
    df = sites(*[{"X": 0.1 if i % 2 else float(i), "i_mid": 5.0, "area": 1e6} for i in range(40)])
    plan = hotspots.hotspots(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan and "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
    (row,) = hotspots.hotspots(df).collect()
    assert row["locations_count"] == 20 and row["sample_locations"] == ["0.1,0.0"] * 5
