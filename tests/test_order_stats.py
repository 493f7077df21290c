import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from runnel.operators.order_stats import nth_values, order_statistics, quantiles

P = [0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]


def frame(spark, *columns):
    rows = list(zip(*columns))
    return spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(len(columns))))


def floats(values):
    return [float(v) for v in values]


@pytest.mark.parametrize("budget", [1 << 17, 50, 3])
def test_quantiles_equal_linear_interpolation(spark, budget):
    rng = np.random.default_rng(7)
    data = [
        floats(rng.lognormal(0, 6, 700)),
        floats(rng.normal(-5, 1, 700)),
        floats(rng.integers(-3, 4, 700)),
    ]
    got = quantiles(frame(spark, *data), ["c0", "c1", "c2"], P, budget)
    for i, values in enumerate(data):
        assert got[f"c{i}"] == pytest.approx(list(np.quantile(values, P)), rel=1e-12)


@pytest.mark.parametrize("budget", [1 << 17, 4])
def test_hot_value_and_extremes(spark, budget):
    values = [1.5] * 300 + [-math.inf, math.inf, 5e-324, -5e-324, 0.0, -0.0, 1.7e308, -1.7e308, 1.5000000000000002]
    n, got = nth_values(frame(spark, values), "c0", [0.0, 0.01, 0.5, 0.99], budget)
    assert (n, got) == (len(values), [sorted(values)[int(n * p)] for p in [0.0, 0.01, 0.5, 0.99]])


def test_missing_values_do_not_count(spark):
    found = order_statistics(frame(spark, [3.0, None, math.nan, 1.0]), ["c0"], lambda n: range(n))["c0"]
    assert found.count == 2 and found.values == {0: 1.0, 1: 3.0}
    assert quantiles(frame(spark, [None, math.nan]), ["c0"], [0.5]) == {"c0": [None]}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=60), st.integers(2, 40))
def test_every_rank(spark, values, budget):
    found = order_statistics(frame(spark, values), ["c0"], lambda n: range(n), budget)["c0"]
    assert [found.values[i] for i in range(len(values))] == sorted(values)


def test_integer_and_odd_names(spark):
    df = spark.range(11).selectExpr("id as `a b`")
    assert quantiles(df, ["a b"], [0.5]) == {"a b": [5.0]}


@pytest.mark.parametrize("columns, budget", [(1, 64), (55, 1 << 12), (500, 1 << 13)])
def test_scans_return_no_more_rows_than_the_budget(spark, monkeypatch, columns, budget):
    from runnel.operators import order_stats

    returned = []
    plain = order_stats._histogram
    monkeypatch.setattr(order_stats, "_histogram", lambda counted: returned.append(counted.count()) or plain(counted))
    rng = np.random.default_rng(11)
    data = [floats(rng.choice([-1, 1], 60) * 2.0 ** rng.uniform(-1000, 1000, 60)) for _ in range(columns)]
    names = [f"c{i}" for i in range(columns)]
    got = quantiles(frame(spark, *data).coalesce(2), names, [0.5], budget)
    assert max(returned) <= budget
    assert all(got[c][0] == pytest.approx(float(np.median(v))) for c, v in zip(names, data))
