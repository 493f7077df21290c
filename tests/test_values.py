import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runnel.functions import text, values
from runnel.schema import BY_NAME, MONTHS, POSITIONAL, SITE_COLUMNS, SITE_SCHEMA, describe_columns


def column(spark, name, rows, kind="double"):
    return spark.createDataFrame([(r,) for r in rows], f"{name} {kind}")


def one(df):
    return [r[0] for r in df.collect()]


def test_site_columns_and_presets():
    assert len(SITE_COLUMNS) == 55
    assert SITE_COLUMNS[:8] == ("X", "Y", "i_mid", "i_low", "i_high", "i_mid_jan", "i_low_jan", "i_high_jan")
    assert SITE_COLUMNS[41] == "runoff_jan" and SITE_COLUMNS[53:] == ("mpw", "area")
    assert BY_NAME[0] == ("jan", "i_mid_jan", "runoff_jan")
    assert POSITIONAL[0] == ("jan", "i_high", "i_high_dec")
    assert POSITIONAL[11] == ("dec", "i_high_nov", "runoff_nov")


def test_column_dictionary(spark):
    rows = {r["column"]: r for r in describe_columns(spark).collect()}
    assert len(rows) == 55
    assert rows["area"]["unit"] == "m2"
    assert rows["i_low_feb"]["meaning"] == "low estimate of the microplastic concentration in February"


def test_positive_ignores_nan_and_null(spark):
    df = column(spark, "v", [1.0, 0.0, -1.0, float("nan"), None])
    assert one(df.where(values.positive("v"))) == [1.0]


def test_density_without_area(spark):
    df = spark.createDataFrame([(2.0, 4e6), (2.0, 0.0), (2.0, float("nan"))], "m double, a double")
    assert one(df.select(values.density("m", "a"))) == [0.5, 0.0, 0.0]


def test_grid_truncates_toward_zero(spark):
    df = column(spark, "x", [-43.2125, -0.05, 0.05, 11.07083333, float("nan")])
    cell = df.select(values.grid_index("x", 0.1).alias("i"))
    corners = one(cell.select(F.expr(values.grid_corner_sql("i", 0.1))))
    assert corners == [-43.2, 0.0, 0.0, 11.0, None]


def test_parse_float_is_strict(spark):
    good = {" 1.5 ": 1.5, "1e5": 1e5, "-.5": -0.5, "inf": math.inf, "Infinity": math.inf, "\t2\t": 2.0}
    bad = ["1.5d", "1.5F", "2f \t", "0x1p3", "-0X1P3", "infd", "1,000", "", "abc"]
    df = column(spark, "t", [*good, *bad], "string")
    assert one(df.select(values.parse_float("t"))) == [*good.values(), *[None] * len(bad)]
    assert math.isnan(one(column(spark, "t", ["nan"], "string").select(values.parse_float("t")))[0])


def test_to_number_drops_commas(spark):
    df = column(spark, "t", ["1,234.5", "x", None], "string")
    assert one(df.select(values.to_number("t"))) == [1234.5, None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=40, max_size=80))
def test_number_text_is_shortest_decimal(spark, numbers):
    edge = [0.0, 1e-4, 4.16667e-4, 9.99e-5, 1e-6, 1.5e-5, 1e7, 12345678.5, 1e15, 1e16, 1.25e20, -3e-7, 0.1, 100.0]
    # The largest magnitude in use; beyond it only the value is compared.
    texts = one(column(spark, "v", [*edge, *numbers]).select(text.number_text("v")))
    assert [float(t) for t in texts] == [*edge, *numbers]
    for t, v in zip(texts, edge):
        assert t == repr(v)


def test_json_object_reads_back(spark):
    df = spark.createDataFrame(
        [('a"b\\c', 1e-06, 5, ["1.0,2.0", "x\ty"])], "key string, v double, n bigint, list array<string>"
    )
    line = one(df.select(text.json_object(df.schema.fields)))[0]
    assert json.loads(line) == {"key": 'a"b\\c', "v": 1e-06, "n": 5, "list": ["1.0,2.0", "x\ty"]}
    assert '"v": 1e-06, "n": 5' in line


def test_month_labels(spark):
    df = column(spark, "c", ["i_mid_jan", "runoff_dec"], "string").select(text.month_label("c").alias("m"))
    got = df.select("m", text.month_title("m"), text.month_full_name("m"), text.month_index("m")).collect()
    assert [tuple(r) for r in got] == [("jan", "Jan", "January", 0), ("dec", "Dec", "December", 11)]


def test_labels_and_colours(spark):
    df = spark.createDataFrame([(9.8125, 37.32917)], "x double, y double")
    row = df.select(
        text.site_key("x", "y"), text.display_name("x", "y"), text.fixed("y", 3), text.grid_key("x", "y")
    ).first()
    assert tuple(row) == ("9.8125,37.32917", "9.81°E, 37.33°N", "37.329", "grid_9.8125_37.32917")
    ramp = one(column(spark, "t", [0.0, 0.5, 1.0, None]).select(text.ramp_color("t")))
    assert ramp == ["#00ff00", "#7f7f00", "#ff0000", None]


@pytest.mark.parametrize(
    "largest, divisor", [(0.0, 5000), (5.0, 0.5), (50.0, 5), (500.0, 50), (5000.0, 500), (50000.0, 5000)]
)
def test_radius_divisor(spark, largest, divisor):
    df = column(spark, "v", [largest])
    assert one(df.select(F.expr(values.radius_divisor_sql("v")))) == [divisor]


def test_scaling_helpers(spark):
    df = spark.createDataFrame([(2.0, 4.0), (8.0, 4.0), (0.0, 0.0)], "v double, q double")
    assert one(df.select(values.capped_share("v", "q"))) == [0.5, 1.0, 1.0]
    assert one(df.select(values.scaled_size("v", "q", 20))) == [15.0, 45.0, None]
    assert one(df.select(values.min_max_scaled("v", "q", "q"))) == [None, None, None]
    assert one(df.select(values.risk_score("v", "v", "q"))) == [1.0, 16.0, None]
    assert one(df.select(values.clamp("v", 1, 5))) == [2.0, 5.0, 1.0]


def test_schema_has_comments():
    assert SITE_SCHEMA["X"].metadata["comment"] == "longitude"
    assert len(MONTHS) == 12
