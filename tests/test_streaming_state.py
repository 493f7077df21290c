"""Keyed state of a stream, limits over time, quantile sketches."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from runnel.operators import sketches
from runnel.streaming import keyed, limits, readings

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "source string, ts timestamp_ntz, reading_id bigint, v double, note string"
ORDER = ["ts", "reading_id"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def batch(rng, start, n, sources):
    return [(rng.choice(sources), DAY + dt.timedelta(minutes=rng.randrange(5000)) if rng.random() > 0.05 else None, start + i, rng.random(), rng.choice(["a", None])) for i in range(n)]


@pytest.mark.parametrize("salts", [1, 3])
def test_restarts_and_small_batches(spark, tmp_path, salts):
    rng = random.Random(salts)
    sources = [f"s{i}" for i in range(100)]
    state, folder = str(tmp_path / "state"), str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    everything, touched = [], []
    for n, chosen in ((1500, sources), (40, sources[:1]), (600, sources[20:40])):
        rows = batch(rng, len(everything), n, chosen)
        everything += rows
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(folder)
        # Each round is a stream started anew on the same checkpoint.
        keyed.start_history(stream, state, "source", ORDER, keep=5, salts=salts).awaitTermination()
        changes = spark.read.format("statestore").option("stateVarName", "kept").option("readChangeFeed", True)
        feed = changes.option("changeStartBatchId", len(touched)).option("changeEndBatchId", len(touched)).load(state)
        touched.append({r[0] for r in feed.select("key.source").distinct().collect()})
        want = rows_of(readings.latest_readings(spark.createDataFrame(everything, SCHEMA), "source", ORDER, 5))
        assert rows_of(keyed.read_history(spark, state, "source", ORDER, 5).select("source", "ts", "reading_id", "v", "note")) == want
    # A batch of one source writes the lists of that source and no others.
    assert touched == [set(sources), {"s0"}, set(sources[20:40])]
    first = readings.latest_readings(spark.createDataFrame(everything[:1500], SCHEMA), "source", ORDER, 5)
    assert rows_of(keyed.read_history(spark, state, "source", ORDER, 5, batch=0).select(*first.columns)) == rows_of(first)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_limits_against_a_loop(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "c", None]), i, DAY + dt.timedelta(hours=rng.randrange(100)) if i % 9 else None, rng.uniform(0, 100), None if i % 7 == 0 else rng.uniform(0, 100)) for i in range(300)]
    df = spark.createDataFrame(rows, "source string, reading_id bigint, ts timestamp_ntz, cpu_percent double, cpu_temp double")
    table = [("a", "cpu_percent", DAY + dt.timedelta(hours=h), 10.0 + h, 50.0 + h) for h in (10, 30, 31, 90)]
    table += [("a", "cpu_percent", DAY + dt.timedelta(hours=30), 5.0, 6.0)]  # the same start: the larger one holds
    table += [("b", "cpu_temp", None, 1.0, 2.0), (None, "cpu_percent", None, 60.0, 80.0), (None, "cpu_percent", DAY + dt.timedelta(hours=50), 61.0, None)]
    got = limits.with_limits(df, spark.createDataFrame(table, "source string, metric string, valid_from timestamp_ntz, warning double, critical double"), ["cpu_percent", "cpu_temp"], ["source", "reading_id", "ts"])

    def held(source, metric, ts):
        fits = [t for t in table if t[0] == source and t[1] == metric and (t[2] is None or ts is not None and t[2] <= ts)]
        best = max(fits, key=lambda t: (t[2] or dt.datetime.min, t[3]), default=None)
        # Without a time, only a limit that holds from ever and for good can be told.
        if ts is None and best is not None and any(t[0] == source and t[1] == metric and t[2] for t in table):
            return None
        return best

    want = []
    for source, i, ts, cpu, temp in rows:
        for metric, value in (("cpu_percent", cpu), ("cpu_temp", temp)):
            best = (held(source, metric, ts) if source is not None else None) or held(None, metric, ts)
            want.append((source, i, ts, metric, value, *(best[3:] if best else (None, None))))
    assert rows_of(got) == sorted(want, key=str)


def test_many_limits_meet_in_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(limits, "SMALL", 0)
    df = spark.createDataFrame([(1, 1, DAY, 75.0, 20.0, 90.0)], "source bigint, reading_id bigint, ts timestamp_ntz, cpu_percent double, memory_percent double, cpu_temp double")
    met = limits.with_limits(df, limits.default_limits(spark), list(readings.STATUS_LIMITS), ["source", "reading_id", "ts"])
    got = {r.metric: r.s for r in met.select("metric", readings.status("value", F.col("warning"), F.col("critical")).alias("s")).collect()}
    assert got == {"cpu_percent": "warning", "memory_percent": "good", "cpu_temp": "critical"}
    assert limits.default_limits(spark).count() == 4


# Sketches ------------------------------------------------------------------------


def test_sketches_do_not_depend_on_partitions(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), rng.choice([rng.gauss(0, 50), rng.uniform(1e-9, 1e9), 0.0, 7.0]), rng.random() if rng.random() > 0.1 else None) for _ in range(4000)]
    rows += [("a", float("inf"), None), ("b", float("-inf"), None), ("b", float("nan"), None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    whole = rows_of(sketches.quantile_sketch(df, ["x", "y"], ["g"]))
    assert rows_of(sketches.quantile_sketch(df.repartition(7), ["x", "y"], ["g"])) == whole
    parts = [sketches.quantile_sketch(df.where(F.pmod(F.hash("x", "y"), F.lit(3)) == i), ["x", "y"], ["g"]) for i in range(3)]
    assert rows_of(sketches.merged_sketches(parts[2].union(parts[0]).union(parts[1]), ["g"])) == whole
    coarse = sketches.merged_sketches(sketches.quantile_sketch(df, ["x", "y"], ["g"]))
    assert rows_of(coarse) == rows_of(sketches.quantile_sketch(df, ["x", "y"]))


@pytest.mark.parametrize("error", [0.005, 0.05])
def test_rank_and_value_errors_are_as_stated(spark, error):
    rng = random.Random(7)
    values = {"x": [rng.gauss(0, 1000) for _ in range(5000)], "y": [float(rng.randrange(4)) for _ in range(5000)], "z": [rng.lognormvariate(0, 5) for _ in range(5000)]}
    df = spark.createDataFrame(list(zip(*values.values())), "x double, y double, z double")
    sketch = sketches.quantile_sketch(df, list(values), error=error)
    assert max(Counter(r.column for r in sketch.collect()).values()) < 1400 / error
    for r in sketches.sketched_quantiles(sketch, [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]).collect():
        sorted_values = sorted(values[r.column])
        rank = int(r.probability * (len(sorted_values) - 1))
        exact = sorted_values[rank]
        assert r.low * (1 + 1e-9) - 1e-9 <= exact <= r.high * (1 + 1e-9) + 1e-9 or r.high * (1 - 1e-9) <= exact <= r.low
        assert abs(r.value - exact) <= error * 1.001 * abs(exact) + 1e-9
        # How many ranks lie between the given value and the exact one.
        between = sum(min(r.value, exact) < v < max(r.value, exact) for v in sorted_values)
        assert between <= r.rank_error * len(sorted_values)


def test_sketch_is_one_scan(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    plan = sketches.quantile_sketch(df, ["x"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Aggregate") == 1
    assert sketches.sketched_quantiles(sketches.quantile_sketch(df.where("false"), ["x"]), [0.5]).collect() == []
