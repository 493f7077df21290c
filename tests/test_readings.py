import datetime as dt

from runnel.streaming import history, readings

SCHEMA = "source string, reading_id bigint, ts timestamp, cpu_percent double, memory_percent double, cpu_temp double, gpu_temp double"
START = dt.datetime(2024, 1, 1)


def frame(spark, *rows):
    return spark.createDataFrame([(s, i, START + dt.timedelta(seconds=i), *m) for s, i, *m in rows], SCHEMA)


def test_status_and_alerts(spark):
    df = frame(
        spark,
        ("a", 1, 69.9, 70.0, 84.9, 75.0),
        ("a", 2, 90.0, 89.9, 85.0, 10.0),
        ("a", 3, 1.0, 1.0, 70.0, 75.5),
    )
    rows = {r["reading_id"]: r for r in readings.with_status(df).collect()}
    assert [rows[1][f"{m}_status"] for m in readings.STATUS_LIMITS] == ["good", "warning", "warning"]
    assert [rows[2][f"{m}_status"] for m in readings.STATUS_LIMITS] == ["critical", "warning", "critical"]
    assert sorted(r["reading_id"] for r in readings.alerts(df).collect()) == [1, 2, 3]
    assert readings.alerts(frame(spark, ("a", 4, 99.0, 99.0, 70.0, 75.0))).collect() == []


def test_gauges(spark):
    rows = {r["metric"]: r for r in readings.gauges(frame(spark, ("a", 1, 95.0, None, None, 60.0)), ["reading_id"]).collect()}
    cpu, memory, temp, gpu = (rows[m] for m in readings.GAUGES)
    assert (cpu["delta"], cpu["band"], cpu["over_threshold"]) == (45.0, "lightcoral", True)
    assert (memory["value"], memory["delta"], memory["band"]) == (0.0, -60.0, "lightgreen")
    assert (temp["value"], gpu["band"], gpu["over_threshold"]) == (45.0, "yellow", False)


def test_history(spark):
    rows = [("hot", i, float(i), 1.0, 1.0, 80.0) for i in range(120)] + [("one", 1, 1.0, 1.0, 1.0, 1.0)]
    df = frame(spark, *rows).repartition(5)
    kept = readings.latest_readings(df, "source", ["ts", "reading_id"])
    assert sorted(r["reading_id"] for r in kept.where("source = 'hot'").collect()) == list(range(70, 120))
    chart = readings.metric_history(df, "source", ["ts", "reading_id"])
    assert {r["source"] for r in chart.collect()} == {"hot"}
    cpu = {r["reading_index"]: r for r in chart.where("metric = 'cpu_percent'").collect()}
    assert len(cpu) == 50 and cpu[0]["value"] == 70.0 and not cpu[0]["over_line"] and cpu[49]["over_line"]
    assert "WindowGroupLimit" in chart._jdf.queryExecution().executedPlan().toString()


def test_streamed_history_equals_the_batch(spark, tmp_path):
    source, kept = tmp_path / "in", str(tmp_path / "kept")
    rows = [(f"s{i % 3}", i, float(i), 1.0, 1.0, 1.0) for i in range(300)]
    for part in range(3):
        frame(spark, *rows[part * 100 : part * 100 + 100]).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    for _ in range(2):  # the second start finds nothing new
        writer = history.history_writer(stream, kept, "source", ["ts", "reading_id"], keep=20)
        run = writer.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
        run.awaitTermination()
    got = {r["reading_id"] for r in history.read_history(spark, kept).collect()}
    assert got == set(range(240, 300))
    assert sorted(p.name for p in (tmp_path / "kept").iterdir()) == ["batch=1", "batch=2"]


def test_alerts_on_a_stream(spark, tmp_path):
    frame(spark, ("a", 1, 1.0, 1.0, 99.0, 1.0), ("a", 2, 1.0, 1.0, 1.0, 1.0)).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    out = readings.gauges(readings.with_status(readings.alerts(stream)), ["reading_id", "cpu_temp_status"])
    run = out.writeStream.format("memory").queryName("alerted").trigger(availableNow=True).start()
    run.awaitTermination()
    got = spark.sql("select distinct reading_id, cpu_temp_status from alerted").collect()
    assert [tuple(r) for r in got] == [(1, "critical")]
