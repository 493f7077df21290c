"""History of a stream of readings as state per source.

Each source keeps its last readings in a list of the stream's state store, so a
batch reads and writes the sources it holds and no others. The store lives in
the stream's checkpoint: a restarted stream goes on from its last finished batch, and the kept
readings are read from there, at any finished batch, without a table beside it.

A source that sends a large part of all readings is split over ``salts`` lists by
a hash of the reading; each list keeps the last readings of its part, and the reader takes the last of all parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from runnel.streaming.readings import HISTORY, latest_readings

#: List state needs this store; with the change log, a batch writes what it changed and not the whole store.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_STATE = "kept"
_SALT = "_salt"


class LastReadings(StatefulProcessor):
    """Keeps the last ``keep`` rows of a key, by ``order``, in list state; says how many it holds."""

    def __init__(self, schema: str, columns: Sequence[str], order: Sequence[str], keep: int):
        self.schema, self.columns, self.keep = schema, list(columns), keep
        self.order = [self.columns.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState(_STATE, self.schema)

    def _place(self, row: tuple) -> tuple:
        # Missing order values come first, as when Spark sorts from the newest down.
        return tuple((row[i] is not None, row[i]) if row[i] is not None else (False, 0) for i in self.order)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = [tuple(row) for row in self.kept.get()] if self.kept.exists() else []
        for part in rows:
            values = part[self.columns].astype(object).where(part[self.columns].notna(), None)
            new = [tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in row) for row in values.itertuples(index=False, name=None)]
            held = sorted(held + new, key=self._place)[-self.keep :]
        self.kept.put(held)
        yield pd.DataFrame({"source": [key[0]], "kept": [len(held)]})

    def close(self) -> None:
        pass


def start_history(
    readings: DataFrame, checkpoint: str, source: str, order: Sequence[str], keep: int = HISTORY, salts: int = 1, available_now: bool = True
) -> StreamingQuery:
    """Start a stream that keeps the last ``keep`` readings per source in its state under ``checkpoint``.

    ``checkpoint`` must be a shared folder. Start it again with the same arguments to go on
    where it stopped.
    """
    spark = readings.sparkSession
    columns = [c for c in readings.columns if c != source]
    schema = ", ".join(f"`{c}` {readings.schema[c].dataType.simpleString()}" for c in columns)
    keyed = readings.withColumn(_SALT, F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int"))
    kind = readings.schema[source].dataType.simpleString()
    counts = keyed.groupBy(source, _SALT).transformWithStateInPandas(
        LastReadings(schema, columns, order, keep), f"source {kind}, kept int", "Update", "None"
    )
    writer = counts.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    # A stream keeps the settings that it started with.
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return writer.start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def read_history(spark: SparkSession, checkpoint: str, source: str, order: Sequence[str], keep: int = HISTORY, batch: int | None = None) -> DataFrame:
    """The readings kept after the last finished batch, or after ``batch``."""
    reader = spark.read.format("statestore").option("stateVarName", _STATE)
    if batch is not None:
        reader = reader.option("batchId", batch)
    rows = reader.load(checkpoint).select(f"key.`{source}`", "list_element.*")
    return latest_readings(rows, source, order, keep)
