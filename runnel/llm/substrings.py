"""Removal of passages that an earlier document has, with a count-min prefilter.

A window is ``window`` words in a row. Its anchor is the smallest of the hashes
of the ``gram``-word runs in it (the leftmost of equal ones), so equal windows
have equal anchors at equal places, and neighbouring windows mostly share one.

Pass 1 counts anchors in a count-min sketch of two rows of cells: each task adds
up its own cells, the shuffle merges them, and an anchor's estimate is the smaller
of its two cells. A window that occurs twice brings its anchor twice, so the
estimate is never below the window's own count and no repeated window is lost.
Pass 2 hashes only the windows whose anchor is estimated to repeat, stores
them, and groups them exactly. Texts, windows and their groups are sent one after
another, and the shuffle files of each step go before the next.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runnel.llm.words import SLICE, SPACED, Words, buffers, release, rolling, slices, split_words
from runnel.sources.staging import free_exchanges, stage, staged

#: Cells of a sketch row for each anchor.
CELLS = 8


def window_anchors(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of all windows inside a document, position of each one's anchor, hashes of all grams)."""
    total = len(words.hashes)
    if total < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = rolling(words, gram)
    best = np.arange(len(hashes))
    span, wanted = 1, window - gram + 1
    while True:
        step = min(span, wanted - span)
        if not step:
            break
        left, right = best[: len(best) - step], best[step:]
        best = np.where(hashes[left] <= hashes[right], left, right)
        span += step
    last = np.repeat(words.first[1:], np.diff(words.first))[: len(best)]
    starts = np.flatnonzero(np.arange(len(best)) + window <= last)
    return starts, best[starts], hashes


def _documents(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))


def _anchors(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            words = split_words(part.column("text"), SPACED)
            _, at, hashes = window_anchors(words, window, gram)
            at = np.unique(at)
            doc = _documents(words)[at]
            yield pa.RecordBatch.from_arrays(
                [part.column("k1").take(pa.array(doc)), part.column("k2").take(pa.array(doc)), pa.array((at - words.first[doc]).astype(np.int32)), pa.array(hashes[at].view(np.int64))],
                names=["k1", "k2", "at", "anchor"],
            )


def _flat(lists: pa.Array, words: Words) -> np.ndarray:
    """Batch positions of positions within documents, given as a list per document; null lists are empty."""
    lists = lists.cast(pa.large_list(pa.int32()))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(words.first[:-1], sizes)


def _windows(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            words = split_words(part.column("text"), SPACED)
            starts, at, _ = window_anchors(words, window, gram)
            marked = np.zeros(len(words.hashes) + 1, bool)
            marked[_flat(part.column("ats"), words)] = True
            starts = starts[marked[at]]
            hashes = rolling(words, window)[starts] if len(starts) else np.zeros(0, np.uint64)
            doc = _documents(words)[starts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)), part.column("id").take(pa.array(doc)), part.column("k1").take(pa.array(doc)), part.column("k2").take(pa.array(doc)),
                    pa.array((starts - words.first[doc]).astype(np.int32)),
                ],
                names=["h", "id", "k1", "k2", "start"],
            )


def kept_text(words: Words, offsets: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Kept words of every document joined by one space."""
    starts, ends = words.starts[keep], words.ends[keep]
    doc = _documents(words)[keep]
    data = words.data.copy()
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    np.subtract.at(edge, ends, 1)
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    gaps = ends[:-1][doc[1:] == doc[:-1]]
    data[gaps], inside[gaps] = 0x20, True
    bounds = np.concatenate([[0], np.cumsum(inside)])[offsets]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[inside]))


def remove_repeats(
    docs: DataFrame, window: int = 50, gram: int = 10, key: str = "doc_id", text: str = "text", carry: Sequence[str] = (), as_is: bool = False, partitions: int | None = None
) -> DataFrame:
    """(key, n_words, n_removed, text, carried columns) of every row; text is the kept words joined by one space;
    with ``as_is``, texts that lose no word come back unchanged (null ones too).

    A word goes if it is in a window whose word sequence also starts in a
    document with a smaller key; windows are judged on the input. Words are
    runs between ASCII white space. Null texts have no words and become empty;
    documents shorter than a window are kept. Rows with equal keys remove nothing
    from one another; a null key is smaller than none and has none below it. An
    empty table gives an empty result. Windows are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(key).alias("id"),
        F.col(text).alias("text"),
        F.struct(F.lit(0).alias("_"), *carry).alias("carry"),
        # Two hashes stand for a row; they are never null, unlike its key.
        F.xxhash64(key, text).alias("k1"),
        F.hash(text, key).alias("k2"),
    )
    id_type = rows.schema["id"].dataType
    spread = rows.repartition(n, "k1", "k2")
    schema = T.StructType().add("h", T.LongType()).add("id", id_type).add("k1", T.LongType()).add("k2", T.IntegerType()).add("start", T.IntegerType())
    with ExitStack() as used:  # stored tables that the result does not refer to
        with staged(rows.select("k1", "k2", "text").mapInArrow(lambda b: _anchors(b, window, gram), "k1 long, k2 int, at int, anchor long"), "anchors") as anchors:
            cells = 1 << max(10, (CELLS * anchors.count()).bit_length())
            repeated = anchors
            for cell in (F.col("anchor"), F.xxhash64("anchor")):
                counted = repeated.withColumn("cell", cell.bitwiseAND(F.lit(cells - 1)))
                # Rows already below two in one sketch row need not be counted in the next.
                sketch = counted.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell")
                repeated = counted.join(sketch, "cell", "left_semi").drop("cell")
            # Rows with equal keys and texts share k1 and k2: sets hold a text's positions once, however many such rows there are.
            marked = used.enter_context(staged(repeated.groupBy("k1", "k2").agg(F.collect_set("at").alias("ats")), "marked"))
        free_exchanges(spark)

        # Texts, groups and covered windows are never in exchanges of one job.
        found = spread.join(marked, ["k1", "k2"]).select("id", "text", "k1", "k2", "ats").mapInArrow(lambda b: _windows(b, window, gram), schema)
        windows = used.enter_context(staged(found, "windows"))
        free_exchanges(spark)
        groups = windows.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("h", "low")
        groups = used.enter_context(staged(groups, "groups"))
        free_exchanges(spark)
        covered = stage(windows.join(groups, "h").where("id > low").groupBy("k1", "k2").agg(F.collect_set("start").alias("starts")), "covered")
    free_exchanges(spark)

    carried = rows.schema["carry"].dataType
    result = T.StructType().add("id", id_type).add("n_words", T.LongType()).add("n_removed", T.LongType()).add("text", T.StringType()).add("carry", carried)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = split_words(part.column("text"), SPACED)
                starts = _flat(part.column("starts"), words)
                depth = np.zeros(len(words.hashes) + 1, np.int64)
                np.add.at(depth, starts, 1)
                np.subtract.at(depth, starts + window, 1)
                keep = np.cumsum(depth[:-1]) == 0
                removed = np.concatenate([[0], np.cumsum(~keep)])[words.first]
                texts = kept_text(words, buffers(part.column("text"))[1], keep).cast(pa.string())
                if as_is:
                    texts = pc.if_else(pa.array(np.diff(removed) == 0), part.column("text"), texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(words.first)), pa.array(np.diff(removed)), texts, part.column("carry")],
                    names=["id", "n_words", "n_removed", "text", "carry"],
                )

    out = spread.join(covered, ["k1", "k2"], "left").select("id", "text", "starts", "carry").mapInArrow(cut, result)
    return out.select(F.col("id").alias(key), "n_words", "n_removed", F.col("text").alias(text), *[F.col("carry")[c].alias(c) for c in carry])
