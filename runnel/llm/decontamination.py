"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Documents and test items are normalised alike: A-Z lower-cased, everything but
digits, letters and characters beyond ASCII taken as a gap, gaps made one
space. The automaton holds every window of item words; a document is scanned
once, and hits are mapped back to words and to characters of the original.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runnel.llm.words import ALNUM, SLICE, Words, buffers, release, slices, split_words
from runnel.sources.staging import stage

#: Bytes of item text in one broadcast automaton; more items make more automata, one scan each.
AUTOMATON_BYTES = 1 << 22


def item_windows(texts: list[tuple[object, str | None]], size: int) -> dict[str, tuple[int, list]]:
    """Window (words between spaces, one character a byte) -> number of words, items that hold it."""
    out: dict[str, tuple[int, list]] = {}
    for item, text in texts:
        words = split_words(pa.array([text], pa.string()), ALNUM, lower=True)
        n = len(words.starts)
        for i in range(max(0, n - size) + 1 if n else 0):
            j = min(n, i + size)
            window = " " + " ".join(words.text(k, k + 1).decode("latin-1") for k in range(i, j)) + " "
            held = out.setdefault(window, (j - i, []))[1]
            if item not in held:
                held.append(item)
    return out


def automaton(windows: dict[str, tuple[int, list]]):
    import ahocorasick

    made = ahocorasick.Automaton()
    for window, value in windows.items():
        made.add_word(window, value)
    if windows:
        made.make_automaton()
    return made if windows else None


def union(spans: list[dict]) -> list[dict]:
    """Spans of words joined where they meet or overlap."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["first"], s["last"])):
        if out and s["first"] <= out[-1]["last"] + 1:
            if s["last"] > out[-1]["last"]:
                out[-1] = out[-1] | {"last": s["last"], "end": s["end"]}
        else:
            out.append(dict(s))
    return out


def hits(machine, words: Words, i: int) -> tuple[list[dict], set]:
    """Hit spans and items of the batch's document i."""
    low, high = int(words.first[i]), int(words.first[i + 1])
    if machine is None or low == high:
        return [], set()
    begin, end = int(words.starts[low]), int(words.ends[high - 1])
    # In-word bytes, and a space for the first byte of every gap.
    data = words.data[begin:end].copy()
    keep = ALNUM[data]
    gaps = words.ends[low : high - 1] - begin
    data[gaps], keep[gaps] = 0x20, True
    text = " " + data[keep].tobytes().decode("latin-1") + " "
    found, items = [], set()
    for at, (n, held) in machine.iter(text):
        found.append((at, n))
        items.update(held)
    if not found:
        return [], items
    # The space after word k stands at ends[k] of the scanned text.
    ends = np.cumsum(words.ends[low:high] - words.starts[low:high] + 1)
    last = np.searchsorted(ends, [at for at, _ in found])
    spans = [{"first": int(k) - n + 1, "last": int(k), "start": 0, "end": 0} for k, (_, n) in zip(last, found)]
    spans = union(spans)
    for s in spans:
        s["start"], s["end"] = int(words.starts[low + s["first"]]), int(words.ends[low + s["last"]])
    return spans, items


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """(key, n_words, n_hit, items, spans, carried columns) of every document.

    An item's windows are its runs of ``size`` words, or all its words if it
    has fewer; an item without words has none. items are the ids (as strings,
    sorted) of items with a window in the document; spans are its hit words,
    joined where they touch, with word numbers and character offsets. Null
    texts have no words. Documents with equal or null keys are judged one by
    one, items with equal keys count as one. Empty tables on either side work.
    Items are collected to the driver in groups of AUTOMATON_BYTES, each group
    one scan; a single item must fit into memory.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_key).cast("string").alias("item"), F.col(item_text).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // AUTOMATON_BYTES))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.struct(F.lit(0).alias("_"), *[c for c in carry if c != text]).alias("carry"))
    word_span = T.StructType([T.StructField(n, T.LongType()) for n in ("first", "last", "start", "end")])
    result = T.StructType().add("id", rows.schema["id"].dataType).add("row", T.LongType()).add("n_words", T.LongType())
    result = result.add("items", T.ArrayType(T.StringType())).add("spans", T.ArrayType(word_span)).add("carry", rows.schema["carry"].dataType)
    with_text = text in carry  # sent once
    if with_text:
        result = result.add("text", T.StringType())
    if groups > 1:
        rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "documents")
    else:
        rows = rows.withColumn("row", F.lit(0).cast("long"))

    def scan(group: int) -> DataFrame:
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(groups)) == group).collect() if groups > 1 else items.collect()
        windows = spark.sparkContext.broadcast(item_windows([(r.item, r.text) for r in part], size))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release()
            machine = automaton(windows.value)
            span = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")]))
            for batch in batches:
                for piece in slices(batch, "text", SLICE):
                    words = split_words(piece.column("text"), ALNUM, lower=True)
                    spans, held = [], []
                    starts = buffers(piece.column("text"))[1]
                    for i in range(len(piece)):
                        found, names = hits(machine, words, i)
                        for s in found:
                            for side in ("start", "end"):
                                # Bytes of UTF-8 that continue a character are not counted.
                                before = words.data[starts[i] : s[side]]
                                s[side] = int(np.count_nonzero((before & 0xC0) != 0x80))
                        spans.append(found)
                        held.append(sorted(names))
                    out = [piece.column("id"), piece.column("row"), pa.array(np.diff(words.first)), pa.array(held, pa.list_(pa.string())), pa.array(spans, span)]
                    out += [piece.column("carry"), piece.column("text")]
                    yield pa.RecordBatch.from_arrays(out[: len(result)], names=result.names)

        return rows.mapInArrow(run, result)

    found = scan(0)
    if groups > 1:
        for g in range(1, groups):
            found = found.union(scan(g))

        @F.arrow_udf(T.ArrayType(word_span))
        def joined(spans: pa.Array) -> pa.Array:
            return pa.array([union(x) for x in spans.to_pylist()], spans.type)

        found = (
            found.groupBy("row")
            .agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.first("carry").alias("carry"), *[F.first("text").alias("text")] * with_text, F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
            .withColumn("spans", joined("spans"))
        )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(F.col("id").alias(key), "n_words", n_hit.alias("n_hit"), "items", "spans", *[F.col("text").alias(c) if c == text else F.col("carry")[c].alias(c) for c in carry])
