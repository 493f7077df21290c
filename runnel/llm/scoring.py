"""Stupid-backoff scores of documents against all other documents.

A word's score is the relative frequency of the longest n-gram that ends with it
and occurs elsewhere, times ``alpha`` for every order given up. Counts are those
of the whole corpus less the document's own, so a text is no evidence for
itself.

Documents are dealt into slices of bounded size. A slice sends its distinct
n-grams, with their counts in it, to the count table's partition by hash; that
adds up the counts of all slices (a frequent n-gram comes once per slice, not
once per occurrence) and sends the totals back. The slice joins
them to the n-grams of its documents and sums each document's scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.llm.words import SLICE as RUN
from runnel.llm.words import SPACED, Words, release, rolling, slices, split_words

#: Bytes of text in a slice, and n-grams in a partition of the count table, on average.
SLICE = 1 << 23
COUNTS = 1 << 20
#: Bits of a hash that are not kept; buckets and keys are its upper bits.
DROPPED = np.uint64(8)
ZSTD = pa.Codec("zstd")


def _grams(words: Words, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, ends) per order: the n-grams' kept bits, and the word at which each ends."""
    place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], np.diff(words.first))
    for k in range(1, order + 1):
        at = np.flatnonzero(place >= k - 1)
        yield (rolling(words, k)[at - (k - 1)] if len(at) else np.zeros(0, np.uint64)) >> DROPPED, at


def _runs(texts: pa.Array) -> Iterator[Words]:
    """The words of a run of texts at a time, so that what is held besides the n-grams stays small."""
    for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", RUN):
        yield split_words(part.column("text"), SPACED, lower=True)


def once(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct texts, null as empty, and which of them each row has."""
    coded = pc.fill_null(texts.cast(pa.large_string()).combine_chunks(), "").dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def distinct_grams(texts: pa.Array, times: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): the distinct n-grams of texts that occur so many ``times``, and how often each occurs."""
    held, weights, begin = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    repeated = bool((times > 1).any())
    for words in _runs(texts):
        size = np.diff(words.first)
        of_word = np.repeat(times[begin : begin + len(size)], size)
        begin += len(size)
        for hashes, at in _grams(words, order):
            held.append(hashes)
            if repeated:
                weights.append(of_word[at])
    hashes = np.concatenate(held)
    del held
    if repeated:
        sequence = np.argsort(hashes)
        hashes, weight = hashes[sequence], np.concatenate(weights)[sequence]
    else:
        hashes.sort()
    # Hashes that agree in the kept bits count as one n-gram.
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    first = np.flatnonzero(new)
    counts = np.add.reduceat(weight, first) if repeated and len(first) else np.diff(first, append=len(hashes))
    return hashes[first], counts


def narrow(values: np.ndarray, compress: bool = False) -> bytes:
    """Non-negative integers in the smallest type that holds them; compressed ones stand behind a byte with its width."""
    most = int(values.max()) if len(values) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max)
    out = values.astype(kind).tobytes()
    return bytes([np.dtype(kind).itemsize]) + ZSTD.compress(out, asbytes=True) if compress else out


def widen(blob: bytes, count: int, compress: bool = False) -> np.ndarray:
    width = (blob[0] if compress else len(blob) // count) if count else 1
    if compress:
        blob = ZSTD.decompress(blob[1:], width * count, asbytes=True) if count else b""
    return np.frombuffer(blob, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[width]).astype(np.int64)


def scores(words: Words, order: int, alpha: float, ids: Sequence[np.ndarray], totals: np.ndarray, corpus: int) -> tuple[np.ndarray, np.ndarray]:
    """(sum of log scores, words scored by a lower order than their place allows) of every document."""
    count = np.diff(words.first)
    doc = np.repeat(np.arange(len(count)), count)
    others = []
    for own in ids:
        left = np.zeros(len(own), np.int64)
        at = np.flatnonzero(own >= 0)
        _, inverse, times = np.unique(doc[at] * np.int64(len(totals) + 1) + own[at], return_inverse=True, return_counts=True)
        left[at] = totals[own[at]] - times[inverse]
        others.append(left)
    rest = (corpus - count)[doc]
    place = np.arange(len(doc)) - words.first[:-1][doc]
    value = np.zeros(len(doc))
    level = np.zeros(len(doc), np.int64)
    for k in range(order, 0, -1):
        seen = (level == 0) & (others[k - 1] > 0)
        if k == 1:
            context = rest
        else:
            context = np.zeros(len(doc), np.int64)
            context[1:] = others[k - 2][:-1]
        value[seen] = np.log(others[k - 1][seen]) - np.log(context[seen])
        level[seen] = k
    unseen = level == 0
    value[unseen] = -np.log(rest[unseen] + 1.0)
    best = np.minimum(place + 1, order)
    value += (best - level) * math.log(alpha)
    sums = np.zeros(len(count))
    np.add.at(sums, doc, value)
    return sums, np.bincount(doc[level < best], minlength=len(count))


def backoff_scores(
    docs: DataFrame, order: int = 2, alpha: float = 0.4, key: str = "doc_id", text: str = "text", partitions: int | None = None, compress: bool = False
) -> DataFrame:
    """(key, n_words, n_backed_off, log_score) of every row.

    Words are runs between ASCII white space, A-Z lower-cased; n-grams do not
    cross documents. A word of the document that occurs nowhere else scores alpha
    to the power of its possible orders, over one more than the words elsewhere.
    Null and empty texts have no words and a score of 0. Rows with equal or null
    keys are documents of their own, each evidence for the other. An empty table
    gives an empty result. N-grams are compared by 56 bits of hash inside their
    partition of the count table. ``compress`` takes CPU time for less shuffled data;
    the result is the same.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    slices = max(n, -(-total // SLICE))
    buckets = min(1 << 16, max(n, total * order // 6 // COUNTS))
    corpus = docs.select(F.col(text).alias("text")).mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"n": [len(split_words(b.column(0), SPACED).starts)]}) for b in batches), "n long"
    )
    corpus_words = corpus.agg(F.sum("n")).first()[0] or 0
    id_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    # Equal rows go to one slice, where their text is worked on once.
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("id", "text"), F.lit(slices)).cast("int")).repartition(n, "slice")

    def ask(table: pa.Table) -> pa.Table:
        release()
        texts, which = once(table.column("text"))
        distinct, counts = distinct_grams(texts, np.bincount(which, minlength=len(texts)), order)
        # The n-grams are sorted and buckets are ranges of their upper bits: each bucket gets one run, as steps.
        keys = distinct.astype(np.int64)
        bounds = np.searchsorted(((keys >> 40) * buckets) >> 16, np.arange(buckets + 1))
        steps = np.diff(keys, prepend=0)
        at = np.flatnonzero(np.diff(bounds))
        first = keys[bounds[at]]
        steps[bounds[at]] = 0
        cut = [(bounds[b], bounds[b + 1]) for b in at]
        return pa.table(
            {
                "bucket": pa.array(at, pa.int32()),
                "slice": pa.array([table.column("slice")[0].as_py()] * len(at), pa.int32()),
                "first": pa.array(first, pa.int64()),
                "size": pa.array([b - a for a, b in cut], pa.int32()),
                **{name: pa.array([narrow(values[a:b], compress) for a, b in cut], pa.binary()) for name, values in (("low", steps & 0xFFFFFFFF), ("high", steps >> 32), ("n", counts))},
            }
        )

    def count(table: pa.Table) -> pa.Table:
        release()
        sizes = table.column("size").to_pylist()
        firsts = table.column("first").to_pylist()
        halves = zip(table.column("low").to_pylist(), table.column("high").to_pylist(), sizes, firsts)
        parts = [np.cumsum(widen(low, k, compress) + (widen(high, k, compress) << 32)) + first for low, high, k, first in halves]
        numbers = np.concatenate([widen(x, k, compress) for x, k in zip(table.column("n").to_pylist(), sizes)])
        distinct, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, inverse, numbers)
        answers = np.split(totals[inverse], np.cumsum(sizes)[:-1])
        return pa.table(
            {"bucket": table.column("bucket"), "slice": table.column("slice"), "size": table.column("size"), "totals": pa.array([narrow(a, compress) for a in answers], pa.binary())}
        )

    def answer(documents: pa.Table, totals: pa.Table) -> pa.Table:
        release()
        texts, which = once(documents.column("text"))
        distinct, _ = distinct_grams(texts, np.ones(len(texts), np.int64), order)
        blobs, sizes = totals.column("totals").to_pylist(), totals.column("size").to_pylist()
        known = np.concatenate([widen(blobs[i], sizes[i], compress) for i in np.argsort(totals.column("bucket").to_numpy())] + [np.zeros(0, np.int64)])
        found = []
        for words in _runs(texts):
            ids = []
            for hashes, at in _grams(words, order):
                some, inverse = np.unique(hashes, return_inverse=True)
                own = np.full(len(words.hashes), -1, np.int64)
                own[at] = np.searchsorted(distinct, some)[inverse]
                ids.append(own)
            found.append((np.diff(words.first), *scores(words, order, alpha, ids, known, corpus_words)))
        size, sums, backed_off = (np.concatenate(parts)[which] for parts in zip(*found))
        return pa.table({"id": documents.column("id"), "n_words": pa.array(size), "n_backed_off": pa.array(backed_off.astype(np.int64)), "log_score": pa.array(sums)})

    asked = rows.groupBy("slice").applyInArrow(ask, "bucket int, slice int, first long, size int, low binary, high binary, n binary")
    counted = asked.groupBy("bucket").applyInArrow(count, "bucket int, slice int, size int, totals binary")
    scored = rows.groupBy("slice").cogroup(counted.groupBy("slice")).applyInArrow(answer, f"id {id_type}, n_words long, n_backed_off long, log_score double")
    return scored.withColumnRenamed("id", key)
