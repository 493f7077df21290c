"""Language of texts and of their parts, by scripts, word scores and Viterbi.

Words are runs of letters. A word's script narrows the candidates to languages
that use it; the word's score for a language is the log likelihood of its byte
trigrams. The best path through a document's words, with a penalty for every
change of language, labels spans; the language with the most letters is the
document's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runnel.llm.words import LOWER, SLICE, buffers, release, slices

#: First and last code points of scripts' letters. Script 0 is "none".
SCRIPTS = [
    ("latin", 0x41, 0x5A), ("latin", 0x61, 0x7A), ("latin", 0xAA, 0xAA), ("latin", 0xB5, 0xB5), ("latin", 0xBA, 0xBA),
    ("latin", 0xC0, 0xD6), ("latin", 0xD8, 0xF6), ("latin", 0xF8, 0x2AF), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x531, 0x586), ("hebrew", 0x5D0, 0x5EA), ("arabic", 0x620, 0x64A), ("devanagari", 0x904, 0x97F), ("bengali", 0x985, 0x9FF),
    ("tamil", 0xB85, 0xBB9), ("thai", 0xE01, 0xE30), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF), ("kana", 0x3041, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7A3),
    ("han", 0x20000, 0x2FA1F),
]
_NAMES = ["none", *dict.fromkeys(name for name, _, _ in SCRIPTS)]
_EDGES = np.array([x for _, low, high in SCRIPTS for x in (low, high + 1)])
_OF_GAP = np.array([0, *(x for name, _, _ in SCRIPTS for x in (_NAMES.index(name), 0))], np.int8)

#: Buckets of hashed trigrams.
FEATURES = 1 << 15
#: Words of a path that are looked at together; a longer path goes on from part to part.
PATH = 4096
UNDETERMINED = "und"


def _words(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(trigram feature of every byte, starts, ends, letters, script, first) of the words of a batch."""
    data, offsets = buffers(texts)
    data = LOWER[data]
    n = len(data)
    wide = data >= 0x80
    script = np.zeros(n, np.int8)
    script[(data >= 0x61) & (data <= 0x7A)] = _NAMES.index("latin")
    for lead, length in ((0xC0, 2), (0xE0, 3), (0xF0, 4)):
        at = np.flatnonzero((data >= lead) & (data < (0xE0, 0xF0, 0xF8)[length - 2]))
        at = at[at + length <= n]
        code = data[at].astype(np.int64) & (0x7F >> length)
        for k in range(1, length):
            code = (code << 6) | (data[at + k] & 0x3F)
        script[at] = _OF_GAP[np.searchsorted(_EDGES, code, "right")]
    # A word has letters only; a byte that continues a character goes with its first.
    inside = script > 0
    for k in range(1, 4):
        inside[k:] |= ((data[k:] & 0xC0) == 0x80) & (script[:-k] > 0) & wide[:-k] & (data[:-k] >= (0xC0, 0xE0, 0xF0)[k - 1])
    marked = np.zeros(n + 2, np.int8)
    marked[1:-1] = inside
    change = np.diff(marked)
    edges = np.unique(offsets[1:-1])
    edges = edges[(edges > 0) & (edges < n)]
    joined = edges[(marked[edges] == 1) & (marked[edges + 1] == 1)]
    starts = np.sort(np.concatenate([np.flatnonzero(change == 1), joined]))
    ends = np.sort(np.concatenate([np.flatnonzero(change == -1), joined]))
    plain = np.where(inside, data, 0x20).astype(np.uint32)
    before = np.full(n + 3, 0x20, np.uint32)
    before[2:-1] = plain
    # The feature of byte i covers bytes i - 2 to i; one more closes the last word.
    grams = before[:-2] | (before[1:-1] << np.uint32(8)) | (before[2:] << np.uint32(16))
    features = ((grams * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int32)
    letters = np.concatenate([[0], np.cumsum(script > 0)])
    first_script = script[starts] if len(starts) else np.zeros(0, np.int8)
    return features, starts, ends, letters[ends] - letters[starts], first_script, np.searchsorted(starts, offsets)


@dataclass
class Model:
    languages: list[str]
    #: Log likelihoods, one row a language, one column a feature.
    scores: np.ndarray
    #: For each script, which languages use it.
    uses: np.ndarray
    #: Share of the training texts.
    prior: np.ndarray
    penalty: float = 12.0


def sampled(rows: DataFrame, per_language: int) -> DataFrame:
    """The rows of (lang, text, h) with the ``per_language`` smallest h of each language, equal ones once.

    Only hashes are ranked, in 64 groups a language first, so no task holds a
    language; the rows are then read again with one bound a language.
    """
    rows = rows.where("text is not null and lang is not null")
    hashes = rows.select("lang", "h").withColumn("part", F.pmod(F.xxhash64("h"), F.lit(64)))
    for groups in (("lang", "part"), ("lang",)):
        hashes = hashes.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy("h"))).where(F.col("rank") <= per_language)
    bounds = hashes.groupBy("lang").agg(F.max("h").alias("bound"))
    # One row per language, as many as the model has.
    return rows.join(F.broadcast(bounds), "lang").where("h <= bound").dropDuplicates(["lang", "h"]).select("lang", "text")


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 400, rare: float = 0.01, penalty: float = 12.0) -> Model:
    """Trigram and script counts of a bounded sample: ``per_language`` documents of each language.

    The sample holds the rows with the smallest hashes of key and text, whole
    texts; equal rows are learned from once. Rows without text or language are left out. A language uses a script
    if at least ``rare`` of its letters are in it. Counts are summed on Spark; the driver gets
    FEATURES numbers per language.
    """
    sample = sampled(labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key, text).alias("h")), per_language)
    scripts = len(_NAMES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                features, starts, ends, letters, script, first = _words(part.column("text"))
                for i, name in enumerate(part.column("lang").to_pylist()):
                    a, b = first[i], first[i + 1]
                    own = totals.setdefault(name, np.zeros(FEATURES + scripts + 1, np.int64))
                    own[-1] += 1
                    if a < b:
                        low, high = starts[a], ends[b - 1]
                        own[:FEATURES] += np.bincount(features[low : high + 1], minlength=FEATURES)
                        own[FEATURES:-1] += np.bincount(script[a:b], letters[a:b], minlength=scripts).astype(np.int64)
        for name, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(own[at])], names=["lang", "feature", "n"])

    counts = sample.select("text", "lang").mapInArrow(count, "lang string, feature long, n long")
    found = counts.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    table = np.zeros((len(languages), FEATURES + scripts + 1))
    np.add.at(table, (found["lang"].map(languages.index).to_numpy(int), found["feature"].to_numpy(int)), found["n"].to_numpy(float))
    grams, letters, rows_of = table[:, :FEATURES] + 0.5, table[:, FEATURES:-1], table[:, -1]
    share = letters / np.maximum(letters.sum(1, keepdims=True), 1)
    return Model(
        languages,
        np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32),
        (share >= rare).T.copy(),
        rows_of / max(rows_of.sum(), 1),
        penalty,
    )


def word_scores(model: Model, features: np.ndarray, starts: np.ndarray, ends: np.ndarray, script: np.ndarray) -> np.ndarray:
    """Score of every word (columns) for every language (rows), at most 0 for the best candidate."""
    out = np.empty((len(model.languages), len(starts)), np.float32)
    for k in range(len(model.languages)):
        sums = np.concatenate([[0.0], np.cumsum(model.scores[k][features], dtype=np.float64)])
        out[k] = sums[ends + 1] - sums[starts]
    allowed = model.uses[script].T
    none = ~allowed.any(0)
    out[:, none] = 0
    out -= np.where(allowed | none, out, -np.inf).max(0)
    return np.where(allowed | none, np.maximum(out, -30), -30).astype(np.float32)


def best_path(scores: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """Language of every word on the best path of each run bounds[i]:bounds[i+1] of words.

    All runs advance together, the longest first, so each step is a few array
    operations; those of more than PATH words go one by one. Of equal ways to a word, staying in its language wins, then the
    first language.
    """
    k, total = scores.shape
    sizes = np.diff(bounds)
    if k > 1 and total and sizes.max() > PATH:
        out = np.empty(total, np.int16)
        short = np.repeat(sizes <= PATH, sizes)
        out[short] = best_path(scores[:, short], np.concatenate([[0], np.cumsum(np.where(sizes <= PATH, sizes, 0))]), penalty)
        for i in np.flatnonzero(sizes > PATH):
            out[bounds[i] : bounds[i + 1]] = long_path(scores[:, bounds[i] : bounds[i + 1]], penalty)
        return out
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = bounds[:-1][order], sizes[order]
    out = np.zeros(total, np.int16)
    if not total or k == 1:
        return out
    stays = np.zeros((k, total), bool)
    came = np.zeros(total, np.int16)
    longest = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), "right")
    value = scores[:, begin[: active[0]]].astype(np.float64)
    finals = np.zeros(len(sizes), np.int16)
    for t in range(1, longest):
        n, ended = active[t], active[t - 1]
        if n < ended:
            finals[n:ended] = value[:, n:].argmax(0)
            value = value[:, :n]
        at = begin[:n] + t
        best = value.max(0)
        came[at] = value.argmax(0)
        best -= penalty
        stay = value >= best
        stays[:, at] = stay
        value = np.where(stay, value, best)
        value += scores[:, at]
    finals[: active[-1]] = value.argmax(0)
    state = finals[:0]
    for t in range(longest - 1, -1, -1):
        n = active[t]
        if n > len(state):
            state = np.concatenate([state, finals[len(state) : n]])
        at = begin[:n] + t
        out[at] = state
        if t:
            state = np.where(stays[state, at], state, came[at])
    return out


def long_path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The path of ``best_path`` for one long run: the values of its languages are handed on from part to part.

    Kept are the language before each word, for every language at it, so the way back is exact.
    """
    k, total = scores.shape
    came = np.empty((total, k), np.int16)
    value = [0.0] * k
    for a in range(0, total, PATH):
        steps = []
        for own in scores[:, a : a + PATH].T.tolist():
            top = max(value)
            leader, least = value.index(top), top - penalty
            steps.append([j if v >= least else leader for j, v in enumerate(value)])
            value = [(v if v >= least else least) + s for v, s in zip(value, own)]
        came[a : a + len(steps)] = steps
    out = np.empty(total, np.int16)
    state = value.index(max(value))
    for a in reversed(range(0, total, PATH)):
        states = []
        for step in reversed(came[a : a + PATH].tolist()):
            states.append(state)
            state = step[state]
        out[a : a + len(states)] = states[::-1]
    return out


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(key, lang_pred, score, spans, carried columns) of every row.

    spans are the labelled parts of a text in characters, in order. lang_pred
    has the most letters in its spans (ties: the first by name), score is its
    share of all letters. Null texts and texts without a letter are ``und`` with score 0
    and no spans; texts whose letters are in no listed script get the model's most frequent
    language with its share as score. Rows with equal or null keys are judged one by one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.struct(F.lit(0).alias("_"), *[c for c in carry if c != text]).alias("carry"))
    span = T.StructType().add("start", T.LongType()).add("end", T.LongType()).add("lang", T.StringType())
    result = T.StructType().add("id", rows.schema["id"].dataType).add("lang_pred", T.StringType()).add("score", T.DoubleType())
    result = result.add("spans", T.ArrayType(span)).add("carry", rows.schema["carry"].dataType)
    with_text = text in carry  # sent once
    if with_text:
        result = result.add("text", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        model = sent.value
        k = len(model.languages)
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = part.column("text")
                features, starts, ends, letters, script, first = _words(texts)
                documents = np.repeat(np.arange(len(part)), np.diff(first))
                if k and len(starts):
                    label = best_path(word_scores(model, features, starts, ends, script), first, model.penalty)
                else:
                    label = np.zeros(len(starts), np.int16)
                share = np.zeros((len(part), max(k, 1)))
                np.add.at(share, (documents, label), letters)
                total = share.sum(1)
                choice = np.where((total > 0) & (k > 0), share.argmax(1), k)
                score = share.max(1) / np.maximum(total, 1)
                for i in np.flatnonzero(total == 0):
                    value = texts[int(i)].as_py()
                    if k and value and _has_letter(value):
                        choice[i], score[i] = int(model.prior.argmax()), model.prior.max()
                # Spans begin where the document or the label changes.
                opens = np.ones(len(starts), bool)
                opens[1:] = (documents[1:] != documents[:-1]) | (label[1:] != label[:-1])
                opens = np.flatnonzero(opens) if k else np.zeros(0, np.int64)
                closes = np.append(opens[1:], len(starts))[: len(opens)]
                data, offsets = buffers(texts)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                base = chars[offsets[documents[opens]]]
                spans = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(documents[opens], np.arange(len(part) + 1)), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(chars[starts[opens]] - base), pa.array(chars[ends[closes - 1]] - base), pa.array(names[label[opens]], pa.string())],
                        names=["start", "end", "lang"],
                    ),
                )
                out = [part.column("id"), pa.array(names[choice], pa.string()), pa.array(score, pa.float64()), spans, part.column("carry"), texts]
                yield pa.RecordBatch.from_arrays(out[: len(result)], names=result.names)

    out = rows.mapInArrow(run, result)
    return out.select(F.col("id").alias(key), "lang_pred", "score", "spans", *[F.col("text").alias(c) if c == text else F.col("carry")[c].alias(c) for c in carry])


def held_out(key: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row's key falls into the fold that nothing is learned from; a null key does not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == fold, F.lit(False))
