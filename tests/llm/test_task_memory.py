"""Memory that the functions of the pipeline's tasks take beside a batch of 4 MB, as numpy and Python allocate it."""

import tracemalloc
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from runnel.llm import decontamination, language, partenum, scoring, substrings

MB = 1 << 20


@pytest.fixture(scope="module")
def batch():
    some = np.random.default_rng(3)
    words = np.array(["".join(some.choice(list("abcdefghij"), 5)) for _ in range(5_000)])
    texts = [" ".join(some.choice(words, 500)) for _ in range(1_300)]
    rows = np.arange(len(texts))
    columns = {"doc_id": rows, "id": rows, "row": rows, "text": texts, "k1": rows, "k2": rows.astype(np.int32), "ats": [[0, 100]] * len(texts), "starts": [[0, 100]] * len(texts), "lang": ["xx"] * len(texts), "carry": [{"_": 0}] * len(texts)}
    return pa.RecordBatch.from_pydict(columns)


def peak(function, batch):
    """MB held at most, results apart."""
    tracemalloc.start()
    try:
        for _ in function(iter([batch])):
            pass
        return tracemalloc.get_traced_memory()[1] / MB
    finally:
        tracemalloc.stop()


@pytest.fixture
def sent(spark, monkeypatch):
    """Functions given to tasks, in order."""
    functions, frame = [], type(spark.range(0))
    plain = frame.mapInArrow

    def noted(self, function, *args, **kwargs):
        functions.append(function)
        return plain(self, function, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", noted)
    return functions


def test_near_duplicates(batch):
    assert peak(lambda b: partenum._send(b, 5, Fraction(4, 5), 16, 3_000), batch) < 52


def test_sets_of_a_part_equal_those_at_once(batch):
    texts = pa.array([None, "", "a b", *batch.column("text").to_pylist(), "a  B c d e f", None])
    part = pa.RecordBatch.from_arrays([texts], names=["text"])
    for got, want in zip(partenum.sets_of(part, 5), partenum.shingle_sets(texts, 5)):
        assert got.dtype == want.dtype and (got == want).all()
    assert [len(x) for x in partenum.sets_of(part.slice(0, 0), 5)] == [0, 1]


def test_repeated_windows(batch):
    assert peak(lambda b: substrings._anchors(b, 50, 10), batch) < 40
    assert peak(lambda b: substrings._windows(b, 50, 10), batch) < 32


def test_language_stage(spark, sent, batch):
    model = language.Model(["xx", "yy"], np.zeros((2, language.FEATURES), np.float32), np.ones((len(language._NAMES), 2), bool), np.ones(2) / 2)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    language.identify(docs, model)
    assert peak(sent[-1], batch) < 80


def test_other_stages(spark, sent, batch):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b c")], "doc_id long, text string")
    partenum.similar_groups(docs)
    substrings.remove_repeats(docs)
    decontamination.contamination(docs, spark.createDataFrame([("i", "q r")], "item_id string, text string"))
    functions = [f for f in sent if f.__name__ in ("digest", "cut", "run")]
    assert len(functions) == 3
    for f in functions:
        assert peak(f, batch) < 48, f.__qualname__


def test_backoff_scores(spark, monkeypatch, batch):
    """A slice takes as much memory however often its texts repeat, and little more than its n-grams."""
    functions = []
    grouped = spark.range(1).groupBy("id")
    for kind in (type(grouped), type(grouped.cogroup(grouped))):
        plain = kind.applyInArrow
        monkeypatch.setattr(kind, "applyInArrow", lambda self, f, schema, plain=plain: (functions.append(f), plain(self, f, schema))[1])
    scoring.backoff_scores(spark.createDataFrame([(1, "a b"), (2, "a b c")], "doc_id long, text string"), order=3, partitions=1)
    ask, count, answer = functions
    half = pa.table({"id": batch.column("id"), "text": batch.column("text"), "slice": pa.array([0] * len(batch), pa.int32())})
    for table, most in ((half, 72), (pa.concat_tables([half] * 5), 110)):
        asked = ask(table)
        totals = count(asked)
        assert peak(lambda b: [ask(table)], batch) < most
        assert peak(lambda b: [answer(table, totals)], batch) < most
