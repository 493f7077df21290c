import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from runnel.llm.graph import components
from runnel.llm.words import ALNUM, SPACED, gram_hashes, run_hashes, slices, split_words

TEXTS = st.lists(st.none() | st.text(alphabet="ab Z9\t\n\r\x0b\x0c\x1c.,é中🙂", max_size=30), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_equal_the_pattern(texts):
    for members, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = split_words(pa.array(texts, pa.string()), members, lower=True)
        for i, text in enumerate(texts):
            lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
            got = [words.text(k, k + 1) for k in range(words.first[i], words.first[i + 1])]
            assert got == [w.encode() for w in re.findall(pattern, lowered)]


def test_grams_stay_in_their_document_and_long_words_hash_alike():
    long = "x" * 600_000
    words = split_words(pa.array(["a b c", "a b", "b c a b", long + " y", "q " + long]))
    hashes, at = gram_hashes(words, 2)
    assert len(hashes) == 2 + 1 + 3 + 1 + 1
    assert hashes[0] == hashes[2] == hashes[5] and hashes[1] == hashes[3]
    assert words.hashes[words.first[3]] == words.hashes[words.first[5] - 1]


def test_equal_runs_hash_alike():
    codes = np.array([5, 6, 7, 1, 5, 6, 7], np.uint64)
    a, b, c = run_hashes(codes, np.array([0, 4, 1]), np.array([3, 7, 4]))
    assert a == b != c


def test_slices_cut_between_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 5, None, "b" * 20, "", "c"]})
    parts = [p.column("text").to_pylist() for p in slices(batch, "text", 6)]
    assert parts == [["aaaaa", None], ["b" * 20], ["", "c"]] or sum(parts, []) == batch.column("text").to_pylist()


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(500 + i, 501 + i) for i in range(40)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component_id"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()
