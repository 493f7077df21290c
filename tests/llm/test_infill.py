"""Fill-in-the-middle against slices of Python strings."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from odd import documents, empty

from runnel.llm.infill import Cutter, Fenwick, fill_in_middle, restored
from runnel.llm.queries import registered

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"^[ \t\n]+(?:[^ \t\n]+[ \t\n]*)?|[^ \t\n]+[ \t\n]*")


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(key, text, units=list):
    text, parts = text or "", units(text or "")
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(parts)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return key, n, "plain", None, None, text, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(parts[:i]), "".join(parts[i:j]), "".join(parts[j:])
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return key, n, form, len(p), len(m), out, text


def odd_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é中🙂 \n\t<P>SM") for _ in range(rng.choice([1, 2, 9, 300, 3000]))) for _ in range(150)]
    return texts + ["<", "<P", "S>", "<S", "M><", "x<M>y", "\x00a\x00", "é", " lead", "trail ", " \n ", "word"]


def test_fenwick_finds_every_item():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 8, 9, 100):
        counts = rng.integers(0, 4, (n, 2))
        tree, sums = Fenwick(counts), np.concatenate([np.zeros((1, 2), int), counts.cumsum(0)])
        assert (tree.before(np.arange(n + 1)) == sums).all()
        for column in (0, 1):
            rank = np.arange(sums[-1, column] + 2)
            block, before = tree.find(column, rank)
            want = np.searchsorted(sums[:, column], rank, "right") - 1
            assert (block == want).all() and (before == sums[want]).all()


@pytest.mark.parametrize("unit, units", [("char", list), ("word", WORD.findall)])
@pytest.mark.parametrize("block", [4, 16, 256])
def test_every_cut_of_every_text(unit, units, block):
    texts = [t for t in odd_texts() if len(t) < 1000] + [""]
    cutter = Cutter(pa.array(texts), unit, block)
    assert cutter.units.tolist() == [len(units(t)) for t in texts] and cutter.chars.tolist() == [len(t) for t in texts]
    for i, parts in enumerate(map(units, texts)):
        cuts = np.arange(len(parts) + 1)
        byte, chars = cutter.place(np.full(len(cuts), i), cuts)
        before = ["".join(parts[:k]) for k in cuts]
        assert (byte - cutter.offsets[i]).tolist() == [len(b.encode()) for b in before] and chars.tolist() == [len(b) for b in before]


@pytest.mark.parametrize("unit, units", [("char", list), ("word", WORD.findall)])
def test_documents(spark, unit, units):
    docs = documents(spark, odd_texts()).repartition(3)
    out = fill_in_middle(docs, unit=unit).withColumn("back", restored())
    want = sorted((expected(r.doc_id, r.text, units) for r in docs.select("doc_id", "text").collect()), key=str)
    assert sorted(map(tuple, out.collect()), key=str) == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    assert fill_in_middle(empty(spark)).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((*e[:5], hashed(e[5]), hashed(e[6])) for e in (expected(r.doc_id, r.text) for r in docs))
    got = registered()["op13_fill_in_middle"](spark, SMALL)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(map(tuple, got.collect())) == want
