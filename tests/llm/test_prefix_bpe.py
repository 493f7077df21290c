"""Prefix BPE against the library, and its digests against the contract."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from odd import documents, empty
from test_tokens_and_packing import odd_texts

from runnel.llm import bpe
from runnel.llm.queries import registered
from runnel.llm.tokens import load

NAME = "byte_bpe_50k.json"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return bpe._tables(NAME)


def library(texts):
    return [e.ids for e in load(NAME).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def word(tables, i):
    return tables.spelled[tables.bounds[i] : tables.bounds[i + 1]].tobytes()


def test_automaton_names_every_token_that_ends_at_a_byte(tables):
    rng = random.Random(2)
    held = {word(tables, i): i for i in range(len(tables.bounds) - 1)}
    walk = bpe.Prefixes(tables)
    for _ in range(40):
        text = b"".join(word(tables, rng.randrange(50256)) for _ in range(3))
        state, length = np.zeros(1, np.int32), np.zeros(1, np.int32)
        for k in range(1, len(text) + 1):
            state, length = walk.step(state, length, np.array([text[k - 1]]))
            token, found = int(tables.token[state[0]]), []
            while token >= 0:
                if walk.size[token] <= length[0]:
                    found.append(token)
                token = int(tables.shorter[token])
            assert found == [held[text[a:k]] for a in range(k) if text[a:k] in held]


def test_pairs_stay_apart_where_the_library_keeps_them(tables):
    rng, pairs = random.Random(3), bpe.Pairs(tables)
    merge = load(NAME).model.tokenize
    letters = {b: c for c, b in bpe.byte_letters().items()}
    a, b = (np.array([rng.randrange(50256) for _ in range(20_000)], np.int32) for _ in range(2))
    got = pairs.compatible(a, b)
    want = [[t.id for t in merge("".join(letters[c] for c in word(tables, x) + word(tables, y)))] == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert got.tolist() == want and 0.1 < got.mean() < 1
    assert pairs.compatible(a, b).tolist() == want  # from memory


def test_last_tokens_of_prefixes_are_those_of_their_encodings(tables):
    text = b" unbelievableness"
    (last,) = bpe.Prefixes(tables).last_tokens(np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]))
    assert last[1:].tolist() == [library([text[:k].decode()])[0][-1] for k in range(1, len(text) + 1)]


@pytest.mark.parametrize("few", [0, 10**9])
def test_ids_are_those_of_the_library(tables, few, monkeypatch):
    monkeypatch.setattr(bpe, "FEW", few)
    rng = random.Random(4)
    texts = odd_texts(1500) + ["".join(rng.choice("etaoins ") for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["a" * 900, "ab" * 500, " " * 700, "ß" * 300 + "中文" * 200, "<|endoftext|>" * 3, "x <|endoftext|>"]
    bounds, ids = bpe.PrefixEncoder(NAME, tables).ids(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == library(texts)


def test_tokens_that_their_merges_do_not_make_are_not_used(tables):
    assert (np.diff(tables.bounds) > 0).all() and (tables.shorter >= 0).sum() == 50_000


def test_documents_are_encoded_and_decoded(spark, monkeypatch):
    monkeypatch.setattr(bpe, "AT_ONCE", 5)
    docs = documents(spark, odd_texts(300)).repartition(3)
    encoded = bpe.encode(docs, NAME)
    rows = encoded.select("doc_id", "n_tokens", "ids", bpe.decoder(spark, NAME)("ids").alias("back"), bpe.digest("ids").alias("d")).collect()
    given = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, r.text or "", ids) for r, ids in zip(given, library([r.text for r in given]))), key=str)
    assert sorted(((r.doc_id, r.back, r.ids) for r in rows), key=str) == want
    assert all(r.n_tokens == len(r.ids) and r.d == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() for r in rows)
    assert bpe.encode(empty(spark), NAME).collect() == []


def test_decoding_like_the_library(spark):
    rng = random.Random(5)
    lists = [[rng.randrange(50257) for _ in range(rng.randrange(6))] for _ in range(400)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(-1, None), (-2, [-5, 64, 10**6])], "i int, ids array<int>")
    got = dict(df.select("i", bpe.decoder(spark, NAME)("ids")).collect())
    tokenizer = load(NAME)
    assert [got[i] for i in range(400)] == [tokenizer.decode(x, skip_special_tokens=False) for x in lists]
    assert got[-1] is None and got[-2] == tokenizer.decode([64], skip_special_tokens=False)


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    tokenizer, want = load(NAME), []
    for r, ids in zip(docs, library([r.text for r in docs])):
        back = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = registered()["op11_prefix_bpe"](spark, SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and sorted(map(tuple, got.collect())) == sorted(want)
