"""The registered queries without SQL, every column of their contracts by plain Python over the smallest tables."""

import re
import zlib
from html import unescape

import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from runnel.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def run(spark, name):
    return queries.registered()[name](spark, SMALL).collect()


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_packing(spark, texts):
    tokenizer = Tokenizer.from_file(str(path("word_bpe_49k.json")))
    ids = {k: tokenizer.encode(t, add_special_tokens=False).ids + [1] for k, t in texts.items()}
    rows = run(spark, "op1_packing")
    pieces, sequences = {}, {}
    for r in rows:
        assert r.length > 0 and r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(ids[r.doc_id])
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for parts, whole in ((sorted(pieces[k]), len(ids[k])) for k in ids):
        assert [s for s, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) == whole
    padded = 0
    for parts in map(sorted, sequences.values()):
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        total = sum(n for _, n in parts)
        assert total <= 2048
        padded += 0 if total & (total - 1) == 0 else 2048 - total
    assert padded <= 0.02 * sum(map(len, ids.values()))


def test_shards(spark, texts):
    rows = run(spark, "op2_hilbert_shards")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, [])) for i in range(24)]
    assert max(counts) - min(counts) <= 1


def test_languages(spark, texts):
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = run(spark, "op7_language")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id]))
    held = [r for r in rows if r.held_out and known[r.doc_id]]
    assert sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.95 * len(held)


def test_main_texts(spark):
    source = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = run(spark, "op8_main_text")
    assert sorted(r.page_id for r in rows) == sorted(source)
    for r in rows:
        assert r.url == source[r.page_id].url and r.n_chars == len(r.text)
        plain = re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", " ", source[r.page_id].html or "")))
        for block in filter(None, r.text.split("\n\n")):
            # A block is trimmed and holds the page's words in the page's order.
            assert block == " ".join(block.split()) and "".join(block.split()) in "".join(plain.split())


def test_token_counts(spark, texts):
    tokenizer = Tokenizer.from_file(str(path("byte_bpe_50k.json")))
    want = [(k, len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for k, t in texts.items()]
    assert sorted(map(tuple, run(spark, "op10_token_counts"))) == sorted((*w, w[2] > 512) for w in want)
