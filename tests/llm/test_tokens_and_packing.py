import random
import zlib
from collections import Counter as Tally
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from odd import documents, empty

from runnel.llm import packing, tokens
from runnel.llm.packing import SumOfSquares, pack, powers_of_two, segments
from runnel.llm.tokens import Counter, Encoder, load, token_counts

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
ALPHABET = "ab cdé\n\t .,'s're  ß   ́ÀΣİ中文1²½🙂<|endoftext|>#&  "


def odd_texts(n=3000):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(n)]
    return texts + ["x<|endoftext|>y. <|endoftext|> z <|startoftext|>", "it's we're. 'tis...", "foo.'s bar,'re", "a\x00b", "", None]


@pytest.mark.parametrize("name, kind", [(BYTE, Counter), (WORD, Encoder)])
def test_pieces_give_what_the_library_gives(name, kind, monkeypatch):
    texts, library, made = odd_texts(), load(name), kind(name)
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    monkeypatch.setattr(tokens, "REMEMBERED", 400)
    for _ in range(2):
        got = made.counts(pa.array(texts)).tolist() if kind is Counter else [x.tolist() for x in made.ids(pa.array(texts))]
        assert got == ([len(w) for w in want] if kind is Counter else want)


def test_counts_of_huge_documents_are_spliced(spark):
    rng = random.Random(6)
    words = ["the", "onhe", "reed,", "it's", "éaux", "中文", "<|endoftext|>", "  ", "\n\n", "12345"]
    long = [" ".join(rng.choice(words) for _ in range(900)) for _ in range(6)]
    long += ["a" * 3000, "ab" * 700 + " " + "c" * 900, " " * 2500, "<|endoftext|>" * 200, "".join(rng.choice(ALPHABET) for _ in range(4000))]
    docs = documents(spark, long)
    library = load(BYTE)
    got = Tally((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts(docs, BYTE, chunk=300, overlap=64).collect())
    want = Tally((k, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for k, t in docs.select("doc_id", "text").collect())
    assert got == want
    assert token_counts(empty(spark), BYTE).collect() == []


def test_level_minimises_the_sum_of_squares():
    rng = np.random.default_rng(2)
    for _ in range(300):
        packer = SumOfSquares(12)
        packer.counts[1:12] = rng.integers(0, 4, 11)
        size = int(rng.integers(1, 13))

        def cost(level):
            after = packer.counts.copy()
            if level:
                after[level] -= 1
            after[level + size] += 1
            return int((after[1:12] ** 2).sum())

        usable = [0, *(h for h in range(1, 12 - size + 1) if packer.counts[h])]
        assert cost(packer.level_for(size)) == min(map(cost, usable))


def test_powers_of_two():
    out = powers_of_two([(0, 0, np.arange(5)), (1, 0, np.arange(6))])
    assert [sum(len(p[2]) for p in s) for s in out] == [8, 2, 1]
    assert [(p[0], p[1]) for s in out for p in s] == [(0, 0), (1, 0), (1, 3), (1, 5)]


def test_segments_join_to_the_text():
    text = "ab cd\nefghijkl mn o"
    for most in (3, 5, 8, 100):
        assert "".join(segments(text, most)) == text


def test_open_windows_are_bounded_and_lose_nothing():
    packer, given, got = SumOfSquares(2048, most=64), 0, []
    for i in range(1000):
        ids = np.full((1100, 1500, 5000)[i % 3], i, np.uint32)
        given += len(ids)
        packer.add_document((i, len(ids)), 0, ids)
        assert packer.counts.sum() == sum(map(len, packer.open)) <= 64
        # An open window keeps no more than its own ids.
        assert all(p[2].base is None or p[2].base.nbytes <= 2048 * 4 for level in packer.open for w in level for p in w)
        if packer.closed:
            full, rest = packer.topped_up()
            assert all(sum(len(p[2]) for p in w) == 2048 for w in full)
            got += [p for w in full for p in w]
            for piece in rest:
                packer.add(piece)
    packer.close()
    full, rest = packer.topped_up()
    got += [p for w in [*full, *packer.full] for p in w] + rest
    seen = Tally()
    for (i, _), start, ids in got:
        assert (ids == i).all()
        seen.update((i, start + k) for k in range(len(ids)))
    assert sum(seen.values()) == given and set(seen.values()) == {1}


def test_left_pieces_are_packed_by_the_rule_again(spark):
    """32 tasks of few documents fill hardly a window; together they do."""
    rng = random.Random(3)
    docs = documents(spark, [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(1, 40))) for _ in range(900)]).repartition(32)
    rows = pack(docs, WORD, window=128).collect()
    windows = {r["sequence_id"]: r["by_rule"] for r in rows}
    assert sum(windows.values()) > 0.8 * len(windows)


def test_windows_of_documents_over_half(spark):
    docs = documents(spark, ["the " * (60 + i % 20) for i in range(200)])
    rows = pack(docs.repartition(4), WORD, window=100, most=8, per_task=3000).collect()
    sums = Tally()
    for r in rows:
        sums[r["sequence_id"]] += r["length"]
    # Each task of the second round leaves one window at most, cut at powers of two.
    tasks = -(-sum(sums.values()) // 3000)
    short = [n for n in sums.values() if n < 100]
    assert all(n & (n - 1) == 0 for n in short) and len(short) <= 7 * tasks < 0.3 * len(sums)
    texts = [r for r in rows if (r["doc_id"] or 0) >= 100]
    assert len({(r["doc_id"], r["start"]) for r in texts}) == len(texts)
    for key in {r["doc_id"] for r in texts}:
        assert len({r["doc_tokens"] for r in texts if r["doc_id"] == key} | {sum(r["length"] for r in texts if r["doc_id"] == key)}) == 1


@pytest.mark.parametrize("window", [16, 2048])
def test_packed_pieces_are_the_documents(spark, monkeypatch, window):
    monkeypatch.setattr(packing, "SEGMENT", 500)
    texts = [" ".join(f"word{i % 7}" for i in range(n)) for n in (1, 3, 5, 8, 13, 400, 700, 3000)]
    docs = documents(spark, texts)
    rows = pack(docs.repartition(3), WORD, window=window).collect()
    library = load(WORD)
    want = Tally()
    for key, text in docs.select("doc_id", "text").collect():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.update((key, at, int(ids[at]), len(ids)) for at in range(len(ids)))
    got = Tally((r["doc_id"], r["start"] + i, t, r["doc_tokens"]) for r in rows for i, t in enumerate(r["ids"]))
    assert got == want
    sequences = defaultdict(list)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window and (at == window or at & (at - 1) == 0)
    assert pack(empty(spark), WORD).collect() == []
