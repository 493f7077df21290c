"""Token ids and counts with public vocabularies, whole texts of any length.

``Counter`` and ``Encoder`` give exactly what the library gives for a text,
faster than encoding every text anew: a text is cut where the vocabulary's
pre-tokenizer always cuts, equal pieces are encoded once, and a bounded memory
keeps them from batch to batch. Texts that hold a special token's string go to
the library whole.

``token_counts`` spreads huge documents over tasks. A document longer than
``chunk`` characters becomes overlapping chunks. Neighbouring chunks are spliced at a common
boundary that is proven to be one of the whole text: in the left chunk, whose
start is known to be right, a pre-token ends there and stands more than
``MARGIN`` characters before the chunk's end, so no later character can change
it; in the right chunk a pre-token starts there, and the splitting of a text
depends on nothing to its left. Where two chunks share no such boundary, the
document is cut again with chunks and overlaps four times as wide, until every
seam holds or one chunk holds the document.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.llm.words import LOWER, buffers, hashed_runs, slices
from runnel.sources.staging import stage

#: Longer than any special token's string or contraction: what follows further away changes no pre-token.
MARGIN = 32
#: Pieces remembered from batch to batch by a task.
REMEMBERED = 400_000
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-&(-/:-@\[-`{-~"


def load(name: str):
    """The tokenizer of a vocabulary file: a path, or a name that the public package knows."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if not os.path.isabs(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Tokenizer.from_file(name)


def _is(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


_SPACE = _is((0x09, 0x0A), (0x0D, 0x0D), (0x20, 0x20))
_LINE = _is((0x09, 0x0A), (0x0D, 0x0D))
_VISIBLE = _is((0x21, 0x7E))
_LETTER = _is((0x41, 0x5A), (0x61, 0x7A))
#: ASCII punctuation but the apostrophe, which may begin a contraction.
_MARK = _VISIBLE & ~_LETTER & ~_is((0x30, 0x39), (0x27, 0x27))


def _cuts(data: np.ndarray, keeps_space: bool) -> np.ndarray:
    """Byte positions where the splitting pattern always has a boundary, whatever stands around.

    Before ASCII white space that follows a visible character; between a letter
    and a mark; after a single line break between visible characters; and, if
    white space is dropped, after any ASCII white space.
    """
    if len(data) < 2:
        return np.zeros(0, np.int64)
    space = _SPACE[data]
    # The second byte of U+00C0 to U+00FF; all but two of them are letters.
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    visible = _VISIBLE[data] | latin
    letter = _LETTER[data] | (latin & (data != 0x97) & (data != 0xB7))
    cut = np.zeros(len(data), bool)
    cut[1:] = (space[1:] & visible[:-1]) | (_MARK[data[1:]] & letter[:-1])
    if keeps_space:
        starts = _VISIBLE[data] | (data == 0xC3)
        cut[2:] |= starts[2:] & _LINE[data[1:-1]] & visible[:-2]
    else:
        cut[1:] |= space[:-1] & ~space[1:]
    return np.flatnonzero(cut)


class _Memory:
    """Ids of pieces by 64-bit hash and length; two sorted parts, so that adding stays cheap."""

    def __init__(self):
        self.parts = [self._part(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32))] * 2

    @staticmethod
    def _part(keys, sizes, counts, flat):
        order = np.argsort(keys, kind="stable")
        return keys[order], sizes[order], (np.cumsum(counts) - counts)[order], counts[order], flat

    def find(self, keys: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each part the places found, their begins and counts, and the flat ids."""
        for known, known_sizes, begins, counts, flat in self.parts:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = np.flatnonzero((known[at] == keys) & (known_sizes[at] == sizes))
                yield hit, begins[at[hit]], counts[at[hit]], flat

    def add(self, keys, sizes, counts, flat) -> None:
        main, recent = self.parts
        if len(main[0]) + len(recent[0]) >= REMEMBERED:
            return

        def plain(part):
            order = np.argsort(part[2], kind="stable")
            return part[0][order], part[1][order], part[3][order], part[4]

        old = plain(recent)
        recent = self._part(*(np.concatenate(x) for x in zip(old, (keys, sizes, counts, flat))))
        if len(recent[0]) * 4 > len(main[0]):
            main = self._part(*(np.concatenate(x) for x in zip(plain(main), plain(recent))))
            recent = self._part(*(x[:0] for x in plain(recent)))
        self.parts = [main, recent]


class _Pieces:
    """Texts cut into pieces; each distinct piece is encoded by the library once and remembered."""

    def __init__(self, name: str):
        self.tokenizer = load(name)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = _Memory()
        self.keeps_space = self.tokenizer.normalizer is None
        lead = "[ ]?" if self.keeps_space else ""
        #: One pre-token for sure: it goes straight to the merges.
        self.simple = re.compile(f"{lead}[{_LETTERS}]+|{lead}[{_MARKS}]+").fullmatch
        # How the library writes single characters for its merges.
        self.letters = {}
        for code in [32, *range(33, 127), *range(0xC0, 0x100)]:
            if re.fullmatch(f"[ {_LETTERS}{_MARKS}]", chr(code)):
                written = self._written(chr(code))
                if len(written) == 1:
                    self.letters[code] = written[0]

    def _written(self, text: str) -> list[str]:
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [part for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def whole(self, texts: list[str]) -> list[list[int]]:
        """What the library gives for texts as they are."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        merge, letters, simple = self.tokenizer.model.tokenize, self.letters, self.simple
        out = [[t.id for t in merge(p.translate(letters))] if simple(p) else None for p in pieces]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.whole([pieces[i] for i in rest])):
            out[i] = ids
        return np.fromiter(map(len, out), np.int64, len(out)), np.fromiter(chain.from_iterable(out), np.uint32)

    def cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first, codes, begins, counts, flat): text i has the pieces codes[first[i]:first[i+1]];
        piece code c has the ids flat[begins[c]:begins[c]+counts[c]]."""
        data, offsets = buffers(texts)
        if not self.keeps_space:
            data = LOWER[data]
        # Marks, not np.unique: that hashes every cut, which takes most of the time.
        marked = np.zeros(len(data) + 1, bool)
        marked[_cuts(data, self.keeps_space)] = True
        marked[offsets] = True
        edges = np.flatnonzero(marked)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        words = coded.dictionary
        spelled, bounds = buffers(words)
        sizes = np.diff(bounds)
        keys = hashed_runs(spelled, bounds[:-1], bounds[1:])
        begins, counts, missing = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.ones(len(words), bool)
        flats, base = [], 0
        for hit, at, n, flat in self.memory.find(keys, sizes):
            begins[hit], counts[hit], missing[hit] = at + base, n, False
            flats.append(flat)
            base += len(flat)
        new = np.flatnonzero(missing)
        n, flat = self._encoded(words.take(pa.array(new)).cast(pa.large_string()).to_pylist())
        begins[new], counts[new] = np.cumsum(n) - n + base, n
        self.memory.add(keys[new], sizes[new], n, flat)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        return np.searchsorted(edges, offsets), codes, begins, counts, np.concatenate([*flats, flat])

    def direct(self, texts: pa.Array) -> np.ndarray:
        """Texts that must not be cut here."""
        out = pa.array(np.zeros(len(texts), bool))
        for special in self.specials:
            out = pc.or_(out, pc.match_substring(texts, special))
        return out.to_numpy(zero_copy_only=False)


class Counter(_Pieces):
    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of tokens of each text; null has none."""
        texts = texts.cast(pa.large_string()).fill_null("")
        direct = self.direct(texts)
        out = np.zeros(len(texts), np.int64)
        for i in np.flatnonzero(direct):
            out[i] = len(self.whole([texts[int(i)].as_py()])[0])
        at = np.flatnonzero(~direct)
        if len(at):
            first, codes, _, counts, _ = self.cut(texts.take(pa.array(at)))
            sums = np.concatenate([[0], np.cumsum(counts[codes])])
            out[at] = sums[first[1:]] - sums[first[:-1]]
        return out


class Encoder(_Pieces):
    """Ids of texts, for vocabularies that drop white space."""

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        texts = texts.cast(pa.large_string()).fill_null("")
        direct = self.direct(texts)
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for i in np.flatnonzero(direct):
            out[i] = np.array(self.whole([texts[int(i)].as_py()])[0], np.uint32)
        at = np.flatnonzero(~direct)
        if len(at):
            first, codes, begins, counts, flat = self.cut(texts.take(pa.array(at)))
            n = counts[codes]
            upto = np.concatenate([[0], np.cumsum(n)])
            # Place in flat of every id: the piece's begin plus the place within the piece.
            everything = flat[np.arange(upto[-1]) + np.repeat(begins[codes] - upto[:-1], n)]
            for i, low, high in zip(at, upto[first[:-1]], upto[first[1:]]):
                out[i] = everything[low:high]
        return out


_made: dict[tuple[type, str], _Pieces] = {}


def worker(kind: type, name: str):
    """One per Python worker, so that what it remembers serves later tasks."""
    if (kind, name) not in _made:
        _made.clear()
        _made[(kind, name)] = kind(name)
    return _made[(kind, name)]


def boundaries(encoding) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pre-tokens in characters, and the tokens before each."""
    words, offsets = encoding.word_ids, encoding.offsets
    at, before = [], []
    last: object = ()
    for k, (word, (start, end)) in enumerate(zip(words, offsets)):
        if word is None or word != last:
            at.append(start)
            before.append(k)
        last = () if word is None else word
    return np.array(at, np.int64), np.array(before, np.int64)


def seam(left: list[tuple[int, int]], right: list[tuple[int, int]]) -> tuple[int, int] | None:
    """Tokens of the left chunk before, and of the right chunk before, the first common boundary."""
    there = dict(right)
    return next(((n, there[p]) for p, n in left if p in there), None)


def _chunk_counts(batches: Iterator[pa.RecordBatch], name: str, chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    tokenizer = load(name)
    for batch in batches:
        rows = {"key": [], "part": [], "tokens": [], "head": [], "tail": []}
        for key, part, last, text in zip(*(batch.column(c).to_pylist() for c in ("key", "part", "last", "piece"))):
            encoding = tokenizer.encode(text, add_special_tokens=False)
            at, before = boundaries(encoding)
            at_doc = at + part * chunk
            marks = list(zip(at_doc.tolist(), before.tolist()))
            end = part * chunk + len(text)
            rows["key"].append(key)
            rows["part"].append(part)
            rows["tokens"].append(len(encoding))
            # Either side of a seam sees the same stretch: the overlap without its last MARGIN characters.
            rows["head"].append([m for m in marks if part and m[0] <= part * chunk + overlap - MARGIN])
            rows["tail"].append([m for m in marks if not last and (part + 1) * chunk < m[0] <= end - MARGIN])
        mark = pa.list_(pa.list_(pa.int64()))
        types = {"key": pa.int64(), "part": pa.int64(), "tokens": pa.int64(), "head": mark, "tail": mark}
        yield pa.RecordBatch.from_pydict({k: pa.array(v, types[k]) for k, v in rows.items()}, pa.schema(types))


def _seam_loss(left: pa.Array, right: pa.Array) -> pa.Array:
    out = []
    for a, b in zip(left.to_pylist(), right.to_pylist()):
        met = seam([tuple(x) for x in a], [tuple(x) for x in b])
        out.append(None if met is None else met[1] - met[0])
    return pa.array(out, pa.int64())


def _spliced(long: DataFrame, name: str, chunk: int, overlap: int) -> DataFrame:
    """(key, tokens): the number of tokens, null where a seam found no common boundary."""
    size = F.length("text")
    parts = F.greatest(F.lit(1), F.ceil(size / F.lit(chunk)))
    chunks = (
        long.select("key", "text", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), (parts - 1).alias("final"))
        .select("key", "part", (F.col("part") == F.col("final")).alias("last"), F.substring("text", (F.col("part") * chunk + 1).cast("int"), F.lit(chunk + overlap)).alias("piece"))
        .repartition("key", "part")
    )
    counted = stage(
        chunks.mapInArrow(
            lambda batches: _chunk_counts(batches, name, chunk, overlap),
            "key long, part long, tokens long, head array<array<long>>, tail array<array<long>>",
        ),
        "chunk-counts",
    )
    loss = F.arrow_udf(_seam_loss, "long")
    left = counted.where(F.size("tail") >= 0).select("key", (F.col("part") + 1).alias("part"), "tail", F.col("tokens").alias("left_tokens"))
    seams = counted.where("part > 0").select("key", "part", "head").join(left, ["key", "part"])
    # Tokens counted twice: those of the left chunk from the boundary on, and of the right chunk before it.
    seams = seams.select("key", (F.col("left_tokens") + loss("tail", "head")).alias("double"))
    return (
        counted.select("key", F.col("tokens").alias("n"), F.lit(False).alias("lost"))
        .union(seams.select("key", -F.col("double"), F.col("double").isNull()))
        .groupBy("key")
        .agg(F.when(~F.bool_or("lost"), F.sum("n")).alias("tokens"))
    )


def token_counts(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", chunk: int = 1 << 15, overlap: int = 512
) -> DataFrame:
    """(key, n_bytes, n_tokens) for every row of ``docs``.

    Null and empty texts have no bytes and no tokens. Rows with equal or null
    keys are counted one by one; an empty table gives an empty result; other
    columns are not read.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    size = F.coalesce(F.length("text"), F.lit(0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker(Counter, vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                n_bytes = pc.binary_length(part.column("text")).fill_null(0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), n_bytes, pa.array(counter.counts(part.column("text")))], names=["id", "n_bytes", "n_tokens"])

    id_type = docs.schema[key].dataType.simpleString()
    schema = f"id {id_type}, n_bytes long, n_tokens long"
    short = rows.where(size <= chunk).mapInArrow(count, schema)
    # Stored, so that the row keys stay the same while a round is repeated; few documents are this long.
    long = stage(rows.where(size > chunk).withColumn("key", F.monotonically_increasing_id()), "long-documents")
    found = []
    rest, wide, lap = long, chunk, overlap
    while not rest.isEmpty():
        result = stage(_spliced(rest.select("key", "text"), vocabulary, wide, lap), "spliced")
        done = rest.join(result.where("tokens is not null"), "key")
        found.append(done.select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.col("tokens").alias("n_tokens")))
        rest = rest.join(result.where("tokens is null").select("key"), "key", "left_semi")
        wide, lap = wide * 4, lap * 4
    for part in found:
        short = short.union(part)
    return short.withColumnRenamed("id", key)
