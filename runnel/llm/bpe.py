"""Byte-level BPE by dynamic programming over prefixes, and decoding.

The merges give every byte string one encoding, and each prefix of that
encoding is the encoding of its own bytes. So a prefix is described by its last
token alone, and that token is the one vocabulary token which ends the prefix
and is compatible with the last token of what stands before it. A suffix
automaton of the vocabulary, fed with the text, names the tokens that end at a
byte, longest first; a pair test tells whether the merges would leave two
neighbours apart. Once the last byte has its token, back-pointers give the ids.

Only distinct pre-tokens are encoded, many at once: position by position over
numpy arrays, or one by one where they are long and few.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.tokens import _Pieces, load
from runnel.llm.words import slices

#: Cells of the table of last tokens of one batch of pre-tokens.
CELLS = 1 << 21
#: Batches with fewer pre-tokens go through the scalar form.
FEW = 12
#: Slots of the table that remembers tested pairs; entries of the scalar form's memories.
SLOTS = 1 << 20
#: Ids decoded at once, unless a single row has more.
AT_ONCE = 1 << 19
_NEVER = np.int64(1 << 40)


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else the next from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Tables:
    """A vocabulary as arrays: spelling, merges and suffix automaton. Its size depends on the vocabulary alone."""

    #: Bytes of token i: spelled[bounds[i]:bounds[i + 1]].
    spelled: np.ndarray
    bounds: np.ndarray
    #: Halves of a merged token, and the rank of its merge; a byte has rank -1.
    left: np.ndarray
    right: np.ndarray
    born: np.ndarray
    #: Merges as sorted left << 32 | right, and their ranks.
    pairs: np.ndarray
    ranks: np.ndarray
    #: Longest token that is a proper suffix of token i; -1 for a byte.
    shorter: np.ndarray
    #: Automaton: sorted state << 8 | byte, the states they lead to, suffix links, longest strings, longest tokens.
    moves: np.ndarray
    target: np.ndarray
    link: np.ndarray
    longest: np.ndarray
    token: np.ndarray


def _automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[int], list[int]]:
    """Suffix automaton of several words: moves, suffix links, and the length of each state's longest string."""
    moves: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]

    def split(p: int, c: int, q: int) -> int:
        """A copy of q for the strings that p and its suffixes lead to by c."""
        moves.append(dict(moves[q]))
        link.append(link[q])
        longest.append(longest[p] + 1)
        copy = link[q] = len(moves) - 1
        while p >= 0 and moves[p].get(c) == q:
            moves[p][c] = copy
            p = link[p]
        return copy

    for word in words:
        state = 0
        for c in word:
            known = moves[state].get(c)
            if known is not None:
                state = known if longest[known] == longest[state] + 1 else split(state, c, known)
                continue
            moves.append({})
            link.append(0)
            longest.append(longest[state] + 1)
            new, p = len(moves) - 1, state
            while p >= 0 and c not in moves[p]:
                moves[p][c] = new
                p = link[p]
            if p >= 0:
                q = moves[p][c]
                link[new] = q if longest[q] == longest[p] + 1 else split(p, c, q)
            state = new
    return moves, link, longest


def _shorter_and_heads(words: list[bytes], usable: np.ndarray, moves, link, longest) -> tuple[np.ndarray, np.ndarray]:
    """(longest token that is a proper suffix of each token, longest token of each state or of its suffixes)."""
    held: dict[int, list[int]] = {}
    at = np.zeros(len(words), np.int64)
    for i, word in enumerate(words):
        state = 0
        for c in word:
            state = moves[state][c]
        at[i] = state
        if usable[i]:
            held.setdefault(state, []).append(i)
    head = np.full(len(moves), -1, np.int32)
    shorter = np.full(len(words), -1, np.int32)
    for state in sorted(range(len(moves)), key=longest.__getitem__):
        before = head[link[state]] if state else -1
        for i in sorted(held.get(state, ()), key=lambda i: len(words[i])):
            shorter[i] = before
            before = i
        head[state] = before
    return shorter, head


def tables(name: str) -> Tables:
    """The tables of a byte-level BPE vocabulary file."""
    model = json.loads(load(name).to_str())["model"]
    if model["type"] != "BPE" or model["continuing_subword_prefix"] or model["end_of_word_suffix"]:
        raise ValueError(f"{name} is no byte-level BPE vocabulary")
    letters = byte_letters()
    ids = model["vocab"]
    words = [b""] * (max(ids.values()) + 1)
    for text, i in ids.items():
        words[i] = bytes(letters[c] for c in text)
    n = len(words)
    left, right, born = np.full(n, -1, np.int32), np.full(n, -1, np.int32), np.full(n, -1, np.int64)
    pairs = {}
    for rank, (a, b) in enumerate(model["merges"]):
        i = ids[a + b]
        pairs[ids[a] << 32 | ids[b]] = rank
        if born[i] < 0:
            left[i], right[i], born[i] = ids[a], ids[b], rank
    keys = np.array(sorted(pairs), np.int64)
    moves, link, longest = _automaton(words)
    spelled = np.frombuffer(b"".join(words), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    out = Tables(
        spelled, bounds, left, right, born, keys, np.array([pairs[k] for k in keys.tolist()], np.int64), np.zeros(n, np.int32),
        *(np.zeros(0),) * 2, np.array(link, np.int32), np.array(longest, np.int32), np.zeros(0),
    )
    # A token that its own merges do not produce is never emitted.
    made = np.flatnonzero(born >= 0)
    whole = Pairs(out).apart(left[made], right[made], born[made])
    usable = np.diff(bounds) == 1
    for i, fine in sorted(zip(made.tolist(), whole.tolist()), key=lambda x: born[x[0]]):
        usable[i] = fine and usable[left[i]] and usable[right[i]]
    out.shorter, out.token = _shorter_and_heads(words, usable, moves, link, longest)
    flat = [(state << 8 | c, to) for state, row in enumerate(moves) for c, to in row.items()]
    flat.sort()
    out.moves, out.target = (np.array(x, t) for x, t in zip(zip(*flat), (np.int64, np.int32)))
    return out


class Pairs:
    """Whether the merges leave two neighbouring tokens apart."""

    def __init__(self, tables: Tables):
        self.t = tables
        self.keys = np.full(SLOTS, -1, np.int64)
        self.found = np.zeros(SLOTS, bool)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or never."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.t.pairs, key), len(self.t.pairs) - 1)
        return np.where(self.t.pairs[at] == key, self.t.ranks[at], _NEVER)

    def apart(self, a: np.ndarray, b: np.ndarray, end: np.ndarray | int = _NEVER) -> np.ndarray:
        """Whether no merge before rank ``end`` joins a part of a with a part of b.

        Merges are undone from the last to the first. What ends a and what begins b
        at a time may merge unless one of them is used up by an earlier merge of its
        own token; at equal rank the merge further left comes first.
        """
        t = self.t
        good = np.ones(len(a), bool)
        a, b = a.astype(np.int64), b.astype(np.int64)
        a_ends = np.broadcast_to(np.asarray(end, np.int64), a.shape).copy()
        b_ends = a_ends - (a_ends < _NEVER)
        live = np.arange(len(a))
        while len(live):
            rank = self.rank(a, b)
            good[live] &= ~((rank < a_ends) & (rank <= b_ends) & (rank < _NEVER))
            born_a, born_b = t.born[a], t.born[b]
            back = born_a > born_b
            go = good[live] & (np.maximum(born_a, born_b) >= 0)
            live, back = live[go], back[go]
            a, b, a_ends, b_ends, born_a, born_b = (x[go] for x in (a, b, a_ends, b_ends, born_a, born_b))
            a_ends, b_ends = np.where(back, born_a, a_ends), np.where(back, b_ends, born_b)
            a, b = np.where(back, t.right[a], a), np.where(back, b, t.left[b])
        return good

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``apart`` for any order of merges, with a memory of fixed size."""
        key = a.astype(np.int64) << 32 | b
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        out = self.found[slot]
        new = np.flatnonzero(self.keys[slot] != key)
        if len(new):
            once, back = np.unique(key[new], return_inverse=True)
            out[new] = self.apart(once >> 32, once & 0xFFFFFFFF)[back]
            self.keys[slot[new]], self.found[slot[new]] = key[new], out[new]
        return out


class Prefixes:
    """Ids of byte strings by the last token of every prefix."""

    def __init__(self, tables: Tables):
        self.t = tables
        self.size = np.diff(tables.bounds)
        self.pairs = Pairs(tables)
        self.go: dict[int, int] = {}
        self.tested: dict[int, bool] = {}

    def step(self, state: np.ndarray, length: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State and match length after one more byte: the longest suffix of the text that some token holds."""
        t = self.t
        state, length = state.copy(), length.copy()
        open_ = np.arange(len(state))
        while len(open_):
            key = state[open_].astype(np.int64) << 8 | byte[open_]
            at = np.minimum(np.searchsorted(t.moves, key), len(t.moves) - 1)
            hit = t.moves[at] == key
            done, open_ = open_[hit], open_[~hit]
            state[done] = t.target[at[hit]]
            length[done] += 1
            if len(open_):
                if not state[open_].any():
                    raise ValueError("the vocabulary lacks a byte of the text")
                state[open_] = t.link[state[open_]]
                length[open_] = t.longest[state[open_]]
        return state, length

    def last_tokens(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """last[i, k]: the last token of the first k bytes of string i; the strings come longest first."""
        t, n = self.t, len(sizes)
        last = np.full((n, int(sizes[0]) + 1), -1, np.int32)
        state, length = np.zeros(n, np.int32), np.zeros(n, np.int32)
        for k in range(int(sizes[0])):
            m = int(np.searchsorted(-sizes, -k, "left"))
            state, length = self.step(state[:m], length[:m], data[begins[:m] + k])
            token = t.token[state]
            over = np.flatnonzero(self.size[token] > length)
            while len(over):
                token[over] = t.shorter[token[over]]
                over = over[self.size[token[over]] > length[over]]
            rest = np.arange(m)
            while len(rest):
                before = last[rest, k + 1 - self.size[token]]
                fits = before < 0
                ask = np.flatnonzero(~fits)
                fits[ask] = self.pairs.compatible(before[ask], token[ask])
                last[rest[fits], k + 1] = token[fits]
                rest, token = rest[~fits], t.shorter[token[~fits]]
        return last

    def _one(self, text: bytes) -> list[int]:
        """The same for one string, byte by byte in Python."""
        t, size, go, tested = self.t, self.size, self.go, self.tested
        last = np.full(len(text) + 1, -1, np.int32)
        state = length = 0
        for k, c in enumerate(text, 1):
            move = state << 40 | length << 8 | c
            found = go.get(move)
            if found is None:
                if len(go) > SLOTS:
                    go.clear()
                s, l = self.step(np.array([state]), np.array([length]), np.array([c]))
                found = go[move] = int(s[0]), int(l[0])
            state, length = found
            token = int(t.token[state])
            while size[token] > length:
                token = int(t.shorter[token])
            while True:
                before = int(last[k - size[token]])
                if before < 0:
                    break
                pair = before << 32 | token
                fits = tested.get(pair)
                if fits is None:
                    if len(tested) > SLOTS:
                        tested.clear()
                    fits = tested[pair] = bool(self.pairs.compatible(np.array([before]), np.array([token]))[0])
                if fits:
                    break
                token = int(t.shorter[token])
            last[k] = token
        out, k = [], len(text)
        while k:
            out.append(int(last[k]))
            k -= int(size[out[-1]])
        return out[::-1]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids): numbers of tokens of the strings, and all ids in order."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(b"".join(texts), np.uint8)
        begins = np.cumsum(sizes) - sizes
        counts = np.zeros(len(texts), np.int64)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        i = 0
        while i < len(order):
            most = int(sizes[order[i]]) + 1
            j = min(len(order), i + max(1, CELLS // most))
            rows = order[i:j]
            if j - i < FEW:
                for r in rows.tolist():
                    ids = np.array(self._one(texts[r]), np.int64)
                    counts[r] = len(ids)
                    held.append((np.full(len(ids), r), np.arange(len(ids))[::-1], ids))
            else:
                last = self.last_tokens(data, begins[rows], sizes[rows])
                at, live, step = sizes[rows].copy(), np.arange(len(rows)), 0
                while len(live):
                    ids = last[live, at[live]]
                    held.append((rows[live], np.full(len(live), step), ids))
                    at[live] -= self.size[ids]
                    counts[rows[live]] += 1
                    live = live[at[live] > 0]
                    step += 1
            i = j
        flat = np.zeros(int(counts.sum()), np.uint32)
        ends = np.cumsum(counts)
        for row, from_end, ids in held:
            flat[ends[row] - 1 - from_end] = ids
        return counts, flat


class PrefixEncoder(_Pieces):
    """Ids of whole texts: pre-tokens by the vocabulary's own splitting, special strings first, ids by ``Prefixes``."""

    def __init__(self, name: str, tables: Tables):
        super().__init__(name)
        self.prefixes = Prefixes(tables)
        self.special_ids = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        simple, split = self.simple, self.tokenizer.pre_tokenizer.pre_tokenize_str
        parts = [[p] if simple(p) else [p[a:b] for _, (a, b) in split(p)] for p in pieces]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        counts, flat = self.prefixes.encode([p.encode() for p in chain.from_iterable(parts)])
        upto = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(sizes)
        return upto[ends] - upto[ends - sizes], flat

    def _marked(self, text: str) -> list[int]:
        """Ids of a text that holds special strings: the first one from the left, the longer one at the same place, is a token of its own."""
        out: list[int] = []
        while True:
            found = [(at, -len(s), s) for s in self.specials if (at := text.find(s)) >= 0]
            at, _, special = min(found, default=(len(text), 0, None))
            if at:
                out.extend(self._encoded([text[:at]])[1].tolist())
            if special is None:
                return out
            out.append(self.special_ids[special])
            text = text[at + len(special) :]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bounds, ids): text i has ids[bounds[i]:bounds[i + 1]]; null counts as empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        marked = self.direct(texts)
        first, codes, begins, counts, flat = self.cut(pa.array(np.where(marked, "", texts.to_numpy(zero_copy_only=False)), pa.large_string()) if marked.any() else texts)
        n = counts[codes]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.arange(upto[-1]) + np.repeat(begins[codes] - upto[:-1], n)].astype(np.int32)
        bounds = upto[first]
        if marked.any():
            own = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            for i in np.flatnonzero(marked):
                own[i] = np.array(self._marked(texts[int(i)].as_py()), np.int32)
            ids = np.concatenate(own)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        return bounds, ids


_built: dict[str, Tables] = {}
_encoders: dict[str, PrefixEncoder] = {}


def _tables(name: str) -> Tables:
    if name not in _built:
        _built[name] = tables(name)
    return _built[name]


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids) of every row: the ids of its whole text, as the library gives them without added tokens.

    Null and empty texts have no ids. A special token's string in a text is that
    token. Repeated and null keys are rows of their own, an empty table
    gives an empty result, other columns are not read.
    """
    spark = docs.sparkSession
    # Bounded by the vocabulary, whatever the table holds.
    shared = spark.sparkContext.broadcast(_tables(vocabulary))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _encoders:
            _encoders[vocabulary] = PrefixEncoder(vocabulary, shared.value)
        encoder = _encoders[vocabulary]
        for batch in batches:
            for part in slices(batch, "text", 1 << 21):
                bounds, ids = encoder.ids(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(bounds)), lists], names=["id", "n_tokens", "ids"])

    id_type = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, n_tokens long, ids array<int>").withColumnRenamed("id", key)


def _spellings(name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every id, special ones included, and where they begin."""
    t, specials = _tables(name), load(name).get_added_tokens_decoder()
    words = {i: s.content.encode() for i, s in specials.items()}
    n = max([len(t.bounds) - 1, *(i + 1 for i in words)])
    own = [words.get(i, t.spelled[t.bounds[i] : t.bounds[i + 1]].tobytes() if i + 1 < len(t.bounds) else b"") for i in range(n)]
    return np.frombuffer(b"".join(own), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in own])])


def decoder(spark, vocabulary: str):
    """A column function from ids to text; bytes that form no character become U+FFFD, null ids give null, unknown ids nothing."""
    shared = spark.sparkContext.broadcast(_spellings(vocabulary))

    def spelled_out(ids: pa.Array, words: pa.Array, sizes: np.ndarray) -> list[str]:
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        unknown = (flat < 0) | (flat >= len(words))
        if unknown.any():
            flat = np.where(unknown, len(words) - 1, flat)  # the last word is the empty one
        joined = words.take(pa.array(flat))
        counts = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes[flat])])[np.concatenate([[0], np.cumsum(counts)])]
        raw = memoryview(b"".join(joined.buffers()[2:] if len(flat) else []))
        return [bytes(raw[a:b]).decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        spelled, bounds = shared.value
        bounds = np.append(bounds, bounds[-1]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(spelled)])
        counts = np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        texts, i = [], 0
        while i < len(ids):
            # Some rows at a time: a batch of rows may hold many ids.
            j = max(i + 1, int(np.searchsorted(counts, (counts[i - 1] if i else 0) + AT_ONCE, "right")))
            texts += spelled_out(ids.slice(i, j - i), words, np.diff(bounds))
            i = j
        return pa.array(texts, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))

    return decode


def digest(ids: Column | str) -> Column:
    """SHA-256, in lowercase hex, of the decimal ids joined by commas."""
    column = F.col(ids) if isinstance(ids, str) else ids
    return F.sha2(F.array_join(column.cast("array<string>"), ","), 256)
