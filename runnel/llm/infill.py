"""Fill-in-the-middle texts, cut by a Fenwick tree over text blocks.

The bytes of a batch of texts stand in blocks of fixed size. A Fenwick tree
holds how many units, and how many code points, begin in each block. The place
of the n-th unit is found by binary lifting: one descent of the tree finds the
block and what begins before it, then only that block's bytes are looked at.
All cuts of a batch descend together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.words import SPACED, buffers, slices

#: Bytes of a block.
BLOCK = 256
#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Fenwick:
    """Prefix sums of several counts per block."""

    def __init__(self, counts: np.ndarray):
        self.n = len(counts)
        self.levels = max(1, self.n.bit_length())
        self.tree = np.zeros((self.n + 1, counts.shape[1]), np.int64)
        self.tree[1:] = counts
        # A node gives its sum to the next larger node that covers it; nodes of one level have different ones.
        for level in range(self.levels):
            step = 1 << level
            nodes = np.arange(step, self.n + 1, 2 * step)
            above = nodes + step
            inside = above <= self.n
            np.add.at(self.tree, above[inside], self.tree[nodes[inside]])

    def before(self, block: np.ndarray) -> np.ndarray:
        """Sums over the blocks before each given one."""
        out = np.zeros((len(block), self.tree.shape[1]), np.int64)
        at = block.copy()
        while (at > 0).any():
            out += self.tree[at]
            at &= at - 1
        return out

    def find(self, column: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, sums before it): the block in which the item of that 0-based rank lies; the number of blocks if there is none."""
        block = np.zeros(len(rank), np.int64)
        sums = np.zeros((len(rank), self.tree.shape[1]), np.int64)
        for level in reversed(range(self.levels)):
            there = block + (1 << level)
            node = self.tree[np.minimum(there, self.n)]
            go = (there <= self.n) & (sums[:, column] + node[:, column] <= rank)
            block[go] = there[go]
            sums[go] += node[go]
        return block, sums


def unit_starts(data: np.ndarray, offsets: np.ndarray, unit: str) -> np.ndarray:
    """Whether a unit begins at each byte: a code point, or a word with the white space after it."""
    if unit == "char":
        return (data & 0xC0) != 0x80
    if unit != "word":
        raise ValueError(f"no such unit: {unit}")
    inside = SPACED[data]
    out = inside.copy()
    out[1:] &= ~inside[:-1]
    # A text's first unit begins with the text, also where white space leads.
    full = offsets[:-1][np.diff(offsets) > 0]
    first = np.zeros(len(data), bool)
    first[full] = True
    lead = first & ~inside
    if lead.any():
        # The first word after leading white space belongs to that first unit.
        word = np.flatnonzero(out)
        at = np.searchsorted(word, np.flatnonzero(lead))
        ends = offsets[np.searchsorted(offsets, np.flatnonzero(lead), "right")]
        near = at < len(word)
        near[near] = word[at[near]] < ends[near]
        out[word[at[near]]] = False
    return out | first


class Cutter:
    """Cuts of the texts of one batch."""

    def __init__(self, texts: pa.Array, unit: str = "char", block: int = BLOCK):
        self.data, self.offsets = buffers(texts)
        self.block = block
        n = -(-len(self.data) // block)
        self.marks = np.zeros((n * block, 2), bool)
        self.marks[: len(self.data), 0] = unit_starts(self.data, self.offsets, unit)
        self.marks[: len(self.data), 1] = (self.data & 0xC0) != 0x80
        self.tree = Fenwick(self.marks.reshape(n, block, 2).sum(1))
        #: Units and code points before each text, and after the last.
        self.base = self._upto(self.offsets)

    def _upto(self, at: np.ndarray) -> np.ndarray:
        """Units and code points before byte positions."""
        block = at // self.block
        sums = self.tree.before(block)
        part = at - block * self.block
        rows = np.flatnonzero(part)
        held = self.marks.reshape(-1, self.block, 2)[block[rows]]
        sums[rows] += (held & (np.arange(self.block) < part[rows, None])[..., None]).sum(1)
        return sums

    @property
    def units(self) -> np.ndarray:
        return np.diff(self.base[:, 0])

    @property
    def chars(self) -> np.ndarray:
        return np.diff(self.base[:, 1])

    def place(self, text: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte, code points before it in its text) of the cut after so many units of each text."""
        byte, chars = self.offsets[text + 1].copy(), self.base[text + 1, 1] - self.base[text, 1]
        # A cut after the last unit is the text's end; there may be no further unit to look for.
        inner = np.flatnonzero(units < self.base[text + 1, 0] - self.base[text, 0])
        rank = self.base[text[inner], 0] + units[inner]
        block, sums = self.tree.find(0, rank)
        held = self.marks.reshape(-1, self.block, 2)[block]
        upto = held[:, :, 0].cumsum(1)
        local = (upto == (rank - sums[:, 0] + 1)[:, None]).argmax(1)
        byte[inner] = block * self.block + local
        within = (held[:, :, 1] & (np.arange(self.block) < local[:, None])).sum(1)
        chars[inner] = sums[:, 1] + within - self.base[text[inner], 1]
        return byte, chars


def draws(key: Column, salt: str = "1:") -> list[Column]:
    """Four unsigned 32-bit numbers: the first 8-digit groups of the SHA-256 of salt and key."""
    spelled = F.sha2(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(spelled, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "char", plain_percent: int = 10, spm_percent: int = 20, salt: str = "1:") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row.

    The text's n units (code points, or words with the white space after them)
    are cut at two places drawn from the key, and the middle goes last: ``psm``
    is prefix, suffix, middle and ``spm`` suffix, prefix, middle, each
    with its mark. A text stays ``plain``, without lengths, if it is empty or null, if it holds
    a mark, or by a draw. A null key draws as an empty one; repeated keys draw alike,
    each for its own text; an empty table gives an empty result; other columns are not read.
    """
    h = draws(F.col(key), salt)
    body = F.coalesce(F.col(text), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | body.contains(mark)
    plain = (body == "") | marked | (h[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    rows = docs.select(F.col(key).alias("id"), body.alias("text"), form.alias("form"), h[0].alias("h1"), h[1].alias("h2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
        for batch in batches:
            for part in slices(batch, "text"):
                cutter = Cutter(part.column("text"), unit)
                n = cutter.units
                forms = part.column("form")
                moved = np.flatnonzero(forms.to_numpy(zero_copy_only=False) != "plain")
                one, two = (part.column(h).to_numpy()[moved] % (n[moved] + 1) for h in ("h1", "h2"))
                low, prefix = cutter.place(moved, np.minimum(one, two))
                high, upto = cutter.place(moved, np.maximum(one, two))
                lengths = np.zeros((2, len(n)), np.int64)
                lengths[0, moved], lengths[1, moved] = prefix, upto - prefix
                out = part.column("text").to_pylist()
                raw = memoryview(np.ascontiguousarray(cutter.data))
                for i, a, b, kind in zip(moved.tolist(), low.tolist(), high.tolist(), forms.take(pa.array(moved)).to_pylist()):
                    start, end = int(cutter.offsets[i]), int(cutter.offsets[i + 1])
                    first, second = (p, raw[start:a]), (s, raw[b:end])
                    if kind == "spm":
                        first, second = second, first
                    out[i] = b"".join([*first, *second, m, raw[a:b]]).decode()
                still = np.ones(len(n), bool)
                still[moved] = False
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), forms, pa.array(lengths[0], mask=still), pa.array(lengths[1], mask=still), pa.array(out, pa.string())],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    id_type = docs.schema[key].dataType.simpleString()
    schema = f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", key)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text behind an output, from its form and marks alone.

    A text that is not plain holds no mark, and none can arise where a mark meets
    text, since marks begin and end with characters found nowhere else in them.
    """
    p, s, m = (F.locate(mark, F.col(output)) for mark in (PREFIX, SUFFIX, MIDDLE))

    def between(after: Column, upto: Column) -> Column:
        return F.substring(F.col(output), after + len(PREFIX), upto - after - len(PREFIX))

    end = F.length(output) + 1
    psm = F.concat(between(p, s), between(m, end), between(s, m))
    spm = F.concat(between(p, m), between(m, end), between(s, p))
    return F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", psm).otherwise(spm)
