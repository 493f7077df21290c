"""Packing of documents into token windows by the sum-of-squares rule.

The rest of a document that does not fill a window goes, whole, into the open
window whose fill level makes the sum of squared level counts smallest. Only the
counts of open windows by level are looked at, an array as long as the window,
and the open windows themselves, of which a task holds a bounded number.

Each task packs its own documents as they come. The pieces of windows that stay
open are packed by the same rule once more, those of many tasks together. What is
still open then is topped up by cutting the emptiest windows' pieces, and a
task's last window is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.llm.tokens import Encoder, worker
from runnel.llm.words import release, slices
from runnel.sources.staging import stage

#: Characters encoded at once of a long text; it is cut at white space only.
SEGMENT = 1 << 22
#: Bytes of text encoded at once; each takes some 50 bytes of memory.
SLICE = 1 << 20
#: Open windows of a task; beyond that the fuller half is closed.
OPEN = 4096
#: Ids that a task of the second round gets, some 4,000 windows.
ROUND = 1 << 23
#: Windows of a record batch.
SENT = 256

#: (document, start in the document, ids)
Piece = tuple[object, int, np.ndarray]


class SumOfSquares:
    """Open windows by fill level, and the online rule that places pieces."""

    def __init__(self, window: int, most: int = OPEN):
        self.window, self.most = window, most
        #: Number of open windows at each level; a closed or empty window counts for nothing.
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window + 1)]
        self.full: list[list[Piece]] = []
        #: Windows closed before they were full, the fullest first.
        self.closed: list[list[Piece]] = []

    def level_for(self, size: int) -> int:
        """Fill level to add a piece of so many ids to; 0 opens a window.

        Moving a window from level h to h + size changes the sum of squares by
        2 * (counts[h + size] - counts[h]) + 2. A new window and a window that
        becomes full change one count only. Ties go to the fullest level.
        """
        last = self.window - size
        counts = self.counts
        change = 2 * (counts[size : size + last + 1] - counts[: last + 1]) + 2
        change[0] = 2 * counts[size] + 1
        change[last] = -2 * counts[last] + 1 if last else 0
        usable = counts[: last + 1] > 0
        usable[0] = True
        places = np.flatnonzero(usable)
        values = change[places]
        return int(places[len(values) - 1 - int(np.argmin(values[::-1]))])

    def add(self, piece: Piece) -> None:
        size = len(piece[2])
        level = self.level_for(size)
        if level:
            held = self.open[level].pop()
            self.counts[level] -= 1
        else:
            held = []
        held.append(piece)
        if level + size == self.window:
            self.full.append(held)
        else:
            self.open[level + size].append(held)
            self.counts[level + size] += 1
            if not level and self.counts.sum() > self.most:
                self.close(self.most // 2)

    def close(self, keep: int = 0) -> None:
        """Closes open windows, the fullest first, until no more than ``keep`` are left."""
        over = int(self.counts.sum()) - keep
        for level in range(self.window, 0, -1):
            while over > 0 and self.open[level]:
                self.closed.append(self.open[level].pop())
                self.counts[level] -= 1
                over -= 1

    def add_document(self, document: object, start: int, ids: np.ndarray) -> None:
        """Whole windows first, then the rest by the rule."""
        whole = len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            self.full.append([(document, start + at, ids[at : at + self.window])])
        if whole < len(ids):
            # A copy: an open window keeps nothing but its own ids.
            self.add((document, start + whole, ids[whole:].copy() if whole else ids))

    def take_full(self) -> list[list[Piece]]:
        full, self.full = self.full, []
        return full

    def take_closed(self) -> list[list[Piece]]:
        closed, self.closed = self.closed, []
        return closed

    def topped_up(self) -> tuple[list[list[Piece]], list[Piece]]:
        """Full windows made of the closed ones, the fullest topped up with pieces of the emptiest, and the pieces left over."""
        held = sorted(self.take_closed(), key=lambda w: -sum(len(p[2]) for p in w))
        left, right, out = 0, len(held) - 1, []
        while left < right:
            room = self.window - sum(len(p[2]) for p in held[left])
            while room and left < right:
                document, start, ids = held[right].pop()
                if len(ids) > room:
                    held[right].append((document, start, ids[:-room]))
                    start, ids = start + len(ids) - room, ids[-room:]
                held[left].append((document, start, ids))
                room -= len(ids)
                if not held[right]:
                    right -= 1
            if not room:
                out.append(held[left])
                left += 1
        return out, held[left] if left == right else []


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """Pieces cut into sequences whose lengths are the powers of two that make up the total."""
    out, rest, total = [], list(pieces), sum(len(p[2]) for p in pieces)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out.append([])
        while room:
            document, start, ids = rest.pop(0)
            if len(ids) > room:
                rest.insert(0, (document, start + room, ids[room:]))
                ids = ids[:room]
            out[-1].append((document, start, ids))
            room -= len(ids)
    return out


def segments(text: str, most: int = SEGMENT) -> Iterator[str]:
    """A text in parts, cut before spaces or line feeds; a part is longer if it has none."""
    at = 0
    while len(text) - at > most:
        cut = max(text.rfind(" ", at + 1, at + most), text.rfind("\n", at + 1, at + most))
        if cut < 0:
            later = [x for x in (text.find(" ", at + most), text.find("\n", at + most)) if x >= 0]
            if not later:
                break
            cut = min(later)
        yield text[at:cut]
        at = cut
    yield text[at:]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, by_rule boolean"


class Rows:
    """Record batches of a task's pieces; a document is its (key, number of ids)."""

    def __init__(self, first_sequence: int, key_type: pa.DataType, names: list[str]):
        self.sequence, self.key_type, self.names = first_sequence, key_type, names

    def _batch(self, rows: list[tuple[Piece, int | None, int | None]], by_rule: bool | None, with_ids: bool) -> pa.RecordBatch:
        sizes = [len(p[2]) for p, _, _ in rows]
        lists = pa.nulls(len(rows), pa.list_(pa.int32()))
        if with_ids and rows:
            values = np.concatenate([p[2] for p, _, _ in rows]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values))
        columns = {
            "id": pa.array([p[0][0] for p, _, _ in rows], self.key_type),
            "start": pa.array([p[1] for p, _, _ in rows], pa.int64()),
            "length": pa.array(sizes, pa.int64()),
            "ids_crc32": pa.array([crc(p[2]) for p, _, _ in rows], pa.int64()),
            "doc_tokens": pa.array([p[0][1] for p, _, _ in rows], pa.int64()),
            "sequence_id": pa.array([s for _, s, _ in rows], pa.int64()),
            "offset": pa.array([o for _, _, o in rows], pa.int64()),
            "by_rule": pa.array([by_rule] * len(rows), pa.bool_()),
            "ids": lists,
        }
        return pa.RecordBatch.from_arrays(list(columns.values())[: len(self.names)], names=self.names)

    def sequences(self, windows: list[list[Piece]], by_rule: bool, with_ids: bool) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(windows), SENT):
            rows = []
            for pieces in windows[at : at + SENT]:
                offset = 0
                for piece in pieces:
                    rows.append((piece, self.sequence, offset))
                    offset += len(piece[2])
                self.sequence += 1
            yield self._batch(rows, by_rule, with_ids)

    def left(self, windows: list[list[Piece]]) -> Iterator[pa.RecordBatch]:
        """Pieces for the second round: no sequence yet."""
        for at in range(0, len(windows), SENT):
            yield self._batch([(p, None, None) for w in windows[at : at + SENT] for p in w], None, True)


def _first_round(batches: Iterator[pa.RecordBatch], vocabulary: str, window: int, end_id: int, with_ids: bool, most: int) -> Iterator[pa.RecordBatch]:
    """Full windows, and the pieces of all others."""
    release()
    encoder, packer, out = worker(Encoder, vocabulary), SumOfSquares(window, most), None
    for batch in batches:
        names = ["id", *(f.split(" ")[0] for f in FIELDS.split(", ")), "ids"]
        out = out or Rows(TaskContext.get().partitionId() << 40, batch.column("id").type, names)
        for part in slices(batch, "text", SLICE):
            short = pc.utf8_length(part.column("text").fill_null("")).to_numpy(zero_copy_only=False) <= SEGMENT
            encoded = iter(encoder.ids(part.column("text").filter(pa.array(short))))
            for i, name in enumerate(part.column("id").to_pylist()):
                if short[i]:
                    ids = np.append(next(encoded), np.uint32(end_id))
                else:
                    parts = segments(part.column("text")[i].as_py())
                    ids = np.concatenate([*(encoder.ids(pa.array([x]))[0] for x in parts), np.array([end_id], np.uint32)])
                packer.add_document((name, len(ids)), 0, ids)
            if packer.full:
                yield from out.sequences(packer.take_full(), True, with_ids)
            if packer.closed:
                yield from out.left(packer.take_closed())
    if out:
        packer.close()
        yield from out.left(packer.take_closed())


def _second_round(batches: Iterator[pa.RecordBatch], window: int, with_ids: bool, most: int) -> Iterator[pa.RecordBatch]:
    """The first round's pieces by the same rule; no window stays open."""
    release()
    packer, out = SumOfSquares(window, most), None
    for batch in batches:
        names = ["id", *(f.split(" ")[0] for f in FIELDS.split(", ")), *(["ids"] if with_ids else [])]
        out = out or Rows((1 << 62) + (TaskContext.get().partitionId() << 40), batch.column("id").type, names)
        for at in range(0, len(batch), 1000):
            part = batch.slice(at, 1000)
            lists = part.column("ids")
            bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            documents = zip(part.column("id").to_pylist(), part.column("doc_tokens").to_pylist())
            for i, (document, start) in enumerate(zip(documents, part.column("start").to_pylist())):
                packer.add((document, start, values[bounds[i] : bounds[i + 1]].astype(np.uint32)))
            if packer.full:
                yield from out.sequences(packer.take_full(), True, with_ids)
            if packer.closed:
                full, rest = packer.topped_up()
                yield from out.sequences(full, False, with_ids)
                for piece in rest:
                    packer.add(piece)
    if out:
        packer.close()
        full, rest = packer.topped_up()
        yield from out.sequences(packer.take_full(), True, with_ids)
        yield from out.sequences(full + powers_of_two(rest), False, with_ids)


def pack(
    docs: DataFrame,
    vocabulary: str,
    window: int = 2048,
    end_id: int = 1,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
    most: int = OPEN,
    per_task: int = ROUND,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, by_rule and, if wanted, ids.

    A document's ids are those of its text and ``end_id``; null and empty texts
    have that id only. The pieces of a document hold each of its ids once.
    Sequences of a power of two need no padding, and no others arise but full
    ones. by_rule tells the sequences that the rule filled from those topped up.
    A task has at most ``most`` open windows. The first round is stored in the shared folder,
    so it is not run again; its left pieces go to tasks of some ``per_task`` ids each, in a
    fixed order, so a task that runs again makes the same sequences. sequence_id holds round
    and task in its upper bits. Rows with equal or null
    keys are packed one by one. An empty table gives an empty result.
    """
    schema = f"id {docs.schema[key].dataType.simpleString()}, {FIELDS}"
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    first = rows.mapInArrow(lambda batches: _first_round(batches, vocabulary, window, end_id, with_ids, most), f"{schema}, ids array<int>")
    first = stage(first, "packing")
    done, left = first.where("sequence_id is not null"), first.where("sequence_id is null")
    # Reads one column; the number of tasks follows the ids that are left.
    ids = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    order = ["id", "start", "ids_crc32", "length", "doc_tokens"]
    left = left.select(*order, "ids").repartition(max(1, -(-ids // per_task)), F.xxhash64("id", "start", "ids_crc32"))
    if with_ids:
        schema += ", ids array<int>"
    # Mixed by a hash, for the rule does better on pieces in no order of size.
    left = left.sortWithinPartitions(F.xxhash64("id", "start", "ids_crc32"), *order)
    second = left.mapInArrow(lambda batches: _second_round(batches, window, with_ids, most), schema)
    return done.select(*second.columns).union(second).withColumnRenamed("id", key)
