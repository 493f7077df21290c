"""Exact order statistics and quantiles of whole columns.

Built-in exact percentiles keep every distinct value of a column in one task,
and a global sort shuffles the whole column. Here a column is scanned a few
times instead: a histogram by magnitude finds the bucket that holds the wanted
rank, the next scan splits only that bucket, and so on until the value is
known. Each scan shuffles and returns histogram rows alone; they number at most
``budget`` (at least LEAST_BUDGET, or two for each wanted rank) however large the
table is and however many columns it has, and the result is exact.

The functions run Spark jobs when called and return plain numbers, so callers
put thresholds into their plans as literals. Feed them a stored or staged
table: a derived input is computed once per scan.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.functions.values import quoted

#: Upper bound for the histogram rows that one scan returns.
HISTOGRAM_ROWS = 1 << 17

#: Histogram rows that a column needs at least; more columns than fit are read in groups.
LEAST_BUDGET = 64

# Doubles span 2**-1074 to 2**1024; 1025 stands for infinity.
_EXPONENTS = 2200


@dataclass
class ColumnRanks:
    """Row count of a column and its values at the wanted 0-based ranks."""

    count: int = 0
    values: dict[int, float] = field(default_factory=dict)


@dataclass
class _Bracket:
    """A value range that holds wanted ranks: ``below`` rows come before it."""

    column: int
    low: float
    high: float
    below: int
    count: int
    ranks: list[int]


def doubles(columns: Sequence[str]) -> str:
    """The columns as doubles, as SQL text."""
    return ", ".join(f"cast({quoted(c)} as double)" for c in columns)


def _magnitude(v: np.ndarray, parts: int, octaves: int) -> np.ndarray:
    """Bucket by sign and binary exponent; rises with v, and infinity has buckets of its own.

    An octave has ``parts`` buckets, or a bucket ``octaves`` octaves.
    """
    finite = np.isfinite(v)
    mantissa, exponent = np.frexp(np.abs(np.where(finite, v, 1.0)))
    size = (exponent.astype(np.int64) + 1100) * parts // octaves
    if parts > 1:
        size += ((mantissa * 2 - 1) * parts).astype(np.int64)
    size = np.where(finite, size, 2300 * parts)
    return np.where(v == 0, 0, np.where(v < 0, -size - 1, size + 1))


def _tally(owner: np.ndarray, bucket: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of equal owner and bucket as one: their count, lowest and highest value."""
    order = np.lexsort((bucket, owner))
    owner, bucket = owner[order], bucket[order]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1])])[: len(owner)])
    if not len(new):
        return owner, bucket, n, low, high
    return owner[new], bucket[new], np.add.reduceat(n[order], new), np.minimum.reduceat(low[order], new), np.maximum.reduceat(high[order], new)


def _counted(df: DataFrame, columns: Sequence[str], place: Callable[[int, np.ndarray], Iterable[tuple[int, np.ndarray, np.ndarray]]]) -> DataFrame:
    """Histogram of the present values, one scan without a row per value.

    ``place`` gets a column's number and values and yields (owner, buckets, values). Each
    task sends one row per owner and bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def merged() -> tuple[np.ndarray, ...]:
            return _tally(*(np.concatenate(x) for x in zip(*held)))

        for batch in batches:
            for i, column in enumerate(batch.columns):
                v = column.drop_null().to_numpy(zero_copy_only=False) + 0.0
                for owner, buckets, values in place(i, v[~np.isnan(v)]):
                    if len(values):
                        held.append(_tally(np.full(len(values), owner, np.int64), buckets, np.ones(len(values), np.int64), values, values))
                        rows += len(held[-1][0])
            if rows > 1 << 20:
                held = [merged()]
                rows = len(held[0][0]) // 2
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["owner", "bucket", "n", "low", "high"])

    table = df.selectExpr(*[f"cast({quoted(c)} as double) as c{i}" for i, c in enumerate(columns)])
    tallies = table.mapInArrow(run, "owner long, bucket long, n long, low double, high double")
    return tallies.groupBy("owner", "bucket").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def _histogram(counted: DataFrame) -> dict[str, np.ndarray]:
    """Histogram rows as arrays, sorted by owner and lowest value."""
    table = counted.toArrow()
    rows = {name: table.column(name).to_numpy() for name in ("owner", "n", "low", "high")}
    order = np.lexsort((rows["low"], rows["owner"]))
    return {name: values[order] for name, values in rows.items()}


def _pick(rows: dict, owner: int, base: int, column: int, ranks: Iterable[int], out: ColumnRanks) -> list[_Bracket]:
    """Place ranks into the buckets of one owner; settle those that are known."""
    mine = slice(*np.searchsorted(rows["owner"], [owner, owner + 1]))
    low, high, counts = rows["low"][mine], rows["high"][mine], rows["n"][mine]
    ends = base + np.cumsum(counts)
    found: dict[int, _Bracket] = {}
    for rank in ranks:
        i = int(np.searchsorted(ends, rank, side="right"))
        if low[i] == high[i]:
            out.values[rank] = float(low[i])
        elif i in found:
            found[i].ranks.append(rank)
        else:
            n = int(counts[i])
            found[i] = _Bracket(column, float(low[i]), float(high[i]), int(ends[i]) - n, n, [rank])
    return list(found.values())


def number_sql(x: float | None) -> str:
    """A double as SQL text."""
    if x is None:
        return "cast(null as double)"
    return f"{x!r}D" if math.isfinite(x) else f"double('{x!r}')"


def _bracketed(df: DataFrame, columns: Sequence[str], brackets: list[_Bracket], parts: int | None) -> DataFrame:
    """Histogram of the values inside brackets; without parts every value is its own bucket.

    The brackets of a column do not overlap. Only columns with a bracket are read.
    """
    used = sorted({b.column for b in brackets})
    own = [[(i, b) for i, b in enumerate(brackets) if b.column == c] for c in used]
    if len(used) == 1:
        # A filter on the column itself is one that storage can use.
        v = doubles([columns[used[0]]])
        df = df.where(" or ".join(f"{v} between {number_sql(b.low)} and {number_sql(b.high)}" for b in brackets))

    def place(position: int, v: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for i, b in own[position]:
            inside = v[(v >= b.low) & (v <= b.high)]
            if parts is None:
                yield i, inside.view(np.int64), inside
            else:
                share = (inside - b.low) / (b.high - b.low)
                yield i, np.minimum(np.floor(share * parts), parts - 1).astype(np.int64), inside

    return _counted(df, [columns[c] for c in used], place)


def order_statistics(
    df: DataFrame,
    columns: Sequence[str],
    ranks: Callable[[int], Iterable[int]],
    budget: int = HISTOGRAM_ROWS,
) -> dict[str, ColumnRanks]:
    """Values at exact ranks of several columns; NULL and NaN do not count.

    ``ranks`` gets the number of values of a column and returns 0-based ranks
    in ascending value order.
    """
    columns = list(columns)
    budget = max(budget, LEAST_BUDGET)
    group = budget // LEAST_BUDGET
    if len(columns) > group:
        out = {}
        for at in range(0, len(columns), group):
            out |= order_statistics(df, columns[at : at + group], ranks, budget)
        return out
    results = {c: ColumnRanks() for c in columns}
    # A column has at most 2 * (exponents * parts / octaves + 2) + 1 buckets.
    share = budget // len(columns) - 5
    parts = max(1, min(16, share // (2 * _EXPONENTS)))
    octaves = max(1, -(-2 * _EXPONENTS // share))
    rows = _histogram(_counted(df, columns, lambda i, v: [(i, _magnitude(v, parts, octaves), v)]))
    brackets: list[_Bracket] = []
    for series, name in enumerate(columns):
        out = results[name]
        out.count = int(rows["n"][rows["owner"] == series].sum())
        if out.count:
            wanted = sorted(set(ranks(out.count)))
            brackets += _pick(rows, series, 0, series, wanted, out)
    while brackets:
        if sum(b.count for b in brackets) <= budget:
            parts = None
        else:
            parts = max(2, budget // len(brackets))
        rows = _histogram(_bracketed(df, columns, brackets, parts))
        found = np.bincount(rows["owner"], weights=rows["n"], minlength=len(brackets))
        if [b.count for b in brackets] != found.tolist():
            raise ValueError("the input changed between scans; pass a stored or staged table")
        brackets = [
            inner
            for i, b in enumerate(brackets)
            for inner in _pick(rows, i, b.below, b.column, b.ranks, results[columns[b.column]])
        ]
    return results


def nth_values(
    df: DataFrame, column: str, fractions: Sequence[float], budget: int = HISTOGRAM_ROWS
) -> tuple[int, list[float | None]]:
    """Row count and, per fraction p, the element at position ``int(n * p)``."""
    found = order_statistics(df, [column], lambda n: [int(n * p) for p in fractions], budget)[column]
    if not found.count:
        return 0, [None] * len(fractions)
    return found.count, [found.values[int(found.count * p)] for p in fractions]


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], budget: int = HISTOGRAM_ROWS
) -> dict[str, list[float | None]]:
    """Exact quantiles per column, linear between neighbouring values."""

    def neighbours(n: int) -> list[int]:
        at = [p * (n - 1) for p in probabilities]
        return [f(a) for a in at for f in (math.floor, math.ceil)]

    def between(found: ColumnRanks, p: float) -> float:
        at = p * (found.count - 1)
        low, high = found.values[math.floor(at)], found.values[math.ceil(at)]
        return low if low == high else low + (high - low) * (at - math.floor(at))

    result = order_statistics(df, columns, neighbours, budget)
    return {
        name: [between(found, p) if found.count else None for p in probabilities]
        for name, found in result.items()
    }
