"""Hard negatives by a GNAT-style tree: multiway hyperplane splits with distance ranges.

Rows are dealt to blocks, and every group of anchors meets every block in a
task of its own. A block is a tree: a node has several split points, a row
belongs to the nearest of them (so hyperplanes part the children), and each split
point keeps the least and largest distance to every child's rows. A query wants
the rows whose inner product lies in a window. One more coordinate gives all
rows of the block the same length, so the window is an annulus around the query.
Whatever split point a query is compared with, a child goes if the distances
that the annulus allows from that point miss the child's range. What is left is scored
exactly, in integers, at the leaves. Blocks give their best rows, a window
function ranks them, and Spark trims each task's rows before it shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runnel.sources.staging import stage

#: Rows of a leaf, children of a node.
LEAF = 96
CHILDREN = 12
#: Rows of a block and anchors of a group, on average.
BLOCK = 16_384
GROUP = 4_096
#: Numbers in a block; blocks of longer vectors have fewer rows. Rows of the smallest block, if cores would idle.
NUMBERS = 1 << 23
SMALL = 2_048
#: Found rows kept before those that can no longer be among the best are dropped; scores computed at once.
HELD = 1 << 20
CELLS = 1 << 22
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of whole-numbered rows; those beyond a long become its end."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if most < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.array([[int(x) for x in row] for row in a], object).reshape(a.shape) @ np.array([[int(x) for x in row] for row in b], object).reshape(b.shape).T
    return np.clip(whole, _LOW, _HIGH).astype(np.int64)


class Gnat:
    """The tree of one block. A node is (split points, least, largest distance of point i to the rows of child j, children), a leaf its rows."""

    def __init__(self, rows: np.ndarray, seed: int = 0):
        self.rows = rows
        with np.errstate(over="ignore"):
            squares = (rows * rows).sum(1)
        #: Square of the rows' common length after the added coordinate.
        self.reach = float(squares.max(initial=0.0))
        #: What rounding may add to a distance.
        self.slack = 3e-6 * (1.0 + np.sqrt(self.reach))
        everything = np.arange(len(rows))
        if self.reach < 2.0**100:
            self.lift = np.sqrt(np.maximum(self.reach - squares, 0.0))
            self.rng = np.random.default_rng(seed)
            self.root = self._node(everything)
        else:
            self.root = everything  # distances would leave the range of doubles

    def _distances(self, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        dots = self.rows[rows] @ self.rows[points].T + self.lift[rows, None] * self.lift[points]
        return np.sqrt(np.maximum(2 * self.reach - 2 * dots, 0.0))

    def _split_points(self, rows: np.ndarray) -> np.ndarray:
        """Rows far from one another: each next one is the furthest, in a sample, from those before."""
        sample = self.rng.choice(rows, min(len(rows), 3 * CHILDREN), replace=False)
        points = [sample[0]]
        away = self._distances(np.array(points), sample)[:, 0]
        while len(points) < CHILDREN and away.max() > self.slack:
            points.append(sample[away.argmax()])
            away = np.minimum(away, self._distances(np.array(points[-1:]), sample)[:, 0])
        return np.array(points)

    def _node(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        points = self._split_points(rows)
        away = self._distances(points, rows)
        own = away.argmin(1)
        parts = [np.flatnonzero(own == j) for j in range(len(points))]
        if max(map(len, parts)) > 0.9 * len(rows):
            return rows  # mostly copies, which no split point parts: a leaf of any size is exact
        low = np.stack([away[part].min(0) for part in parts], 1)
        high = np.stack([away[part].max(0) for part in parts], 1)
        return points, low, high, [self._node(rows[part]) for part in parts]


@dataclass
class Search:
    """The first ``k`` rows of each query's window in one block, by falling score and rising key.

    A query belongs to an anchor; only rows whose label is (``same``) or is not that of
    the anchor count, and none of the anchor's own key.
    """

    tree: Gnat
    keys: np.ndarray
    labels: np.ndarray
    anchors: np.ndarray
    anchor_keys: np.ndarray
    anchor_labels: np.ndarray
    #: Of the queries: their anchors, and their least and largest scores.
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    k: int
    same: bool

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the found rows."""
        self.low = self.low.copy()
        self.best = np.full((len(self.anchor), self.k), _LOW, np.int64)
        self.held, self.n_held, self.scored = [], 0, 0
        with np.errstate(over="ignore"):
            self.norms = (self.anchors * self.anchors).sum(1)
        queries = np.flatnonzero(self.low <= self.high)
        if len(queries) and len(self.keys):
            self._first(self.tree.root, queries)
            self._visit(self.tree.root, queries)
        self._trim()
        return tuple(self.held[0])

    def _away(self, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of queries to split points; a query's added coordinate is 0."""
        used, back = np.unique(self.anchor[queries], return_inverse=True)
        dots = self.anchors[used] @ self.tree.rows[points].T
        return np.sqrt(np.maximum(self.norms[used, None] + self.tree.reach - 2 * dots, 0.0))[back]

    def _first(self, node, queries: np.ndarray) -> None:
        """Raise the queries' least scores by the leaf around them, so that the visit starts with narrow windows."""
        if isinstance(node, np.ndarray):
            self._leaf(node, queries, keep=False)
            return
        near = self._away(queries, node[0]).argmin(1)
        for j in np.unique(near):
            self._first(node[3][j], queries[near == j])

    def _visit(self, node, queries: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            self._leaf(node, queries, keep=True)
            return
        points, low, high, children = node
        away = self._away(queries, points)
        norm = self.norms[self.anchor[queries]] + self.tree.reach
        slack = self.tree.slack + 3e-6 * np.sqrt(norm)
        inner = np.sqrt(np.maximum(norm - 2.0 * self.high[queries], 0.0)) - slack
        for j, child in enumerate(children):
            # The window as it is by now: leaves of earlier children may have raised its lower end.
            outer = np.sqrt(np.maximum(norm - 2.0 * self.low[queries], 0.0)) + slack
            least = np.maximum(away - outer[:, None], inner[:, None] - away)
            meets = ((least <= high[:, j]) & (away + outer[:, None] >= low[:, j])).all(1)
            if meets.any():
                self._visit(child, queries[meets])

    def _leaf(self, rows: np.ndarray, queries: np.ndarray, keep: bool) -> None:
        step = max(1, CELLS // max(1, len(rows)))
        for at in range(0, len(queries), step):
            self._score(rows, queries[at : at + step], keep)

    def _score(self, rows: np.ndarray, queries: np.ndarray, keep: bool) -> None:
        used, back = np.unique(self.anchor[queries], return_inverse=True)
        scores = products(self.anchors[used], self.tree.rows[rows])
        self.scored += scores.size
        fits = (self.labels[rows] == self.anchor_labels[used, None]) == self.same
        fits &= self.keys[rows] != self.anchor_keys[used, None]
        scores, fits = scores[back], fits[back]
        fits &= (scores >= self.low[queries, None]) & (scores <= self.high[queries, None])
        some = np.flatnonzero(fits.any(1))
        if not len(some):
            return
        queries, scores, fits = queries[some], scores[some], fits[some]
        own = np.where(fits, scores, _LOW)
        # Rows of the first descent are met again by the visit, so only their bound is kept.
        top = np.concatenate([self.best[queries], own], 1) if keep else np.concatenate([np.full((len(own), self.k), _LOW), own], 1)
        top = np.partition(top, top.shape[1] - self.k, axis=1)[:, top.shape[1] - self.k :]
        self.low[queries] = np.maximum(self.low[queries], top.min(1))
        if keep:
            self.best[queries] = top
            q, r = np.nonzero(fits & (scores >= self.low[queries, None]))
            self.held.append(np.stack([queries[q], rows[r], scores[q, r]]))
            self.n_held += len(q)
            if self.n_held > HELD:
                self._trim()

    def _trim(self) -> None:
        """Keep the first k rows of every query."""
        q, r, s = np.concatenate([np.zeros((3, 0), np.int64), *self.held], axis=1)
        # Falling scores by complement: the negative of the least long is itself.
        order = np.lexsort((self.keys[r], ~s, q))
        q, r, s = q[order], r[order], s[order]
        begin = np.searchsorted(q, q, "left")
        kept = np.arange(len(q)) - begin < self.k
        self.held = [np.stack([q[kept], r[kept], s[kept]])]
        # What stays is bounded by the queries; count from there.
        self.n_held = 0


def whole_numbers(vectors: pa.Array, dim: int, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, as doubles; what leaves the range of doubles stays at its end."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), dim)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -1.7e308, 1.7e308)


def _searched(rows: pa.Table, anchors: pa.Table, scale: float, k: int, same: bool) -> Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]:
    """(anchor, window's score, key, score) found in one block for one group of anchors; vectors of unlike lengths are not compared."""
    rows, anchors = rows.combine_chunks(), anchors.combine_chunks()
    for dim in np.unique(pc.list_value_length(anchors["v"]).to_numpy()):
        mine, asking = (t.filter(pc.equal(pc.list_value_length(t["v"]), int(dim))) for t in (rows, anchors))
        if not len(mine):
            continue
        owner, base, low, high = [], [], [], []
        for i, windows in enumerate(asking["windows"].to_pylist()):
            for w in windows:
                owner.append(i), base.append(w["score"]), low.append(w["low"]), high.append(w["high"])
        codes = pa.chunked_array([*asking["label"].chunks, *mine["label"].chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
        search = Search(
            Gnat(whole_numbers(mine["v"].combine_chunks(), dim, scale)), mine["key"].to_numpy(), codes[len(asking) :],
            whole_numbers(asking["v"].combine_chunks(), dim, scale), asking["key"].to_numpy(), codes[: len(asking)],
            np.array(owner, np.int64), np.array(low, np.int64), np.array(high, np.int64), k, same,
        )
        q, r, s = search.run()
        yield asking["a"].take(pa.array(search.anchor[q])), pa.array(np.array(base, np.int64)[q]), mine["key"].take(pa.array(r)), pa.array(s)


def _best(rows: DataFrame, anchors: DataFrame, blocks: int, groups: int, scale: float, k: int, same: bool) -> DataFrame:
    """(a, base, key, score, rank): the first k rows of every window over all blocks."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = list(_searched(left, right, scale, k, same)) if len(left) and len(right) else []
        empty = pa.table({n: pa.array([], pa.int64()) for n in ("a", "base", "key", "score")})
        tables = [pa.table([pa.chunked_array([c]) if isinstance(c, pa.Array) else c for c in part], names=empty.column_names).cast(empty.schema) for part in parts]
        return pa.concat_tables([empty, *tables])

    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    dealt = rows.select("block", every_group, "key", "label", "v")
    asked = anchors.select(every_block, F.col("group").alias("group"), F.col("a").alias("a"), *(F.col(c).alias(c) for c in ("key", "label", "v", "windows")))
    found = dealt.groupBy("block", "group").cogroup(asked.groupBy("block", "group")).applyInArrow(meet, "a long, base long, key long, score long")
    order = Window.partitionBy("a", "base").orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least_percent: int = 30, most_percent: int = 90,
    scale: float = 256.0, key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x); a score is the inner product with the anchor.
    An anchor's positives are its first rows of the same label, by falling score and
    rising key, its own key left out. For each positive the first
    rows of other labels follow whose score is between the two percentages of the positive's score, both included.
    Rows without key or label, and those whose vector is null or has null or
    non-finite components, take no part; vectors of unlike lengths are not compared.
    Repeated rows are rows of their own, but an anchor that repeats key, label and vector
    asks once. Ties of score and key have equal results. Scores beyond a long are
    taken as its end. An empty table, and one without anchors, gives an empty result. Keys must be whole numbers.
    """
    spark = vectors.sparkSession
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = usable.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), F.col(vector).alias("v"), is_anchor.alias("asks"))
    total, asking, longest = rows.agg(F.count("*"), F.count_if("asks"), F.max(F.size("v"))).first()
    size = max(SMALL, min(BLOCK, NUMBERS // max(1, longest or 1)))
    cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, groups = max(1, -(-total // size), min(cores, total // SMALL)), max(1, -(-asking // GROUP))
    named = F.xxhash64("key", "label", "v")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int"))
    anchors = rows.where("asks").select(named.alias("a"), "key", "label", "v").dropDuplicates(["a"])
    anchors = anchors.withColumn("group", F.pmod(F.xxhash64("a", F.lit(2)), F.lit(groups)).cast("int"))

    whole = F.array(F.struct(F.lit(0).cast("long").alias("score"), F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high")))
    first = _best(rows, anchors.withColumn("windows", whole), blocks, groups, scale, positives, True)
    first = stage(first.select("a", F.col("key").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # The window of each score that a positive has; exact also where the products leave a long.
    score = F.col("positive_score").cast("decimal(19,0)")
    low = F.ceil(score * least_percent / 100).cast("long").alias("low")
    high = F.floor(score * most_percent / 100).cast("long").alias("high")
    windows = first.select("a", F.col("positive_score").alias("score"), low, high).distinct()
    windows = windows.groupBy("a").agg(F.collect_list(F.struct("score", "low", "high")).alias("windows"))
    found = _best(rows, anchors.join(windows, "a"), blocks, groups, scale, negatives, False)
    found = found.select("a", F.col("base").alias("positive_score"), "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
    named = first.join(anchors.select("a", F.col("key").alias("anchor_id")), "a")
    return named.join(found, ["a", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
