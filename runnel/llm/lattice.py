"""Near-duplicate vectors by hashing to E8 lattice cells.

Unit vectors are projected to eight dimensions at random, once per table, and
decoded to the nearest point of the E8 lattice. A vector is stored under its
own cell and looks into that cell and the nearest of the 240 cells around, so a
pair meets if either looks where the other is stored. Every candidate pair is
verified by its cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.llm.graph import components
from runnel.llm.words import mix
from runnel.sources.staging import stage


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of size 1, or all of size 1/2 with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    for signs in product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            out.append(np.array(signs))
    return np.array(out)


SHORTEST = _shortest()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, then re-round the worst coordinate where the sum is odd."""
    point = np.rint(x)
    error = x - point
    odd = np.flatnonzero(point.sum(1) % 2 != 0)
    worst = np.abs(error[odd]).argmax(1)
    point[odd, worst] += np.where(error[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the better of the nearest even points and those shifted by one half."""
    a = _nearest_even(x)
    b = _nearest_even(x - 0.5) + 0.5
    closer = ((x - b) ** 2).sum(1) < ((x - a) ** 2).sum(1)
    return np.where(closer[:, None], b, a)


def cell_names(points: np.ndarray, table: int) -> np.ndarray:
    """64-bit names of lattice points; twice a point is integer."""
    twice = np.rint(points * 2).astype(np.int64).view(np.uint64)
    name = np.full(points.shape[:-1], table + 1, np.uint64)
    for k in range(8):
        name = mix(name * np.uint64(0x9E3779B97F4A7C15) + twice[..., k])
    return name.view(np.int64)


def cells(unit: np.ndarray, tables: int, probes: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(own, looked): for every vector its cell in each table, and the nearest cells around it."""
    n, dim = unit.shape
    rng = np.random.default_rng([seed, dim])
    own, looked = np.empty((n, tables), np.int64), np.empty((n, tables, probes), np.int64)
    for t in range(tables):
        x = unit @ rng.standard_normal((dim, 8)) / width
        point = nearest(x)
        near = np.argpartition(-((x - point) @ SHORTEST.T), probes, axis=1)[:, :probes]
        own[:, t] = cell_names(point, t)
        looked[:, t] = cell_names(point[:, None, :] + SHORTEST[near], t)
    return own, looked


def near_vectors(
    vectors: DataFrame, least: float = 0.98, tables: int = 8, probes: int = 16, key: str = "vec_id", vector: str = "embedding", label: str = "label", seed: int = 5
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Rows link when their labels are equal and not null, their vectors have as
    many components and a cosine (in doubles) of at least ``least``. Null or zero
    vectors, and those with null or non-finite components, link with nothing
    and stay. Equal vectors of a label are one class: they link with one another and
    share the class's links, without being expanded into pairs. Rows with equal keys
    count as vectors of their own; a null key is never a component_id unless all are
    null. An empty table gives an empty result. Cells hold about the distance of
    the least cosine, at any number of vectors; pairs that meet in no table are missed
    (measured recall is in the README).
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & finite & some, F.lit(False))
    # Adding zero makes -0.0 and 0.0 the same.
    rows = rows.withColumn("usable", usable).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    rows = rows.withColumn("c1", F.xxhash64("label", "v")).withColumn("c2", F.hash("v", "label"))
    alone = rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = rows.where("usable")
    classes = linked.groupBy("c1", "c2").agg(F.min("id").alias("low"), F.count("*").alias("m"), F.first("v").alias("v"), F.first("label").alias("label"))
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    # Projected differences at the least cosine are as long as the cells are deep.
    width = float(np.sqrt(2 * (1 - least)) * np.sqrt(8) / 0.75)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 2000):
                part = batch.slice(start, 2000)
                sizes = part.column("v").value_lengths().to_numpy(zero_copy_only=False)
                for dim in np.unique(sizes):
                    own_rows = part.filter(pa.array(sizes == dim))
                    v = own_rows.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                    v = v / np.abs(v).max(1, keepdims=True)
                    own, looked = cells(v / np.linalg.norm(v, axis=1, keepdims=True), tables, probes, width, seed)
                    salt = mix(np.array([dim], np.uint64)).view(np.int64)[0]
                    for stored, found in ((True, own ^ salt), (False, looked.reshape(len(own), -1) ^ salt)):
                        take = pa.array(np.repeat(np.arange(len(own)), found.shape[1]))
                        yield pa.RecordBatch.from_arrays(
                            [own_rows.column("class").take(take), own_rows.column("label").take(take), pa.array(found.ravel()), pa.array(np.full(found.size, stored))],
                            names=["class", "label", "cell", "stored"],
                        )

    label_type = classes.schema["label"].dataType.simpleString()
    placed = classes.select("class", "label", "v").mapInArrow(place, f"class long, label {label_type}, cell long, stored boolean")
    placed = stage(placed, "cells")
    held = placed.where("stored").select("label", "cell", F.col("class").alias("other"))
    met = placed.join(held, ["label", "cell"]).where("class != other")
    pairs = met.select(F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")).distinct()

    @F.arrow_udf("double")
    def cosine(x: pa.Array, y: pa.Array) -> pa.Array:
        sizes = x.value_lengths().to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        a, b = x.flatten().to_numpy(zero_copy_only=False), y.flatten().to_numpy(zero_copy_only=False)
        if not len(sizes):
            return pa.array([], pa.float64())
        # Scaled by the largest component, so that squares stay in range.
        a = a / np.repeat(np.maximum.reduceat(np.abs(a), bounds), sizes)
        b = b / np.repeat(np.maximum.reduceat(np.abs(b), bounds), sizes)
        dot, aa, bb = (np.add.reduceat(p, bounds) for p in (a * b, a * a, b * b))
        return pa.array(dot / np.sqrt(aa * bb))

    x = classes.select(F.col("class").alias("a"), F.col("v").alias("x"))
    y = classes.select(F.col("class").alias("b"), F.col("v").alias("y"))
    close = pairs.join(x, "a").join(y, "b").where(F.size("x") == F.size("y")).where(cosine("x", "y") >= least)
    links = stage(close.select("a", "b"), "vector-links")
    both = links.union(links.select("b", "a"))
    weights = classes.select(F.col("class").alias("b"), "m")
    more = both.join(weights, "b").groupBy(F.col("a").alias("class")).agg(F.sum("m").alias("more"))
    groups = components(links).withColumnRenamed("node", "class").withColumnRenamed("component_id", "group")
    joined = classes.select("class", "c1", "c2", "m", "low").join(more, "class", "left").join(groups, "class", "left")
    joined = joined.withColumn("group", F.coalesce("group", "class"))
    lowest = joined.groupBy("group").agg(F.min("low").alias("component_id"))
    result = joined.join(lowest, "group").select("c1", "c2", (F.col("m") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id")
    out = linked.select("id", "c1", "c2").join(result, ["c1", "c2"]).select("id", "n_links", "component_id").union(alone)
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
