"""Near duplicates by n-gram Jaccard similarity, with PartEnum signatures.

Sets that are similar enough have close sizes and few elements that only one of
them has. Sizes are divided into bands; for each band the largest difference k
of a similar pair is known. The band's hash partitions the feature domain into
n1 parts with n1 * 2 > k, so two similar sets differ by at most one element in
some part. That part is partitioned into three again, of which at least two
agree: each set has a signature for every part and every two of its three
thirds, and similar sets share one.

Signatures are compared in buckets that hold about the same number of them at
every size of the input. A task sends a signature once, whatever number of its
documents have it. Candidates are verified against a hub of each group,
never pair by pair within it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runnel.llm.graph import components
from runnel.llm.words import SLICE, SPACED, mix, release, rolling, slices, split_words
from runnel.sources.staging import free_exchanges, stage, staged

THIRDS = 3
#: Signatures in a bucket, on average.
BUCKET = 1 << 19
#: Bands with fewer parts are partitioned twice, by two hashes.
FEW_PARTS = 24
#: Bands of more than one and up to so many parts have prefix keys for the sets with an empty signature.
PREFIX_PARTS = 12
#: Elements whose signatures are made at once, unless one set has more.
RUN = 1 << 16
#: Bits of a set's parity sketch, and of the wide one of sets of more elements than that.
SKETCH = 512
WIDE = 2048
#: Comparisons of group members with others in one round, for each ROWS rows of such groups; if there are more, HUBS members
#: of each group are compared first, and GROWTH times as many in each further round.
PAIRS = 100_000_000
ROWS = 1_000_000
HUBS = 8
GROWTH = 8
#: Signatures of a class, of the largest groups, of which one stands for all that two classes share.
MEETINGS = 4


class Bands:
    """Size bands of sets for a least similarity."""

    def __init__(self, similarity: Fraction, largest: int):
        self.similarity = s = similarity
        self.low, self.high, self.differ = [1], [], []
        while True:
            low = self.low[-1]
            high = max(low, int(low / s))
            self.high.append(high)
            # A pair has at most (1 - s) / (1 + s) of its two sizes in differing elements.
            self.differ.append(int((1 - s) / (1 + s) * (high + int(high / s))))
            if high >= largest:
                break
            self.low.append(high + 1)
        self.parts = [-(-(k + 1) // 2) if k else 0 for k in self.differ]
        self.reach = np.array([int(h / s) for h in self.high])
        self.low, self.parts = np.array(self.low), np.array(self.parts)

    def instances(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, band) of every signature scheme that a set takes part in: its own, and the lower one if a similar set may be there."""
        own = np.searchsorted(self.low, sizes, "right") - 1
        lower = np.flatnonzero((own > 0) & (sizes <= self.reach[np.maximum(own - 1, 0)]))
        sets = np.concatenate([np.flatnonzero(sizes > 0), lower])
        bands = np.concatenate([own[sizes > 0], own[lower] - 1])
        keep = self.parts[bands] > 0  # with no difference allowed, similar sets are equal
        return sets[keep], bands[keep]


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct n-word shingles of every text; with fewer words, the whole as one."""
    words = split_words(texts, SPACED, lower=True)
    count = np.diff(words.first)
    doc = np.repeat(np.arange(len(count)), count)
    hashes, docs = [], []
    for k in range(1, n + 1):
        grams = rolling(words, k)
        last = np.repeat(words.first[1:], count)[: len(grams)]
        inside = np.arange(k, k + len(grams)) <= last
        inside &= (count[doc[: len(grams)]] >= n) if k == n else (count[doc[: len(grams)]] == k)
        at = np.flatnonzero(inside)
        hashes.append(grams[at])
        docs.append(doc[at])
    hashes, docs = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    hashes, docs = hashes[new], docs[new]
    return hashes, np.searchsorted(docs, np.arange(len(count) + 1))


def sets_of(part: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of a part's texts, made from slices of it, so that what is held besides the result stays small."""
    made = [shingle_sets(s.column("text"), n) for s in slices(part, "text", SLICE)]
    sizes = np.concatenate([np.zeros(0, np.int64), *(np.diff(bounds) for _, bounds in made)])
    return np.concatenate([np.zeros(0, np.uint64), *(hashes for hashes, _ in made)]), np.concatenate([[0], np.cumsum(sizes)])


def set_hashes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash for each set; equal sets have equal ones."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes))])
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def signatures(hashes: np.ndarray, bounds: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) pairs.

    Signatures that no element of the set takes part in are left out, unless there is one part only: unrelated
    sets share them. A similar pair that shares no other one has such signatures on both sides, so sets that
    have any get, in bands of few parts, a key for each of their first elements by hash; similar sets have one of these in common.
    """
    sizes = np.diff(bounds)
    out, owners = [], []
    for seed in (1, 2):
        sets, band = bands.instances(sizes)
        if seed == 2:
            few = (bands.parts[band] < FEW_PARTS) & (bands.parts[band] > 1)
            sets, band = sets[few], band[few]
        if not len(sets):
            continue
        n, parts = sizes[sets], bands.parts[band]
        begin = np.concatenate([[0], np.cumsum(parts * THIRDS)])
        element = np.arange(n.sum()) + np.repeat(bounds[sets] - (np.cumsum(n) - n), n)
        which = mix(hashes[element] + np.uint64(seed * 0xA24BAED4963EE407 % (1 << 64)))
        part = (which >> np.uint64(20)) % np.repeat(parts, n).astype(np.uint64)
        cell = np.repeat(begin[:-1], n) + (part * np.uint64(THIRDS) + which % np.uint64(THIRDS)).astype(np.int64)
        sums = np.zeros(begin[-1], np.uint64)
        np.add.at(sums, cell, mix(which))
        filled = np.bincount(cell, minlength=begin[-1]).reshape(-1, THIRDS) > 0
        sums = mix(sums).reshape(-1, THIRDS)
        owner = np.repeat(sets, parts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        label = mix((np.repeat(band, parts).astype(np.uint64) << np.uint64(34)) + (place.astype(np.uint64) << np.uint64(3)) + np.uint64(seed << 2))
        single = np.repeat(parts == 1, parts)
        if seed == 1:
            lacks = np.logical_or.reduceat((filled.sum(1) < 2) & ~single, np.cumsum(parts) - parts) & (parts <= PREFIX_PARTS)
            keys, of = _prefix_keys(hashes, bounds, sets[lacks], band[lacks], bands.similarity)
            out.append(keys)
            owners.append(of)
        for left_out in range(THIRDS):
            a, b = [t for t in range(THIRDS) if t != left_out]
            used = np.flatnonzero(filled[:, a] | filled[:, b] | single)
            made = mix(label[used] + np.uint64(left_out)) + sums[used, a] * np.uint64(3) + sums[used, b] * np.uint64(5)
            out.append(mix(made))
            owners.append(owner[used])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owners)


def _in_runs(hashes: np.ndarray, bounds: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """``signatures`` of a run of sets at a time, so that what is held besides the result stays small."""
    made, owners, i = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + RUN, "right")) - 1)
        some, owner = signatures(hashes[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], bands)
        made.append(some)
        owners.append(owner + i)
        i = j
    return np.concatenate(made), np.concatenate(owners)


def _prefix_keys(hashes: np.ndarray, bounds: np.ndarray, sets: np.ndarray, band: np.ndarray, similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(key, set): the elements of which a similar set has at least one among its own, by band.

    Similar sets share at least s * n elements of each side's n, so they cannot differ in all of the first n - s * n + 1.
    """
    n = np.diff(bounds)[sets]
    count = n - -(-n * similarity.numerator // similarity.denominator) + 1
    element = np.arange(count.sum()) + np.repeat(bounds[sets] - (np.cumsum(count) - count), count)
    label = mix((band.astype(np.uint64) << np.uint64(34)) + np.uint64(3 << 2))
    return mix(np.repeat(label, count) + hashes[element]), np.repeat(sets, count)


def parity_sketches(hashes: np.ndarray, bounds: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """``size`` bits for each set, a power of two: whether an odd number of its elements falls on the bit.

    Elements that two sets share cancel out, so the sketches differ in no more
    bits than the sets in elements. The two halves of a sketch, combined by exclusive or, are the sketch of half the size.
    """
    count = len(bounds) - 1
    owner = np.repeat(np.arange(count), np.diff(bounds))
    bit = (mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(size)).astype(np.int64)
    odd = np.bincount(owner * size + bit, minlength=count * size).reshape(count, size) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def wide_sketches(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """WIDE bits for each set of more elements than SKETCH; null for the others."""
    large = np.diff(bounds) > SKETCH
    sizes = np.where(large, np.diff(bounds), 0)
    bits = np.zeros((len(sizes), WIDE // 64), np.int64)
    element = np.repeat(large, np.diff(bounds))
    of_large = np.concatenate([[0], np.cumsum(sizes[large])])
    bits[large] = parity_sketches(hashes[element], of_large, WIDE)
    return pa.FixedSizeListArray.from_arrays(pa.array(bits.ravel()), WIDE // 64, mask=pa.array(~large)).cast(pa.list_(pa.int64()))


def long_sketches(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Sketches of sets of more than WIDE elements, of one or two bits for each element; null for the others."""
    out: list[np.ndarray | None] = [None] * (len(bounds) - 1)
    for i in np.flatnonzero(np.diff(bounds) > WIDE).tolist():
        n = int(bounds[i + 1] - bounds[i])
        out[i] = parity_sketches(hashes[bounds[i] : bounds[i + 1]], np.array([0, n]), 1 << (n - 1).bit_length())[0]
    return pa.array(out, pa.list_(pa.int64()))


_BLOB = "bucket int, local boolean, signatures binary, members binary, classes binary"


def _send(batches: Iterator[pa.RecordBatch], n: int, similarity: Fraction, buckets: int, largest: int) -> Iterator[pa.RecordBatch]:
    """Signatures of the distinct sets of each part of a batch, by bucket.

    A signature that several of the sets have goes to its bucket once; which
    sets share it is known here and sent on as it is (``local``).
    """
    release()
    bands = Bands(similarity, largest)
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, bounds = sets_of(part, n)
            classes = set_hashes(hashes, bounds).view(np.int64)
            _, once = np.unique(classes, return_index=True)
            sizes = np.diff(bounds)
            element = np.arange(sizes[once].sum()) + np.repeat(bounds[once] - (np.cumsum(sizes[once]) - sizes[once]), sizes[once])
            bounds = np.concatenate([[0], np.cumsum(sizes[once])])
            classes = classes[once]
            made, owner = _in_runs(hashes[element], bounds, bands)
            bucket = ((made >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            name = (bucket << 32) | (made & np.uint64(0xFFFFFFFF)).astype(np.int64)
            order = np.lexsort((classes[owner], name))
            name, owner = name[order], owner[order]
            new = np.ones(len(name), bool)
            new[1:] = name[1:] != name[:-1]
            shared = ~new
            shared[:-1] |= shared[1:]
            rows: dict[str, list] = {c.split(" ")[0]: [] for c in _BLOB.split(", ")}

            def row(to: int, local: bool, names: np.ndarray, members: np.ndarray) -> None:
                held, index = np.unique(members, return_inverse=True)
                rows["bucket"].append(to)
                rows["local"].append(local)
                rows["signatures"].append((names if local else names.astype(np.uint32)).tobytes())
                rows["members"].append(index.astype(np.uint32 if len(held) > 0xFFFF else np.uint16).tobytes())
                rows["classes"].append(classes[held].tobytes())

            if shared.any():
                row(int(made.sum() % np.uint64(buckets)), True, name[shared], owner[shared])
            name, owner = name[new], owner[new]
            cuts = np.searchsorted(name >> 32, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                row(int(b), False, name[cuts[b] : cuts[b + 1]], owner[cuts[b] : cuts[b + 1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["bucket"], pa.int32()), pa.array(rows["local"], pa.bool_()), *(pa.array(rows[c], pa.binary()) for c in ("signatures", "members", "classes"))], names=list(rows)
            )


def _meet(key: tuple, table: pa.Table) -> pa.Table:
    """(signature, class) of the signatures of a bucket that several classes have, and what tasks found themselves."""
    names, classes, own = [], [], []
    for local, signed, members, held in zip(*(table.column(c).to_pylist() for c in ("local", "signatures", "members", "classes"))):
        held = np.frombuffer(held, np.int64)
        count = len(signed) // (8 if local else 4)
        index = np.frombuffer(members, np.uint16 if len(members) == 2 * count else np.uint32)
        values = np.frombuffer(signed, np.int64) if local else np.frombuffer(signed, np.uint32).astype(np.int64) | (key[0].as_py() << 32)
        names.append(values)
        classes.append(held[index])
        own.append(np.full(count, local))
    names, classes, own = map(np.concatenate, (names, classes, own))
    given = pa.table({"signature": names[own], "class": classes[own]})
    names, classes = names[~own], classes[~own]
    order = np.lexsort((classes, names))
    names, classes = names[order], classes[order]
    same = names[1:] == names[:-1]
    new = np.ones(len(names), bool)
    new[1:] = ~same | (classes[1:] != classes[:-1])
    names, classes = names[new], classes[new]
    shared = np.zeros(len(names), bool)
    same = names[1:] == names[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    return pa.concat_tables([given, pa.table({"signature": names[shared], "class": classes[shared]})])


def sketch_tests(percent: int) -> tuple[Column, Column]:
    """Whether sets of na and nb elements may be similar, by their sketches x and y, and by the wide ones wx and wy.

    A lower bound of the elements in one set only, against what a similar pair may have. Of long sets the short sketch says little.
    Written out word by word, so that a join compiles it and makes no object for a pair.
    """
    within = f"* {100 + percent} <= {100 - percent} * (na + nb)"
    apart, wider = (" + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(size // 64)) for a, b, size in (("x", "y", SKETCH), ("wx", "wy", WIDE)))
    return F.expr(f"({apart}) {within}"), F.expr(f"wx is null or wy is null or ({wider}) {within}")


def passed(rows: DataFrame, test: Column) -> DataFrame:
    """The rows that pass ``test``, which stays out of the join below them.

    Spark would put it into the join's loop. Java does not compile a method of over 8,000 bytes, and interprets it at every pair.
    """
    return rows.select(F.inline(F.array(F.struct(*rows.columns)))).where(test)


def across(x: DataFrame, y: DataFrame, test: Column, further: Column) -> DataFrame:
    """(a, b) of the rows of x and y that share a signature, not a component, and pass ``test`` and ``further``.

    Two classes with meetings in common are compared under the least of these only, others under every signature they share.
    """
    once = F.coalesce(F.array_min(F.array_intersect("ma", "mb")), "signature") == F.col("signature")
    pairs = x.join(y, (F.col("signature") == F.col("s")) & (F.col("component") != F.col("own")) & test)
    return passed(pairs, further & once).select("a", "b")


def similar_groups(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Two rows link when 100 * shared shingles >= percent * all their shingles;
    a shingle is ``words`` words (A-Z lower-cased, split at ASCII white space), a
    shorter text is one shingle. component_id is the smallest key reachable by links.
    Texts without words (null, empty, white space) have no shingles and link with
    nothing. Null keys are linked like others and are never a component_id, unless
    a group has no other. Rows with equal keys are linked each by its own text.
    An empty table gives an empty result. Shingles and sets are compared by 64-bit hashes.
    Signatures in which a set has no element are left out in bands of several parts, since
    unrelated sets share them. Up to PREFIX_PARTS parts, prefix keys make up for them and every similar pair
    meets. Beyond, a pair is missed if each part in which it differs at most once shows nothing
    it shares, at a chance under 1e-12 (README).
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    similarity = Fraction(percent, 100)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(key, text).alias("k1"), F.hash(text, key).alias("k2"))
    id_type = docs.schema[key].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                hashes, bounds = shingle_sets(part.column("text"), words)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("k1"), part.column("k2"), pa.array(np.diff(bounds)), pa.array(set_hashes(hashes, bounds).view(np.int64))], names=["id", "k1", "k2", "n", "class"]
                )

    digests = stage(rows.mapInArrow(digest, f"id {id_type}, k1 long, k2 int, n long, class long"), "digests")
    total, largest = digests.agg(F.sum("n"), F.max("n")).first()
    empty = digests.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    if not total:
        return empty.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")
    bands = Bands(similarity, largest)
    rate = max((2 * THIRDS * p / low for p, low in zip(bands.parts, bands.low)), default=1.0)
    buckets = max(n, int(total * rate / 2 / BUCKET) + 1)
    blobs = rows.select("text").mapInArrow(lambda b: _send(b, words, similarity, buckets, largest), _BLOB)
    met = blobs.repartition(min(buckets, 4 * n), "bucket").groupBy("bucket").applyInArrow(_meet, "signature long, class long")
    used = ExitStack()  # stored tables that the result does not refer to
    members = used.enter_context(staged(met.distinct(), "members"))
    free_exchanges(spark)

    # The sets of the classes that share a signature, from one row of each class.
    wanted = members.select("class").distinct()
    chosen = digests.join(wanted, "class").groupBy("class").agg(F.min(F.struct("k1", "k2", "n")).alias("r")).select("class", "r.*")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        seen: set[int] = set()  # equal rows are in one partition
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                fresh = [c not in seen and not seen.add(c) for c in part.column("class").to_pylist()]
                part = part.filter(pa.array(fresh, pa.bool_()))
                hashes, bounds = shingle_sets(part.column("text"), words)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
                bits = pa.FixedSizeListArray.from_arrays(pa.array(parity_sketches(hashes, bounds).ravel()), SKETCH // 64).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("class"), pa.array(np.diff(bounds)), lists, bits, wide_sketches(hashes, bounds), long_sketches(hashes, bounds)], names=["class", "n", "shingles", "sketch", "wide", "long"])

    texts = rows.select("k1", "k2", "text").repartition(n, "k1", "k2").join(chosen, ["k1", "k2"])
    held = used.enter_context(staged(texts.select("class", "text").mapInArrow(sets, "class long, n long, shingles array<long>, sketch array<long>, wide array<long>, long array<long>"), "sets"))
    free_exchanges(spark)
    sketches = held.select("class", "n", "sketch", "wide", "long")
    possible, wide = sketch_tests(percent)
    # The few sets beyond have sketches as long as they are; the longer of two is folded to the shorter one's size.
    shorter = "least(size(lx), size(ly))"
    folded = {w: f"aggregate(sequence(i, size({w}) - 1, {shorter}), 0L, (a, j) -> a ^ {w}[j])" for w in ("lx", "ly")}
    longer = F.expr(f"aggregate(sequence(0, {shorter} - 1), 0, (s, i) -> s + bit_count({folded['lx']} ^ {folded['ly']})) * {100 + percent} <= {100 - percent} * (na + nb)")

    def verified(pairs: DataFrame) -> DataFrame:
        a = held.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
        b = held.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
        size = F.size("x") + F.size("y")
        both = F.size(F.array_intersect("x", "y"))
        return pairs.join(b, "b").join(a, "a").where(both * 100 >= F.lit(percent) * (size - both)).select("a", "b")

    # A hub is the member that meets the most others under all its signatures: of copies of one text one changed
    # little, which most of the group are similar to. Any member would do, but most leave more to compare below.
    sizes = members.groupBy("signature").agg(F.count("*").alias("size"))
    largest_groups = F.slice(F.sort_array(F.collect_list(F.struct("size", "signature")), asc=False), 1, MEETINGS).getField("signature")
    met = used.enter_context(staged(members.join(sizes, "signature").groupBy("class").agg(F.sum("size").alias("others"), largest_groups.alias("meetings")), "met"))
    free_exchanges(spark)
    first = F.min(F.struct(-F.col("others"), "class")).getField("class")
    hub = members.join(met, "class").groupBy("signature").agg(first.alias("a"))
    pairs = members.join(hub, "signature").where("class != a").select("a", F.col("class").alias("b")).distinct()
    pairs = pairs.join(sketches.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"), F.col("wide").alias("wx")), "a")
    pairs = pairs.join(sketches.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"), F.col("wide").alias("wy")), "b").where(possible)
    links = stage(verified(passed(pairs, wide).select("a", "b")), "links")
    # The lists are made once, so that the signature of a pair is the same in all rounds.
    sketches = sketches.join(met.select("class", "meetings"), "class")
    done = spark.createDataFrame([], "signature long, class long")
    whole, each = False, HUBS
    groups = stage(components(links), "components")
    while not whole:
        free_exchanges(spark)
        # Signatures whose classes are not all in one component; the component with most of them is their rest,
        # and every other member is compared with all of other components.
        joined = members.join(groups.withColumnRenamed("node", "class"), "class", "left").select("signature", "class", F.coalesce("component_id", "class").alias("component"))
        torn = joined.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low != high")
        with staged(joined.join(torn.select("signature", "size"), "signature").join(sketches, "class"), "torn") as torn:
            sizes = torn.groupBy("signature", "component").agg(F.count("*").alias("m"))
            rest = sizes.groupBy("signature").agg(F.max(F.struct("m", "component")).getField("component").alias("rest"))
            hubs = torn.join(rest, "signature").where("component != rest").join(done, ["signature", "class"], "left_anti")
            asked, most = hubs.agg(F.count("*"), F.sum("size")).first()
            if not asked:
                break
            whole = most <= PAIRS * max(1, torn.count() // ROWS)
            if not whole:
                order = Window.partitionBy("signature").orderBy("class")
                hubs = stage(hubs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= each), "hubs")
                done = stage(done.union(hubs.select("signature", "class")), "done")
                each *= GROWTH
            pairs = None
            # A similar pair is under WIDE on one side and at most a little over it on the other, or over it on both.
            for chosen, held_as, test, further in (
                (F.col("n") <= WIDE * 100 // percent, (("sketch", ("x", "y")), ("wide", ("wx", "wy"))), (F.least("na", "nb") <= WIDE) & possible, wide),
                (F.col("n") > WIDE, (("long", ("lx", "ly")),), longer, F.lit(True)),
            ):
                x = hubs.where(chosen).select("signature", F.col("component").alias("own"), F.col("class").alias("a"), F.col("n").alias("na"), F.col("meetings").alias("ma"), *(F.col(c).alias(n[0]) for c, n in held_as))
                y = torn.where(chosen).select(F.col("signature").alias("s"), "component", F.col("class").alias("b"), F.col("n").alias("nb"), F.col("meetings").alias("mb"), *(F.col(c).alias(n[1]) for c, n in held_as))
                found = across(x, y, test, further)
                pairs = found if pairs is None else pairs.union(found)
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            links = stage(links.union(verified(pairs)), "links")
            groups = stage(components(links), "components")
    used.close()
    free_exchanges(spark)
    classes = digests.where("n > 0").join(groups.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component_id", "class"))
    lowest = classes.groupBy("component").agg(F.min("id").alias("component_id"))
    out = classes.drop("component_id").join(lowest, "component").select("id", "n", "component_id").union(empty)
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")
