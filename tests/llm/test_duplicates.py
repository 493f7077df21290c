"""Substring removal, near duplicates and near vectors against brute force."""

import random
import re
from collections import Counter
from fractions import Fraction
from itertools import product
from pathlib import Path

import numpy as np
import pytest
from odd import documents, empty
from pyspark.sql import functions as F

from runnel.llm import lattice, partenum
from runnel.llm.lattice import SHORTEST, near_vectors, nearest
from runnel.llm.partenum import similar_groups
from runnel.llm.substrings import remove_repeats
from runnel.llm.words import mix
from runnel.sources.staging import shared_folder


def spaced(text, lower=False):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def passages(seed=9):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "A.B,"]
    shared = [" ".join(rng.choice(vocabulary, 30)) for _ in range(4)]
    texts = []
    for i in range(60):
        parts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 40))))]
        if i % 3:
            parts += [shared[i % 4], " ".join(rng.choice(vocabulary, 5)), shared[(i + 1) % 4] if i % 2 else ""]
        texts.append("  ".join(parts))
    return texts + [texts[3], texts[3] + " end", "w1 " * 50, "w1 " * 35]


def test_repeats_equal_brute_force(spark):
    window = 12
    docs = documents(spark, passages())
    rows = docs.select("doc_id", "text").collect()
    first = {}
    for r in rows:
        w = spaced(r["text"])
        for i in range(len(w) - window + 1):
            if r["doc_id"] is not None:
                first[tuple(w[i : i + window])] = min(r["doc_id"], first.get(tuple(w[i : i + window]), r["doc_id"]))
    want = []
    for r in rows:
        w, gone = spaced(r["text"]), set()
        for i in range(len(w) - window + 1):
            if r["doc_id"] is not None and first[tuple(w[i : i + window])] < r["doc_id"]:
                gone.update(range(i, i + window))
        want.append((r["doc_id"], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    got = remove_repeats(docs, window=window, gram=4, carry=["id", "carry", "k1"], partitions=3)
    assert got.columns == ["doc_id", "n_words", "n_removed", "text", "id", "carry", "k1"]
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got.collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(n for _, _, n, _ in want) > 500
    assert remove_repeats(empty(spark)).collect() == []


def groups(rows, n, percent):
    """Component per row by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = spaced(text, lower=True)
        sets.append({tuple(w[i : i + n]) for i in range(max(0, len(w) - n) + 1)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    lowest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            lowest[find(i)] = min(key, lowest.get(find(i), key))
    return sorted(((key, len(s), lowest.get(find(i))) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=str)


def near_copies(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"Word{i}" for i in range(200)]
    texts = []
    for size in (6, 9, 14, 20, 35, 60, 120, 400):
        base = list(rng.choice(vocabulary, size))
        for _ in range(14):
            copy = list(base)
            for _ in range(int(rng.integers(0, max(2, size // 20) + 1))):
                copy[int(rng.integers(0, len(copy)))] = str(rng.choice(vocabulary))
            if rng.random() < 0.3:
                copy = copy[: int(len(copy) * rng.uniform(0.9, 1))]
            texts.append(" ".join(copy))
    common = " ".join(vocabulary[:25])
    return texts + [common + " " + " ".join(rng.choice(vocabulary, 12)) for _ in range(40)]


@pytest.mark.parametrize("words, percent, pairs", [(3, 90, 100_000_000), (5, 80, 100_000_000), (3, 90, 5), (2, 60, 100_000_000)])
def test_groups_equal_brute_force(spark, monkeypatch, words, percent, pairs):
    monkeypatch.setattr(partenum, "PAIRS", pairs)
    monkeypatch.setattr(partenum, "BUCKET", 1 << 10)
    docs = documents(spark, near_copies(words))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = groups(rows, words, percent)
    got = sorted((tuple(r) for r in similar_groups(docs, words, percent, partitions=3).collect()), key=str)
    assert got == want
    assert len({w[2] for w in want}) < len(want) - 20


def test_groups_of_nothing(spark):
    assert similar_groups(empty(spark)).collect() == []
    blank = documents(spark).where("trim(coalesce(text, '')) = ''").where("doc_id < 4")
    assert {(r["n_shingles"], r["doc_id"] == r["component_id"]) for r in similar_groups(blank).collect()} <= {(0, True)}


def test_bands_hold_every_similar_pair():
    from fractions import Fraction

    for percent in (60, 80, 90):
        bands = partenum.Bands(Fraction(percent, 100), 3000)
        for a in [*range(1, 200), 777, 1500]:
            for b in range(a, min(3000, a * 100 // percent) + 1, max(1, a // 37)):
                # The largest difference of a similar pair of these sizes.
                most = int((a + b) * Fraction(100 - percent, 100 + percent))
                own = [set(zip(*bands.instances(np.array([n])))) for n in (a, b)]
                shared = {int(x[1]) for x in own[0]} & {int(x[1]) for x in own[1]}
                assert a == b and most == 0 or any(2 * bands.parts[i] > most for i in shared) or most == 0


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 400, 150).astype(np.uint64)) for _ in range(30)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    made = partenum.parity_sketches(np.concatenate(sets), bounds)
    for i, j in product(range(30), repeat=2):
        apart = sum(int(x).bit_count() for x in (made[i] ^ made[j]).view(np.uint64))
        assert apart <= len(set(sets[i].tolist()) ^ set(sets[j].tolist()))


def test_nearest_lattice_points():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)) * 2
    point = nearest(x)
    twice = np.rint(point * 2).astype(int)
    assert np.allclose(point * 2, twice) and (point.sum(1) % 2 == 0).all() and ((twice % 2).min(1) == (twice % 2).max(1)).all()
    # No neighbour is closer, and none of a wide cube of lattice points is for some.
    around = point[:, None, :] + SHORTEST
    assert (((x - point) ** 2).sum(1)[:, None] <= ((x[:, None, :] - around) ** 2).sum(2) + 1e-9).all()
    assert len(SHORTEST) == 240 and np.allclose((SHORTEST**2).sum(1), 2)


def vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(60, 64))
    rows = []
    for i, v in enumerate(base):
        for k in range(1 + i % 6):
            noise = rng.normal(size=64) * np.linalg.norm(v) / 8 * rng.uniform(0, 0.25)
            rows.append((len(rows), [float(x) for x in v + (noise if k else 0)], int(i % 3)))
    rows += [(900 + i, rows[5][1], rows[5][2]) for i in range(30)]
    rows += [(1000, None, 1), (1001, [0.0] * 64, 1), (1002, [float("nan")] + [1.0] * 63, 1), (1003, [None] + [1.0] * 63, 1)]
    rows += [(1004, rows[5][1], None), (1005, [float("inf")] * 64, 1), (1006, [1.0, 2.0], 1), (1007, [2.0, 4.0], 1), (1008, [], 1), (1009, rows[5][1], 2)]
    rows += [(1007, [2.0, 4.0], 1), (1010, [1e300, 2e300], 1), (1011, [-0.0, 1.0], 1), (1012, [0.0, 1.0], 1)]
    return spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, label int, id string")


def test_vectors_equal_brute_force(spark):
    df = vectors(spark)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    usable = [v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    parent, links = list(range(len(rows))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if usable[i] and usable[j] and la == lb and len(a) == len(b):
                x, y = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    lowest = {}
    for i, r in enumerate(rows):
        lowest[find(i)] = min(r[0], lowest.get(find(i), r[0]))
    want = sorted((r[0], links[i], lowest[find(i)], lowest[find(i)] == r[0]) for i, r in enumerate(rows))
    assert sorted(tuple(r) for r in near_vectors(df).collect()) == want and sum(links.values()) > 900
    assert near_vectors(df.limit(0)).collect() == []


def test_recall_at_the_least_cosine(spark):
    rng = np.random.default_rng(12)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (b * a).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cosine = 0.9801
    pair = cosine * a + np.sqrt(1 - cosine**2) * b
    rows = [(2 * i, x.tolist(), 0) for i, x in enumerate(a)] + [(2 * i + 1, x.tolist(), 0) for i, x in enumerate(pair)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert near_vectors(df).agg(F.sum("n_links")).first()[0] / 6000 >= 0.9
    assert lattice.cells(a[:2], 8, 16, 0.7, 5)[1].shape == (2, 8, 16)


@pytest.mark.parametrize("percent, shared, a, b", [(80, 12, 1, 2), (80, 12, 0, 3), (80, 8, 1, 1), (80, 16, 2, 2), (90, 9, 0, 1), (90, 18, 1, 1)])
def test_no_small_pair_is_lost(percent, shared, a, b):
    """400,000 pairs at exactly the least similarity share a signature or a prefix key each."""
    rng, n = np.random.default_rng(percent + shared), 50_000
    bands = partenum.Bands(Fraction(percent, 100), 1000)
    for _ in range(8):
        h = rng.integers(0, 1 << 63, (n, shared + a + b)).astype(np.uint64)
        sides = [np.sort(h[:, : shared + a], 1), np.sort(np.concatenate([h[:, :shared], h[:, shared + a :]], 1), 1)]
        named = []
        for side in sides:
            made, owner = partenum.signatures(side.ravel(), np.arange(n + 1) * side.shape[1], bands)
            named.append((mix(made + mix(owner.astype(np.uint64))), owner))
        at = np.flatnonzero(np.isin(named[0][0], named[1][0]))
        assert len(np.unique(named[0][1][at])) == n


def test_wide_sketches_bound_the_difference_and_tell_long_sets_apart():
    rng = np.random.default_rng(3)
    for n, m, shared in ((600, 600, 0), (1300, 1300, 0), (1300, 1100, 1050), (3000, 2900, 2800), (4000, 3600, 0)):
        common = rng.integers(0, 1 << 63, shared).astype(np.uint64)
        x, y = (np.concatenate([common, rng.integers(0, 1 << 63, k - shared).astype(np.uint64)]) for k in (n, m))
        wx, none, wy = (None if w is None else np.array(w) for w in partenum.wide_sketches(np.concatenate([x, x[:512], y]), np.array([0, n, n + 512, n + 512 + m])).to_pylist())
        differ = int(np.bitwise_count((wx ^ wy).view(np.uint64)).sum())
        assert none is None and differ <= n + m - 2 * shared
        assert (differ * 180 <= 20 * (n + m)) == (shared > 0)
        lx, ly = (np.array(w) if w else None for w in partenum.long_sketches(np.concatenate([x, y]), np.array([0, n, n + m])).to_pylist())
        assert (lx is None) == (n <= partenum.WIDE) and (ly is None) == (m <= partenum.WIDE)
        if lx is not None and ly is not None:
            while len(lx) != len(ly):
                lx, ly = (w if len(w) == min(len(lx), len(ly)) else w[: len(w) // 2] ^ w[len(w) // 2 :] for w in (lx, ly))
            differ = int(np.bitwise_count((lx ^ ly).view(np.uint64)).sum())
            assert differ <= n + m - 2 * shared and (differ * 180 <= 20 * (n + m)) == (shared > 0)


def test_long_texts_that_share_a_passage(spark):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]

    def text(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    texts = [" ".join(text(rng.randrange(1200, 1600)) + passage) for _ in range(25)]
    texts += [" ".join(text(rng.randrange(3900, 4300)) + passage) for _ in range(12)]
    # Around the limit, also where one side is over WIDE and where the sizes of long sketches differ.
    for n in (1500, 2040, 4100):
        base = text(n)
        for k in (0, 10, 30, 50):
            copy = list(base)
            for _ in range(k * n // 1500):
                copy[rng.randrange(n)] = "x"
            texts.append(" ".join(copy[k % 3 * n // 60 :] + passage))
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for words_, percent in ((5, 80), (3, 90)):
        got = sorted(map(tuple, partenum.similar_groups(df, words=words_, percent=percent).collect()))
        assert got == sorted(groups(rows, words_, percent))


def test_repeats_in_many_equal_rows(spark):
    rng = np.random.default_rng(4)
    text = " ".join(f"w{x}" for x in rng.integers(0, 10**6, 400))
    rows = spark.range(20_000).select(F.when(F.col("id") < 19_000, 5).when(F.col("id") < 19_990, F.lit(None)).otherwise(F.col("id")).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    got = remove_repeats(rows).groupBy("doc_id", "n_removed", F.length("text").alias("n")).count().collect()
    # Null keys remove nothing and lose nothing; the others lose all to the smallest key.
    want = [(5, 0, len(text), 19_000), (None, 0, len(text), 990)] + [(i, 400, 0, 1) for i in range(19_990, 20_000)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_repeats_keep_no_windows_beside_the_texts(spark):
    """Windows and texts are sent in jobs of their own, and what a job stored for the next is deleted."""
    folder = Path(shared_folder(spark)) / "runnel"
    before = set(folder.glob("*"))
    got = remove_repeats(documents(spark, passages()), window=12, gram=4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "hashpartitioning(h#" not in plan
    assert [p.name.split("-")[0] for p in set(folder.glob("*")) - before] == ["covered"]
    assert got.where("n_removed > 0").count() > 10


def test_near_copies_of_one_text_meet_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 10_000, 150)]
    texts = []
    for k in range(120):  # of the base some are at 0.8 and more, some under
        copy = list(base)
        for place in rng.choice(140, int(rng.integers(1, 6)), replace=False):
            copy[int(place)] = f"own{k}x{place}"
        texts.append(" ".join(copy))
    met, across = [], partenum.across
    monkeypatch.setattr(partenum, "across", lambda *frames: (met.append([tuple(sorted(r)) for r in across(*frames).collect()]), across(*frames))[1])
    docs = documents(spark, texts)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in similar_groups(docs, 5, 80).collect()), key=str)
    assert got == groups(rows, 5, 80)
    assert sum(map(len, met)) <= 2 * len(set(sum(met, []))) + 100


def test_comparisons_are_compiled(spark):
    # Java interprets a method of over 8,000 bytes.
    bits = {"sketch": partenum.SKETCH // 64, "wide": partenum.WIDE // 64, "meetings": 4}
    sets = spark.range(50).select("id", (F.col("id") % 3).alias("signature"), F.lit(400).alias("n"), *(F.array(*[F.xxhash64("id", F.lit(i)) for i in range(k)]).alias(c) for c, k in bits.items()))
    x = sets.selectExpr("signature", "id as own", "id as a", "n as na", "meetings as ma", "sketch as x", "wide as wx")
    y = sets.selectExpr("signature as s", "id as component", "id as b", "n as nb", "meetings as mb", "sketch as y", "wide as wy")
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, value in zip(kept, ("false", "-1")):
            spark.conf.set(c, value)
        pairs = partenum.across(x, y, *partenum.sketch_tests(80))
        codes = debug.codegenStringSeq(pairs._jdf.queryExecution().executedPlan())
        joins = [codes.apply(i)._3().maxMethodCodeSize() for i in range(codes.size()) if "SortMergeJoin" in codes.apply(i)._1()]
        assert len(joins) == 1 and joins[0] < 8_000
    finally:
        for c, value in kept.items():
            spark.conf.set(c, value)


def test_few_rounds_for_large_groups(spark, monkeypatch):
    monkeypatch.setattr(partenum, "PAIRS", 5)
    monkeypatch.setattr(partenum, "HUBS", 1)
    rounds, staged = [], partenum.staged
    monkeypatch.setattr(partenum, "staged", lambda df, name="table": (rounds.append(name), staged(df, name))[1])
    # Of one signature each, as the long common passage fills most parts of a set; no two are similar.
    some = np.random.default_rng(2)
    common = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, common + "".join(f" x{some.integers(1 << 40)}" for _ in range(24))) for i in range(60)], "doc_id long, text string")
    got = similar_groups(docs, 1, 80, partitions=2).collect()
    assert len({r["component_id"] for r in got}) == 60
    assert 2 < rounds.count("torn") < 8
