import math
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest
from odd import documents, empty
from pyspark.sql import functions as F

from runnel.llm.scoring import backoff_scores
from runnel.llm.sharding import hash_level, hilbert_index, hilbert_shards, log_level


@pytest.mark.parametrize("dimensions, bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dimensions, bits):
    cells = np.array(list(product(range(1 << bits), repeat=dimensions)))
    index = hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_shards_are_runs_of_the_curve(spark):
    docs = documents(spark, [f"text {i}" * (i % 9) for i in range(500)]).withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 5))
    cells = [hash_level(F.col("source"), 3), log_level(F.octet_length("text"), 3)]
    rows = hilbert_shards(docs, cells, 3, 24, "doc_id", [F.col("text")], partitions=5).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == docs.count() and len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 1
    assert Counter((r["doc_id"], r["c0"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(size))
    placed = [r["curve"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert placed == sorted(placed)
    none = empty(spark).withColumn("source", F.lit("s"))
    assert hilbert_shards(none, cells, 3, 24, "doc_id").collect() == []
    few = hilbert_shards(documents(spark).limit(3).withColumn("source", F.lit("s")), cells, 3, 24, "doc_id").collect()
    assert len({r["shard"] for r in few}) == 3 and all(r["slot"] == 0 for r in few)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["a", "B", "c", "dd", "e", "é"], 1 + i)) for i in range(25)] + ["only here words", "a B c"]
    docs = documents(spark, texts)
    rows = docs.select("doc_id", "text").collect()
    words = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")] for r in rows]

    def grams(w, k):
        return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))

    total = [sum((grams(w, k) for w in words), Counter()) for k in range(order + 1)]
    size = sum(map(len, words))
    want = []
    for row, w in zip(rows, words):
        own = [grams(w, k) for k in range(order + 1)]
        score, lower = 0.0, 0
        for i in range(len(w)):
            most = min(i + 1, order)
            for k in range(most, 0, -1):
                g = tuple(w[i - k + 1 : i + 1])
                n = total[k][g] - own[k][g]
                if n > 0:
                    context = size - len(w) if k == 1 else total[k - 1][g[:-1]] - own[k - 1][g[:-1]]
                    score += math.log(n / context) + (most - k) * math.log(0.4)
                    lower += k < most
                    break
            else:
                score += most * math.log(0.4) - math.log(size - len(w) + 1)
                lower += 1
        want.append((row["doc_id"], len(w), lower, round(score, 6)))
    got = [(r["doc_id"], r["n_words"], r["n_backed_off"], round(r["log_score"], 6)) for r in backoff_scores(docs, order, partitions=3).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert backoff_scores(empty(spark)).collect() == []
