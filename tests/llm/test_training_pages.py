"""What the labeller of pages is trained on."""

import numpy as np

from runnel.llm import pages


def test_all_blocks_of_sampled_pages_count(spark, monkeypatch):
    html = "<article>" + "".join(f"<p>story {i}</p>" for i in range(700)) + "</article><footer>" + "".join(f"<p>end {i}</p>" for i in range(30)) + "</footer>"
    given = {}
    monkeypatch.setattr(pages, "train", lambda found, labels, **more: given.update(found=found, labels=labels))
    pages.fit(spark.createDataFrame([(1, html), (2, "<p>x</p>")], "page_id long, html string"), made=3)
    assert sorted(map(len, given["labels"][:2])) == [1, 730]
    long = max(range(2), key=lambda i: len(given["labels"][i]))
    assert given["labels"][long][-30:].sum() == 0 and given["labels"][long][:700].all()
    assert np.array_equal(given["found"][long][690:], pages.vectors(pages.blocks(html)[690:]))


def test_windows_cover_pages_and_train_reads_them():
    for n in (1, 4, 5, 9, 10, 11, 23):
        starts = pages.window_starts(n, 5)
        assert {b for a in starts for b in range(a, min(a + 5, n))} == set(range(n)) and len(set(starts)) == len(starts)
        assert starts[0] == 0 and (n <= 5 or starts[1] == n - 5)

    class Seen(np.ndarray):
        def __getitem__(self, part):
            read.append((part.start, min(part.stop, len(self))))
            return np.asarray(self)[part]

    read = []
    x = np.random.default_rng(0).random((23, pages.FEATURES)).astype(np.float32).view(Seen)
    pages.train([x], [np.zeros(23, np.float32)], hidden=4, rounds=5, batch=1, window=5)
    assert read == [(0, 5), (18, 23), (5, 10), (10, 15), (15, 20)]


def test_sample_sends_hashes_before_pages(spark, monkeypatch):
    rows = [(i % 40 if i % 7 else None, f"<p>page {i % 50}</p>") for i in range(120)] + [(3, "<p>same</p>")] * 5
    raw = spark.createDataFrame(rows, "id long, html string").repartition(6)
    want = [r.html for r in raw.orderBy(*[pages.F.xxhash64(c) for c in ("id", "html")]).limit(60).collect()]
    kind, sent = type(raw), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: sent.append((self.columns, "Limit" in self._jdf.queryExecution().optimizedPlan().toString())) or collect(self))
    given = {}
    monkeypatch.setattr(pages, "train", lambda found, labels, **more: given.update(n=len(found)))
    pages.fit(raw, sample=60, made=0, key="id")
    assert given["n"] == 60 and any(limited for _, limited in sent)
    assert not any(limited and "html" in columns for columns, limited in sent)
    assert pages.sampled(raw, 60) == want and pages.sampled(raw.limit(0), 60) == []
