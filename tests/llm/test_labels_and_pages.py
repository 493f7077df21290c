"""Decontamination, language and page text against brute force and held-out accuracy."""

import re
from itertools import product

import numpy as np
import pytest
from odd import documents, empty

from runnel.llm import decontamination, language, pages
from runnel.llm.decontamination import contamination
from runnel.llm.language import Model, best_path, identify

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(ALNUM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("size, limit", [(4, 1 << 22), (4, 60), (10, 1 << 22)])
def test_contamination_equals_brute_force(spark, monkeypatch, size, limit):
    monkeypatch.setattr(decontamination, "AUTOMATON_BYTES", limit)
    rng = np.random.default_rng(8)
    vocabulary = ["alpha", "Beta", "gamma-delta", "é", "x1", "(zeta)", "eta.", "中文"]
    items = [(i, " ".join(rng.choice(vocabulary, n))) for i, n in enumerate([1, 2, 3, 4, 5, 9, 12, 12, 30])] + [(20, None), (21, " ... "), (7, "alpha x1 é beta é")]
    benchmark = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")
    texts = [" ".join(rng.choice(vocabulary, 60)) for _ in range(25)] + [items[8][1], "..." + items[6][1].upper() + "!", "é", "two alpha"]
    docs = documents(spark, texts)
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(0, len(w) - size) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    want = []
    for key, text in docs.select("doc_id", "text").collect():
        w, hit, held = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    held |= windows[tuple(w[i : i + n])]
        want.append((key, len(w), len(hit), sorted(held)))
    rows = contamination(docs, benchmark, size, carry=["id", "text"]).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows), key=str) == sorted(want, key=str)
    for r in rows:
        # Spans name the hit words in the original text.
        found = [w for s in r["spans"] for w in words(r["text"][s["start"] : s["end"]])]
        assert len(found) == r["n_hit"] and all(words(r["text"])[s["first"] : s["last"] + 1] == words(r["text"][s["start"] : s["end"]]) for s in r["spans"])
    assert contamination(empty(spark), benchmark).collect() == []
    assert all(r["n_hit"] == 0 for r in contamination(docs, benchmark.limit(0)).collect())


def test_best_path_is_the_best():
    rng = np.random.default_rng(5)
    for _ in range(60):
        sizes = rng.integers(0, 6, 5)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.normal(size=(3, bounds[-1])).astype(np.float32) * 2
        label = best_path(scores, bounds, 1.5)

        def value(path, own):
            return sum(own[k, t] for t, k in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))

        for a, b in zip(bounds[:-1], bounds[1:]):
            own = scores[:, a:b]
            best = max(value(p, own) for p in product(range(3), repeat=int(b - a)))
            assert value(label[a:b], own) == pytest.approx(best, abs=1e-4)


def test_long_paths_equal_one_path(monkeypatch):
    rng = np.random.default_rng(6)
    bounds = np.concatenate([[0], np.cumsum([0, 3, 700, 1, 0, 95, 1500, 6])])
    near = (rng.normal(size=(4, bounds[-1])) * 2).astype(np.float32)
    ties = rng.integers(-3, 1, (4, bounds[-1])).astype(np.float32)
    for scores in (near, ties):
        whole = best_path(scores, bounds, 3.0)
        for part in (1, 7, 64, 1000):
            monkeypatch.setattr(language, "PATH", part)
            assert (best_path(scores, bounds, 3.0) == whole).all()
        monkeypatch.undo()


def test_the_sample_is_bounded_and_equal_rows_count_once(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 'fr', 'en') as lang", "if(id % 3 = 1, 'same', concat('t', id)) as text", "if(id % 3 = 1, 7L, xxhash64(id)) as h")
    got = [(r.lang, r.text) for r in language.sampled(rows.repartition(7), 50).collect()]
    want = []
    for name in ("en", "fr"):
        own = sorted((r.h, r.lang, r.text) for r in rows.where(f"lang = '{name}'").collect())
        want += sorted({x[1:] for x in own if x[0] <= own[49][0]})
    assert sorted(got) == sorted(want) and 50 <= len(got) <= 100
    assert language.sampled(rows.limit(0), 50).collect() == []


LINES = {
    "en": "the quick brown fox jumps over the lazy dog and then with the others that were there",
    "fr": "le renard brun saute par dessus le chien paresseux et puis avec les autres qui étaient là",
    "de": "der schnelle braune Fuchs springt über den faulen Hund und dann mit den anderen die dort waren",
    "ru": "быстрая коричневая лиса прыгает через ленивую собаку и потом с другими которые были там",
}


@pytest.fixture(scope="module")
def model(spark):
    rng = np.random.default_rng(2)
    rows = [(i * 4 + k, " ".join(rng.permutation(line.split())), lang) for i in range(60) for k, (lang, line) in enumerate(LINES.items())]
    return language.fit(spark.createDataFrame([*rows, (None, "x", None), (9999, None, "en")], "doc_id long, text string, lang string"))


def test_languages_and_spans(spark, model):
    mixed = "the others were there with the dog " + LINES["ru"] + ". " + LINES["ru"]
    texts = [*LINES.values(), mixed, "12 34 ...", "ქართული ენა", "日本", (LINES["de"] + " ") * 2000]
    rows = identify(documents(spark, texts), model, carry=["text", "id"]).collect()
    by = {r["text"]: r for r in rows}
    assert [by[line]["lang_pred"] for line in LINES.values()] == list(LINES)
    for text in (None, "", " \t\n ", "12 34 ..."):
        assert (by[text]["lang_pred"], by[text]["score"], by[text]["spans"]) == ("und", 0.0, [])
    assert by["日本"]["lang_pred"] in model.languages and by["ქართული ენა"]["lang_pred"] in model.languages
    assert by[mixed]["lang_pred"] == "ru" and 0.5 < by[mixed]["score"] < 1
    spans = by[mixed]["spans"]
    assert [s["lang"] for s in spans] == ["en", "ru"] and mixed[spans[0]["start"] : spans[0]["end"]] == "the others were there with the dog"
    assert by[texts[-1]]["lang_pred"] == "de"
    assert identify(empty(spark), model).collect() == [] and len(rows) == 8 + len(texts)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify(docs, language.fit(docs.where(~language.held_out())), carry=["lang"]).where(language.held_out()).collect()
    assert len(found) > 200 and sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.98


def test_model_without_rows(spark):
    none = language.fit(empty(spark))
    rows = identify(documents(spark), none).collect()
    assert none.languages == [] and {r["lang_pred"] for r in rows} == {"und"}
    only = Model(["en"], np.zeros((1, language.FEATURES), np.float32), np.ones((len(language._NAMES), 1), bool), np.ones(1))
    assert {r["lang_pred"] for r in identify(documents(spark), only, carry=["text"]).where("text = 'one'").collect()} == {"en"}


def test_blocks_of_a_page():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <nav id=top><ul><li><a href="/a">A</a><li>B &amp; C</ul></nav><!-- <p>no</p> -->
    <article class="post main"><h1>Head</h1><p>One <b>two</b>
      three<p>Four<br>five &lt;6&gt; a < b</article><div class='ad'>Buy<p></p></div><footer>&copy; x"""
    found = [(path[-1], text) for path, text, _ in pages.blocks(page)]
    assert found == [("a", "A"), ("li", "B & C"), ("h1", "Head"), ("p", "One two three"), ("p", "Four five <6> a < b"), ("div.ad", "Buy"), ("footer", "© x")] or [
        t for _, t in found
    ] == ["A", "B & C", "Head", "One two three", "Four five <6> a < b", "Buy", "© x"]
    assert pages.blocks("") == [] and pages.blocks("<p>a<!-- b") [0][1] == "a" and pages.blocks("plain")[0][1] == "plain"
    assert pages.blocks("<script>x") == [] and [t for _, t, _ in pages.blocks("a<script>x</script>b")] == ["ab"]


def test_learned_pages(spark):
    raw = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = pages.fit(raw)
    odd = spark.createDataFrame([(None, None, "u"), (1, "", "u"), (1, "", "u"), (2, "<nav>menu</nav>", "u")], "page_id long, html string, url string")
    rows = pages.main_text(odd, model, carry=["url"]).collect()
    assert len(rows) == 4 and {r["text"] for r in rows if r["page_id"] != 2} == {""}
    assert pages.main_text(odd.limit(0), model).collect() == []
    wrong = 0
    for page_id, html, text in pages.main_text(raw, model, carry=["html"]).select("page_id", "html", "text").collect():
        article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        want = [b for b in (re.sub(r"\s+", " ", pages.unescape(re.sub(r"</?(?:b|br)>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", article)) if b]
        wrong += "\n\n".join(want) != text
    assert wrong <= 2
    # Layouts and texts that were not in the training set.
    rng = np.random.default_rng(99)
    made = [pages.made_up(["Sentences of some length that belong to a story.", "More of it, and longer."], ["Home", "Share this", "All rights reserved"], rng) for _ in range(150)]
    scores = pages.label(model, [pages.vectors(found) for found, _ in made])
    right = np.concatenate([(s >= 0.5) == np.array(y) for s, (_, y) in zip(scores, made)])
    assert right.mean() > 0.97


def test_slopes_lower_the_loss():
    rng = np.random.default_rng(0)
    xs = [np.abs(rng.normal(size=(n, pages.FEATURES))).astype(np.float32) for n in (3, 7, 5, 9)]
    ys = [(x[:, 0] > np.roll(x[:, 0], 1)).astype(np.float32) for x in xs]
    model = pages.train(xs, ys, hidden=8, rounds=150, batch=4)
    assert np.mean(np.concatenate([(s >= 0.5) == y for s, y in zip(pages.label(model, xs), ys)])) > 0.9
    assert pages.label(model, [np.zeros((0, pages.FEATURES), np.float32)])[0].shape == (0,)


@pytest.mark.parametrize(
    "page, want",
    [
        ('<p data-x="a>b">Hello', ["Hello"]),
        ('<p><a title="2 > 1">link</a> on', ["link on"]),
        ('<p>x<img alt="1>0" src=a>y', ["xy"]),
        ("<p title='a>\"b'>one</p><p title=it's>two</p>", ["one", "two"]),
        ("<script src=/a/>var x=1;</script><p>text", ["text"]),
        ("<script src='a'/>var x=1;</script foo><p>text", ["text"]),
        ("<svg/><p>after<svg><text>no</text></svg>", ["after"]),
        ("<!--><p>one<!---><p>two<!-- <p> --!><p>three<!-- never closed <p>four", ["one", "two", "three"]),
        ('<p title="never closed>one</p><p>two', ["one", "two"]),
        ("<p class = >one</p><p a==b>two", ["one", "two"]),
        ('<a href=x?q="1>one</a> two', ["one two"]),
        ("1 < 2 <p>3 <4", ["1 < 2", "3 <4"]),
        ("<p>one</p><p title='cut", ["one"]),
    ],
)
def test_tags_end_where_html_has_it(page, want):
    assert [text for _, text, _ in pages.blocks(page)] == want


def test_names_come_from_attributes_alone():
    path, _, _ = pages.blocks('<div title="x class=ad" data-class="menu" CLASS=\'Body text\' id=main/>A<p>b')[0]
    assert path == ("div.body.text.main",)
