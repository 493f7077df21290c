"""Pages of more blocks than are read at once."""

import numpy as np
import pytest

from runnel.llm import pages


def one_pass(model, x):
    """Probabilities of a page read in one go."""
    mask = np.ones((len(x), 1), bool)
    states = [pages._steps(x[:, None] @ w, r, mask, d == 1) for d, (w, r) in enumerate(zip(model.inputs, model.recurrent))]
    return pages._sigmoid(np.concatenate(states, 2) @ model.output[:-1] + model.output[-1])[:, 0]


def telling(model):
    """The same model with more say of the recurrence and of the output, so that context counts."""
    return pages.Labeller(model.inputs, [r * 2 for r in model.recurrent], model.output * 40)


@pytest.mark.parametrize("size", [1, 5, 7])
def test_parts_are_labelled_like_one_pass(monkeypatch, size):
    model = telling(pages.Labeller.fresh(16, 3))
    rng = np.random.default_rng(1)
    given = [rng.random((n, pages.FEATURES)).astype(np.float32) * 0.2 for n in [0, 40, 1, 5, 6, 13, 7, *range(2, 80), 200]]
    monkeypatch.setattr(pages, "SEQUENCE", size)
    for x, got in zip(given, pages.label(model, given)):
        assert got.shape == (len(x),)
        if len(x):
            want = one_pass(model, x)
            assert np.allclose(got, want, atol=1e-4)
            sure = np.abs(want - 0.5) > 1e-4
            assert ((got >= 0.5) == (want >= 0.5))[sure].all() and sure.mean() > 0.9


def test_main_text_of_a_long_page(spark):
    model = telling(pages.Labeller.fresh(16, 3))
    rng = np.random.default_rng(2)
    html = "".join(f"<{t}>word{i} {'more ' * int(n)}</{t}>" for i, (t, n) in enumerate(zip(rng.choice(["p", "li", "h2", "div"], 5000), rng.integers(0, 9, 5000))))
    found = pages.blocks(html)
    assert len(found) > 2 * pages.SEQUENCE
    want = one_pass(model, pages.vectors(found))
    # A threshold inside the widest gap near the cut: rounding decides nothing, the context does.
    cut = pages.SEQUENCE
    near = np.sort(want[cut - 8 : cut + 8])
    k = int(np.diff(near)[4:11].argmax()) + 4
    least = float(near[k : k + 2].mean())
    rows = spark.createDataFrame([(1, html), (2, "<p>short</p>")], "page_id long, html string")
    got = {r["page_id"]: r for r in pages.main_text(rows, model, least=least).collect()}
    kept = got[1]["text"].split("\n\n")
    names = [text for _, text, _ in found]
    sure = np.abs(want - least) > 1e-4
    chosen = set(kept)
    assert got[1]["n_blocks"] == len(found) and got[1]["n_kept"] == len(kept)
    assert [n in chosen for n, s in zip(names, sure) if s] == (want >= least)[sure].tolist() and sure.mean() > 0.9
    assert sure[cut - 8 : cut + 8].all()
