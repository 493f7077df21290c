"""Main text of web pages with a recurrent block labeller.

A page is cut into blocks, its leaf runs of text. Each block has a vector of
its tag path (tags, classes and ids, hashed) and of its words (hashed). A
bidirectional LSTM in numpy reads the whole page and labels every block as
article or not, so a block is judged by what stands before and after it.

The labeller is trained on a bounded sample of pages. Their labels come from
the tag path where it is telling (menus, footers, adverts and so on by element,
class or id); the same texts are also set into made-up layouts whose labels are
known, so that it does not hang on the sample's layout alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runnel.llm.words import SPACED, slices, split_words

# Elements of HTML by how they take part in text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "noscript", "template", "svg", "textarea", "title", "iframe", "object", "math", "canvas", "audio", "video"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "label", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
    "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: A block element that starts ends an open one of these at the top of the path.
ENDS_ITSELF = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
#: Elements and names whose text is not the article's, and those whose text is.
OUTSIDE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "label", "fieldset"}
OUTSIDE_NAMES = {
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "footer", "header", "login", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "reply", "replies", "search", "share", "sidebar", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget",
}
INSIDE_TAGS = {"article", "main"}

#: A ">" inside a quoted value does not end the tag; a quote that is never closed is none.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_COMMENT = re.compile(r"<!--(?:-?>|.*?--!?>)", re.DOTALL)
NAMED = {"class", "id", "role"}
#: Hidden elements of another markup, which alone may close themselves.
FOREIGN = {"svg", "math"}
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

PATH_FEATURES = 96
WORD_FEATURES = 64
FEATURES = PATH_FEATURES + WORD_FEATURES + 4
#: Blocks read at once; a longer page is read in parts of so many that hand on their states.
SEQUENCE = 2048

Path = tuple[str, ...]


def closes_itself(rest: str) -> bool:
    """Whether what follows a tag's name ends in a "/" that belongs to no value."""
    ends = [m.end() for m in _ATTRIBUTE.finditer(rest)]
    return rest.endswith("/") and (not ends or ends[-1] < len(rest))


def blocks(page: str) -> list[tuple[Path, str, int]]:
    """(path, text, length of link text) of the page's non-empty leaf blocks, in page order.

    The path holds a tag and, behind dots, the words of its class, id and role
    per open element. Character references are decoded and white space is made
    one space. Comments, scripts, styles and other hidden elements are left out; an unclosed one
    hides the rest of the page. Tags end as HTML has it: not inside quoted values, and a
    "/" before the end closes no HTML element.
    """
    out: list[tuple[Path, str, int]] = []
    path: list[str] = []
    tags: list[str] = []
    parts: list[str] = []
    links = at = 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = _SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                out.append((tuple(path), text, links))
            parts.clear()
        links = 0

    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            parts.append(page[at:])
            break
        if begin > at:
            parts.append(page[at:begin])
            if "a" in tags:
                links += begin - at
        if page.startswith("<!--", begin):
            comment = _COMMENT.match(page, begin)
            at = comment.end() if comment else len(page)
            continue
        if page.startswith(("<!", "<?"), begin):
            end = page.find(">", begin)
            at = len(page) if end < 0 else end + 1
            continue
        tag = _TAG.match(page, begin)
        if not tag:
            # A lone "<", or a tag that the page breaks off.
            at = begin + 1
            if re.match(r"</?[a-zA-Z]", page[begin : begin + 3]):
                at = len(page)
            else:
                parts.append("<")
            continue
        closes, name, rest = tag[1], tag[2].lower(), tag[3]
        at = tag.end()
        if name in HIDDEN:
            if not closes and not (name in FOREIGN and closes_itself(rest)):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in BLOCK:
            flush()
        elif name == "br":
            parts.append(" ")
        if closes:
            if name in tags:
                place = len(tags) - 1 - tags[::-1].index(name)
                # An inline element does not end the blocks inside it.
                if name in BLOCK or not any(t in BLOCK for t in tags[place + 1 :]):
                    del tags[place:], path[place:]
        elif name not in VOID:
            if name in BLOCK:
                while tags and tags[-1] not in BLOCK:
                    tags.pop(), path.pop()
                if tags and name in ENDS_ITSELF.get(tags[-1], ()):
                    tags.pop(), path.pop()
            named = [m for m in _ATTRIBUTE.finditer(rest) if m[1].lower() in NAMED]
            names = [w for m in named for w in _WORD.findall((m[2] or m[3] or m[4] or "").lower())]
            tags.append(name)
            path.append(".".join([name, *names]))
    flush()
    return out


def outside(path: Path) -> bool:
    """Whether the path names a part of the page that is not its article."""
    inner = False
    for element in path:
        tag, *names = element.split(".")
        if tag in INSIDE_TAGS:
            inner = True
        if tag in OUTSIDE_TAGS or OUTSIDE_NAMES & set(names) or (tag == "header" and not inner):
            return True
    return False


def _bucket(word: str, n: int) -> int:
    value = 2166136261
    for byte in word.encode():
        value = (value ^ byte) * 16777619 & 0xFFFFFFFF
    return (value ^ value >> 15) % n


_path_memory: dict[Path, np.ndarray] = {}


def _path_vector(path: Path) -> np.ndarray:
    if path not in _path_memory:
        if len(_path_memory) > 20_000:
            _path_memory.clear()
        out = np.zeros(PATH_FEATURES, np.float32)
        for depth, element in enumerate(reversed(path)):
            tag, *names = element.split(".")
            for word in [tag, *(f".{n}" for n in names)]:
                out[_bucket(word, PATH_FEATURES)] += 1 / (1 + 0.2 * depth)
        _path_memory[path] = out
    return _path_memory[path]


def vectors(found: list[tuple[Path, str, int]]) -> np.ndarray:
    """One row of FEATURES numbers per block."""
    out = np.zeros((len(found), FEATURES), np.float32)
    if not found:
        return out
    words = split_words(pa.array([t for _, t, _ in found], pa.large_string()), SPACED, lower=True)
    count = np.diff(words.first)
    block = np.repeat(np.arange(len(found)), count)
    bag = np.bincount(block * WORD_FEATURES + (words.hashes % np.uint64(WORD_FEATURES)).astype(np.int64), minlength=len(found) * WORD_FEATURES)
    out[:, :PATH_FEATURES] = [_path_vector(p) for p, _, _ in found]
    out[:, PATH_FEATURES:-4] = bag.reshape(len(found), -1) / np.maximum(count, 1)[:, None]
    size = np.array([len(t) for _, t, _ in found], np.float32)
    out[:, -4] = np.log1p(size) / 5
    out[:, -3] = np.minimum(np.array([n for _, _, n in found]) / size, 1)
    out[:, -2] = np.log1p(count) / 5
    out[:, -1] = 1
    return out


@dataclass
class Labeller:
    """Weights: per direction the input, the recurrence and the bias of four gates; then the output."""

    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray

    @staticmethod
    def fresh(hidden: int, seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        inputs = [(rng.standard_normal((FEATURES, 4 * hidden)) * 0.15).astype(np.float32) for _ in range(2)]
        recurrent = [(rng.standard_normal((hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32) for _ in range(2)]
        return Labeller(inputs, recurrent, (rng.standard_normal(2 * hidden + 1) * 0.1).astype(np.float32))

    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _steps(x: np.ndarray, recurrent: np.ndarray, mask: np.ndarray, backward: bool, keep: list | None = None, carried: np.ndarray | None = None) -> np.ndarray:
    """Hidden states of one direction; x is (time, batch, 4 * hidden), mask (time, batch).

    ``carried`` (2, batch, hidden) holds state and cell to begin with, zeros without it, and takes the last ones.
    """
    time, batch, four = x.shape
    h = four // 4
    state, cell = np.zeros((2, batch, h), np.float32) if carried is None else carried.copy()
    out = np.zeros((time, batch, h), np.float32)
    for t in reversed(range(time)) if backward else range(time):
        gates = x[t] + state @ recurrent
        take, forget, give = (_sigmoid(gates[:, k * h : (k + 1) * h] + (k == 1)) for k in range(3))
        new = np.tanh(gates[:, 3 * h :])
        before, before_cell = state, cell
        live = mask[t][:, None]
        cell = np.where(live, forget * cell + take * new, cell)
        squashed = np.tanh(cell)
        state = np.where(live, give * squashed, state)
        out[t] = state
        if keep is not None:
            keep.append((t, take, forget, give, new, before, before_cell, squashed, live))
    if carried is not None:
        carried[:] = state, cell
    return out


def label(model: Labeller, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Probability that a block belongs to the article, for the blocks of every page.

    Each direction goes through the parts of a page in its order and takes its
    state and cell along, so the result is that of one pass, and no more than
    SEQUENCE blocks of 64 pages are in work.
    """
    out = [np.full(len(p), model.output[-1], np.float32) for p in pages]
    order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
    hidden = len(model.recurrent[0])
    for at in range(0, len(order), 64):
        chosen = order[at : at + 64]
        lengths = np.array([len(pages[i]) for i in chosen])
        parts = range(0, lengths[-1], SEQUENCE)
        for d, (w, r) in enumerate(zip(model.inputs, model.recurrent)):
            carried = np.zeros((2, len(chosen), hidden), np.float32)
            for begin in reversed(parts) if d else parts:
                # Pages are sorted by length: those that reach this part are the last ones.
                reach = int(np.searchsorted(lengths, begin, "right"))
                x, mask = _padded([pages[i][begin : begin + SEQUENCE] for i in chosen[reach:]])
                states = _steps(x @ w, r, mask, d == 1, carried=carried[:, reach:])
                score = states @ model.output[d * hidden : (d + 1) * hidden]
                for column, i in enumerate(chosen[reach:]):
                    own = out[i][begin : begin + SEQUENCE]
                    own += score[: len(own), column]
    return [_sigmoid(score) for score in out]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), FEATURES), np.float32)
    mask = np.zeros((longest, len(pages)), bool)
    for i, p in enumerate(pages):
        x[: len(p), i], mask[: len(p), i] = p, True
    return x, mask


class _Vectors:
    """The vectors of a long page, made for the blocks that are read."""

    def __init__(self, found: list[tuple[Path, str, int]]) -> None:
        self.found = found

    def __len__(self) -> int:
        return len(self.found)

    def __getitem__(self, part: slice) -> np.ndarray:
        return vectors(self.found[part])


def window_starts(blocks: int, window: int) -> list[int]:
    """Starts of the windows that cover a page: the first, the one that ends with the page, then those between."""
    last = max(0, blocks - window)
    return [0, last, *range(window, last, window)] if last else [0]


def train(
    pages: Sequence[np.ndarray | _Vectors], labels: list[np.ndarray], hidden: int = 16, rounds: int = 160, batch: int = 24, rate: float = 0.02, seed: int = 8, window: int = 512
) -> Labeller:
    """Fit by Adam on the mean cross entropy of the blocks, back through time over whole pages.

    A page of more than ``window`` blocks is read by a window each time it is
    drawn, in the order of ``window_starts``; about rounds * batch / pages windows of it are read.
    """
    model = Labeller.fresh(hidden, seed)
    rng = np.random.default_rng(seed)
    weights = model.weights()
    mean = [np.zeros_like(w) for w in weights]
    square = [np.zeros_like(w) for w in weights]
    drawn = [0] * len(pages)
    for step in range(1, rounds + 1):
        chosen = rng.choice(len(pages), min(batch, len(pages)), replace=False)
        parts = []
        for i in chosen:
            starts = window_starts(len(pages[i]), window)
            begin = starts[drawn[i] % len(starts)]
            parts.append(slice(begin, begin + window))
            drawn[i] += 1
        x, mask = _padded([pages[i][part] for i, part in zip(chosen, parts)])
        target = np.zeros(mask.shape, np.float32)
        for column, (i, part) in enumerate(zip(chosen, parts)):
            own = labels[i][part]
            target[: len(own), column] = own
        tapes: list[list] = [[], []]
        states = [_steps(x @ w, r, mask, d == 1, tapes[d]) for d, (w, r) in enumerate(zip(model.inputs, model.recurrent))]
        both = np.concatenate(states, 2)
        error = (_sigmoid(both @ model.output[:-1] + model.output[-1]) - target) * mask / mask.sum()
        slopes_out = np.append(np.tensordot(error, both, ([0, 1], [0, 1])), error.sum())
        slopes_in, slopes_rec = [], []
        for d in range(2):
            from_above = error[:, :, None] * model.output[d * hidden : (d + 1) * hidden]
            rec = np.zeros_like(model.recurrent[d])
            gate_slopes = np.zeros((*mask.shape, 4 * hidden), np.float32)
            ds = np.zeros((mask.shape[1], hidden), np.float32)
            dc = np.zeros_like(ds)
            for t, take, forget, give, new, before, before_cell, squashed, live in reversed(tapes[d]):
                ds = ds + from_above[t]
                through = np.where(live, ds, 0)
                inner = np.where(live, dc + through * give * (1 - squashed**2), 0)
                gates = np.concatenate([inner * new * take * (1 - take), inner * before_cell * forget * (1 - forget), through * squashed * give * (1 - give), inner * take * (1 - new**2)], 1)
                gate_slopes[t] = gates
                rec += before.T @ gates
                ds = gates @ model.recurrent[d].T + np.where(live, 0, ds)
                dc = inner * forget + np.where(live, 0, dc)
            slopes_in.append(np.tensordot(x, gate_slopes, ([0, 1], [0, 1])))
            slopes_rec.append(rec)
        for k, slope in enumerate([*slopes_in, *slopes_rec, slopes_out]):
            slope = np.clip(slope, -1, 1)
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            square[k] = 0.99 * square[k] + 0.01 * slope**2
            weights[k] -= (rate * mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


#: Made-up layouts: elements around the article, and kinds of other parts with how many blocks they have.
_ARTICLES = [("article",), ("main",), ("main", "article"), ("div.content",), ("div.main.content", "div.text"), ("section.post", "div.entry"), ("div.story.body",), ("div", "div"), ("section",)]
_PARTS = [
    (("nav", "ul", "li", "a"), 3, 9), (("header", "div.site.title"), 1, 2), (("header", "nav", "ul", "li", "a"), 3, 7), (("ul.menu", "li", "a"), 3, 9), (("div.ad",), 1, 1),
    (("div.advert", "p"), 1, 2), (("div.cookie.notice", "p"), 1, 2), (("div.banner",), 1, 1), (("aside", "p"), 1, 4), (("div.sidebar", "ul", "li"), 2, 6), (("form", "label"), 1, 4),
    (("form.newsletter", "p"), 1, 2), (("section.comments", "div.comment", "p"), 1, 6), (("div#comments.comments", "ul", "li", "p"), 1, 5), (("ol.comment.list", "li"), 1, 5),
    (("div.related", "ul", "li", "a"), 2, 6), (("div.share", "a"), 1, 4), (("footer",), 1, 3), (("footer", "p"), 1, 3), (("div.footer", "p"), 1, 2),
]


def made_up(texts: list[str], asides: list[str], rng: np.random.Generator) -> tuple[list[tuple[Path, str, int]], list[int]]:
    """A page of given texts in a made-up layout, and the labels of its blocks."""
    def some(most: int) -> list[tuple]:
        return [_PARTS[i] for i in rng.integers(0, len(_PARTS), rng.integers(0, most + 1))]

    found, labels = [], []

    def add(path: tuple, text: str, own: int) -> None:
        found.append((("html", "body", *(e.replace("#", ".") for e in path)), text, len(text) if "a" in path else 0))
        labels.append(own)

    def put(part: tuple, around: tuple = ()) -> None:
        path, low, high = part
        source = texts if rng.random() < 0.4 else asides
        for _ in range(rng.integers(low, high + 1)):
            text = source[rng.integers(len(source))]
            add((*around, *path), text if len(path) < 4 or rng.random() < 0.3 else " ".join(text.split()[:3]) or text, 0)

    article = _ARTICLES[rng.integers(len(_ARTICLES))]
    for part in some(4):
        put(part)
    if rng.random() < 0.7:
        add((*article, "h1"), texts[rng.integers(len(texts))][:60].strip() or "x", 1)
    for _ in range(rng.integers(1, 12) if rng.random() < 0.85 else rng.integers(12, 90)):
        add((*article, ("p", "p", "p", "p", "h2", "li", "blockquote")[rng.integers(7)]), texts[rng.integers(len(texts))], 1)
        if rng.random() < 0.08:
            put(_PARTS[rng.integers(len(_PARTS))], article)
    for part in some(4):
        put(part)
    return found, labels


def sampled(rows: DataFrame, sample: int) -> list[str]:
    """html of the ``sample`` rows of (id, html) with the smallest hashes; equal rows count one by one.

    Tasks send hashes only to find them; then the driver gets each chosen page once.
    """
    hashed = rows.withColumns({"of_id": F.xxhash64("id"), "of_html": F.xxhash64("html")})
    chosen = [tuple(r) for r in hashed.select("of_id", "of_html").orderBy("of_id", "of_html").limit(sample).collect()]
    wanted = rows.sparkSession.createDataFrame(sorted(set(chosen)), "of_id long, of_html long")
    found = hashed.join(F.broadcast(wanted), ["of_id", "of_html"], "left_semi").dropDuplicates(["of_id", "of_html"]).collect()
    html = {(r.of_id, r.of_html): r.html for r in found}
    return [html[key] for key in chosen]


def fit(pages: DataFrame, sample: int = 160, made: int = 320, key: str = "page_id", text: str = "html", longest: int = 300_000, seed: int = 8, window: int = 512) -> Labeller:
    """Train on the ``sample`` pages with the smallest key hashes and ``made`` made-up ones.

    Pages of more than ``longest`` characters are left out of the sample; they
    would not fit the driver. All blocks of a sampled page count, those of pages
    of more than ``window`` blocks by windows that cover the page (see ``train``).
    """
    rows = pages.select(F.col(key).alias("id"), F.col(text).alias("html")).where(F.length("html") <= longest)
    rng = np.random.default_rng(seed)
    found = [b for b in map(blocks, sampled(rows, sample)) if b]
    labels = [[0 if outside(path) else 1 for path, _, _ in page] for page in found]
    texts = [t for page, own in zip(found, labels) for (_, t, _), y in zip(page, own) if y] or ["text"]
    asides = [t for page, own in zip(found, labels) for (_, t, _), y in zip(page, own) if not y] or ["aside"]
    for _ in range(made):
        page, own = made_up(texts, asides, rng)
        found.append(page)
        labels.append(own)
    read = [vectors(page) if len(page) <= window else _Vectors(page) for page in found]
    return train(read, [np.array(own, np.float32) for own in labels], seed=seed, window=window)


def main_text(pages: DataFrame, model: Labeller, key: str = "page_id", html: str = "html", carry: Sequence[str] = (), least: float = 0.5) -> DataFrame:
    """(key, text, n_blocks, n_kept, carried columns) of every page; text joins the article's blocks by blank lines.

    Null and empty pages, and pages without an article block, have an empty
    text. Rows with equal or null keys are read one by one. An empty table
    gives an empty result. Every block is labelled in the context of its whole page.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(F.col(key).alias("id"), F.col(html).alias("html"), F.struct(F.lit(0).alias("_"), *carry).alias("carry"))
    result = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("text", T.StringType()), T.StructField("n_blocks", T.LongType())])
    result = result.add("n_kept", T.LongType()).add("carry", rows.schema["carry"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html", 1 << 21):
                found = [blocks(page or "") for page in part.column("html").to_pylist()]
                features = vectors([b for page in found for b in page])
                scores = label(sent.value, np.split(features, np.cumsum([len(page) for page in found])[:-1]))
                kept = [[page[k][1] for k in np.flatnonzero(score >= least)] for page, score in zip(found, scores)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(["\n\n".join(k) for k in kept], pa.string()), pa.array([len(p) for p in found], pa.int64()), pa.array([len(k) for k in kept], pa.int64()), part.column("carry")],
                    names=["id", "text", "n_blocks", "n_kept", "carry"],
                )

    out = rows.mapInArrow(run, result)
    return out.select(F.col("id").alias(key), "text", "n_blocks", "n_kept", *[F.col("carry")[c].alias(c) for c in carry])
