"""Main text of web pages by a recurrent block labeller."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costseries.llm.common import fields

SAMPLE = 300  # pages the labeller is trained on
LEAVES, WORDS = 150, 40  # of a sampled page and of each of its blocks that training reads
PATH_DIM, WORD_DIM, MORE = 192, 48, 6
DIM = PATH_DIM + WORD_DIM + MORE
HIDDEN = 16
STEPS, BATCH = 260, 24  # of training

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
SILENT = "script|style|noscript|template|title|textarea|select|svg|iframe|object"  # what they hold is no text of the page
INLINE = set("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
ENDS_P = set("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

# An attribute's value is quoted only if the quote follows the equals sign; elsewhere quotes are letters like others.
ATTRIBUTES = r"(?:[\s/]+|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>]*+))?+)*+"
CONTENT = {"article", "main"}
MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<silent>{SILENT})(?=[\s/>]|\Z){ATTRIBUTES}(?:>.*?(?:</(?P=silent)\s*>|\Z)|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>{ATTRIBUTES})(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME_PART = re.compile(r"[a-z]+")

Leaf = tuple[tuple[str, ...], str, float]  # path tokens, text, share of letters inside links


def leaves(page: str | None) -> list[Leaf]:
    """Text blocks of a page in order, with the path of open elements and the names these carry.

    Markup, comments and elements that hold no text vanish; references are decoded; white space becomes
    one space; block elements and line breaks end a block, inline ones don't. Class names of several parts
    (``has-sidebar``, ``comments-open``) say how a page is laid out where they stand on or around its outermost article or
    main element, and a header inside of that is the article's own: such names are left out of the path.
    """
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...], tuple[str, ...]]] = []  # tag, its names, parts of compound names
    parts: list[str] = []
    linked = links = 0
    owner: tuple[str, ...] | None = None

    def path() -> tuple[str, ...]:
        heart = next((k for k, (tag, _, _) in enumerate(stack) if tag in CONTENT), -1)
        tokens: list[str] = []
        for k, (tag, names, compound) in enumerate(stack):
            tokens += names[1:] if tag == "header" and -1 < heart < k else names
            if k > heart:
                tokens += compound
        return tuple(tokens)

    def flush() -> None:
        nonlocal linked, owner
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append((owner or (), text, min(1.0, linked / len(text))))
        parts.clear()
        linked, owner = 0, None

    def say(text: str) -> None:
        nonlocal linked, owner
        if owner is None and not text.isspace():
            owner = path()
        parts.append(text)
        linked += len(text) * bool(links)

    def pop_to(depth: int) -> None:
        nonlocal links
        links -= sum(tag == "a" for tag, _, _ in stack[depth:])
        del stack[depth:]

    at = 0
    body = page or ""
    for m in MARKUP.finditer(body):
        if m.start() > at:
            say(body[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        block = tag not in INLINE
        if block:
            flush()
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop_to(k)
                    break
            continue
        if tag in ENDS_P:  # a new block ends an open paragraph
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if tag in CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES[tag]:
                    pop_to(k)
                    break
                if stack[k][0] in HOLDS[tag]:
                    break
        if tag not in VOID and not m["attrs"].endswith("/"):
            names, compound = [tag], []
            if "=" in m["attrs"]:
                for got in NAMED.findall(m["attrs"]):
                    for name in "".join(got).split():
                        found = ["." + n for n in NAME_PART.findall(name.lower())]
                        (names if len(found) < 2 else compound).extend(found)
            stack.append((tag, tuple(names), tuple(compound)))
            links += tag == "a"
    say(body[at:])
    flush()
    return out


class Features:
    """Vectors of blocks: hashed path tokens, hashed words and a few measures."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, int] = {}

    def path(self, tokens: tuple[str, ...]) -> np.ndarray:
        got = self.paths.get(tokens)
        if got is None:
            if len(self.paths) > 20_000:
                self.paths.clear()
            got = np.zeros(PATH_DIM, np.float32)
            for t in tokens:
                got[zlib.crc32(t.encode()) % PATH_DIM] = 1
            self.paths[tokens] = got
        return got

    def word(self, word: str) -> int:
        got = self.words.get(word)
        if got is None:
            if len(self.words) > 300_000:
                self.words.clear()
            got = self.words[word] = zlib.crc32(word.encode("utf-8", "replace")) % WORD_DIM
        return got

    def page(self, blocks: list[Leaf]) -> np.ndarray:
        x = np.zeros((len(blocks), DIM), np.float32)
        for k, (tokens, text, linked) in enumerate(blocks):
            x[k, :PATH_DIM] = self.path(tokens)
            found = text.split(" ")
            x[k, PATH_DIM : PATH_DIM + WORD_DIM] = np.bincount([self.word(w) for w in found], minlength=WORD_DIM) / (len(found) + 4.0)
            x[k, PATH_DIM + WORD_DIM :] = (
                np.log1p(len(found)) / 5, linked, float(text[-1] in ".!?…\"”"), k / len(blocks), 1 / (1 + k), 1 / (len(blocks) - k),
            )
        return x


Weights = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def initial(rng: np.random.Generator) -> Weights:
    w: Weights = {}
    for d in "fb":
        w[f"x{d}"] = rng.normal(0, 0.15, (DIM, 4 * HIDDEN)).astype(np.float32)
        w[f"h{d}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        w[f"b{d}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN).astype(np.float32)  # gates in, forget, out, cell
    w["o"] = rng.normal(0, 0.3, (2 * HIDDEN, 1)).astype(np.float32)
    w["c"] = np.zeros(1, np.float32)
    return w


def _run(w: Weights, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states of one direction; x is time first, masked steps carry the state along."""
    z = x @ w[f"x{d}"] + w[f"b{d}"]
    n, m = x.shape[0], HIDDEN
    h = c = np.zeros((x.shape[1], m), np.float32)
    out = np.zeros((n, x.shape[1], m), np.float32)
    for t in range(n) if d == "f" else range(n - 1, -1, -1):
        a = z[t] + h @ w[f"h{d}"]
        gates = _sigmoid(a[:, : 3 * m])
        i, f, o, g = gates[:, :m], gates[:, m : 2 * m], gates[:, 2 * m :], np.tanh(a[:, 3 * m :])
        c2 = f * c + i * g
        tc = np.tanh(c2)
        k = mask[t][:, None]
        if keep is not None:
            keep.append((t, h, c, i, f, o, g, tc, k))
        c, h = k * c2 + (1 - k) * c, k * (o * tc) + (1 - k) * h
        out[t] = h
    return out


def predict(w: Weights, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Probability of main text per step and page."""
    h = np.concatenate([_run(w, d, x, mask) for d in "fb"], 2)
    return _sigmoid(h @ w["o"] + w["c"])[:, :, 0]


def _back(w: Weights, d: str, x: np.ndarray, kept: list, dout: np.ndarray, grad: Weights) -> None:
    m = HIDDEN
    dz = np.zeros((x.shape[0], x.shape[1], 4 * m), np.float32)
    dh = dc = np.zeros((x.shape[1], m), np.float32)
    grad[f"h{d}"] = np.zeros_like(w[f"h{d}"])
    for t, h, c, i, f, o, g, tc, k in reversed(kept):
        dh = dh + dout[t]
        own, pass_h, pass_c = dh * k, dh * (1 - k), dc * (1 - k)
        inner = own * o * (1 - tc * tc) + dc * k
        a = np.concatenate((inner * g * i * (1 - i), inner * c * f * (1 - f), own * tc * o * (1 - o), inner * i * (1 - g * g)), 1)
        dz[t] = a
        grad[f"h{d}"] += h.T @ a
        dh, dc = a @ w[f"h{d}"].T + pass_h, inner * f + pass_c
    grad[f"x{d}"] = np.tensordot(x, dz, ([0, 1], [0, 1]))
    grad[f"b{d}"] = dz.sum((0, 1))


def gradient(w: Weights, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, Weights]:
    """Mean cross entropy over the blocks and its gradient."""
    kept = {"f": [], "b": []}
    h = np.concatenate([_run(w, d, x, mask, kept[d]) for d in "fb"], 2)
    p = _sigmoid(h @ w["o"] + w["c"])[:, :, 0]
    n = max(1.0, float(mask.sum()))
    loss = -float((mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum()) / n
    e = (mask * (p - y) / n)[:, :, None].astype(np.float32)
    grad: Weights = {"o": np.tensordot(h, e, ([0, 1], [0, 1])), "c": e.sum((0, 1))}
    dh = e @ w["o"].T
    _back(w, "f", x, kept["f"], dh[:, :, :HIDDEN], grad)
    _back(w, "b", x, kept["b"], dh[:, :, HIDDEN:], grad)
    return loss, grad


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = max(map(len, pages))
    x, mask = np.zeros((n, len(pages), DIM), np.float32), np.zeros((n, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


# Names that pages commonly give to their parts.
MAIN = [("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".article", ".body"), ("div", ".main", "div", ".post"), ("section", ".entry", ".content"), ("div", ".main", ".content", "article"), ("main", "div", ".story")]
ASIDE = {
    "top": [("header",), ("div", ".header"), ("header", ".site", ".header"), ("div", ".top", ".banner"), ("div", ".masthead")],
    "menu": [("nav", "ul", "li", "a"), ("div", ".menu", "ul", "li", "a"), ("ul", ".navigation", "li", "a"), ("header", "nav", "a"), ("div", ".breadcrumb", "a"), ("div", ".navbar", "ul", "li", "a"), ("nav", "a"), ("div", ".nav", "a")],
    "ad": [("div", ".ad"), ("div", ".ads"), ("div", ".advert"), ("div", ".advertisement"), ("aside", ".sponsored"), ("div", ".promo"), ("div", ".sponsor"), ("section", ".ad", ".banner")],
    "side": [("aside", "p"), ("aside", ".sidebar", "ul", "li", "a"), ("div", ".sidebar", "p"), ("div", ".related", "ul", "li", "a"), ("div", ".widget", "p"), ("aside",), ("div", ".share", "a"), ("div", ".social", "a")],
    "notice": [("div", ".cookie", ".notice"), ("div", ".notice"), ("div", ".cookie", "p"), ("div", ".consent", "p"), ("div", ".popup"), ("div", ".alert"), ("div", ".banner", ".cookie", "button")],
    "form": [("form", "label"), ("form",), ("div", ".newsletter", "form", "p"), ("form", ".search", "button"), ("div", ".subscribe", "p"), ("form", ".login", "label"), ("div", ".signup", "form", "label")],
    "comment": [("section", ".comments", "div", ".comment", "p"), ("div", ".comments", "p"), ("ol", ".commentlist", "li", ".comment", "p"), ("div", ".comment"), ("div", ".replies", "div", ".reply", "p"), ("section", ".comments", "h3"), ("div", ".discussion", "p")],
    "foot": [("footer",), ("footer", "p"), ("div", ".footer"), ("div", ".copyright"), ("footer", "ul", "li", "a"), ("div", ".footer", "p")],
}
IN_MAIN = [("p",), ("p",), ("p",), ("p", "b"), ("h2",), ("h3",), ("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("div",), ("table", "tr", "td"), ("pre",), ("p", "em"), ()]
BOILER = {"nav", "footer", "header", "aside", "form", "button", "menu"} | {f".{n}" for n in "ad ads advert advertisement sponsored sponsor promo menu navigation breadcrumb navbar nav sidebar related widget share social cookie notice consent popup alert newsletter subscribe login signup comments comment commentlist replies reply discussion footer copyright masthead banner".split()}


def weak_label(tokens: tuple[str, ...]) -> int | None:
    """What the names on the path say: main text, boilerplate, or nothing."""
    if not BOILER.isdisjoint(tokens):
        return 0
    return 1 if not CONTENT.isdisjoint(tokens) else None


def lesson(rng: np.random.Generator, pages: list[list[Leaf]]) -> tuple[list[Leaf], list[int]]:
    """A page to learn from: a sampled page as it is where its names tell, or its texts in another common frame."""
    page = pages[rng.integers(len(pages))]
    told = [weak_label(t) for t, _, _ in page]
    if None not in told and rng.random() < 0.5:
        return page, told
    texts = [t for _, t, _ in page]
    pick = lambda: texts[rng.integers(len(texts))]
    short = lambda: " ".join(pick().split(" ")[: rng.integers(1, 7)])
    top = ("html", "body") + (("div", ".wrapper") if rng.random() < 0.3 else ("div", ".page", ".container") if rng.random() < 0.2 else ())
    out: list[tuple[Leaf, int]] = []

    def frame(kind: str, most: int, where: tuple[str, ...] = top) -> None:
        if rng.random() < 0.55:
            names = ASIDE[kind][rng.integers(len(ASIDE[kind]))]
            for _ in range(rng.integers(1, most + 1)):
                link = "a" in names
                text = short() if link or kind in ("menu", "form") or rng.random() < 0.4 else pick()
                out.append(((where + names, text, 1.0 if link else 0.0), 0))

    main = MAIN[rng.integers(len(MAIN))]
    for kind, most in (("notice", 2), ("top", 2), ("menu", 8), ("ad", 1), ("side", 4)):
        frame(kind, most)
    body = [t for (_, t, _), l in zip(page, told) if l != 0] or [pick()]
    if rng.random() < 0.7:
        out.append(((top + main + ("h1",), short(), 0.0), 1))
    for text in body:
        out.append(((top + main + IN_MAIN[rng.integers(len(IN_MAIN))], text if rng.random() < 0.9 else short(), float(rng.random() < 0.03)), 1))
        if rng.random() < 0.06:
            frame(("ad", "side", "form", "notice")[rng.integers(4)], 2, top + main)
    if rng.random() < 0.25:
        frame("comment", 5, top + main)
    for kind, most in (("comment", 6), ("side", 4), ("ad", 1), ("form", 3), ("foot", 3), ("notice", 1)):
        frame(kind, most)
    return [leaf for leaf, _ in out], [label for _, label in out]


def train(pages: list[list[Leaf]], seed: int = 7) -> Weights:
    """Fit the labeller by Adam on lessons drawn from the sampled pages; the same pages give the same weights."""
    rng = np.random.default_rng(seed)
    w, make = initial(rng), Features()
    mean, square = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, STEPS + 1):
        drawn = [lesson(rng, pages) for _ in range(BATCH)]
        x, mask = padded([make.page(blocks) for blocks, _ in drawn])
        y = np.zeros_like(mask)
        for k, (_, labels) in enumerate(drawn):
            y[: len(labels), k] = labels
        x[:, :, :PATH_DIM] *= (rng.random(x.shape[:2]) > 0.03)[:, :, None]  # some blocks must be told by their neighbours
        _, grad = gradient(w, x, y, mask)
        norm = float(np.sqrt(sum((g * g).sum() for g in grad.values())))
        rate = 0.02 * (1 - 0.9 * step / STEPS)
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.995 * square[k] + 0.005 * g * g
            w[k] = (w[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.995**step)) + 1e-6)).astype(np.float32)
    return w


def learn(pages: DataFrame) -> Weights | None:
    """Train on ``SAMPLE`` pages, those with the least hashes; of each some blocks of bounded size reach the driver."""
    hashed = pages.where("html is not null").withColumn("h", F.xxhash64("id", "html"))
    least = hashed.select("h").distinct().orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    if least is None:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                got = leaves(value.as_py())[:LEAVES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([[list(t) for t, _, _ in got]], pa.list_(pa.list_(pa.string()))), pa.array([[" ".join(x.split(" ")[:WORDS]) for _, x, _ in got]], pa.list_(pa.string())), pa.array([[s for _, _, s in got]], pa.list_(pa.float64()))],
                    names=["paths", "texts", "linked"],
                )

    drawn = hashed.where(F.col("h") <= least).select("html").distinct()  # copies of a page count once
    rows = drawn.mapInArrow(run, fields("paths array<array<string>>, texts array<string>, linked array<double>")).collect()
    found = [[(tuple(p), t, s) for p, t, s in zip(r["paths"], r["texts"], r["linked"])] for r in rows]
    found = sorted((p for p in found if p), key=lambda p: [t for _, t, _ in p])
    return train(found) if found else None


def extract(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` of the blocks labelled as main text, ``n_chars``, ``n_blocks`` and ``n_kept``.

    A null html is empty; a page without main text gives an empty text. Whole pages are read. Repeated
    rows give repeated results; other columns are not carried; an empty table gives an empty result.
    """
    rows = pages.select(pages[page].alias("id"), pages[url].alias("url"), pages[html].alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(learn(rows))
    kind, url_kind = pages.schema[page].dataType.simpleString(), pages.schema[url].dataType.simpleString()
    schema = fields(f"id {kind}, url {url_kind}, text string, n_chars long, n_blocks long, n_kept long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, make = shared.value, Features()
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                found = [leaves(v.as_py()) for v in batch.column(2)]
                texts, kept = [""] * len(found), [0] * len(found)
                order = sorted((k for k in range(len(found)) if found[k] and w is not None), key=lambda k: len(found[k]))
                while order:  # pages of like length go through the network together
                    group = [order.pop()]
                    while order and len(group) < 64 and len(found[group[0]]) * (len(group) + 1) < 40_000:
                        group.append(order.pop())
                    p = predict(w, *padded([make.page(found[k]) for k in group]))
                    for c, k in enumerate(group):
                        chosen = [t for (_, t, _), q in zip(found[k], p[:, c]) if q >= 0.5]
                        texts[k], kept[k] = " ".join(chosen), len(chosen)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(b) for b in found], pa.int64()), pa.array(kept, pa.int64())],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", page).withColumnRenamed("url", url)
