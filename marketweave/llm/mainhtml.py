"""Main text of web pages by a linear-chain conditional random field over their leaf blocks.

A page is read into blocks: runs of text between the edges of block-level elements.  A block's
features are the tags and class names of its ancestors and the shape of its text; its label
says whether it is of the article.  The chain's weights are trained on labelled pages: those of
a bounded sample that mark their article, and rebuilt forms of them, in which the same article
stands in other wrappers among headers, notices, sidebars, forms and reader comments.  Pages
are decoded by Viterbi; all blocks of the article are kept, whole and in order.

Training reads at most SAMPLE_ROWS pages, by hashed id, of LONGEST characters at most; of an
article's sentences the first SENTENCES may stand as decoys in its rebuilt forms.  Reading and
decoding know no such bounds.

Defined results: null or empty html, and pages without an article block, give the empty text.
Where no page marks its article, nothing can be learned and every page gives the empty text.
A null page_id or url keeps its row.  Repeated rows have equal results.  An empty table gives
an empty result.  White space is what Python's `str.split` parts by.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from marketweave.llm.labelled import smallest
from marketweave.operators import html as markup
from marketweave.operators.html import decoded, events, raw_end

cloudpickle.register_pickle_by_value(markup)

SAMPLE_ROWS = 400  # pages that train the chain, by hashed id
LONGEST = 200_000  # characters of a page that trains; longer ones are read, not trained on
WIDTH = 4096  # hashed features
EPOCHS = 6
SENTENCES = 40

_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
# Elements of HTML that do not part text, have no end tag, or hold no readable text.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr br input".split()
)
#: Elements without readable text; the content of the first ones is no markup.
RAW = {tag: raw_end(tag) for tag in ("script", "style", "textarea", "iframe", "noembed", "noframes", "xmp")}
HIDDEN = {*RAW, "noscript", "template", "svg", "math", "object", "select", "datalist"}
#: Ancestors of a block that count as features: the outermost and the nearest ones.
OUTER, NEAR = 8, 16
_ENDS_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_MARKS = re.compile(r"[.,;:!?]")


def blocks(page: str) -> list[tuple[str, tuple[str, ...], float]]:
    """`text, ancestors, share of linked text` of each block that has text. An ancestor is a tag
    with its class names, outermost first.

    An end tag closes up to its nearest open partner; a paragraph ends where another block starts,
    a list item where the next one does.  Every step costs what it closes, so a page takes time in
    proportion to its size, whatever is left open in it.
    """
    out: list[tuple[str, tuple[str, ...], float]] = []
    stack: list[tuple[str, str]] = []
    solid: list[int] = []  # places of the elements in the stack that part text
    open_: Counter = Counter()
    parts: list[str] = []
    linked = hidden = 0

    def end() -> None:
        nonlocal linked
        text = " ".join(decoded("".join(parts)).split()) if parts else ""
        if text:
            near = solid if len(solid) <= OUTER + NEAR else solid[:OUTER] + solid[-NEAR:]
            out.append((text, tuple(stack[i][1] for i in near), min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal hidden
        for tag, _ in stack[to:]:
            open_[tag] -= 1
            hidden -= tag in HIDDEN
        del stack[to:]
        while solid and solid[-1] >= to:
            solid.pop()

    for kind, value, attrs in events(page, RAW):
        if kind == "text":
            if not hidden:
                parts.append(value)
                linked += len(value) if open_["a"] else 0
            continue
        if value == "br":
            parts.append(" ")
        elif value not in INLINE:
            end()
        if kind == "end":
            if open_[value]:
                at = len(stack) - 1
                while stack[at][0] != value:
                    at -= 1
                close(at)
        elif kind == "start":
            closed = "li" if value == "li" else "p" if value in _ENDS_P else None
            if closed and solid and stack[solid[-1]][0] == closed:
                close(solid[-1])
            names = " ".join(a or b or c for a, b, c in _NAMES.findall(attrs))
            stack.append((value, f"{value} {names}".strip().lower()))
            open_[value] += 1
            hidden += value in HIDDEN
            if value not in INLINE:
                solid.append(len(stack) - 1)
    end()
    return out


def _id(name: str) -> int:
    return zlib.crc32(name.encode()) % WIDTH


def features(found: list[tuple[str, tuple[str, ...], float]]) -> list[np.ndarray]:
    """Hashed features of each block."""
    out = []
    for i, (text, path, linked) in enumerate(found):
        names = {"bias", f"links={min(3, int(linked * 4))}"}
        size = text.count(" ") + 1
        names.add(f"words={min(8, size.bit_length())}")
        names.add(f"marks={min(3, len(_MARKS.findall(text)) * 12 // size)}")
        names.add(f"head={text[0] in '©®™'}")
        names.add(f"first={i == 0}")
        for part in path:
            words = re.split(r"[^a-z0-9]+", part)
            names.add("in=" + words[0])
            names.update("name=" + w for w in words[1:] if w)
        if path:
            names.add("leaf=" + path[-1].split()[0])
        out.append(np.array(sorted({_id(n) for n in names})))
    return out


def _marginals(e: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of labels and of neighbouring pairs."""
    n = len(e)
    alpha, beta = e.copy(), np.zeros_like(e)
    for t in range(1, n):
        alpha[t] += np.logaddexp(alpha[t - 1, 0] + trans[0], alpha[t - 1, 1] + trans[1])
    for t in range(n - 2, -1, -1):
        nxt = e[t + 1] + beta[t + 1]
        beta[t] = np.logaddexp(trans[:, 0] + nxt[0], trans[:, 1] + nxt[1])
    whole = np.logaddexp(alpha[-1, 0], alpha[-1, 1])
    pairs = np.exp(alpha[:-1, :, None] + trans + (e[1:] + beta[1:])[:, None, :] - whole)
    return np.exp(alpha + beta - whole), pairs


def fit(pages: list[tuple[list[np.ndarray], np.ndarray]], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights (label, feature) and transitions, by adaptive gradient ascent."""
    rng = np.random.default_rng(seed)
    weight, trans = np.zeros((2, WIDTH)), np.zeros((2, 2))
    seen_w, seen_t = np.full((2, WIDTH), 1e-2), np.full((2, 2), 1e-2)
    for _ in range(EPOCHS):
        for p in rng.permutation(len(pages)):
            x, y = pages[p]
            if not len(y):
                continue
            e = np.stack([weight[:, f].sum(axis=1) for f in x])
            label, pairs = _marginals(e, trans)
            gap = -label
            gap[np.arange(len(y)), y] += 1
            d_w = np.zeros((2, WIDTH))
            for f, g in zip(x, gap):
                d_w[:, f] += g[:, None]
            d_t = -pairs.sum(axis=0)
            np.add.at(d_t, (y[:-1], y[1:]), 1)
            hit = np.flatnonzero(d_w.any(axis=0))
            d_w[:, hit] -= 1e-3 * weight[:, hit]
            seen_w[:, hit] += d_w[:, hit] ** 2
            weight[:, hit] += 0.2 * d_w[:, hit] / np.sqrt(seen_w[:, hit])
            seen_t += d_t**2
            trans += 0.2 * d_t / np.sqrt(seen_t)
    return weight, trans


def decode(x: list[np.ndarray], weight: np.ndarray, trans: np.ndarray) -> list[int]:
    """The likeliest labels of a page's blocks."""
    if not x:
        return []
    own = weight[1] - weight[0]
    (t00, t01), (t10, t11) = trans.tolist()
    zero, one, back = 0.0, float(own[x[0]].sum()), []
    for f in x[1:]:
        gain = float(own[f].sum())
        back.append((zero + t00 < one + t10, zero + t01 < one + t11))
        zero, one = max(zero + t00, one + t10), max(zero + t01, one + t11) + gain
    path = [int(one > zero)]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


_OUTSIDE = {"nav", "aside", "form", "footer", "header", "head"}


def marked(page: str) -> tuple[list, np.ndarray] | None:
    """Blocks and labels of a page that marks its article."""
    found = blocks(page)
    y = []
    for _, path, _ in found:
        tags = [p.split()[0] for p in path]
        inside = "article" in tags
        after = tags[tags.index("article") + 1 :] if inside else []
        side = any(t in _OUTSIDE for t in after) or any(re.search(r"\b(ad|ads|advert|comments?|related|share|notice)\b", p) for p in path)
        y.append(int(inside and not side))
    return (found, np.array(y)) if any(y) else None


# Names under which sites know the parts of a page; what surrounds an article in rebuilt pages.
_WRAP = ("article", "main", 'div class="content"', 'div id="main-content"', 'div class="post-body"', 'section class="story"', 'div class="entry"')
_AROUND = (
    ("header", 'div class="header"', 'div class="site-header banner"'),
    ("nav", 'div class="menu"', 'ul class="navigation"'),
    ('div class="notice"', 'div class="cookie-notice"', 'div id="banner"'),
    ("aside", 'div class="sidebar"', 'div class="related"'),
    ('div class="ad"', 'div class="advert"', 'aside class="ads sponsored"'),
    ("form", 'form class="newsletter subscribe"', 'form id="search"'),
    ('section class="comments"', 'div id="comments"', 'div class="comment reader-comments"'),
    ("footer", 'div class="footer"', 'div id="footer"'),
)


def _rebuilt(found: list, y: np.ndarray, rng) -> tuple[list, np.ndarray]:
    """Another form of a page: its article in some wrapper, and its other texts and pieces of the
    article's sentences around and inside it."""
    body = [text for (text, _, _), label in zip(found, y) if label]
    rest = [text for (text, _, _), label in zip(found, y) if not label] or ["-"]
    sentences = [s for text in body for s in re.split(r"(?<=[.!?]) ", text)][:SENTENCES]
    wrap = _WRAP[rng.integers(len(_WRAP))]
    pages: list[tuple[str, list[str], int]] = []

    def part(kind: int, within: tuple[str, ...]) -> None:
        name = _AROUND[kind][rng.integers(3)]
        for _ in range(int(rng.integers(1, 4))):
            talk = kind in (2, 3, 6) and rng.random() < 0.7
            text = sentences[rng.integers(len(sentences))] if talk else rest[rng.integers(len(rest))]
            pages.append((text, [*within, name, ("p", "li", "div")[rng.integers(3)]], 0))

    outer = ("body",) if rng.random() < 0.5 else ("body", 'div class="wrapper"')
    for kind in (0, 1, 2, 4):
        if rng.random() < 0.6:
            part(kind, outer)
    for i, text in enumerate(body):
        leaf = ("h1", "h2")[i > 0] if len(text) < 80 and rng.random() < 0.5 else "p"
        pages.append((text, [*outer, wrap, leaf], 1))
        if rng.random() < 0.08:
            part((3, 4, 5)[rng.integers(3)], (*outer, wrap))
    if rng.random() < 0.3:
        part(6, (*outer, wrap))
    for kind in (3, 5, 6, 7):
        if rng.random() < 0.6:
            part(kind, outer)
    names = lambda path: tuple(re.sub(r'\s*(class|id)="([^"]*)"', r" \2", p) for p in path)
    return [(text, names(path), 0.9 if path[-2].startswith(("nav", "ul")) else 0.0) for text, path, _ in pages], np.array([label for *_, label in pages])


def train(pages: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions from a bounded sample of the pages that mark their article."""
    some = pages.filter(F.col("html").contains("<article") & (F.length("html") <= LONGEST)).select("html", F.xxhash64("html").alias("h"))
    keys = smallest(some.select("h").distinct(), "h", rows)
    some = some.join(F.broadcast(keys), "h").groupBy("h").agg(F.min("html").alias("html"))
    labelled = [m for r in sorted(r["html"] for r in some.collect()) if (m := marked(r))]
    rng = np.random.default_rng(11)
    every = []
    for found, y in labelled:
        every.append((features(found), y))
        every += [(features(b), z) for b, z in (_rebuilt(found, y, rng) for _ in range(2))]
    return fit(every)


def main_text(page: str | None, weight: np.ndarray, trans: np.ndarray) -> str:
    found = blocks(page or "")
    return " ".join(text for (text, _, _), keep in zip(found, decode(features(found), weight, trans)) if keep)


def _extract(batches, weight: np.ndarray, trans: np.ndarray, keep: list[str]):
    for batch in batches:
        texts = [main_text(p.as_py(), weight, trans) for p in batch.column("html")]
        chars = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string()), chars], [*keep, "text", "n_chars"])


def extract(pages: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """`page_id, url, text, n_chars` of each row."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    pages = pages.select("page_id", "url", "html")
    weight, trans = model
    return pages.mapInArrow(partial(_extract, weight=weight, trans=trans, keep=["page_id", "url"]), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
