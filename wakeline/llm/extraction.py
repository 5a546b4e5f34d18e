"""Main text of web pages: boosted trees over element features, decoded so that ancestors and descendants agree."""

from __future__ import annotations

import html as entities
import json
import math
import random
from collections import Counter
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wakeline.llm import boosting, dom, templates
from wakeline.llm.common import drawn, map_arrow, text_batches

#: Pages whose texts fill the taught pages (least hash first), and how many pages are taught.
SAMPLE, TAUGHT = 300, 500
# Fixed word lists, looked for in class, id, role and the like.
GOOD_WORDS = ("article", "content", "post", "entry", "main", "body", "story", "text", "prose")
BAD_WORDS = {
    "menu": ("nav", "navigation", "menu", "navbar", "breadcrumb", "breadcrumbs", "tabs", "pagination", "toc"),
    "frame": ("header", "masthead", "banner", "footer", "copyright", "legal", "bottom", "topbar", "contentinfo"),
    "side": ("sidebar", "side", "aside", "widget", "related", "recommended", "share", "social", "tags", "complementary", "trending"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion"),
    "notice": ("cookie", "cookies", "notice", "consent", "popup", "modal", "alert", "dialog", "newsletter", "subscribe", "gdpr", "disclaimer", "paywall"),
    "reader": ("comment", "comments", "respond", "responses", "reply", "replies", "discussion", "disqus", "reader"),
    "form": ("form", "search", "login", "signup", "contact", "register"),
}
TAG_KINDS = (
    ("article", "main"), ("nav", "menu"), ("header",), ("footer",), ("aside",), ("form", "fieldset", "button", "label", "select"),
    ("section",), ("div",), ("p", "blockquote", "pre"), ("ul", "ol", "li", "dl", "dd", "dt"), ("h1", "h2", "h3", "h4", "h5", "h6"),
    ("table", "tbody", "tr", "td", "th"), ("a", "span", "b", "i", "em", "strong"),
)
_KIND = {name: k for k, names in enumerate(TAG_KINDS) for name in names}
_TOKEN = re.compile(r"[a-z]+")
_BAD = {w: k for k, words in enumerate(BAD_WORDS.values()) for w in words}
_GOOD = set(GOOD_WORDS)


def told(nodes: list[dom.Node]) -> list[tuple[int, int]]:
    """(bits of bad word kinds, number of good words) of each element's attributes."""
    out = []
    for node in nodes:
        bad = good = 0
        if node.attributes:
            for w in _TOKEN.findall(node.attributes):
                if w in _BAD:
                    bad |= 1 << _BAD[w]
                elif w in _GOOD:
                    good += 1
        out.append((bad, good))
    return out


class Page:
    """A page's elements with what the trees see of them."""

    def __init__(self, html: str):
        self.nodes, raw = dom.read(html)
        n = len(self.nodes)
        self.unseen = [False] * n
        self.link = [False] * n
        for i, node in enumerate(self.nodes[1:], 1):
            self.unseen[i] = self.unseen[node.parent] or node.name in dom.UNSEEN
            self.link[i] = self.link[node.parent] or node.name == "a"
        self.pieces = [(i, t if t is None or "&" not in t else entities.unescape(t)) for i, t in raw if not self.unseen[i]]
        own, words, marks, linked, blocks = ([0] * n for _ in range(5))
        for i, t in self.pieces:
            if t is None:
                blocks[i] += 1
            else:
                size = len(t.strip())
                if size:
                    own[i] += size
                    words[i] += t.count(" ") + 1
                    marks[i] += t.count(".") + t.count(",")
                    if self.link[i]:
                        linked[i] += size
        self.own = own[:]
        count = [1] * n
        for i in range(n - 1, 0, -1):
            p = self.nodes[i].parent
            for column in (own, words, marks, linked, blocks, count):
                column[p] += column[i]
        self.size, self.words, self.marks, self.linked, self.blocks, self.count = own, words, marks, linked, blocks, count
        self.judge = self._judged()

    def _judged(self) -> list[int]:
        """The judged element that decides for each element: itself, or its nearest judged ancestor."""
        out = [0] * len(self.nodes)
        for i, node in enumerate(self.nodes[1:], 1):
            p = node.parent
            apart = node.name in dom.BLOCK or (self.own[p] == 0 and self.nodes[p].name in dom.BLOCK and self.nodes[p].name not in ("p", "li", "td", "h1", "h2", "h3"))
            out[i] = i if apart and not self.unseen[i] and self.size[i] else out[p]
        return out

    def rows(self) -> tuple[list[int], np.ndarray]:
        """(judged elements, their features)."""
        nodes, said = self.nodes, told(self.nodes)
        above_bad, above_good, inside = [0] * len(nodes), [0] * len(nodes), [0] * len(nodes)
        for i, node in enumerate(nodes[1:], 1):
            p = node.parent
            kind = _KIND.get(node.name, -1)
            above_bad[i] = above_bad[p] | said[p][0] | (1 << (8 + _KIND[nodes[p].name]) if _KIND.get(nodes[p].name, -1) in (1, 2, 3, 4, 5) else 0)
            above_good[i] = above_good[p] + said[p][1]
            inside[i] = inside[p] + (_KIND.get(nodes[p].name, -1) == 0)
        judged = [i for i in range(1, len(nodes)) if self.judge[i] == i]
        total = max(1, self.size[0])
        out = []
        families: dict[int, tuple[list[int], dict[int, int], Counter]] = {}  # of a parent, found once
        for i in judged:
            node = nodes[i]
            p = node.parent
            if p not in families:
                siblings = [c for c in nodes[p].children if self.size[c]]
                families[p] = siblings, {c: k for k, c in enumerate(siblings)}, Counter(nodes[c].name for c in siblings)
            siblings, places, names = families[p]
            k = places[i]
            size = self.size[i]
            bad, good = said[i]
            below = sum(said[c][0] > 0 for c in node.children)
            row = [
                math.log1p(size), size / total, size / max(1, self.size[p]), math.log1p(self.own[i]), self.linked[i] / max(1, size),
                self.count[i] / (size + 1), self.marks[i] / max(1, self.words[i]), self.words[i] / max(1, self.blocks[i]),
                node.depth, len(siblings), k, k / max(1, len(siblings)), len(siblings) - k - 1,
                math.log1p(self.size[siblings[k - 1]]) if k else -1, math.log1p(self.size[siblings[k + 1]]) if k + 1 < len(siblings) else -1,
                good, above_good[i], inside[i], below, bad > 0, above_bad[i] > 0, len(node.children),
                names[node.name], sum(nodes[c].name in ("p", "h2", "blockquote") for c in node.children),
                sum(nodes[c].name in ("article", "main") for c in node.children),
            ]
            row += [bad >> b & 1 for b in range(len(BAD_WORDS))] + [above_bad[i] >> b & 1 for b in range(8 + 6)]
            kind, over = _KIND.get(node.name, -1), _KIND.get(nodes[p].name, -1)
            row += [kind == t for t in range(len(TAG_KINDS))] + [over == t for t in range(len(TAG_KINDS))]
            out.append(row)
        return judged, np.array(out, float)

    def decode(self, judged: list[int], chance: np.ndarray) -> set[int]:
        """Judged elements that stay: the likeliest choice in which all ancestors of one that stays stay too."""
        yes = dict(zip(judged, np.log(np.clip(chance, 0.002, 0.998)).tolist()))
        no = dict(zip(judged, np.log(np.clip(1 - chance, 0.002, 0.998)).tolist()))
        up = {i: self.judge[self.nodes[i].parent] for i in judged}
        stay, leave = {i: yes[i] for i in judged}, {i: no[i] for i in judged}
        for i in reversed(judged):
            if up[i]:
                stay[up[i]] += max(stay[i], leave[i])
                leave[up[i]] += leave[i]
        kept = {0}
        for i in judged:
            if up[i] in kept and stay[i] >= leave[i]:
                kept.add(i)
        return kept

    def text(self, kept: set[int]) -> str:
        """Texts of elements that stay: white space inside a block is one space, blocks are joined by one."""
        blocks, block = [], []
        for i, t in self.pieces:
            if t is None:
                if block:
                    blocks.append(" ".join("".join(block).split()))
                    block = []
            elif self.judge[i] in kept:
                block.append(t)
        if block:
            blocks.append(" ".join("".join(block).split()))
        return " ".join(b for b in blocks if b)


def teach(texts: list[str], pages: int = TAUGHT, seed: int = 3) -> dict:
    """Trees fitted on pages of known parts, filled with ``texts``. An element is right to stay if it holds article text."""
    rng = random.Random(seed)
    pool = texts or ["Some words, then more words. A second sentence follows.", "Short text."]
    xs, ys = [], []
    for _ in range(pages):
        page = Page(templates.page(rng, pool))
        holds = [False] * len(page.nodes)
        for i, t in page.pieces:
            if t and templates.MARK in t:
                while i >= 0 and not holds[i]:
                    holds[i] = True
                    i = page.nodes[i].parent
        judged, x = page.rows()
        xs.append(x)
        ys += [holds[i] for i in judged]
    return boosting.fit(np.concatenate(xs), np.array(ys, float))


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = SAMPLE) -> str:
    """The trees as JSON text. At most ``sample`` pages, least hash of key and html first, come to the driver."""
    seen = pages.filter(F.col(html).isNotNull()).select(F.xxhash64(F.lit(9), key, html).alias("hash"), F.col(html).alias("html"))
    texts = []
    for row in drawn(seen, "hash", sample).orderBy("hash", "html").collect():
        for _, t in Page(row["html"]).pieces:
            t = entities.escape(" ".join((t or "").split()), quote=False).replace(templates.MARK, "")
            if 10 < len(t) < 3000:
                texts.append(t)
    return json.dumps(teach(texts))


def extract(pages: DataFrame, model: str, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without its html, plus ``out``, the main text, and n_chars, its code points.

    The whole html is read; null or empty html gives an empty text. What stays is decided for elements that are blocks or
    stand alone; inline elements follow the block they are in. Text outside of any element stays unless an element
    around it goes. Elements that a reader does not see (head, scripts, styles and the like) never stay. Rows are
    independent, so repeated rows give repeated results. A column named like a result is replaced.
    """
    others = [c for c in pages.columns if c not in (html, out, "n_chars")]
    schema = pages.select(*others).schema.add(out, "string").add("n_chars", "long")
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        trees = json.loads(sent.value)
        for batch, texts in text_batches(batches, html):
            for at in range(0, len(texts), 200):
                read = [Page(t) for t in texts[at : at + 200]]
                rows = [p.rows() for p in read]
                sizes = np.cumsum([0] + [len(j) for j, _ in rows])
                some = [x for _, x in rows if len(x)]
                chance = boosting.predict(trees, np.concatenate(some)) if some else np.zeros(0)
                found = [p.text(p.decode(j, chance[a:b])) for p, (j, _), a, b in zip(read, rows, sizes[:-1], sizes[1:])]
                part = batch.slice(at, 200)
                columns = [*(part.column(c) for c in others), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(pages.select(*others, html), work, schema)
