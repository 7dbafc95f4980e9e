"""Main text of web pages by a tree-structured graphical model.

A page is its DOM tree; every element and every run of text has a hidden label,
content or not. A node's own look (tag, names, size, links) gives its potential,
a logistic model; a parent and a child are tied by a potential that depends on
the parent's tag. Both are trained on labelled pages. Messages passed upward from
the leaves and downward from the root (sum-product, exact on a tree) give each
run's marginal probability of content, and runs at 0.5 or more are the text.

Trees of many pages are handled together, one level of depth at a time.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

_OPEN = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_TAG_AT = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?>[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_NAME_END = re.compile(r"[\s/>]")
_SPECIAL = re.compile(r"""[>"']""")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_GOLD = re.compile(r'data-gold="([01])"')
_PART = re.compile(r"[a-z]+")
#: Elements whose text is never shown.
HIDDEN = frozenset({"script", "style", "noscript", "template", "head", "title", "textarea", "svg", "iframe", "object", "select"})
RAW = frozenset({"script", "style", "textarea", "title", "noscript", "iframe"})
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
#: A start tag of the key closes an open element of these, within the listed bounds.
_P_CLOSERS = frozenset("p div ul ol dl table section article aside header footer nav main h1 h2 h3 h4 h5 h6 blockquote pre form hr figure fieldset address details".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)} | {x: ("p",) for x in _P_CLOSERS}
_BOUND = frozenset("ul ol dl table div section article aside header footer nav main body form blockquote td th".split())
TAGS = ("#text", "html", "body", "main", "article", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "a", "span", "b", "strong", "em", "i", "nav", "header", "footer", "aside", "form", "button", "label", "table", "tr", "td", "blockquote", "pre", "figure", "figcaption", "small", "#other")
_TAG = {t: i for i, t in enumerate(TAGS)}
#: Elements nested deeper hang on the one at this depth, as in browsers; none is lost.
DEEPEST = 512
#: Tags without an end in a page, after which ends are looked up with a memory.
FAILED = 8
#: Parts of class, id and role names that speak for or against content.
FOR = frozenset("article content post entry story body text main prose".split())
AGAINST = frozenset(
    "ad ads advert advertisement sponsor sponsored promo banner nav navigation navbar menu breadcrumb breadcrumbs footer header masthead sidebar side aside widget related recommended comment comments reply replies discussion "
    "cookie consent notice alert popup modal newsletter subscribe signup login search form share social toolbar pagination pager copyright legal disclaimer contentinfo complementary skip".split()
)
FEATURES = len(TAGS) + 10


class Tags:
    """The markup of a page from left to right, in time linear in the page whatever it holds."""

    def __init__(self, source: str):
        self.source, self.last, self.failed = source, source.rfind(">"), 0
        self._next: dict[re.Pattern, tuple[int, int]] = {}
        self._ends: dict[int, int] = {}

    def _found(self, pattern: re.Pattern, at: int) -> int:
        """The next match from ``at`` on, or -1; ``at`` mostly grows, so a match ahead is remembered."""
        since, ahead = self._next.get(pattern, (0, -2))
        if ahead == -2 or not since <= at <= ahead and not (ahead == -1 and since <= at):
            m = pattern.search(self.source, at)
            since, ahead = self._next[pattern] = at, m.start() if m else -1
        return ahead

    def _end(self, at: int) -> int:
        """Where the tag whose attributes start at ``at`` has its ``>``, outside quotes; -1 if nowhere."""
        passed, end = [], -1
        while at <= self.last and (here := self._found(_SPECIAL, at)) >= 0:
            if here in self._ends or self.source[here] == ">":
                end = self._ends.get(here, here)
                break
            passed.append(here)
            if (closed := self.source.find(self.source[here], here + 1)) < 0:
                break
            at = closed + 1
        self._ends.update(dict.fromkeys(passed, end))
        return end

    def tag(self, at: int) -> tuple[str, str, int] | None:
        """(name, attributes, end) of the tag at ``at``, if it has an end."""
        if at > self.last:
            return None
        if self.failed < FAILED:
            if m := _TAG_AT.match(self.source, at):
                return m[1].lower(), m[2], m.end()
            self.failed += 1
            return None
        start = at + 1 + (self.source[at + 1] == "/")
        named = self._found(_NAME_END, start)
        end = self._end(named) if named >= 0 else -1
        return (self.source[start:named].lower(), self.source[named:end], end + 1) if end >= 0 else None

    def __iter__(self) -> Iterator[tuple[str, str, str, str]]:
        """(text before, kind, name, attributes) of each tag; kind is "" or "/" for tags, "text" for what ends at other markup."""
        source, at, seek = self.source, 0, 0
        while m := _OPEN.search(source, seek):
            start, kind = m.start(), source[m.start() + 1]
            if kind in "!?":
                comment = source.startswith("<!--", start)
                end = source.find("-->", start + 4) if comment else source.find(">", start + 2) if start < self.last else -1
                if end < 0 and not comment:
                    seek = m.end()
                    continue
                yield source[at:start], "text", "", ""
                at = seek = len(source) if end < 0 else end + (3 if comment else 1)
                continue
            if (found := self.tag(start)) is None:
                seek = m.end()
                continue
            name, attributes, end = found
            yield source[at:start], "/" if kind == "/" else "", name, attributes
            at = seek = end
            if kind != "/" and name in RAW:
                # What it holds is no markup and is never shown.
                closing = re.compile(rf"</{name}\b", re.IGNORECASE).search(source, at)
                end = source.find(">", closing.end()) if closing else -1
                at = seek = end + 1 if end >= 0 else len(source)
        yield source[at:], "text", "", ""


class Forest:
    """The trees of several pages as arrays; parents come before children."""

    def __init__(self):
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.tag: list[int] = []
        self.named: list[int] = []  # bit 0: a name speaks for content, bit 1: against
        self.text: list[str] = []
        self.block: list[int] = []  # of a run of text: which block of its page
        self.linked: list[bool] = []
        self.gold: list[int] = []
        self.roots: list[int] = []

    def add(self, parent: int, tag: str, named: int, text: str, block: int, linked: bool, gold: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(_TAG.get(tag, _TAG["#other"]))
        self.named.append(named)
        self.text.append(text)
        self.block.append(block)
        self.linked.append(linked)
        self.gold.append(gold)
        return len(self.parent) - 1

    def page(self, source: str) -> None:
        """Parse a page and append its tree."""
        root = self.add(-1, "html", 0, "", 0, False, 0)
        self.roots.append(root)
        open_tags: list[tuple[str, int, bool, int]] = [("html", root, False, 0)]  # tag, node, in a link, gold
        places: dict[str, list[int]] = {}  # of open tags in open_tags
        bounds: list[int] = [0]
        hidden, block, spaced = 0, 0, -1  # spaced: the block in which white space stands before what follows

        def close(k: int) -> None:
            nonlocal hidden, block
            for tag, *_ in open_tags[k:]:
                hidden -= tag in HIDDEN
                block += tag not in INLINE
                places[tag].pop()
            del open_tags[k:]
            while bounds[-1] >= k:
                bounds.pop()

        for piece, kind, tag, attributes in Tags(source):
            if piece and not hidden:
                if piece.isspace():
                    spaced = block
                else:
                    _, node, linked, gold = open_tags[-1]
                    text = html.unescape(piece)
                    self.add(node, "#text", 0, f" {text}" if spaced == block else text, block, linked, gold)
                    spaced = -1
            if kind == "text":
                continue
            if kind == "/":
                if own := places.get(tag):
                    close(own[-1])
                continue
            if tag == "html" or tag == "body" and places.get("body"):
                continue
            if tag == "body":
                if own := places.get("head"):
                    close(own[0])
            if targets := _CLOSES.get(tag):
                nearest = max((own[-1] for x in targets if (own := places.get(x))), default=-1)
                if nearest >= bounds[-1] and nearest > 0:
                    close(nearest)
            if tag not in INLINE:
                block += 1
            if tag in VOID or tag in RAW:
                continue
            named = 0
            if "=" in attributes:
                for value in _NAME.findall(attributes):
                    parts = set(_PART.findall(value.lower()))
                    named |= bool(parts & FOR) | 2 * bool(parts & AGAINST)
            gold = _GOLD.search(attributes)
            _, parent, linked, above = open_tags[-1]
            if self.depth[parent] >= DEEPEST:
                parent = self.parent[parent]
            mark = int(gold[1]) if gold else above
            linked = linked or tag in ("a", "button")
            places.setdefault(tag, []).append(len(open_tags))
            if tag in _BOUND:
                bounds.append(len(open_tags))
            open_tags.append((tag, self.add(parent, tag, named, "", block, linked, mark), linked, mark))
            hidden += tag in HIDDEN

    def arrays(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Parents, depths, and the nodes of each depth from 1 on."""
        parent, depth = np.array(self.parent, np.int64), np.array(self.depth, np.int64)
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(1, int(depth.max(initial=0)) + 2))
        return parent, depth, [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def features(self) -> np.ndarray:
        """One row a node: its tag, its names, and the size, links and marks of the text under it."""
        parent, depth, levels = self.arrays()
        n = len(parent)
        chars = np.array([len(x) for x in self.text], float)
        words = np.array([x.count(" ") + 1 if x else 0 for x in self.text], float)
        marks = np.array([x.count(".") + x.count(",") + x.count("?") + x.count("!") if x else 0 for x in self.text], float)
        sums = np.column_stack([chars, chars * np.array(self.linked), words, marks, chars > 0])
        for nodes in reversed(levels):
            np.add.at(sums, parent[nodes], sums[nodes])
        total = np.maximum(sums[:, 0], 1)
        out = np.zeros((n, FEATURES))
        tag = np.array(self.tag)
        out[np.arange(n), tag] = 1
        named = np.array(self.named)
        k = len(TAGS)
        out[:, k] = named & 1
        out[:, k + 1] = named >> 1 & 1
        out[:, k + 2] = np.log1p(sums[:, 0]) / 4
        out[:, k + 3] = sums[:, 1] / total
        out[:, k + 4] = np.log1p(sums[:, 2] / np.maximum(sums[:, 4], 1)) / 3
        out[:, k + 5] = np.minimum(sums[:, 3] / np.maximum(sums[:, 2], 1), 1)
        out[:, k + 6] = sums[:, 0] == 0
        out[:, k + 7] = np.minimum(depth, 20) / 10
        out[:, k + 8] = (tag == 0) & np.array(self.linked)
        out[:, k + 9] = 1
        return out


class Model:
    """Node weights and, for each parent tag, log P(child | parent) / P(child)."""

    def __init__(self, weights: np.ndarray, ties: np.ndarray):
        self.weights, self.ties = weights, ties

    def marginals(self, forest: Forest) -> np.ndarray:
        """P(content) of every node, by one upward and one downward pass of messages."""
        parent, _, levels = forest.arrays()
        odds = np.clip(forest.features() @ self.weights, -8, 8)
        own = -np.logaddexp(0, np.column_stack([odds, -odds]))  # log P(0), log P(1)
        tie = self.ties[np.array(forest.tag)[np.maximum(parent, 0)]]  # (node, parent label, own label)
        up = own.copy()
        message = np.zeros_like(own)
        for nodes in reversed(levels):
            message[nodes] = np.logaddexp.reduce(tie[nodes] + up[nodes, None, :], axis=2)
            np.add.at(up, parent[nodes], message[nodes])
        belief = up.copy()
        for nodes in levels:
            above = belief[parent[nodes]] - message[nodes]
            above -= above.max(1, keepdims=True)
            belief[nodes] = up[nodes] + np.logaddexp.reduce(tie[nodes] + above[:, :, None], axis=1)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))


def gold_labels(forest: Forest) -> np.ndarray:
    """A run's label is that of its page's marking; an element's, what most of the text under it has."""
    parent, _, levels = forest.arrays()
    chars = np.array([len(x) for x in forest.text], float)
    sums = np.column_stack([chars * np.array(forest.gold), chars])
    for nodes in reversed(levels):
        np.add.at(sums, parent[nodes], sums[nodes])
    return np.where(sums[:, 1] > 0, 2 * sums[:, 0] > sums[:, 1], np.array(forest.gold) > 0).astype(int)


def train(pages: list[str], ridge: float = 0.5, rounds: int = 25, smooth: float = 2.0) -> Model:
    """Fit on pages whose elements mark content with ``data-gold="1"``, and other parts inside with "0"."""
    forest = Forest()
    for page in pages:
        forest.page(page)
    x, y = forest.features(), gold_labels(forest)
    w = np.zeros(FEATURES)
    for _ in range(rounds):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(FEATURES)
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    parent = np.array(forest.parent)
    child = np.flatnonzero(parent >= 0)
    counts = np.zeros((len(TAGS), 2, 2))
    np.add.at(counts, (np.array(forest.tag)[parent[child]], y[parent[child]], y[child]), 1)
    every = counts.sum(0) + 1
    every = every / every.sum(1, keepdims=True)
    given = (counts + 2 * smooth * every) / (counts.sum(2, keepdims=True) + 2 * smooth)
    share = y[child].mean()
    return Model(w, np.log(given) - np.log(np.array([1 - share, share])))


#: Elements around the content of a training page.
LAYOUTS = (
    ("<article{g}>", "</article>"), ("<article{g}>", "</article>"), ("<main{g}>", "</main>"), ("<main><article{g}>", "</article></main>"), ('<div class="content"{g}>', "</div>"), ('<div id="content"><div class="post"{g}>', "</div></div>"),
    ('<div class="entry-content"{g}>', "</div>"), ('<section class="article-body"{g}>', "</section>"), ("<div{g}>", "</div>"), ('<div id="main"{g}>', "</div>"), ('<div class="wrap"><div{g}>', "</div></div>"),
)


def labelled_pages(n: int = 240, seed: int = 11, layouts: Sequence[tuple[str, str]] = LAYOUTS) -> list[str]:
    """Labelled training pages: layouts that sites use, filled with made-up words."""
    r = random.Random(seed)
    bits = "an be co di en for ga hi in ja ka lo me no on per qui re sa ti un ver wa xi yo zu th er ing tion ent ou le der sch".split()

    def word() -> str:
        return "".join(r.choice(bits) for _ in range(r.randint(1, 4)))

    def sentence(a: int = 1, b: int = 18) -> str:
        return " ".join(word() + ("," if r.random() < 0.08 else "") for _ in range(r.randint(a, b))).capitalize() + "."

    def prose(a: int = 1, b: int = 6) -> str:
        return " ".join(sentence() for _ in range(r.randint(a, b)))

    def label() -> str:
        text = " ".join(word() for _ in range(r.choice([1, 1, 1, 2, 3, 6]))) + r.choice(["", "", "", ",", ".", "!", "?"])
        return text.capitalize() if r.random() < 0.5 else text

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{word()}">{label()}</a></li>' for _ in range(k)) + "</ul>"

    def boilerplate(kind: str) -> str:
        a = prose(1, 2)
        if kind == "nav":
            return r.choice([f"<nav>{links(r.randint(3, 8))}</nav>", f'<div class="menu">{links(r.randint(3, 8))}</div>', f'<ul id="nav">{links(4)[4:]}', f'<div role="navigation">{links(5)}</div>'])
        if kind == "header":
            return r.choice([f"<header><h1>{word()}</h1><p>{sentence(1, 6)}</p></header>", f'<div id="header"><a href="/">{word()}</a> {sentence(1, 5)}</div>', f'<div class="site-header"><h2>{word()} {word()}</h2></div>'])
        if kind == "ad":
            return r.choice([f'<div class="ad">{a}</div>', f'<div class="advert"><p>{a}</p></div>', f'<aside class="sponsored"><a href="#">{a}</a></aside>', f'<div class="ad">{prose(2, 5)}</div>', f'<div id="banner-ad">{sentence()}</div>'])
        if kind == "aside":
            return r.choice([f'<aside><h3>{word()}</h3>{links(4)}</aside>', f'<div class="sidebar"><p>{a}</p>{links(3)}</div>', f'<div id="sidebar"><h2>{word()}</h2><p>{prose(1, 4)}</p></div>', f"<aside><p>{prose(1, 4)}</p></aside>"])
        if kind == "notice":
            return r.choice([f'<div class="cookie-notice">{a} <button>{word()}</button></div>', f'<div class="notice"><p>{prose(1, 6)}</p></div>', f'<div id="consent"><p>{a}</p></div>', f'<div role="alert">{a}</div>'])
        if kind == "form":
            return r.choice([f'<form action="/s"><label>{word()}</label><input name="q"><button>{word()}</button></form>', f'<form class="newsletter"><p>{a}</p><input type="email"><button>{word()}</button></form>', f'<div class="search"><form><input></form>{word()}</div>'])
        if kind == "comments":
            own = "".join(f'<{t} class="comment"><b>{word()}</b><p>{prose(1, 4)}</p></{t}>' for t in [r.choice(["div", "li", "article"])] * r.randint(1, 5))
            return r.choice([f'<section class="comments"><h2>{word()}</h2>{own}</section>', f'<div id="comments">{own}</div>', f'<ol class="comment-list">{own}</ol>'])
        if kind == "related":
            return r.choice([f'<div class="related"><h3>{word()}</h3>{links(4)}</div>', f'<section class="share">{links(3)}</section>', f"<div>{links(6)}</div>"])
        return r.choice(
            [
                f"<footer>&copy; {word()}.example.net &middot; {prose(1, 4)}</footer>", f"<footer>{prose(1, 6)}</footer>", f"<footer>&copy; {word()} - {prose(1, 2)}\n{prose(1, 3)}</footer>", f'<div id="footer"><p>&copy; {word()} {sentence()}</p>{links(3)}</div>',
                f'<div class="footer">{a} &copy; 2020</div>', f"<footer><p>{prose(1, 2)}</p>{links(4)}</footer>",
            ]
        )

    def content() -> str:
        out = []
        if r.random() < 0.55:
            out.append(f"<h1>{sentence(3, 10)}</h1>")
        for i in range(r.choice([1, 1, 2, 3, 4, 6, 9])):
            kind = r.random()
            text = r.choice([prose(1, 1), prose(1, 4), prose(3, 12), sentence(1, 2)])
            if kind < 0.08:
                out.append(f"<h2>{sentence(1, 6)}</h2>")
            elif kind < 0.14:
                out.append("<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif kind < 0.18:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.21:
                out.append(f"<table><tr><td>{sentence(1, 4)}</td><td>{sentence(1, 4)}</td></tr></table>")
            elif kind < 0.30:
                out.append(f'<p>{text} <a href="/{word()}">{word()} {word()}</a> {sentence()}</p>')
            elif kind < 0.42:
                out.append(f"<p><b>{text}<br>")
            elif kind < 0.50:
                out.append(f"<p>{text}")
            elif kind < 0.56:
                out.append(f"{text}<br>{sentence()}<br>")
            else:
                out.append(f"<p>{text}</p>")
            if i and r.random() < 0.06:
                out.append(boilerplate(r.choice(["ad", "related", "form"])).replace(">", ' data-gold="0">', 1))
        return "".join(out)

    pages = []
    for _ in range(n):
        opening, ending = r.choice(layouts)
        body = opening.format(g=' data-gold="1"') + content() + ending
        before = "".join(boilerplate(k) for k in ("header", "nav", "notice", "ad", "form", "aside") if r.random() < 0.5)
        after = "".join(boilerplate(k) for k in ("related", "comments", "aside", "ad", "form", "notice", "footer") if r.random() < 0.5)
        pages.append(f"<!DOCTYPE html><html><head><title>{sentence(2, 6)}</title><style>p{{margin:0}}</style><script>var a='</p>';</script></head><body>{before}{body}{after}</body></html>")
    return pages


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train(labelled_pages())


def extract(pages: list[str], model: Model, threshold: float = 0.5) -> list[str]:
    """The main text of each page."""
    forest = Forest()
    for page in pages:
        forest.page(page)
    p = model.marginals(forest)
    out = []
    for a, b in zip(forest.roots, [*forest.roots[1:], len(forest.parent)], strict=True):
        blocks: dict[int, list[str]] = {}
        for i in range(a, b):
            if forest.text[i] and p[i] >= threshold:
                blocks.setdefault(forest.block[i], []).append(forest.text[i])
        lines = (_SPACE.sub(" ", "".join(x)).strip() for x in blocks.values())
        out.append("\n".join(x for x in lines if x))
    return out


def extract_pages(pages: DataFrame, model: Model | None = None, chars: int = 1_000_000) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    Null and empty html gives an empty text, as does a page without content;
    nothing is dropped or cut. Unclosed and misnested tags are repaired as they
    come, and elements nested deeper than ``DEEPEST`` hang on the one at that
    depth. Repeated rows are extracted each; other columns are not read. No
    shuffle; a task holds the trees of about ``chars`` characters at a time, and
    takes time linear in a page, whatever its markup.
    """
    held = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .tokens import blocks

        for batch in batches:
            sources = batch.column("html").to_pylist()
            for a, b in blocks(sources, chars):
                texts = extract(sources[a:b], held.value)
                own = [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *own], names=["page_id", "url", "text", "n_chars"])

    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return read.mapInArrow(lean(extracted), "page_id long, url string, text string, n_chars long")
