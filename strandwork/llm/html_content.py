"""Main text of web pages by a tree-structured graphical model.

A page is read into a tree of elements and runs of text. Each node is content or not; unary potentials come from its tag,
its class, id and role, and figures of its text; a parent and its child share a potential that depends on the child's kind.
Sum-product messages, once up and once down the tree, give every node's exact marginal, and runs of text whose marginal is
above one half are the main text. The potentials are trained on labelled pages by the exact gradient (observed counts minus
expected ones); the labelled pages are made by a seeded generator of page layouts, so nothing but this file is needed.

Many pages are one forest of numpy arrays: messages move level by level, not node by node.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# --- reading a page --------------------------------------------------------------------------------------------------

_OPEN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
#: What follows a tag's name; quotes mean something after an equals sign only.
_REST = re.compile(r"((?:[^\"'>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[\"'=])*+)>")
#: Tags of a page whose quotes hide every later ">" end at the first one; after so many of them quotes are no longer looked at.
UNQUOTED_AFTER = 16


class Scanner:
    """Tags and comments of a page from any place on, in linear time: what a caller skips (raw text) is never read as tags."""

    def __init__(self, source: str):
        self.source, self.last, self.hidden, self.end = source, source.rfind(">"), 0, len(source)

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(begin, end, closing, name, attributes) of the first tag from ``at`` on; a comment has no name. A tag that nothing ends is markup up to
        the page's end, which ``end`` then marks."""
        source = self.source
        while (at := source.find("<", at)) >= 0:
            m = _OPEN.match(source, at)
            if not m:
                at += 1
                continue
            if not m[3]:
                mark = "-->" if m[1] else ">"
                to = source.find(mark, m.end())
                return at, (to + len(mark) if to >= 0 else len(source)), False, "", ""
            if at > self.last:
                self.end = at
                return None
            rest = _REST.match(source, m.end()) if self.hidden < UNQUOTED_AFTER else None
            if rest:
                return at, rest.end(), bool(m[2]), m[3].lower(), rest[1]
            self.hidden += 1
            to = source.find(">", m.end())
            return at, to + 1, bool(m[2]), m[3].lower(), source[m.end() : to]
        return None


# The standard's void, raw-text, paragraph-closing and block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style template iframe svg textarea title audio video select datalist head annotation annotation-xml".split())
RAW = frozenset("script style textarea title iframe".split())
#: What can stand in a head, what ends an open select, where HTML can stand inside svg or math, and what ends those elsewhere.
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template noframes head html".split())
ENDS_SELECT = frozenset("select input textarea".split())
HTML_POINTS = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
SECTION = frozenset("article section nav aside header footer main form dialog menu search".split())
BLOCK = SECTION | frozenset("address blockquote body center dd details dir div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html legend li ol optgroup option p pre summary table tbody td tfoot th thead tr ul caption br button".split())
CLOSES_P = BLOCK - frozenset("br td th tr tbody thead tfoot caption body html button option optgroup legend".split())
ENDS_FOREIGN = BLOCK - frozenset("a button form main section article nav aside header footer caption td th tr tbody thead tfoot option optgroup legend".split()) | frozenset("img span strong em b i small sup sub".split())
#: A start tag ends an open element of these kinds, up to one of the fences.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "tbody", "thead", "tfoot")), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)), "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
}

TAGS = ("#text", "article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "li", "table", "td", "a", "nav", "header", "footer", "aside", "form", "button", "label", "blockquote", "pre", "figure", "inline", "body", "dialog", "address", "other")
_TAG = {t: k for k, t in enumerate(TAGS)} | {t: "h3" for t in ("h4", "h5", "h6")} | {"ol": "ul", "dl": "ul", "menu": "ul", "dd": "li", "dt": "li", "th": "td", "input": "form", "fieldset": "form", "legend": "label", "figcaption": "figure", "html": "body", "search": "form", "code": "pre"}
_TAG |= {t: "inline" for t in "b i em strong span u s small sub sup mark q cite abbr time font tt kbd samp var del ins bdi bdo data dfn wbr big strike ruby rt rp".split()}
_TAG = {t: (k if isinstance(k, int) else TAGS.index(k)) for t, k in _TAG.items()}

# Words in class, id and role, by what they tell; a longer word counts if it is one of five letters or more with an ending of COMPOUNDS.
KINDS: tuple[tuple[str, str], ...] = (
    ("comment", "comment comments reply replies discuss discussion disqus respond commentlist thread guestbook"),
    ("advert", "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion adsense adslot banner-ad partner"),
    ("notice", "cookie cookies consent gdpr notice notices popup modal overlay alert newsletter subscribe subscription paywall toast warning disclaimer announcement alertdialog dialog"),
    ("menu", "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc skip"),
    ("side", "sidebar side aside widget widgets related recommended recommendations trending popular more complementary rail teaser"),
    ("share", "share sharing social follow like buttons"),
    ("footer", "footer foot bottom copyright legal contentinfo colophon imprint"),
    ("header", "header masthead top topbar logo banner branding hero"),
    ("form", "form search login signin signup register contact poll vote"),
    ("meta", "meta byline author date timestamp tag tags category categories labels credit posted"),
    ("hidden", "hidden sr-only invisible offscreen"),
    ("title", "title headline heading"),
    ("content", "content article post entry story main body text prose page-content articlebody hentry markdown copy paragraph lead"),
)
_WORD_KIND = {w: k + 1 for k, (_, ws) in reversed(list(enumerate(KINDS))) for w in ws.split()}
COMPOUNDS = frozenset("s es list lists box boxes area wrap wrapper container section block blocks left right top inner outer bar item items link links text unit slot zone form panel group row col column thread count body holder".split())
_LONG = sorted((w for w in _WORD_KIND if len(w) >= 5), key=lambda w: (-len(w), w))
N_KINDS = len(KINDS) + 1
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'""")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[a-z]+")


def kind_of(name: str) -> int:
    """The kind of a class, id or role value: the first in KINDS that one of its words tells; 0 for none."""
    best = 0
    for w in _NAMES.findall(name):
        w = w.lower()
        k = _WORD_KIND.get(w) or next((_WORD_KIND[x] for x in _LONG if w.startswith(x) and w[len(x) :] in COMPOUNDS), 0)
        best = k if k and (not best or k < best) else best
    return best


def _read_attributes(text: str) -> int:
    """The kind that an element's attributes tell."""
    kind = 0
    for name, value in _ATTR.findall(text):
        value = value.strip("\"'")
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            kind = _WORD_KIND["hidden"]
        elif name in ("class", "id", "role") and (k := kind_of(value)) and (not kind or k < kind):
            kind = k
    return kind


_known_attributes = lru_cache(maxsize=20_000)(_read_attributes)


def _attributes(text: str) -> int:
    """_read_attributes of the whole text; long ones are not kept."""
    return _known_attributes(text) if len(text) <= 2000 else _read_attributes(text)


def _after_raw(source: str, name: str, at: int) -> int:
    """Where the element of raw text ends whose start tag ends at ``at``."""
    end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
    to = source.find(">", end.end()) if end else -1
    return to + 1 if to >= 0 else len(source)


def _left_open(source: str, name: str, at: int) -> bool:
    """Whether the next tag of that name is not an end tag."""
    found = re.compile(rf"<(/?){name}(?=[\s/>])", re.I).search(source, at)
    return not (found and found[1])


def _ends_dropped(name: str, closing: bool, inner: list[str], outer: list[tuple[str, int]], open_: bool) -> bool:
    """Whether a tag ends a dropped element without being its end tag.

    inner: the dropped element and what is open in it; outer: what it stands in; open_: it seems to have no end tag.
    """
    drop = inner[0]
    if closing:
        return name not in inner and any(x == name for x, _ in outer)
    if drop == "head":
        return name == "body" or (len(inner) == 1 and name not in IN_HEAD)
    if drop == "select" and name in ENDS_SELECT:
        return True
    if drop in ("svg", "math"):
        return name in ENDS_FOREIGN and HTML_POINTS.isdisjoint(inner)
    if name in SIBLINGS:
        ends, fences = SIBLINGS[name]
        if not any(x in ends or x in fences for x in inner):
            for x, _ in reversed(outer):
                if x in fences:
                    break
                if x in ends:
                    return True
    if open_ and name in CLOSES_P and "p" not in inner:
        for x, _ in reversed(outer):
            if x == "p":
                return True
            if x in SECTION or x in ("div", "td", "li", "blockquote", "body"):
                break
    return False


_MARK = re.compile(r'\bdata-y="([01])"')


class Tree:
    """Nodes of one page in page order: the root first, parents before their children.

    marks: whether to read the labels of training pages (data-y, 0 or 1; -1 for none).
    """

    def __init__(self, source: str, marks: bool = False):
        self.tag, self.parent, self.depth, self.kind, self.label, self.text, self.block = [_TAG["body"]], [0], [0], [0], [-1], [""], [0]
        stack: list[tuple[str, int]] = [("#root", 0)]
        count = Counter(["#root"])  # what is open, so that nothing is looked for in vain
        block = at = 0
        inner: list[str] = []  # an element whose text is dropped, and what is open in it
        open_ = False

        def add(tag: int, kind: int, label: int, text: str) -> int:
            self.tag.append(tag)
            self.parent.append(stack[-1][1])
            self.depth.append(self.depth[stack[-1][1]] + 1)
            self.kind.append(kind)
            self.label.append(label)
            self.text.append(text)
            self.block.append(block)
            return len(self.tag) - 1

        def close(k: int) -> None:
            count.subtract(n for n, _ in stack[k:])
            del stack[k:]

        scanner = Scanner(source)
        while found := scanner.next(at):
            start, end, closing, name, said = found
            run = source[at:start]
            if inner == ["head"] and run.strip():  # no text can stand in a head
                inner = []
            if not inner and run:
                if run.strip():
                    add(0, 0, -1, html.unescape(run))
                elif len(self.text) > 1 and self.tag[-1] == 0 and self.block[-1] == block:
                    self.text[-1] += " "
                else:
                    add(0, 0, -1, " ")
            at = end
            if not name:
                continue
            empty = said.rstrip().endswith("/")
            if inner and not _ends_dropped(name, closing, inner, stack, open_):
                if closing:
                    for k in range(len(inner) - 1, -1, -1):
                        if inner[k] == name:
                            del inner[k:]
                            break
                elif inner[0] in ("svg", "math") and empty:
                    pass
                elif name in RAW:
                    at = _after_raw(source, name, at)
                elif name not in VOID and not (inner[0] == "head" and (name in ("head", "html") or (name == "noscript" and _left_open(source, name, at)))):
                    inner.append(name)
                continue
            inner = []
            if closing:
                if name in BLOCK:
                    block += 1
                for k in range(len(stack) - 1, 0, -1) if count[name] > 0 else ():
                    if stack[k][0] == name:
                        close(k)
                        break
                    if name not in BLOCK and stack[k][0] in BLOCK:
                        break
                continue
            if name in BLOCK:
                block += 1
            if name in RAW:
                at = _after_raw(source, name, at)
                continue
            if name in DROPPED:
                if not empty:
                    inner, open_ = [name], _left_open(source, name, at)
                continue
            if name in SIBLINGS:
                ends, fences = SIBLINGS[name]
                for k in range(len(stack) - 1, 0, -1) if any(count[x] > 0 for x in ends) else ():
                    if stack[k][0] in fences:
                        break
                    if stack[k][0] in ends:
                        close(k)
                        break
            if name in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1) if count["p"] > 0 else ():
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in SECTION or stack[k][0] in ("div", "td", "li", "blockquote", "body"):
                        break
            if name in VOID:
                continue
            mark = _MARK.search(said) if marks else None
            count[name] += 1
            stack.append((name, add(_TAG.get(name, _TAG["other"]), _attributes(said), int(mark[1]) if mark else -1, "")))
        if (not inner or inner == ["head"]) and source[at : scanner.end].strip():
            add(0, 0, -1, html.unescape(source[at : scanner.end]))


# --- the model -------------------------------------------------------------------------------------------------------

_INLINE = (_TAG["#text"], _TAG["inline"], _TAG["a"])
_SECTIONS = tuple(_TAG[t] for t in ("article", "main", "section", "nav", "header", "footer", "aside", "form", "dialog", "address"))
FIGURES = 9
EDGES = 4


@dataclass
class Forest:
    """Many pages side by side."""

    tag: np.ndarray
    kind: np.ndarray
    parent: np.ndarray  # -1 for roots
    depth: np.ndarray
    edge: np.ndarray  # kind of the edge to the parent
    figures: np.ndarray
    levels: list[np.ndarray]
    place: np.ndarray  # of each node in its level

    def to_parents(self, level: int, values: np.ndarray) -> np.ndarray:
        """Sums of one level's values by parent, for all nodes of the level above: work in proportion to the two levels."""
        return np.bincount(self.place[self.parent[self.levels[level]]], values, len(self.levels[level - 1]))

    @classmethod
    def of(cls, trees: list[Tree]) -> Forest:
        sizes = [len(t.tag) for t in trees]
        shift = np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        page = np.repeat(np.arange(len(trees)), sizes)
        flat = lambda name: np.array([x for t in trees for x in getattr(t, name)], np.int64)
        tag, kind, depth = flat("tag"), flat("kind"), flat("depth")
        parent = flat("parent") + shift
        parent[depth == 0] = -1
        by_depth = np.argsort(depth, kind="stable")
        levels = np.split(by_depth, np.searchsorted(depth[by_depth], np.arange(1, int(depth.max()) + 1)))
        place = np.empty(len(tag), np.int64)
        for level in levels:
            place[level] = np.arange(len(level))
        out = cls(tag, kind, parent, depth, tag, tag, levels, place)
        chars = np.array([len(x) for t in trees for x in t.text], float)
        marks = np.array([(x.count(".") + x.count(",") + x.count("!") + x.count("?")) if len(x) > 1 else 0 for t in trees for x in t.text], float)
        linked = np.zeros(len(tag), bool)
        for level in levels[1:]:
            linked[level] = linked[parent[level]] | (tag[level] == _TAG["a"])
        total = np.stack([chars, chars * linked, marks, (tag == _TAG["p"]).astype(float), (tag == _TAG["a"]).astype(float)], 1)
        for k in range(len(levels) - 1, 0, -1):
            for c in range(total.shape[1]):
                total[levels[k - 1], c] += out.to_parents(k, total[levels[k], c])
        n, in_links, dots, paras, links = total.T
        page_chars = n[levels[0]][page]
        out.figures = np.stack([
            np.ones(len(tag)), np.log1p(n) / 6, in_links / (n + 1), np.minimum(dots / (n + 20) * 20, 2), np.minimum(n / (page_chars + 1), 1),
            np.log1p(paras) / 2, np.log1p(links) / 2, linked.astype(float), np.minimum(depth, 12) / 12,
        ], 1)
        out.edge = np.where(tag == 0, 0, np.where(np.isin(tag, _INLINE), 1, np.where(np.isin(tag, _SECTIONS), 2, 3)))
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


@dataclass
class Model:
    """Log potentials: of content against none by tag and leaf, kind and tag group, figures; pairs by edge kind [parent, child]."""

    tag: np.ndarray
    kind: np.ndarray
    figures: np.ndarray  # [leaf or element, figure]
    pair: np.ndarray

    @classmethod
    def blank(cls) -> Model:
        return cls(np.zeros(len(TAGS)), np.zeros(N_KINDS), np.zeros((2, FIGURES)), np.zeros((EDGES, 2, 2)))

    def marginals(self, f: Forest, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """P(content) of each node and, if asked, P(parent, child) of each edge: sum-product, up and down."""
        own = np.zeros((len(f.tag), 2))
        own[:, 1] = self.tag[f.tag] + self.kind[f.kind] + (f.figures * self.figures[(f.tag != 0).astype(int)]).sum(1)
        below = own  # potentials with all that lies below
        up = np.zeros_like(own)
        for k in range(len(f.levels) - 1, 0, -1):
            level = f.levels[k]
            up[level] = _log_sum(below[level][:, None, :] + self.pair[f.edge[level]], 2)
            for y in (0, 1):
                below[f.levels[k - 1], y] += f.to_parents(k, up[level, y])
        joint = np.zeros((len(f.tag), 2, 2)) if pairs else None
        full = below.copy()
        for level in f.levels[1:]:
            above = full[f.parent[level]] - up[level]
            both = above[:, :, None] + self.pair[f.edge[level]] + below[level][:, None, :]
            full[level] = _log_sum(both, 1)
            if joint is not None:
                z = np.exp(both - both.max((1, 2), keepdims=True))
                joint[level] = z / z.sum((1, 2), keepdims=True)
        return 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -60, 60))), joint


def train(pages: list[str], rounds: int = 250, rate: float = 0.08, ridge: float = 2e-4) -> Model:
    """Fits to pages whose elements carry data-y marks (inherited by what is inside; none: not content); Adam ascent."""
    trees = [Tree(p, marks=True) for p in pages]
    f = Forest.of(trees)
    y = np.array([x for t in trees for x in t.label], np.int64)
    for level in f.levels:
        inherited = np.where(f.parent[level] >= 0, y[f.parent[level]], 0)
        y[level] = np.where(y[level] >= 0, y[level], np.maximum(inherited, 0))
    model = Model.blank()
    n = len(trees)
    edges = np.flatnonzero(f.parent >= 0)
    seen = np.zeros((EDGES, 2, 2))
    np.add.at(seen, (f.edge[edges], y[f.parent[edges]], y[edges]), 1)
    leaf = (f.tag != 0).astype(int)
    parts = ["tag", "kind", "figures", "pair"]
    first = {p: np.zeros_like(getattr(model, p)) for p in parts}
    second = {p: np.zeros_like(getattr(model, p)) for p in parts}
    for t in range(1, rounds + 1):
        p, joint = model.marginals(f, pairs=True)
        off = y - p
        figures = np.stack([(f.figures * (off * (leaf == k))[:, None]).sum(0) for k in (0, 1)])
        expected = np.stack([joint[edges][f.edge[edges] == k].sum(0) for k in range(EDGES)])
        step = {"tag": np.bincount(f.tag, off, len(TAGS)), "kind": np.bincount(f.kind, off, N_KINDS), "figures": figures, "pair": seen - expected}
        for name in parts:
            g = step[name] / n - ridge * getattr(model, name) * 10
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.99 * second[name] + 0.01 * g * g
            setattr(model, name, getattr(model, name) + rate * (first[name] / (1 - 0.9**t)) / (np.sqrt(second[name] / (1 - 0.99**t)) + 1e-8))
    return model


# --- labelled pages --------------------------------------------------------------------------------------------------


class Maker:
    """Labelled pages of many layouts; data-y marks what is content (1) and what within it is not (0)."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def pick(self, words: str) -> str:
        return self.r.choice(words.split("|"))

    def words(self, least: int, most: int) -> str:
        syllables = "ba ke lo mi nu ra so ti va we ze on er an th".split()
        out = ["".join(self.r.choice(syllables) for _ in range(self.r.randint(1, 4))) for _ in range(self.r.randint(least, most))]
        for k in range(len(out)):
            if self.r.random() < 0.12:
                out[k] += self.r.choice(".,.,!?&amp;")
        return " ".join(out).capitalize()

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{self.r.randint(1, 99)}">{self.words(1, 3)}</a></li>' for _ in range(n))

    def named(self, names: str) -> str:
        x = self.r.random()
        if x < 0.12:
            return ""
        if x < 0.56:  # half of the names tell nothing
            return f' class="{self.words(1, 2).lower()}"'
        key = self.r.choice(("class", "class", "class", "id"))
        return f' {key}="{self.r.choice(("", "", "site-", "page-", "c-"))}{self.pick(names)}"'

    def nav(self) -> str:
        items = self.links(self.r.randint(2, 9))
        return self.r.choice((f"<nav><ul>{items}</ul></nav>", f"<div{self.named('menu|navbar|nav|main-menu|breadcrumbs')}><ul>{items}</ul></div>", f"<ul{self.named('menu|nav|tabs')}>{items}</ul>", f"<nav>{self.words(1, 4)} {items}</nav>"))

    def header(self) -> str:
        inner = self.r.choice((f"<h1>{self.words(1, 4)}</h1>", f"<a href='/'>{self.words(1, 3)}</a><p>{self.words(3, 12)}</p>", f"<div class='logo'>{self.words(1, 2)}</div>"))
        inner += self.nav() if self.r.random() < 0.4 else ""
        return self.r.choice((f"<header>{inner}</header>", f"<div{self.named('header|masthead|topbar|banner')}>{inner}</div>"))

    def footer(self) -> str:
        inner = self.r.choice((f"&copy; {self.words(1, 3)} &middot; {self.words(2, 14)}", f"<p>{self.words(2, 30)}</p>", f"<p>&copy; {self.words(2, 6)}</p><ul>{self.links(3)}</ul>"))
        return self.r.choice((f"<footer>{inner}</footer>", f"<footer>{inner}</footer>", f"<div{self.named('footer|bottom|copyright|legal')}>{inner}</div>"))

    def aside(self) -> str:
        inner = f"<h3>{self.words(1, 4)}</h3>" + self.r.choice((f"<ul>{self.links(self.r.randint(2, 6))}</ul>", f"<p>{self.words(4, 40)}</p>"))
        return self.r.choice((f"<aside>{inner}</aside>", f"<div{self.named('sidebar|widget|related|recommended|side')}>{inner}</div>", f"<aside{self.named('sidebar|related')}>{inner}</aside>"))

    def advert(self) -> str:
        inner = self.r.choice((self.words(2, 30), f"<p>{self.words(3, 30)}</p>", f"<a href='#'>{self.words(2, 9)}</a>", f"{self.words(3, 9)}\n{self.words(3, 9)}\n{self.words(2, 6)}"))
        return f'<{"div" if self.r.random() < 0.85 else "section"} class="{self.pick("ad|ads|advert|advertisement|sponsored|promo|ad-slot|ad banner")}">{inner}</div>'

    def notice(self) -> str:
        inner = f"<p>{self.words(5, 40)}</p>" + self.r.choice(("", "<button>Ok</button>", f"<a href='#'>{self.words(1, 2)}</a>"))
        return f'<div {self.r.choice(("class", "id"))}="{self.pick("cookie-banner|cookie-notice|consent|notice|gdpr|newsletter|popup|modal|alert")}">{inner}</div>' if self.r.random() < 0.9 else f"<dialog>{inner}</dialog>"

    def form(self) -> str:
        inner = f"<label>{self.words(1, 4)}</label><input name=q><textarea>{self.words(2, 6)}</textarea><select><option>{self.words(1, 2)}</select><button>{self.words(1, 2)}</button>"
        return f"<form{self.named('search|login|contact|signup')}>{'<p>' + self.words(2, 15) + '</p>' if self.r.random() < 0.5 else ''}{inner}</form>"

    def comments(self) -> str:
        each = lambda: self.r.choice((f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.words(4, 70)}</p></div>', f"<li><p>{self.words(4, 70)}</p></li>", f"<article class='comment'><p>{self.words(4, 60)}</p></article>"))
        inner = f"<h2>{self.words(1, 2)}</h2>" + "".join(each() for _ in range(self.r.randint(1, 6)))
        return f'<{self.pick("section|div|div|ol")} {self.r.choice(("class", "id"))}="{self.pick("comments|comment-list|discussion|replies|disqus|respond|user-comments")}">{inner}</div>'.replace("<ol", "<div").replace("<section", "<div")

    def block(self) -> str:
        x = self.r.random()
        text = self.words(*self.r.choice(((1, 4), (8, 40), (30, 120), (60, 200))))
        if x < 0.12:
            text = text.replace(" ", f' <a href="/x">{self.words(1, 3)}</a> ', 1)
        if x < 0.2:
            return f"<p><b>{text}<br>"
        if x < 0.24:
            return f"<ul{self.r.choice(('', ' class=list'))}>" + "".join(f"<li>{self.words(2, 20)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>"
        if x < 0.27:
            return f"<blockquote><p>{text}</p></blockquote>"
        if x < 0.3:
            return f"<h2>{self.words(1, 6)}</h2><p>{text}</p>"
        if x < 0.32:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 4)}</td></tr>" for _ in range(3)) + "</table>"
        if x < 0.34:
            return f"<figure><img src=a.png><figcaption>{self.words(3, 12)}</figcaption></figure>"
        if x < 0.36:
            return f"<pre>{self.words(3, 20)}</pre>"
        if x < 0.4:
            return f"<div>{text}</div>"
        return f"<p>{text}</p>"

    def article(self) -> str:
        r = self.r
        parts = [self.block() for _ in range(r.choice((0, 1, 1, 2, 3, 4, 6, 9, 14)))]
        for make, chance in ((self.advert, 0.12), (self.aside, 0.1), (self.form, 0.05), (self.notice, 0.05), (lambda: f'<div class="{self.pick("share|social|tags|related")}"><a href="#">{self.words(1, 2)}</a> <a href="#">{self.words(1, 2)}</a></div>', 0.12), (self.comments, 0.08)):
            if r.random() < chance and parts:
                parts.insert(r.randint(0, len(parts)), re.sub(r"^<(\w+)", r'<\1 data-y="0"', make()))
        head = r.choice((f"<h1>{self.words(1, 12)}</h1>", f"<h1>{self.words(1, 12)}</h1>", f"<h2>{self.words(1, 12)}</h2>", f"<header><h1>{self.words(1, 9)}</h1></header>", "" if parts else f"<p>{self.words(1, 5)}</p>"))
        inner = head + "".join(parts)
        x = r.random()
        if x < 0.55:
            return f'<article data-y="1"{self.named("post|entry|article|story") if r.random() < 0.4 else ""}>{inner}</article>'
        if x < 0.65:
            return f'<main data-y="1">{inner}</main>'
        if x < 0.72:
            return f'<section data-y="1"{self.named("content|article-body|post")}>{inner}</section>'
        return f'<div data-y="1"{self.named("content|main-content|article|post|entry-content|story|text|body")}>{inner}</div>'

    def page(self) -> str:
        r = self.r
        before = [f() for f, chance in ((self.notice, 0.2), (self.header, 0.45), (self.nav, 0.75), (self.advert, 0.45), (self.form, 0.12), (self.aside, 0.15)) if r.random() < chance]
        after = [f() for f, chance in ((self.comments, 0.3), (self.aside, 0.25), (self.advert, 0.15), (self.notice, 0.1), (self.form, 0.1), (self.footer, 0.8)) if r.random() < chance]
        if r.random() < 0.3:
            r.shuffle(before)
        inner = "".join(before) + self.article() + "".join(after)
        if r.random() < 0.3:
            inner = f'<div{self.named("wrapper|container|page|layout")}>{inner}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 9)}</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{inner}" + ("</body></html>" if r.random() < 0.9 else "")


def labelled_pages(n: int = 500, seed: int = 11) -> list[str]:
    maker = Maker(seed)
    return [maker.page() for _ in range(n)]


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train(labelled_pages())


# --- the operator ----------------------------------------------------------------------------------------------------


def main_texts(sources: list[str], model: Model) -> list[str]:
    """The main text of each page: blocks in page order, one line each, white space inside a block as one space."""
    trees = [Tree(s) for s in sources]
    p, _ = model.marginals(Forest.of(trees))
    out, at = [], 0
    for t in trees:
        lines: list[str] = []
        last = None
        bare = not any(t.tag[1:])  # a page without elements is its own text
        for k, text in enumerate(t.text):
            if t.tag[k] == 0 and text and (bare or p[at + k] > 0.5):
                if t.block[k] == last:
                    lines[-1] += text
                else:
                    lines.append(text)
                    last = t.block[k]
        at += len(t.tag)
        out.append("\n".join(x for x in (" ".join(line.split()) for line in lines) if x))
    return out


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html, any more columns).

    Null, empty and text-free pages give an empty text, one without elements is text as a whole, and a tag that nothing ends is none; broken markup is read as browsers do where it is common (open
    paragraphs, list items and cells, missing ends). What browsers show where an element is not supported (noscript, object,
    canvas) and formulas are text like any other; audio, video, drawings, frames and what fields hold are not. A run of text
    whose marginal is exactly one half is left out. Repeated rows give repeated rows. Pages are read whole, in groups of
    bounded size; a very long page makes a group of its own. Work grows with the nodes of a page, not with its depth.
    """
    held = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column("html")
            i = 0
            while i < len(sources):
                group, size = [], 0
                while i + len(group) < len(sources) and size < 1 << 20:
                    group.append(sources[i + len(group)].as_py() or "")
                    size += len(group[-1])
                texts = main_texts(group, held.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id").slice(i, len(group)), batch.column("url").slice(i, len(group)), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
                )
                i += len(group)

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
