"""Main-text extraction with a tree-structured graphical model.

A page is read into a tree of elements. Each element has a hidden state, content
or boilerplate; unary potentials come from its features (tag, attribute words,
text and link density, place in the page), edge potentials couple it with its
parent (one 2x2 table per kind of element). Sum-product messages go up from the
leaves and down from the root, one sweep each, and give every element's exact
marginal. The weights are the maximum-likelihood fit on labelled pages: whole
labelled page tables may be given (`fit`), and by default a generator writes them
(`training_pages`), so that no page of the table is ever needed for training.

All pages of a batch form one forest and each message pass handles a level at a
time, so the cost is linear in the text.

Text rules: character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by an empty line. Markup, comments, scripts,
styles, templates, drawings and form controls have no text. Defined results: null and
empty pages have the text '' and 0 characters; unclosed and stray tags follow the
usual recovery (a new block closes an open paragraph, an end tag without its start is
passed over); a drawing or control that isn't closed ends at the next block, a raw
element without its end tag (but scripts and styles) is passed over as a tag; a quote that
is never closed ends with its tag; text outside any block belongs to the body; elements below
MAX_DEPTH hang at that depth, as in browsers. Repeated pages get a row each. A
page of any size or nesting takes time linear in its length.
"""

from __future__ import annotations

import html as entities
import random
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm import textnp

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
#: Elements whose text isn't shown; they are read as a tree.
MUTE = frozenset("svg select annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img nobr math mi mn mo ms mtext mrow mfrac msqrt mroot msup msub msubsup mover munder munderover mstyle mspace mpadded mtable mtr mtd semantics".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: An opening tag on the left ends an open element on the right, up to the fence.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}

ENDS_MUTE = frozenset("li dt dd tr td th tbody body".split())

KINDS = ("html", "head", "body", "nav", "header", "footer", "aside", "main", "article", "section", "div", "p", "h", "list", "li", "table", "cell", "quote", "pre", "form", "figure", "address", "other")
_KIND = {k: i for i, k in enumerate(KINDS)} | {f"h{n}": KINDS.index("h") for n in range(1, 7)}
for _name, _tags in {"list": "ul ol dl menu dir", "li": "li dt dd", "table": "table tbody thead tfoot tr caption", "cell": "td th", "quote": "blockquote", "form": "form fieldset button input select textarea", "figure": "figure figcaption picture video audio"}.items():
    _KIND |= {t: KINDS.index(_name) for t in _tags.split()}
#: Words in class, id and role that speak for or against an element.
BAD_WORDS = ("nav", "menu", "footer", "header", "head", "side", "sidebar", "aside", "ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent", "notice", "popup", "modal", "share", "social", "related", "recommend", "recommended", "comment", "comments", "reply", "replies", "disqus", "breadcrumb", "breadcrumbs", "pagination", "pager", "login", "signup", "subscribe", "newsletter", "widget", "toolbar", "tags", "meta", "byline", "copyright", "legal", "search", "alert", "gdpr", "teaser", "outbrain", "masthead", "complementary", "contentinfo", "navigation", "respond", "form")
GOOD_WORDS = ("article", "content", "main", "post", "entry", "story", "body", "text", "page", "articlebody", "prose")
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_MARKUP = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
#: Of a tag, up to its end or to the next quoted value.
_PLAIN_ATTRS = re.compile(r"""[^>"']*""")
MAX_DEPTH = 512
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_BLANK = re.compile(r"\s+")

N_KIND = len(KINDS)
F_BAD, F_GOOD, F_HIDDEN, F_LINK, F_SHORT, F_LONG, F_STOP, F_NOTEXT, F_HEADING, F_BARE, F_BARE_BODY, F_BIAS = range(N_KIND, N_KIND + 12)
N_FEATURES = N_KIND + 12
#: Kinds that may hold running text.
PROSE = np.isin(np.arange(N_KIND), [KINDS.index(k) for k in ("body", "p", "h", "list", "li", "quote", "pre", "table", "cell")])


@lru_cache(maxsize=8192)
def attribute_marks(attrs: str) -> tuple[bool, bool, bool]:
    """Whether the attributes hold a word against, a word for, and a mark of being hidden."""
    bad = good = hidden = False
    for name, value in _ATTR.findall(attrs):
        low = name.lower()
        v = value.strip("\"'")
        if low == "hidden":
            hidden = True
        elif low == "aria-hidden":
            hidden |= v.lower() == "true"
        else:
            ws = set(_WORDS.findall(_CAMEL.sub(r"\1 \2", v).lower()))
            bad |= any(w in ws for w in BAD_WORDS)
            good |= any(w in ws for w in GOOD_WORDS)
    return bad, good, hidden


class Tags:
    """Reads the attributes and raw contents of a page's tags, each character a bounded number of times."""

    def __init__(self, page: str):
        self.page = page
        self.none_after = {'"': len(page) + 1, "'": len(page) + 1}  # from where on a quote is known not to occur
        self.closes: dict[str, tuple[int, int | None]] = {}  # of an element: from where searched, end of its end tag

    def attributes(self, at: int) -> tuple[str, int]:
        """The attributes of a tag whose name ends at `at`, and where the tag ends."""
        page, first, from_ = self.page, at, at
        while True:
            m = _PLAIN_ATTRS.match(page, at)
            at = m.end()
            if at >= len(page):
                return page[first:], at
            quote = page[at]
            if quote == ">":
                return page[first:at], at + 1
            at += 1
            if page[from_ : at - 1].rstrip().endswith("="):  # otherwise a quote opens no value
                close = page.find(quote, at) if at < self.none_after[quote] else -1
                if close < 0:
                    self.none_after[quote] = min(self.none_after[quote], at)
                else:
                    at = close + 1
            from_ = at

    def close(self, name: str, at: int) -> int | None:
        """The end of the first end tag of a raw element at `at` or later, None without one."""
        from_, found = self.closes.get(name, (len(self.page) + 1, None))
        if from_ > at or (found is not None and found <= at):
            m = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(self.page, at)
            found = m.end() if m else None
            self.closes[name] = (at, found)
        return found


class Open:
    """The open elements of a page. An inline one has its block's number."""

    def __init__(self, root: int):
        self.names, self.nodes, self.blocks, self.linked, self.muted = ["html"], [root], [0], [0], [0]
        self.places: dict[str, list[int]] = {"html": [0]}  # of a name, where it stands among the open elements
        self.depth = [0]

    node = property(lambda self: self.nodes[-1])
    links = property(lambda self: self.linked[-1])
    mute = property(lambda self: self.muted[-1])

    def push(self, name: str, node: int, inline: bool = True, mute: bool = False) -> None:
        at = len(self.names)
        self.places.setdefault(name, []).append(at)
        self.names.append(name)
        self.depth.append(min(self.depth[-1] + (not inline), MAX_DEPTH))
        self.nodes.append(node)
        self.blocks.append(self.blocks[-1] if inline else at)
        self.linked.append(self.linked[-1] + (name == "a"))
        self.muted.append(self.muted[-1] + mute)

    def cut(self, at: int) -> None:
        for name in self.names[at:]:
            self.places[name].pop()
        for x in (self.names, self.nodes, self.blocks, self.linked, self.muted, self.depth):
            del x[at:]

    def last(self, name: str) -> int:
        """Where the innermost element of a name stands, 0 without one."""
        places = self.places.get(name)
        return places[-1] if places else 0

    def end(self, name: str) -> bool:
        """An end tag: whether it closed something."""
        at = self.last(name)
        if not at or (name in INLINE and at < self.blocks[-1]):
            return False
        self.cut(at)
        return True

    def leave(self, name: str) -> None:
        if self.last(name):
            self.cut(self.last(name))

    def leave_mute(self) -> None:
        while self.muted[-1]:
            self.cut(max(map(self.last, MUTE)))

    def close_p(self) -> None:
        at = self.blocks[-1]
        if at and self.names[at] == "p":
            self.cut(at)

    def close_first(self, ends: set[str], fence: set[str]) -> None:
        at = max(map(self.last, ends))
        if at > max(map(self.last, fence)):
            self.cut(at)


@dataclass
class Forest:
    """Elements of many pages, parents before children."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    attrs: list[str] = field(default_factory=list)
    texts: list[list[tuple[int, str]]] = field(default_factory=list)  # of an element: (order, text)
    linked: list[int] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    order: int = 0

    def add(self, tag: str, attrs: str, parent: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.texts.append([])
        self.linked.append(0)
        return len(self.tag) - 1

    def read(self, page: str) -> None:
        """Adds a page's tree: blocks as elements, inline text to the nearest block."""
        root = self.add("html", "", -1)
        self.roots.append(root)
        at, end = 0, len(page)
        tags, open_ = Tags(page), Open(root)
        while at < end:
            m = _MARKUP.search(page, at)
            to = m.start() if m else end
            if to > at and not open_.mute:
                self._text(open_.node, page[at:to], open_.links)
            if not m:
                break
            at = m.end()
            if m.group(2) is None:
                if m.group().startswith("<![CDATA[") and not open_.mute:
                    self._text(open_.node, m.group()[9:-3], open_.links)
                continue
            name = m.group(2).lower()
            attrs, at = tags.attributes(at)
            if m.group(1):
                if not open_.end(name) and name == "p":
                    self._gap(open_)
                continue
            if name in RAW:
                close = tags.close(name, at)
                if close is not None or name in ("script", "style"):
                    at = close if close is not None else end
                if name == "textarea":
                    self.add("form", attrs, open_.node)
                continue
            if name == "html":
                continue
            if name in CLOSES_P or name in ENDS_MUTE:
                open_.leave_mute()
            if name in CLOSES_P:
                open_.close_p()
            if name in IMPLIED:
                open_.close_first(*IMPLIED[name])
            if name == "body":
                open_.leave("head")
            if name in VOID:
                if name in ("br", "hr", "img", "input", "wbr"):
                    self._gap(open_, "" if name == "wbr" else " ")
                continue
            if name in MUTE:
                if name == "select":
                    self.add("form", attrs, open_.node)
                if not attrs.endswith("/"):
                    open_.push(name, open_.node, mute=True)
            elif name in INLINE or open_.mute:
                open_.push(name, open_.node)
            else:
                parent = open_.node if open_.depth[-1] < MAX_DEPTH else self.parent[open_.node]
                open_.push(name, self.add(name, attrs, parent), inline=False)

    def _gap(self, open_: Open, by: str = " ") -> None:
        if by and self.texts[open_.node] and not open_.mute:
            self._text(open_.node, by, 0)

    def _text(self, node: int, text: str, links: int) -> None:
        self.order += 1
        if "&" in text:
            text = entities.unescape(text)
        kept = self.texts[node]
        if kept and kept[-1][0] == self.order - 1:
            kept[-1] = (self.order, kept[-1][1] + text)
        else:
            kept.append((self.order, text))
        if links > 0:
            self.linked[node] += len(text)


def evidence(f: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature matrix, kinds (those with a word against them apart) and parents of the elements."""
    n = len(f.tag)
    x = np.zeros((n, N_FEATURES), np.float32)
    kind = np.asarray([_KIND.get(t, N_KIND - 1) for t in f.tag], np.int64)
    x[np.arange(n), kind] = 1
    marks = np.asarray([attribute_marks(a) if a else (False, False, False) for a in f.attrs], np.float32).reshape(n, 3)
    x[:, F_BAD : F_HIDDEN + 1] = marks
    own = np.zeros(n)
    stops = np.zeros(n)
    for i, parts in enumerate(f.texts):
        for _, t in parts:
            own[i] += len(t)
            stops[i] += t.count(".") + t.count(",") + t.count("!") + t.count("?")
    parent = np.asarray(f.parent, np.int64)
    total, linked = own.copy(), np.asarray(f.linked, float)
    for i in range(n - 1, -1, -1):
        p = parent[i]
        if p >= 0:
            total[p] += total[i]
            linked[p] += linked[i]
    x[:, F_LINK] = linked / np.maximum(total, 1)
    x[:, F_SHORT] = (own > 0) & (own < 60)
    x[:, F_LONG] = np.minimum(np.log1p(own) / 6, 1.5)
    x[:, F_STOP] = np.minimum(stops / 4, 1)
    x[:, F_NOTEXT] = own == 0
    x[:, F_HEADING] = kind == _KIND["h1"]
    # pages without any element that announces content keep it directly in the body
    told = (np.isin(kind, [KINDS.index(k) for k in ("article", "main", "section")]) & (marks[:, 0] == 0)) | (marks[:, 1] > 0)
    page = np.searchsorted(np.asarray(f.roots), np.arange(n), "right") - 1
    bare = (np.bincount(page, told, len(f.roots)) == 0)[page]
    x[:, F_BARE], x[:, F_BARE_BODY] = bare & PROSE[kind], bare & (kind == KINDS.index("body"))
    x[:, F_BIAS] = 1
    return x, kind + N_KIND * (marks[:, 0] > 0), parent


def levels(parent: np.ndarray) -> list[np.ndarray]:
    """Elements by depth."""
    depth = np.zeros(len(parent), np.int64)
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            depth[i] = depth[p] + 1
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max() + 1))) if len(depth) else []


@dataclass
class Model:
    unary: np.ndarray  # (N_FEATURES, 2)
    edge: np.ndarray  # (2 N_KIND, 2, 2): log potential of parent state, own state; what tells against a child so needn't tell against its parent

    def infer(self, x: np.ndarray, kind: np.ndarray, parent: np.ndarray, by_level: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, float]:
        """Marginals (n, 2), edge marginals (n, 2, 2; roots unused) and the log partition function."""
        score = x @ self.unary
        table = self.edge[kind]
        inside = score.astype(np.float64)
        up = np.zeros((len(score), 2))
        for rows in by_level[:0:-1]:
            up[rows] = np.logaddexp(table[rows, :, 0] + inside[rows, None, 0], table[rows, :, 1] + inside[rows, None, 1])
            for s in (0, 1):
                np.add.at(inside[:, s], parent[rows], up[rows, s])
        down = np.zeros_like(inside)
        for rows in by_level[1:]:
            p = parent[rows]
            rest = inside[p] + down[p] - up[rows]
            down[rows] = np.logaddexp(rest[:, 0, None] + table[rows, 0, :], rest[:, 1, None] + table[rows, 1, :])
        belief = inside + down
        z = np.logaddexp(belief[:, 0], belief[:, 1])
        marginal = np.exp(belief - z[:, None])
        has = parent >= 0
        both = np.zeros((len(score), 2, 2))
        p = parent[has]
        rest = inside[p] + down[p] - up[has]
        joint = rest[:, :, None] + table[has] + inside[has][:, None, :]
        both[has] = np.exp(joint - z[has][:, None, None])
        return marginal, both, float(z[~has].sum())


def fit_forest(f: Forest, y: np.ndarray, steps: int = 100, rate: float = 0.3, l2: float = 0.01) -> Model:
    """Gradient ascent on the likelihood of the labelled states (observed minus expected counts)."""
    x, kind, parent = evidence(f)
    x = x.astype(np.float64)
    by_level = levels(parent)
    m = Model(np.zeros((N_FEATURES, 2)), np.zeros((2 * N_KIND, 2, 2)))
    n_pages = max(len(f.roots), 1)
    seen_u = np.stack([x.T @ (y == s) for s in (0, 1)], axis=1)
    has = np.flatnonzero(parent >= 0)
    seen_e = np.zeros((2 * N_KIND, 2, 2))
    np.add.at(seen_e, (kind[has], y[parent[has]], y[has]), 1)
    gu, ge = np.full_like(m.unary, 1e-8), np.full_like(m.edge, 1e-8)
    for _ in range(steps):
        marginal, both, _ = m.infer(x, kind, parent, by_level)
        du = (seen_u - x.T @ marginal) / n_pages - l2 * m.unary
        want = np.stack([np.bincount(kind[has], both[has, i, j], 2 * N_KIND) for i in (0, 1) for j in (0, 1)], axis=1).reshape(2 * N_KIND, 2, 2)
        de = (seen_e - want) / n_pages - l2 * m.edge
        gu += du * du
        ge += de * de
        m.unary += rate * du / np.sqrt(gu)
        m.edge += rate * de / np.sqrt(ge)
    return m


#: What stands around the content of generated pages.
WRAPS = (*["<article data-y>{}</article>"] * 4, "<main data-y><article data-y>{}</article></main>", '<div class="content" data-y>{}</div>', '<div id="post-body" data-y>{}</div>', "<main data-y>{}</main>", "<section data-y>{}</section>", *["{}"] * 4)


def training_pages(n: int = 600, seed: int = 11) -> list[tuple[str, str]]:
    """Generated pages with their main text: (html, text). Content elements carry data-y in the page."""
    rng = random.Random(seed)
    syllables = [a + b for a in ("k", "l", "m", "n", "r", "s", "t", "v", "d", "h", "b", "") for b in ("a", "e", "i", "o", "u", "en", "er", "ing")]
    word = lambda: "".join(rng.choices(syllables, k=rng.randrange(1, 4)))
    pick = lambda *xs: rng.choice(xs)

    def prose(a: int, b: int) -> str:
        r = rng.random()
        if b >= 30 and r < 0.06:  # runs of one word, plain lists of words
            return " ".join([word() + pick("", ",")] * rng.randrange(20, 900))
        if b >= 11 and r < 0.12:
            return " ".join(word() for _ in range(rng.randrange(a, 4 * b)))
        return "".join(word() + pick(" ", " ", " ", " ", ", ", ". ", " &amp; ") for _ in range(rng.randrange(a, b))) + word() + pick(".", ".", "!", "")

    link = lambda: f'<a href="/{word()}">{word()}</a>'
    out = []
    for _ in range(n):
        good: list[str] = []

        def keep(tag: str, text: str, attrs: str = "") -> str:
            good.append(text)
            return f"<{tag} data-y{attrs}>{text}</{tag}>"

        items = "".join(f"<li>{link()}</li>" for _ in range(rng.randrange(2, 9)))
        bad_block = lambda: pick(
            f'<div class="{pick("ad", "ads banner", "advert", "sponsored", "promo")}">{pick(prose(2, 14), "<p>" + prose(2, 14) + "</p>", link())}</div>',
            f'<div class="{pick("cookie-notice", "notice", "alert popup", "newsletter subscribe")}"><p>{prose(4, 25)}</p></div>',
            f'<aside class="{pick("sidebar", "related", "widget")}"><h3>{word()}</h3><ul>{items}</ul>{pick("", "<p>" + prose(3, 30) + "</p>")}</aside>',
            f'<div class="{pick("breadcrumbs", "share social", "tags", "menu", "pagination")}">{link()} {link()} {link()}</div>',
            f'<p class="{pick("ad", "notice", "byline meta", "share", "sponsored")}">{prose(2, 14)}</p>',
            f'<ul class="{pick("menu", "nav", "social", "tags")}">{items}</ul>',
            f'<form action="/{word()}"><label>{word()}</label><input name="q"><button>{word()}</button>{pick("", "<p>" + prose(3, 12) + "</p>")}</form>',
        )
        said = lambda: pick(f'<{pick("div", "article", "li")} class="comment"><p>{prose(3, 60)}</p></div>', f"<li>{prose(3, 40)}</li>", f"<li><p>{prose(3, 40)}</p></li>")
        comments = lambda: f'<{pick("section", "div")} {pick("class", "id")}="{pick("comments", "comment-list", "replies", "user-comments", "reader-comments")}">{pick("", f"<h2>{word()}</h2>")}' + pick("{}", "<ol>{}</ol>", "<ul>{}</ul>").format("".join(said() for _ in range(rng.randrange(1, 5)))) + "</section>"
        # what stands within articles too, short ones included
        within = lambda: pick(
            f'<p class="{pick("byline", "byline meta", "meta", "notice", "ad", "share", "head", "copyright")}">{prose(1, 9)}</p>',
            f'<div class="{pick("ad", "ads banner", "promo", "sponsored", "newsletter")}">{pick(prose(1, 9), "<p>" + prose(1, 9) + "</p>", link())}</div>',
            f"<aside>{pick(prose(2, 20), '<p>' + prose(2, 20) + '</p>', f'<h3>{word()}</h3><ul>{items}</ul>')}</aside>",
            f'<div class="{pick("share", "social", "tags", "related")}">{link()} {link()}</div>',
            bad_block(),
        )
        body, short = [], rng.random() < 0.5
        if rng.random() < (0.5 if short else 0.85):
            head = keep("h1", prose(1, pick(11, 11, 40)))
            top = f'<{pick("div", "header")} data-y class="{pick("entry-header", "post-header", "article-head", "header")}">'
            body.append(pick(head, head, head, f"<header data-y>{head}</header>", f"<header data-y>{head}<p class='byline'>{prose(1, 6)}</p></header>", f"{top}{head}{top[1:top.index(' ')].join(('</', '>'))}"))
        inside = pick(0, 1, 1, 2, 3) if short else 0
        for _ in range(rng.randrange(1, 4) if short else rng.randrange(0, 12) or 1):
            r = rng.random() if not short else 0.03 + 0.79 * rng.random()
            if r < 0.03:  # one line over and over
                line = prose(1, 4)
                body.extend(keep("p", line) for _ in range(rng.randrange(10, 150)))
            elif r < 0.74:
                text = prose(1, 80) if rng.random() < 0.8 else prose(0, 3)
                if rng.random() < 0.2:
                    good.append(text)
                    body.append(f"<p data-y><b>{text}<br>")
                else:
                    body.append(keep("p", text))
            elif r < 0.82:
                body.append(keep("h2", prose(1, 6)))
            elif r < 0.88:
                body.append("<ul data-y>" + "".join(keep("li", prose(1, 20)) for _ in range(rng.randrange(2, 6))) + "</ul>")
            elif r < 0.92:
                body.append("<blockquote data-y>" + keep("p", prose(4, 30)) + "</blockquote>")
            elif r < 0.95:
                body.append("<table data-y>" + "".join("<tr data-y>" + "".join(keep("td", prose(0, 4)) for _ in range(2)) + "</tr>" for _ in range(2)) + "</table>")
            elif r < 0.97:
                body.append(keep("pre", prose(3, 20)))
            else:
                body.append(bad_block())
        for _ in range(inside):
            body.insert(rng.randrange(len(body) + 1), within())
        tail = [comments()] if rng.random() < 0.25 else []
        if rng.random() < 0.1:
            body.append(f"<footer>{prose(1, 9)}</footer>")
        inner = "".join(body) + (comments() if rng.random() < 0.2 else "")
        before = [f"<nav><ul>{items}</ul></nav>" if rng.random() < 0.8 else f"<header><div class='logo'>{word()}</div><ul>{items}</ul></header>"] + [bad_block() for _ in range(rng.randrange(0, 3))]
        after = [bad_block() for _ in range(rng.randrange(0, 3))] + [f"<footer>{pick('<p>' + prose(3, 14) + '</p>', '&copy; ' + prose(2, 14), link())}</footer>" if rng.random() < 0.85 else ""]
        around = pick(*WRAPS)
        page = f"<!DOCTYPE html><html><head><title>{prose(2, 8)}</title><style>p{{}}</style></head><body{' data-y' if around == '{}' else ''}>{''.join(before)}{around.format(inner)}{''.join(tail)}{''.join(after)}</body></html>"
        out.append((page, "\n\n".join(_BLANK.sub(" ", entities.unescape(g)).strip() for g in good)))
    return out


def states(f: Forest) -> np.ndarray:
    """Labels of a forest read from training pages: the elements marked data-y."""
    return np.asarray(["data-y" in a for a in f.attrs], np.int64)


@lru_cache(maxsize=4)
def default_model(n: int = 600, seed: int = 11) -> Model:
    f = Forest()
    for page, _ in training_pages(n, seed):
        f.read(page)
    y = states(f)
    f.attrs = [a.replace("data-y", "") for a in f.attrs]
    return fit_forest(f, y)


def fit(pages: DataFrame, bound: int = 2000) -> Model:
    """From at most bound labelled pages (html, text): elements whose text is among the page's text blocks are content."""
    f, y = Forest(), []
    for row in pages.select("html", "text").where("html is not null and text is not null").orderBy(F.xxhash64("html")).limit(bound).toLocalIterator():
        first = len(f.tag)
        f.read(row["html"])
        good = set(row["text"].split("\n\n"))
        own = [bool(f.texts[i]) and _BLANK.sub(" ", "".join(t for _, t in f.texts[i])).strip() in good for i in range(first, len(f.tag))]
        for i in range(len(f.tag) - 1, first, -1):
            if own[i - first] and f.parent[i] > first and f.tag[f.parent[i]] != "body":
                own[f.parent[i] - first] = True
        y += own
    return fit_forest(f, np.asarray(y, np.int64)) if y else default_model()


def extract_many(pages: list[str | None], model: Model, threshold: float = 0.5) -> list[str]:
    """The main text of each page."""
    f = Forest()
    for page in pages:
        f.read(page or "")
    x, kind, parent = evidence(f)
    content = model.infer(x, kind, parent, levels(parent))[0][:, 1] >= threshold
    out = []
    bounds = [*f.roots, len(f.tag)]
    for a, b in zip(bounds, bounds[1:]):
        content[a] |= b == a + 1  # a page without an element is its text
    for a, b in zip(bounds, bounds[1:]):
        parts = sorted((o, i, t) for i in range(a, b) if content[i] for o, t in f.texts[i])
        blocks, last = [], -1
        for o, i, t in parts:
            t = t if t.strip() or i == last else ""
            if i == last:
                blocks[-1] += t
            elif t:
                blocks.append(t)
                last = i
        out.append("\n\n".join(y for y in (_BLANK.sub(" ", z).strip() for z in blocks) if y))
    return out


def extract(pages: DataFrame, keep: list[str], model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """keep columns, text and n_chars of every page."""
    model = model or default_model()
    sent = pages.sparkSession.sparkContext.broadcast((model.unary, model.edge))
    kept = pages.select("html", *keep)

    def run(batches):
        m = Model(*sent.value)
        for batch in batches:
            at, sizes = 0, np.asarray([len(v) if v else 0 for v in batch.column(0).to_pylist()] or [0])
            while at < len(batch):
                n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), 1 << 20)))
                part = batch.slice(at, n)
                texts = extract_many(part.column(0).to_pylist(), m, threshold)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*keep, "text", "n_chars"])
                at += n

    return kept.mapInArrow(run, textnp.schema(kept, "text string, n_chars long", 1))
