"""Main text of web pages: boosted trees over DOM nodes, decoded down the hierarchy.

A tolerant parser turns a page into a tree of block elements whose leaves are runs of text. Each
node gets features: its tag, what its attributes' tokens and role say, the same of its ancestors,
text, link and mark-up density of its subtree, depth, and how it compares with its siblings. Boosted
regression trees give the log-odds that main text lies in a node. Decoding picks the set of nodes
of greatest total log-odds in which a dropped node has no kept descendant, so that choices for
ancestors and descendants can't contradict each other.

The trees are trained here, on pages that ``training_pages`` makes up from a seed: sites differ in
mark-up, names and order of their parts, and each run of text is known to be main text or not.
"""

from __future__ import annotations

import functools
import html as html_lib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: elements without end tag, elements whose content isn't text of the page,
#: block elements, and which open elements a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style noscript template head title textarea select option button svg math iframe object canvas audio video map datalist".split())
RAW = frozenset("script style textarea title iframe noscript".split())
#: What may stand in a head; elements that a start tag of their own kind ends; where block elements may stand in SVG and MathML.
IN_HEAD = frozenset("head title meta link base basefont bgsound style script noscript noframes template".split())
NO_NESTING = frozenset("select option button".split())
FOREIGN = frozenset("foreignobject annotation-xml desc".split())
BLOCK = frozenset(
    "html body main article section nav aside header footer address div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption form fieldset legend details summary dialog menu hgroup search center hr".split()
)
CLOSES_P = BLOCK - frozenset("html body tr td th thead tbody tfoot caption li dt dd legend".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "tfoot": ("table",)}

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>|<[!?][^>]*+>", re.S)
ATTR = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    """An element, or a run of text (tag ``#``) with its pieces."""

    __slots__ = ("tag", "attrs", "parent", "kids", "text", "chars", "linked", "runs", "depth", "start")

    def __init__(self, tag: str, attrs: str, parent: "Node | None", start: int):
        self.tag, self.attrs, self.parent, self.start = tag, attrs, parent, start
        self.kids: list[Node] = []
        self.text: list[str] = []
        self.chars = self.linked = self.runs = 0
        self.depth = parent.depth + 1 if parent else 0


def parse(page: str) -> Node:
    """The tree of block elements and runs of text; unclosed and stray tags are put up with."""
    root = node = Node("#root", "", None, 0)
    run: Node | None = None
    skip: str | None = None  # the outermost element whose content isn't text
    inner: dict[str, int] = {}  # block elements open inside it
    skip_depth = links = 0
    at = 0
    lowered = None
    for_raw = 0
    for m in MARKUP.finditer(page):
        if m.start() < for_raw:
            continue
        if skip == "head" and page[at : m.start()].strip():
            skip = None
        if m.start() > at and not skip:
            run = _add_text(node, run, page[at : m.start()], links, at)
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        attrs = (m[3] if m[2] else m[6]) or ""
        closing = bool(m[1] or m[4])
        if tag in RAW and not closing and not attrs.endswith("/") and (not skip or skip == "head" or tag in ("script", "style", "textarea")):
            lowered = lowered or page.lower()
            end = lowered.find("</" + tag, at)
            stop = len(page) if end < 0 else end
            close = page.find(">", stop)
            for_raw = at = len(page) if end < 0 or close < 0 else close + 1
            continue
        if skip == "head" and not closing and tag == "template":
            skip, skip_depth = tag, 1
            inner.clear()
            continue
        if skip and _ends(skip, node, tag, closing, inner):
            skip = None
        if skip:
            if tag == skip:
                skip_depth += -1 if closing or tag in NO_NESTING or tag == "head" else 1
                if closing and skip_depth <= 0:
                    skip = None
                skip_depth = max(skip_depth, 1)
            elif tag in BLOCK or tag in FOREIGN:
                inner[tag] = max(0, inner.get(tag, 0) + (-1 if closing else 1))
            continue
        if tag in SKIP:
            if not closing and not attrs.endswith("/"):
                skip, skip_depth = tag, 1
                inner.clear()
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag == "br":
            run = _add_text(node, run, " ", 0, at) if run else run
            continue
        if tag not in BLOCK or tag == "hr":
            if tag == "hr":
                run = None
            continue
        run = None
        if closing:
            up = node
            while up and up.tag != tag:
                up = up.parent
            if up and up.parent:
                node = up.parent
            links = 0
            continue
        if tag in ("html", "body") and any(n.tag == tag for n in _path(node)):
            continue
        if tag in CLOSES_P:
            node = _close(node, ("p",), ("table", "td", "th", "li", "div", "section", "article", "aside", "main", "body"))
        if tag in CLOSES:
            node = _close(node, CLOSES[tag], SCOPE.get(tag, ()))
        child = Node(tag, attrs, node, m.start())
        node.kids.append(child)
        node = child
    if at < len(page) and skip in (None, "head"):
        _add_text(node, run, page[at:], links, at)
    return root


def _ends(skip: str, node: Node, tag: str, closing: bool, inner: dict[str, int]) -> bool:
    """Whether a tag ends a skipped element that has no end tag: a head at the first start tag that can't
    stand in it, others where their parent closes, SVG and MathML also at a block element of HTML."""
    if skip == "head":
        return not closing and tag not in IN_HEAD
    if tag not in BLOCK:
        return False
    if closing:
        return not inner.get(tag) and any(n.tag == tag for n in _path(node))
    if skip in ("svg", "math"):
        return not any(inner.get(x) for x in FOREIGN)
    return tag in CLOSES and not any(inner.get(x) for x in SCOPE.get(tag, ())) and _close(node, CLOSES[tag], SCOPE.get(tag, ())) is not node


def _path(node: Node | None) -> Iterator[Node]:
    while node:
        yield node
        node = node.parent


def _close(node: Node, tags: tuple[str, ...], stop: tuple[str, ...]) -> Node:
    """The parent of the outermost open element of ``tags`` below the next of ``stop``; else the node itself."""
    found = None
    for n in _path(node):
        if n.tag in tags:
            found = n
        elif n.tag in stop:
            break
    return found.parent if found and found.parent else node


def _add_text(node: Node, run: Node | None, text: str, links: int, start: int) -> Node | None:
    if run is None:
        if not text.strip():
            return None
        run = Node("#", "", node, start)
        node.kids.append(run)
    run.text.append(text)
    n = len(text.strip())
    run.chars += n
    if links:
        run.linked += n
    return run


#: Words that page authors use in class, id and role for parts that are not main text, by part, and for main text (fixed values).
PARTS = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumb crumbs pager pagination toc sitemap skip topbar toolbar tabs",
    "header": "header masthead branding logo tagline site banner top hero",
    "footer": "footer foot bottom copyright colophon legal credits contentinfo imprint",
    "side": "sidebar side aside widget widgets rail complementary secondary related recommended recommendations more popular trending tags tag archive archives categories also",
    "ad": "ad ads adv advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo promoted promotion dfp outbrain taboola commercial partner teaser",
    "notice": "cookie cookies consent gdpr notice notification alert warning popup modal overlay dialog disclaimer privacy paywall toast announcement",
    "form": "form login signin signup register search searchbox subscribe subscription newsletter contact input captcha optin",
    "comment": "comment comments commentlist discussion disqus respond response responses reply replies reader feedback thread guestbook",
    "share": "share sharing social facebook twitter follow like likes print email buttons actions byline author meta date rating vote",
    "main": "article articlebody content contents body entry post story text main maincontent page prose copy news blog column document",
}
PART_NAMES = tuple(PARTS)
PART_OF = {w: i for i, (_, ws) in enumerate(PARTS.items()) for w in ws.split()}
ROLE_OF = {"navigation": 0, "banner": 1, "contentinfo": 2, "complementary": 3, "search": 6, "form": 6, "alert": 5, "dialog": 5, "main": 9, "article": 9}
TAGS = ("#root", "#", "html", "body", "main", "article", "section", "nav", "aside", "header", "footer", "div", "p", "h", "list", "li", "table", "cell", "quote", "pre", "figure", "form", "address", "other")
TAG_ID = {t: i for i, t in enumerate(TAGS)} | {f"h{i}": TAGS.index("h") for i in range(1, 7)} | {"ul": TAGS.index("list"), "ol": TAGS.index("list"), "dl": TAGS.index("list"), "menu": TAGS.index("list"), "dt": TAGS.index("li"), "dd": TAGS.index("li")} | {t: TAGS.index("table") for t in ("thead", "tbody", "tfoot", "tr")} | {t: TAGS.index("cell") for t in ("td", "th", "caption")} | {"blockquote": TAGS.index("quote"), "figcaption": TAGS.index("figure"), "fieldset": TAGS.index("form"), "legend": TAGS.index("form"), "search": TAGS.index("form"), "dialog": TAGS.index("aside")}
TAG_PARTS = {"nav": 0, "header": 1, "footer": 2, "aside": 3, "form": 6, "fieldset": 6, "search": 6, "dialog": 5, "main": 9, "article": 9, "menu": 0}


@functools.lru_cache(maxsize=1 << 14)
def attribute_parts(attrs: str) -> int:
    """Bits of the parts that class, id, role and the like name."""
    bits = 0
    for m in ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role" and value.lower() in ROLE_OF:
            bits |= 1 << ROLE_OF[value.lower()]
        elif key in ("class", "id", "role", "itemprop", "aria-label", "data-component"):
            for w in NAME_PART.findall(value):
                p = PART_OF.get(w.lower())
                if p is not None:
                    bits |= 1 << p
    return bits


N_PARTS = len(PART_NAMES)
BASIC = 14
FEATURES = BASIC + 3 * N_PARTS


def nodes_and_features(root: Node) -> tuple[list[Node], list[int], np.ndarray]:
    """Nodes in document order, the place of each one's parent, and their features."""
    nodes: list[Node] = []
    parent: list[int] = []
    stack = [(root, -1)]
    while stack:
        n, p = stack.pop()
        me = len(nodes)
        nodes.append(n)
        parent.append(p)
        stack.extend((k, me) for k in reversed(n.kids))
    count = len(nodes)
    paragraphs, leaves, headings = ([0] * count for _ in range(3))
    for i in range(count - 1, -1, -1):
        n = nodes[i]
        if n.tag == "#":
            leaves[i] = 1
        elif n.tag == "p":
            paragraphs[i] += 1
        elif n.tag in ("h1", "h2"):
            headings[i] += 1
        if (p := parent[i]) >= 0:
            up = nodes[p]
            up.chars += n.chars
            up.linked += n.linked
            for a in (paragraphs, leaves, headings):
                a[p] += a[i]
    total = max(1, nodes[0].chars)
    own, above = [0] * count, [0] * count
    rows = np.zeros((count, FEATURES), np.float32)
    head = []
    for i, n in enumerate(nodes):
        bits = attribute_parts(n.attrs) if n.attrs else 0
        if n.tag in TAG_PARTS:
            bits |= 1 << TAG_PARTS[n.tag]
        own[i] = bits
        p = parent[i]
        up = nodes[p] if p >= 0 else n
        above[i] = above[p] | own[p] if p >= 0 else 0
        text = max(1, n.chars)
        sib = len(up.kids) if p >= 0 else 1
        head.append(
            (
                TAG_ID.get(n.tag, TAGS.index("other")), TAG_ID.get(up.tag, TAGS.index("other")), n.depth, np.log1p(n.chars), n.linked / text, leaves[i], n.chars / max(1, leaves[i]), paragraphs[i],
                paragraphs[i] / max(1, leaves[i]), headings[i], sib, n.chars / max(1, up.chars), up.linked / max(1, up.chars), n.chars / total,
            )
        )
    rows[:, :BASIC] = head
    bits = np.array([own, above, [own[p] if p >= 0 else 0 for p in parent]], np.int64)
    rows[:, BASIC:] = ((bits[:, :, None] >> np.arange(N_PARTS)) & 1).transpose(1, 0, 2).reshape(count, -1)
    return nodes, parent, rows


class Trees:
    """Gradient-boosted regression trees of fixed depth, for the logistic loss."""

    def __init__(self, rounds: int = 80, depth: int = 5, rate: float = 0.25, bins: int = 32, l2: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2 = rounds, depth, rate, bins, l2
        self.base, self.feature, self.cut, self.leaf = 0.0, [], [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        edges = [self._edges(x[:, f]) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1)
        n = len(y)
        self.base = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
        z = np.full(n, self.base)
        # sums over flags are matrix products, over the other features counts by bin
        flags = [f for f, e in enumerate(edges) if len(e) < 2]
        flagged, other = binned[:, flags].T.astype(float), [(f, np.ascontiguousarray(binned[:, f])) for f, e in enumerate(edges) if len(e) > 1]
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            g, h = p - y, p * (1 - p)
            at = np.zeros(n, np.int64)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                first, width = 2**level - 1, 2**level
                gs, hs = (self._sums(v, at - first, width, flags, flagged, other) for v in (g, h))
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + self.l2) + (gt - gs) ** 2 / (ht - hs + self.l2) - gt**2 / (ht + self.l2)
                gain[(hs < 1) | (ht - hs < 1)] = 0
                best = gain.reshape(width, -1).argmax(axis=1)
                f, b = best // self.bins, best % self.bins
                ok = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
                for k in np.flatnonzero(ok):
                    if b[k] < len(edges[f[k]]):
                        feature[first + k], cut[first + k] = f[k], edges[f[k]][b[k]]
                at = 2 * at + 1 + (x[np.arange(n), feature[at]] >= cut[at])
            first = 2**self.depth - 1
            value = -self.rate * np.bincount(at - first, g, first + 1) / (np.bincount(at - first, h, first + 1) + self.l2)
            z += value[at - first]
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(value)
        return self

    def _sums(self, v: np.ndarray, node: np.ndarray, width: int, flags: list[int], flagged: np.ndarray, other: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """Sums of ``v`` by node, feature and bin, each bin with those before it."""
        out = np.zeros((width, len(flags) + len(other), self.bins))
        at = np.zeros((len(v), width))
        at[np.arange(len(v)), node] = v
        total = at.sum(axis=0)
        out[:, flags] = total[:, None, None]
        out[:, flags, 0] -= (flagged @ at).T
        for f, bins in other:
            out[:, f] = np.bincount(node * self.bins + bins, v, width * self.bins).reshape(width, self.bins).cumsum(axis=1)
        return out

    def _edges(self, v: np.ndarray) -> np.ndarray:
        """Cuts between the values if they are few (rare flags keep theirs), else at quantiles."""
        u = np.unique(v)
        return (u[1:] + u[:-1]) / 2 if len(u) < self.bins else np.unique(np.quantile(v, np.linspace(0, 1, self.bins + 1)[1:-1]))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z, row = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[row, feature[at]] >= cut[at])
            z += leaf[at - (2**self.depth - 1)]
        return z


def decode(parent: list[int], weight: np.ndarray) -> np.ndarray:
    """Kept nodes: the set of greatest weight in which each kept node's ancestors are kept. Parents come before children."""
    best = weight.tolist()
    for i in range(len(best) - 1, 0, -1):
        if best[i] > 0:
            best[parent[i]] += best[i]
    keep = np.zeros(len(best), bool)
    for i, b in enumerate(best):
        keep[i] = b > 0 and (i == 0 or keep[parent[i]])
    return keep


def run_text(n: Node) -> str:
    """A run's text: character references decoded, white space as single spaces, trimmed."""
    return " ".join(html_lib.unescape("".join(n.text)).split())


MARK = "\ue000"  # marks main text in training pages


def _prose(r: random.Random, words: tuple[int, int]) -> str:
    out = []
    for _ in range(r.randint(*words)):
        w = "".join(r.choice(("th", "an", "er", "in", "ou", "el", "ré", "sch", "ing", "tion", "ea", "st", "qu", "ed", "ly", "o", "a")) for _ in range(r.randint(1, 4)))
        out.append(w + r.choice(("", "", "", "", "", ",", ".", "%%%", "!!", " ***") if r.random() < 0.3 else ("", "", "", "", "", "", ",", ".")))
    return " ".join(out).capitalize() + r.choice((".", ".", "", "?"))


def _links(r: random.Random, n: int) -> str:
    return "".join(f'<li><a href="/{i}">{_prose(r, (1, 4))}</a></li>' for i in range(n))


def _element(r: random.Random, part: str, tags: tuple[str, ...], inner: str, plain: float = 0.0) -> str:
    """``inner`` within an element that says by tag, class, id or role what part it is."""
    tag = r.choice(tags)
    names = PARTS[part].split()
    name = r.choice(names[: max(4, len(names) // 2)] if r.random() < 0.7 else names)
    if r.random() < 0.4:
        name = r.choice(("site-{}", "{}-box", "{}-wrap", "c-{}", "{}_inner", "main-{}" if part != "main" else "{}-main", "l-{}", "{}1")).format(name)
    attr = r.choice((f' class="{name}"', f' id="{name}"', f' class="x{r.randint(1, 99)} {name}"', f" class='{name}'", f" class={name}"))
    if tag in TAG_PARTS and part != "comment" and r.random() < 0.5 or r.random() < plain:
        attr = r.choice(("", f' class="b{r.randint(1, 99)}"'))
    return f"<{tag}{attr}>{inner}</{tag}>"


def _main_blocks(r: random.Random) -> list[str]:
    say = lambda *w: MARK + _prose(r, w)
    out = [f"<h1>{say(2, 14)}</h1>"] if r.random() < 0.85 else []
    for _ in range(r.choice((1, 2, 4, 8, 16, 30))):
        kind = r.random()
        if kind < 0.74:
            inner = say(*r.choice(((1, 3), (4, 12), (12, 40), (40, 150))))
            if r.random() < 0.25:
                inner = f"<b>{inner}" + r.choice(("</b>", "<br>", ""))
            if r.random() < 0.15:
                inner += f' <a href="/x">{_prose(r, (1, 4))}</a> {_prose(r, (1, 8))}'
            out.append(f"<p>{inner}" + r.choice(("</p>", "</p>", "</p>", "")))
        elif kind < 0.82:
            out.append(f"<h{r.choice((2, 3, 4))}>{say(1, 8)}</h2>" if r.random() < 0.1 else (lambda h: f"<{h}>{say(1, 8)}</{h}>")(r.choice(("h2", "h3", "h4"))))
        elif kind < 0.9:
            out.append((lambda t: f"<{t}>" + "".join(f"<li>{say(1, 25)}" + r.choice(("</li>", "")) for _ in range(r.randint(2, 7))) + f"</{t}>")(r.choice(("ul", "ol"))))
        elif kind < 0.93:
            out.append(f"<blockquote><p>{say(5, 40)}</p></blockquote>")
        elif kind < 0.95:
            out.append("<table>" + "".join("<tr>" + "".join(f"<td>{say(1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 5))) + "</table>")
        elif kind < 0.97:
            out.append(f"<figure><img src=x.png><figcaption>{say(3, 15)}</figcaption></figure>")
        elif kind < 0.985:
            out.append(f"<pre>{say(4, 20)}</pre>")
        else:
            out.append(f"<div>{say(5, 60)}</div>")
    return out


def training_page(r: random.Random) -> str:
    """A made-up page; runs of main text start with ``MARK``."""
    prose = lambda *w: _prose(r, w)
    nav = lambda: _element(r, "nav", ("nav", "div", "ul", "nav"), f"<ul>{_links(r, r.randint(2, 12))}</ul>" if r.random() < 0.7 else " | ".join(f'<a href="#">{prose(1, 3)}</a>' for _ in range(5)))
    header = lambda: _element(r, "header", ("header", "div", "header"), f"<{r.choice(('h1', 'h2', 'p', 'div'))}><a href='/'>{prose(1, 5)}</a>" + (f"<p>{prose(2, 12)}</p>" if r.random() < 0.5 else ""))
    ad = lambda: _element(r, "ad", ("p",), prose(2, 40)) if r.random() < 0.15 else _element(r, "ad", ("div", "aside", "section", "div"), r.choice((f"{prose(2, 60)}", f"<p>{prose(4, 80)}</p>", f"<a href='//ad'>{prose(1, 12)}</a>", f"<h3>{prose(1, 6)}</h3><p>{prose(3, 30)}</p>")))
    notice = lambda: _element(r, "notice", ("p",), prose(5, 40)) if r.random() < 0.15 else _element(r, "notice", ("div", "section", "aside", "dialog"), r.choice((f"<p>{prose(5, 50)}</p><button>{prose(1, 2)}</button>", prose(5, 50))))
    form = lambda: _element(r, "form", ("form", "form", "div"), f"<form action='/s'><label>{prose(1, 6)}</label><input name=q><p>{prose(2, 20)}</p><button>{prose(1, 2)}</button></form>" if r.random() < 0.5 else f"<h4>{prose(1, 5)}</h4><p>{prose(3, 25)}</p><input><select><option>{prose(1, 2)}</select>")
    share = lambda: _element(r, "share", ("div",), r.choice((f"<ul>{_links(r, 4)}</ul>", f"{prose(1, 6)} <a href='#'>{prose(1, 2)}</a>")))
    side = lambda: _element(r, "side", ("aside", "div", "aside", "section"), f"<h3>{prose(1, 5)}</h3>" + r.choice((f"<ul>{_links(r, r.randint(2, 9))}</ul>", f"<p>{prose(5, 90)}</p>", f"<div>{prose(5, 40)}</div><p>{prose(5, 40)}</p>")))
    reader = lambda: _element(r, "comment", ("div", "li", "article", "div"), f"<h4>{prose(1, 3)}</h4>" * r.randint(0, 1) + f"<p>{prose(3, 90)}</p>" * r.randint(1, 2))
    comments = lambda: _element(r, "comment", ("section", "div", "ol", "div"), f"<h3>{prose(1, 4)}</h3>" * r.randint(0, 1) + "".join(reader() if r.random() < 0.7 else f"<div><p>{prose(3, 80)}</p></div>" for _ in range(r.randint(1, 8))))
    foot = lambda: _element(r, "footer", ("footer", "div", "footer"), r.choice((f"&copy; {prose(1, 4)} &middot; {prose(2, 30)}", f"<p>{prose(3, 40)}</p>", f"<ul>{_links(r, 5)}</ul><p>{prose(2, 12)}</p>")))
    blocks = _main_blocks(r)
    for extra, chance in ((ad, 0.35), (share, 0.2), (form, 0.25), (side, 0.15), (notice, 0.15), (nav, 0.1)):
        if r.random() < chance:
            blocks.insert(r.randint(0, len(blocks)), extra())
    body = "".join(blocks)
    if r.random() < 0.15:
        body += comments()
    style = r.random()
    if style < 0.55:
        main = f"<article>{body}</article>"
    elif style < 0.95:
        main = _element(r, "main", ("div", "section", "main", "article"), body, plain=0.2)
    else:
        main = f"<div>{body}</div>"
    if r.random() < 0.3:
        main = r.choice(("<main>{}</main>", '<div class="container">{}</div>', '<div id="content">{}</div>', "<section>{}</section>")).format(main)
    rich = r.choice((0.0, 0.5, 1.0, 1.0, 1.0))  # some pages have little beside the main text
    top = [f() for f, c in ((notice, 0.25), (header, 0.5), (nav, 0.8), (ad, 0.4), (form, 0.15), (side, 0.15)) if r.random() < c * rich]
    end = [f() for f, c in ((share, 0.2), (comments, 0.35), (side, 0.35), (ad, 0.25), (form, 0.2), (nav, 0.15), (notice, 0.15), (foot, 0.85)) if r.random() < c * rich]
    r.shuffle(top)
    inner = "".join(top) + main + "".join(end)
    if r.random() < 0.3:
        inner = r.choice(('<div id="page">{}</div>', '<div class="wrapper">{}</div>', "<div>{}</div>")).format(inner)
    tail = "</body></html>" if r.random() < 0.85 else ""
    head = f"<!DOCTYPE html><html><head><title>{prose(2, 8)}</title><style>p{{}}</style><script>var a='<p>';</script></head><body>" if r.random() < 0.85 else r.choice(("<body>", "<html><body>", ""))
    return f"{head}{inner}{tail}"


@functools.lru_cache(maxsize=2)
def trained(pages: int = 1500, seed: int = 7) -> Trees:
    """Trees fitted to ``pages`` made-up pages (bounds the training set)."""
    r = random.Random(seed)
    xs, ys = [], []
    for _ in range(pages):
        nodes, parent, x = nodes_and_features(parse(training_page(r)))
        y = np.array([n.tag == "#" and MARK in "".join(n.text) for n in nodes])
        for i in range(len(nodes) - 1, 0, -1):
            y[parent[i]] |= y[i]
        xs.append(x)
        ys.append(y)
    return Trees().fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def main_texts(pages: list[str | None], trees: Trees) -> list[str]:
    """The main text of each page: kept runs in page order, joined by newlines."""
    parsed = [nodes_and_features(parse(p or "")) for p in pages]
    weights = trees.log_odds(np.concatenate([x for _, _, x in parsed])) if parsed else np.empty(0)
    out, at = [], 0
    for nodes, parent, x in parsed:
        keep = decode(parent, weights[at : at + len(x)])
        at += len(x)
        texts = (run_text(n) for n, k in zip(nodes, keep, strict=True) if k and n.tag == "#")
        out.append("\n".join(t for t in texts if t))
    return out


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text (main text, empty if none) and n_chars (its code points).

    A null page counts as empty. Rows are independent, repeated ones too; an empty table gives none.
    Other columns pass, columns of the two names are replaced. The model (some kilobytes) is trained once on the driver and broadcast.
    """
    keep = pages.drop("text", "n_chars")
    schema = keep.withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema
    names = keep.columns
    model = pages.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                b = whole.slice(at, 200)
                texts = main_texts(b.column(html).to_pylist(), model.value)
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*names, "text", "n_chars"])

    return keep.mapInArrow(run, schema)
