"""Trees to Markdown: one pass per unit over its rows of the node table.

Text, lists, tables and formulas of a unit depend on each other (labels are consumed only by what
renders), so a unit's nodes meet in one group; units are small, a group is bounded by its unit.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame

from quillspark.functions.labels import NEXT_STYLE, ROMAN

#: Roles of elements in a unit's body (fixed values of the format).
INLINE = frozenset("a xref strong b i em sup sub ins signage equation-inline glossterm".split())
TRANSPARENT = frozenset("content glossBody glossAlt intro-part".split())
NOTHING = frozenset("placeholder common-cellChildTextNode related-links".split())
IDENTITY = frozenset("title sptc archive-num glossterm meta".split())
#: Cells of a table, what may stand beside its rows, and what shows although it has no text (fixed values of the format).
CELLS = frozenset(("td", "th", "entry"))
BESIDE_ROWS = frozenset(("col", "colgroup", "colspec", "title"))
SHOWN = frozenset(("img", "image", "table", "equation-block", "equation-inline"))
LIST_CLASSES = {"alpha": "alpha", "lower-alpha": "alpha", "roman": "roman", "lower-roman": "roman", "numbered": "numbered", "decimal": "numbered", "upper-alpha": "upper-alpha", "upper-roman": "upper-roman"}
SPACE = re.compile(r"\s+")


class RenderError(ValueError):
    """An element or span that no rule models: named, never approximated."""


class El:
    """An element or text of a unit."""

    __slots__ = ("tag", "attrs", "text", "kids", "up", "shows")

    def __init__(self, tag: str, attrs: dict, text: str | None, up: "El | None"):
        self.tag, self.attrs, self.text, self.kids, self.up = tag, attrs, text, [], up
        #: Whether it or something in it is text, a figure, a table or a formula; ``tree`` hands it up.
        self.shows = tag in SHOWN or bool(text and text.strip())

    def elements(self) -> "list[El]":
        return [k for k in self.kids if k.tag != "#text"]

    def content(self) -> str:
        return self.text or "" if self.tag == "#text" else "".join(k.content() for k in self.kids)

    def has(self, tags: frozenset) -> bool:
        return self.tag in tags or any(k.has(tags) for k in self.elements())


def tree(rows: pd.DataFrame) -> El:
    """The root of a unit's rows, which are in order of pre."""
    by: dict[int, El] = {}
    root = None
    for r in rows.sort_values("pre").itertuples():
        up = by.get(None if pd.isna(r.parent) else int(r.parent))
        e = El(r.tag, dict(r.attrs or {}), r.text, up)
        by[int(r.pre)] = e
        if up:
            up.kids.append(e)
        elif root is None:
            root = e
    for e in reversed(by.values()):
        if e.up and e.shows:
            e.up.shows = True
    return root


class Outline(NamedTuple):
    """A list before its items have labels: its style (None: bullets) and the parts of each item.

    A part is a text, an outline or a list of block parts. Which items show, and so which label an
    item has, is known only once all parts are there.
    """

    style: str | None
    items: list[list]


def _role(k: El) -> str:
    """What a child of a list item is: part of a run of text, a paragraph, a list or a block."""
    return "run" if k.tag == "#text" or k.tag in INLINE else {"p": "p", "ol": "list", "ul": "list"}.get(k.tag, "block")


def alpha(n: int) -> str:
    s = ""
    while n > 0:
        n, r = divmod(n - 1, 26)
        s = chr(97 + r) + s
    return s


def roman(n: int) -> str:
    s = ""
    for v, t in ROMAN:
        k, n = divmod(n, v)
        s += t * k
    return s


LABEL: dict[str, Callable[[int], str]] = {"alpha": alpha, "roman": roman, "numbered": str, "upper-alpha": lambda n: alpha(n).upper(), "upper-roman": lambda n: roman(n).upper()}


class Renderer:
    """Renders one unit. ``link``: href to an absolute URL or None; ``figures``: prefix of image URLs."""

    def __init__(self, figures: str = ""):
        self.prefix = figures
        self.terms: dict[str, None] = {}
        self.figures: dict[str, None] = {}
        self.warnings: list[str] = []
        self.tables: list[str] = []
        self.number: str | None = None

    # a list of parts: ("line", text) lines join into one block, ("block", text) stands alone
    def unit(self, root: El, skip: frozenset = frozenset(), lead: str | None = None) -> str:
        out: list[tuple[str, str]] = [("block", lead)] if lead else []
        for k in root.elements():
            if k.tag not in skip and k.tag not in IDENTITY:
                self.block(k, out, 0)
        self.flush_number(out)
        return "\n\n".join(_blocks(out))

    def warn(self, kind: str, text: str) -> None:
        self.warnings.append(f"{kind}: {text}")

    def take_number(self) -> str:
        n, self.number = self.number, None
        return f"**{n}** " if n else ""

    def flush_number(self, out: list) -> None:
        if self.number:
            out.append(("block", f"**{self.number}**"))
            self.warn("orphan-num", f"{self.number} had no paragraph")
            self.number = None

    def block(self, e: El, out: list, depth: int) -> None:
        t = e.tag
        if t in TRANSPARENT or t == "glossdef":
            for k in e.elements():
                if t != "glossdef" or k.tag != "title":
                    self.block(k, out, depth)
        elif t == "subclause":
            self._subclause(e, out, depth)
        elif t in NOTHING:
            return
        elif t in ("clauseref", "callout-type"):
            if t == "callout-type" and e.content().strip() or any(k.tag not in ("title", "clause") for k in e.elements()):
                raise RenderError(f"<{t}> carries content")
        elif t == "p":
            text = self.inline(e)
            if text:
                out.append(("block", self.take_number() + text))
        elif t == "num":
            self.flush_number(out)
            inner = self.inline(e).strip().strip("()").strip()
            self.number = f"({inner})" if inner else None
        elif t in INLINE and t != "signage":
            out.append(("block", self.inline(e)))
        else:
            rule = getattr(self, "_" + RULES[t], None) if t in RULES else None
            if rule is None:
                raise RenderError(f"<{t}> in a block position")
            self.flush_number(out)
            rule(e, out, depth)

    def _subclause(self, e: El, out: list, depth: int) -> None:
        if e.attrs.get("variation-type"):
            out.append(("block", f"**{self.variation(e)}**"))
        if e.attrs.get("deleted-text"):
            out.append(("block", e.attrs["deleted-text"]))
        before, size = self.number, len(out)
        for k in e.elements():
            if k.tag != "title":
                self.block(k, out, depth)
        if len(out) == size and self.number and self.number != before:
            self.warn("empty-subclause", f"{self.number} labels nothing")
            self.number = None

    def _heading(self, e: El, out: list, depth: int) -> None:
        out.append(("block", f"{'###' if e.tag == 'h3' else '##'} {self.inline(e)}"))

    def _section(self, e: El, out: list, depth: int) -> None:
        taken, rest = _take(e, ("title", "h2", "h3"))
        head = taken.get("h2") or taken.get("h3")
        level = "###" if head and head.tag == "h3" else "##"
        seen = []
        for h in (taken.get("title"), head):
            text = self.inline(h) if h else ""
            if text and text not in seen:
                out.append(("block", f"{level} {text}"))
                seen.append(text)
        for k in rest:
            self.block(k, out, depth)

    def _list(self, e: El, out: list, depth: int) -> None:
        out += self.drawn(self.outlined(e, None, depth), depth)

    def members(self, e: El) -> Iterator[El]:
        """The items of a list. An item that shows nothing and holds one list stands for that list's items."""
        for li in e.elements():
            if li.tag != "li":
                raise RenderError(f"<{li.tag}> in a list")
            lists = [k for k in li.kids if _role(k) == "list"]
            if len(lists) == 1 and not any(k.shows for k in li.kids if k not in lists):
                self.warn("flattened-wrapper-item", "an item held only a list")
                yield from self.members(lists[0])
            else:
                yield li

    def outlined(self, e: El, above: str | None, depth: int) -> Outline:
        """above: the style of the numbered list around it; bullets pass it on."""
        style = self.list_style(e, above) if e.tag == "ol" else None
        return Outline(style, [self.parts(li, style or above, depth) for li in self.members(e)])

    def list_style(self, e: El, above: str | None) -> str:
        named = [v for v in (e.attrs.get(k, "").strip() for k in ("class", "outputclass")) if v]
        if named and named[0] not in LIST_CLASSES:
            raise RenderError(f"list class {named[0]}")
        if above and not named and above not in NEXT_STYLE:
            self.warn("list-depth", f"no style below {above}")
        outermost = "numbered" if e.up is not None and e.up.tag == "desc-note" else "alpha"
        return LIST_CLASSES[named[0]] if named else NEXT_STYLE.get(above, above) if above else outermost

    def parts(self, li: El, style: str | None, depth: int) -> list:
        found: list = []
        for role, group in itertools.groupby(li.kids, _role):
            if role == "run":
                texts = ["".join(k.text if k.tag == "#text" else self.mark(k) for k in group)]
                found += [t for t in (SPACE.sub(" ", x).strip() for x in texts) if t]
            elif role == "p":
                found += [t for t in map(self.inline, group) if t]
            elif role == "list":
                found += [self.outlined(k, style, depth + 1) for k in group]
            else:
                for k in group:
                    self.block(k, blocks := [], depth)
                    found.append(blocks)
        return found

    def drawn(self, o: Outline, depth: int) -> list[tuple[str, str]]:
        """Lines of an outline. A text that comes first stands beside its label, all else below; an item of which nothing shows takes no label."""
        out: list[tuple[str, str]] = []
        n, pad = 1, "  " * depth
        for parts in o.items:
            label = f"({LABEL[o.style](n)})" if o.style else "-"
            beside = [x for x in parts[:1] if isinstance(x, str)]
            below: list[tuple[str, str]] = []
            for x in parts[len(beside) :]:
                below += [("line", f"{pad}  {x}")] if isinstance(x, str) else self.drawn(x, depth + 1) if isinstance(x, Outline) else x
            if beside or below:
                out += [("line", " ".join([pad + label, *beside])), *below]
                n += 1
            else:
                self.warn("empty-list-item", f"{label} labels nothing")
        return out

    def _table(self, e: El, out: list, depth: int) -> None:
        taken, _ = _take(e, ("title",))
        if "title" in taken:
            out.append(("block", f"**{self.inline(taken['title'])}**"))
        text = self.grid(e)
        if text:
            out.append(("block", text))

    def grid(self, e: El) -> str:
        """A square pipe table; spanning cells repeat, rows without text go, the first one left heads it."""
        rows = list(_rows(e, False, {}))
        placed = list(_placed(rows))
        width = max((max(r) + 1 for r in placed if r), default=0)
        text = {id(c): self.cell(c) for row in placed for c in row.values()}
        lines = [[text[id(row[i])] if i in row else "" for i in range(width)] for row in placed]
        if not width:
            return ""
        wide = sum(_span(c, cols)[:2] != (1, 1) for cells, _, cols in rows for c in cells)
        heads = sum(head or i == 0 and all(c.tag == "th" for c in cells) for i, (cells, head, _) in enumerate(rows))
        left = [x for x in lines if any(x)]
        for n, least, kind, what in ((wide, 1, "table-irregular", "spanning cells repeated"), (heads, 2, "table-multirow-header", "header rows"), (len(lines) - len(left), 1, "table-empty-rows", "empty rows")):
            if n >= least:
                self.warn(kind, f"{n} {what}")
        drawn = ["| " + " | ".join(x) + " |" for x in left]
        return "\n".join([*drawn[:1], "|" + " --- |" * width, *drawn[1:]]) if left else ""

    def cell(self, c: El) -> str:
        inner: list[tuple[str, str]] = []
        run = Renderer(self.prefix)
        run.terms, run.figures, run.warnings, run.tables = self.terms, self.figures, self.warnings, self.tables
        if any(k.tag not in INLINE and k.tag not in NOTHING for k in c.elements()):
            for k in c.kids:
                if k.tag == "#text":
                    if k.text.strip():
                        inner.append(("block", SPACE.sub(" ", k.text).strip()))
                else:
                    run.block(k, inner, 0)
            text = " ".join(_blocks(inner))
        else:
            text = self.inline(c)
        return SPACE.sub(" ", text).strip().replace("|", "\\|")

    def _reference(self, e: El, out: list, depth: int) -> None:
        taken, rest = _take(e, ("title", "num"))
        if e.tag == "table-reference":
            self.tables.append(e.up.tag if e.up is not None else "")
        else:
            out.append(("block", f"**{self.variation(e)}**"))
        num = self.inline(taken["num"]) if "num" in taken and not taken["num"].has(frozenset(("placeholder",))) else ""
        title = self.inline(taken["title"]) if "title" in taken else ""
        inner: list[tuple[str, str]] = []
        for k in rest:
            self.block(k, inner, depth)
        if not inner and re.search("[A-Za-z0-9]", num):
            self.warn("empty-table-reference", f"Table {num} renders nothing")
            return
        out.append(("block", "### Table" + (f" {num}" if num else "") + (f" — {title}" if title else "")))
        out += inner

    def _figure(self, e: El, out: list, depth: int) -> None:
        if e.tag in ("img", "image"):
            out.append(("block", self.image(e, "", "")))
            return
        taken, rest = _take(e, ("title", "num"))
        num = self.inline(taken["num"]) if "num" in taken else ""
        title = self.inline(taken["title"]) if "title" in taken else ""
        for k in rest:
            if k.tag in ("img", "image"):
                out.append(("block", self.image(k, num, title)))
            elif k.tag == "longdescref":
                if k.content().strip():
                    out.append(("block", self.inline(k)))
            else:
                self.block(k, out, depth)

    def image(self, e: El, num: str, title: str) -> str:
        from urllib.parse import quote

        name = (e.attrs.get("src") or e.attrs.get("href") or "").rsplit("/", 1)[-1]
        label = " ".join(x for x in ("Figure", num) if x) + (f": {title}" if title else "")
        url = f"{self.prefix}/{quote(name, safe="!~*'")}"
        self.figures[name] = None
        shown = name.rsplit(".", 1)[-1].lower() in ("svg", "png", "jpg", "jpeg", "gif", "webp", "avif")
        return f"{'!' if shown else ''}[{label}]({url})"

    def _quote(self, e: El, out: list, depth: int) -> None:
        taken, rest = _take(e, ("title", "callout-type")) if e.tag == "callout" else ({}, e.elements())
        kind = next((v for k, v in taken["callout-type"].attrs.items() if k.endswith("type")), "").strip() if "callout-type" in taken else ""
        title = self.inline(taken["title"]) if "title" in taken else ""
        label = " — ".join(x for x in (kind[:1].upper() + kind[1:], title) if x)
        inner: list[tuple[str, str]] = []
        for k in rest:
            self.block(k, inner, depth)
        if not inner:
            if label:
                self.warn("empty-callout", f"{label} labels nothing")
            return
        blocks = ([f"**{label}**"] if label else []) + _blocks(inner)
        out.append(("block", "\n".join(f"> {x}" if x else ">" for x in "\n\n".join(blocks).split("\n"))))

    def _variation(self, e: El, out: list, depth: int) -> None:
        taken, rest = _take(e, ("title",))
        title = self.inline(taken["title"]) if "title" in taken else ""
        out.append(("block", f"**{self.variation(e)}{f' — {title}' if title else ''}**"))
        for k in rest:
            self.block(k, out, depth)

    def variation(self, e: El) -> str:
        state = e.attrs.get("state") or e.attrs.get("variation") or ""
        kind = (e.attrs.get("variation-type") or e.attrs.get("type") or "").lower()
        return " ".join(x for x in (state.upper(), "variation", f"({kind})" if kind else "") if x)

    def _equation(self, e: El, out: list, depth: int) -> None:
        out.append(("block", self.math(e)))

    def _verbatim(self, e: El, out: list, depth: int) -> None:
        out.append(("block", self.inline(e)))

    def _resources(self, e: El, out: list, depth: int) -> None:
        for k in e.elements():
            if k.tag != "link":
                raise RenderError(f"<{k.tag}> among resources")
            href = k.attrs.get("href", "")
            label = SPACE.sub(" ", k.attrs.get("title", "")).strip() or href
            out.append(("line", f"- [{label}]({href})" if re.match("https?://", href, re.I) else f"- {label}"))

    def _acronym(self, e: El, out: list, depth: int) -> None:
        out.append(("block", f"Acronym: {self.inline(e)}"))

    def inline(self, e: El) -> str:
        """The inline text of an element: white space collapsed, marks for emphasis and links."""
        return SPACE.sub(" ", "".join(k.text if k.tag == "#text" else self.mark(k) for k in e.kids)).strip()

    def mark(self, e: El) -> str:
        t = e.tag
        if t in NOTHING:
            return ""
        if t in ("equation-inline", "math"):
            return self.math(e)
        inner = SPACE.sub(" ", "".join(k.text if k.tag == "#text" else self.mark(k) for k in e.kids))
        if t in ("a", "xref"):
            if any("gloss" in e.attrs.get(k, "") for k in ("type", "class", "outputclass")) and inner.strip():
                self.terms[inner.strip()] = None
            href = e.attrs.get("href", "")
            return _edges(inner, lambda s: f"[{s}]({href})") if re.match("https?://", href, re.I) else inner
        if t in ("strong", "b"):
            return _edges(inner, lambda s: f"**{s}**")
        if t in ("i", "em"):
            return _edges(inner, lambda s: f"*{s}*")
        return inner

    def math(self, e: El) -> str:
        """A formula on one line: a_b, a^b, a/b, roots and fences; annotations dropped."""
        kids = [k for k in e.elements() if k.tag not in ("annotation", "annotation-xml")]
        if not kids:
            return SPACE.sub(" ", e.content()).strip()
        parts = [self.math(k) for k in kids]
        self_ = e.tag
        if "mathml-flattened" not in {w.split(":")[0] for w in self.warnings}:
            self.warn("mathml-flattened", "a formula was set on one line")
        wrap = lambda s: s if len(s) <= 1 or re.fullmatch(r"[\w.]+", s) else f"({s})"
        if self_ == "msub":
            return f"{parts[0]}_{wrap(parts[1])}"
        if self_ == "msup":
            return f"{parts[0]}^{wrap(parts[1])}"
        if self_ == "msubsup":
            return f"{parts[0]}_{wrap(parts[1])}^{wrap(parts[2])}"
        if self_ == "mfrac":
            return f"{wrap(parts[0])}/{wrap(parts[1])}"
        if self_ == "msqrt":
            return "√" + wrap(" ".join(parts))
        if self_ == "mfenced":
            return e.attrs.get("open", "(") + ", ".join(parts) + e.attrs.get("close", ")")
        if self_ == "mtable":
            return "; ".join(parts)
        if self_ == "mtr":
            return ", ".join(parts)
        return " ".join(p for p in parts if p)


#: Block elements to the rule that renders them.
RULES = {
    "h2": "heading", "h3": "heading", "section": "section", "ol": "list", "ul": "list", "table": "table", "table-reference": "reference", "table-reference-variation": "reference", "table-variation": "reference",
    "image-reference": "figure", "image-reference-variation": "figure", "img": "figure", "image": "figure", "callout": "quote", "desc-note": "quote", "subclause-variation": "variation", "equation-block": "equation",
    "notice": "verbatim", "signage": "verbatim", "resources": "resources", "glossAcronym": "acronym", "glossAbbreviation": "acronym",
}


def _blocks(parts: list[tuple[str, str]]) -> list[str]:
    out, lines = [], []
    for kind, s in [*parts, ("block", "")]:
        if kind == "line":
            lines.append(s)
            continue
        if lines:
            out.append("\n".join(lines))
            lines = []
        if s:
            out.append(s)
    return out


def _edges(s: str, mark: Callable[[str], str]) -> str:
    core = s.strip()
    return s if not core else s[: len(s) - len(s.lstrip())] + mark(core) + s[len(s.rstrip()) :]


def _take(e: El, tags: tuple[str, ...]) -> tuple[dict[str, El], list[El]]:
    taken: dict[str, El] = {}
    rest = []
    for k in e.elements():
        if k.tag in tags and k.tag not in taken:
            taken[k.tag] = k
        else:
            rest.append(k)
    return taken, rest


def _rows(e: El, head: bool, cols: dict[str, int]) -> Iterator[tuple[list[El], bool, dict[str, int]]]:
    """Each row's cells, whether it stands in a head, and the named columns of its group."""
    if e.tag == "tgroup":
        names = [k.attrs["colname"] for k in e.elements() if k.tag == "colspec" and k.attrs.get("colname")]
        cols = dict(zip(names, range(len(names)), strict=True))
    for k in e.elements():
        if k.tag in ("tr", "row"):
            for c in k.elements():
                if c.tag not in CELLS:
                    raise RenderError(f"<{c.tag}> in a row")
            yield k.elements(), head, cols
        elif k.tag in ("thead", "tbody", "tfoot", "tgroup"):
            yield from _rows(k, k.tag == "thead" or k.tag == "tgroup" and head, cols)
        elif k.tag not in BESIDE_ROWS:
            raise RenderError(f"<{k.tag}> in a table")


def _placed(rows: list[tuple[list[El], bool, dict[str, int]]]) -> Iterator[dict[int, El]]:
    """Cells by column, row by row: what spans rows is carried down, the row's own cells take the columns it leaves.
    What spans more rows than there are gives rows of its own."""
    carried: dict[int, tuple[El, int]] = {}
    for cells, _, cols in rows:
        row = {i: c for i, (c, _) in carried.items()}
        carried = {i: (c, n - 1) for i, (c, n) in carried.items() if n > 1}
        for c in cells:
            wide, tall, start = _span(c, cols)
            at = next(i for i in itertools.count() if i not in row)
            if start not in (None, at):
                raise RenderError(f"a cell names column {start + 1} but the row is at column {at + 1}")
            row |= dict.fromkeys(range(at, at + wide), c)
            if tall > 1:
                carried |= dict.fromkeys(range(at, at + wide), (c, tall - 1))
        yield row
    while carried:
        yield {i: c for i, (c, _) in carried.items()}
        carried = {i: (c, n - 1) for i, (c, n) in carried.items() if n > 1}


def _span(c: El, cols: dict[str, int]) -> tuple[int, int, int | None]:
    """Columns and rows of a cell, and the column it names. What isn't modelled is refused: a cell in a wrong column is a wrong value."""
    count = lambda key: int(m[1]) if (m := re.match(r"\s*([0-9]+)", c.attrs.get(key, ""))) and int(m[1]) else 1
    wide, tall, start = count("colspan"), count("rowspan"), None
    if c.attrs.get("colname"):
        raise RenderError(f"a cell at the column {c.attrs['colname']}")
    ends = [c.attrs[k] for k in ("namest", "nameend") if c.attrs.get(k)]
    if wide == 1 and ends:
        if len(ends) == 1 or not set(ends) <= cols.keys() or cols[ends[0]] > cols[ends[1]]:
            raise RenderError(f"a span over {' to '.join(ends)}")
        start, wide = cols[ends[0]], cols[ends[1]] - cols[ends[0]] + 1
    more = c.attrs.get("morerows") or "0"
    if tall == 1 and not more.isdigit():
        raise RenderError(f"morerows={more}")
    return wide, tall if tall > 1 else int(more) + 1, start


RENDERED = "unit string, body string, defined_terms array<string>, figures array<string>, warnings array<string>, table_refs array<string>, error string"


def render(unit_nodes: DataFrame, figures: str = "", skip: frozenset = frozenset()) -> DataFrame:
    """Rows of units (unit, pre, parent, tag, attrs, text) to their Markdown. A unit that no rule models gives ``error`` and no body."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        r = Renderer(figures)
        body = error = None
        try:
            root = tree(rows)
            body = r.unit(root, skip, root.attrs.get("deleted-text") or root.attrs.get("summary"))
        except RenderError as e:
            error = str(e)
        return pd.DataFrame([[rows["unit"].iloc[0], body, list(r.terms), list(r.figures), r.warnings, r.tables, error]], columns=["unit", "body", "defined_terms", "figures", "warnings", "table_refs", "error"])

    return unit_nodes.groupBy("unit").applyInPandas(run, RENDERED)
