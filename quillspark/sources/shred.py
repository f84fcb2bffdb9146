"""XML and HTML as node tables.

A node table has one row per element or text node of a document: doc_id, pre, post, parent, depth,
ord, tag (``#text`` for text), attrs, text, path. ``pre``/``post`` number nodes by opening and closing,
so an ancestor has a smaller pre and a larger post; ``ord`` is the place among siblings; ``path`` holds
the pre of each ancestor from the root down, and the node's own, so that descent is an equi-join.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame

NODE = "pre int, post int, parent int, depth int, ord int, tag string, attrs map<string,string>, text string, path array<int>, error string"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Builder:
    def __init__(self):
        self.rows: list[list] = []
        self.stack: list[int] = []
        self.kids: list[int] = [0]
        self.count = 0

    def open(self, tag: str, attrs: dict) -> None:
        parent = self.stack[-1] if self.stack else None
        self.rows.append([len(self.rows), 0, parent, len(self.stack), self.kids[-1], tag, {k: v or "" for k, v in attrs.items()}, None, [*self.stack, len(self.rows)]])
        self.kids[-1] += 1
        self.stack.append(len(self.rows) - 1)
        self.kids.append(0)

    def close(self) -> None:
        self.rows[self.stack.pop()][1] = self.count
        self.kids.pop()
        self.count += 1

    def text(self, data: str) -> None:
        last = self.rows[-1] if self.rows else None
        if last and last[5] == "#text" and last[2] == (self.stack[-1] if self.stack else None) and last[4] == self.kids[-1] - 1:
            last[7] += data
            return
        self.rows.append([len(self.rows), self.count, self.stack[-1] if self.stack else None, len(self.stack), self.kids[-1], "#text", {}, data, [*self.stack, len(self.rows)]])
        self.kids[-1] += 1
        self.count += 1


def parse_xml(text: str) -> list[list]:
    """Rows of a document; any fault of the mark-up gives one row with the error instead."""
    b = _Builder()
    p = expat.ParserCreate()
    p.buffer_text = True
    p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler = b.open, lambda _: b.close(), b.text
    try:
        p.Parse(text, True)
    except expat.ExpatError as e:
        return [[0, 0, None, 0, 0, None, {}, None, [], str(e)]]
    return [[*r, None] for r in b.rows]


class _Html(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.b = _Builder()

    def handle_starttag(self, tag, attrs):
        open_tag = self.b.rows[self.b.stack[-1]][5] if self.b.stack else None
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and open_tag == tag:
            self.b.close()
        self.b.open(tag, dict(attrs))
        if tag in VOID:
            self.b.close()

    def handle_startendtag(self, tag, attrs):
        self.b.open(tag, dict(attrs))
        self.b.close()

    def handle_endtag(self, tag):
        names = [self.b.rows[i][5] for i in self.b.stack]
        if tag in names:
            while self.b.rows[self.b.stack[-1]][5] != tag:
                self.b.close()
            self.b.close()

    def handle_data(self, data):
        if self.b.stack or data.strip():
            self.b.text(data)


def parse_html(text: str) -> list[list]:
    p = _Html()
    p.feed(text)
    p.close()
    while p.b.stack:
        p.b.close()
    return [[*r, None] for r in p.b.rows]


def shred(docs: DataFrame, doc_id: str, content: str, kind: str = "xml") -> DataFrame:
    """The node table of each document. Null and empty contents give no rows; a faulty XML document one with ``error``."""
    parse = parse_xml if kind == "xml" else parse_html
    type_of = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "pre", "post", "parent", "depth", "ord", "tag", "attrs", "text", "path", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, x in zip(b.iloc[:, 0], b.iloc[:, 1], strict=True):
                if x is not None and x.strip():
                    rows = pd.DataFrame([[i, *r] for r in parse(x)], columns=names)
                    rows["parent"] = rows["parent"].astype("Int32")
                    yield rows

    return docs.select(doc_id, content).mapInPandas(run, f"doc_id {type_of}, {NODE}")
