"""One large document in parallel: node tables of documents that no task reads whole.

A document is a sequence of pieces cut before each ``<``, so a piece is a tag with the text that
follows it; a file is read as such pieces by Spark's text reader, each task a range of bytes. Pieces are
dealt out by ranges of their order. What a range means depends on what the ranges before it leave
open, so it is summed up twice:

- whether a comment, CDATA section, instruction or raw element is open at its end, for each that may be open
  at its start. These maps compose, and say in which state each range begins; pieces before its first
  tag belong to a text that may have begun earlier, and are given to the range before.
- what it closes that it didn't open, and what it opens and leaves open. Composed from left to right
  this is the stack of open elements: every range learns its open ancestors.

The first composition folds one row a range in the driver. Of the second no stack is ever formed, since what unclosed
elements leave open grows with the document: counts (closed, opened) give each range the depth it begins at by a window, so each
element that a range leaves open and each end tag that closes one of an earlier range has a known height. At one height elements
open and close in turn, so a window by document and height finds the element that an end tag closes; it has a
few rows a range at most. A range numbers its nodes by itself, and joins and offsets make that the numbers of the document.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.operators import scan
from quillspark.session import cut, discard
from quillspark.sources.shred import VOID

#: What may be open between pieces, and what ends it. A raw element (script, style) is open under its own name.
ENDS = {"comment": "-->", "cdata": "]]>", "instruction": "?>"}
RAW = ("script", "style")
STATES = ("", *ENDS, *RAW)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME = re.compile(r"/?\s*([^\s/>]+)")


def pieces_of_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, block, n, piece) of files below ``path``, by byte ranges of spark.sql.files.maxPartitionBytes: doc_id is the
    file's path, block the byte a range begins at, n the order within. The piece before the first ``<`` has no tag."""
    lines = spark.read.option("lineSep", "<").text(path)
    return lines.select(F.col("_metadata.file_path").alias("doc_id"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), F.col("value").alias("piece"))


def after(piece: str, state: str, markup: str) -> tuple[str, list[tuple[str, str]]]:
    """The state after a piece (without its ``<``) and what it holds, as (what, string): tag or text."""
    if state in ENDS:
        end = piece.find(ENDS[state])
        text = piece if end < 0 else piece[:end]
        held = [("text", "<" + text)] if state == "cdata" else []
        if end < 0:
            return state, held
        return "", [*held, ("text", html.unescape(piece[end + len(ENDS[state]) :]))]
    if state in RAW:
        if not re.match(rf"/{state}\s*>", piece, re.I):
            return state, [("text", "<" + piece)]
        state = ""
    for start, name in (("!--", "comment"), ("![CDATA[", "cdata"), ("?", "instruction")):
        if piece.startswith(start):
            end = piece.find(ENDS[name], len(start))
            held = [("text", piece[len(start) : end if end >= 0 else None])] if name == "cdata" else []
            return (name, held) if end < 0 else ("", [*held, ("text", html.unescape(piece[end + len(ENDS[name]) :]))])
    if not piece[:1].isalpha() and piece[:1] not in ("/", "!", "_", ":"):
        return "", [("text", html.unescape("<" + piece))]
    tag, _, text = _split(piece)
    if tag.startswith("!"):
        return "", [("text", html.unescape(text))]
    name = (m[1].lower() if markup == "html" else m[1]) if (m := NAME.match(tag)) else ""
    raw = name if markup == "html" and name in RAW and not tag.startswith("/") else ""
    return raw, [("tag", tag), ("text", text if raw else html.unescape(text))]


def _split(piece: str) -> tuple[str, str, str]:
    """A tag, its end and the text after it: the first > outside quotation marks."""
    end = piece.find(">")
    if end < 0 or not ('"' in piece[:end] or "'" in piece[:end]):
        return piece.partition(">")
    quote = ""
    for i, c in enumerate(piece):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c == ">":
            return piece[:i], ">", piece[i + 1 :]
    return piece.partition(">")


#: Pieces that may open or end something that holds no tags.
SPECIAL = r"(?isu)^(?:!--|!\[CDATA\[|\?|/?(?:script|style))|-->|\]\]>|\?>"
#: A tag up to its end, with few enough quotation marks for the depth of an expression.
HEAD = r"""^(/?[A-Za-z][\w:.-]*+(?:[\s/](?:[^"'>]++|"[^"]*+"|'[^']*+'){0,60}+)?+)>"""


def _marked(piece: Column) -> Column:
    """What ``_states`` must know of a piece: all of it if it may open or end something, else whether it holds a tag."""
    return F.when(piece.rlike(SPECIAL), piece).otherwise(F.concat(F.substring(piece, 1, 1), F.lit(">")))


def _bare(piece: Column) -> Column:
    """A piece without attributes and with a stand-in for its text (there or not; one with references may come to nothing, and stays): it
    makes the same nodes. Pieces that may open or end something, and those that aren't plainly a tag, stay as they are."""
    head = F.regexp_extract(piece, HEAD, 1)
    text = piece.substr(F.length(head) + 2, F.length(piece))
    slash = F.when(head.endswith("/"), "/>").otherwise(">")
    bare = F.concat(F.regexp_extract(head, r"^/?[A-Za-z][\w:.-]*", 0), slash, F.when(text == "", "").when(text.contains("&"), text).otherwise("x"))
    return F.when(piece.rlike(SPECIAL) | (head == ""), piece).otherwise(bare)


def _states(markup: str):
    """One row a range: for each state that may be open at its start, the state at its end and how many pieces come before
    its first tag (they belong to a text that an earlier range may have begun); and how many pieces there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, used, n = None, {}, {}, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([[now[s] for s in STATES]], pa.list_(pa.string())), pa.array([[used[s] for s in STATES]], pa.list_(pa.int64())), pa.array([n], pa.int64())], names=["__part", "ends", "used", "n"])

        for b in batches:
            for p, first, piece in zip(*(b.column(c).to_pylist() for c in ("__part", "__first", "piece")), strict=True):
                if p != part:
                    if part is not None:
                        yield row()
                    part, now, used, n = p, {s: s for s in STATES}, dict.fromkeys(STATES, 0), 0
                step = {was: ("", [("tag", "")]) if first else after(piece, was, markup) for was in set(now.values())}
                for s in STATES:
                    state, held = step[now[s]]
                    if used[s] == n and not any(what == "tag" for what, _ in held):
                        used[s] = n + 1
                    now[s] = state
                n += 1
        if part is not None:
            yield row()

    return run


LOCAL = "__part int, doc_id string, what string, tag string, attrs map<string,string>, text string, level int, shut int, up_pre bigint, pre bigint, closed bigint, closed_shut int, path array<bigint>, open array<struct<tag:string,pre:bigint>>, ends array<struct<tag:string,closed:bigint>>"
FIELDS = [x.split(" ")[0] for x in re.split(r", (?=\w+ )", LOCAL)]
KINDS = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.struct([("tag", pa.string()), ("pre", pa.int64())])), pa.list_(pa.struct([("tag", pa.string()), ("closed", pa.int64())]))]
BATCH = 20_000
CLOSED, CLOSED_SHUT = FIELDS.index("closed"), FIELDS.index("closed_shut")


class _Range:
    """Nodes of one document in one range, numbered from 0.

    level: elements opened here that stand above a node. shut: elements opened before the range
    that are closed by then; up_pre: the parent, if it was opened here. A node's closing number is
    ``closed`` and, of the elements it was opened after, as many more as were really there to be shut.
    paths: whether nodes are given the numbers of the elements above them that were opened here, and their own.
    Rows are given away as they close; only open elements are kept.
    """

    def __init__(self, part: int, doc: str, paths: bool):
        self.part, self.doc, self.paths, self.kept = part, doc, paths, 0
        self.rows: list[list] = []
        self.stack: list[list] = []
        self.nodes = self.closed = 0
        self.ends: list[dict] = []
        self.last_text: list | None = None

    def close(self, row: list) -> None:
        row[CLOSED], row[CLOSED_SHUT] = self.closed, len(self.ends)
        self.closed += 1

    def node(self, what: str, tag: str, attrs: dict, text: str | None) -> list:
        row = [self.part, self.doc, what, tag, attrs, text, len(self.stack), len(self.ends), self.stack[-1][9] if self.stack else None, self.nodes, None, None, [*(r[9] for r in self.stack), self.nodes] if self.paths else None, None, None]
        self.nodes += 1
        self.rows.append(row)
        return row

    def text(self, text: str) -> None:
        if self.last_text is not None:
            self.last_text[5] += text
        elif text:
            self.last_text = self.node("text", "#text", {}, text)
            self.close(self.last_text)

    def tag(self, tag: str, markup: str) -> None:
        self.last_text = None
        m = NAME.match(tag)
        name = (m[1].lower() if markup == "html" else m[1]) if m else ""
        if tag.startswith("/"):
            if self.stack:
                row = self.stack.pop()
                self.close(row)
                if row[3] != name:
                    self.rows.append([self.part, self.doc, "fault", None, {}, f"</{name}> closes <{row[3]}>", *[None] * 9])
            else:
                self.ends.append({"tag": name, "closed": self.closed})
            return
        attrs = {(k.lower() if markup == "html" else k): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(tag[m.end() :] if m else "")}
        row = self.node("element", name, attrs, None)
        if tag.endswith("/") or (markup == "html" and name in VOID):
            self.close(row)
        else:
            self.stack.append(row)

    def full(self) -> bool:
        return len(self.rows) >= self.kept + BATCH

    def batches(self, last: bool) -> Iterator[pa.RecordBatch]:
        rows, self.rows = self.rows, []
        if last:
            opened = [{"tag": r[3], "pre": r[9]} for r in self.stack]
            rows.append([self.part, self.doc, "range", None, {}, None, len(self.stack), len(self.ends), None, self.nodes, self.closed, None, None, opened, self.ends])
        else:
            self.rows = [r for r in rows if r[2] == "element" and r[CLOSED] is None or r is self.last_text]
            rows = [r for r in rows if not (r[2] == "element" and r[CLOSED] is None or r is self.last_text)]
            self.kept = len(self.rows)
        for k in range(0, len(rows), BATCH):
            yield pa.RecordBatch.from_arrays([pa.array([list(r[i].items()) if i == 4 else r[i] for r in rows[k : k + BATCH]], kind) for i, kind in enumerate(KINDS)], names=FIELDS)


def _local(markup: str, paths: bool):
    """Nodes of ranges, numbered within them, faults, and one summary for each range and document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, ""
        for b in batches:
            for p, d, first, piece in zip(*(b.column(c).to_pylist() for c in ("__part", "doc_id", "__first", "piece")), strict=True):
                if now is None or (p, d) != (now.part, now.doc):
                    if now is not None:
                        yield from now.batches(True)
                    now, state = _Range(p, d, paths), ""
                if first:
                    now.last_text = None
                state, held = ("", [("text", html.unescape(piece))]) if first else after(piece, state, markup)
                for what, x in held:
                    if what == "text":
                        now.text(x)
                    else:
                        now.tag(x, markup)
                if now.full():
                    yield from now.batches(False)
        if now is not None:
            yield from now.batches(True)

    return run


def shred_pieces(pieces: DataFrame, order: list[str], markup: str = "xml", text: str | None = None, parts: int | None = None, bare: bool = False, paths: bool = False) -> tuple[DataFrame, DataFrame]:
    """Node tables of documents given as ``pieces`` (doc_id, *order, piece), and their faults (doc_id, fault).

    Nodes: doc_id, pre, post, parent, depth, tag, attrs, text, numbered as ``shred`` numbers them.
    A piece begins after a ``<``, but for a document's first one, or those where the column ``text``
    is true: they begin a text of their own, and nothing is open before them but elements. Null pieces are empty.
    markup: xml, or html, where void elements close themselves, scripts and styles hold no tags and
    names are in lower case. An end tag closes the innermost element, whatever its name. Faults: end
    tags of another name, end tags that close nothing, elements left open (they close where the document ends).
    bare: nodes are (doc_id, pre, depth, tag) alone. Attributes and texts don't travel then, and what would
    find post and parent of elements that lie in several ranges is left out.
    paths: with it nodes have ``path``, as those of ``shred``; the rows of the table and what a range must know grow with
    the depth, so it is for documents of bounded depth.
    """
    keyed = pieces.select(F.col("doc_id").cast("string").alias("doc_id"), *order, F.coalesce("piece", F.lit("")).alias("piece"), *([F.col(text).alias("__first")] if text else []))
    if not text:
        least = keyed.groupBy("doc_id").agg(F.min(F.struct(*order)).alias("__least"))
        keyed = keyed.join(least, "doc_id").withColumn("__first", F.struct(*order) == F.col("__least")).drop("__least")
    if bare:
        keyed = keyed.withColumn("piece", F.when(F.col("__first"), F.col("piece")).otherwise(_bare(F.col("piece"))))
    key = ["doc_id", *order]
    r = scan.ranged(keyed, key, parts)
    ordered = lambda df: df.repartition("__part").sortWithinPartitions("__part", *key)
    states = ordered(r.withColumn("piece", F.when(F.col("__first"), "").otherwise(_marked(F.col("piece"))))).select("__part", "__first", "piece").mapInArrow(_states(markup), "__part int, ends array<string>, used array<bigint>, n bigint")
    moved, state, home = [], "", None
    for x in sorted(states.collect(), key=lambda x: x["__part"]):
        i = STATES.index(state)
        moved.append((x["__part"], x["used"][i], x["__part"] if home is None else home))
        if x["used"][i] < x["n"]:
            home = x["__part"]
        state = x["ends"][i]
    spark = pieces.sparkSession
    lead = F.broadcast(spark.createDataFrame(moved, "__part int, __lead bigint, __home int"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*key))
    dealt = r.join(lead, "__part").withColumn("__part", F.when(place <= F.col("__lead"), F.col("__home")).otherwise(F.col("__part")))
    local = cut(ordered(dealt).select("__part", "doc_id", "__first", "piece").mapInArrow(_local(markup, paths), LOCAL), "shredded")
    discard(r)
    starts = cut(_starts(local), "starts")
    stacks = _matched(local, starts, paths)
    if not bare or paths:
        stacks = cut(stacks, "stacks")
    n = local.where("what in ('element', 'text')").drop("open", "ends").join(starts.select("__part", "doc_id", "__nodes", "__closed", "__there"), ["__part", "doc_id"])
    n = n.withColumn("pre", F.col("pre") + F.col("__nodes")).withColumn("up_pre", F.col("up_pre") + F.col("__nodes"))
    n = n.withColumn("depth", F.col("level") + F.greatest(F.lit(0), F.col("__there") - F.col("shut")))
    n = n.withColumn("post", F.col("closed") + F.col("__closed") + F.least("closed_shut", "__there"))
    n = n.withColumn("parent", F.when(F.col("depth") > 0, F.col("up_pre")))
    if not bare:
        # an element that its own range doesn't close, and a node whose parent its own range doesn't open
        far = (F.col("post").isNull()) | (F.col("up_pre").isNull() & (F.col("depth") > 0))
        posts = stacks.where("what in ('end', 'left')").select("doc_id", "pre", F.col("post").alias("__post"))
        above = stacks.where("shut is not null").select("__part", "doc_id", "shut", F.col("pre").alias("__up"))
        joined = n.where(far).join(above, ["__part", "doc_id", "shut"], "left").join(posts, ["doc_id", "pre"], "left")
        joined = joined.withColumn("post", F.coalesce("post", "__post")).withColumn("parent", F.coalesce("parent", "__up"))
        n = n.where(~far).unionByName(joined.select(n.columns))
    columns = ["doc_id", "pre", "depth", "tag"] if bare else ["doc_id", "pre", "post", "parent", "depth", "tag", "attrs", "text"]
    if paths:
        open_ = stacks.where("what in ('end', 'peek')").groupBy("__part", "doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("height", "pre"))), lambda x: x["pre"]).alias("__stack"))
        here = F.transform("path", lambda x: x + F.col("__nodes"))
        outer = F.coalesce(F.slice("__stack", F.lit(1), F.greatest(F.lit(0), F.col("__there") - F.col("shut")).cast("int")), F.array().cast("array<bigint>"))
        n = n.join(open_, ["__part", "doc_id"], "left").withColumn("path", F.concat(outer, here))
        columns.append("path")
    return n.select(columns), _faults(local, starts, stacks)


def _starts(local: DataFrame) -> DataFrame:
    """What stands before each range of a document, from counts alone: nodes, closed ones, how many elements are open (__there), how
    many of them the range shuts; and of the whole document how many are closed and left open by its end tags."""
    r = local.where("what = 'range'").select("__part", "doc_id", F.size("open").cast("long").alias("o"), F.size("ends").cast("long").alias("e"), F.col("pre").alias("n"), F.col("closed").alias("c"))
    whole = Window.partitionBy("doc_id")
    order = whole.orderBy("__part")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a counter that never falls below zero, lowest after a range's end tags and before what it leaves open
    r = r.withColumn("s", F.sum(F.col("o") - F.col("e")).over(so_far))
    r = r.withColumn("after", F.col("s") - F.least(F.lit(0), F.min(F.col("s") - F.col("o")).over(so_far)))
    r = r.withColumn("__there", F.lag("after", 1, 0).over(order)).withColumn("__shut", F.least("e", "__there"))
    total = F.col("c") + F.col("__shut")
    return r.select("__part", "doc_id", (F.sum("n").over(so_far) - F.col("n")).alias("__nodes"), (F.sum(total).over(so_far) - total).alias("__closed"), "__there", "__shut", F.sum(total).over(whole).alias("__all"), F.max_by("after", "__part").over(whole).alias("__deep"))


def _matched(local: DataFrame, starts: DataFrame, whole: bool) -> DataFrame:
    """Elements that lie in several ranges, by height: end (the end tag that closes one), left (one that nothing closes), peek (the one
    that a range finds innermost when it has shut all it shuts; whole: all that it finds and doesn't shut).

    pre, tag: the element's, post: its closing number, by: the end tag's name; shut: in this range, after so
    many end tags, it is the innermost of those opened before the range.
    """
    r = local.where("what = 'range'").select("__part", "doc_id", "open", "ends").join(starts, ["__part", "doc_id"])
    key = ["doc_id", "__part"]
    none = lambda kind: F.lit(None).cast(kind)
    ends = r.select(*key, "__there", "__closed", "__all", "__deep", F.posexplode("ends").alias("j", "x")).where("j < __there")
    ends = ends.select(*key, (F.col("__there") - F.col("j")).alias("height"), F.lit("end").alias("what"), none("long").alias("pre"), none("string").alias("tag"), (F.col("__closed") + F.col("x.closed") + F.col("j")).alias("post"), F.col("x.tag").alias("by"), F.col("j").cast("int").alias("shut"))
    left = F.col("__there") - F.col("__shut")
    peeks = r.where(left > 0).select(*key, "__shut", left.alias("top"), F.explode(F.sequence(F.lit(1).cast("long") if whole else left, left)).alias("height"))
    peeks = peeks.select(*key, "height", F.lit("peek").alias("what"), none("long").alias("pre"), none("string").alias("tag"), none("long").alias("post"), none("string").alias("by"), F.when(F.col("height") == F.col("top"), F.col("__shut").cast("int")).alias("shut"))
    opened = r.select(*key, left.alias("base"), "__nodes", "__all", "__deep", F.posexplode("open").alias("m", "x"))
    height = F.col("base") + F.col("m") + 1
    opened = opened.select(*key, height.alias("height"), F.lit("left").alias("what"), (F.col("__nodes") + F.col("x.pre")).alias("pre"), F.col("x.tag").alias("tag"), (F.col("__all") + F.col("__deep") - height).alias("post"), none("string").alias("by"), none("int").alias("shut"))
    # in one range the elements of before come before those it leaves open
    w = Window.partitionBy("doc_id", "height").orderBy("__part", F.when(F.col("what") == "left", 1).otherwise(0))
    before, rest = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    last = lambda c: F.last(F.col(c), ignorenulls=True).over(before)
    e = ends.unionByName(peeks).unionByName(opened)
    e = e.select("*", last("pre").alias("__pre"), last("tag").alias("__tag"), F.max(F.when(F.col("what") == "end", 1)).over(rest).alias("__closes"))
    opens = F.col("what") == "left"
    e = e.where(~opens | F.col("__closes").isNull())
    return e.select(*key, "height", "what", F.when(opens, F.col("pre")).otherwise(F.col("__pre")).alias("pre"), F.when(opens, F.col("tag")).otherwise(F.col("__tag")).alias("tag"), "post", "by", "shut")


def _faults(local: DataFrame, starts: DataFrame, stacks: DataFrame) -> DataFrame:
    """Faults inside ranges, and those that only show between them. What a document leaves open is one row."""
    say = lambda *x: F.concat(*(F.lit(y) if i % 2 == 0 else F.col(y) for i, y in enumerate(x))).alias("fault")
    inside = local.where("what = 'fault'").select("doc_id", F.col("text").alias("fault"))
    r = local.where("what = 'range'").select("__part", "doc_id", "ends").join(starts.select("__part", "doc_id", "__there"), ["__part", "doc_id"])
    stray = r.select("doc_id", "__there", F.posexplode("ends").alias("j", "x")).where("j >= __there").select("doc_id", F.col("x.tag").alias("by")).select("doc_id", say("</", "by", "> closes nothing"))
    other = stacks.where("what = 'end' and by <> tag").select("doc_id", say("</", "by", "> closes <", "tag", ">"))
    left = stacks.where("what = 'left'").groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("height", "tag"))), lambda x: x["tag"]), " ").alias("tags")).select("doc_id", say("left open: ", "tags"))
    return inside.unionByName(stray).unionByName(other).unionByName(left)
