"""Two states of a text in one: tracked changes, milestones, the base view and what survives in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.tree import with_path
from quillspark.session import cut


def clamped_depth(df: DataFrame, partition: list[str], order: list[str], delta: Column, name: str = "depth") -> DataFrame:
    """A counter over ordered rows that never falls below zero.

    With S the running sum and m its running minimum, the depth is S - min(0, m): two windows over
    one sort instead of a loop.
    """
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = df.withColumn("__s", F.sum(delta).over(w))
    return s.withColumn(name, (F.col("__s") - F.least(F.lit(0), F.min("__s").over(w))).cast("long")).drop("__s")


def marks(attrs: Column) -> Column:
    """Change marks of an element: array of (kind, year), a ``type`` attribute of insert or delete with the ``dateTime`` of its prefix."""
    entries = F.filter(F.map_entries(attrs), lambda e: (F.substring_index(e["key"], ":", -1) == "type") & F.lower(e["value"]).isin("insert", "delete"))
    prefix = lambda k: F.when(k.contains(":"), F.concat(F.substring_index(k, ":", 1), F.lit(":"))).otherwise("")
    when = lambda k: F.substring(F.element_at(attrs, F.concat(prefix(k), F.lit("dateTime"))), 1, 4).try_cast("int")
    return F.transform(entries, lambda e: F.struct(F.lower(e["value"]).alias("kind"), when(e["key"]).alias("year")))


def kept(m: Column, cycle: int) -> Column:
    """Whether all marks keep an element in the state before ``cycle``: inserts of earlier years, deletions of that year or later."""
    return F.forall(m, lambda x: F.when(x["kind"] == "insert", x["year"] < cycle).otherwise(x["year"] >= cycle))


def draft_insert(m: Column, cycle: int) -> Column:
    return (F.size(m) > 0) & F.forall(m, lambda x: (x["kind"] == "insert") & (x["year"] >= cycle))


def undated(nodes: DataFrame, cycle: int) -> DataFrame:
    """Violations: marks without a year, or of the year between the cycles."""
    m = nodes.withColumn("m", F.explode(marks(F.col("attrs"))))
    return m.where(F.col("m.year").isNull() | (F.col("m.year") == cycle - 1)).select("doc_id", "pre", "tag", F.col("m.year").alias("year"))


#: Inline elements whose text alone doesn't show that an earlier passage survives (fixed values).
INLINE = ("xref", "a", "b", "i", "u", "em", "strong", "span", "ph", "link", "sub", "sup", "glossref", "equation-inline", "placeholder", "math", "mathML", "image")


def _edge(tag: str, action: str) -> Column:
    """Whether a node is the start or end milestone of an insertion or deletion range."""
    act = F.coalesce(F.col("attrs")["xt:action"], F.col("attrs")["action"], F.lit(""))
    return (F.substring_index("tag", ":", -1) == tag) & (act == action)


def _container(tag: str) -> Column:
    return (F.substring_index("tag", ":", -1) == tag) & ~_edge(tag, "start") & ~_edge(tag, "end")


def _inside(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """(doc_id, o_pre, pre, ...): nodes strictly below each node of ``outer`` (doc_id, o_pre)."""
    return nodes.select("*", F.explode("path").alias("o_pre")).join(outer, ["doc_id", "o_pre"]).where("pre > o_pre")


def _outer(nodes: DataFrame) -> DataFrame:
    return nodes.select("doc_id", F.col("pre").alias("o_pre"))


def _below(nodes: DataFrame, tops: DataFrame, on: list[str], strictly: bool = True) -> DataFrame:
    """(on, pre) of the nodes that have one of ``tops`` (on, pre) above them, or are one."""
    up = nodes.select(*on, "pre", F.explode("path").alias("__top")).join(tops.select(*on, F.col("pre").alias("__top")), [*on, "__top"])
    return (up.where("__top <> pre") if strictly else up).select(*on, "pre").distinct()


def visible(nodes: DataFrame, within: list[str], hidden: str = "insText") -> DataFrame:
    """Text nodes outside ranges and containers of ``hidden`` (insText: the earlier state; delText: the accepted one).

    ``within``: columns that delimit the stretch in which ranges are counted, doc_id or doc_id and o_pre.
    """
    delta = F.when(_edge(hidden, "start"), 1).when(_edge(hidden, "end"), -1).otherwise(0)
    counted = clamped_depth(nodes, within, ["pre"], delta, "__depth").where("tag = '#text' and __depth = 0").drop("__depth")
    return counted.join(_below(counted, nodes.where(_container(hidden)), within), [*within, "pre"], "left_anti")


def surviving(nodes: DataFrame, rejected: DataFrame) -> DataFrame:
    """(doc_id, o_pre, kept_text): text of the earlier state below each rejected element, inline elements not counted."""
    from quillspark.functions.text import collapse

    nodes = with_path(nodes)
    below = _inside(nodes, _outer(rejected))
    seen = visible(below, ["doc_id", "o_pre"])
    inline = nodes.where(F.substring_index("tag", ":", -1).isin(*INLINE)).select("doc_id", F.col("pre").alias("__top"))
    hid = seen.select("doc_id", "o_pre", "pre", F.explode("path").alias("__top")).where("__top < pre and __top >= o_pre").join(inline, ["doc_id", "__top"]).select("doc_id", "o_pre", "pre").distinct()
    text = seen.join(hid, ["doc_id", "o_pre", "pre"], "left_anti").groupBy("doc_id", "o_pre").agg(collapse(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pre", "text"))), lambda s: s["text"]), "")).alias("kept_text"))
    return text.where("kept_text <> ''")


def base_view(nodes: DataFrame, cycle: int, refused: DataFrame | None = None) -> DataFrame:
    """``nodes`` of the state before ``cycle``, with ``retained`` for elements kept only for what stands in them.

    An element whose marks reject it goes with all below it, unless it is a later insertion under
    which text of the earlier state survives. ``refused`` (doc_id, tag, kept_text) rules out single
    survivors. Jobs run while the plan is made: three intermediate tables are written. Then ranges and containers of insertions lose their text, and containers of deletions
    are unwrapped: their children take their parent.
    """
    columns, m = nodes.columns, marks(F.col("attrs"))
    nodes = cut(with_path(nodes).withColumn("__kept", (F.col("tag") == "#text") | kept(m, cycle)).withColumn("__draft", draft_insert(m, cycle)))
    rejected = nodes.where("not __kept")
    soft = rejected.where("__draft")
    holds = surviving(nodes, soft).join(soft.select("doc_id", F.col("pre").alias("o_pre"), "tag"), ["doc_id", "o_pre"])
    if refused is not None:
        holds = holds.join(refused, ["doc_id", "tag", "kept_text"], "left_anti")
    hold = cut(holds.select("doc_id", F.col("o_pre").alias("pre"), F.lit(True).alias("retained")))
    gone = _below(nodes, rejected.join(hold, ["doc_id", "pre"], "left_anti"), ["doc_id"], strictly=False)
    left = cut(nodes.join(gone, ["doc_id", "pre"], "left_anti").join(hold, ["doc_id", "pre"], "left"))
    texts = visible(left, ["doc_id"]).select("doc_id", "pre", F.lit(True).alias("__seen"))
    boxed = _below(left, left.where(_container("insText")), ["doc_id"], strictly=False)
    edges = _edge("insText", "start") | _edge("insText", "end") | _edge("delText", "start") | _edge("delText", "end")
    left = left.join(texts, ["doc_id", "pre"], "left").where((F.col("tag") != "#text") | F.col("__seen")).join(boxed, ["doc_id", "pre"], "left_anti").where(~edges)
    wrapper = left.where(_container("delText")).select("doc_id", F.col("pre").alias("parent"), F.col("parent").alias("__grand"))
    left = left.where(~_container("delText")).join(wrapper, ["doc_id", "parent"], "left").withColumn("parent", F.coalesce("__grand", "parent"))
    return left.select(*columns, F.coalesce("retained", F.lit(False)).alias("retained"))


def accepted_text(nodes: DataFrame, of: DataFrame, cycle: int) -> DataFrame:
    """(doc_id, o_pre, accepted): text below each element of ``of`` with later insertions taken and deletions left out."""
    from quillspark.functions.text import collapse

    nodes = with_path(nodes)
    below = _inside(nodes, _outer(of))
    deleted = nodes.where((F.col("tag") == "placeholder") | F.exists(marks(F.col("attrs")), lambda x: (x["kind"] == "delete") & (x["year"] >= cycle))).select("doc_id", F.col("pre").alias("__top"))
    seen = visible(below, ["doc_id", "o_pre"], hidden="delText")
    hid = seen.select("doc_id", "o_pre", "pre", F.explode("path").alias("__top")).where("__top < pre and __top > o_pre").join(deleted, ["doc_id", "__top"]).select("doc_id", "o_pre", "pre").distinct()
    return seen.join(hid, ["doc_id", "o_pre", "pre"], "left_anti").groupBy("doc_id", "o_pre").agg(collapse(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pre", "text"))), lambda s: s["text"]), "")).alias("accepted"))


def retention_counts(base: DataFrame, units: DataFrame) -> DataFrame:
    """(doc_id, unit, n): retained elements of each unit, those of nested units counted for the inner one only."""
    r = with_path(base).where("retained").select("doc_id", F.col("pre").alias("r_pre"), F.explode("path").alias("unit"))
    inner = r.join(units.select("doc_id", F.col("pre").alias("unit")), ["doc_id", "unit"]).groupBy("doc_id", "r_pre").agg(F.max("unit").alias("unit"))
    return inner.groupBy("doc_id", "unit").agg(F.count(F.lit(1)).alias("n"))


def corrections(texts: DataFrame, rulings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts (doc_id, pre, text, retained) with ruled replacements (doc_id, find, replace), and the violations:
    rulings that match no text, several, or text that isn't retained."""
    hits = texts.join(rulings, "doc_id").where(F.contains("text", "find"))
    count = hits.groupBy("doc_id", "find").agg(F.count(F.lit(1)).alias("n"), F.bool_and("retained").alias("inside"))
    faults = rulings.join(count, ["doc_id", "find"], "left").where("n is null or n <> 1 or not inside").select("doc_id", "find", F.coalesce("n", F.lit(0)).alias("n"), "inside")
    good = hits.join(count.where("n = 1 and inside"), ["doc_id", "find"]).select("doc_id", "pre", F.replace("text", "find", "replace").alias("fixed"))
    return texts.join(good, ["doc_id", "pre"], "left").withColumn("text", F.coalesce("fixed", "text")).drop("fixed"), faults


def disclosure(count: Column) -> Column:
    """The one-line note of a unit that keeps text of an earlier state; null for none."""
    return F.when(count > 0, F.concat(F.lit("> Note: "), count, F.when(count == 1, " passage is").otherwise(" passages are"), F.lit(" given as in the earlier state.")))
