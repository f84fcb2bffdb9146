"""Context inheritance, classification and guards over node tables.

Ancestors come from a node's path, so joins up and down a tree are equi-joins on document and place:
a few big documents spread over tasks, and rows grow with nodes times depth, not with their square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators import scan
from quillspark.session import cut


def intervals(nodes: DataFrame) -> DataFrame:
    """(doc_id, pre, end) of nodes with something below them, from pre and post alone: end is the pre of the last
    node below, the greatest pre of the nodes that close no later."""
    closed = scan.running_max(nodes.select("doc_id", F.col("pre").cast("long").alias("pre"), "post"), ["doc_id"], ["post"], "pre", "end")
    return closed.where("end > pre").select("doc_id", "pre", "end")


def stabbed(nodes: DataFrame) -> DataFrame:
    """(doc_id, pre, a_pre): each node with all its ancestors, from pre and post alone.

    An interval belongs to one cell of the interval tree over the document's places: the smallest
    dyadic one that holds it, whose midpoint it spans. The intervals of a cell all hold its midpoint, so
    they lie in each other and are no more than the tree is deep. A node looks into the cells above
    its place, one for each size that its document has: an equi-join by document, size and cell. Pairs of
    nodes are never formed, and a large document spreads over tasks.
    """
    iv = intervals(nodes).withColumn("size", F.when(F.col("pre") == F.col("end"), 0).otherwise(F.length(F.bin(F.col("pre").bitwiseXOR(F.col("end"))))))
    iv = cut(iv.select("doc_id", F.col("pre").alias("a_pre"), "end", "size", F.expr("shiftright(pre, size)").alias("cell")), "intervals")
    sizes = iv.groupBy("doc_id").agg(F.collect_set("size").alias("sizes"))
    points = nodes.select("doc_id", F.col("pre").cast("long").alias("pre")).join(sizes, "doc_id").select("doc_id", "pre", F.explode("sizes").alias("size"))
    points = points.withColumn("cell", F.expr("shiftright(pre, size)"))
    return points.join(iv, ["doc_id", "size", "cell"]).where("a_pre < pre and pre <= end").select("doc_id", "pre", "a_pre")


def with_path(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``path``: the pre of each ancestor and its own. Node tables of ``shred`` have it; for others it
    is made from pre and post by ``stabbed``."""
    if "path" in nodes.columns:
        return nodes
    kind = nodes.schema["pre"].dataType.simpleString()
    up = stabbed(nodes).groupBy("doc_id", F.col("pre").cast(kind).alias("pre")).agg(F.array_sort(F.collect_list("a_pre")).cast(f"array<{kind}>").alias("__up"))
    return nodes.join(up, ["doc_id", "pre"], "left").withColumn("path", F.concat(F.coalesce("__up", F.array().cast(f"array<{kind}>")), F.array("pre"))).drop("__up")


def ancestors(nodes: DataFrame, of: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
    """(doc_id, pre) of each node of ``of`` with its ancestors-or-self as a_pre and a_<column>."""
    nodes = with_path(nodes)
    of = nodes if of is None else of if "path" in of.columns else of.join(nodes.select("doc_id", "pre", "path"), ["doc_id", "pre"])
    a = nodes.where("tag <> '#text'").select("doc_id", F.col("pre").alias("a_pre"), *(F.col(c).alias(f"a_{c}") for c in columns or ["tag"]))
    return of.select("doc_id", "pre", F.explode("path").alias("a_pre")).join(a, ["doc_id", "a_pre"])


def nearest(nodes: DataFrame, value: Column, name: str, where: Column | None = None) -> DataFrame:
    """``nodes`` with ``name``: the value of the nearest ancestor-or-self that has one (and meets ``where``)."""
    v = F.when(where, value) if where is not None else value
    found = ancestors(nodes.withColumn("__v", F.nullif(v, F.lit(""))), columns=["__v"]).groupBy("doc_id", "pre").agg(F.max_by(F.when(F.col("a___v").isNotNull(), F.col("a___v")), F.when(F.col("a___v").isNotNull(), F.col("a_pre"))).alias(name))
    return nodes.join(found, ["doc_id", "pre"], "left")


def with_class(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """``nodes`` with the class of their tag (null: unknown). ``classes`` (tag, class) is a vocabulary of a few hundred rows at most."""
    return nodes.join(classes, "tag", "left")


def unknown_tags(classed: DataFrame) -> DataFrame:
    """Violations: elements of no known class below an element that isn't a unit's own content."""
    parent = classed.select("doc_id", F.col("pre").alias("parent"), F.col("class").alias("parent_class"))
    return classed.where("tag <> '#text' and class is null").join(parent, ["doc_id", "parent"], "left").where("parent_class is null or parent_class in ('root', 'container', 'transparent')").select("doc_id", "pre", "tag")


def stray_text(classed: DataFrame) -> DataFrame:
    """Violations: text directly in a structural element."""
    parent = classed.select("doc_id", F.col("pre").alias("parent"), F.col("class").alias("parent_class"))
    return classed.where("tag = '#text' and trim(text) <> ''").join(parent, ["doc_id", "parent"]).where("parent_class in ('root', 'container', 'transparent', 'pointer')").select("doc_id", "pre", "text")


def pointer_content(classed: DataFrame) -> DataFrame:
    """Violations: children of elements that only point elsewhere."""
    parent = classed.where("class = 'pointer'").select("doc_id", F.col("pre").alias("parent"))
    return classed.where("tag <> '#text' or trim(text) <> ''").join(parent, ["doc_id", "parent"]).select("doc_id", "pre", "tag")


def orphan_prose(classed: DataFrame) -> DataFrame:
    """Violations: a container's own prose with no container above it."""
    up = ancestors(classed, classed.where("class = 'prose'"), ["class"]).where("a_class in ('container', 'unit')").select("doc_id", "pre").distinct()
    return classed.where("class = 'prose'").join(up, ["doc_id", "pre"], "left_anti").select("doc_id", "pre", "tag")


def contexts(classed: DataFrame) -> DataFrame:
    """Units and containers with the section, container and state they stand in.

    A state or container number is the nearest one at or above; containers above the nearest
    section don't count, since entering a section clears the context.
    """
    attr = lambda k: F.nullif(F.trim(F.col("attrs")[k]), F.lit(""))
    c = classed.withColumn("own_state", F.upper(attr("state"))).withColumn("own_num", attr("num"))
    up = ancestors(c, c.where("class in ('unit', 'container')"), ["class", "tag", "own_state", "own_num", "type", "title"] if "type" in c.columns else ["class", "tag", "own_state", "own_num"])
    w = Window.partitionBy("doc_id", "pre")
    up = up.withColumn("section_pre", F.max(F.when(F.col("a_class") == "root", F.col("a_pre"))).over(w))
    near = lambda col, cond: F.max_by(F.when(cond & col.isNotNull(), col), F.when(cond & col.isNotNull(), F.col("a_pre")))
    inside = F.coalesce(F.col("a_pre") > F.col("section_pre"), F.lit(True))
    ctx = up.groupBy("doc_id", "pre").agg(
        near(F.col("a_own_state"), F.lit(True)).alias("state"),
        near(F.col("a_own_num"), (F.col("a_class") == "root")).alias("section_num"),
        near(F.col("a_tag"), (F.col("a_class") == "container") & inside).alias("container_kind"),
        near(F.col("a_own_num"), (F.col("a_class") == "container") & inside).alias("container_num"),
    )
    return c.where("class in ('unit', 'container')").select("doc_id", "pre", "post", "tag", "class", "attrs").join(ctx, ["doc_id", "pre"])


def own_prose(classed: DataFrame) -> DataFrame:
    """(doc_id, container, pre): prose of a container reached through transparent elements only."""
    prose = classed.where("class = 'prose'")
    between = ancestors(classed, prose, ["class"]).where(F.col("a_pre") < F.col("pre"))
    blocked = between.where("a_class not in ('transparent') or a_class is null").groupBy("doc_id", "pre").agg(F.max("a_pre").alias("container"))
    owner = classed.where("class = 'container'").select("doc_id", F.col("pre").alias("container"))
    return blocked.join(owner, ["doc_id", "container"]).select("doc_id", "container", "pre")


def overviews(classed: DataFrame) -> DataFrame:
    """Containers that have prose of their own: each is an overview unit."""
    return classed.where("class = 'container'").join(own_prose(classed).select("doc_id", F.col("container").alias("pre")).distinct(), ["doc_id", "pre"], "left_semi")


def child_text(nodes: DataFrame, tag: str, name: str) -> DataFrame:
    """(doc_id, parent, name): the collapsed text of each element's first child of a tag."""
    from quillspark.functions.text import collapse

    nodes = with_path(nodes)
    first = nodes.where(F.col("tag") == tag).groupBy("doc_id", "parent").agg(F.min("pre").alias("a_pre"))
    text = nodes.where("tag = '#text'").select("doc_id", "pre", "text", F.explode("path").alias("a_pre"))
    return first.join(text, ["doc_id", "a_pre"]).groupBy("doc_id", "parent").agg(collapse(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pre", "text"))), lambda s: s["text"]), "")).alias(name))


def without(nodes: DataFrame, tag: str) -> DataFrame:
    """``nodes`` without elements of a tag and all below them: what a placeholder holds is no value."""
    nodes = with_path(nodes)
    top = nodes.where(F.col("tag") == tag).select("doc_id", F.col("pre").alias("__top"))
    gone = nodes.select("doc_id", "pre", F.explode("path").alias("__top")).join(top, ["doc_id", "__top"]).select("doc_id", "pre").distinct()
    return nodes.join(gone, ["doc_id", "pre"], "left_anti")


def abstracts(classed: DataFrame) -> DataFrame:
    """Roots that carry prose of their own as an attribute, with section and state: each is an overview unit."""
    attr = lambda k: F.nullif(F.trim(F.col("attrs")[k]), F.lit(""))
    own = classed.where("class = 'root'").where(attr("summary").isNotNull())
    up = ancestors(classed.withColumn("own_state", F.upper(attr("state"))), own, ["own_state"])
    near = up.groupBy("doc_id", "pre").agg(F.max_by("a_own_state", F.when(F.col("a_own_state").isNotNull(), F.col("a_pre"))).alias("state"))
    return own.select("doc_id", "pre", "post", "tag", "class", "attrs", attr("num").alias("section_num")).join(near, ["doc_id", "pre"])


def prose_attribute(nodes: DataFrame) -> Column:
    """Prose that an element carries as an attribute, else the text of a childless element (column n_children)."""
    return F.coalesce(F.nullif(F.col("attrs")["deleted-text"], F.lit("")), F.nullif(F.col("attrs")["summary"], F.lit("")), F.when(F.col("n_children") == 0, F.col("text")))


def containment(nodes: DataFrame) -> DataFrame:
    """How often a tag stands in a parent tag."""
    e = nodes.where("tag <> '#text'")
    p = e.select("doc_id", F.col("pre").alias("parent"), F.col("tag").alias("parent_tag"))
    return e.join(p, ["doc_id", "parent"], "left").groupBy("parent_tag", "tag").count().withColumnRenamed("count", "n")
