"""Referenced subtrees copied below their pointers, without numbering a document again.

A node's label is the path of its ancestors' numbers and its own, so labels order a document as
it reads. A copy's label is that of its pointer, followed by what the node's own label says from the
referenced element on: it sorts below the pointer and before what follows, whatever is spliced elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.tree import with_path
from quillspark.session import cut


def spliced(nodes: DataFrame, pointers: DataFrame, most: int = 20) -> tuple[DataFrame, DataFrame]:
    """Instances (doc_id, label, from_doc, from_pre, hops) of nodes and of what pointers bring in, and faults (doc_id, label, fault).

    nodes: doc_id, pre, and path or post. pointers (doc_id, pre, to_doc, to_pre): each pointer once, an element without
    children of its own. A pointer inside a copied subtree is followed in turn: hops counts how
    many have been. An instance is the node itself (hops 0) or a copy; its order in its document is that
    of its label. Faults: pointers to nothing, and those followed ``most`` times without end (they bring in what they did so far).

    Each round is an equi-join of the pointers at hand with the rows below their targets, which are
    written once: only referenced subtrees, a row for each node and referenced ancestor.
    """
    n = with_path(nodes).select("doc_id", "pre", F.col("path").cast("array<long>").alias("path"))
    p = cut(pointers.select("doc_id", F.col("pre").cast("long").alias("pre"), "to_doc", F.col("to_pre").cast("long").alias("to_pre")), "pointers")
    targets = p.select("to_doc", "to_pre").distinct()
    below = n.select(F.col("doc_id").alias("to_doc"), F.col("pre").alias("from_pre"), "path", F.posexplode("path").alias("at", "to_pre")).join(targets, ["to_doc", "to_pre"])
    below = cut(below.select("to_doc", "to_pre", "from_pre", F.slice("path", F.col("at") + 1, F.size("path")).alias("tail")), "below")
    out = n.select("doc_id", F.col("path").alias("label"), F.col("doc_id").alias("from_doc"), F.col("pre").cast("long").alias("from_pre"), F.lit(0).alias("hops"))
    # pointers at hand: where they stand, and what they point to
    at = n.join(p, ["doc_id", "pre"]).select("doc_id", F.col("path").alias("label"), "to_doc", "to_pre")
    faults = None
    for hop in range(1, most + 1):
        at = cut(at, "pointers")
        lost = at.join(below.select("to_doc", "to_pre").distinct(), ["to_doc", "to_pre"], "left_anti").select("doc_id", "label", F.lit("points to nothing").alias("fault"))
        faults = lost if faults is None else faults.unionByName(lost)
        copies = cut(at.join(below, ["to_doc", "to_pre"]).select("doc_id", F.concat("label", "tail").alias("label"), F.col("to_doc").alias("from_doc"), "from_pre", F.lit(hop).alias("hops")), "copies")
        out = out.unionByName(copies)
        at = copies.join(p.select(F.col("doc_id").alias("from_doc"), F.col("pre").alias("from_pre"), "to_doc", "to_pre"), ["from_doc", "from_pre"]).select("doc_id", "label", "to_doc", "to_pre")
        if at.isEmpty():
            return out, faults
    return out, faults.unionByName(at.select("doc_id", "label", F.lit("has no end").alias("fault")))
