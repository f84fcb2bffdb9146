"""Near-duplicate vectors within a label: int8 tile products with rigorous error bounds.

Equal vectors of a label are one node with a multiplicity. A label's nodes fall into tiles of
about ``tile`` vectors by hash, and each pair of tiles is one group. There unit vectors are scaled
to int8; with e the norm of a vector's quantisation error, a product of quantised vectors differs
from the cosine by at most e1 + (1 + e1) * e2. Pairs whose interval holds the threshold are
computed again in double precision, the others are decided. A group gives, per vector, how many
vectors it links to and the least vector of its piece of the link graph: rows in proportion to
its vectors, never pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from quillspark.llm.common import materialise
from quillspark.llm.graph import components

#: Room for rounding in double and single precision, beside the error of quantisation.
SLACK = 1e-9
#: Up to this length products of int8 vectors are exact in single precision: 127 * 127 * n < 2 ** 24.
EXACT_F32 = 1040


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, their scale, and the norm of the error, by row."""
    scale = 127 / np.abs(unit).max(axis=1)
    q = np.rint(unit * scale[:, None])
    return q.astype(np.int8), scale, np.linalg.norm(unit - q / scale[:, None], axis=1)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows as doubles with a largest component between 1/2 and 1, by a power of two: no square of a component overflows or vanishes, and cosines keep every bit."""
    x = x.astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def link_matrix(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of x and y (not zero) have a cosine of ``threshold`` or more, in double precision."""
    x, y = scaled(x), scaled(y)
    ux, uy = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    (qx, sx, ex), (qy, sy, ey) = quantise(ux), quantise(uy)
    kind = np.float32 if x.shape[1] <= EXACT_F32 else np.float64
    approx = (qx.astype(kind) @ qy.astype(kind).T).astype(np.float64) / np.outer(sx, sy)
    bound = ex[:, None] + np.outer(1 + ex, ey) + SLACK
    found = approx - bound >= threshold
    i, j = np.nonzero(~found & (approx + bound >= threshold))
    for at in range(0, len(i), 65536):
        a, b = i[at : at + 65536], j[at : at + 65536]
        found[a, b] = np.einsum("ij,ij->i", x[a], y[b]) / (np.linalg.norm(x[a], axis=1) * np.linalg.norm(y[b], axis=1)) >= threshold
    return found


def _tile_links(keys: np.ndarray, weight: np.ndarray, x: np.ndarray, left: np.ndarray, same: bool, threshold: float) -> pd.DataFrame:
    """Links of a pair of tiles (left: rows of the first; same: both are one tile), and the least key of each row's piece."""
    order = np.argsort(keys, kind="stable")
    keys, weight, x, left = keys[order], weight[order], x[order], left[order]
    a = np.flatnonzero(left)
    b = a if same else np.flatnonzero(~left)
    links = np.zeros(len(keys), np.int64)
    root = np.arange(len(keys))
    blocks = []
    for i in range(0, len(a), 1024):
        for j in range(0, len(b), 1024):
            m = link_matrix(x[a[i : i + 1024]], x[b[j : j + 1024]], threshold)
            if same:
                m &= a[i : i + 1024][:, None] != b[j : j + 1024]
            if m.any():
                blocks.append((a[i : i + 1024], b[j : j + 1024], m))
                links[a[i : i + 1024]] += m @ weight[b[j : j + 1024]]
                if not same:
                    links[b[j : j + 1024]] += weight[a[i : i + 1024]] @ m
    moved = bool(blocks)
    while moved:
        before = root.copy()
        for p, q, m in blocks:
            root[p] = np.minimum(root[p], np.where(m, root[q], len(keys)).min(axis=1))
            root[q] = np.minimum(root[q], np.where(m, root[p][:, None], len(keys)).min(axis=0))
        root = root[root]
        moved = bool((root != before).any())
    hit = links > 0
    return pd.DataFrame({"key": keys[hit], "links": links[hit], "root": keys[root[hit]]})


def near_vectors(vectors: DataFrame, threshold: float = 0.93, tile: int = 1024) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Only vectors of one (non-null) label and one length are compared. Vectors that are null,
    empty, zero, or hold a null or non-finite component link with nothing. Rows that repeat an id
    are vectors of their own; a null vec_id is counted, but names no component, and is never kept.
    A cosine of exactly the threshold links. Other columns don't matter, an empty table gives no rows.
    """
    # single-precision vectors travel as they are; cosines are taken of their values as doubles
    single = vectors.schema["embedding"].dataType == ArrayType(FloatType(), True) or vectors.schema["embedding"].dataType == ArrayType(FloatType(), False)
    v = vectors.select("vec_id", F.col("label").alias("__label"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("__x"))
    finite = F.forall("__x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    usable = F.col("__label").isNotNull() & F.coalesce(finite & F.exists("__x", lambda c: c != 0), F.lit(False))
    key = F.when(usable, F.concat_ws(":", F.hex(F.xxhash64("__label", "__x")), F.hex(F.xxhash64(F.lit("second"), "__x", "__label"))))
    v = v.withColumn("__key", key)
    nodes = materialise(v.where("__key is not null").groupBy("__key").agg(F.first("__label").alias("__label"), F.first("__x").alias("__x"), F.count(F.lit(1)).alias("__m")).withColumn("__n", F.size("__x")), "vectors")
    tiles = nodes.groupBy("__label", "__n").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("__t"))
    placed = nodes.join(tiles, ["__label", "__n"]).withColumn("__own", F.pmod(F.xxhash64("__key"), F.col("__t")).cast("int"))
    pairs = placed.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__t") - 1))).select("__label", "__n", F.least("__own", "__other").alias("__i"), F.greatest("__own", "__other").alias("__j"), "__own", "__key", "__x", "__m")

    def run(group: pa.Table) -> pa.Table:
        x = group.column("__x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1)
        i, j = group.column("__i")[0].as_py(), group.column("__j")[0].as_py()
        keys = np.array(group.column("__key").to_pylist(), dtype=object)
        out = _tile_links(keys, group.column("__m").to_numpy(), x, group.column("__own").to_numpy() == i, i == j, threshold)
        return pa.table({"key": pa.array(out["key"], pa.string()), "links": pa.array(out["links"], pa.int64()), "root": pa.array(out["root"], pa.string())})

    found = materialise(pairs.groupBy("__label", "__n", "__i", "__j").applyInArrow(run, "key string, links long, root string"), "tile-links")
    roots = components(found.select(F.col("key").alias("src"), F.col("root").alias("dst")))
    links = found.groupBy("key").agg(F.sum("links").alias("__links"))
    state = nodes.select("__key", "__m").join(links, F.col("key") == F.col("__key"), "left").join(roots, F.col("node") == F.col("__key"), "left").select(F.col("__key").alias("__k"), (F.coalesce("__links", F.lit(0)) + F.col("__m") - 1).alias("__links"), F.coalesce("root", "__key").alias("__root"))
    # written and joined by hint: where one component or one vector holds many rows, Spark can split the join
    state = materialise(state, "vectors-state")
    rows = materialise(v.select("vec_id", "__key").join(state.hint("merge"), F.col("__k") == F.col("__key"), "left").select("vec_id", "__links", "__root"), "vectors-rows")
    least = materialise(rows.where("__root is not null").groupBy(F.col("__root").alias("__r")).agg(F.min("vec_id").alias("__least")), "vectors-least")
    component = F.coalesce("__least", "vec_id")
    return rows.join(least.hint("merge"), F.col("__r") == F.col("__root"), "left").select("vec_id", F.coalesce("__links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def oracle(threshold: float = 0.93) -> str:
    return f"""
    WITH RECURSIVE v AS (
      SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
    ), ok AS (
      SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0
    ), links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= {threshold}
    ), reach AS (
      SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
    ), c AS (
      SELECT a, min(b) AS component_id FROM reach GROUP BY a
    ), n AS (
      SELECT a, count(*) AS n FROM links GROUP BY a
    )
    SELECT c.a AS vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, c.a = component_id AS kept FROM c LEFT JOIN n ON c.a = n.a
    """
