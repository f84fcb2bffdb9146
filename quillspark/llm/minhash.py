"""Near-duplicate texts by circulant MinHash, banding and exact Jaccard verification.

A shingle's 64-bit hash gives its place in a universe of 2**20 (the first permutation); one random
permutation of the universe, shifted circularly by k, gives coordinate k of the signature: all
coordinates of a shingle are one contiguous stretch of the permutation.

Texts with equal shingle sets are one node. Nodes that agree in a band share a bucket. Links are
looked for in two rounds, neither of which forms the pairs of a bucket. First each node is held
against its bucket's least node. Then nodes that this leaves apart from their bucket's least node
are held against the rest of the bucket by signature, in blocks of bounded size, and a block gives
only a spanning forest of what is close enough. The components of that are families; each family's
nodes are laid out in tiles, every pair of tiles is one group that has the full sets at hand, and
gives a spanning forest of the links it finds between different components. Pairs whose signatures
agree too rarely for the threshold (by 4.6 standard deviations) are dropped; every other pair is
decided on the full sets, unless its ends are in one component already.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import boxed, materialise, row_key, unboxed
from quillspark.llm.graph import components

UNIVERSE = 1 << 20
#: Texts whose words are in a worker's memory at once.
SLICE = 250
MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: A-Z lowered, words between ASCII white space,
    k words a shingle, a shorter text as one shingle, none for a text without words or a null."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = words.flatten()
    of = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
    full = pc.not_equal(pc.binary_length(flat), 0)
    of = of[full.to_numpy(zero_copy_only=False)]
    codes = pc.dictionary_encode(pc.filter(flat, full))
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in codes.dictionary.to_pylist()), np.uint64, len(codes.dictionary))
    h = table[codes.indices.to_numpy()]
    n = np.bincount(of, minlength=len(words))
    starts = np.concatenate(([0], np.cumsum(n)))
    rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for i in range(k):
        rolled = rolled * MULT + h[i : len(h) - k + 1 + i]
    rolled = mix(rolled)
    out = []
    for d in range(len(words)):
        a, m = starts[d], n[d]
        if m >= k:
            s = rolled[a : a + m - k + 1]
        elif m:
            s = mix(np.array([functools.reduce(lambda x, y: (x * int(MULT) + int(y)) & (1 << 64) - 1, h[a : a + m], int(m))], np.uint64))
        else:
            s = np.empty(0, np.uint64)
        out.append(np.unique(s))
    return out


@functools.lru_cache(maxsize=2)
def permutation(coords: int) -> np.ndarray:
    """The second permutation; row i holds its values at i, i + 1, ... circularly: coordinate k's value of place i."""
    p = np.random.default_rng(20).permutation(UNIVERSE).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([p, p[: coords - 1]]), coords)


def signature(shingles: np.ndarray, coords: int) -> np.ndarray:
    rows = permutation(coords)
    places = (shingles & np.uint64(UNIVERSE - 1)).astype(np.int64)
    out = np.full(coords, UNIVERSE, np.int32)
    for at in range(0, len(places), 512):
        np.minimum(out, rows[places[at : at + 512]].min(axis=0), out=out)
    return out


def _signatures(k: int, bands: int, rows: int):
    weights = np.random.default_rng(21).integers(1, 1 << 62, (1, bands, rows), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    label = np.arange(1, bands + 1, dtype=np.uint64) * MULT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                sets = shingle_sets(b.column("text"), k)
                sigs = np.array([signature(s, bands * rows) for s in sets]).reshape(len(sets), -1)
                keys = mix((sigs.reshape(len(sets), bands, rows).astype(np.uint64) * weights).sum(axis=2) + label).view(np.int64)
                some = [len(s) > 0 for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("__row"),
                        pa.array(map(len, sets), pa.int64()),
                        pa.array((hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets), pa.binary()),
                        pa.array((x.tobytes() if ok else None for x, ok in zip(sigs.astype(np.uint8), some, strict=True)), pa.binary()),
                        pa.array((x if ok else None for x, ok in zip(keys, some, strict=True)), pa.list_(pa.int64())),
                    ],
                    names=["__row", "__n", "__set", "__sig", "__bands"],
                )

    return run


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays([b.column("__set"), pa.array((s.tobytes() for s in shingle_sets(b.column("text"), k)), pa.binary())], names=["__set", "__full"])

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("__x"), b.column("__y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(p) + len(q) - len(np.union1d(p, q))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield b.select(["src", "dst"]).filter(pa.array(keep, pa.bool_()))

    return run


def _agree(percent: int, coords: int) -> float:
    """Least number of equal coordinates a pair is verified for: 4.6 standard deviations below the threshold's mean."""
    s = percent / 100
    return coords * s - 4.6 * (coords * s * (1 - s)) ** 0.5


def _screen_stars(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("__x", "__y"))
                yield b.select(["src", "dst"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return run


def near_texts(docs: DataFrame, shingle: int = 4, percent: int = 80, bands: int = 40, rows: int = 6, block: int = 512) -> DataFrame:
    """``docs`` with n_shingles, component_id and kept.

    Documents link when 100 * intersection >= percent * union of their shingle sets; component_id
    is the least doc_id reachable. Null, empty and blank texts have no shingles and link with
    nothing. Equal texts share a component; so do repeated rows, and all rows of the least doc_id
    are kept. A null doc_id is a member of its component but names none and is never kept, unless
    all ids of the component are null: then component_id is null. Other columns pass, whatever
    their names; columns of the three names are replaced. A pair at the threshold is missed with a
    probability of about 7e-6, one of similarity 0.9 with less than 1e-12.
    """
    text = docs.select(row_key("doc_id", "text").alias("__row"), "text")
    sigs = materialise(text.mapInArrow(_signatures(shingle, bands, rows), "__row binary, __n long, __set binary, __sig binary, __bands array<long>"), "minhash")
    nodes = sigs.where("__set is not null").groupBy("__set").agg(F.min("__row").alias("__row"), F.first("__n").alias("__n"), F.first("__sig").alias("__sig"), F.first("__bands").alias("__bands"))
    nodes = materialise(nodes, "minhash-nodes")
    bucket = nodes.select("__set", F.explode("__bands").alias("__b"))
    shared = materialise(bucket.groupBy("__b").agg(F.min("__set").alias("__hub"), F.count(F.lit(1)).alias("__size")).where("__size > 1"), "minhash-buckets")
    members = materialise(bucket.join(shared, "__b"), "minhash-members")
    stars = members.where("__hub <> __set").select(F.col("__hub").alias("src"), F.col("__set").alias("dst")).distinct()
    least = _agree(percent, bands * rows)
    links = _confirmed(_screened(stars, nodes, percent, least), nodes, docs, shingle, percent)
    roots = components(links)
    near = materialise(_rest(members, nodes, roots, percent, least, block), "minhash-near")
    families = components(near.unionByName(roots.select(F.col("node").alias("src"), F.col("root").alias("dst"))))
    more = materialise(_within(families, roots, nodes, docs, shingle, percent, least, block), "minhash-more")
    roots = components(links.unionByName(more))
    named = sigs.join(roots, F.col("node") == F.col("__set"), "left").select("__row", "__n", F.coalesce("root", "__set").alias("__root")).dropDuplicates(["__row"])
    d, keep = boxed(docs, ("n_shingles", "component_id", "kept"))
    ids = docs.select(F.col("doc_id").alias("__id"), row_key("doc_id", "text").alias("__row")).join(named, "__row").where("__root is not null")
    # written and joined by hint: where one component holds many rows, Spark can split the join
    names = materialise(ids.groupBy(F.col("__root").alias("__r")).agg(F.min("__id").alias("__least")), "minhash-names")
    named = named.join(names.hint("merge"), F.col("__r") == F.col("__root"), "left").select("__row", "__n", "__root", "__least")
    j = d.join(named, F.col("__key") == F.col("__row"), "left")
    own = unboxed("doc_id")
    component = F.when(F.col("__root").isNull(), own).otherwise(F.col("__least"))
    return j.select(*map(unboxed, keep), F.col("__n").alias("n_shingles"), component.alias("component_id"), F.coalesce(own == component, F.lit(False)).alias("kept"))


def _screened(pairs: DataFrame, nodes: DataFrame, percent: int, least: float) -> DataFrame:
    """Pairs (src, dst) whose set sizes and signatures allow the threshold."""
    a = nodes.select(F.col("__set").alias("src"), F.col("__n").alias("__na"), F.col("__sig").alias("__x"))
    b = nodes.select(F.col("__set").alias("dst"), F.col("__n").alias("__nb"), F.col("__sig").alias("__y"))
    sized = pairs.join(a, "src").join(b, "dst").where(F.least("__na", "__nb") * 100 >= F.greatest("__na", "__nb") * percent)
    return sized.select("src", "dst", "__x", "__y").mapInArrow(_screen_stars(least), "src binary, dst binary")


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets meet the threshold; only texts that are in a pair are read into sets."""
    pairs = materialise(pairs, "minhash-pairs")
    wanted = pairs.select(F.col("src").alias("__set")).unionByName(pairs.select(F.col("dst").alias("__set"))).distinct()
    sets = _sets(wanted, nodes, docs, shingle)
    both = pairs.join(sets.select(F.col("__set").alias("src"), F.col("__full").alias("__x")), "src").join(sets.select(F.col("__set").alias("dst"), F.col("__full").alias("__y")), "dst")
    return materialise(both.select("src", "dst", "__x", "__y").mapInArrow(_verify(percent), "src binary, dst binary"), "minhash-links")


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(__set, __full): the whole shingle sets of the nodes of ``wanted`` (__set), from one text each."""
    rows = nodes.select("__set", "__row").join(wanted, "__set", "left_semi")
    text = docs.select(row_key("doc_id", "text").alias("__row"), "text").join(rows, "__row")
    return materialise(text.select("__set", "text").mapInArrow(_full_sets(shingle), "__set binary, __full binary").dropDuplicates(["__set"]), "minhash-sets")


def _rest(members: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int, least: float, block: int) -> DataFrame:
    """Pairs of one bucket in different components, of which none is the bucket's least node, screened in blocks."""
    r = lambda node, name: roots.select(F.col("node").alias(node), F.col("root").alias(name))
    m = members.where("__size > 2 and __set <> __hub").join(r("__set", "__r"), "__set", "left").join(r("__hub", "__h"), "__hub", "left")
    m = m.select("__b", "__set", F.coalesce("__r", "__set").alias("__comp"), (F.coalesce("__r", "__set") != F.coalesce("__h", "__hub")).alias("__apart"))
    size = m.groupBy("__b").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("__nb"), F.count_if("__apart").alias("__k")).where("__k > 0").withColumn("__na", F.ceil(F.col("__k") / block).cast("int"))
    m = m.join(size, "__b").join(nodes.select("__set", "__n", "__sig"), "__set")
    tile = lambda n: F.pmod(F.xxhash64("__set"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["__b", "__i", "__j", "__set", "__comp", "__n", "__sig", "__side"]
    a = m.where("__apart").withColumn("__i", tile("__na")).withColumn("__j", each("__nb")).withColumn("__side", F.lit(0)).select(*cols)
    b = m.withColumn("__j", tile("__nb")).withColumn("__i", each("__na")).withColumn("__side", F.lit(1)).select(*cols)

    return a.unionByName(b).groupBy("__b", "__i", "__j").applyInArrow(_block(percent, least, None), "src binary, dst binary").distinct()


def _within(families: DataFrame, roots: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, percent: int, least: float, block: int) -> DataFrame:
    """Links between different components of a family, by pairs of tiles with full sets; a spanning forest of each group's."""
    f = families.select(F.col("node").alias("__set"), F.col("root").alias("__fam"))
    f = f.unionByName(families.select(F.col("root").alias("__set"), F.col("root").alias("__fam")).distinct())
    f = f.join(roots.select(F.col("node").alias("__set"), F.col("root").alias("__r")), "__set", "left").withColumn("__comp", F.coalesce("__r", "__set")).drop("__r")
    split = f.groupBy("__fam").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("__t"), (F.min("__comp") < F.max("__comp")).alias("__many")).where("__many").drop("__many")
    f = materialise(f.join(split, "__fam"), "minhash-families")
    full = _sets(f.select("__set"), nodes, docs, shingle)
    placed = f.join(nodes.select("__set", "__n", "__sig"), "__set").join(full, "__set").withColumn("__own", F.pmod(F.xxhash64("__set"), F.col("__t")).cast("int"))
    tiles = placed.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__t") - 1))).withColumn("__i", F.least("__own", "__other")).withColumn("__j", F.greatest("__own", "__other"))
    # a tile paired with itself is both sides
    side = F.when(F.col("__i") == F.col("__j"), 2).when(F.col("__own") == F.col("__i"), 0).otherwise(1)
    return tiles.select("__fam", "__i", "__j", "__set", "__comp", "__n", "__sig", side.alias("__side"), "__full").groupBy("__fam", "__i", "__j").applyInArrow(_block(percent, least, percent), "src binary, dst binary")


def _block(percent: int, least: float, decide: int | None):
    """Pairs of a left and a right row of different components that pass the screen (and with ``decide``
    the threshold on full sets), so many as join pieces: at most one less than the rows."""

    def run(t: pa.Table) -> pa.Table:
        side = t.column("__side").to_numpy()
        sig = np.frombuffer(b"".join(t.column("__sig").to_pylist()), np.uint8).reshape(t.num_rows, -1)
        keys = t.column("__set").to_pylist()
        piece = np.unique(np.array(t.column("__comp").to_pylist(), dtype=object), return_inverse=True)[1]
        full = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("__full")] if decide else None
        n = t.column("__n").to_numpy()
        right = np.flatnonzero(side >= 1)
        out = []
        for i in np.flatnonzero(side != 1):
            fit = right[(piece[right] != piece[i]) & (np.minimum(n[right], n[i]) * 100 >= np.maximum(n[right], n[i]) * percent)]
            fit = fit[(sig[fit] == sig[i]).sum(axis=1) >= least]
            for j in fit:
                if piece[j] == piece[i]:
                    continue
                if decide:
                    both = n[i] + n[j] - len(np.union1d(full[i], full[j]))
                    if 100 * both < decide * (n[i] + n[j] - both):
                        continue
                out.append((keys[i], keys[j]))
                piece[piece == piece[j]] = piece[i]
        return pa.table({"src": pa.array((a for a, _ in out), pa.binary()), "dst": pa.array((b for _, b in out), pa.binary())})

    return run


def oracle(shingle: int = 4, percent: int = 80) -> str:
    """DuckDB SQL over all documents: shingles as strings, pairs by shared shingle, reachability by recursion."""
    return f"""
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
    ), s AS (
      SELECT DISTINCT doc_id, CASE WHEN len(ws) < {shingle} THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + {shingle - 1}], ' ') END AS g
      FROM w, unnest(range(1, greatest(2, len(ws) - {shingle - 2}))) AS u(i) WHERE len(ws) > 0
    ), n AS (
      SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
    ), p AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS (
      SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {percent} * (x.n + y.n - k)
    ), reach AS (
      SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
    ), c AS (
      SELECT a, min(b) AS component_id FROM reach GROUP BY a
    )
    SELECT c.a AS doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.a = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.a
    """
