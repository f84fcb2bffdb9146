"""Periodic runs of words by the divide and conquer of Main and Lorentz.

A run is a stretch of words that repeats with a period and that no neighbour extends. Words are
interned to ids. A document is halved again and again; a run of four periods or more that crosses a
midpoint has two periods on one side of it at least, so the words right of the midpoint (or left of
it, read backwards) repeat at once with that period: the Z-function of that half, at the distance of
the period, is no less than the period. Such repetitions are extended both ways to the document's
bounds; intervals found at several midpoints come once, with their smallest period.

All halves of one depth, of many documents, are handled side by side in numpy. The first 16 words
of all distances are compared at once. Distances that survive are decided one by one, by comparing
blocks, or where a half has many of them by its whole Z-function in linear time; a distance inside a
run that is already known is skipped, for it can only be a multiple of that run's period. So the work
is n log n in the words of a document, whatever they repeat.

Plan: a narrow transformation of rows, no shuffle; a task holds about a million words (or one document) at a time.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words compared for all distances at once; distances in one half that are decided by comparing blocks.
FIRST, FEW = 16, 32
WORDS_AT_ONCE = 1_000_000


def words(text: str | None) -> list[bytes]:
    """Stretches of bytes other than space and the controls 9 to 13."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def z_function(x: list[int]) -> list[int]:
    """z[i]: how many items from i on agree with those from the start, in linear time; z[0] is the length."""
    n = len(x)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:  # all that is known agrees: go on from there
            while i + k < n and x[k] == x[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    if n:
        z[0] = n
    return z


def agree(x: np.ndarray, a: int, b: int, most: int) -> int:
    """How many items from a on agree with those from b on, ``most`` at most."""
    n, step = 0, 64
    while n < most:
        k = min(step, most - n)
        d = x[a + n : a + n + k] != x[b + n : b + n + k]
        i = int(d.argmax())
        if d[i]:
            return n + i
        n, step = n + k, min(4 * step, 1 << 16)
    return n


class Side:
    """Repetitions right of midpoints; the left ones are those of the reversed words."""

    def __init__(self, x: np.ndarray):
        self.x, self.back = x, x[::-1]
        self.found: list[tuple[int, int, int]] = []
        self.known: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)  # by document and period: (start, end), sorted

    def survivors(self, mid: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(half, distance) of distances 1 to reach whose first words, FIRST at most, repeat."""
        half = np.repeat(np.arange(len(mid)), reach)
        q = np.arange(len(half)) - np.repeat(np.cumsum(reach) - reach, reach) + 1
        at, last = mid[half], len(self.x) - 1
        for t in range(FIRST):
            same = (q <= t) | (self.x[np.minimum(at + t, last)] == self.x[np.minimum(at + t + q, last)])
            half, q, at = half[same], q[same], at[same]
            if not len(half) or t + 1 >= q.max():
                break
        return half, q

    def search(self, mid: np.ndarray, hi: np.ndarray, doc: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> None:
        half, q = self.survivors(mid, (hi - mid) // 2)
        for h, own in zip(*_groups(half, q), strict=True):
            self._decide(int(mid[h]), int(hi[h]), int(doc[h]), int(lows[doc[h]]), int(highs[doc[h]]), own.tolist())

    def _decide(self, m: int, hi: int, doc: int, low: int, high: int, distances: list[int]) -> None:
        z, i = None, 0
        while i < len(distances):
            q = distances[i]
            i += 1
            runs = self.known.get((doc, q), [])
            k = bisect_right(runs, (m, high + 1)) - 1
            if k >= 0 and runs[k][1] >= m + 2 * q:
                end = runs[k][1]
            else:
                if q > FIRST:
                    if z is None and i > FEW:
                        z = z_function(self.x[m:hi].tolist())
                    if (z[q] if z is not None else agree(self.x, m, m + q, q)) < q:
                        continue
                end = m + q + agree(self.x, m, m + q, high - m - q)
                n = len(self.x)
                start = m - agree(self.back, n - m, n - m - q, m - low)
                self.found.append((start, end, q))
                runs = self.known[doc, q]
                runs.insert(bisect_left(runs, (start, end)), (start, end))
            # larger distances that repeat inside this run are multiples of its period
            i = bisect_right(distances, (end - m) // 2, i)


def _groups(half: np.ndarray, q: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(half):
        return [], []
    cuts = np.flatnonzero(np.diff(half)) + 1
    return half[np.concatenate(([0], cuts))].tolist(), np.split(q, cuts)


def runs(x: np.ndarray, bounds: np.ndarray, least: int = 6, exponent: int = 4) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of the runs of documents laid end to end (``x``: ids, bounds: where
    documents begin, and the end), by document, start and period. length is ``least`` and ``exponent`` periods at least."""
    if exponent < 4:
        raise ValueError("runs of fewer than four periods needn't have two periods on one side of a midpoint")
    lows, highs, n = bounds[:-1], bounds[1:], len(x)
    right, left = Side(x), Side(x[::-1])
    doc = np.flatnonzero(highs - lows >= least)
    lo, hi = lows[doc], highs[doc]
    while len(doc):
        mid = (lo + hi) // 2
        right.search(mid, hi, doc, lows, highs)
        left.search(n - mid, n - lo, doc, n - highs, n - lows)
        doc, lo, hi = np.concatenate((doc, doc)), np.concatenate((lo, mid)), np.concatenate((mid, hi))
        large = hi - lo >= least
        doc, lo, hi = doc[large], lo[large], hi[large]
    smallest: dict[tuple[int, int], int] = {}
    for s, e, q in (*right.found, *((n - e, n - s, q) for s, e, q in left.found)):
        if e - s >= max(least, exponent * q):
            smallest[s, e] = min(q, smallest.get((s, e), q))
    where = sorted((s, q, e) for (s, e), q in smallest.items())
    docs = np.searchsorted(bounds, [s for s, _, _ in where], side="right") - 1
    return [(d, s - int(lows[d]), e - s, q) for d, (s, q, e) in zip(docs.tolist(), where, strict=True)]


def interned(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of texts, their ids end to end, and the bounds of the texts."""
    split = [words(t) for t in texts]
    ids: dict[bytes, int] = defaultdict(count().__next__)
    bounds = np.concatenate(([0], np.cumsum([len(w) for w in split], dtype=np.int64)))
    return split, np.fromiter((ids[w] for ws in split for w in ws), np.int64, int(bounds[-1])), bounds


def collapse(split: list[bytes], own: list[tuple[int, int, int]]) -> str:
    """The words that no run contains after its first period, joined by single spaces."""
    keep = np.ones(len(split), bool)
    for s, n, q in own:
        keep[s + q : s + n] = False
    return b" ".join(split if keep.all() else [split[i] for i in np.flatnonzero(keep)]).decode("utf-8", "surrogatepass")


def find_runs(docs: DataFrame, text: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """``docs`` with n_words, runs (start, length, period; by start and period, starts count words from 0) and collapsed.

    A run has the smallest period of its words, is of ``least`` words and of ``exponent`` (4 or more)
    periods at least, and no neighbouring word extends it. collapsed is the text without what runs
    repeat: a word goes if a run holds it after the run's first period; the others are joined by
    single spaces. A null, empty or blank text has no words, no runs and an empty collapsed text. A
    run may lie in another or overlap it. Each row is its own; repeated rows have equal results, and an
    empty table gives no rows. Other columns pass, whatever their names; those of the three names are replaced.
    """
    keep = docs.select(*(f"`{c}`" for c in docs.columns if c not in ("n_words", "runs", "collapsed")))
    names = keep.columns

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column, first, chars = b.column(text), 0, 0
            sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
            for i, size in enumerate(sizes):
                chars += size
                if chars >= 6 * WORDS_AT_ONCE or i + 1 == len(sizes):
                    yield _batch(b.slice(first, i + 1 - first), names, text, least, exponent)
                    first, chars = i + 1, 0

    extra = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    shape = docs.sparkSession.createDataFrame([], extra).schema
    out = type(shape)([*keep.schema.fields, *shape.fields])
    return keep.mapInArrow(found, out)


def _batch(b: pa.RecordBatch, names: list[str], text: str, least: int, exponent: int) -> pa.RecordBatch:
    split, x, bounds = interned(b.column(text).to_pylist())
    own: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for d, *run in runs(x, bounds, least, exponent):
        own[d].append(tuple(run))
    lists = [own.get(i, []) for i in range(len(split))]
    flat = [r for rs in lists for r in rs]
    struct = pa.StructArray.from_arrays([pa.array([r[i] for r in flat], pa.int64()) for i in range(3)], names=["start", "length", "period"])
    offsets = pa.array(np.concatenate(([0], np.cumsum([len(rs) for rs in lists]))), pa.int32())
    cols = [pa.array(np.diff(bounds), pa.int64()), pa.ListArray.from_arrays(offsets, struct), pa.array([collapse(w, rs) for w, rs in zip(split, lists, strict=True)], pa.string())]
    return pa.RecordBatch.from_arrays([*(b.column(n) for n in names), *cols], names=[*names, "n_words", "runs", "collapsed"])


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for a tenth of the ids (CRC-32 of the decimal id divisible by ten) its words with a repetition planted in them:
    from word a on, words repeat with period p, which the id gives. A null id plants nothing."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    split = F.array(F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0)))

    def plant(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.concat(F.slice(w, F.lit(1), a), F.transform(F.sequence(a, n - 1), lambda i: F.element_at(w, a + (i - a) % p + 1)))

    # one element that holds the words, so that they are taken apart once
    changed = F.array_join(F.transform(split, lambda w: F.when(F.size(w) > 0, plant(w)).otherwise(w))[0], " ")
    return F.when((h % 10 == 0) & text.isNotNull(), changed).otherwise(text)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs; start, length, period and exponent_milli of the longest run (ties: smallest start, then period;
    null without runs); runs_sha256 and collapsed_sha256, of all runs and of the text without repetitions, in hexadecimal.

    Repetitions are planted first (``planted``). docs: doc_id and text.
    """
    r = find_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    lines = F.transform("runs", lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n")))
    top = F.array_max(F.transform("runs", lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period"))))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return r.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("t"), sha(F.array_join(lines, "")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("t.start")).alias("start"), "t.length", (-F.col("t.period")).alias("period"), F.expr("1000 * t.length div -t.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )
