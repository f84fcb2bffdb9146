"""Phrase collocations by position bitmaps, as SPAM mines sequences.

A task lays the words of its documents end to end, by language, into shards; where pieces or
documents meet stands a position without word. In a shard a word is a bitmap of its positions, of
which only blocks of 64 that aren't empty are kept. A phrase's bitmap has the positions of its last
word: shifted by one and ANDed with a word's bitmap it gives the bitmap of the phrase with that word,
and popcounts of its blocks how often that stands in the shard. A shift that meets a gap meets no
word, so phrases stay within pieces. Phrases are extended depth-first, a group of first words at a
time, so that the bitmaps of few phrases are held at once.

Counts of shards are summed by Spark. A phrase can only be frequent if its words and its shorter
phrases are; so each length is counted over all shards before the next, and a shard extends only
phrases that are frequent in all. Its own counts tell which of those it holds: a phrase's counts meet by one
exchange, their sum stays with each of them, and those of frequent phrases return to their shards. Nothing is broadcast. Shards are written once as compressed word ids,
and once more when the frequent words are known. A task takes a shard's rows in order, first
what the shard has to know, then its words, so no row holds more than a shard's words and no list is collected.

Then all is joins and aggregates over the frequent phrases: the counts of the parts of each cut, the
lowest-scoring cut, longer phrases that say the same, and the first phrases of each group.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import materialise
from quillspark.session import discard

#: Words of a task's open shards; rows of bitmaps (blocks that aren't empty) extended at a time.
SHARD_WORDS, ROWS_AT_ONCE = 2_000_000, 1 << 17

#: Letters A-Z in lower case; what ends a piece becomes a byte that UTF-8 doesn't have, a tab a space.
ENDS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(bytes(range(65, 91)) + ENDS + b"\t", bytes(range(97, 123)) + b"\xff" * len(ENDS) + b" ")
GAP = b"\xff"


def words(text: str | None) -> list[bytes]:
    """Words in order, with GAP where a piece ends. Of white space only spaces are left to split at."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).replace(GAP, b" \xff ").split()


class Shard:
    """Words of one group's documents as ids in order of first sight; 0 is no word."""

    def __init__(self):
        self.ids: dict[bytes, int] = defaultdict(count().__next__)
        self.ids[GAP], self.laid, self.n = 0, [], 0
        self.ids.default_factory = count(1).__next__

    def add(self, text: str | None) -> int:
        own = [*words(text), GAP]
        ids = self.ids
        self.laid.append(np.fromiter((ids[w] for w in own), np.int32, len(own)))
        self.n += len(own)
        return len(own)


def _sharded(by: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, Shard] = defaultdict(Shard)
        number, total, task = count(), 0, TaskContext.get().partitionId()
        for b in batches:
            for group, t in zip(b.column(by), b.column(text), strict=True):
                total += open_[group.as_py()].add(t.as_py())
                if total >= SHARD_WORDS:
                    most = max(open_, key=lambda g: open_[g].n)
                    done = open_.pop(most)
                    total -= done.n
                    yield from _laid(done, most, _number(task, next(number)))
        for g, s in open_.items():
            yield from _laid(s, g, _number(task, next(number)))

    return run


SHARDS = "shard bigint, grp string, local bigint, word string, n bigint, laid binary"
#: Bits of a shard's number within its task, and of a word's number within its shard.
IN_TASK, IN_SHARD = 12, 28


def _number(task: int, n: int) -> int:
    if n >> IN_TASK:
        raise ValueError("a task has too many shards: read smaller partitions")
    return (task << IN_TASK) + n


#: A shard's rows for a task are of a kind, with numbers (n1, n2, ...); this kind, the last, has its words instead.
BLOB = 99


def _laid(s: Shard, group: str, number: int) -> Iterator[pa.RecordBatch]:
    """The words of a shard with their counts, then one row with all its ids."""
    x = np.concatenate(s.laid)
    n = np.bincount(x, minlength=len(s.ids))[1:]
    names = [w.decode("utf-8", "surrogatepass") for w in s.ids if w != GAP]
    for words_, counts, laid in ((names, n, None), ([None], [None], _packed(x))):
        k = len(words_)
        local = pa.array(np.arange(1, k + 1)) if laid is None else pa.array([None], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([number] * k, pa.int64()), pa.array([group] * k, pa.string()), local, pa.array(words_, pa.string()), pa.array(counts, pa.int64()), pa.array([laid] * k, pa.binary())], names=["shard", "grp", "local", "word", "n", "laid"])


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def _unpacked(laid: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(laid)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """(shard, words, numbers by column) of rows sorted by shard and kind."""
    held = []
    for b in batches:
        kind = b.column("kind").to_numpy(zero_copy_only=False)
        numbers = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names if c[0] == "n"])
        start = 0
        for end in np.flatnonzero(kind == BLOB).tolist():
            yield b.column("shard")[end].as_py(), _unpacked(b.column("laid")[end].as_py()), np.concatenate([*held, numbers[:, start:end]], axis=1)
            held, start = [], end + 1
        held.append(numbers[:, start:].copy())


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of frequent words only: their number, their global ids in order, and at each position the place of its word
    among these, from 1; 0 for others and for gaps. Shards without frequent words go."""
    for shard, laid, (local, gid) in _by_shard(batches):
        x = np.frombuffer(laid, np.int32)
        if len(gid):
            order = np.argsort(gid)
            of = np.zeros(int(max(x.max(), local.max())) + 1, np.int32)
            of[local[order]] = np.arange(1, len(gid) + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([_packed(np.array([len(gid)], np.int64), gid[order], of[x])], pa.binary())], names=["shard", "laid"])


class Bitmaps:
    """Positions of the frequent words of a shard (``y``: the word at each position, from 0; negative: none).

    Rows (word, block, bits) by word and block; row_of: the row that holds the bit of a position.
    """

    def __init__(self, y: np.ndarray):
        at = np.flatnonzero(y >= 0)
        at = at[np.argsort(y[at], kind="stable")].astype(np.int32)
        w, b = y[at], at >> 6
        first = np.ones(len(at), bool)
        first[1:] = (w[1:] != w[:-1]) | (b[1:] != b[:-1])
        starts = np.flatnonzero(first)
        self.word, self.block = w[starts], b[starts]
        bit = np.uint64(1) << (at & 63).astype(np.uint64)
        self.bits = np.bitwise_or.reduceat(bit, starts) if len(at) else bit
        self.row_of = np.zeros(len(y), np.int32)
        self.row_of[at] = np.cumsum(first, dtype=np.int32) - 1
        # positions that hold any of the words
        self.any = np.zeros((len(y) >> 6) + 2, np.uint64)
        np.bitwise_or.at(self.any, self.block, self.bits)

    def extended(self, phrase: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bitmaps of phrases shifted by one place and ANDed with those of all words that follow: (phrase, word, block, bits)."""
        over = bits >> np.uint64(63)
        c = over > 0
        phrase, block, bits = np.concatenate((phrase, phrase[c])), np.concatenate((block, block[c] + 1)), np.concatenate((bits << np.uint64(1), over[c]))
        bits &= self.any[block]
        out = []
        while True:
            left = bits != 0
            phrase, block, bits = phrase[left], block[left], bits[left]
            if not len(bits):
                break
            lowest = bits & (~bits + np.uint64(1))
            row = self.row_of[(block.astype(np.int64) << 6) + np.bitwise_count(lowest - np.uint64(1))]
            both = bits & self.bits[row]
            out.append((phrase, self.word[row], block, both))
            bits = bits ^ both
        if not out:
            return phrase, phrase, block, bits
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Level:
    """Frequent phrases of one length in a shard: sorted keys (phrase without its last word, last word), their words,
    and which phrase of the length below each is without its first word."""

    def __init__(self, keys: np.ndarray, words: np.ndarray, tail: np.ndarray):
        self.keys, self.words, self.tail = keys, words, tail

    def find(self, phrase: np.ndarray, word: np.ndarray, n_words: int) -> np.ndarray:
        """Places of (phrase, word), -1 for those that aren't there."""
        if not len(self.keys):
            return np.full(len(word), -1, np.int64)
        key = phrase.astype(np.int64) * n_words + word
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, i, -1)


def _levels(n: int, known: np.ndarray) -> list[Level]:
    """Levels of the words (places 0 to n) and of the phrases in ``known`` (a row of words each) with all phrases inside them."""
    levels = [Level(np.arange(n, dtype=np.int64), np.arange(n)[:, None], np.zeros(n, np.int64))]

    def index(words_: np.ndarray) -> np.ndarray:
        at = words_[:, 0]
        for d in range(1, words_.shape[1]):
            at = levels[d].find(at, words_[:, d], n)
        return at

    m = known.shape[1]
    for k in range(2, m + 1):
        inside = np.concatenate([known[:, i : i + k] for i in range(m - k + 1)])
        keys, first = np.unique(index(inside[:, :-1]) * n + inside[:, -1], return_index=True)
        levels.append(Level(keys, inside[first], index(inside[first][:, 1:])))
    return levels


def counted(x: np.ndarray, local: np.ndarray, gids: np.ndarray, known: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """How often phrases stand in a shard that are one word longer than those of ``known`` (pairs without it): (global ids
    of their words, a row a phrase; counts), by groups.

    x: local word ids. local, gids: frequent words. known: the shard's phrases of one length that are frequent in all shards, a row of global ids each.
    """
    order = np.argsort(gids)
    local, gids = local[order], gids[order]
    n = len(gids)
    if not n:
        return
    of = np.full(max(int(x.max(initial=0)), int(local.max())) + 1, -1, np.int32)
    of[local] = np.arange(n, dtype=np.int32)
    maps = Bitmaps(of[x])
    places = np.arange(n)[:, None]
    if known is not None:
        places = np.minimum(np.searchsorted(gids, known), n - 1)
        places = places[(gids[places] == known).all(axis=1)]
    levels = _levels(n, places)

    cuts = np.concatenate(([0], np.flatnonzero(np.diff(maps.word)) + 1, [len(maps.word)]))
    first = 0
    while first < len(maps.word):
        last = int(cuts[max(np.searchsorted(cuts, first + ROWS_AT_ONCE, side="right") - 1, np.searchsorted(cuts, first, side="right"))])
        phrase, block, bits = maps.word[first:last].astype(np.int64), maps.block[first:last], maps.bits[first:last]
        first = last
        for depth in range(len(levels)):
            phrase, word, block, bits = maps.extended(phrase, block, bits)
            below = levels[depth]
            if depth:  # the phrase without its first word is frequent, too
                ok = below.find(below.tail[phrase], word, n) >= 0
                phrase, word, block, bits = phrase[ok], word[ok], block[ok], bits[ok]
            if depth + 1 < len(levels):
                place = levels[depth + 1].find(phrase, word, n)
                ok = place >= 0
                phrase, block, bits = place[ok], block[ok], bits[ok]
        keys, which = np.unique(phrase * n + word, return_inverse=True)
        sums = np.bincount(which, weights=np.bitwise_count(bits), minlength=len(keys)).astype(np.int64)
        yield np.column_stack((gids[levels[-1].words[keys // n]], gids[keys % n])), sums


def _counting(k: int):
    """Counts of phrases of k words; before a shard's words come its frequent phrases of one word less, if these are more than words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, laid, numbers in _by_shard(batches):
            n = int(np.frombuffer(laid, np.int64, 1)[0])
            gids, x = np.frombuffer(laid, np.int64, n, 8), np.frombuffer(laid, np.int32, offset=8 * (n + 1))
            for phrases, sums in counted(x, np.arange(1, n + 1), gids, numbers.T if k > 2 else None):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (np.full(len(sums), shard), *phrases.T, sums)], names=["shard", *_words(k), "n"])

    return run


def _words(k: int) -> list[str]:
    return [f"w{i}" for i in range(1, k + 1)]


def _rows(df: DataFrame, kind: int, *numbers: str) -> DataFrame:
    return df.select("shard", F.lit(kind).alias("kind"), *(F.col(c).alias(f"n{i}") for i, c in enumerate(numbers)), F.lit(None).cast("binary").alias("laid"))


def _blobs(df: DataFrame, numbers: int) -> DataFrame:
    return df.select("shard", F.lit(BLOB).alias("kind"), *(F.lit(0).cast("long").alias(f"n{i}") for i in range(numbers)), "laid")


def _sorted(first: DataFrame, last: DataFrame) -> DataFrame:
    return first.unionByName(last).repartition("shard").sortWithinPartitions("shard", "kind")


def frequent_phrases(docs: DataFrame, by: str = "lang", text: str = "text", least: int = 30, longest: int = 4, other: str = "und") -> tuple[DataFrame, DataFrame]:
    """(grp, phrase, words, n) of words and phrases of up to ``longest`` words that stand at least ``least`` times in the
    texts of a group, and (grp, total) with the words of each group.

    phrase: words joined by spaces. Occurrences within pieces count, overlaps included. The rows of a
    null group are those of ``other``. Null and empty texts have no words; repeated rows count again.
    """
    rows = docs.select(F.coalesce(F.col(f"`{by}`").cast("string"), F.lit(other)).alias("grp"), F.col(f"`{text}`").alias("text"))
    shards = materialise(rows.mapInArrow(_sharded("grp", "text"), SHARDS), "phrases-shards")
    vocabulary = shards.where("word is not null").select("shard", "grp", "local", F.col("word").alias("phrase"), "n")
    totals = materialise(vocabulary.groupBy("grp").agg(F.sum("n").alias("total")), "phrases-totals")
    # a word is known by its number in the first shard that has it; that row stands for it
    each, own = Window.partitionBy("grp", "phrase"), F.shiftleft("shard", IN_SHARD) + F.col("local")
    here = vocabulary.withColumn("total", F.sum("n").over(each)).withColumn("gid", F.min(own).over(each)).where(F.col("total") >= least)
    here = materialise(here.select("shard", "local", "gid", *(F.when(F.col("gid") == own, F.col(c)).alias(c) for c in ("grp", "phrase", "total"))), "phrases-1")
    one = here.where("phrase is not null").select("gid", "grp", "phrase", F.col("total").alias("n"))
    dense = materialise(_sorted(_rows(here, 0, "local", "gid"), _blobs(shards.where("laid is not null"), 2)).mapInArrow(_dense, "shard bigint, laid binary"), "phrases-dense")
    discard(shards)
    levels, held = [one.select("grp", "phrase", F.array("phrase").alias("words"), "n")], None
    for k in range(2, longest + 1):
        w = _words(k)
        rows = _blobs(dense, 1) if held is None else _sorted(_rows(held, k, *w[:-1]), _blobs(dense, k - 1))
        counts = rows.mapInArrow(_counting(k), ", ".join(f"{c} bigint" for c in ["shard", *w, "n"]))
        # a phrase has a row for each shard, so nothing is left to combine before the exchange
        each = Window.partitionBy(*w)
        summed = counts.withColumn("total", F.sum("n").over(each)).withColumn("first", F.min("shard").over(each))
        last, held = held, materialise(summed.where(F.col("total") >= least).drop("n"), f"phrases-{k}")
        if last is not None:
            discard(last)
        named = held.where("shard = first").select(*w, F.col("total").alias("n"))
        for i, c in enumerate(w):
            named = named.join(one.select(F.col("gid").alias(c), F.col("phrase").alias(f"p{i}"), *(["grp"] if i == 0 else [])), c)
        own = [f"p{i}" for i in range(k)]
        levels.append(materialise(named.select("grp", F.concat_ws(" ", *own).alias("phrase"), F.array(*own).alias("words"), "n"), f"phrases-{k}-named"))
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out, totals


def collocations(docs: DataFrame, by: str = "lang", text: str = "text", least: int = 30, longest: int = 4, top: int = 2000, same: int = 80, other: str = "und") -> DataFrame:
    """The ``top`` phrases of each group by the score of their lowest-scoring cut: group, rank (from 1), phrase, a, l, r, n, score.

    A candidate is a phrase of 2 to ``longest`` words that stands a times, ``least`` at least. A cut
    after its first words gives l and r, how often the two parts stand, and floor(2000000 a / (l + r));
    the lowest counts, the first of equal ones. A candidate inside a longer one that stands
    ``same`` per cent as often or more is dropped, whatever becomes of the longer one. Phrases rank
    by score, then a, both descending, then by the bytes of their words joined by spaces. n: words of the group.
    Null groups are ``other``; an empty table, or one without frequent phrases, gives no rows.
    """
    every, totals = frequent_phrases(docs, by, text, least, longest, other)
    counts = every.select("grp", F.col("phrase").alias("part"), "n")
    cand = every.where("size(words) > 1").withColumnRenamed("n", "a")
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    joined = lambda first, n: F.array_join(F.slice("words", first, n), " ")
    cuts = cand.select("grp", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("grp", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    part = lambda side, name: counts.select("grp", F.col("part").alias(side), F.col("n").alias(name))
    cuts = cuts.join(part("left", "l"), ["grp", "left"]).join(part("right", "r"), ["grp", "right"])
    cuts = cuts.withColumn("score", F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r)"))
    best = cuts.groupBy("grp", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    inner = cand.where("size(words) > 2").select("grp", "a", F.explode(F.expr("flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))")).alias("phrase"))
    inner = inner.groupBy("grp", "phrase").agg(F.max("a").alias("longer"))
    left = best.join(inner, ["grp", "phrase"], "left").where(F.coalesce(exact("longer") * 100 < exact("a") * same, F.lit(True)))
    w = Window.partitionBy("grp").orderBy(F.desc("m.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return ranked.join(totals, "grp").select(F.col("grp").alias(by), F.col("rank").cast("long").alias("rank"), "phrase", "a", "m.l", "m.r", F.col("total").alias("n"), "m.score")


def oracle() -> str:
    """``op11_phrases`` in DuckDB, by lists of words."""
    return r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM t),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM p, range(1, 5) r(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= 30),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
c AS (SELECT lang, phrase, n AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.lang, c.phrase, a, cut, l.n AS l, r.n AS r, ((a::HUGEINT * 2000000) // (l.n + r.n))::BIGINT AS score FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[:cut], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, phrase, max(n) AS longer FROM (SELECT lang, n, unnest(list_transform(range(1, k - m + 2), lambda x: array_to_string(w[x:x + m - 1], ' '))) AS phrase FROM (SELECT lang, n, k, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS m FROM f WHERE k > 2)) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, total.n AS n, score
FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase JOIN total ON total.lang = b.lang WHERE longer IS NULL OR 100 * longer < 80 * a QUALIFY rank <= 2000"""
