"""Phrases by a positional index: postings (word, text, line, position), and phrases as joins of them.

The index is written once and serves any number of phrases. All phrases of a call are looked for in
one plan: the words of each are counted, the rarest is joined first, so the key of a common word
never opens a join unless a phrase has no other; the next rarest thins the candidates, and the rest
confirms them by text, line and place less offset. Candidates are written between these steps, so
that Spark knows how few they are and sends them to the postings instead of moving those.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.session import cut


def squeezed(text: Column) -> Column:
    """The words of a text, whatever white space stands between them."""
    return F.filter(F.split(F.regexp_replace(text, "\\s+", " "), " "), lambda w: w != "")


def _fits(phrases: list[str]) -> list[tuple[str, int, Column]]:
    """(phrase, offset, whether ``word`` may stand there in a line that holds the phrase). The first word of a phrase may be the
    end of a longer one, the last its beginning, a single one any part. An empty phrase is refused."""
    if not all(phrases):
        raise ValueError("an empty phrase is in every line")
    word = F.col("word")

    def fits(pieces: list[str], i: int) -> Column:
        if len(pieces) == 1:
            return F.contains(word, F.lit(pieces[0]))
        return word.endswith(pieces[0]) if i == 0 else word.startswith(pieces[i]) if i == len(pieces) - 1 else word == pieces[i]

    return [(p, i, fits(p.split(" "), i)) for p in dict.fromkeys(phrases) for i in range(len(p.split(" ")))]


def index(texts: DataFrame, doc: str = "doc_id", text: str = "text", lines: bool = False, ordered: bool = True, phrases: list[str] | None = None) -> DataFrame:
    """Postings (row, doc, line, pos, word) of ``texts``, written once and, if ``ordered``, sorted by word within a
    file, so that a filter on words reads the pages of those words only: for an index that is to be kept.

    lines: each line is cut at single spaces, so that words and places say all of it (two spaces
    enclose an empty word). Else a text is one line of its words. row tells texts apart whose
    ids repeat or are null. A null text has no postings. phrases: only the words that ``lines_with``
    looks up for these, for an index of lines that serves them and no others.
    """
    t = texts.select(F.col(doc).alias("doc"), F.col(text).alias("__t"))
    cores = texts.sparkSession.sparkContext.defaultParallelism
    if t.rdd.getNumPartitions() < cores:  # a small file is one task's; its texts are dealt out
        t = t.repartition(cores)
    t = t.withColumn("row", F.monotonically_increasing_id())
    if lines:
        t = t.select("row", "doc", F.posexplode(F.split("__t", "\n")).alias("line", "__t"))
        words = F.split("__t", " ", -1)
    else:
        t = t.select("row", "doc", F.lit(0).alias("line"), "__t")
        words = squeezed(F.col("__t"))
    postings = t.select("row", "doc", "line", F.posexplode(words).alias("pos", "word"))
    if phrases is not None:
        postings = postings.where(functools.reduce(Column.__or__, (ok for _, _, ok in _fits(phrases)), F.lit(False)))
    return cut(postings.sortWithinPartitions("word") if ordered else postings, "postings")


def parts_of(passages: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(phrase, off, word) of each passage's words."""
    return passages.select(F.col(key).alias("phrase"), F.posexplode(squeezed(F.col(text))).alias("off", "word"))


def occurrences(postings: DataFrame, parts: DataFrame, alternatives: bool = False) -> DataFrame:
    """(phrase, row, doc, line, start): where all parts of a phrase stand one after the other.

    parts (phrase, off, word): offsets from 0 on; several words may stand for one offset. A phrase
    without parts, or with an offset of which no word is in the index, is nowhere. Repeated phrases are one.
    alternatives: many words may; a candidate then asks for the word at a place, not for each that would do there.
    """
    parts = cut(parts.where("phrase is not null").distinct(), "parts")
    words = parts.select("word").distinct()
    counts = postings.select("word").join(words, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    each = parts.join(counts, "word", "left").groupBy("phrase", "off").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    # the offsets of a phrase, rarest first
    order = each.groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct("n", "off"))).alias("o")).where(F.col("o")[0]["n"] > 0)
    ranked = cut(order.select("phrase", F.size("o").alias("length"), F.posexplode(F.transform("o", lambda x: x["off"])).alias("rank", "off")).join(parts, ["phrase", "off"]), "parts")
    first = ranked.where("rank = 0")
    found = first.join(postings, "word").select("phrase", "length", "row", "doc", "line", (F.col("pos") - F.col("off")).alias("start"))
    found = cut(found.where("start >= 0"), "candidates")
    at = ["row", "line", "pos"]
    place = postings.select(*at, "word")
    keep = ["phrase", "length", "row", "doc", "line", "start"]

    def confirmed(df: DataFrame, which: str) -> DataFrame:
        """Candidates with each of the offsets ``which`` where one of its words stands. What they expect is written first: little, it goes to the postings."""
        if not alternatives:
            parts_ = df.join(ranked.where(which).select("phrase", "off", "word"), "phrase").withColumn("pos", F.col("start") + F.col("off"))
            return cut(parts_.select(*keep, "pos", "word"), "expected").join(place, [*at, "word"]).select(*keep)
        asked = df.join(ranked.where(which).select("phrase", "off").distinct(), "phrase").withColumn("pos", F.col("start") + F.col("off"))
        return cut(asked.select(*keep, "off", "pos"), "expected").join(place, at).join(parts, ["phrase", "off", "word"], "left_semi").select(*keep)

    found = cut(found.where("length = 1").unionByName(confirmed(found.where("length > 1"), "rank = 1")), "candidates")
    rest = confirmed(found.where("length > 2"), "rank > 1").groupBy(*keep).agg(F.count(F.lit(1)).alias("n")).where("n = length - 2").select(*keep)
    return found.where("length <= 2").unionByName(rest).drop("length")


def containment(passages: DataFrame, texts: DataFrame) -> DataFrame:
    """(item_id, doc_id) of passages that texts contain word for word (white space as single spaces).

    An empty or null passage is in no text. Repeated rows give a pair once, null ids none.
    """
    found = occurrences(index(texts, ordered=False), parts_of(passages))
    return found.where("doc is not null").select(F.col("phrase").alias("item_id"), F.col("doc").alias("doc_id")).distinct()


def lines_with(postings: DataFrame, phrases: list[str]) -> DataFrame:
    """(phrase, row, doc, line): lines that hold one of ``phrases`` as a substring, from an index of lines.

    Words that may stand at a phrase's ends as parts of longer ones are looked up among the distinct words of
    the index, and only their postings are read on. A phrase with a line break is in no line; an empty one is refused.
    """
    each = [F.struct(F.lit(p).alias("phrase"), F.lit(i).alias("off"), ok.alias("ok")) for p, i, ok in _fits(phrases)]
    if not each:
        return postings.limit(0).select(F.lit("").alias("phrase"), "row", "doc", "line")
    words = postings.select("word").distinct().select("word", F.explode(F.filter(F.array(*each), lambda x: x["ok"])).alias("x"))
    words = cut(words.select("x.phrase", "x.off", "word"), "words")
    postings = postings.join(words.select("word").distinct(), "word", "left_semi")
    return occurrences(postings, words, alternatives=True).select("phrase", "row", "doc", "line").distinct()
