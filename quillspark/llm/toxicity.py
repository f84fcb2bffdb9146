"""Toxicity by class-conditional Kneser-Ney models.

Each class (toxic, ordinary) has a model of its expressions (words). Occurrences in the class,
less an absolute discount, give the upper order; the mass the discount frees goes to one backoff
distribution that both classes share, made of continuation counts: in how many documents of
either class an expression turns up, not how often. An expression whose document counts don't
differ between the classes by a likelihood-ratio test, or whose estimates differ by less than a
factor of 20, is too rare or too even to have a class's own estimate and is left to the shared backoff,
which adds nothing to the comparison: many weak expressions can't outweigh few strong ones.

A text's value is the toxic less the ordinary log-likelihood, divided by the number of words and
some words more, so that one word doesn't decide a short text. An isotonic fit maps it to a
probability. That fit is crossed: the training rows fall into two folds, and a row's value for the
fit comes from the models of the other fold, which have not seen the row. The two thresholds were
chosen by the log-loss of these crossed values (``crossed``), so by training rows only.

Plan: one pass counts the labelled rows, one gives their crossed values, and one narrow pass scores
all rows. Texts are never shuffled unless the labels or the model outgrow stated bounds.
"""

from __future__ import annotations

import operator
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import boxed, materialise, row_key, unboxed

WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: CRC-32 of the id's decimal text leaves 2 by 4. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fold(doc_id: Column) -> Column:
    """0 or 1: which half of the training rows a row belongs to."""
    return (F.crc32(F.concat(doc_id.cast("string"), F.lit("/fold")).cast("binary")) % 2).cast("int")


class Known:
    """Labels by id for the tasks: sorted ids and whether each is toxic."""

    def __init__(self, t: pa.Table):
        order = np.argsort(ids := t.column("doc_id").to_numpy(zero_copy_only=False))
        self.ids, self.toxic = ids[order], t.column("__toxic").to_numpy()[order].astype(np.int8)

    def of(self, ids: pa.Array) -> np.ndarray:
        """1 toxic, 0 ordinary, -1 without label."""
        out = np.full(len(ids), -1, np.int8)
        valid = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
        if len(self.ids) and len(valid):
            own = ids.take(pa.array(valid)).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(self.ids, own), len(self.ids) - 1)
            hit = self.ids[at] == own
            out[valid[hit]] = self.toxic[at[hit]]
        return out


def training(docs: DataFrame, labels: DataFrame, max_known: int = 2_000_000) -> tuple[DataFrame, object | None]:
    """Rows to learn from (text, __fold, __toxic), and the labels in a broadcast if they are few.

    Labels: toxic if any of an id's is. Up to max_known labelled ids are sent to the tasks, which
    leave out the rows without label themselves: __toxic is null then, and set by ``_tagged``.
    More are joined by an exchange.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("__toxic"))
    known = materialise(known.where(~held_out(F.col("doc_id"))), "toxicity-labels")
    rows = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", fold(F.col("doc_id")).alias("__fold"))
    if known.count() <= max_known:
        return rows.withColumn("__toxic", F.lit(None).cast("int")), docs.sparkSession.sparkContext.broadcast(Known(known.toArrow()))
    return rows.join(known.hint("merge"), "doc_id"), None


def _tagged(b: pa.RecordBatch, known) -> Iterator[tuple[str | None, int, int]]:
    """(text, fold, class) of the batch's labelled rows."""
    toxic = b.column("__toxic").to_numpy(zero_copy_only=False) if known is None else known.value.of(b.column("doc_id"))
    texts, folds = b.column("text"), b.column("__fold").to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(toxic >= 0):
        yield texts[i].as_py(), int(folds[i]), int(toxic[i])


#: Occurrences and documents by fold and class.
CELLS = [f"{x}{f}{c}" for x in "nd" for f in (0, 1) for c in (0, 1)]
COUNTED = "word string, " + ", ".join(f"{c} long" for c in CELLS)


def _counter(known):
    """Occurrences and documents by fold and class of each word; the null word has the documents of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs = [Counter() for _ in CELLS], [0] * 4
        for b in batches:
            for text, f, c in _tagged(b, known):
                w = words(text)
                docs[2 * f + c] += 1
                seen[2 * f + c].update(w)
                seen[4 + 2 * f + c].update(set(w))
            if sum(map(len, seen[:4])) > 500_000:
                yield _counted(seen)
                seen = [Counter() for _ in CELLS]
        yield _counted(seen)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), *(pa.array([x], pa.int64()) for x in [0] * 4 + docs)], names=["word", *CELLS])

    return run


def _counted(seen: list[Counter]) -> pa.RecordBatch:
    keys = list(set().union(*seen[:4]))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in seen)], names=["word", *CELLS])


class Model:
    """Log-likelihood ratios of expressions, by interpolated Kneser-Ney smoothing."""

    def __init__(self, ratios: dict[str, float], prior_words: int = 50):
        self.ratios, self.prior_words = ratios, prior_words

    def value(self, text: str | None) -> float:
        w = words(text)
        get = self.ratios.get
        return sum(get(x, 0.0) for x in w) / (len(w) + self.prior_words)


#: Log-ratios are multiples of its reciprocal.
GRAIN = float(1 << 30)

#: The model of all training rows, and those of either fold.
MODELS = {"__ratio": (0, 1), "__ratio0": (0,), "__ratio1": (1,)}


def rated(docs: DataFrame, labels: DataFrame, discount: float = 0.75, evidence: float = 10.0, strength: float = 3.0) -> DataFrame | None:
    """word, __seen, __ratio: each word of the labelled rows that aren't held out, its documents and its
    log-ratio; __ratio0 and __ratio1 are those of the models of one fold.

    Each row counts, wholly. evidence: least likelihood-ratio statistic (one degree of freedom) of an
    expression's document counts. strength: least log-ratio, either way, of its class estimates. Their defaults
    are those of the least crossed log-loss, see ``crossed``. The ratio of a word below either is null. None without toxic or without ordinary words; a fold
    without one of them takes the model of all rows.
    """
    return _rated(*training(docs, labels), discount, evidence, strength)


def _rated(train: DataFrame, known, discount: float = 0.75, evidence: float = 10.0, strength: float = 3.0) -> DataFrame | None:
    counts = train.mapInArrow(_counter(known), COUNTED).groupBy("word").agg(*(F.sum(c).alias(c) for c in CELLS))
    counts = materialise(counts, "toxicity")
    isword = F.col("word").isNotNull()

    def cells(x: str, c: int, folds: tuple[int, ...]) -> Column:
        return reduce(operator.add, (F.col(f"{x}{f}{c}") for f in folds))

    aggs = []
    for name, folds in MODELS.items():
        for c in (0, 1):
            aggs += [F.coalesce(F.sum(F.when(isword, cells(x, c, folds))), F.lit(0)).alias(f"{x}{c}{name}") for x in "nd"]
            aggs += [F.count_if(isword & (cells("n", c, folds) > 0)).alias(f"t{c}{name}"), F.coalesce(F.sum(F.when(~isword, cells("d", c, folds))), F.lit(0)).alias(f"docs{c}{name}")]
    total = counts.agg(*aggs).first()
    if not total["n0__ratio"] or not total["n1__ratio"]:
        return None

    def ratio(name: str) -> Column:
        if not total[f"n0{name}"] or not total[f"n1{name}"]:
            return ratio("__ratio")
        n, d = ([cells(x, c, MODELS[name]) for c in (0, 1)] for x in "nd")
        seen = d[0] + d[1]

        def p(c: int) -> Column:
            backoff = seen * (discount * total[f"t{c}{name}"] / (total[f"d0{name}"] + total[f"d1{name}"]))
            return (F.greatest(n[c] - discount, F.lit(0.0)) + backoff) / total[f"n{c}{name}"]

        # multiples of a power of two: sums of them are exact, so that every plan gives the same value
        value = F.when(seen > 0, F.round(F.log(p(1) / p(0)) * GRAIN) / GRAIN)
        return F.when((_evidence(d, [total[f"docs{c}{name}"] for c in (0, 1)]) >= evidence) & (F.abs(value) >= strength), value)

    seen = cells("d", 0, (0, 1)) + cells("d", 1, (0, 1))
    return counts.where(isword).select("word", seen.alias("__seen"), *(ratio(name).alias(name) for name in MODELS))


def fit(docs: DataFrame, labels: DataFrame, prior_words: int = 50, **params) -> Model:
    """The whole model in the driver, for tables whose vocabulary it holds; ``score`` doesn't need that.

    prior_words: even words that each text counts besides its own. params: those of ``rated``.
    """
    words_rated = rated(docs, labels, **params)
    return Model({r["word"]: r["__ratio"] for r in words_rated.where("__ratio is not null").collect()} if words_rated else {}, prior_words)


def _shipped(words_rated: DataFrame | None, most: int) -> tuple[dict[str, tuple[float, float, float]], DataFrame | None]:
    """Ratios (of all rows, of fold 0, of fold 1) sent to every task, at most ``most`` words, and the table of
    the others to be joined (None if there are none).

    Without others the first are the model. Else they are the words seen in the most documents,
    even ones with 0, so that only rarer words have to travel to the table.
    """
    if words_rated is None:
        return {}, None
    filled = [F.coalesce(c, F.lit(0.0)).alias(c) for c in MODELS]
    get = lambda df: {r["word"]: tuple(r[c] for c in MODELS) for r in df.collect()}
    model = materialise(words_rated.where(F.coalesce(*MODELS).isNotNull()).select("word", *filled), "toxicity-model")
    if model.count() <= most:
        return get(model), None
    octave, cut, n = F.floor(F.log2("__seen")), 63, 0
    for r in sorted(words_rated.groupBy(octave.alias("o")).count().collect(), key=lambda r: -r["o"]):
        n += r["count"]
        if n > most:
            break
        cut = r["o"]
    return get(words_rated.where(octave >= cut).select("word", *filled)), model


def _evidence(d: list[Column], docs: list[int]) -> Column:
    """Twice the log-likelihood ratio of: a word's share of documents differs by class, against: it doesn't."""
    n = sum(docs)
    seen = d[0] + d[1]

    def part(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    return 2 * sum((part(d[c], seen * docs[c] / n) + part(docs[c] - d[c], docs[c] - seen * docs[c] / n) for c in (0, 1)), F.lit(0.0))


def calibration(bins: list[tuple[float, int, int]]) -> tuple[list[float], list[float]]:
    """Isotonic fit: (value, ordinary rows, toxic rows) ascending, to knots and their probabilities."""
    ordinary, toxic = sum(b[1] for b in bins), sum(b[2] for b in bins)
    prior = (toxic + 1) / (ordinary + toxic + 2)
    blocks: list[list[float]] = []  # [first value, last value, rows, toxic rows]
    for x, a, b in bins:
        blocks.append([x, x, a + b, b])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            hi = blocks.pop()
            blocks[-1] = [blocks[-1][0], hi[1], blocks[-1][2] + hi[2], blocks[-1][3] + hi[3]]
    xs, ps = [], []
    for lo, hi, n, k in blocks:
        p = (k + prior) / (n + 1)
        p = max(p, ps[-1]) if ps else p
        for x in dict.fromkeys((lo, hi)):
            xs.append(x)
            ps.append(p)
    return xs or [0.0], ps or [prior]


def _total(m: dict[str, tuple], which: int, w: list[str]) -> float:
    return sum(m[x][which] for x in w if x in m)


def _value(m: dict[str, tuple], which: int, w: list[str], prior_words: int) -> float:
    return _total(m, which, w) / (len(w) + prior_words)


def _bins(train: DataFrame, known, model, bin_width: float, prior_words: int) -> list[tuple[float, int, int]]:
    """(value, ordinary rows, toxic rows) of the training rows, each valued by the model of the other fold."""

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Counter()
        for b in batches:
            for text, f, c in _tagged(b, known):
                out[round(_value(model.value, 2 - f, words(text), prior_words) / bin_width), c] += 1
        keys = sorted({k for k, _ in out})
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), *(pa.array([out[k, c] for k in keys], pa.int64()) for c in (0, 1))], names=["b", "n0", "n1"])

    binned = train.mapInArrow(bins, "b int, n0 long, n1 long").groupBy("b").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    return [(r["b"] * bin_width, r["n0"], r["n1"]) for r in binned.orderBy("b").collect()]


def crossed(docs: DataFrame, labels: DataFrame, settings: list[dict], threshold: float = 0.3, bin_width: float = 0.002, prior_words: int = 50) -> list[dict]:
    """What each setting of ``rated``'s parameters gives on the training rows alone: the area under the curve of
    their crossed values, the log-loss of the fit to these, precision and recall at ``threshold``.

    This is how the defaults were chosen; rows that are held out have no part in it, neither their
    labels nor their texts. The models are sent to the tasks whole: for samples, not for all the world's labels.
    """
    train, known = training(docs, labels)
    out = []
    for params in settings:
        ratios, _ = _shipped(_rated(train, known, **params), 1 << 62)
        out.append(params | _figures(_bins(train, known, docs.sparkSession.sparkContext.broadcast(ratios), bin_width, prior_words), threshold))
    return out


def _figures(bins: list[tuple[float, int, int]], threshold: float) -> dict:
    xs, ps = calibration(bins)
    p = _probability(np.array([b[0] for b in bins]), xs, ps)
    n0, n1 = (np.array([b[i] for b in bins], float) for i in (1, 2))
    below = np.cumsum(n0) - n0
    auc = float((n1 * (below + n0 / 2)).sum() / max(n0.sum() * n1.sum(), 1.0))
    said, hit = (n0 + n1)[p >= threshold].sum(), n1[p >= threshold].sum()
    loss = -float((n1 * np.log(p) + n0 * np.log(1 - p)).sum() / max((n0 + n1).sum(), 1.0))
    return {"auc": auc, "loss": loss, "precision": float(hit / max(said, 1.0)), "recall": float(hit / max(n1.sum(), 1.0))}


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, bin_width: float = 0.002, prior_words: int = 50, max_shipped: int = 200_000, max_known: int = 2_000_000, **params) -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (1 if score >= threshold).

    A null or empty text has value 0, as an even text has. Labels are taken by doc_id (toxic if any
    label of an id is); rows that repeat an id are texts of their own. Without toxic or without
    ordinary training rows every score is the smoothed share of toxic ones. An empty table gives
    no rows. Other columns pass, whatever their names; columns of the three names are replaced.
    Every word of the model counts: at most max_shipped ratios are sent to the driver and the
    tasks, the others are joined to the texts' words as a table. At most max_known labels are sent,
    more are joined. Sent to the driver besides: one row per bin of values, which lie between the least and the greatest log-ratio.
    """
    spark = docs.sparkSession
    train, known = training(docs, labels, max_known)
    ratios, others = _shipped(_rated(train, known, **params), max_shipped)
    model = spark.sparkContext.broadcast(ratios)

    if others is not None:
        return _score_joined(docs, labels, model, others, threshold, bin_width, prior_words)
    xs, ps = calibration(_bins(train, known, model, bin_width, prior_words))
    keep = docs.drop("held_out", "score", "predicted")
    names = keep.columns

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.array([_value(model.value, 0, words(x.as_py()), prior_words) for x in b.column("text")], float)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(_probability(values, xs, ps))], names=[*names, "score"])

    scored = keep.mapInArrow(scores, keep.withColumn("score", F.lit(0.0)).schema)
    return scored.select(*(F.col(f"`{c}`") for c in names), held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def _probability(values: np.ndarray, xs: list[float], ps: list[float]) -> np.ndarray:
    """Calibrated probability, with a slight slope where the isotonic fit is flat."""
    return 0.99 * np.interp(values, xs, ps) + 0.01 / (1 + np.exp(-4 * np.clip(values, -8, 8)))


def _score_joined(docs: DataFrame, labels: DataFrame, model, others: DataFrame, threshold: float, bin_width: float, prior_words: int) -> DataFrame:
    """``score`` by a model that isn't sent to the tasks whole: words that are not in ``model`` are joined to ``others``."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            own = [words(x.as_py()) for x in b.column("text")]
            crossed = [_total(m, 0 if f is None else 2 - f, w) for w, f in zip(own, b.column("__fold").to_pylist(), strict=True)]
            cols = [b.column("doc_id"), b.column("__key"), b.column("__fold"), pa.array([_total(m, 0, w) for w in own], pa.float64()), pa.array(crossed, pa.float64())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([[x for x in w if x not in m] for w in own], pa.list_(pa.string())), pa.array([len(w) + prior_words for w in own], pa.int64())], names=["doc_id", "__key", "__fold", "__value", "__crossed", "__rest", "__n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", row_key("doc_id", "text").alias("__key"), fold(F.col("doc_id")).alias("__fold"), "text")
    valued = texts.mapInArrow(values, f"doc_id {kind}, __key binary, __fold int, __value double, __crossed double, __rest array<string>, __n long")
    valued = materialise(valued.dropDuplicates(["__key"]), "toxicity-values")
    crossed = F.when(F.col("__fold") == 0, F.col("__ratio1")).otherwise(F.col("__ratio0"))
    rest = valued.select(F.col("__key").alias("__rkey"), "__fold", F.explode("__rest").alias("word")).join(others, "word").groupBy("__rkey").agg(F.sum("__ratio").alias("__more"), F.sum(crossed).alias("__more_crossed"))
    sum_of = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0.0))) / F.col("__n")
    valued = materialise(valued.join(rest, F.col("__key") == F.col("__rkey"), "left").select("doc_id", "__key", sum_of("__value", "__more").alias("__value"), sum_of("__crossed", "__more_crossed").alias("__crossed")), "toxicity-values")
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("__toxic"))
    bin_of = F.bround(F.col("__crossed") / bin_width).cast("int")
    # as often as rows hold the text: the rows, not the distinct texts, are what the fit counts
    times = docs.groupBy(row_key("doc_id", "text").alias("__tkey")).agg(F.count(F.lit(1)).alias("__times"))
    rows = valued.where(~held_out(F.col("doc_id"))).join(known, "doc_id").join(times, F.col("__key") == F.col("__tkey"))
    n = lambda c: F.sum(F.when(F.col("__toxic") == c, F.col("__times")).otherwise(0)).alias(f"n{c}")
    binned = rows.groupBy(bin_of.alias("b")).agg(n(0), n(1))
    xs, ps = calibration([(r["b"] * bin_width, r["n0"], r["n1"]) for r in binned.orderBy("b").collect()])

    def probabilities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("__key"), pa.array(_probability(b.column("__value").to_numpy(), xs, ps))], names=["__k", "__score"])

    scored = valued.select("__key", "__value").mapInArrow(probabilities, "__k binary, __score double")
    d, keep = boxed(docs, ("held_out", "score", "predicted"))
    j = d.join(scored, F.col("__key") == F.col("__k"))
    return j.select(*map(unboxed, keep), held_out(unboxed("doc_id")).alias("held_out"), F.col("__score").alias("score"), F.when(F.col("__score") >= threshold, 1).otherwise(0).alias("predicted"))
