"""Sources mixed to target weights by Pareto order sampling.

A source's target (in words) over its size gives the copies that each of its words should have on
average. The whole part of that are certain copies of every document; the rest is the chance of one
copy more, and who gets it is decided by order sampling: a document's rank is the odds of a random
number that its id and text give, divided by the odds of its inclusion, and the lowest ranks are
taken, as many as the chances sum up to. So the number of copies is fixed, whatever the chances.

Words are to be fixed as well, though documents differ in length. So samples are taken in strata:
documents of a source whose sizes are within an eighth of each other. From the largest sizes down
each stratum takes the whole number of documents that comes closest to the words it should give;
the chances inside it tilt towards the longer or shorter documents until the expected words are
those wanted (half as much more or less at most), and what remains is carried to the next smaller
sizes. Whole documents are taken, never parts.

Plan: the rows given are written once, without texts if the caller leaves them out. Strata are
sums; a source has some hundred at most, whatever its rows, and their chain is one array. The cut
of a stratum is found by counts in 1,024 ranges of rank, so that only the range that holds the cut
is ever sorted: a source with a third of all rows is spread over all tasks. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import materialise
from quillspark.operators import scan

WORDS = "[^\\x20\\x09-\\x0D]+"
RANGES = 1024


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)).cast("long"), F.lit(0).cast("long"))


def uniform(*cols: str) -> Column:
    """A number inside (0, 1) that the values of the columns give; nulls and empty strings differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in cols]
    return (F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def size_class(size: str) -> Column:
    """Sizes below 8 stand alone, larger ones are classed by eighths of an octave; larger sizes have larger classes."""
    e = f"(length(bin({size})) - 4)"
    return F.expr(f"CASE WHEN {size} < 8 THEN {size} ELSE 8 * {e} + shiftright({size}, {e}) END").cast("int")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sizes`` (source, source_size; one row a source) with target: ``share`` of all sizes dealt out by weight.

    Weights go to the sources in the order of their code points, null last, and repeat. No target
    exceeds ``most`` times its source's size; what is above goes to the others by weight, until none
    is above. share must not exceed most. The level (words a weight) that all sources below their
    limits share rises until those at their limits no longer change; a round is one sum over the sources.
    """
    ranked = scan.places(sizes, [F.col("source").asc_nulls_last()], "__rank")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("__rank") - 1) % len(weights) + 1).cast("int"))
    s = materialise(ranked.select("source", "source_size", weight.alias("__weight"), (F.col("source_size") * float(most)).alias("__limit")), "mixing-sources")
    total = share * (s.agg(F.sum("source_size")).first()[0] or 0)
    full, level = -1, 0.0
    while True:
        at_limit = F.col("__limit") <= F.col("__weight") * level
        r = s.agg(F.count_if(at_limit).alias("n"), F.sum(F.when(at_limit, F.col("__limit"))).alias("taken"), F.sum(F.when(~at_limit, F.col("__weight"))).alias("w")).first()
        if r["n"] == full or not r["w"]:
            return s.select("source", "source_size", F.least("__limit", F.col("__weight") * level).alias("target"))
        full, level = r["n"], (total - (r["taken"] or 0.0)) / r["w"]


def _chain(ratio: Column, strata: Column) -> Column:
    """The strata of a source (cls, n, s, q: documents, sum and sum of squares of sizes), largest sizes first, with
    ``take``, how many get a copy more, and ``tilt``; folded from one to the next with the words still owed."""
    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<struct<cls:int,take:long,n:long,mean:double,tilt:double>>").alias("done"))

    def step(a: Column, x: Column) -> Column:
        mean = x["s"] / x["n"]
        goal = ratio * x["s"] + a["owed"]
        take = F.greatest(F.lit(0), F.least(x["n"], F.when(x["s"] > 0, F.floor(goal / mean + 0.5)).otherwise(0)))
        left = goal - take * mean
        spread = (x["q"] * x["n"]).cast("double") / (x["s"].cast("double") * x["s"].cast("double")) - 1.0
        most = F.least(F.lit(4.0), 7.5 * (x["n"] - take) / take)
        tilt = F.when((take > 0) & (take < x["n"]) & (spread > 1e-9), F.greatest(-most, F.least(most, left / (take * mean * spread)))).otherwise(0.0)
        got = F.struct(x["cls"].alias("cls"), take.cast("long").alias("take"), x["n"].alias("n"), mean.alias("mean"), tilt.alias("tilt"))
        owed = F.when(x["s"] > 0, left - F.when(tilt != 0, take * mean * spread * tilt).otherwise(0.0)).otherwise(a["owed"])
        return F.struct(owed.alias("owed"), F.concat(a["done"], F.array(got)).alias("done"))

    return F.aggregate(F.reverse(F.array_sort(strata)), start, step, lambda a: a["done"])


def mix(docs: DataFrame, size: str = "size", key: tuple[str, ...] = ("doc_id",), weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``docs`` with source_size, target (both of a row's source) and taken (words the mix takes of the row: its size times its copies).

    docs: source, the size in words and the columns of ``key``, whose values decide the random
    numbers; other columns pass. A null source is a source of its own, a null or negative size is 0.
    Rows of equal key have equal random numbers; which of them are taken is decided by size, so rows
    that are equal throughout stand for each other and reruns give the same rows. Sizes of 0 take
    nothing. If all sizes are 0 all targets are. An empty table gives no rows. Columns named
    source_size, target and taken are replaced.
    """
    spare = docs.drop("source_size", "target", "taken")
    names = spare.columns
    sized = spare.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("__row"), "source", F.greatest(F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)), F.lit(0)).alias("__size"), uniform(*key).alias("__u"))
    t = materialise(sized.withColumn("__cls", size_class("__size")), "mixing-rows")
    strata = materialise(t.groupBy("source", "__cls").agg(F.count(F.lit(1)).alias("n"), F.sum("__size").alias("s"), F.sum(F.col("__size").cast("decimal(20,0)") * F.col("__size")).cast("decimal(38,0)").alias("q")), "mixing-strata")
    aims = targets(strata.groupBy("source").agg(F.sum("s").alias("source_size")), weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aims = aims.withColumn("__whole", F.floor(ratio)).withColumn("__part", ratio - F.floor(ratio))
    by_source = strata.groupBy("source").agg(F.collect_list(F.struct(F.col("__cls").alias("cls"), "n", "s", "q")).alias("strata"))
    chained = aims.join(by_source.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).select("source", "source_size", "target", "__whole", F.explode(_chain(F.col("__part"), F.col("strata"))).alias("x"))
    plan = materialise(chained.select("source", "source_size", "target", "__whole", F.col("x.cls").alias("__cls"), "x.take", "x.n", "x.mean", "x.tilt"), "mixing-plan")

    chance = F.col("take") / F.col("n") * (1.0 + F.col("tilt") * (F.col("__size") / F.col("mean") - 1.0))
    odds = lambda p: p / (1.0 - p)
    # the Pareto rank, times the stratum's own odds, mapped to (0, 1): the order within a stratum is the same, and the values are spread evenly
    pareto = odds(F.col("__u")) / odds(chance) * odds(F.col("take") / F.col("n"))
    sampled = (F.col("take") > 0) & (F.col("take") < F.col("n"))
    p = plan.withColumnRenamed("source", "__source").withColumnRenamed("__cls", "__pcls")
    ranked = t.join(p, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__cls") == F.col("__pcls"))).drop("__source", "__pcls")
    ranked = ranked.withColumn("__v", F.when(sampled, pareto / (1.0 + pareto))).withColumn("__range", F.floor(F.col("__v") * RANGES).cast("int"))
    of = ["source", "__cls"]
    counts = ranked.where("__range is not null").groupBy(*of, "take", "__range").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*of).orderBy("__range"))
    cut = counts.withColumn("__upto", upto).where("__upto >= take and __upto - c < take")
    cut = materialise(cut.select(F.col("source").alias("__source"), F.col("__cls").alias("__pcls"), F.col("__range").alias("__cut"), (F.col("take") - (F.col("__upto") - F.col("c"))).alias("__last")), "mixing-cuts")
    ranked = ranked.join(cut, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__cls") == F.col("__pcls")), "left")
    # only the range of the cut is put in order
    edge = F.coalesce(F.col("__range") == F.col("__cut"), F.lit(False))
    more = F.when(F.col("take") == F.col("n"), 1).when(F.col("__range") < F.col("__cut"), 1).otherwise(0)
    w = Window.partitionBy(*of).orderBy("__v", "__size", "__u")
    out = ranked.where(~edge).withColumn("__more", more).unionByName(ranked.where(edge).withColumn("__more", F.when(F.row_number().over(w) <= F.col("__last"), 1).otherwise(0)))
    return out.select(*(F.col(f"__row.`{c}`") for c in names), "source_size", "target", (F.col("__size") * (F.col("__whole") + F.col("__more"))).cast("long").alias("taken"))


def oracle() -> str:
    """``op13_mixing`` in DuckDB: the targets by a closed form, the chain of the strata by recursion, each stratum sorted whole."""
    return r"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(text) AS h FROM documents),
u AS (SELECT *, (('0x' || left(md5(coalesce('=' || doc_id, '-') || chr(31) || coalesce('=' || h, '-')), 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u,
  CASE WHEN size < 8 THEN size ELSE 8 * (length(bin(size)) - 4) + (size >> (length(bin(size)) - 4)) END AS cls FROM d),
src AS (SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM u GROUP BY source),
lev AS (SELECT w, 2::DOUBLE * source_size AS lim, (1.5::DOUBLE * (SELECT sum(source_size) FROM src)::DOUBLE - coalesce(sum(2::DOUBLE * source_size) OVER (ORDER BY source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, source_size / w AS o FROM src),
t AS (SELECT source, source_size, least(2::DOUBLE * source_size, w * coalesce((SELECT level FROM lev WHERE lim > w * level ORDER BY o LIMIT 1), 0)) AS target FROM src),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole, CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0 END AS ratio FROM t),
st AS (SELECT source, cls, count(*) AS n, sum(size)::BIGINT AS s, sum(size::HUGEINT * size)::HUGEINT AS q, row_number() OVER (PARTITION BY source ORDER BY cls DESC) AS k FROM u GROUP BY source, cls),
ch AS (
  SELECT source, 0::BIGINT AS k, 0::DOUBLE AS owed, 0::BIGINT AS cls, 0::BIGINT AS n, 0::DOUBLE AS mean, 0::BIGINT AS take, 0::DOUBLE AS tilt FROM r
  UNION ALL
  SELECT source, k, CASE WHEN s > 0 THEN lft - CASE WHEN tilt <> 0 THEN take * mean * spread * tilt ELSE 0 END ELSE goal END, cls, n, mean, take, tilt FROM (
    SELECT *, CASE WHEN take > 0 AND take < n AND spread > 1e-9::DOUBLE THEN greatest(-least(4::DOUBLE, 7.5::DOUBLE * (n - take) / take), least(least(4::DOUBLE, 7.5::DOUBLE * (n - take) / take), lft / (take * mean * spread))) ELSE 0 END AS tilt FROM (
      SELECT *, goal - take * mean AS lft, CASE WHEN s > 0 THEN (q * n)::DOUBLE / (s::DOUBLE * s::DOUBLE) - 1::DOUBLE END AS spread FROM (
        SELECT *, greatest(0, least(n, CASE WHEN s > 0 THEN floor(goal / mean + 0.5::DOUBLE) ELSE 0 END))::BIGINT AS take FROM (
          SELECT st.source, st.k, st.cls, st.n, st.s, st.q, st.s / st.n AS mean, CASE WHEN st.s > 0 THEN r.ratio * st.s + ch.owed ELSE ch.owed END AS goal
          FROM ch JOIN st ON st.source IS NOT DISTINCT FROM ch.source AND st.k = ch.k + 1 JOIN r ON r.source IS NOT DISTINCT FROM st.source))))),
p AS (SELECT u.*, take, n, take::DOUBLE / n AS base, take::DOUBLE / n * (1::DOUBLE + tilt * (size / mean - 1::DOUBLE)) AS chance FROM u JOIN ch ON u.source IS NOT DISTINCT FROM ch.source AND u.cls = ch.cls AND ch.k > 0),
v AS (SELECT *, CASE WHEN take > 0 AND take < n THEN (u / (1::DOUBLE - u)) / (chance / (1::DOUBLE - chance)) * (base / (1::DOUBLE - base)) END AS pareto FROM p),
x AS (SELECT *, row_number() OVER (PARTITION BY source, cls ORDER BY pareto / (1::DOUBLE + pareto), size, u) AS rank FROM v)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN rank <= take THEN 1 ELSE 0 END))::BIGINT AS taken FROM x JOIN r ON x.source IS NOT DISTINCT FROM r.source"""
