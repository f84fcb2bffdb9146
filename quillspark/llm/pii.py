"""Personal data by rules and by bootstrapped contextual extraction, with DataFrame functions only.

Rule matches of four kinds are the seeds. Tokens with a digit or an at sign, and runs of digit groups
with single spaces between them, are candidate instances; what surrounds one gives its lexical
patterns (word before and shape, shape and word after, word before and word after). Seeds give
patterns confidence, confident patterns give instances a score, and so on for a fixed number of
rounds over the aggregated pattern-instance graph. A pattern's instances that a rule refused, or that
are another kind's, count wholly against it; those that nothing is known of count against it a
little, until a pattern gives them a score. Instances of confident patterns that no rule has found
or refused become spans too.

Positions come without a Python call: splitting a text by a pattern gives what lies between its
matches, and lengths sum up to code-point offsets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import boxed, materialise, row_key, unboxed

KINDS = ("email", "ip", "card", "phone")
#: The rules' patterns, in the form that Java matches without stack growth or rescanning: groups
#: are possessive, and a run of the leading class is entered only at its start or where the
#: last match ended. The matches are those of the plain patterns.
RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without this character or these can have no match.
NEEDS = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9][ -]?[0-9]", "phone": "[+][0-9]"}
#: A run of digit groups with single spaces between them, or a token with a digit or an at sign: the candidates.
TOKEN = r"(?<!\S)(?:[+(]*+[0-9][0-9().,/-]*+(?:\x20[(]?[0-9][0-9().,/-]*+)*+(?!\S)|[^\s0-9@]*+[0-9@]\S*+)"
#: A word longer than this stands in a pattern by its digest.
LONG_WORD = 64
#: A match of the card's pattern with fewer digits says nothing about what it is.
NEAR_CARD = 12
#: Letters and digits of a discovered identifier, at least.
LEAST = 5
#: Stands for the kind of an instance that a rule refused.
REFUSED = "-"


def valid(kind: str, m: Column) -> Column:
    """Whether a match of a rule's pattern counts."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return F.forall(F.split(m, "[.]"), lambda x: F.coalesce(x.try_cast("bigint"), F.lit(999)) <= 255)
    if kind == "phone":
        return n.between(8, 15)
    if kind == "card":
        doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
        return F.when(n.between(16, 19), F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0).otherwise(False)
    return F.lit(True)


def located(docs: DataFrame, patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """Matches with their places: __id, __key, __kind, __i, __m, __start, __end, __left, __right.

    patterns: kind to (pattern, what a text must hold). One exchange brings a document's matches
    together and drops rows that repeat doc_id and text.
    """

    def word(g: Column, last: bool) -> Column:
        spaced = F.translate(g, "\t\n\r\f\x0b", "     ")
        w = F.lower(F.substring_index(F.rtrim(spaced) if last else F.ltrim(spaced), " ", -1 if last else 1))
        return F.when(F.length(w) > LONG_WORD, F.md5(w)).otherwise(w)

    found = F.array(
        *(
            F.when(
                F.col("text").rlike(needs),
                F.struct(
                    F.lit(kind).alias("kind"),
                    F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias("ms"),
                    F.transform(F.split("text", p, -1), lambda g: F.struct(F.length(g).alias("n"), word(g, True).alias("l"), word(g, False).alias("r"))).alias("gaps"),
                ),
            )
            for kind, (p, needs) in patterns.items()
        )
    )
    per_doc = (
        docs.select(F.col("doc_id").alias("__id"), "text").where(F.col("text").rlike("[0-9@]"))
        .select("__id", _key(), F.explode(found).alias("__f")).where("size(__f.ms) > 0")
        .groupBy("__id", "__key", F.col("__f.kind").alias("__kind")).agg(F.first("__f").alias("__f"))
    )
    rows = per_doc.select("__id", "__key", "__kind", F.posexplode(F.transform("__f.ms", lambda m, i: F.struct(m.alias("m"), F.get("__f.gaps", i).alias("g"), F.get("__f.gaps", i + 1)["r"].alias("r")))).alias("__i", "__x"))
    w = Window.partitionBy("__id", "__key", "__kind").orderBy("__i")
    end = F.sum(F.col("__x.g.n") + F.length("__x.m")).over(w)
    return rows.select("__id", "__key", "__kind", "__i", F.col("__x.m").alias("__m"), (end - F.length("__x.m")).alias("__start"), end.alias("__end"), F.col("__x.g.l").alias("__left"), F.col("__x.r").alias("__right"))


def _key() -> Column:
    return F.unhex(F.md5(F.concat_ws("\x1f", F.coalesce(F.concat(F.lit("="), F.col("__id").cast("string")), F.lit("-")), F.concat(F.lit("="), F.col("text"))))).alias("__key")


def shape(token: Column) -> Column:
    """A token's shape: runs of letters become a, of digits 9, mixed ones x; other characters stay."""
    mixed = F.regexp_replace(token, "(?<![A-Za-z0-9])(?:[A-Za-z]++[0-9]|[0-9]++[A-Za-z])[A-Za-z0-9]*+", "\u0001")
    return F.translate(F.regexp_replace(F.regexp_replace(mixed, r"\p{L}+", "a"), "[0-9]+", "9"), "\u0001", "x")


def discovered(tokens: DataFrame, rule_matches: DataFrame, rounds: int, confidence: float, support: int, doubt: float) -> DataFrame:
    """Spans that confident patterns add: __id, __key, __kind, __start, __end.

    tokens: candidates from ``located``; rule_matches: all matches of the rules' patterns, with
    ``__ok``. A candidate that touches a rule's match is a seed of its kind, or refused. A pattern's
    confidence in a kind is S / (S + N + doubt * U + 0.5): S the scores of its instances of the kind,
    at least ``support`` of them, N its instances that are refused or another kind's, U the others.
    """
    t = tokens.select("__id", "__key", F.rtrim(F.col("__m"), F.lit(".,;:!?)\"'")).alias("__v"), "__start", "__left", "__right").withColumn("__end", F.col("__start") + F.length("__v")).where("__end > __start")
    r = rule_matches.select(F.col("__key").alias("__rkey"), F.col("__kind").alias("__rkind"), F.col("__start").alias("__rs"), F.col("__end").alias("__re"), "__ok")
    # spans meet by stretches of 64 characters, so a text with many of both doesn't pair them all
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / 64), F.floor((F.col(b) - 1) / 64)))
    touch = t.withColumn("__c", cells("__start", "__end")).join(r.withColumn("__rc", cells("__rs", "__re")), (F.col("__key") == F.col("__rkey")) & (F.col("__c") == F.col("__rc")) & (F.col("__start") < F.col("__re")) & (F.col("__rs") < F.col("__end")), "left")
    t = touch.groupBy(*t.columns).agg(F.min(F.when(F.col("__ok"), F.col("__rkind"))).alias("__seed"), F.coalesce(F.max(F.lit(True) & F.col("__rkind").isNotNull()), F.lit(False)).alias("__seen"))
    pats = F.array(F.concat_ws("\u0002", F.lit("L"), "__left", "__shape"), F.concat_ws("\u0002", F.lit("R"), "__shape", "__right"), F.concat_ws("\u0002", F.lit("B"), "__left", "__right"))
    t = materialise(t.withColumn("__shape", shape(F.col("__v"))).withColumn("__pats", pats), "pii-tokens")
    edges = t.select(F.explode("__pats").alias("__p"), F.lower("__v").alias("__inst"), "__seed", "__seen").groupBy("__p", "__inst").agg(F.min("__seed").alias("__seed"), F.max("__seen").alias("__seen"))
    edges = materialise(edges, "pii-edges")
    if rounds < 1:
        return t.where("false").select("__id", "__key", F.lit("").alias("__kind"), "__start", "__end")
    # tables written for each round: a hot instance's edges meet its score by a join that Spark can split
    # all instances with what rules say of them; short ones (years, numbers of rooms) only count against patterns
    known = edges.groupBy("__inst").agg(F.min("__seed").alias("__kind"), F.max("__seen").alias("__seen"))
    known = materialise(known.select("__inst", F.coalesce("__kind", F.lit(REFUSED)).alias("__kind"), F.col("__kind").isNotNull().cast("double").alias("__s"), "__seen"), "pii-known")
    decided = known.where("__seen").drop("__seen")
    fresh = known.where((~F.col("__seen")) & (F.length(F.regexp_replace("__inst", r"[^\p{L}0-9]", "")) >= LEAST)).select("__inst")
    totals = edges.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    scores = decided
    for _ in range(rounds):
        mine = {k: F.when(F.col("__kind") == k, F.col("__s")) for k in KINDS}
        sums = edges.join(scores.hint("merge"), "__inst").groupBy("__p").agg(F.count(F.lit(1)).alias("__all"), *(F.struct(F.lit(k).alias("kind"), F.coalesce(F.sum(c), F.lit(0.0)).alias("sum"), F.count(c).alias("c")).alias(f"__{k}") for k, c in mine.items()))
        sums = sums.join(totals, "__p").select("__p", "__n", "__all", F.explode(F.array(*(f"__{k}" for k in KINDS))).alias("__x"))
        against = F.col("__all") - F.col("__x.c") + doubt * (F.col("__n") - F.col("__all"))
        conf = F.col("__x.sum") / (F.col("__x.sum") + against + 0.5)
        good = sums.where(F.col("__x.c") >= support).select("__p", F.col("__x.kind").alias("__kind"), conf.alias("__conf")).where(F.col("__conf") >= confidence)
        new = edges.join(good, "__p").join(fresh, "__inst", "left_semi").groupBy("__inst", "__kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("__conf"))))).alias("__s"))
        found = new.groupBy("__inst").agg(F.max(F.struct("__s", "__kind")).alias("__b")).select("__inst", F.col("__b.__kind").alias("__kind"), F.col("__b.__s").alias("__s"))
        found = materialise(found, "pii-found")
        scores = decided.unionByName(found)
    best = found.where(F.col("__s") >= confidence).select("__inst", "__kind")
    return t.where("not __seen").withColumn("__inst", F.lower("__v")).join(best.hint("merge"), "__inst").select("__id", "__key", "__kind", "__start", "__end")


def find_pii(docs: DataFrame, rounds: int = 3, confidence: float = 0.9, support: int = 5, doubt: float = 0.1) -> DataFrame:
    """Per row of ``docs``: doc_id, __key, and __base and __spans, arrays of (kind number, kind, start, end).

    Offsets count code points, end exclusive. Null and empty texts have no spans (empty arrays).
    Rows that repeat doc_id and text get the same result each; a null doc_id is a value like others.
    Equal spans of one kind count once. Other columns of ``docs`` don't matter. rounds: 0 finds what
    the rules find. confidence, support, doubt: see ``discovered``.
    """
    matches = located(docs, {k: (RULES[k], NEEDS[k]) for k in KINDS})
    ok = reduce(lambda a, k: F.when(F.col("__kind") == k, valid(k, F.col("__m"))).otherwise(a), KINDS, F.lit(False))
    # any two digits match the card's pattern: too few for a card, they are no refused one
    telling = (F.col("__kind") != "card") | (F.length(F.regexp_replace("__m", "[^0-9]", "")) >= NEAR_CARD)
    matches = materialise(matches.withColumn("__ok", ok).where(F.col("__ok") | telling), "pii-rules")
    more = discovered(located(docs, {"token": (TOKEN, "[0-9@]")}), matches, rounds, confidence, support, doubt)
    spans = matches.where("__ok").select("__id", "__key", "__kind", "__start", "__end", F.lit(True).alias("__rule")).unionByName(more.withColumn("__rule", F.lit(False)))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("__kind")).cast("int")
    item = F.struct(number.alias("n"), F.col("__kind").alias("kind"), F.col("__start").cast("long").alias("start"), F.col("__end").cast("long").alias("end"))
    grouped = spans.groupBy("__id", "__key").agg(F.array_sort(F.collect_set(F.when(F.col("__rule"), item))).alias("__base"), F.array_sort(F.collect_set(item)).alias("__spans"))
    d = docs.select("doc_id", row_key("doc_id", "text").alias("__dkey"))
    none = F.array().cast("array<struct<n:int,kind:string,start:bigint,end:bigint>>")
    return d.join(grouped.drop("__id"), F.col("__dkey") == F.col("__key"), "left").select("doc_id", F.col("__dkey").alias("__key"), F.coalesce("__base", none).alias("__base"), F.coalesce("__spans", none).alias("__spans"))


def digests(docs: DataFrame, **params) -> DataFrame:
    """Per document: number of rule spans by kind, digest of the rule spans, and all spans as text."""
    found = find_pii(docs, **params)
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: F.filter("__base", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text("__base").cast("binary"), 256).alias("base_sha256"), text("__spans").alias("spans"))


def mask(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in angle brackets; overlapping spans become one mark, of the first.

    Null and empty texts stay. Other columns pass, whatever their names.
    """
    found = find_pii(docs, **params).where("size(__spans) > 0").dropDuplicates(["doc_id", "__key"]).select(F.col("doc_id").alias("__id"), "__key", F.array_sort(F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("neg"), s["kind"].alias("kind")))).alias("__spans"))
    d, keep = boxed(docs)
    j = d.join(found.drop("__id"), "__key", "left")
    old = unboxed("text")
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(old, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        added = F.struct((-s["neg"]).alias("at"), F.concat(acc["parts"], F.array(F.concat(gap, F.lit("<"), F.upper(s["kind"]), F.lit(">")))).alias("parts"))
        grown = F.struct(F.greatest(acc["at"], -s["neg"]).alias("at"), acc["parts"].alias("parts"))
        return F.when(s["start"] >= acc["at"], added).otherwise(grown)

    done = F.aggregate("__spans", zero, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(old, (acc["at"] + 1).cast("int"), F.length(old))))
    text = F.when(F.col("__spans").isNull(), old).otherwise(done)
    return j.select(*(text.alias(c) if c == "text" else unboxed(c) for c in keep))
