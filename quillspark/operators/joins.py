"""Join operators: tiers, identities, cardinality guards, rescue, pointers, rulings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tiered(left: DataFrame, right: DataFrame, tiers: list[tuple[Column, Column]], id: str, pick: str) -> DataFrame:
    """``left`` with the match of its first tier that has one: rule (1...), matches (how many), match (the least of ``pick``).

    A tier is a pair of keys, of the left and the right side; null keys match nothing. Each tier is
    an equi-join on groups of the right side, so no right row is repeated per left row; ambiguity
    (matches > 1) is reported, not resolved.
    """
    found = []
    for i, (lk, rk) in enumerate(tiers, 1):
        keys = right.select(rk.alias("__k"), F.col(pick).alias("__p")).where("__k is not null").groupBy("__k").agg(F.min("__p").alias("match"), F.count_distinct("__p").alias("matches"))
        found.append(left.select(F.col(id), lk.alias("__k")).join(keys, "__k").select(id, F.lit(i).alias("rule"), "match", "matches"))
    best = reduce(DataFrame.unionByName, found).groupBy(id).agg(F.min(F.struct("rule", "match", "matches")).alias("__b"))
    return left.join(best, id, "left").select(left["*"], "__b.rule", "__b.match", "__b.matches")


def classified(left: DataFrame, right: DataFrame, key: str, tolerated: str) -> DataFrame:
    """``left`` with ``state``: found, tolerated (the key carries a marker of a known broken reference) or missing."""
    r = right.select(F.col(key).alias("__k")).distinct()
    return left.join(r, F.col(key) == F.col("__k"), "left").withColumn("state", F.when(F.col("__k").isNotNull(), "found").when(F.col(key).startswith(tolerated), "tolerated").otherwise("missing")).drop("__k")


def identity(refs: DataFrame, clauses: DataFrame, rulings: DataFrame) -> DataFrame:
    """Three identities of a reference reconciled: file, clause id, title id.

    refs: ref, conref, id, title_id. clauses: conref, id. rulings: ref, action. ``decision``: agree,
    title-only (a fault), ruled, redirect (another file carries both ids), or a ruling's action,
    else unresolved.
    """
    by_file = clauses.select("conref", F.col("id").alias("file_id"))
    by_id = clauses.groupBy("id").agg(F.min("conref").alias("id_conref"), F.count(F.lit(1)).alias("id_files")).select(F.col("id").alias("title_id"), "id_conref", "id_files")
    j = refs.join(by_file, "conref", "left").join(by_id, "title_id", "left").join(rulings, "ref", "left")
    id_ok, title_ok = F.col("id").eqNullSafe(F.col("file_id")), F.col("title_id").eqNullSafe(F.col("file_id"))
    decision = (
        F.when(id_ok & title_ok, "agree").when(id_ok, "title-only").when(title_ok, F.coalesce("action", F.lit("id-only")))
        .when((F.col("id") == F.col("title_id")) & (F.col("id_files") == 1), "redirect").otherwise(F.coalesce("action", F.lit("unresolved")))
    )
    return j.select("ref", "conref", "id", "title_id", decision.alias("decision"), F.when(decision == "redirect", F.col("id_conref")).otherwise(F.col("conref")).alias("target"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Violations of uniqueness: key, n."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def recover(refs: DataFrame, siblings: DataFrame, rulings: DataFrame) -> DataFrame:
    """Ruled recoveries from another package: identities checked again, variations and pointers refused (``problem``)."""
    r = rulings.select("ref", "from", "conref", "wanted_id")
    j = refs.select("ref").join(r, "ref").join(siblings.select(F.col("package").alias("from"), "conref", F.col("id").alias("found_id"), "is_variation", "has_conref"), ["from", "conref"], "left")
    return j.withColumn("problem", F.when(F.col("found_id").isNull(), "not there").when(F.col("found_id") != F.col("wanted_id"), "another identity").when(F.col("is_variation"), "a variation").when(F.col("has_conref"), "a pointer"))


def splice(pointers: DataFrame, wrappers: DataFrame, most: int = 20) -> DataFrame:
    """Pointers followed to the wrapper that holds content: start, node, hops, state (content, empty, dangling, cyclic).

    pointers: start, target. wrappers: node (each once), points_to (null: holds content), empty.
    Chains are followed by doubling, five rounds of joins for 20 hops; one of ``most`` hops or more
    counts as cyclic.
    """
    # where a node leads to in 1, 2, 4, ... hops, or in fewer if it ends there: a round of joins for each bit of ``most``
    jump = wrappers.select("node", F.coalesce("points_to", "node").alias("to"), F.col("points_to").isNotNull().cast("int").alias("hops"))
    at = pointers.select("start", F.col("target").alias("node"), F.lit(0).alias("hops"))
    then = lambda a, key, j: a.join(j.select(F.col("node").alias("__n"), F.col("to").alias("__to"), F.col("hops").alias("__h")), F.col(key) == F.col("__n"), "left").withColumn(key, F.coalesce("__to", key)).withColumn("hops", F.col("hops") + F.coalesce("__h", F.lit(0))).drop("__n", "__to", "__h")
    for bit in range(most.bit_length()):
        if most >> bit & 1:
            at = then(at, "node", jump)
        if most >> bit > 1:
            jump = then(jump, "to", jump)
    end = at.join(wrappers.select(F.col("node").alias("__n"), "empty"), F.col("node") == F.col("__n"), "left")
    state = F.when(F.col("hops") >= most, "cyclic").when(F.col("__n").isNull(), "dangling").when(F.col("empty"), "empty").otherwise("content")
    return end.select("start", "node", "hops", state.alias("state"))


def state_files(hosts: DataFrame, files: DataFrame) -> DataFrame:
    """Hosts (host, stem, base_id, accepted_id, state) with their state's file: folded stem and state, else id and state taken apart from the stem.

    The prefix-and-suffix rule becomes an equi-join: the id token and the state are cut from each
    file's stem once, instead of testing every pair.
    """
    from quillspark.functions.text import norm_id, stem

    f = files.withColumn("__s", stem(F.col("name"))).withColumn("__state", F.regexp_extract("__s", "-([a-z]{2,3})$", 1)).withColumn("__id", F.regexp_extract("__s", "^([a-z]+[0-9]+[a-z]+[0-9]+|[^-]+)", 1))
    key = lambda x, y: F.concat_ws("|", x, y)
    low = F.lower(F.col("state"))
    return tiered(hosts, f, [
        (key(norm_id(F.col("stem")), low), key(F.regexp_replace("__s", "-[a-z]{2,3}$", ""), F.col("__state"))),
        (key(norm_id(F.col("base_id")), low), key(F.col("__id"), F.col("__state"))),
        (key(norm_id(F.col("accepted_id")), low), key(F.col("__id"), F.col("__state"))),
    ], "host", "name")


def variations(hosts: DataFrame, members: DataFrame) -> DataFrame:
    """Units that hosts' variations give: a DELETE gives itself, a REPLACE its target if that is a member; each target once."""
    own = hosts.where("type = 'DELETE'").select("host", F.col("host").alias("unit"), F.lit("DELETE").alias("type"))
    replaced = hosts.where("type = 'REPLACE'").join(members.select(F.col("unit").alias("target")).distinct(), "target", "left_semi").groupBy("target").agg(F.min("host").alias("host"))
    return own.unionByName(replaced.select("host", F.col("target").alias("unit"), F.lit("REPLACE").alias("type")))


def merge_sources(first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """The union of two sources, one row per key; the first source wins."""
    both = first.withColumn("__src", F.lit(0)).unionByName(second.withColumn("__src", F.lit(1)))
    cols = [c for c in first.columns if c not in key]
    best = both.groupBy(*key).agg(F.min(F.struct("__src", *cols)).alias("__b"))
    return best.select(*key, *(F.col(f"__b.{c}") for c in cols))


def rescued(members: DataFrame, reached: DataFrame, key: str, national: DataFrame | None = None) -> DataFrame:
    """Members that nothing reached; with a category inherited from the national entry of their term, if given."""
    left = members.join(reached.select(key).distinct(), key, "left_anti")
    if national is None:
        return left
    return left.join(national.groupBy("term").agg(F.min("category").alias("inherited")), "term", "left").withColumn("category", F.coalesce("category", "inherited")).drop("inherited")


def insert_only(accepted: DataFrame, base: DataFrame, ids: DataFrame) -> DataFrame:
    """Violations: references of the accepted view only, whose id nothing else supplies."""
    return accepted.join(base.select("ref").distinct(), "ref", "left_anti").join(ids.select("id").distinct(), "id", "left_anti")


def ruled(df: DataFrame, rulings: DataFrame, keys: list[str], name: str = "ruling") -> DataFrame:
    """``df`` with the id of the ruling that applies, by null-safe equality of all keys. Null-safe equality is an equi-join, so no side has to be small."""
    r = rulings.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("id").alias(name))
    return df.join(r, reduce(lambda a, k: a & F.col(k).eqNullSafe(F.col(f"__{k}")), keys, F.lit(True)), "left").drop(*(f"__{k}" for k in keys))


def reachable(cited: DataFrame, embedded: DataFrame, key: str) -> DataFrame:
    """Cited designations with the number of distinct holders that embed them; 0 or several are faults."""
    n = embedded.groupBy(key).agg(F.count_distinct("holder").alias("holders"), F.min("holder").alias("holder"))
    return cited.select(key).distinct().join(n, key, "left").select(key, F.coalesce("holders", F.lit(0)).alias("holders"), "holder")


def first_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by an ordinal."""
    cols = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.min(order).alias(order), *(F.min_by(c, order).alias(c) for c in cols))


def membership(files: DataFrame) -> DataFrame:
    """Clause files (base_id, accepted_id) with ``membership``: of both states under one designation or two, or of one state only."""
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    kind = F.when(~has("base_id"), "later only").when(~has("accepted_id"), "earlier only").when(F.col("base_id") == F.col("accepted_id"), "unchanged").otherwise("renumbered")
    return files.withColumn("membership", kind)


def renumbered(files: DataFrame) -> DataFrame:
    """Files whose designation the later state replaces by another of letters, digits and dots."""
    return membership(files).where((F.col("membership") == "renumbered") & F.col("accepted_id").rlike("^[A-Za-z0-9.]+$")).drop("membership")


def image_sources(images: DataFrame, files: DataFrame) -> DataFrame:
    """Image nodes (doc_id, pre, href) with the disk name of their package's file and a state.

    A name matches as it stands, else in lower case, else without its extension. A node without
    match is missing, one with several ambiguous: both are violations. Raster data in the href
    itself is skipped.
    """
    base = F.regexp_extract(F.regexp_replace("href", r"[?#].*$", ""), r"([^/\\]+)$", 1)
    of = images.where(~F.col("href").startswith("data:")).select("doc_id", "pre", F.struct("doc_id", "pre").alias("__node"), base.alias("__name"))
    key = lambda c: F.concat_ws("|", F.col("doc_id").cast("string"), c)
    low = lambda c: F.lower(F.col(c))
    bare = lambda c: F.regexp_replace(low(c), r"\.[^.]*$", "")
    found = tiered(of, files, [(key(F.col("__name")), key(F.col("name"))), (key(low("__name")), key(low("name"))), (key(bare("__name")), key(bare("name")))], "__node", "name")
    state = F.when(F.col("match").isNull(), "missing").when(F.col("matches") > 1, "ambiguous").otherwise("found")
    out = found.select("doc_id", "pre", F.when(state == "found", F.col("match")).alias("name"), state.alias("state"))
    return images.join(out, ["doc_id", "pre"], "left").withColumn("state", F.coalesce("state", F.lit("inline")))


def packaged(figures: DataFrame, documents: DataFrame, listings: DataFrame) -> DataFrame:
    """Figures (year, key, file) with the package of their document (year, key, package) and whether its listing
    (package, name) has the file: listed, not listed, or no package."""
    d = documents.select("year", "key", "package").distinct()
    has = listings.select("package", F.col("name").alias("file"), F.lit(True).alias("__there")).distinct()
    j = figures.join(d, ["year", "key"], "left").join(has, ["package", "file"], "left")
    return j.select("year", "key", "file", "package", F.when(F.col("package").isNull(), "no package").when(F.col("__there"), "listed").otherwise("not listed").alias("state"))


def collapse_runs(df: DataFrame, partition: list[str], order: list[str], key: str) -> DataFrame:
    """Gaps and islands: runs of equal ``key`` with their first ordinal and length."""
    w = Window.partitionBy(*partition).orderBy(*order)
    n = df.withColumn("__new", (~F.col(key).eqNullSafe(F.lag(key).over(w))).cast("int")).withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return n.groupBy(*partition, "__run", key).agg(F.count(F.lit(1)).alias("length")).drop("__run")
