"""Group-and-fold operators: uniqueness by path, glossary senses, link index, censuses, parity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import body_of, prose_list
from quillspark.functions.urls import rewrite_prefix
from quillspark.session import cut


def neutral(content: Column, prefix: Column) -> Column:
    """A body with its document's image prefix replaced by a placeholder, so that copies compare equal."""
    return rewrite_prefix(content, prefix, F.lit("{figures}"))


def digests(records: DataFrame) -> DataFrame:
    """``records`` (path, kind, doc, ord, content, prefix) with digests of their contents, as they stand and after neutralising image prefixes, instead of these."""
    d, nd = F.unhex(F.sha2("content", 256)), F.unhex(F.sha2(neutral(F.col("content"), F.col("prefix")), 256))
    return records.select("path", "kind", "doc", "ord", d.alias("__d"), nd.alias("__nd"))


def resolve_unique(records: DataFrame) -> DataFrame:
    """One row per path: outcome (single, identical, merged, folded, conflict), the canonical record's ordinal, documents and bodies.

    records: path, kind, doc, ord (document order, then place), content, prefix. Texts are read once
    and leave as digests, of which each document's distinct ones are written; what is collected in order is a
    path's documents, as many as publish.
    """
    return resolve_digests(digests(records))


def resolve_digests(records: DataFrame) -> DataFrame:
    """``resolve_unique`` of what ``digests`` gives."""
    # one pass over the texts; what follows reads digests only
    r = cut(records.groupBy("path", "kind", "doc", "__d", "__nd").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n")), "digests")
    per_doc = r.groupBy("path", "doc").agg(F.max("kind").alias("kind"), F.min("ord").alias("ord"), F.count_distinct("__d").alias("senses"), F.sum("n").alias("n"))
    docs = per_doc.groupBy("path").agg(F.max("kind").alias("kind"), F.sum("n").alias("records"), F.min("ord").alias("canonical"), F.max("senses").alias("senses"), F.array_sort(F.collect_list(F.struct("ord", "doc"))).alias("docs"))
    all_ = r.groupBy("path").agg(F.count_distinct("__d").alias("contents"), F.count_distinct("__nd").alias("classes"))
    outcome = (
        F.when(F.col("records") == 1, "single").when(F.col("contents") == 1, "identical")
        .when((F.col("kind") == "glossary") & (F.col("senses") > 1), "merged").when(F.col("kind") == "glossary", "folded").otherwise("conflict")
    )
    return all_.join(docs, "path").select("path", outcome.alias("outcome"), "canonical", "records", "contents", "classes", F.transform("docs", lambda s: s["doc"]).alias("documents"))


def copies(records: DataFrame) -> DataFrame:
    """(k, canonical, copies, documents): records (k, ord, doc) of equal key folded: the first ordinal, how many there are,
    and their documents in the order in which they were first seen. A key's records are summed up by document before they meet."""
    per_doc = records.groupBy("k", "doc").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n"))
    g = per_doc.groupBy("k").agg(F.min("ord").alias("canonical"), F.sum("n").alias("copies"), F.array_sort(F.collect_list(F.struct("ord", "doc"))).alias("d"))
    return g.select("k", "canonical", "copies", F.transform("d", lambda x: x["doc"]).alias("documents"))


def fold_classes(records: DataFrame) -> DataFrame:
    """Per path and body class (after neutralising image prefixes): first ordinal, documents in order, body."""
    r = records.withColumn("__nd", F.sha2(neutral(F.col("content"), F.col("prefix")), 256))
    g = r.groupBy("path", "__nd").agg(F.min("ord").alias("first"), F.min_by("content", "ord").alias("content"), F.array_sort(F.collect_set(F.struct("ord", "doc"))).alias("__docs"))
    return g.select("path", "first", F.array_distinct(F.transform("__docs", lambda s: s["doc"])).alias("documents"), "content")


def merge_senses(classes: DataFrame) -> DataFrame:
    """One text per path: a single class gives its body, several give theirs under a heading each, with the documents that publish it."""
    parts = F.array_sort(F.collect_list(F.struct("first", "documents", F.trim(body_of(F.col("content")), F.lit("\n")).alias("body"))))
    g = classes.groupBy("path").agg(parts.alias("p"))
    many = F.array_join(F.transform("p", lambda s, i: F.concat(F.lit("## Definition "), (i + 1).cast("string"), F.lit(" ("), prose_list(s["documents"]), F.lit(")\n\n"), s["body"])), "\n\n")
    return g.select("path", F.size("p").alias("senses"), F.when(F.size("p") == 1, F.col("p")[0]["body"]).otherwise(many).alias("body"))


def ordered_union(df: DataFrame, key: str, items: str, order: str, name: str) -> DataFrame:
    """The distinct items of a key's arrays in the order in which they were first seen."""
    g = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, items))).alias("__a"))
    return g.select(key, F.array_distinct(F.flatten(F.transform("__a", lambda s: s[items]))).alias(name))


def first_difference(pairs: DataFrame) -> DataFrame:
    """(key, line, left, right) where two texts (key, a, b) first differ; lines count from 1."""
    n = F.greatest(F.size(F.split("a", "\n")), F.size(F.split("b", "\n")))
    both = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((i + 1).alias("line"), F.get(F.split("a", "\n"), i).alias("left"), F.get(F.split("b", "\n"), i).alias("right")))
    return pairs.select("key", F.get(F.filter(both, lambda s: ~s["left"].eqNullSafe(s["right"])), F.lit(0)).alias("d")).where("d is not null").select("key", "d.line", "d.left", "d.right")


def parity(units: DataFrame, tables: DataFrame, expected: DataFrame) -> DataFrame:
    """Counts by (doc, parent) of units and table references against what is expected; delta 0 is right. Only whole documents are compared."""
    u = units.where("full").groupBy("doc", "parent").agg(F.count(F.lit(1)).alias("units"))
    t = tables.groupBy("doc", "parent").agg(F.count(F.lit(1)).alias("refs"))
    j = u.join(t, ["doc", "parent"], "full_outer").join(expected, ["doc", "parent"], "full_outer")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return j.select("doc", "parent", z("units").alias("units"), z("refs").alias("refs"), z("expected").alias("expected"), (z("units") + z("refs") - z("expected")).alias("delta"))


def warning_category(warning: Column) -> Column:
    """What stands before the first colon, else the whole text; ``other`` for an empty one."""
    return F.when(F.trim(warning) == "", "other").when(F.contains(warning, F.lit(":")), F.trim(F.substring_index(warning, ":", 1))).otherwise(F.trim(warning))


def census(paths: DataFrame) -> DataFrame:
    """Files by edition and folder with subtotals and the total (nulls stand for all)."""
    parts = F.split("path", "/")
    return paths.select(parts[0].alias("edition"), F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), "/").alias("dir")).rollup("edition", "dir").agg(F.count(F.lit(1)).alias("files"))


def link_index(urls: DataFrame, host: str, states: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Page URLs to an index (key, url), its collisions (key, urls) and refused URLs.

    Keys: volume/section/ for a section page, volume/section/lead for a container, or
    volume/state:xx/lead for a jurisdiction's; the latter rank pages of that jurisdiction's own
    section before others. A key with one best URL is in the index, with several in the collisions.
    ``states``: section slug to code.
    """
    from quillspark.functions.text import squash

    u = urls.select(F.regexp_replace("url", "/+$", "").alias("url")).distinct()
    shape = f"^https?://{host}/editions/[a-z]+-([0-9]{{4}})/adopted/(.+)$"
    u = u.withColumn("__p", F.regexp_extract("url", shape, 2)).withColumn("edition", F.regexp_extract("url", shape, 1))
    refused = u.where("__p = ''").select("url")
    s = u.where("__p <> ''").withColumn("__s", F.filter(F.split("__p", "/"), lambda x: x != "")).where("size(__s) in (2, 3)")
    c = container_slug(F.get("__s", F.lit(2)), sorted(set(states.values())))
    number = F.regexp_replace(F.get("__s", F.lit(1)), "^[0-9]+-", "")
    table = F.create_map(*(F.lit(x) for kv in states.items() for x in kv))
    section_state = F.element_at(table, number)
    state = F.coalesce(c["state"], section_state)
    section = squash(F.substring_index(F.get("__s", F.lit(1)), "-", 1))
    key = F.when(F.size("__s") == 2, F.concat_ws("|", F.get("__s", F.lit(0)), section, F.lit(""))).otherwise(F.concat_ws("|", F.get("__s", F.lit(0)), F.when(state.isNotNull(), F.concat(F.lit("state:"), state)).otherwise(section), c["lead"]))
    rank = F.when((F.size("__s") == 3) & state.isNotNull() & ~F.coalesce(section_state == state, F.lit(False)), 1).otherwise(0)
    k = s.where((F.size("__s") == 2) | (c["lead"] != "")).select("edition", "url", key.alias("key"), rank.alias("rank"))
    best = k.withColumn("__m", F.min("rank").over(Window.partitionBy("edition", "key"))).where("rank = __m").groupBy("edition", "key").agg(F.array_sort(F.collect_set("url")).alias("urls"))
    return best.where("size(urls) = 1").select("edition", "key", F.col("urls")[0].alias("url")), best.where("size(urls) > 1"), refused


def container_slug(slug: Column, states: list[str]) -> Column:
    """state, lead and rest of a container's slug: a leading ``part`` and one jurisdiction come off, in either order."""
    from quillspark.functions.text import squash

    w = F.filter(F.split(slug, "-"), lambda x: x != "")
    item = lambda a, i: F.get(a, F.lit(i))
    rest = lambda a: F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0)))
    first_part = (item(w, 0) == "part") & (F.size(w) > 1)
    first_state = item(w, 0).isin(*states) & (F.size(w) > 1)
    a = F.when(first_part | first_state, rest(w)).otherwise(w)
    took1 = F.when(first_state, item(w, 0))
    second_part = (first_part | first_state) & (item(a, 0) == "part") & (F.size(a) > 1)
    second_state = (first_part | first_state) & took1.isNull() & item(a, 0).isin(*states) & (F.size(a) > 1)
    b = F.when(second_part | second_state, rest(a)).otherwise(a)
    return F.struct(F.coalesce(took1, F.when(second_state, item(a, 0))).alias("state"), squash(item(b, 0)).alias("lead"), rest(b).alias("rest"))


def resolve_links(units: DataFrame, index: DataFrame, collisions: DataFrame, states: list[str]) -> DataFrame:
    """Units (unit, edition, volume, kind, id, state, section, container, container_title, title) with url, fail-closed.

    A collision is decided only if the words after the lead of exactly one candidate's slug all
    stand in the title. A unit without section number takes the national container's page if the
    volume has one only.
    """
    from quillspark.functions.text import squash, title_words
    from quillspark.functions.urls import with_fragment

    lead = squash(F.regexp_replace(F.trim(F.coalesce("container", F.lit(""))), r"(?i)^part[\s-]+", ""))
    st = squash(F.col("state"))
    section = squash(F.col("section"))
    key = F.when(lead == "", F.concat_ws("|", "volume", section, F.lit(""))).when(st.isin(*states), F.concat_ws("|", F.col("volume"), F.concat(F.lit("state:"), st), lead)).when(section != "", F.concat_ws("|", "volume", section, lead))
    u = units.withColumn("__key", key).withColumn("__lead", lead).withColumn("__words", title_words(F.when(lead == "", F.col("title")).otherwise(F.col("container_title"))))
    direct = index.select("edition", F.col("key").alias("__key"), F.col("url").alias("__direct"))
    slug = F.get(F.split(F.regexp_replace("u", "^https?://[^/]+/", ""), "/"), F.lit(5))
    cand = collisions.select("edition", F.col("key").alias("__key"), F.explode("urls").alias("u")).withColumn("__rest", container_slug(slug, states)["rest"])
    tie = u.select("unit", "edition", "__key", "__words").join(cand, ["edition", "__key"]).where((F.size("__rest") > 0) & (F.size(F.array_except("__rest", "__words")) == 0)).groupBy("unit").agg(F.count(F.lit(1)).alias("__n"), F.min("u").alias("__tie"))
    part = F.split("key", "\\|")
    national = index.where(F.col("key").rlike(r"^[^|]*\|[^|:]*\|[^|]+$")).groupBy("edition", part[0].alias("volume"), part[2].alias("__lead")).agg(F.count(F.lit(1)).alias("__m"), F.min("url").alias("__nat")).where("__m = 1")
    j = u.join(direct, ["edition", "__key"], "left").join(tie.where("__n = 1"), "unit", "left").join(national, ["edition", "volume", "__lead"], "left")
    page = F.coalesce("__direct", "__tie", F.when((section == "") & (lead != "") & ~st.isin(*states), F.col("__nat")))
    return j.select("unit", F.when((F.col("kind") == "clause") & (lead != ""), with_fragment(page, F.col("id"))).otherwise(page).alias("url"))
