"""Readers: node tables of documents and packages to raw units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.operators import joins, scan, tracked, tree
from quillspark.session import cut


def read_document(nodes: DataFrame, classes: DataFrame, edition: str, volume: str, number_tag: str = "sptc") -> DataFrame:
    """Units of monolithic documents: every element of class unit, and an overview of each container with prose of its own.

    A section with a summary gives an overview, too. nodes: as ``shred`` gives them; classes: tag,
    class, kind. ``unit_ord`` is document order. A placeholder is no number and supersedes nothing.
    """
    nodes = tree.with_path(nodes)
    c = tree.with_class(nodes, classes.select("tag", "class"))
    none = F.lit(None).cast("string")
    ctx = tree.contexts(c).unionByName(tree.abstracts(c).withColumn("container_kind", none).withColumn("container_num", none))
    stated = tree.without(nodes, "placeholder")
    title = tree.child_text(nodes, "title", "title").withColumnRenamed("parent", "pre")
    number = tree.child_text(stated, number_tag, "id").withColumnRenamed("parent", "pre")
    term = tree.child_text(nodes, "glossterm", "term").withColumnRenamed("parent", "pre")
    old = tree.child_text(stated, "archive-num", "supersedes").withColumnRenamed("parent", "pre")
    own = tree.overviews(c).unionByName(c.where("class = 'root'").select(c.columns)).select("doc_id", "pre", F.lit(True).alias("overview"))
    u = ctx.join(own, ["doc_id", "pre"], "left").where("class = 'unit' or overview")
    for extra in (title, number, term, old):
        u = u.join(extra, ["doc_id", "pre"], "left")
    u = u.join(classes.select("tag", "kind"), "tag", "left")
    box = title.select("doc_id", F.col("pre").alias("container_pre"), F.col("title").alias("container_title"))
    near = tree.ancestors(c, c.where("class in ('unit', 'container')"), ["class"]).where("a_class = 'container'").groupBy("doc_id", "pre").agg(F.max("a_pre").alias("container_pre"))
    u = u.join(near, ["doc_id", "pre"], "left").join(box, ["doc_id", "container_pre"], "left")
    return u.select(
        "doc_id", F.col("pre").alias("unit_ord"), "post", F.lit(edition).alias("edition"), F.lit(volume).alias("volume"), F.when(F.col("class") == "unit", F.col("kind")).otherwise("page").alias("kind"), F.coalesce("overview", F.lit(False)).alias("overview"),
        F.nullif("id", F.lit("")).alias("id"), F.nullif("term", F.lit("")).alias("term"), F.coalesce("title", "term", F.lit("")).alias("title"), "state", F.nullif("supersedes", F.lit("")).alias("supersedes"),
        F.nullif(F.col("attrs")["building"], F.lit("")).alias("building_classes"), F.coalesce(F.col("attrs")["category"], F.when(F.col("kind") == "glossary", "glossary")).alias("category"), "section_num", "container_kind", "container_num", "container_title",
    )


def read_package(spine: DataFrame, clauses: DataFrame, rulings: DataFrame, states: list[str], tolerated: str = "ERROR") -> tuple[DataFrame, DataFrame]:
    """Units of a package of small files from its map, and violations.

    spine: ref, ord, conref, id, title_id, section. clauses: conref, id, name, variation, base_id.
    rulings: ref, action. References are reconciled by three identities; a state is declared or
    taken from the file's name, and the two must agree; clauses the map never reaches are rescued.
    """
    from quillspark.operators import guards

    known = joins.classified(spine, clauses, "conref", tolerated)
    decided = joins.identity(known.where("state = 'found'").select("ref", "conref", "id", "title_id"), clauses, rulings)
    by_name = clauses.withColumn("named_state", tx.filename_state(F.col("name"), states))
    state = F.coalesce(F.upper(F.nullif("variation", F.lit(""))), "named_state")
    files = by_name.select("conref", F.col("id").alias("file_id"), "base_id", state.alias("state"), (F.upper("variation") != F.col("named_state")).alias("at_odds"))
    reached = decided.where("decision in ('agree', 'id-only', 'redirect')").select("ref", F.col("target").alias("conref")).join(files, "conref").join(spine.select("ref", "ord", "section"), "ref")
    members = reached.where("base_id <> ''").groupBy("conref").agg(F.min("ord").alias("ord"), F.min_by("section", "ord").alias("section"), F.first("file_id").alias("id"), F.first("state").alias("state"), F.lit(False).alias("rescued"))
    left = joins.rescued(files.where("base_id <> ''"), decided.select(F.col("target").alias("conref")), "conref")
    units = members.unionByName(left.select("conref", F.lit(None).cast(spine.schema["ord"].dataType).alias("ord"), F.lit(None).cast("string").alias("section"), F.col("file_id").alias("id"), "state", F.lit(True).alias("rescued")))
    bad = guards.gathered(
        guards.violation(known.where("state = 'missing'"), "reference", "ref", "concat('no file ', conref)"),
        guards.violation(decided.where("decision in ('title-only', 'unresolved')"), "identity", "ref", "decision"),
        guards.violation(files.where("at_odds"), "state", "conref", "'name and attribute differ'"),
        guards.violation(joins.duplicates(clauses, "id"), "identity", "id", "concat(n, ' files')"),
    )
    return units, bad


def package_files(nodes: DataFrame, cycle: int, states: list[str], number_tags: tuple[str, ...] = ("sptc", "num"), base: DataFrame | None = None) -> DataFrame:
    """What each file of a package (doc_id: its name) says of itself: file, root, id, title_id, variation, base_id,
    accepted_id, term, title, state, at_odds.

    base_id, term and title are those of the state before ``cycle``; accepted_id is the later state's
    designation. state: stated, else from the file's name; at_odds if both are there and differ.
    """
    nodes = tree.with_path(nodes)
    base = tracked.base_view(nodes, cycle) if base is None else base
    top = nodes.where("parent is null and tag <> '#text'")
    attr = lambda k: F.nullif(F.trim(F.col("attrs")[k]), F.lit(""))
    files = top.select("doc_id", F.col("pre").alias("__root"), F.col("tag").alias("root"), attr("id").alias("id"), F.upper(attr("variation")).alias("variation"))
    of_root = lambda df: df.join(files.select("doc_id", F.col("__root").alias("parent")), ["doc_id", "parent"]).drop("parent")
    # the first tag that numbers a file counts, whatever the order of its children
    place = F.array_position(F.array(*map(F.lit, number_tags)), F.col("tag"))
    numbers = of_root(nodes.where(place > 0)).groupBy("doc_id").agg(F.min_by("pre", F.struct(place, "pre")).alias("pre"))
    number = nodes.join(numbers, ["doc_id", "pre"], "left_semi")
    accepted = tracked.accepted_text(nodes, number, cycle).select("doc_id", F.nullif("accepted", F.lit("")).alias("accepted_id"))
    words = base.where("tag = '#text'").select("doc_id", F.col("pre").alias("at"), "text", F.explode("path").alias("pre")).join(numbers, ["doc_id", "pre"])
    based = words.groupBy("doc_id").agg(F.nullif(tx.collapse(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda s: s["text"]), "")), F.lit("")).alias("base_id"))
    titles = of_root(nodes.where("tag = 'title'")).groupBy("doc_id").agg(F.min_by(attr("id"), "pre").alias("title_id"))
    for extra in (accepted, based, titles, of_root(tree.child_text(base, "glossterm", "term")), of_root(tree.child_text(base, "title", "title"))):
        files = files.join(extra, "doc_id", "left")
    named = tx.filename_state(F.col("file"), states)
    files = files.withColumnRenamed("doc_id", "file").drop("__root")
    return files.withColumn("state", F.coalesce("variation", named)).withColumn("at_odds", F.coalesce(F.col("variation") != named, F.lit(False)))


def spine(base: DataFrame, map_tag: str = "map") -> DataFrame:
    """References of a package's map in order, from its base view: ref, ord, conref, id, title_id, section (of the nearest topic set).
    ref: the place in the order of the maps and of what stands in them."""
    base = base.join(base.where("parent is null").where(F.col("tag") == map_tag).select("doc_id"), "doc_id", "left_semi")
    at = tree.nearest(base, F.col("attrs")["section-num"], "section").where("tag = 'clauseref'")
    title = base.where("tag = 'title'").groupBy("doc_id", F.col("parent").alias("pre")).agg(F.min_by(F.col("attrs")["id"], "pre").alias("title_id"))
    at = at.join(title, ["doc_id", "pre"], "left").select("doc_id", F.col("pre").alias("ord"), F.col("attrs")["conref"].alias("conref"), F.col("attrs")["id"].alias("id"), "title_id", "section")
    return scan.places(at, ["doc_id", "ord"], "ref").withColumn("ref", F.col("ref").cast("string")).drop("doc_id")


def read_package_files(nodes: DataFrame, cycle: int, rulings: DataFrame, states: list[str], tolerated: str = "ERROR") -> tuple[DataFrame, DataFrame]:
    """Units of a package from the node tables of its files and its map, and violations.

    Units: unit, kind, id, title, state, section, how. mapped: clauses of the earlier state that the
    map reaches under a sound identity; variation: what variations of those give, a replacement's
    file or the deletion itself; rescued: clauses and glossary entries that nothing reaches.
    """
    from quillspark.operators import guards

    nodes = cut(tree.with_path(nodes))
    base = cut(tracked.base_view(nodes, cycle))
    files = cut(package_files(nodes, cycle, states, base=base).where("root <> 'map'"))
    refs = cut(spine(base))
    clauses = files.where("root = 'clause'").select(F.col("file").alias("conref"), "id")
    known = joins.classified(refs, clauses, "conref", tolerated)
    decided = joins.identity(known.where("state = 'found'").select("ref", "conref", "id", "title_id"), clauses, rulings)
    sound = decided.where("decision in ('agree', 'id-only', 'keep', 'redirect')").select("ref", F.col("target").alias("file")).join(refs.select("ref", "ord", "section"), "ref")
    told = files.select("file", F.when(F.col("root") == "clause", "clause").otherwise("glossary").alias("kind"), F.col("base_id").alias("id"), F.coalesce("title", "term", F.lit("")).alias("title"), "state")
    first = sound.groupBy("file").agg(F.min_by("section", "ord").alias("section"))
    mapped = told.join(first, "file").where("id is not null")
    sites = base.where("tag = 'clause-variation'").select(F.col("doc_id").alias("file"), F.upper(F.col("attrs")["variation"]).alias("own"), F.upper(F.col("attrs")["variation-type"]).alias("type"), F.col("attrs")["target"].alias("target")).join(mapped, "file")
    hosts = sites.select(F.concat_ws("#", "file", "own").alias("host"), "file", "own", "type", "target", "id", "title", "section")
    given = joins.variations(hosts, told.where("id is not null").select(F.col("file").alias("unit")))
    v = given.join(hosts.select("host", "own", "section", F.col("id").alias("__id"), F.col("title").alias("__title")), "host").join(told.select(F.col("file").alias("unit"), "id", "title"), "unit", "left")
    v = v.select("unit", F.lit("clause").alias("kind"), F.coalesce("id", "__id").alias("id"), F.coalesce("title", "__title").alias("title"), F.col("own").alias("state"), "section", F.lit("variation").alias("how"))
    left = joins.rescued(joins.rescued(told.where("id is not null or kind = 'glossary'"), sound, "file"), v.select(F.col("unit").alias("file")), "file")
    left = left.join(decided.select(F.col("target").alias("file")), "file", "left_anti")
    row = lambda df, how, section: df.select(F.col("file").alias("unit"), "kind", "id", "title", "state", section.alias("section"), F.lit(how).alias("how"))
    units = row(mapped, "mapped", F.col("section")).unionByName(v).unionByName(row(left, "rescued", F.lit(None).cast("string")))
    bad = guards.gathered(
        guards.violation(known.where("state = 'missing'"), "reference", "ref", "concat('no file ', conref)"),
        guards.violation(decided.where("decision in ('title-only', 'unresolved')"), "identity", "ref", "decision"),
        guards.violation(files.where("at_odds"), "state", "file", "'name and attribute differ'"),
        guards.violation(joins.duplicates(clauses, "id"), "identity", "id", "concat(n, ' files')"),
        guards.stated(refs.where("conref is not null").where(~F.col("conref").startswith(tolerated))),
    )
    return units, bad


def parse_args(argv: list[str]) -> dict[str, list[str]]:
    """--editions, --volumes and --sections, each once and not empty; anything else is refused."""
    out: dict[str, list[str]] = {}
    for a in argv:
        flag, eq, value = a.partition("=")
        name = flag.removeprefix("--")
        if not flag.startswith("--") or name not in ("editions", "volumes", "sections"):
            raise ValueError(f"unknown argument {a}")
        values = [v.strip() for v in value.split(",")]
        if not eq or not all(values):
            raise ValueError(f"{flag} needs values")
        if name in out or len(set(values)) < len(values):
            raise ValueError(f"{flag} names something twice")
        out[name] = values
    return out
