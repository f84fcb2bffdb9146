"""String functions as Column expressions: collapsing, folding, slugs, names, citations, prose."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as ECMAScript's \s and trim() know it; Java's \s is ASCII only.
WS = "[\\t\\n\\x0B\\f\\r \\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]"
SLUG_CAP = 60


def trim_ws(x: Column) -> Column:
    return F.regexp_replace(x, f"^{WS}+|{WS}+$", "")


def collapse(x: Column) -> Column:
    """White space runs as single spaces, trimmed."""
    return F.trim(F.regexp_replace(x, f"{WS}+", " "))


@functools.lru_cache(maxsize=1)
def _fold_maps() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Compatibility decompositions without combining marks, by rule from the Unicode tables of this Python:
    one-to-one ones as a translation, the longer ones of the usual blocks as replacements."""
    src, dst, longer = [], [], []
    for c in map(chr, range(0x80, 0x10000)):
        if unicodedata.category(c) == "Cs":
            continue
        t = "".join(x for x in unicodedata.normalize("NFKD", c) if not 0x300 <= ord(x) <= 0x36F)
        if len(t) == 1 and t != c:
            src.append(c)
            dst.append(t)
        elif len(t) > 1 and (c < "ɐ" or " " <= c < "←" or "ﬀ" <= c < "﬇"):
            longer.append((c, t))
    return "".join(src), "".join(dst), tuple(longer)


def fold(x: Column) -> Column:
    """NFKD without U+0300-036F, in the JVM: exact for Latin, Greek and Cyrillic text, general punctuation,
    number forms and width variants. ``fold_exact`` covers every character."""
    src, dst, longer = _fold_maps()
    x = F.translate(F.regexp_replace(x, "[\\u0300-\\u036f]", ""), src, dst)
    many = "[" + "".join(c for c, _ in longer) + "]"
    slow = functools.reduce(lambda a, p: F.replace(a, F.lit(p[0]), F.lit(p[1])), longer, x)
    return F.when(x.rlike(many), slow).otherwise(x)


def fold_exact(x: Column) -> Column:
    """NFKD without U+0300-036F for any text, by an Arrow UDF."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else "".join(c for c in unicodedata.normalize("NFKD", v) if not 0x300 <= ord(c) <= 0x36F))

    return F.pandas_udf(run, StringType())(x)


def _tokens(folded: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(folded), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slugify(x: Column, folded: bool = False) -> Column:
    """Lower-case ASCII words joined by hyphens; null gives the empty string."""
    x = F.coalesce(x, F.lit(""))
    return _tokens(x if folded else fold(x))


def cap_slug(slug: Column, cap: int = SLUG_CAP) -> Column:
    """A slug of at most ``cap`` characters, cut at its last hyphen at or before ``cap``, else hard."""
    head = F.regexp_extract(F.substring(slug, 1, cap + 1), "^(.+)-[^-]*$", 1)
    cut = F.when(head != "", head).otherwise(F.substring(slug, 1, cap))
    return F.when(F.length(slug) <= cap, slug).otherwise(F.regexp_replace(cut, "-+$", ""))


def designation(x: Column) -> Column:
    """Like a slug, but dots stay and are trimmed at the ends."""
    t = F.lower(fold(trim_ws(F.coalesce(x, F.lit("")))))
    return F.regexp_replace(F.regexp_replace(t, "[^a-z0-9.]+", "-"), "^[-.]+|[-.]+$", "")


def squash(x: Column) -> Column:
    """Folded, lower-case, letters and digits only."""
    return F.regexp_replace(F.lower(fold(F.coalesce(x, F.lit("")))), "[^a-z0-9]+", "")


def title_words(x: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(fold(F.coalesce(x, F.lit("")))), "[^a-z0-9]+"), lambda w: w != ""))


def join_parts(*parts: Column, suffix: str = ".md") -> Column:
    """The non-empty parts joined by hyphens, with a suffix."""
    return F.concat(F.array_join(F.filter(F.array(*(F.coalesce(p, F.lit("")) for p in parts)), lambda p: p != ""), "-"), F.lit(suffix))


def term_slug(term: Column) -> Column:
    """The file token of a term; where ASCII doesn't carry it, with eight digits of its SHA-1."""
    slug = cap_slug(slugify(term))
    hashed = F.concat(F.when(slug == "", "term").otherwise(slug), F.lit("-"), F.substring(F.sha1(term.cast("binary")), 1, 8))
    return F.when((slug == "") | term.rlike("[^\\x00-\\x7F]"), hashed).otherwise(slug)


def container_token(kind: Column, section_type: Column, tokens: dict[str, str], section_kind: str = "section") -> Column:
    """The file token of a container kind by a table; null for a kind the table lacks (a violation)."""
    table = F.create_map(*(F.lit(x) for kv in tokens.items() for x in kv)) if tokens else F.create_map()
    return F.when(kind == section_kind, F.when(section_type == "schedule", "schedule").otherwise("section")).otherwise(F.element_at(table, kind))


def container_number(num: Column, token: Column) -> Column:
    """The designation of a container, without its own kind word in front."""
    n = designation(num)
    bare = F.when(n.startswith(F.concat(token, F.lit("-"))), F.substring(n, F.length(token) + 2, F.length(n))).otherwise("")
    return F.when(bare != "", bare).otherwise(n)


def unit_filename(u: dict[str, Column], tokens: dict[str, str]) -> Column:
    """The name of a unit's file, from the columns kind, id, term, title, state, containerKind, containerNum and sectionType."""
    state = slugify(u["state"])
    title = cap_slug(slugify(u["title"]))
    tok = container_token(u["containerKind"], u["sectionType"], tokens)
    numbered = F.coalesce(u["containerNum"], F.lit("")) != ""
    page = F.when(numbered & tok.isNull(), None).when(numbered, join_parts(tok, container_number(u["containerNum"], tok), state, title)).otherwise(join_parts(F.lit("page"), state, title))
    return F.when(u["kind"] == "clause", join_parts(designation(u["id"]), state, title)).when(u["kind"] == "glossary", join_parts(term_slug(trim_ws(u["term"])), state)).when(u["kind"] == "page", page)


def unit_path(edition: Column, kind: Column, volume: Column, filename: Column, glossary_dir: str = "glossary") -> Column:
    return F.concat_ws("/", edition, F.when(kind == "glossary", glossary_dir).otherwise(volume), filename)


def unsafe_segment(x: Column) -> Column:
    """Whether a path segment is empty, absolute or climbs."""
    return (x == "") | x.rlike(r"(^|/)\.\.(/|$)|\\|^/|^[A-Za-z]:")


def citation(prefix: Column, kind: Column, id: Column, term: Column, title: Column, state: Column) -> Column:
    what = F.when(kind == "clause", id).when(kind == "glossary", F.concat(F.lit("Glossary: "), term)).otherwise(title)
    return F.concat(prefix, F.lit(" "), what, F.when(F.coalesce(state, F.lit("")) != "", F.concat(F.lit(" ("), F.upper(state), F.lit(")"))).otherwise(""))


def heading(kind: Column, id: Column, term: Column, title: Column) -> Column:
    pair = F.array_join(F.filter(F.array(*(trim_ws(F.coalesce(x, F.lit(""))) for x in (id, title))), lambda x: x != ""), " — ")
    return F.when(kind == "glossary", trim_ws(term)).when(kind == "clause", pair).otherwise(trim_ws(F.coalesce(title, F.lit(""))))


def prose_list(items: Column) -> Column:
    """Items as prose: A, B and C."""
    n = F.size(items)
    return F.when(n <= 1, F.array_join(items, "")).otherwise(F.concat(F.array_join(F.slice(items, F.lit(1), n - 1), ", "), F.lit(" and "), F.element_at(items, -1)))


def wrap(x: Column, width: int, indent: str = "") -> Column:
    """Words of a text filled greedily into lines of at most ``width`` characters."""
    words = F.filter(F.split(x, " "), lambda w: w != "")
    start = F.struct(F.array().cast("array<string>").alias("lines"), F.lit("").alias("line"))

    def step(acc: Column, w: Column) -> Column:
        longer = F.when(acc["line"] == "", w).otherwise(F.concat(acc["line"], F.lit(" "), w))
        fits = (acc["line"] == "") | (F.length(longer) + len(indent) <= width)
        return F.struct(F.when(fits, acc["lines"]).otherwise(F.concat(acc["lines"], F.array(acc["line"]))).alias("lines"), F.when(fits, longer).otherwise(w).alias("line"))

    done = F.aggregate(words, start, step, lambda acc: F.filter(F.concat(acc["lines"], F.array(acc["line"])), lambda s: s != ""))
    return F.array_join(F.transform(done, lambda s: F.concat(F.lit(indent), s)), "\n")


def stem(x: Column) -> Column:
    """A file name without extension, folded: lower case, separators as hyphens."""
    return norm_id(F.regexp_replace(x, r"\.[^.]*$", ""))


def norm_id(x: Column) -> Column:
    return F.regexp_replace(F.lower(x), r"[.\-_ ]+", "-")


def local_name(x: Column) -> Column:
    return F.substring_index(x, ":", -1)


def unwrap(x: Column) -> Column:
    """A value without list bullet, quotes, code ticks and emphasis around it."""
    return F.regexp_replace(trim_ws(x), r"^(?:[-*>]\s+)?[\"'`*_]*|[\"'`*_]*$", "")


def clean_value(x: Column) -> Column:
    return F.regexp_replace(unwrap(x), r"[.,;]+$", "")


def body_of(content: Column) -> Column:
    """What follows the front matter and the first heading of a document."""
    after = F.regexp_replace(content, r"(?s)\A---\n.*?\n---\n+", "")
    return F.regexp_replace(after, r"\A# [^\n]*\n+", "")


def section_kind(x: Column) -> Column:
    """section, schedule or other, from a heading like ``Section A``."""
    return F.when(x.rlike(r"(?i)^section\s"), "section").when(x.rlike(r"(?i)^schedule\s"), "schedule").otherwise("other")


def filename_state(x: Column, states: list[str]) -> Column:
    """The jurisdiction a file name ends with, upper case; null if none of ``states``."""
    found = F.upper(F.regexp_extract(F.regexp_replace(x, r"\.[^.]*$", ""), r"[-_ ]([A-Za-z]{2,3})$", 1))
    return F.when(found.isin(*states), found)


def edit_year(x: Column) -> Column:
    """The year a date-time starts with, null where it has none."""
    return F.nullif(F.substring(x, 1, 4).try_cast("int"), F.lit(0))


#: Codes of the jurisdictions that may stand before a figure's designation (fixed values).
JURISDICTIONS = ("ACT", "NSW", "NT", "QLD", "SA", "TAS", "VIC", "WA")


def fig_key(x: Column) -> Column:
    """One key for a figure's designation, as prose names it or as its caption does.

    What a caption says after a colon goes, then a qualifier (in brackets, or the word
    explanatory), punctuation of the sentence around it and a jurisdiction in front; lower case.
    """
    lead = F.substring_index(x, ":", 1)
    bare = F.regexp_replace(trim_ws(F.substring_index(lead, "(", 1)), r"(?i)\s+explanatory$", "")
    bare = F.rtrim(bare, F.lit(".,;:)]"))
    first = F.upper(F.substring_index(bare, " ", 1))
    return F.lower(F.when(first.isin(*JURISDICTIONS) & F.contains(bare, F.lit(" ")), F.ltrim(F.substring(bare, F.length(first) + 1, 1 << 30))).otherwise(bare))


def sources_for(volume: Column, sources: Column) -> Column:
    """sources and problem: the documents that publish an entry, by default its own volume; none, or one named twice, is a problem."""
    given = F.coalesce(sources, F.array(volume))
    list_ = F.filter(F.transform(given, lambda s: trim_ws(F.coalesce(s, F.lit("")))), lambda s: s != "")
    problem = F.when(F.size(list_) == 0, "no source").when(F.size(F.array_distinct(list_)) < F.size(list_), "named twice")
    return F.struct(list_.alias("sources"), problem.alias("problem"))


def escape_re(x: Column) -> Column:
    """A text as a pattern that matches it and nothing else."""
    return F.regexp_replace(x, r"([.*+?^${}()|\[\]\\])", r"\\$1")
