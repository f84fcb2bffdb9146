"""YAML scalars and flow sequences, front matter in and out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import trim_ws

#: Order of the front-matter keys (fixed values).
KEYS = ("clause", "term", "title", "citation", "web_url", "edition", "volume", "sources", "jurisdiction", "supersedes", "building_classes_excluded", "defined_terms")
#: Words that YAML reads as a boolean or nothing, in small letters, capitalised or in capitals; special floats; indicators (fixed values).
WORDS = ("y", "n", "yes", "no", "true", "false", "on", "off", "null")
SPECIAL = ("~", ".inf", "-.inf", ".nan")
INDICATORS = "-?:,[]{}#&*!|>'\"%@`"
#: Digits after the mark of a number that isn't decimal.
RADIX = {"0x": "0123456789abcdefABCDEF", "0o": "01234567", "0b": "01"}


def _only(x: Column, chars: str) -> Column:
    """Whether a text has characters, all of them of a set."""
    return (x != "") & (F.translate(x, chars, "") == "")


def is_word(x: Column) -> Column:
    low = F.lower(x)
    cased = (x == low) | (x == F.upper(x)) | (x == F.concat(F.upper(F.substring(x, 1, 1)), F.substring(low, 2, 9)))
    return x.isin(*SPECIAL) | (low.isin(*WORDS) & cased)


def is_number(x: Column) -> Column:
    """Decimal integers and floats and 0x, 0o and 0b, with a sign or none. A point may lead, but then has no exponent."""
    body = F.when(F.substring(x, 1, 1).isin("+", "-"), F.substring(x, 2, 1 << 30)).otherwise(x)
    radix = F.lit(False)
    for mark, digits in RADIX.items():
        radix = radix | (body.startswith(mark) & _only(F.substring(body, len(mark) + 1, 1 << 30), digits))
    plain = _only(body, "0123456789.eE+-") & F.substring(body, 1, 1).isin(*"0123456789.") & body.try_cast("double").isNotNull()
    return radix | (plain & ~(body.startswith(".") & F.lower(body).contains("e")))


def needs_quote(x: Column) -> Column:
    """Whether YAML would not read a plain scalar back as this text."""
    edge = x != trim_ws(x)
    mark = F.instr(F.lit(INDICATORS), F.substring(x, 1, 1)) > 0
    inside = F.contains(x, F.lit(": ")) | x.endswith(":") | F.contains(x, F.lit(" #")) | x.rlike(r"\p{Cntrl}")
    date = F.translate(F.substring(x, 1, 10), "012345678", "999999999") == "9999-99-99"
    return (x == "") | edge | mark | inside | date | is_word(x) | is_number(x)


def quoted(x: Column) -> Column:
    x = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for char, text in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        x = F.replace(x, F.lit(char), F.lit(text))
    controls = F.when(x.rlike(r"\p{Cntrl}"), reduce(lambda a, c: F.replace(a, F.lit(chr(c)), F.lit(f"\\x{c:02x}")), [*range(1, 32), 127], x)).otherwise(x)
    return F.concat(F.lit('"'), controls, F.lit('"'))


#: Values that need no quotes whatever the rules below say: a letter, letters, digits and harmless marks, longer than any
#: word that YAML reads as something else. Most titles are of this form, and one match decides them.
PLAIN = r"^\p{L}[\p{L}\p{N} ,/()._'-]{6,}[\p{L}\p{N})]$"


def scalar(x: Column) -> Column:
    """A value as a YAML scalar; null as the empty one."""
    x = F.coalesce(x, F.lit(""))
    return F.when(x.rlike(PLAIN), x).when(needs_quote(x), quoted(x)).otherwise(x)


def flow_seq(items: Column) -> Column:
    item = lambda s: F.when(s.rlike(r"[,\[\]{}]"), quoted(s)).otherwise(scalar(s))
    return F.concat(F.lit("["), F.array_join(F.transform(items, item), ", "), F.lit("]"))


def front_matter(values: dict[str, Column]) -> Column:
    """Front-matter lines in the fixed order. Null values give no line; an empty list of terms none either."""
    lines = []
    for k in KEYS:
        if k not in values:
            continue
        v = values[k]
        if k == "sources":
            lines.append(F.concat(F.lit("sources: "), flow_seq(v)))
        elif k == "defined_terms":
            lines.append(F.when(F.size(v) > 0, F.concat(F.lit("defined_terms:\n"), F.array_join(F.transform(v, lambda t: F.concat(F.lit("  - "), scalar(t))), "\n"))))
        else:
            lines.append(F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), scalar(v))))
    return F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"))


def document(front: Column, heading: Column, note: Column, body: Column) -> Column:
    """A whole file: front matter, heading, note and body, blank lines between, empty ones left out."""
    parts = F.array(front, F.when(heading != "", F.concat(F.lit("# "), heading)).otherwise(""), F.coalesce(note, F.lit("")), F.coalesce(body, F.lit("")))
    return F.concat(F.array_join(F.filter(parts, lambda p: p != ""), "\n\n"), F.lit("\n"))


def unquote(x: Column) -> Column:
    """The value of a scalar as ``scalar`` writes it."""
    inner = F.substring(x, 2, F.length(x) - 2)
    out = F.replace(inner, F.lit("\\\\"), F.lit("\u0000"))
    for text, char in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
        out = F.replace(out, F.lit(text), F.lit(char))
    return F.when(x.rlike('(?s)^".*"$'), F.replace(out, F.lit("\u0000"), F.lit("\\"))).otherwise(x)
