"""Labels of list items and numbers: letters, Roman numerals, styles, spans, percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What style a list within a list of some style has (fixed values).
NEXT_STYLE = {"numbered": "alpha", "alpha": "roman", "roman": "upper-alpha", "upper-alpha": "upper-roman"}
#: Roman numerals by value (fixed values).
ROMAN = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))


def alpha(n: Column) -> Column:
    """a, b, ... z, aa, ab, ... for 1, 2, ...: bijective base 26, up to six letters."""
    n = n.cast("long")
    out = F.lit("")
    rest = n
    for _ in range(6):
        letter = F.when(rest > 0, F.char(F.lit(97) + (rest - 1) % 26)).otherwise("")
        out = F.concat(letter, out)
        rest = F.when(rest > 0, F.floor((rest - 1) / 26)).otherwise(F.lit(0))
    return F.when(n > 0, out)


def roman(n: Column) -> Column:
    n = n.cast("int")
    out, rest = F.lit(""), n
    for value, text in ROMAN:
        out = F.concat(out, F.repeat(F.lit(text), F.floor(rest / value).cast("int")))
        rest = rest % value
    return F.when(n > 0, out)


def list_label(style: Column, n: Column) -> Column:
    """The label of the n-th item: (1), (a), (i), (A), (I), or a bullet."""
    inner = F.when(style == "numbered", n.cast("string")).when(style == "alpha", alpha(n)).when(style == "roman", roman(n)).when(style == "upper-alpha", F.upper(alpha(n))).when(style == "upper-roman", F.upper(roman(n)))
    return F.when(inner.isNull(), "-").otherwise(F.concat(F.lit("("), inner, F.lit(")")))


def child_style(parent: Column) -> Column:
    """The style of a list inside an item of ``parent`` style; outermost lists are alpha."""
    table = F.create_map(*(F.lit(x) for kv in NEXT_STYLE.items() for x in kv))
    return F.coalesce(F.element_at(table, parent), F.lit("alpha"))


def number_prefix(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"^\s*\(?([^()\s]+)\)?\s*$", "($1)"))


def percent(part: Column, whole: Column) -> Column:
    """One decimal and a per cent sign; a dash for an empty whole."""
    return F.when(whole == 0, "-").otherwise(F.concat(F.format_number(part * 100.0 / whole, 1), F.lit("%")))


def span(start: Column, end: Column) -> Column:
    """Columns covered from start to end; 1 where either isn't a number or they run backwards."""
    s, e = start.try_cast("int"), end.try_cast("int")
    return F.greatest(F.lit(1), F.coalesce(e - s + 1, F.lit(1)))
