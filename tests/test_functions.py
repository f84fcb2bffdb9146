from pyspark.sql import functions as F

from quillspark.functions import labels, text, urls, yamlish


def ev(spark, col, *values, names="abcdefgh"):
    row = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names[: len(values)])) if values else spark.range(1)
    return row.select(col.alias("x")).first()["x"]


def test_slug_and_cap(spark):
    a = F.col("a")
    assert ev(spark, text.slugify(a), "Fire-Résistance, “walls” & ½ №5 ﬁx") == "fire-resistance-walls-1-2-no5-fix"
    assert ev(spark, text.slugify(a), "  ") == ""
    long = "abcdefghi-" * 8
    assert ev(spark, text.cap_slug(a), long) == "abcdefghi-" * 5 + "abcdefghi"
    assert ev(spark, text.cap_slug(a), "x" * 80) == "x" * 60
    assert ev(spark, text.cap_slug(a), "short") == "short"


def test_fold_agrees_with_exact(spark):
    s = "Ångström ﬁ ² é ǆ ΐ Ж ／ Ａ … ™"
    assert ev(spark, text.fold(F.col("a")), s) == ev(spark, text.fold_exact(F.col("a")), s)


def test_white_space_is_wide(spark):
    assert ev(spark, text.collapse(F.col("a")), " a  \n b﻿ ") == "a b"


def test_names(spark):
    c = {k: F.col(k) for k in ("kind", "id", "term", "title", "state", "containerKind", "containerNum", "sectionType")}
    cases = {
        ("clause", "C2D2", None, "Fire walls", "NSW", None, None, None): "c2d2-nsw-fire-walls.md",
        ("glossary", None, "%", None, None, None, None, None): "term-4345cb1f.md",
        ("glossary", None, "Sole-occupancy unit", None, None, None, None, None): "sole-occupancy-unit.md",
        ("page", None, None, "Introduction", None, None, None, None): "page-introduction.md",
        ("page", None, None, "Scope", "VIC", "part", "Part C2", "section"): "part-c2-vic-scope.md",
        ("page", None, None, "States", None, "section", "1", "schedule"): "schedule-1-states.md",
        ("page", None, None, "X", None, "unheard", "1", "section"): None,
    }
    df = spark.createDataFrame(list(cases), "kind string, id string, term string, title string, state string, containerKind string, containerNum string, sectionType string")
    got = [r["x"] for r in df.select(text.unit_filename(c, {"part": "part"}).alias("x")).collect()]
    assert got == list(cases.values())


def test_paths(spark):
    for p, bad in (("", True), ("../x", True), ("a/../b", True), ("/a", True), ("C:x", True), ("..name", False), ("a/b", False), ("a\\b", True)):
        assert ev(spark, text.unsafe_segment(F.col("a")), p) is bad, p


def test_citation_heading_prose(spark):
    a, b = F.col("a"), F.lit(None).cast("string")
    assert ev(spark, text.citation(F.lit("Code"), F.lit("clause"), a, b, b, F.lit("nsw")), "C1") == "Code C1 (NSW)"
    assert ev(spark, text.heading(F.lit("clause"), a, b, F.lit("Walls")), "C1") == "C1 — Walls"
    assert ev(spark, text.prose_list(F.split(a, ",")), "A,B,C") == "A, B and C"
    assert ev(spark, text.prose_list(F.split(a, ",")), "A") == "A"
    assert ev(spark, text.wrap(a, 7, " "), "aa bb cc dddddddddd e") == " aa bb\n cc\n dddddddddd\n e"


def test_labels(spark):
    df = spark.createDataFrame([(n,) for n in (1, 26, 27, 702, 703, 4, 9, 40, 1994)], "n int")
    got = [(r["a"], r["r"]) for r in df.select(labels.alpha(F.col("n")).alias("a"), labels.roman(F.col("n")).alias("r")).collect()]
    assert [a for a, _ in got[:5]] == ["a", "z", "aa", "zz", "aaa"]
    assert [r for _, r in got[5:]] == ["iv", "ix", "xl", "mcmxciv"]
    assert ev(spark, labels.span(F.col("a"), F.col("b")), "2", "4") == 3
    assert ev(spark, labels.span(F.col("a"), F.col("b")), "x", "4") == 1


def test_urls(spark):
    a = F.col("a")
    assert ev(spark, urls.encode_component(a), "a (b)!~*'.svg") == "a%20(b)!~*'.svg"
    assert ev(spark, urls.file_url(F.lit("p"), a), "a (b).svg") == "p/a%20%28b%29.svg"
    assert ev(spark, urls.canonical(a), "http://x/y//?q#f") == "http://x/y"
    assert ev(spark, urls.content_type(a), "x.unknown") is None
    assert ev(spark, urls.retry_delay_ms(F.lit(3), a), "120") == 60_000
    assert ev(spark, urls.retry_delay_ms(F.lit(3), a), "soon") == 4_000


def test_yaml(spark):
    a = F.col("a")
    for x, y in (("plain", "plain"), ("", '""'), ("yes", '"yes"'), ("1.5", '"1.5"'), ("a: b", '"a: b"'), ("2024-01-01x", '"2024-01-01x"'), ("a #b", '"a #b"'), ('say "x"', 'say "x"'), ("- a", '"- a"'), ("a\tb\x01", '"a\\tb\\x01"'), ("a\\ b:", '"a\\\\ b:"')):
        assert ev(spark, yamlish.scalar(a), x) == y
        if "\x01" not in x:
            assert ev(spark, yamlish.unquote(yamlish.scalar(a)), x) == x
    assert ev(spark, yamlish.flow_seq(F.split(a, ";")), "Vol one;a, b") == '[Vol one, "a, b"]'


def test_plain_values_need_no_quotes(spark):
    import random

    r = random.Random(2)
    values = ["".join(r.choice("ABCxyzé日 ,/()._'-09:#~") for _ in range(r.randint(1, 14))) for _ in range(3000)] + ["falsefalse", "nullnull", "yes yes yes", "infinity (x)"]
    df = spark.createDataFrame([(v,) for v in values], "a string").where(F.col("a").rlike(yamlish.PLAIN))
    assert df.count() > 50 and df.where(yamlish.needs_quote(F.col("a"))).count() == 0
