import random

import pytest
from pyspark.sql import functions as F

from quillspark.sources import ranges, shred


def document(r, n):
    names, out, stack = ["a", "b", "c-d", "e.f"], ["<root k='1'>"], ["root"]
    for _ in range(n):
        x = r.random()
        if x < 0.3:
            stack.append(r.choice(names))
            out.append(f"<{stack[-1]}" + r.choice(["", " x='1 > 0'", ' y="q&amp;r" z = "" ', "\n"]) + ">")
        elif x < 0.55 and len(stack) > 1:
            out.append(f"</{stack.pop()}{r.choice(['', ' '])}>")
        elif x < 0.65:
            out.append(f"<{r.choice(names)}/>")
        elif x < 0.75:
            out.append(r.choice(["<!-- a > b - c <x> <y/> -->", "<![CDATA[ <no> & tags ]] > ]]>", "<?do <it> now?>", "<!---->"]))
        else:
            out.append(r.choice(["text", " &lt;more&gt; ", "\n", "ü > 日本", "&#65;"]))
    return "".join(out) + "".join(f"</{t}>" for t in reversed(stack))


def same_nodes(got, xml):
    want = [(r[0], r[1], r[2], r[3], r[5], r[6], r[7]) for r in shred.parse_xml(xml)]
    rows = sorted((x.pre, x.post, x.parent, x.depth, x.tag, x.attrs, x.text) for x in got)
    assert rows == want


@pytest.mark.parametrize("parts", [1, 5, 37])
def test_pieces_as_one_parser(spark, parts):
    r = random.Random(parts)
    docs = {f"d{i}": document(r, r.choice((0, 3, 40, 300))) for i in range(5)}
    pieces = [(d, i, p) for d, x in docs.items() for i, p in enumerate(x.split("<"))]
    r.shuffle(pieces)
    nodes, faults = ranges.shred_pieces(spark.createDataFrame(pieces, "doc_id string, n int, piece string"), ["n"], parts=parts)
    assert faults.count() == 0
    rows = nodes.collect()
    for d, x in docs.items():
        same_nodes([n for n in rows if n.doc_id == d], x)


def test_file_by_byte_ranges(spark, tmp_path):
    xml = "<?xml version='1.0'?>" + document(random.Random(8), 3000)
    (tmp_path / "one.xml").write_text(xml)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        pieces = ranges.pieces_of_files(spark, str(tmp_path))
        assert pieces.select("block").distinct().count() > 5
        nodes, faults = ranges.shred_pieces(pieces, ["block", "n"], parts=9)
        same_nodes(nodes.collect(), xml)
        assert faults.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_faults(spark):
    docs = {"x": "<a><b></a></b></c>", "y": "<a><b>t", "z": "<a></a>", "n": None}
    pieces = [(d, i, p) for d, x in docs.items() for i, p in enumerate((x or "").split("<"))]
    for parts in (1, 12):
        nodes, faults = ranges.shred_pieces(spark.createDataFrame(pieces, "doc_id string, n int, piece string"), ["n"], parts=parts)
        assert sorted(map(tuple, faults.collect())) == [("x", "</a> closes <b>"), ("x", "</b> closes <a>"), ("x", "</c> closes nothing"), ("y", "left open: a b")]
        assert sorted((n.doc_id, n.pre, n.post, n.depth, n.tag) for n in nodes.collect()) == [("x", 0, 1, 0, "a"), ("x", 1, 0, 1, "b"), ("y", 0, 2, 0, "a"), ("y", 1, 1, 1, "b"), ("y", 2, 0, 2, "#text"), ("z", 0, 0, 0, "a")]


def test_html(spark):
    x = "<!DOCTYPE html><P>a<br>b<script>if (a<b) '</p>'</SCRIPT><img src=x>1 < 2</p>"
    pieces = [("d", i, p) for i, p in enumerate(x.split("<"))]
    for parts in (1, 20):
        nodes, _ = ranges.shred_pieces(spark.createDataFrame(pieces, "doc_id string, n int, piece string"), ["n"], "html", parts=parts)
        assert [(n.depth, n.tag, n.text) for n in nodes.orderBy("pre").collect()] == [(0, "p", None), (1, "#text", "a"), (1, "br", None), (1, "#text", "b"), (1, "script", None), (2, "#text", "if (a<b) '</p>'"), (1, "img", None), (1, "#text", "1 < 2")]


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 7), (3, 25)])
def test_unclosed_elements_over_ranges(spark, seed, parts):
    r = random.Random(seed)
    docs = {f"d{i}": "".join(r.choice(["<a>", "<b>", "<b/>", "x", *(["</a>", "</b>", "</a></b></a>"] if i % 2 else ["</b>"])]) for _ in range(150)) for i in range(4)}
    pieces = [(d, i, p) for d, x in docs.items() for i, p in enumerate(x.split("<"))]
    want, faults = [], []
    for d, x in docs.items():
        rows, stack, closed, text = [], [], 0, None
        for i, p in enumerate(x.split("<")):
            tag, _, rest = p.partition(">") if i else ("", "", p)
            if tag.startswith("/"):
                text = None
                if stack:
                    top = stack.pop()
                    rows[top][2], closed = closed, closed + 1
                    faults += [(d, f"<{tag}> closes <{rows[top][5]}>")] if rows[top][5] != tag[1:] else []
                else:
                    faults.append((d, f"<{tag}> closes nothing"))
            elif tag:
                text = None
                rows.append([d, len(rows), None, stack[-1] if stack else None, len(stack), tag.strip("/"), [*stack, len(rows)]])
                if tag.endswith("/"):
                    rows[-1][2], closed = closed, closed + 1
                else:
                    stack.append(rows[-1][1])
            if rest and text is None:
                text = [d, len(rows), closed, stack[-1] if stack else None, len(stack), "#text", [*stack, len(rows)]]
                rows.append(text)
                closed += 1
        faults += [(d, "left open: " + " ".join(rows[k][5] for k in stack))] if stack else []
        while stack:
            rows[stack.pop()][2], closed = closed, closed + 1
        want += map(tuple, rows)
    nodes, found = ranges.shred_pieces(spark.createDataFrame(pieces, "doc_id string, n int, piece string"), ["n"], parts=parts, paths=True)
    got = nodes.select("doc_id", "pre", "post", "parent", "depth", "tag", "path").collect()
    assert sorted(map(tuple, got)) == want
    assert sorted(map(tuple, found.collect())) == sorted(faults)


def test_stacks_stay_out_of_the_driver(spark, monkeypatch):
    # what stays open grows with the document; the driver folds a row of numbers a range
    n, parts, seen = 3000, 6, []
    kind = type(spark.range(0))
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: seen.extend(rows := collect(df)) or rows)
    pieces = spark.range(n).select(F.lit("d").alias("doc_id"), "id", F.lit("a>").alias("piece"), F.lit(False).alias("text"))
    nodes, _ = ranges.shred_pieces(pieces, ["id"], text="text", parts=parts, bare=True)
    assert nodes.agg(F.max("depth"), F.count("*")).first() == (n - 1, n)
    assert len(str(seen)) < 300 * parts


def test_closed_rows_leave_a_range_early(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ranges, "BATCH", 10)
    n = 200
    pieces = ["root>", *(x for _ in range(n) for x in ("p>x", "/p>")), "a>"]
    batch = pa.RecordBatch.from_pydict({"__part": [0] * len(pieces), "doc_id": ["d"] * len(pieces), "__first": [False] * len(pieces), "piece": pieces})
    out = [b.to_pylist() for b in ranges._local("xml", False)(iter([batch]))]
    assert max(map(len, out)) <= 20 and len(out) > 10
    assert sorted(x["pre"] for b in out for x in b if x["what"] != "range") == list(range(2 * n + 2))


@pytest.mark.parametrize("markup", ["xml", "html"])
def test_bare_pieces_make_the_same_nodes(spark, markup):
    r = random.Random(6)
    some = ["<a x='1 > 0'>t", '<b y="q&amp;r" z = "" >', "</a>", "</b >u", "<c/>", "<br />", "<c d=e/>&#1;", "<c d='/'>&amp;", "<!-- x <b> --> y", "<![CDATA[ <no> ]]>", "<?do <it> now?>", "<SCRIPT>if (a<b) '</p>'</script>", "</\u017fcript>", "< no", "<!DOCTYPE x>", "<1>", "<\u00e9>", "<a'b>", "<a b='>", "<a", "\n", "<p" + " k='v'" * 90 + ">", "<_x>", "<x:y/z>"]
    pieces = [(f"d{d}", i, p) for d in range(6) for i, p in enumerate("".join(r.choice(some) for _ in range(120)).split("<"))]
    df = spark.createDataFrame(pieces, "doc_id string, n int, piece string")
    rows = lambda **k: sorted(map(tuple, ranges.shred_pieces(df, ["n"], markup, parts=5, **k)[0].select("doc_id", "pre", "depth", "tag").collect()))
    assert rows(bare=True) == rows()
