import html
import random
import re

import numpy as np
import pytest

from quillspark.llm import htmltext as h
from quillspark.llm import queries


@pytest.fixture(scope="module")
def trees():
    return h.trained()


def article(page):
    """The blocks of a test page's article by plain string work."""
    a = page[page.index("<article>") + 9 : page.index("</article>")]
    a = re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", "\n", a))
    return "\n".join(x for x in (" ".join(html.unescape(y).split()) for y in a.split("\n")) if x)


def test_query_on_pages(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op10_htmltext(spark, sf).collect()
    assert len(rows) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert sum(r["text"] == article(pages[r["page_id"]]) for r in rows) / len(rows) > 0.98


def test_held_out_made_up_pages(trees):
    r = random.Random(12345)
    right = total = exact = 0
    pages = [h.training_page(r) for _ in range(150)]
    for p, text in zip(pages, h.main_texts(pages, trees), strict=True):
        nodes, _, _ = h.nodes_and_features(h.parse(p))
        truth = [h.run_text(n) for n in nodes if n.tag == "#" and h.MARK in "".join(n.text)]
        got = text.split("\n")
        right += len(set(truth) & set(got))
        total += len(set(truth) | set(got))
        exact += truth == got
    assert right / total > 0.97 and exact / 150 > 0.7


PARTS = {
    "nav": '<nav><ul><li><a href="/a">Home</a></li></ul></nav>', "header": "<header><h1>Site</h1><p>tag line</p></header>", "ad": '<div class="advert"><p>Buy the thing now, it is good.</p></div>', "notice": '<div id="cookie-notice">We use cookies on this site to make it work.</div>',
    "form": '<form><p>Sign up for our letter</p><input name="q"><button>Go</button></form>', "side": '<aside class="sidebar"><h3>More</h3><p>A list of other stories that you may like.</p></aside>', "comments": '<section id="comments"><div class="comment"><p>I liked this very much, thank you for the text.</p></div></section>', "footer": "<footer>&copy; 2024 the site</footer>",
}


def test_parts_go_and_main_text_stays(trees):
    main = "<article><h1>A title &amp; more</h1><p>First   paragraph of the text,\nwith two lines.</p><p>Short.</p><ul><li>one item</li><li>two items</li></ul><p>Last paragraph, with a <a href='/x'>link</a> in it.</p></article>"
    page = f"<html><body>{PARTS['notice']}{PARTS['header']}{PARTS['nav']}{main}{PARTS['side']}{PARTS['ad']}{PARTS['comments']}{PARTS['form']}{PARTS['footer']}</body></html>"
    assert h.main_texts([page], trees)[0] == "A title & more\nFirst paragraph of the text, with two lines.\nShort.\none item\ntwo items\nLast paragraph, with a link in it."
    inside = f"<body><article><h1>T</h1><p>{'Some words of the text. ' * 5}</p>{PARTS['ad']}{PARTS['form']}<p>{'More words of it. ' * 5}</p></article></body>"
    assert "Buy" not in h.main_texts([inside], trees)[0] and h.main_texts([inside], trees)[0].count("\n") == 2


def test_parser_puts_up_with_anything():
    for page in ("", "plain", "<p>a<p>b", "<div><p>x</div>y</p>", "<a b='c>d", "<script>var a='</p>'", "<!-- open", "<ul><li>a<li>b<ul><li>c</ul></ul>", "<table><tr><td>a<td>b<tr><td>c</table>", "</body>x", "<p" * 50, "<div>" * 3000 + "deep"):
        nodes, parent, x = h.nodes_and_features(h.parse(page))
        assert x.shape == (len(nodes), h.FEATURES) and all(p < i for i, p in enumerate(parent)) and np.isfinite(x).all()
    runs = [h.run_text(n) for n in h.nodes_and_features(h.parse("<p>a <b>b</b>&lt;<br>c<p>d<script>x</script><div>e"))[0] if n.tag == "#"]
    assert runs == ["a b< c", "d", "e"]


def test_decode_is_the_best_consistent_choice():
    r = np.random.default_rng(1)
    for _ in range(40):
        n = int(r.integers(1, 9))
        parent = [-1, *(int(r.integers(0, i)) for i in range(1, n))]
        w = r.normal(size=n)
        best = max((sum(w[i] for i in range(n) if s >> i & 1) for s in range(1 << n) if all(not s >> i & 1 or i == 0 or s >> parent[i] & 1 for i in range(n))))
        assert abs(w[h.decode(parent, w)].sum() - best) < 1e-9


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "u", None, "t"), (2, None, "", "t"), (None, "u", "<p>" + "word " * 50_000, "t"), (1, "u", None, "t")], "page_id long, url string, html string, text string")
    got = h.extract(df).collect()
    assert len(got) == 4 and [r["n_chars"] for r in got if r["html"] is None] == [0, 0] and h.extract(df.where("false")).count() == 0


def test_unclosed_skipped_elements_end():
    text = lambda page: " ".join("".join(n.text).strip() for n in h.nodes_and_features(h.parse(page))[0] if n.tag == "#")
    assert text("<head><title>t</title><body><p>all of it</p>") == "all of it"
    assert text("<head><title>t</title><meta name=a><div>all of it</div>") == "all of it"
    assert text("<head><title>t</title>all of it") == "all of it"
    assert text("<html><head><script>a='<head';b=i<n;c=\"it's\"</script></head><body><p>x</p>") == "x"
    assert text("<head><template><div>no</div></template><title>t</title></head><p>x</p>") == "x"
    for tag in ("button", "select", "svg", "object"):
        assert text(f"<div>a<{tag}>no</div><p>b</p>") == "a b", tag
        assert text(f"<ul><li>a<{tag}>no<li>b</ul>") == "a b", tag
        assert text(f"<div>a<{tag}>no</{tag}>b</div>") == "ab", tag
    assert text("<button>no<button>no</button><p>x</p>") == "x"
    assert text("<svg><svg></svg><path></svg><p>x</p>") == "x"
    assert text("<svg><foreignObject><div>no</div></foreignObject></svg><p>x</p>") == "x"
    assert text("<svg><path><p>x</p>") == "x"
    assert text("<div><object><script>'</object>'</script>no</object>x</div>") == "x"
