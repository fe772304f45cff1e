import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from riskfeat.llm import wrappers as w

SCHEMA = "page_id bigint, url string, html string"


def shape(items):
    """A wrapper as text: ? optional, + repeated, # a text slot, = a text that never changed."""
    out = []
    for sym, optional, repeated, kids, slot in items:
        if slot:
            text = "#" if slot[3] is None else "="
        else:
            text = f"({shape(kids)})" if sym == w.GROUP else f"{sym}[{shape(kids)}]"
        out.append(text + "+" * repeated + "?" * optional)
    return " ".join(out)


def wrapper(*pages):
    return w.wrapper_of(w.page_items(p) for p in pages)


def test_slots_optionals_and_repeats():
    assert shape(wrapper("<div>a<p>x</p></div>", "<div>a<p>y</p></div>")) == "div[= p[#]]"
    assert shape(wrapper("<h1>t</h1><p>x", "<h1>t</h1><hr><div>note</div><p>x")) == "h1[=] div[=]? p[=]"
    assert shape(wrapper("<ul><li>a<li>b</ul>", "<ul><li>a<li>b<li>c<li>d</ul><p>z")) == "ul[li[=] li[#]+] p[=]?"
    assert shape(wrapper("<dl><dt>a<dd>b</dl>", "<dl><dt>a<dd>b<dt>c<dd>d<dd>e</dl>")) == "dl[(dt[#]? dd[#]?)+]"


def accepts(marks, items):
    """Whether all texts and elements of a page fall into the wrapper, whatever the order in a group."""
    at = 0
    for sym, _, _, kids, slot in items:
        mark, _ = w._place(marks, at, sym)
        if mark is None or not slot and isinstance(mark[1], list) and not accepts(mark[1], kids):
            return False
    return True


def some_page(rng):
    body = "".join(rng.choice(["<h2>h</h2>", "<p>p</p>", "<p>p</p>", "<ul><li>a<li>b</ul>", "<blockquote>q</blockquote>",
                               "<div class=ad>x</div>", "<table><tr><td>1<td>2<tr><td>3</table>"]) for _ in range(rng.randrange(70)))
    return f"<html><body><nav><a href=x>n</a></nav><article>{body}</article></body>"


@pytest.mark.parametrize("seed", range(5))
def test_every_page_falls_into_the_wrapper_of_all(seed):
    rng = random.Random(seed)
    pages = [w.page_items(some_page(rng)) for _ in range(40)]
    whole = w.align(w.wrapper_of(pages[:20]), w.wrapper_of(pages[20:]))
    marks = w.plan(whole, 3)["items"]
    assert all(accepts(marks, p) for p in pages)
    assert len(w._dump(whole)) < 20_000


ARTICLE = "<h1>A &amp; B</h1><p>One <b>two</b>\n three.<br>Four<p>Five &lt;six&gt; &#233;&nbsp;x</p><ul><li>i<li>ii</ul>"
TEXT = "A & B\n\nOne two three. Four\n\nFive <six> é x\n\ni\n\nii"
FRAMES = [
    "<!doctype html><html><head><title>t</title><style>p{margin:0}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a>x"
    "</a></ul></nav><main>{}</main><aside>side</aside><footer>&copy; me</footer></body></html>",
    "<body class='has-sidebar'><div class='cookie-notice'>We use</div><div id=menu><a href=/>m</a></div><article class=post>{}"
    "<div class='ad'>buy</div><section class='comments'><article><p>nice</article></section></article><div class=sidebar>s",
    "<div><form action=x><input><label>q</label></form><article><header><script>var a='</p>'</script></header>{}<form>reply "
    "here</form><aside>more</aside><footer>tags</footer></article><div id='comments-2'><p>c</div></div>",
    "<form id=aspnet><nav>n</nav><article>{}</article><select><option>a<option>b</select></form>",
    "<div class='navbar'><a>1</a></div><!-- <article>no</article> --><div class=content>{}</div><div class='footer-links'>f</div>",
    "<div role=banner>b</div><div role='main'>{}<div class='social-share'>s</div></div><div role=contentinfo>c",
]


@pytest.mark.parametrize("page", [f.replace("{}", ARTICLE) for f in FRAMES])
def test_articles_in_many_frames(page):
    assert w.main_text(page, w.plan(wrapper(page), 1)) == TEXT


def test_texts_of_the_host_go_where_no_article_is_marked():
    pages = [f"<div>Welcome to the site</div><div><a href=/>{i} home</a></div><div><h1>T{i}</h1><p>Text {i}</div><div>All "
             "rights reserved</div>" for i in range(4)]
    known = w.plan(wrapper(*pages), 4)
    assert [w.main_text(p, known) for p in pages] == [f"T{i}\n\nText {i}" for i in range(4)]
    copies = w.plan(wrapper(*pages[:1] * 9), 1)  # copies of one page prove nothing
    assert "Welcome" in w.main_text(pages[0], copies)


@pytest.mark.parametrize("page,text", [
    ("a < b & c &unknown; &am", "a < b & c &unknown; &am"), ("<p>x<", "x<"), ("<p>x</", "x"), ("<p>x<b", "x"), ("", ""), ("<", "<"),
    ("<p a='1>x</p><p>y", "x\n\ny"), ("x<!-- y", "x"), ("<script>x", ""), ("<p>a</div>b</p>c", "a\n\nb\n\nc"),
    ("<p title='a>b'>x", "x"), ("<P>A<BR/>b", "A b"), ("<textarea>t</textarea >x", "x"), ("<p>\u2003 é\x0b x", "é x")])
def test_broken_markup(page, text):
    assert w.main_text(page, w.plan(wrapper(page), 1)) == text


@pytest.mark.parametrize("page", ["<div>" * 200_000 + "x", "<p a='" * 200_000 + "x", "<!--" * 200_000, "<b>" * 300_000 + "x",
                                  "</p>" * 300_000 + "x", "<a href=\"x\">l</a> w " * 100_000, "<" * 1_000_000, "<p>a<h2>b" * 100_000,
                                  "<ul><li>x" * 100_000])
def test_long_pages_take_linear_time(page):
    start = time.perf_counter()
    w.main_text(page, w.plan(wrapper(page), 1))
    assert time.perf_counter() - start < 20


def test_table_of_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in w.extracted(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>", "", article.replace("<br>", " ")))
        assert got[r["page_id"]] == "\n\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_odd_rows_and_merged_wrappers(spark, monkeypatch):
    rows = [(1, None, f"<article><p>x</article>"), (2, "no host", None), (None, "http://A.b/x", ""), (3, "http://a.b/y?z", FRAMES[0].replace("{}", ARTICLE)),
            (3, "http://a.b/y?z", FRAMES[0].replace("{}", ARTICLE)), (4, "http://A.B/", FRAMES[1].replace("{}", ARTICLE)), (5, "x://c", "plain")]
    want = sorted([(1, "x"), (2, ""), (None, ""), (3, TEXT), (3, TEXT), (4, TEXT), (5, "plain")], key=repr)
    df = spark.createDataFrame(rows * 3, SCHEMA).repartition(7).withColumns(
        {c: F.lit(1) for c in ("host", "plan", "pages", "_host", "piece", "bucket", "wrapper", "text")})
    for _ in range(2):
        got = w.extracted(df)
        assert got.columns == df.columns
        assert sorted([(r["page_id"], r["text"]) for r in got.collect()], key=repr) == sorted(want * 3, key=repr)
        monkeypatch.setattr(w, "PLAN_BYTES", 0)  # wrappers joined by a shuffle, the largest hosts' broadcast
    assert w.extracted(df.limit(0)).count() == 0
