"""Main text of pages: layouts with a known article, the given pages by SQL, edge rows."""

import duckdb
import pytest

from snaplake.llm import extract, registry

LONG = "The first paragraph tells, at length, what happened; it has marks, clauses, and an end."
MORE = "A second one follows with more of it: names, numbers, and a reason why it matters."
BODY = f"<p>{LONG}</p><p>{MORE} See <a href='/x'>the report</a>, too.</p><h2>Why</h2><ul><li>One</li><li>Two</li></ul><p>End.</p>"
TEXT = f"{LONG}\n\n{MORE} See the report, too.\n\nWhy\n\nOne\n\nTwo\n\nEnd."
MENU = "<ul class='main-menu'>" + "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(12)) + "</ul>"
COMMENTS = "<section id='comments'><h3>3 comments</h3>" + "".join(f"<div><p>I think, as a reader, that {i} is too long, and wrong, and late, and I say so here.</p></div>" for i in range(9)) + "</section>"

LAYOUTS = {
    "article": f"<nav>{MENU}</nav><div class='cookie-notice'>We use cookies.</div><article><h1>Title</h1>{BODY}</article><footer>&copy; 2020</footer>",
    "main": f"<header><a href=/>Home</a></header><main><h1>Title</h1>{BODY}{COMMENTS}</main><aside><p>Other text, which isn't meant, stands here.</p></aside>",
    "plain divs": f"<div id=top><div>{MENU}</div></div><div class=wrap><div id=content><h1>Title</h1>{BODY}</div><div class='sidebar'><p>Other, longer text.</p></div></div><div>{MENU}</div>",
    "unnamed boxes": f"<div><div>{MENU}</div><div><h1>Title</h1>{BODY}</div><div><ul><li><a href=a>About</a></li><li><a href=b>Terms</a></li></ul></div></div>",
    "comments": f"<div class=page><div class=post><h1>Title</h1>{BODY}</div><div class='post-comments'>{COMMENTS}</div></div>",
    "form around all": f"<form action='/x'><div class=menu>{MENU}</div><article><h1>Title</h1>{BODY}</article><input name=q><button>Send</button></form>",
    "named wrapper": f"<div class='has-sidebar header-wide'><h1>Title</h1>{BODY}</div><div class=ads>Buy, now!</div>",
    "header in article": f"<article><header class=entry-header><h1>Title</h1><p>By someone, today.</p></header>{BODY}<footer>Filed under x</footer></article>",
    "cut off": f"<article><h1>Title</h1>{BODY}</article><footer>&copy; 2020 <a hr",
    "unclosed": f"<article><h1>Title</h1><p>{LONG}<p>{MORE} See <a href='/x'>the report</a>, too.<h2>Why</h2><ul><li>One<li>Two</ul><p>End.",
    "upper case": f"<ARTICLE><H1>Title</H1>{BODY}</ARTICLE><SCRIPT>if (a</b>) document.write('<p>no</p>')</SCRIPT><STYLE>p>b{{}}</STYLE>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page = f"<!DOCTYPE html><html><head><title>T &amp; S</title><script>var t='</p>';</script></head><body class='no-sidebar'>{LAYOUTS[name]}"
    assert extract.main_text(page + ("" if name in ("cut off", "unclosed") else "</body></html>")) == f"Title\n\n{TEXT}"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), (" \n ", ""), ("<p></p><!-- a > b -->", ""), ("just text", "just text"), ("a < b &amp; c &lt d", "a < b & c < d"),
        ("<p>a&nbsp;\n\tb<br>c<b>d</b>e<!-- x -->f</p>", "a b cdef"), ("<p>&#x41;&#66;&eacute;&unknown;&am", "ABé&unknown;&am"), ("<nav>only</nav>", ""),
        ("<p title='a > b'>x</p><p title=\"c's\">y", "x\n\ny"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"), ("<p>x</p></div></article><p>y</p>", "x\n\ny"),
        ("<p>a</p>\x00<p>b</p>", "a\n\n\x00\n\nb"), ("<pre>a\n  b</pre>", "a b"), ("<article>x</article><article>y</article>", "x\n\ny"),
    ],
)
def test_edges_of_pages(page, text):
    assert extract.main_text(page) == text


def test_long_and_deep_pages():
    many = "".join(f"<p>Paragraph {i}, with a mark.</p>" for i in range(20_000))
    got = extract.main_text(f"<body>{many}</body>")
    assert got.split("\n\n") == [f"Paragraph {i}, with a mark." for i in range(20_000)]
    assert extract.main_text("<div>" * 3000 + "deep, text.") == "deep, text."
    assert extract.main_text("<p a='" * 2000 + "x") == ""


def test_short_blocks_of_the_article_stay():
    """Path ratios choose paths by their mean: short paragraphs of a chosen path stay."""
    page = f"<div>{MENU}</div><div><p>{LONG}</p><p>Ok.</p><p>{MORE}</p><p>1</p></div>"
    assert extract.main_text(page) == f"{LONG}\n\nOk.\n\n{MORE}\n\n1"


def test_path_ratios_choose_text_over_links():
    leaves = [(("ul", "li", "a"), f"Item {i}", True) for i in range(20)] + [(("div", "p"), LONG, False)] * 3
    assert extract.content_paths(leaves) == {("div", "p")}


def test_rows_and_columns(spark):
    rows = [(1, "u", LAYOUTS["article"], "old", "x"), (1, "u", LAYOUTS["article"], "old", "x"), (None, None, None, None, None), (2, "v", "", "old", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT string, `a.b` string").repartition(2)
    got = extract.extract(pages)
    assert got.columns == ["page_id", "url", "html", "a.b", "text"]
    assert sorted((r["page_id"] or 0, r["text"]) for r in got.collect()) == [(0, ""), (1, f"Title\n\n{TEXT}"), (1, f"Title\n\n{TEXT}"), (2, "")]
    assert extract.extract(pages, html="html", text="html").columns == ["page_id", "url", "TEXT", "a.b", "html"]
    assert extract.extract(pages.limit(0), keep_html=False).count() == 0


def test_given_pages_by_sql(spark):
    sf = "/root/testdata/sf0.01"
    c = duckdb.connect()
    c.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    got = sorted(tuple(r) for r in registry.queries()["op11_tag_path_text"](spark, sf).collect())
    assert got == sorted(c.execute(registry.oracle_sql()["op11_tag_path_text"]).fetchall())
