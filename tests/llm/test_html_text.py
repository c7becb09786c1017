"""Main text of pages: made pages, given pages against a plain reading."""

import html
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stellate.llm.html_text import extract_text, main_text, with_length

DIR = "/root/testdata/sf0.001"
PROSE = ["The first paragraph tells, at some length, what the matter is about and why it matters.",
         "A second one goes on, with commas, clauses, and an end that comes late enough to count.",
         "Short end."]


def body(paragraphs=PROSE):
    return "".join(f"<p>{p}</p>" for p in paragraphs)


def test_the_article_without_the_rest():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>if (a<b) x("</p>")</script></head>
    <body class="has-sidebar"><header><h1>Site name</h1><nav><a href=/>Home</a></nav></header>
    <div id="cookie-notice">We use cookies, many of them, and tell you so in a long sentence, again and again.</div>
    <div class="wrap"><div class="content"><h1>Title &amp; more</h1>{body()}
    <form><p>Your mail address, please, so that we can write to you, often.</p><input></form>
    <aside>Related, related, related, related, related, related, related.</aside>
    <ul><li><a href=1>Read this next</a><li><a href=2>And this</a></ul></div>
    <div class="sidebar">{body(["Sidebar prose, with commas, that is as long as any paragraph of the article, or longer."])}</div></div>
    <section><h2>3 comments</h2>{body(["I agree, fully, with all that the author says, and would add, if I may, a word."])}</section>
    <footer>&copy; 2020, all rights, reserved, by us</footer></body></html>"""
    assert main_text(page) == "\n".join(["Title & more", *PROSE])


def test_markup_and_white_space():
    page = ("<article><header><h1>A\n title</h1></header><p>One <b>bold<i>est</b>&nbsp;&#119;ord\t&lt;tag&gt;,<br>next"
            "<p>Two &quot;quoted&quot; <a href='x'>link</a>.<ul><li>first point, here<li>second point, there</ul>"
            "<pre>  a\n  b  </pre><!-- <p>not this</p> --><noscript>nor this</noscript></article>")
    assert main_text(page) == ('A title\nOne boldest word <tag>, next\nTwo "quoted" link.\n'
                               'first point, here\nsecond point, there\na b')


def test_siblings_and_title_are_kept():
    page = (f"<div><h1>Head</h1><div id=a>{body(PROSE * 4)}</div><p>A closing remark beside it.</p>"
            f"<div id=b>{body(PROSE[:2])}</div><div id=c><p>x</p></div></div>")
    assert main_text(page).split("\n") == ["Head", *PROSE * 4, "A closing remark beside it.", *PROSE[:2]]


def test_links_discount():
    links = "".join(f"<p><a href={i}>A headline, with commas, of another article, number {i}, to read</a></p>" for i in range(30))
    assert main_text(f"<body><div>{links}</div><div>{body()}</div></body>") == "\n".join(PROSE)


def test_comment_articles_and_wrappers_with_misleading_names():
    page = (f"<div class='header-menu-page'><main><article>{body()}</article>"
            f"<article class='comment'>{body(PROSE[:1])}</article></main></div>")
    assert main_text(page) == "\n".join(PROSE)


@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"), ("<p>a < b & c</p>", "a < b & c"),
    ("<p>unclosed <!-- comment", "unclosed"), ("<p>x</p><script>never closed", "x"), ("<p>a</p></div></p>", "a"),
    ("<p title=\"never ends>one</p><p>two</p>", "one\ntwo"), ("<div hidden><p>no</p></div><p>yes</p>", "yes"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<p> </p>", ""), ("<nav>only a menu</nav>", "")])
def test_odd_pages(source, text):
    assert main_text(source) == text


@given(st.text(alphabet="<>/!-\"'= apdivul&;x", max_size=80))
@settings(max_examples=300, deadline=None)
def test_any_text_is_read(source):
    assert isinstance(main_text(source), str)


@pytest.mark.parametrize("piece", ["<a ", "<div>", "<p title=\"", "<!--", "</p>", "<li>", "<b>x", "&amp;", "<table><tr>", "<svg>"])
def test_long_odd_pages_take_linear_time(piece):
    start = time.time()
    main_text(piece * 60_000)
    assert time.time() - start < 20


def test_given_pages_against_a_plain_reading(spark):
    pages = spark.read.parquet(f"{DIR}/pages.parquet")
    found = with_length(extract_text(pages.selectExpr("*", "'old' AS text", "1 AS __html")))
    assert found.columns == ["page_id", "url", "html", "__html", "text", "n_chars"]
    rows = found.collect()
    assert len(rows) == pages.count()
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_nulls_repeats_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "<p>Ä</p>"), (2, "<p>Ä</p>"), (None, "")], "page_id long, html string")
    assert sorted(map(tuple, with_length(extract_text(df)).select("page_id", "text", "n_chars").collect()), key=str) == \
        sorted([(1, "", 0), (2, "Ä", 1), (2, "Ä", 1), (None, "", 0)], key=str)
    assert extract_text(df.limit(0)).collect() == []
