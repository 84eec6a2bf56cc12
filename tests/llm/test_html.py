"""Op 7: regions of varied pages, and the query against the pages' own article."""

import html
import re
import time

import pytest

from conftest import SF01
from pacewise.llm import html_extract, queries

BODY = "<p>First long paragraph of the article with enough words to count.</p><p>Short.</p><p>Another long paragraph, <b>bold</b>er &amp; caf&eacute;&nbsp;open.</p>"
TEXT = "First long paragraph of the article with enough words to count. Short. Another long paragraph, bolder & café open."
CLUTTER = ["<nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>", "<div class='ad'>Buy now, this long advert has many words.</div>",
           "<aside>Side text that is long enough to be content by itself.</aside>", "<form>Your mail <input name=a><button>Go</button></form>",
           "<div id='cookie-notice'>We use cookies, a long notice text about them.</div>", "<script>var t = '<p>no</p>';</script>",
           "<style>p{margin:0}</style>", "<section class='userComments'><p>A reader comment that is long and loud.</p></section>",
           "<div role='banner'>Site title</div>", "<!-- hidden <p>text</p> -->", "<footer>&copy; somebody, all rights reserved here.</footer>"]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='story'>{}</div>", "<body><div><div>{}</div></div>"])
@pytest.mark.parametrize("k", range(len(CLUTTER)))
def test_clutter_goes(wrap, k):
    page = f"<html><head><title>T</title></head><body>{CLUTTER[k]}{CLUTTER[-k]}{wrap.format(BODY)}{CLUTTER[k]}{CLUTTER[k - 3]}</body></html>"
    assert html_extract.main_text(page) == TEXT


def test_inside_the_article():
    page = f"<article><header><h1>Title</h1><p>by A</p></header>{BODY}<div class=share>Share</div><div class='comments'><p>Nice!</p></div><footer>x</footer></article>"
    assert html_extract.main_text(page) == "Title " + TEXT
    assert html_extract.main_text(f"<article>{BODY}") == TEXT                      # never closed
    assert html_extract.main_text(f"<div class=ad>advert<article>{BODY}</article>") == TEXT
    assert html_extract.main_text("<article><p><b>one<br><p>two  \n three</article>") == "one two three"


@pytest.mark.parametrize("name", ["content has-sidebar", "with-nav story", "layout sidebar", "sidebar-right", "header", "search", "post comments"])
def test_wrappers_with_words_of_clutter(name):
    for attr in ("class", "id"):
        page = f"<body><nav><a href=x>Home</a></nav><div {attr}='{name}'><div>{BODY}</div><div class='sidebar'>Other text</div></div><footer>x</footer></body>"
        assert html_extract.main_text(page) == TEXT


def test_text_named_by_words_of_clutter():
    page = ("<article><h2 id='search-results'>Search results</h2><section id='related-work'><h3>Related work</h3><p>Others did this.</p></section>"
            "<section id='search'><p>How to search.</p></section><p class='notice'>Note this.</p><div class='notice'>And <span class='header'>this</span>.</div>"
            f"<div class='entry-header'>Intro</div>{BODY}<div class='related-posts'><p>More posts</p></div><section class='comments'><p>No</p></section></article>")
    assert html_extract.main_text(page) == "Search results Related work Others did this. How to search. Note this. And this. Intro " + TEXT


def test_regions_are_whole():
    long = "".join(f"<p>Paragraph {k} of a long story, with quite a number of words in it.</p>" for k in range(9))
    text = " ".join(f"Paragraph {k} of a long story, with quite a number of words in it." for k in range(9))
    menu = "<div><a href=x>Home</a> <a href=y>News</a></div>"
    end = "And the last part of the story stands by itself at the end."
    for parts in (f"<div>{long}</div><div><p>{end}</p></div>", f"<div>{text}</div><div>{end}</div>"):
        assert html_extract.main_text(f"<body>{menu}<div class=story>{parts}</div>{menu}</body>") == f"{text} {end}"
    assert html_extract.main_text(f"<body>{menu}<article>{long}</article><article><p>{end}</p></article><article>Fin.</article>{menu}</body>") == f"{text} {end} Fin."
    assert html_extract.main_text(f"<div><article>{long}</article></div><div><article><p>{end}</p></article></div>") == f"{text} {end}"
    assert html_extract.main_text(f"<article>{long}</article><section class=comments><article><p>{end}</p></article></section>") == text
    assert html_extract.main_text(f"<article>{long}</article><article class='related'><p>{end}</p></article>") == text
    linked = "<p><a href=z>This paragraph is a link with as many words as its neighbours here.</a></p>"
    assert "This paragraph is a link" in html_extract.main_text(f"<body>{menu}<div>{long}{linked}{long}</div></body>")


@pytest.mark.parametrize("page", ["", "   ", "<html></html>", "<nav>a</nav>", "<p", "<![CDATA[x]]>", "<!DOCTYPE html>", "</div></p>", "<script>x"])
def test_pages_without_text(page):
    assert html_extract.main_text(page) in ("", "<p")


def test_plain_text_and_long_pages():
    assert html_extract.main_text("just &lt;text&gt;") == "just <text>"
    many = "".join(f"<p>paragraph number {k} of a long page</p>" for k in range(3000))
    assert html_extract.main_text(f"<article>{many}</article>").count("paragraph") == 3000
    assert html_extract.main_text("<div>" * 500 + "deep" + "</div>" * 500) == "deep"


def test_clusters_decide_where_no_article_is_named(monkeypatch):
    page = ("<body><div><span>Home</span></div><div><div>Top <b>5</b> of <i>all</i></div><div>Log in</div></div><div><h1>Title</h1></div>"
            f"<div class='x'>{BODY}<p>Fin.</p></div><div><div>Made <b>by</b> <i>us</i></div><div>(c) 2020</div></div></body>")
    assert html_extract.main_text(page) == f"Title {TEXT} Fin."
    monkeypatch.setattr(html_extract, "content_lines", lambda ratios: ratios == ratios)
    assert html_extract.main_text(page) == f"Home Top 5 of all Log in Title {TEXT} Fin. Made by us (c) 2020"


def test_forms_and_comments():
    menu = "<nav><a href=x>Home</a></nav>"
    for story in (f"<article>{BODY}</article>", f"<div>{BODY}</div>", BODY):
        assert html_extract.main_text(f"<body><form>{menu}{story}<footer>x</footer></form></body>") == TEXT
        assert html_extract.main_text(f"<body>{menu}{story}<form><p>Leave us your mail address and we will write you.</p></form></body>") == TEXT
        assert html_extract.main_text(f"<body>{story}<div id=commentsThread><p>A reader wrote this, with quite many words.</p></div></body>") == TEXT
    assert html_extract.main_text(f"<article>{BODY}<form>Your mail <input name=a></form></article>") == TEXT
    assert html_extract.main_text("<form><article>Few.</article></form>") == "Few."
    assert html_extract.main_text("<body><form>Search <input name=q></form></body>") == ""


@pytest.mark.parametrize("unit", ["<div>some words here", "<section class=comments><p>w", "<article>some words", "<header><div>x", "</p><div>some words",
                                  "<form><div>some words here", "<div class=sidebar>some words here in a box of names"])
def test_deep_pages_take_linear_time(unit):
    def seconds(n):
        start = time.process_time()
        html_extract.main_text(unit * n)
        return time.process_time() - start

    seconds(500)
    assert seconds(16_000) < 40 * max(0.02, seconds(2_000))  # 64 times, if it were quadratic


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, f"<article>{BODY}</article>", "z"), (3, f"<article>{BODY}</article>", "z")], "page_id int, html string, TEXT string")
    out = html_extract.extract(df)
    assert out.columns == ["page_id", "html", "text"]
    assert sorted(r["text"] for r in out.collect()) == ["", "", TEXT, TEXT]
    assert html_extract.extract(df.limit(0)).collect() == []


def test_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    got = queries.op7_html(spark, SF01).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search("<article>(.*)</article>", pages[r["page_id"]]["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("</?(?:p|br|h1)>", " ", article))).split())
        assert (r["text"], r["n_chars"], r["url"]) == (want, len(want), pages[r["page_id"]]["url"])
