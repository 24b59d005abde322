"""Pages whose classes, nesting or markup used to lose text."""

import time

import pytest

from comanda.llm import html

TEXT = "".join(f"<p>Paragraph {i} of the article, long enough to count for the page.</p>" for i in range(5))
WANT = ["Title", *(f"Paragraph {i} of the article, long enough to count for the page." for i in range(5))]


def text_of(spark, source, n=1):
    rows = [(i, "http://a.example.org/", source) for i in range(n)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"].split("\n\n") for r in got]


STATES = ["layout has-sidebar", "content no-sidebar", "entry comments-open", "page-wrap with-ads", "post share-enabled", "story social-story", "article-body related"]


def test_state_classes_keep_the_article(spark):
    source = "<html><body><nav>menu</nav><div class='{}'><{}><h1>Title</h1>{}</{}></div><div class='comments-area'><p>A comment that is said.</p></div></body></html>"
    rows = [(i, f"http://h{i}.example.org/", source.format(c, tag, TEXT, tag)) for i, (c, tag) in enumerate([(c, t) for c in STATES for t in ("article", "section")])]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r["text"].split("\n\n") for r in got] == [WANT] * len(rows)


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "main-nav", "cookie-banner", "comments", "ad-slot", "post-comments", "entry-share", "newsletterBox", "related posts"])
def test_names_without_text(name):
    assert html.names_no_text(name)


@pytest.mark.parametrize("name", [*STATES, "content", "sidebar-content", "shadow", "address", "navy-theme is-active", ""])
def test_names_that_say_nothing_against_text(name):
    assert not html.names_no_text(name)


def test_a_page_of_dropped_names_only_keeps_its_text(spark):
    assert text_of(spark, f"<body><div class='notice'><h1>Title</h1>{TEXT}</div></body>") == [WANT]


def test_formulas_are_text(spark):
    source = "<body><article><h1>Title</h1><p>As <math><mi>a</mi><mo>+</mo><mi>b</mi></math> shows.</p></article></body>"
    assert text_of(spark, source) == [["Title", "As a+b shows."]]


def test_deep_pages_take_little_time():
    start = time.perf_counter()
    page = html.Page("<body>" + "<div>some text" * 2000)
    found = page.candidates()
    assert len(page.blocks) == 2000 and found and time.perf_counter() - start < 3
    page = html.Page("<body>" + "<div><p>some text</p></div>" * 5000)
    assert page.candidates()[0]["last"] == 4999 and time.perf_counter() - start < 6
