"""Main text by wrappers: common markup, hosts without telling names, odd and very long pages."""

import time

import pytest

from tallymart.llm import wrappers

SCHEMA = "page_id long, url string, html string"
# markup around one varied text, and what has to come out for page k
MARKUP = {
    "style of an article": ('<article style="overflow:hidden"><p>A {k}</p></article>', "A {k}"),
    "class of a part": ('<article><div class="overflow-hidden"><p>A {k}</p></div></article>', "A {k}"),
    "shown to readers": ('<article><div aria-hidden="false"><p>A {k}</p></div></article>', "A {k}"),
    "data attribute": ('<article><p data-hidden-id="5">A {k}</p></article>', "A {k}"),
    "hidden": ('<article><p>A {k}</p><p hidden>no {k}</p><p aria-hidden="true">no {k}</p><p style="display: none">no {k}</p></article>', "A {k}"),
    "form around the page": ("<form id=f><article><p>A {k}</p></article></form>", "A {k}"),
    "form in the article": ("<article><p>A {k}</p><form><p>Vote {k}</p></form></article>", "A {k}"),
    "related work": ('<article><section id="related-work"><p>A {k}</p></section></article>', "A {k}"),
    "named after a state": ('<div class="content has-sidebar"><p>A {k}</p></div>', "A {k}"),
    "references": ("<article><p>A {k}</p><ul><li><a href=x>R {k}</a></li><li><a href=y>S {k}</a></li></ul></article>", "A {k}\nR {k}\nS {k}"),
    "formula": ("<article><p>A {k} <math><mi>x</mi><annotation>y</annotation></math></p></article>", "A {k} x"),
    "comment in a main part": ("<main><p>A {k} with much more text than the comment</p><article>yes {k}</article></main>", "A {k} with much more text than the comment"),
    "comments in an article": ("<article><p>A {k} is longer than that</p><article>yes {k}</article><article>no {k}</article></article>", "A {k} is longer than that"),
    "reader feedback": ('<article><p>A {k}</p><div class="reader-feedback"><p>no {k}</p></div></article>', "A {k}"),
    "named header": ('<article><div class="entry-header"><h1>T {k}</h1><span>by x</span></div><p>A {k}</p></article>', "T {k}\nA {k}"),
    "named comments": ('<article><p>A {k}</p><div class="post-comments"><p>no {k}</p></div></article>', "A {k}"),
}


def texts(spark, pages):
    return {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(pages, SCHEMA)).collect()}


@pytest.mark.parametrize("n", [1, 3, 8])
def test_common_markup(spark, n):
    pages = [
        (100 * i + k, f"https://host{i}.example.org/{k}", f"<html><body>{form.format(k=k)}<footer>F</footer></body></html>")
        for i, (form, _) in enumerate(MARKUP.values())
        for k in range(n)
    ]
    found = texts(spark, pages)
    expected = {(name, k): text.format(k=k) for name, (_, text) in MARKUP.items() for k in range(n)}
    assert {(name, k): found[100 * i + k] for i, name in enumerate(MARKUP) for k in range(n)} == expected


def test_copies_of_a_page_are_one_page(spark):
    page = "<html><body><p>Some text of this page.</p></body></html>"
    assert set(texts(spark, [(k, "https://a.example.org/", page) for k in range(5)]).values()) == {"Some text of this page."}


NAMELESS = """<html><body><div><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></div><div><p>We use cookies on this site</p></div>
<div><h1>Title {k}</h1><p>Para {k} one</p><p>Para {k} two</p></div>{advert}<div><h3>What others say</h3>{comments}</div></body></html>"""


def test_host_without_telling_names(spark):
    """Menu, notice, adverts and comments are known by what the host's pages share and repeat, not from a page alone."""
    pages = []
    for k in range(9):
        comments = "".join(f"<div><b>Ann{j}</b><p>I say {k} {j}</p></div>" for j in range(k % 3 + 1))
        advert = f'<div><a href="x{k}">Buy {k} now</a></div>' if k % 2 else ""
        pages.append((k, "https://nameless.example.org/", NAMELESS.format(k=k, comments=comments, advert=advert)))
    right = {k: f"Title {k}\nPara {k} one\nPara {k} two" for k in range(9)}
    assert texts(spark, pages) == right
    alone = texts(spark, [(k, f"https://nameless{k}.example.org/", page) for k, _, page in pages])
    assert all(alone[k] != right[k] and right[k] in alone[k] for k in right)


def test_extra_and_clashing_columns(spark):
    rows = [(1, "https://a.example.org/", "<article><p>x</p></article>", "h", "w", 1)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, host string, wrapper string, wrapper_pages int")
    found = wrappers.main_text(df).collect()
    assert [(r.page_id, r.text, r.n_chars, r.host) for r in found] == [(1, "x", 1, "a.example.org")]


@pytest.mark.parametrize("bad", ['<a href="x ', "word <", "word <b ", "<a b='\"", "a<!-- -->", "</x>a", "<script   ", "<p it's>", "<div><p>"])
def test_long_pages_of_broken_markup(bad):
    begin = time.monotonic()
    page = wrappers.parse(bad * (1_000_000 // len(bad)))
    wrappers.extract(page, wrappers.decide(wrappers.wrapper_of(page), 1))
    assert time.monotonic() - begin < 20


def test_text_around_broken_tags():
    def text(page):
        return wrappers.extract(wrappers.parse(page), wrappers.decide(wrappers.wrapper_of(wrappers.parse(page)), 1))

    assert text("<p>a < b and c > d</p>") == "a < b and c > d"
    assert text("<p title='a > b'>x</p><p it's>y</p><p>don't</p>") == "x\ny\ndon't"
    assert text('<p>x</p><a href="y <b>z</b>') == "x\nz"
    assert text("a<!-- c -->b</i>c") == "abc"
