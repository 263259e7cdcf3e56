from __future__ import annotations

import itertools
import random

import pytest

from tidemark.llm import html_text, queries

PAGE = """<!DOCTYPE html><html lang=en><head><title>Title &amp; more</title><style>p{}</style></head>
<body class="has-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies to improve what you see on this site.</div>
<article><h1>Head &lt;line&gt;</h1><p>First   paragraph<br>with a <b>bold</b> word.<p>Second&nbsp;one, &eacute;t&eacute; &#8364;5.</p>
<div class="ad">Buy now, this is a long advert text that reads like a sentence.</div>
<script>document.write("<p>no</p>")</script><form><label>Your name</label><input></form>
<section id="comments"><p>A reader writes a long comment about this article here.</p></section></article>
<aside><p>Other things you may like to read, in a long sentence.</p></aside><footer>&copy; 2020 Site</footer></body></html>"""


def test_article_without_boilerplate():
    assert html_text.main_text(PAGE) == "Head <line>\n\nFirst paragraph with a bold word.\n\nSecond one, été €5."


def test_page_without_article_element():
    page = (
        "<body><div id=menu><a href=/a>One</a></div><div><h2>The head</h2><p>A first paragraph, long enough to count as text.</p>"
        "<p>Short.</p></div><div class='footer-links'><a href=/x>Imprint</a></div></body>"
    )
    assert html_text.main_text(page) == "The head\n\nA first paragraph, long enough to count as text.\n\nShort."


LONG = "This paragraph of the text says what there is to say, at the length of a usual sentence, and then it ends."


@pytest.mark.parametrize("around", ["<body><nav><a href=/>Home</a></nav><article>{}</article></body>", "<body><div>{}</div></body>"])
@pytest.mark.parametrize(
    "begin", ['<section id="search-algorithms"><h2>', '<section><h2 id="related-work">', '<section id="how-to-share-a-form"><h2 class="header">',
              '<div class="post-header"><h2>', '<section><h2 id="search">']
)
def test_slugs_and_headings_with_names_stay(around, begin):
    end = "</div>" if begin.startswith("<div") else "</section>"
    page = around.format(f"<p>{LONG}</p>{begin}Three tides</h2><p>{LONG}</p><p>Short.</p>{end}<p>{LONG}</p>")
    assert html_text.main_text(page) == "\n\n".join([LONG, "Three tides", LONG, "Short.", LONG])


@pytest.mark.parametrize("name", ["class=notice", "id=search", "id=form", "class='widget text'"])
def test_names_in_an_article_can_be_outweighed(name):
    page = f"<article><p>{LONG}</p><div {name}><p>{LONG}</p></div></article>"
    assert html_text.main_text(page) == f"{LONG}\n\n{LONG}"


@pytest.mark.parametrize("name", ["class=ad-slot", "class='box cookie-bar'", "id=comments", "class=footer-links", "class=related-posts", "id=sidebar2"])
def test_named_places_go(name):
    page = f"<body><div {name}><p>A short text that stands beside the article.</p></div><div><h2>Head</h2><p>{LONG}</p><p>{LONG}</p></div></body>"
    assert html_text.main_text(page) == f"Head\n\n{LONG}\n\n{LONG}"


ASIDES = "comment comment-list comment-body user-comments reply notice cookie-notice related share menu signup-form comments responses user-feedback author-bio".split()


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main><div>{}</div></main>", '<div class="post">{}</div>'])
@pytest.mark.parametrize("name", ASIDES)
def test_comments_and_notices_in_an_article_go(around, name):
    aside = f"<div class='{name}'><p>I have read all of it and want to say what I think about it here.</p></div>"
    page = f"<body>{around.format(f'<h1>Head</h1><p>{LONG}</p><p>{LONG}</p>{aside}<p>{LONG}</p>{aside}')}</body>"
    assert html_text.main_text(page) == "\n\n".join(["Head", LONG, LONG, LONG])


def test_a_long_thread_of_comments_goes():
    thread = "".join(f"<div class=comment><p>{LONG}</p></div>" for _ in range(6))
    page = f"<article><p>{LONG}</p><p>{LONG}</p><section class=comment-list>{thread}</section></article>"
    assert html_text.main_text(page) == f"{LONG}\n\n{LONG}"
    page = f"<article><div class=comment><p>{LONG}</p><p>{LONG}</p></div></article>"
    assert html_text.main_text(page) == f"{LONG}\n\n{LONG}"


def test_a_slash_at_the_end_of_a_bare_value_closes_nothing():
    page = f"<article><p>{LONG}</p><script src=https://cdn.example/>code()</script><p>{LONG}</p></article>"
    assert html_text.main_text(page) == f"{LONG}\n\n{LONG}"
    page = "<div><a href=/a/>One</a> <a href=/>Two</a> <a href='/x'/>no link"
    assert html_text.blocks(page)[0].linked == len("OneTwo")
    closing = {"/": True, " a/": True, " a='x'/": True, " a=b /": True, " a=b/": False, " a= b/": False, " a=/": False, " a= /": False, "": False}
    assert {x: html_text._self_closing(x) for x in closing} == closing


@pytest.mark.parametrize(
    ("inner", "text"),
    [("so <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds", "so E=m holds"), ("a <object>stand-in</object> b", "a stand-in b"),
     ("go <svg><title>up</title><path/></svg> home", "go up home"), ("x<noscript> y </noscript>z", "x y z"), ("x<canvas></canvas>y", "x y"),
     ("x<select><option>A<option>B</select>y", "x y")],
)
def test_embedded_text_stays_in_its_paragraph(inner, text):
    assert html_text.main_text(f"<article><p>{LONG}</p><p>{inner}</p></article>") == f"{LONG}\n\n{text}"


@pytest.mark.parametrize("tag", ["object", "noscript"])
def test_stand_ins_that_read_like_the_article_stay(tag):
    assert html_text.main_text(f"<article><{tag}><p>{LONG}</p></{tag}></article>") == LONG


@pytest.mark.parametrize("tag", ["video", "button", "template", "canvas"])
def test_controls_and_notes_on_players_go(tag):
    page = f"<article><p>{LONG}</p><div><{tag}>Your browser does not support this.</{tag}></div><p>{LONG}</p></article>"
    assert html_text.main_text(page) == f"{LONG}\n\n{LONG}"


@pytest.mark.parametrize("tag", ["button", "video", "object", "svg", "math", "select", "template", "noscript", "canvas", "audio"])
@pytest.mark.parametrize("later", ["", "<div><{0}>Later</{0}></div>"])
def test_an_unclosed_element_drops_nothing_after_it(tag, later):
    page = f"<body><article><p>{LONG}</p><{tag} class=x><p>{LONG}</p><p>Short.</p></article>{later.format(tag)}</body>"
    assert html_text.main_text(page) == f"{LONG}\n\n{LONG}\n\nShort."


@pytest.mark.parametrize(
    "page", [None, "", "<", "<p", "<p" * 3000, "</p></div>", "<a href='x", '<p title="a>b', "<script>x", "<!-- x", "<div>" * 2000, "&am"]
)
def test_broken_pages_do_not_fail(page):
    assert isinstance(html_text.main_text(page), str)


def test_minimum_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randint(1, 7)
        terminals = [rng.randint(-9, 9) for _ in range(n)]
        ties = [(i, j, rng.randint(1, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(side):
            own = sum(max(t, 0) if not s else max(-t, 0) for t, s in zip(terminals, side))  # noqa: B023
            return own + sum(w for i, j, w in ties if side[i] != side[j])  # noqa: B023

        best = min(cost(s) for s in itertools.product((False, True), repeat=n))
        assert cost(html_text.minimum_cut(terminals, ties)) == best


def test_smoothness_decides_what_the_classifier_leaves_open():
    assert html_text.minimum_cut([900, -100, 900], [(0, 1, 200), (1, 2, 200)]) == [True, True, True]
    assert html_text.minimum_cut([-900, 100, -900], [(0, 1, 200), (1, 2, 200)]) == [False, False, False]


def test_query(spark, stored_tables):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, 5), (2, None, None, 6), (3, "v", "", 7), (3, "v", "", 7)], "page_id bigint, url string, html string, text2 int"
    )
    rows = queries.op2_main_text(spark, stored_tables(pages=pages)).collect()
    assert sorted((r["page_id"], r["n_chars"]) for r in rows) == [(1, len(html_text.main_text(PAGE))), (2, 0), (3, 0), (3, 0)]
    assert queries.op2_main_text(spark, stored_tables(pages=pages.limit(0))).count() == 0
    with pytest.raises(ValueError):
        html_text.with_main_text(pages.withColumnRenamed("text2", "TEXT"))


def test_given_pages_give_their_article(spark, sf):
    import html as h
    import re

    for r in spark.read.parquet(f"{sf}/pages.parquet").limit(40).collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        inner = re.sub(r"<br>", " ", re.sub(r"</?[ab]\b[^>]*>", "", inner))
        expected = [" ".join(h.unescape(x).split()) for x in re.split(r"</?(?:p|h1|article)>", inner)]
        assert html_text.main_text(r["html"]) == "\n\n".join(x for x in expected if x)
