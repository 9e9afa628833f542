import html
import re
import time

import pytest
from pyspark.sql import functions as F

from gondola.llm import html_text

from .conftest import SF

CASES = {
    "sidebar and comments": (
        '<html><body><header><h1>Site</h1></header><div id="sidebar"><p>Read more, now. Buy this, please.</p></div><div class="content">'
        "<h2>Title here</h2><p>First para, with text. And more of it.</p><p>Second, good one.</p><ul><li>One item.</li><li>Two items.</li></ul></div>"
        '<div class="comments"><p>Nice article, thanks! I liked it, a lot. Very very much, really.</p></div><footer>(c) x</footer></body></html>',
        "Title here\n\nFirst para, with text. And more of it.\n\nSecond, good one.\n\nOne item.\n\nTwo items."),
    "entities and space": ("<article><p> a &lt;b&gt;\n\t&amp;amp; &nbsp;c&#233;&#x21;</p><p>d<br>e</p></article>", "a <b> &amp; cé!\n\nd e"),
    "forms, scripts, styles": ('<article><style>p{}</style><p>Body, text.</p><script>var x="<p>no</p>";</script><form><p>Sign up. Now, please.</p><input></form></article>',
                               "Body, text."),
    "unclosed tags": ('<div><p>unclosed <b>bold <p>next <a href="x>y">link</a> < 5 & 6', "unclosed bold\n\nnext link < 5 & 6"),
    "comment in markup": ("<article><p>a, b.<!-- <p>no</p> --> c</p><!-- never closed <p>x</p></article>", "a, b. c"),
    "reader comments inside main": ('<main><section class="comments"><div>long comment, text. really long, so long. and more, and more, and more.</div></section><p>Short.</p></main>',
                                    "Short."),
    "notices, roles, hidden": ('<body><div class="cookie-notice">We use cookies, accept. ok.</div><div class="post"><h1>T</h1><p>Body text, here. Good.</p><aside>Side, note.</aside>'
                               '<p hidden>no</p><p style="display: none">no</p></div><div role="navigation">x</div></body>', "T\n\nBody text, here. Good."),
    "wrapper named like a sidebar": ('<div class="has-sidebar"><article><h1>T</h1><p>Body, text.</p></article></div>', "T\n\nBody, text."),
    "layout class": ('<div class="content with-sidebar no-comments"><h2>T</h2><p>Body, text.</p><p>More, text.</p></div>', "T\n\nBody, text.\n\nMore, text."),
    "header of the article": ('<body><div class="site-header"><h2>Site</h2></div><article><div class="article-header"><h1>T</h1></div><p>Body, text.</p></article></body>',
                              "T\n\nBody, text."),
    "form around the page": ('<body><form id="f"><div class="menu">a</div><h1>T</h1><p>Body, text. More, text.</p><div class="search"><p>find</p></div></form></body>',
                             "T\n\nBody, text. More, text."),
    "discussion and adverts": ('<article><p>Body, text.</p><div class="adBox"><p>Buy, now.</p></div><section id="discussion"><p>I say, no.</p></section></article>', "Body, text."),
    "plain text": ("just text, here", "just text, here"),
    "menus only": ("<nav><a href=x>a</a></nav><footer>b</footer>", ""),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    source, text = CASES[name]
    assert html_text.main_text(source) == text


LONG = "A long paragraph, with many words, and more of them. It goes on, and on, until it ends. Then it ends."
FIVE = f"<p>{LONG}</p>" * 5
ALL = "\n\n".join([LONG] * 5)
WHOLE = {
    "body in an inner div": (f'<article><h1>Title</h1><div class="entry">{FIVE}</div><ul><li>One</li><li>Two</li></ul></article>', f"Title\n\n{ALL}\n\nOne\n\nTwo"),
    "lead, table and second section": (
        f"<body><main><div><h1>Title</h1></div><div>Lead</div><div><section>{FIVE}</section><section><h2>More</h2><p>Short.</p></section></div>"
        "<table><tr><td>a</td><td>b</td></tr></table></main></body>", f"Title\n\nLead\n\n{ALL}\n\nMore\n\nShort.\n\na b"),
    "no article, body in an inner div": (f'<body><div class="post"><h1>Title</h1><div class="entry">{FIVE}</div><ul><li>One</li></ul></div></body>', f"Title\n\n{ALL}\n\nOne"),
    "ids that are slugs": (
        f'<article><h1>T</h1><h2 id="search-and-rescue">Rescue</h2>{FIVE}<section id="side-effects"><h2 id="privacy-law">Law</h2><p id="notice">Mild.</p></section>'
        '<section id="discussion"><h2>Discussion</h2><p>We say, no.</p></section><section id="comments"><h2>Comments</h2><p>I say, no.</p></section></article>',
        f"T\n\nRescue\n\n{ALL}\n\nLaw\n\nMild.\n\nDiscussion\n\nWe say, no."),
    "page builder": (
        f'<body><div class="elementor-widget elementor-widget-heading"><h1>T</h1></div><div class="elementor-widget elementor-widget-text-editor">'
        f'<div class="elementor-widget-container">{FIVE}</div></div><div class="theme-footer">Foot</div><div class="cookie-law-info">We use them.</div></body>', f"T\n\n{ALL}"),
    "notice": (f'<article><div class="notice">Closed, today.</div>{FIVE}<div class="notices"><p>Closed, too.</p></div><div class="site-notice">Shut.</div>'
               f'<div class="NOTICE">Shut.</div><div id="siteNotice">Shut.</div></article>', ALL),
    "layout classes": (f'<body><div class="page_has_sidebar hasSidebar noComments no-search-form" id="search-with-care">{FIVE}</div></body>', ALL),
    "comments as articles": (
        f'<body><article><h1>T</h1><p>{LONG}</p></article><div id="comments"><ol><li class="comment"><article class="comment-body">{FIVE}</article></li></ol></div>'
        f'<div class="related"><article class="card">{FIVE}</article></div><article class="comment">{FIVE}</article></body>', f"T\n\n{LONG}"),
    "teasers beside a page without article": (f'<body><div>{FIVE}</div><div class="sidebar"><article><p>Other, page.</p></article></div></body>', ALL),
    "article in an element named like a sidebar": (f'<body><div>Slogan</div><div class="sidebar"><div class="search">x</div><article>{FIVE}</article></div></body>', ALL),
    "form around a page without h1": (f'<body><form action="/"><div class="logo">x</div><h2>T</h2>{FIVE}</form></body>', f"T\n\n{ALL}"),
    "form with a title": (f'<body><div>{FIVE}</div><form><h1>Sign up</h1><p>Now, please.</p></form></body>', ALL),
    "everything in widgets": (f'<body><div class="logo">x</div><div class="widget"><h1>T</h1></div><div class="widget">{FIVE}</div></body>', f"T\n\n{ALL}"),
    "a widget beside the text": (f'<body><div>{FIVE}</div><div class="widget"><p>Recent, posts.</p></div><div class="widget-area"><p>Old, posts.</p></div></body>', ALL),
    "a list of linked sources in an article": (
        f'<article><h1>T</h1>{FIVE}<ul><li><a href="a">One</a></li><li><a href="b">Two</a></li><li><a href="c">Three</a></li></ul></article>',
        f"T\n\n{ALL}\n\nOne\n\nTwo\n\nThree"),
    "linked headlines in main": (
        "<main>" + "".join(f'<h2><a href="{i}">Headline {i}</a></h2><p>{LONG}</p>' for i in range(4)) + '</main><nav><a href="x">Home</a></nav>',
        "\n\n".join(f"Headline {i}\n\n{LONG}" for i in range(4))),
    "a menu beside the article": (
        f'<body><div><p><a href="a">One</a></p><p><a href="b">Two</a></p><p><a href="c">Three</a></p></div><article>{FIVE}</article></body>', ALL),
    "two articles": (
        f"<body><article><h1>First</h1>{FIVE}{FIVE}</article><article><h1>Second</h1><h2>Part</h2><p>{LONG}</p></article></body>",
        f"First\n\n{ALL}\n\n{ALL}\n\nSecond\n\nPart\n\n{LONG}"),
    "labels outside a form": (f"<article>{FIVE}<p>Use the <label>red</label> one.</p><form><label>Name</label><input></form></article>", f"{ALL}\n\nUse the red one."),
    "formulas": (f'<article>{FIVE}<p>The value <math><mi>x</mi><annotation encoding="tex">\\x</annotation></math> is 2.</p></article>', f"{ALL}\n\nThe value x is 2."),
    "beside the article": (f"<body><div>Slogan</div><h1>Title</h1><article>{FIVE}</article><div><p>{LONG}</p></div></body>", f"Title\n\n{ALL}\n\n{LONG}"),
}


@pytest.mark.parametrize("name", WHOLE)
def test_nothing_but_boilerplate_is_dropped(name):
    source, text = WHOLE[name]
    assert html_text.main_text(source) == text


@pytest.mark.parametrize("source", ["<div>" * 30_000 + "x", '<a "' * 100_000, "<div>" * 30_000 + "</section>" * 30_000, "<button>" * 30_000, "<!--" * 50_000,
                                    "<blockquote>a" * 20_000, "<p>a" * 30_000])
def test_time_is_linear_in_the_page(source):
    began = time.time()
    html_text.main_text(source)
    assert time.time() - began < 20


def test_query_gives_the_articles_blocks(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = html_text.query(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:h1|p)>", article))
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_nulls_long_pages_repeats_and_clashes(spark):
    long = "<article>" + "<p>word, word. word</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>a, b.</p>"), (3, "<p>a, b.</p>"), (None, long)], "page_id long, html string").withColumns({"Text": F.lit("x"), "extra": F.lit(1)})
    rows = html_text.extract(df).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"], r["extra"]) for r in rows) == [(0, 20_000 * 18 - 2 + 0, 1), (1, 0, 1), (2, 0, 1), (3, 5, 1), (3, 5, 1)]
    assert html_text.extract(df.limit(0)).collect() == []
