"""Main text of pages: structure, decisions of the two passes, and broken markup."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import pytest

from clearwell.llm import pages as pg
from clearwell.llm.queries import QUERIES

LONG = "It is the first of the long parts of this text, and it was written so that there are many of the words in it. " * 3
MORE = "The second part of the story is in the same style as that of the first, with all of the usual words of a text. " * 3


def squash(text):
    return " ".join(text.split())


def test_article_without_the_rest():
    page = f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>
    <header><h1>The site of the day</h1></header><nav><ul><li><a href="/a">A</a><li><a href='/b'>B</a></ul></nav>
    <div class="cookie-notice">We use cookies on this site and it is for you to say if that is fine with you.</div>
    <article><header><h1>Title &amp; more</h1></header><p><b>{LONG}</b><br>and&nbsp;on
    <p>Short.<p>a &lt; b &#x41;&#66;</p><script>var x = "</p><p>no</p>";</script><!-- <p>hidden</p> -->
    <div class="ad">It is the best of all and it is for you and for all of us.</div>
    <form><label>Your name</label><input></form><p>{MORE}</p>
    <section id="comments"><article><p>{LONG}</p></article></section></article>
    <aside>{MORE}</aside><footer>&copy; site</footer></body></html>"""
    wanted = f"Title & more {squash(LONG)} and on Short. a < b AB {squash(MORE)}"
    assert pg.main_text(page) == wanted


def test_pages_without_an_article():
    page = f"""<body><div><a href=x>One</a> | <a href=y>Two</a></div><p>{LONG}</p><p>Brief.</p><p>{MORE}</p>
    <div>{'keyword, ' * 40}</div><p>contact</p></body>"""
    assert pg.main_text(page) == f"{squash(LONG)} Brief. {squash(MORE)}"


def test_open_blocks_follow_the_nearer_neighbour():
    good, bad = pg.Block(LONG, 0, False, 0, False), pg.Block("x", 0, True, 0, False)
    open_ = pg.Block("short", 0, False, 0, False)
    assert pg.classify([good, open_, open_, open_, bad]) == [True, True, True, False, False]
    assert pg.classify([bad, open_, good]) == [False, False, True]
    assert pg.classify([open_]) == [False] and pg.classify([]) == []
    inside = pg.Block("short", 0, False, 1, False)
    assert pg.classify([bad, inside, bad]) == [False, True, False]


def test_broken_markup():
    for page in (None, "", "<", "<p", "<article", "</p></div>", "<script>never closed", "<!-- never closed <p>x</p>", "<a href='"):
        assert pg.main_text(page) == ""
    assert pg.main_text("<article><p>no end") == "no end"
    assert pg.main_text("<nav><ul><li>menu<article><p>body text</article>") == "body text"
    assert pg.main_text("<article><p>1 < 2 & 3 > 2 &unknown; &amp;lt;</article>") == "1 < 2 & 3 > 2 &unknown; &lt;"
    assert pg.main_text('<article><p title="a > b">text</article>') == "text"
    assert len(pg.main_text("<article>" + "<div>word " * 3000)) == 5 * 3000 - 1


def test_hostile_rows(llm):
    rows = [(1, "u", "<article><p>x</article>"), (1, "u", "<article><p>x</article>"), (2, None, None), (None, "v", ""),
            (3, "w", "<article><p>" + "é " * 50_000)]
    df = llm.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = sorted((tuple(r) for r in pg.extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (2, None, "", 0), (None, "v", "", 0),
                          (3, "w", " ".join("é" * 50_000), 99_999)], key=repr)
    assert pg.extract(df.limit(0)).count() == 0


def test_every_article_of_the_test_pages(llm):
    folder = "/root/testdata/sf0.01"
    html = {r["page_id"]: r["html"] for r in llm.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in QUERIES["op9_main_text"](llm, folder).collect():
        article = re.search(r"<article>(.*?)</article>", html[r["page_id"]], re.DOTALL)[1]
        plain = pg.html.unescape(re.sub(r"<[^>]*>", " ", article))
        assert r["text"].split() == plain.split() and r["n_chars"] == len(r["text"])


def test_names_do_not_lose_the_article():
    long, more = squash(LONG), squash(MORE)
    body = f"<p>{LONG}</p>"
    for page in (f'<html class="no-hidden menu"><body class="has-sidebar nav-open"><article>{body}</article>',
                 f'<body class="sidebar"><div class="content no-sidebar"><article>{body}</article></div>',
                 f'<article class="post comments-open">{body}</article>', f'<article class="post sidebar">{body}</article>',
                 f'<main id="navigation">{body}</main>', f'<div class="sidebar toolbar"><article>{body}</article></div>',
                 f'<div class="withComments">{body}</div>', f'<body style="display: none">{body}'):
        assert pg.main_text(page) == long, page
    assert pg.main_text(f'<div class="sidebar">{body}</div>') == ""
    assert pg.main_text(f'<div id="comments"><article>{body}</article></div><p>{MORE}</p>') == more
    assert pg.main_text(f'<article>{body}<article class="comment"><p>{MORE}</p></article></article>') == long
    assert pg.main_text(f'<article>{body}{body}</article><div class="sidebar"><article><p>{MORE}</p></article></div>') == f"{long} {long}"
    assert pg.main_text(f'<article hidden>{body}</article>') == ""


def test_a_teaser_does_not_discard_the_text_around():
    page = f"<div><p>{LONG}</p><p>{MORE}</p></div><article><h3>Next</h3><p>Read on.</p></article>"
    assert f"{squash(LONG)} {squash(MORE)}" in pg.main_text(page)
    assert pg.main_text(f"<article><p>{LONG}</p><p>{MORE}</p></article><p>{MORE}</p>") == f"{squash(LONG)} {squash(MORE)}"


def without_tags(page):
    """The page with all tags and names that tell an article from the rest turned into plain ones."""
    page = re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", page)
    return page.replace(' class="ad"', "")


def test_density_decides_where_tags_tell_nothing(llm):
    pages = [r["html"] for r in llm.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    wanted = kept = foreign = exact = 0
    for page in pages:
        article = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
        plain = Counter(pg.html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        got = Counter(pg.main_text(without_tags(page)).split())
        wanted, kept, foreign = wanted + plain.total(), kept + (plain & got).total(), foreign + (got - plain).total()
        exact += got == plain
    assert kept > 0.97 * wanted and foreign < 0.02 * wanted and exact > 0.6 * len(pages)


def test_markup_that_is_not_closed_loses_no_text():
    long = squash(LONG)
    body = f"<article><p>{LONG}</p>%s<p>{MORE}</p></article>"
    for odd in ("<svg class='i'/>", "<object data=x>", "<svg>", "<iframe src=x>", "<select>", "<template>"):
        assert pg.main_text(body % odd) == f"{long} {squash(MORE)}", odd
    assert pg.main_text(f"<html><head><meta charset=x><title>t</title><body><p>{LONG}</p>") == long
    assert pg.main_text(body % "<svg><text>no</text></svg><object>no</object>") == f"{long} {squash(MORE)}"
    assert pg.main_text(f"<p>{LONG}</p><script>var a = 1") == long


def test_a_form_around_the_page_is_no_form():
    page = f"<body><form><div><a href=x>Menu</a></div><p>{LONG}</p><p>Brief.</p><p>{MORE}</p><input></form></body>"
    assert pg.main_text(page) == f"{squash(LONG)} Brief. {squash(MORE)}"
    assert pg.main_text(f"<p>{LONG}</p><form><p>It is for you to give us the name and the place of it.</p></form><p>{MORE}</p>") == (
        f"{squash(LONG)} {squash(MORE)}")


def test_pages_in_languages_without_known_stop_words():
    chinese = "\u4eca\u5929\u5929\u6c14\u5f88\u597d\uff0c\u6211\u4eec\u53bb\u516c\u56ed\u3002" * 30
    russian = "\u042d\u0442\u043e \u0434\u043b\u0438\u043d\u043d\u044b\u0439 \u0442\u0435\u043a\u0441\u0442. " * 15
    for text in (chinese, russian):
        page = f"<div><a href=x>{text[:9]}</a></div><h2>{text[:4]}</h2><p>{text}</p><p>{text[:12]}</p><div>{'x, ' * 99}</div>"
        assert pg.main_text(page).startswith(squash(f"{text[:4]} {text}"))
        assert "x, x" not in pg.main_text(page)


@pytest.mark.parametrize("piece", ["<tr><td>cell text</td></tr>", "<b>x ", "</i><b>x", "<li>x<b>", "<object>x ", "<p><a href=y>x"])
def test_time_grows_with_the_page(piece):
    began = time.perf_counter()
    pg.main_text(piece * 2_000)
    small, began = time.perf_counter() - began, time.perf_counter()
    pg.main_text(piece * 20_000)
    assert time.perf_counter() - began < 40 * small + 0.5


def test_main_text_against_a_plain_second_pass():
    """Nearest decided neighbours by looking at all blocks, for any mix of blocks."""
    r = random.Random(6)
    for _ in range(300):
        of = [
            pg.Block(r.choice([LONG, MORE, "short", "x " * 90, "a bit of a text that is not so long"]), r.choice([0, 0, 0, 40]),
                     r.random() < 0.2, r.choice([0, 0, 1, 2]), r.random() < 0.1)
            for _ in range(r.randrange(1, 14))
        ]
        first = [pg._first_pass(b) for b in of]
        for order, step in ((range(len(of)), -1), (range(len(of) - 1, -1, -1), 1)):
            for i, j in enumerate(pg._nearest_decided(of, first, order)):
                fits = [
                    x for x in range(len(of)) if (x - i) * step > 0 and first[x] is not None
                    and (not of[i].content or of[x].content == of[i].content and not of[x].boilerplate)
                ]
                assert j == min(fits, key=lambda x: abs(x - i), default=None)
