"""Main text of pages: hand-made pages, and the given pages whose article element is known."""

from __future__ import annotations

import html
import re
import time

import pytest

from foldcat.llm.html_blocks import extract_pages, main_text, settle

LONG = "The river is one of the longest in the country and it runs to the sea with a lot of water in it."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p></p>", ""),
        (f"<nav><a>Home</a></nav><p>{LONG}</p><p>Short.</p><footer>&copy; x</footer>", f"{LONG}\n\nShort."),
        ("<article><h1>A &amp; B</h1><p>x&nbsp; y\n z</p></article>", "A & B\n\nx y z"),
        ("<article><p>a<b>b</b> c<br>d<p>e</article>", "ab c d\n\ne"),
        ('<article><p>x</p><div class="ad">buy the best of the cars in the world now and here for you</div><p>y</p></article>', "x\n\ny"),
        ("<script>var a='</p><p>hey';</script><style>p{}</style><article>t &lt;b&gt;</article>", "t <b>"),
        (f"<div id='comments'><p>{LONG}</p></div><main><p>m</p></main><aside>{LONG}</aside>", "m"),
        (f"<form>{LONG}</form><p>{LONG}</p><div class='cookie-notice'>{LONG}</div>", LONG),
        (f"<div><a href='a'>{LONG}</a></div><p>{LONG}</p>", LONG),
        ("<!-- <p>no</p> --><article>yes<!-- open", "yes"),
        ("<article><p>unclosed <a href='x>y'>link", "unclosed link"),
        (f"<article><section class='comments'><p>{LONG}</p></section><p>own</p></article>", "own"),
        ("<article><ul><li>one<li>two</ul></article>", "one\n\ntwo"),
        ("&amp;lt; <", ""),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_open_blocks_follow_their_neighbours():
    assert settle([True, None, None, None, False], [0] * 5) == [True, True, True, False, False]
    assert settle([None, None], [0, 1]) == [False, True]
    assert settle([False, None, True], [1, 0, 0]) == [False, True, True]


def test_given_pages(spark):
    """The given pages hold one article element each: its blocks are the result."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    assert len(got) == pages.count()
    for page in pages.collect():
        body = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<!--.*?-->", "", body.replace("<br>", " ")))
        want = "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)
        assert got[page.page_id].text == want
        assert got[page.page_id].n_chars == len(want)


def test_odd_rows(spark):
    rows = [(1, None, None, "a"), (1, "u", "<p>" * 5000 + "x", "b"), (None, "u", "<p>" + "word the " * 300_000, "c"), (2, "u", "<<<>>> &#0; &bogus;", "d")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_pages(pages).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert max(r.n_chars for r in got) == 9 * 300_000 - 1
    assert extract_pages(pages.limit(0)).count() == 0


POLISH = "Wisła jest najdłuższą rzeką kraju. " + "Płynie przez wiele miast, łąk oraz lasów aż do morza, gdzie kończy swój długi bieg. " * 3
CHINESE = "这条河流是全国最长的河流之一，它穿过许多城市和森林，最后流入大海。" * 4
LINKS = "<a href='x'>" + "python spark java scala hive kafka flink " * 4 + "</a> more"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # The prose stands in a div, a related story in an article element.
        (f"<div><p>{LONG}</p><p>{LONG}</p></div><article class='card'><h3>Next</h3><p>Short teaser.</p></article>", f"{LONG}\n\n{LONG}"),
        # Prose beside the element is kept, short blocks that only an element would save are not.
        (f"<div><p>{LONG}</p></div><article><h1>T</h1><p>{LONG}</p><p>{LONG}</p></article>", f"{LONG}\n\nT\n\n{LONG}\n\n{LONG}"),
        # Of several elements the one with the most text is the article.
        (f"<article><p>Teaser.</p></article><article><h1>T</h1><p>{LONG}</p></article><article><p>Other.</p></article>", f"T\n\n{LONG}"),
        ("<article><p>x</p></article><article><p>y</p></article>", "x\n\ny"),
        # Link density and length reject inside the element.
        (f"<article><p>{LONG}</p><p>{LINKS}</p><p>{LONG}</p></article>", f"{LONG}\n\n{LONG}"),
        # Languages whose stop words are not listed.
        (f"<p>{POLISH}</p><p>{CHINESE}</p>", f"{POLISH.strip()}\n\n{CHINESE}"),
        (f"<div>{'tag cloud words ' * 20}</div><p>{LONG}</p><div>{LINKS}</div>", f"{'tag cloud words ' * 20}".strip() + f"\n\n{LONG}"),
    ],
)
def test_the_element_is_a_feature(page, text):
    assert main_text(page) == text


ARTICLE = f"<h1>T</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
WANTED = f"T\n\n{LONG}\n\nShort.\n\n{LONG}"
READER = "<p>I think that this is one of the best of all of them and I read it with a lot of joy.</p>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>x</title><body><article>{ARTICLE}</article></body></html>",
        f"<html><head><meta charset=utf-8><title>x<body><article>{ARTICLE}</article><svg><title>i</title></svg>",
        f"<body><datalist><option value=a></datalist><article>{ARTICLE}</article>",
        f"<body><select><option>a<option>b</select><button>Menu<article>{ARTICLE}</article><button>ok</button>",
        f"<body><nav><button>Menu</nav><article>{ARTICLE}</article><textarea>",
        f"<body><form action=x method=post><div>{ARTICLE}</div><input name=v></form>",
        f"<body><form id=aspnetForm><nav><a>Home</a></nav><article>{ARTICLE}</article></form>",
        f'<body class="has-sidebar"><article class="post comments-open">{ARTICLE}</article></body>',
        f'<body class="home search"><div class="search-results-page">{ARTICLE}</div></body>',
        f'<body><main class="social page">{ARTICLE}</main>',
        f'<body><div class="layout sidebar-right"><div>{ARTICLE}</div></div>',
        f'<body><div class="with-sidebar widget">{ARTICLE}</div>',
        f"<body><article><p class=it's></p>{ARTICLE}</article>",
        f"<body><article><a title=\"it's\" rel=don't></a>{ARTICLE}</article>",
        f'<article>{ARTICLE}</article><ol class="commentlist"><li>{READER}</ol>',
        f'<article>{ARTICLE}</article><div class="userComments">{READER * 9}</div>',
        f'<article>{ARTICLE}</article><section id="comments"><article class="comment-body">{READER * 9}</article></section>',
        f'<article>{ARTICLE}</article><article class="comment">{READER * 9}</article>',
        f'<div class="topnav">the home of the of and a the list of all of it in a row here</div><article>{ARTICLE}</article>',
        f'<article>{ARTICLE}<svg><text>the of and a to in is that it for was on are as</text></svg></article>',
        f"<script>var a = '<p>';</script><style>p {{ }}</style><article>{ARTICLE}</article><script>if (a < b) {{ x('</p>')",
        f"<article>{ARTICLE}<object>",
        f"<nav>the of and a to in is that it for was on are<div><article>{ARTICLE}</article></div>",
    ],
)
def test_pages_as_they_are_written(page):
    assert main_text(page).replace("the of and a to in is that it for was on are\n\n", "") == WANTED


@pytest.mark.parametrize(
    "page",
    [
        "<a '" * 250_000,
        "<a =\"" * 200_000,
        "<a x='\"" * 150_000,
        "<b>" * 150_000 + "</i>" * 150_000,
        "<p><table><tr><td>" + "<b>" * 150_000 + "</p>" * 150_000,
        "<![CDATA[" * 110_000,
        "<a" * 500_000,
        "<!" * 500_000,
        "<button>" * 120_000,
        "<option><title>" * 60_000,
        "<script>" * 120_000,
        "<svg><li>" * 100_000,
        "<div class='sidebar'>" * 50_000 + LONG,
        "&" * 1_000_000,
        "<p " + "class " * 160_000 + ">" + LONG,
        "<" * 1_000_000,
    ],
)
def test_a_megabyte_of_anything_takes_little_time(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 4
