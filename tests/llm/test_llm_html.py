"""Main text of pages."""

from __future__ import annotations

import html
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarn.llm.html_text import extract_text, main_text
from tarn.llm.queries import QUERIES

PARAGRAPH = "A sentence, of some length, that reads like text, because it has commas and words."
OTHER = "Another paragraph of the article, which also says something, at some length."


def plain(page):
    """The article of a test page: it is marked, and its blocks are p and h1."""
    article = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", article)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_query_gives_the_articles(spark, sf_dir):
    sql = f"SELECT page_id, url, html FROM '{sf_dir}/pages.parquet'"
    pages = {p: (u, h) for p, u, h in duckdb.connect().execute(sql).fetchall()}
    rows = QUERIES["op1_html_extraction"](spark, sf_dir).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        url, page = pages[r.page_id]
        assert (r.url, r.text, r.n_chars) == (url, plain(page), len(plain(page)))


@pytest.mark.parametrize(
    "junk",
    [
        "<nav><a href=/a>One</a> <a href=/b>Two</a></nav>",
        "<header><h1>Site name</h1></header>",
        "<footer>Copyright, all rights reserved, and so on.</footer>",
        "<aside><p>Side bar, with text, and commas, that goes on for some time, as they do.</p></aside>",
        '<div class="sidebar"><p>Side bar, with text, and commas, that goes on, as they do.</p></div>',
        '<div id="cookie-notice">We use cookies, as all do, to serve you better.</div>',
        '<div class="ad-slot"><p>Buy this, buy that, buy now, at a price, only today.</p></div>',
        "<form><p>Your name, your address, your wishes, please.</p><input><select><option>x</select></form>",
        "<script>if (a < b) document.write('<p>script, text, here</p>')</script>",
        "<style>p > a { color: red }</style>",
        "<!-- <p>a comment, of the markup, not of readers</p> -->",
        '<section class="comments">' + f"<p>{PARAGRAPH}</p>" * 9 + "</section>",
        '<ul class="menu"><li><a href=/x>Menu</a></li></ul>',
        '<p style="display: none">hidden, text, that nobody, sees</p>',
        "<noscript>Please, switch on, your scripts.</noscript>",
    ],
)
@pytest.mark.parametrize("shell", ["<article>{}</article>", '<div class="post">{}</div>', "<main><div>{}</div></main>"])
def test_junk_stays_out(junk, shell):
    article = shell.format(f"<p>{PARAGRAPH}</p><p>{OTHER}</p>")
    for page in (f"<html><body>{junk}{article}</body></html>", f"<body>{article}{junk}</body>"):
        assert main_text(page) == f"{PARAGRAPH}\n\n{OTHER}"


def test_characters_white_space_and_blocks():
    page = (
        "<article><h2>Title &amp; &lt;more&gt;</h2><p>one &eacute; &#233; &#x1F600;\n\n two\t<b>th</b>ree"
        "<br>four<p>five, six<ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>"
    )
    assert main_text(page) == "Title & <more>\n\none é é \U0001f600 two three four\n\nfive, six\n\na\n\nb\n\nc\n\nd"


def test_nothing_is_dropped_from_a_long_article():
    paragraphs = [f"Paragraph {n}, with words." if n % 7 else "Short" for n in range(3_000)]
    page = "<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"
    assert main_text(page) == "\n\n".join(paragraphs)


def test_links_discount_a_container():
    links = "".join(f'<p><a href="/{n}">Link text, with commas, number {n}, and more</a></p>' for n in range(40))
    page = f"<body><div>{links}</div><div><p>{PARAGRAPH}</p><p>{OTHER}</p></div></body>"
    assert main_text(page) == f"{PARAGRAPH}\n\n{OTHER}"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    "< > </ <!-- --> <p> </p> <div class=ad> </div> <a href='x > y'> </a> <script> </script> \" ' & &amp; &#0; "
    "<![CDATA[ ]]> <table> <td> <li> <br/> <article> </article> text é \x00".split(" ")
)).map("".join))
def test_any_markup_gives_text(page):
    text = main_text(page)
    assert text == text.strip() and "\n\n\n" not in text


def test_deep_and_broken_pages():
    assert main_text("<div>" * 100_000 + "deep") == "deep"
    assert main_text('<p>a<p title="never closed>b') == "a\n\nb"
    assert main_text("plain text") == "plain text"
    assert main_text("") == ""


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "u", "<p>text"), (2, "u", ""), (2, "u", ""), (3, "u", "<p>" + "a " * 200_000)]
    pages = spark.createDataFrame([(*r, "x", 9) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = [tuple(r) for r in extract_text(pages).collect()]
    assert got[:4] == [(1, None, "", 0), (None, "u", "text", 4), (2, "u", "", 0), (2, "u", "", 0)]
    assert got[4][3] == 399_999
    assert extract_text(pages.where("false")).collect() == []


def test_a_form_around_the_page_is_no_boilerplate():
    words = "The article goes on, sentence by sentence, until it has said what it came to say. " * 3
    controls = "<input value='x'><select><option>Pick</option></select><button>Send</button><textarea>Type</textarea>"
    page = f"<body><form class='form'><h1>Title</h1><div><p>{words}</p><p>{words}</p></div>{controls}</form></body>"
    found = main_text(page)
    assert found.count("The article") == 6
    assert not any(word in found for word in ("Pick", "Send", "Type"))
    assert "Sign" not in main_text(f"<body><div><p>{words}</p></div><form><p>Sign up here</p></form></body>")


ARTICLE = "<p>" + "The river rose, and the old mill turned again, slowly at first. " * 4 + "</p>"
WANTED = " ".join(("The river rose, and the old mill turned again, slowly at first. " * 4).split())
COMMENT = "<p>" + "I liked this article, thank you, and I will read it again soon. " * 3 + "</p>"


@pytest.mark.parametrize(
    "page",
    [
        f"<article>{ARTICLE}<article class='comment'>{COMMENT}</article></article>",
        f"<main><article>{ARTICLE}</article><article class='comment'>{COMMENT}</article></main>",
        f"<body><article>{ARTICLE}</article><div class='comments'><h1>Comments</h1>{COMMENT}</div></body>",
        f"<body><article class='related page'>{ARTICLE}</article></body>",
        f"<body><div class='form-page'>{ARTICLE}</div></body>",
    ],
)
def test_comments_go_and_an_odd_name_does_not_empty_a_page(page):
    assert main_text(page) == WANTED
