from __future__ import annotations

import re
import time

import pytest

from martworks.llm import line_blocks
from martworks.llm.line_blocks import main_text

NAV = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>Über uns</a></li></ul></nav>"
FOOT = "<footer>&copy; example.com &middot; All rights</footer>"
PARTS = ["A title here", "First paragraph with some length to it, and a <b>bold</b> word.", "Two.", "Third&nbsp;one &amp; more\n  text &lt;x&gt; &#233;&#x1F642;."]
TEXT = "\n".join(["A title here", "First paragraph with some length to it, and a bold word.", "Two.", "Third one & more text <x> é🙂."])


def article(parts=PARTS, between=""):
    return f"<h1>{parts[0]}</h1>" + between.join(f"<p>{p}</p>" for p in parts[1:])


def test_article_page():
    page = (
        "<!DOCTYPE html><html><head><meta charset=utf-8><title>A title here - site</title><style>p{}</style>"
        f"<script>var t='</p>';</script></head><body>{NAV}<!-- ad 1 --><div class='ad'>Buy this fine thing now.</div>"
        f"<article>{article()}</article>"
        "<aside>Related: something else that is long enough to look like text of an article.</aside>"
        "<section id='comments'><h2>Comments</h2><p>I think that this comment is long, long, long enough.</p></section>"
        f"<form><label>Your name</label><input name=n><button>Send</button></form>{FOOT}</body></html>"
    )
    assert main_text(page) == TEXT


@pytest.mark.parametrize(
    "junk",
    [
        "<div class='advert'>Buy now, it is cheap and good and will not last for long.</div>",
        "<aside><p>More</p><p>More</p><p>More</p><p>More</p><p>More</p></aside>",
        "<div class=\"cookie-notice\"><p>We use cookies on this site.</p></div>",
        "<script>if (a < b) { document.write('<p>no</p>') }</script>",
        "<!-- <p>hidden</p> -->",
        "<form action=/><p>Sign up for our letter</p><select><option>One<option>Two</select></form>",
    ],
)
def test_junk_between_paragraphs(junk):
    assert main_text(f"<body>{NAV}<article>{article(between=junk)}</article>{FOOT}</body>") == TEXT
    inner = article(between=junk).replace("Two.", "A second paragraph, as long as the others of this article are.")
    want = TEXT.replace("Two.", "A second paragraph, as long as the others of this article are.")
    assert main_text(f"<body>{NAV}<div>{inner}</div>{FOOT}</body>") == want


def test_tags_that_are_never_closed():
    assert main_text(f"<body>{NAV}<article><h1>A title<p><b>One<br><p>Two <i>words</i></article>{FOOT}") == "A title\nOne\nTwo words"
    assert main_text(f"<body><nav><ul><li>Home<article><p>One</p></article>{FOOT}") == "One"


def test_inline_advert_does_not_cut_a_paragraph():
    assert main_text("<article><p>One <span class=ad>buy</span> two</p></article>") == "One two"


def test_surge_and_dive():
    assert line_blocks.regions([0, 0, 90, 5, 60, 0, 0, 0, 0, 10, 0], 80) == [(2, 5)]
    assert line_blocks.regions([0, 0, 0], 80) == []


def test_empty_pages():
    for page in (None, "", "   ", "<html></html>", NAV, "<script>x</script>", "<!--"):
        assert main_text(page) == ""
    assert main_text("just some text") == "just some text"


def test_given_pages(spark):
    """The article element of the given pages holds their text and nothing else."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in line_blocks.extracted(pages).collect()}
    assert len(got) == pages.count()
    for p in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", p.html, re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h\d)\b[^>]*>", inner)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " , b.replace("<b>", "").replace("</b>", ""))).split()) for b in blocks]
        want = "\n".join(b for b in blocks if b)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    big = "<article>" + "<p>word word</p>" * 20_000
    rows = [(1, "u", None, "x", "y"), (1, "u", "", None, None), (None, None, "<p>" + "a b " * 50, "x", "y"), (3, "u", big, None, None)]
    got = line_blocks.extracted(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [("1", 0), ("1", 0), ("3", 20_000 * 10 - 1), ("None", 199)]
    assert line_blocks.extracted(spark.createDataFrame([], schema)).count() == 0


LONG = "".join(f"<p>Paragraph {i} of an article that is long enough to surge.</p>" for i in range(5))


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="content social-enabled">{LONG}</div>',
        f'<article><div class="entry-content with share">{LONG}</div></article>',
        f'<h1>Short</h1><div class="post no-sidebar shareable share">{LONG}</div>',
    ],
)
def test_a_class_word_does_not_empty_a_page(page):
    assert main_text(f"<body>{NAV}{page}{FOOT}</body>").endswith("Paragraph 4 of an article that is long enough to surge.")
    comment = "<div class=comments><p>A comment that is about as long as a paragraph is.</p></div>"
    assert "comment" not in main_text(f"<body>{page}{comment}</body>") or "share" in page


def test_windows_decide_without_an_article(spark):
    """The given pages give the same text when no element names the article."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for p in pages:
        assert main_text(re.sub(r"(</?)(article|main)\b", r"\1div", p.html)) == main_text(p.html)


@pytest.mark.parametrize(
    "page",
    ["<a " * 350_000, '<a "' * 250_000, '<a x="' * 170_000, "<b>" * 100_000 + "</i>" * 100_000, "<!" * 500_000,
     "<script>" * 100_000, "<" * 10**6, "<p class=x>" * 60_000, "<a href='x\" " * 80_000, "<b x=" * 160_000],
)
def test_time_grows_with_the_page(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 5


def test_tags_that_do_not_end():
    assert main_text("<p>One two three <a href='x") == "One two three"
    assert main_text("<p>One two three</p><script>var x") == "One two three"
    assert main_text("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert main_text('<p title="a > b">One</p>') == "One"
