"""HTML extraction: the cut against all labellings, pages of several makes."""

from __future__ import annotations

import itertools
import random

import pytest

from starmart.llm import main_text
from starmart.llm.main_text import extract, minimum_cut


def cost(keep, odds, edges):
    """What a labelling pays: odds given up on either side, and edges cut."""
    total = sum(max(z, 0) if not k else max(-z, 0) for z, k in zip(odds, keep))
    return total + sum(w for a, b, w in edges if keep[a] != keep[b])


def test_cut_is_the_cheapest_labelling():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 9)
        odds = [round(rng.uniform(-3, 3), 2) for _ in range(n)]
        edges = [(a, b, round(rng.uniform(0, 2), 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        got = cost(minimum_cut(odds, edges), odds, edges)
        assert abs(got - min(cost(k, odds, edges) for k in itertools.product((True, False), repeat=n))) < 1e-6


ARTICLE = "<h1>The title</h1><p>First paragraph, with a <a href=x>link</a> in it &amp; more.</p>\n<p>Second   one,<br>on two\tlines.</p>"
WANT = "The title\nFirst paragraph, with a link in it & more.\nSecond one, on two lines."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='<p>no</p>';</script></head><body>{body}</body></html>"


def test_article_without_its_surroundings():
    around = [
        "<nav><ul><li><a href=/a>Home page</a></li><li><a href=/b>News of today</a></li></ul></nav>",
        "<header><p>Site name and a long slogan that reads like a sentence.</p></header>",
        "<div class='ad'>Buy our wonderful things now, they are really cheap today.</div>",
        "<aside><p>Some other long text in the side bar, which is not the article.</p></aside>",
        "<div id='cookie-notice'>We use cookies to make this site better. Please accept them all.</div>",
        "<form action=x><label>Your mail address</label><p>Write to us, we are happy to read it.</p><button>Send</button></form>",
    ]
    after = "<section class='comments'><p>What a great article this is, thank you for writing it!</p></section><footer>&copy; 2024 Some company, all rights reserved.</footer>"
    assert extract(page("".join(around) + f"<article>{ARTICLE}</article>" + after)) == WANT
    assert extract(page(f"<article>{ARTICLE}<div class=ad>An advert that stands within the article itself.</div></article>")) == WANT


def test_pages_without_an_article_element():
    story = "".join(f"<p>Paragraph number {i} of the story has enough words to be read as text, and ends well.</p>" for i in range(4))
    got = extract(page(f"<div><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div><div>{story}</div><div class=footer><p>Imprint and so on, in a sentence.</p></div>"))
    assert got.split("\n")[0].startswith("Paragraph number 0") and len(got.split("\n")) == 4


def test_broken_markup():
    assert extract("<article><p><b>One.<br><p>Two &am <p>Three &lt;3 &#233; &eacute") == "One.\nTwo &am\nThree <3 é é"
    assert extract("<article><!-- no --><p>Text one is here.</p><p></div></b>Text two is here.</article><nav>menu") == "Text one is here.\nText two is here."
    assert extract("plain words only, which no markup surrounds, and which are long enough to be a text.").startswith("plain words")
    assert extract(None) == extract("") == extract("<html></html>") == ""


def test_long_and_deep_pages():
    many = "<article>" + "".join(f"<p>Sentence number {i} stands here.</p>" for i in range(5000)) + "</article>"
    assert len(extract(many).split("\n")) == 5000
    assert extract("<div>" * 3000 + "<article><p>Deep text is found here.</p></article>") == "Deep text is found here."
    assert len(extract("<article><p>" + "word " * 100000 + "</p></article>")) == 499999


def test_pages_table(spark):
    rows = [(1, "u", page(f"<article>{ARTICLE}</article>")), (2, None, None), (None, "v", ""), (1, "u", page(f"<article>{ARTICLE}</article>"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'mine' as text", "1 as n_chars")
    got = sorted(main_text.main_text(frame).collect(), key=str)
    assert [(r["text"], r["n_chars"]) for r in got if r["page_id"] == 1] == [(WANT, len(WANT))] * 2
    assert [(r["text"], r["n_chars"]) for r in got if r["page_id"] != 1] == [("", 0)] * 2
    assert main_text.main_text(frame.limit(0)).collect() == []


STORY = "".join(f"<p>Paragraph number {i} of the story has enough words to be read as text, and it ends well here.</p>" for i in range(20))


@pytest.mark.parametrize("inner", [STORY, f"<article>{STORY}</article>", f"<div><section>{STORY}</section></div>", f"<main><div class=text>{STORY}</div></main>"])
@pytest.mark.parametrize(
    "name", ["has-sidebar", "with-sidebar", "post share", "no-comments", "layout-side", "header-fixed", "sidebar-left main", "page-header", "is-menu-open", "site-footer-sticky"]
)
def test_no_article_is_lost_in_a_layout(name, inner):
    """What holds most of the page's text is no side bar, whatever its class is called."""
    around = "<nav><a href=1>Home</a> <a href=2>News</a></nav>", "<footer>Imprint and so on, in one sentence.</footer>"
    body = f"{around[0]}<div class='{name}'>{inner}</div>{around[1]}"
    for html in (page(body), page(f"<div id=wrapper>{body}</div>"), page(f"<form id=aspnet action=x>{body}<input name=y></form>")):
        assert len(extract(html).split("\n")) == 20


def test_parts_within_the_content_go():
    side = "<div class=sidebar><p>About the author of this page, who writes things often and well.</p></div>"
    reader = "<p>A comment by some reader, long enough to be a paragraph of its own, which goes on for quite a while, really.</p>"
    comments = f"<div class=comments><div class=c><div>{reader}</div></div><div class=c><article>{reader}</article></div></div>"
    got = extract(page(f"<div class=content>{side}{STORY}{comments}</div>"))
    assert len(got.split("\n")) == 20 and "author" not in got and "reader" not in got


def test_many_nested_elements_take_linear_time():
    words = extract("<div>word here " * 100_000)
    assert isinstance(words, str)
    assert extract("<div>" * 100_000 + f"<article>{STORY}</article>").count("\n") == 19
    assert extract("<b>" * 50_000 + f"<article>{STORY}</article>").count("\n") == 19
