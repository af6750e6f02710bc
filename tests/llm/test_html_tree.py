"""Pages without telling names, names that only look like noise, hostile pages, and what the style tree decides."""

import random
import time

import pytest

from kinfold.llm import htmltext


def site(pages: int, seed: int = 3):
    """Pages whose menu, notice and footer have no names; each with an article of three unnamed sections."""
    rng = random.Random(seed)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    rows, articles = [], {}
    for i in range(pages):
        parts = [words(30) for _ in range(3)]
        articles[i] = "\n\n".join(parts)
        body = "".join(f"<div class='k{k}'><p>{p}</p></div>" for k, p in enumerate(parts))
        menu = "".join(f"<li><a href='/{x}'>{x}</a></li>" for x in ("home", "news", "about", "contact"))
        rows.append((i, f"http://site.org/{i}", f"<html><body><div><div><ul>{menu}</ul></div><div><p>This site uses all kinds of things and wants you to know about every one of them.</p></div><div>{body}</div><div><p>All rights reserved by the owners</p></div></div></body></html>"))
    return rows, articles


@pytest.mark.parametrize("pages", [2, 3, 40])
def test_unnamed_boilerplate_goes_by_entropy_alone(spark, pages):
    rows, articles = site(pages)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in htmltext.main_texts(df).collect()} == articles
    without = {r["page_id"]: r["text"] for r in htmltext.main_texts(df, threshold=0.0).collect()}
    assert all("All rights reserved" in t and articles[i] in t for i, t in without.items())


def test_unnamed_notice_inside_articles(spark):
    rows = [(i, "http://a.com/x", f"<article><h1>t{i}</h1><p>one {i} two</p><div class='q'><p>Join us today</p></div><p>same</p></article>") for i in range(6)]
    got = {r["page_id"]: r["text"] for r in htmltext.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"t{i}\n\none {i} two\n\nsame" for i in range(6)}


def test_copies_stay_whole(spark):
    rows = [(i, "http://a.com/x", "<body><div><p>the same text</p></div><div>more</div></body>") for i in range(5)]
    assert {r["text"] for r in htmltext.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {"the same text\n\nmore"}


def test_names():
    text = lambda x: htmltext.Page(x).main_text()
    assert text("<article><p>A</p><div class='share-price'>Prices rose</div></article>") == "A\n\nPrices rose"
    assert text("<div class='content search'><p>Long article</p></div><div class='page with-sidebar'><p>text</p></div>") == "Long article\n\ntext"
    for name in ("ad", "ad-slot-2", "site-footer", "siteFooter", "cookie_banner", "post-comments", "x widget", "newsletter-signup", "social-links", "related-posts", "navMenu"):
        assert text(f"<div class='{name}'>noise</div><p>k</p>") == "k", name


def test_hostile_pages_end_soon():
    for source in ("<a" * 350_000, "a<" * 500_000, '<a "' * 250_000, '<a "' * 250_000 + ">", "<div>" * 150_000, "<div>x</p>" * 90_000, "<li><ul>" + "<div><li>x" * 80_000, "<![CDATA[" * 100_000 + ">", "<b '>\"" * 150_000, "<div " + 'a="' * 300_000 + ">x", "<dl>" + "<dd><p>x" * 90_000):
        began = time.process_time()
        htmltext.Page(source).main_text({1})
        assert time.process_time() - began < 8
