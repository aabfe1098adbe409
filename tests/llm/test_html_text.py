import html as h
import math
import random
import re

import pytest

from paddock.llm import html_text
from paddock.llm.html_text import main_text

LONG = "This is a long paragraph of the article with many words in it, enough to stand out from menus and notices. " * 2
TAIL = "Another paragraph that belongs to the article and tells the reader something more about the matter at hand."


def plain(page):
    """What the pages table holds as article, by string search."""
    body = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)[1]
    return " ".join(h.unescape(re.sub(r"<[^>]*>", " \x01 ", body).replace("\x01", "")).split())


def test_article_of_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = html_text.extract_text(pages).select("page_id", "html", "text").collect()
    assert len(got) == 250
    squeeze = lambda t: re.sub(r"\s", "", t)
    assert all(squeeze(r.text) == squeeze(plain(r.html)) for r in got)
    assert all(r.text == " ".join(r.text.split()) for r in got)


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   ", ""), ("<script>var a = '<p>no</p>';</script>", ""), ("plain &amp; simple", "plain & simple"),
    (f"<body><nav><a href=x>Home</a></nav><div class='main-content'><h1>Title</h1><div><p>{LONG}<p>Short.<p>{TAIL}</div></div><footer>c</footer>",
     f"Title {' '.join(LONG.split())} Short. {TAIL}"),
    (f"<html><body><header><h2>Site</h2></header><main><article><header><h1>T</h1></header><p>{TAIL}</p><ul><li>one</li><li>two <b>bold</b></li></ul>"
     f"<div class='ad-slot'>Buy</div><p>{TAIL}</p><section id='comments'><p>{LONG}</p></section></article><aside>{LONG}</aside></main></body>",
     f"T {TAIL} one two bold {TAIL}"),
    (f"<body><div id=cookieNotice>{LONG}</div><form><p>{LONG}</p></form><article><p>a&nbsp;&lt;b&gt;&#233;<br>c  d\n e</p><p>{LONG}</p><div><h3>Comments (12)</h3><p>{LONG}</p></div></article>",
     f"a <b>é c d e {' '.join(LONG.split())}"),
    (f"<div><p>{LONG}</p><ul><li><a>one</a></li><li><a>two</a></li><li><a>three</a></li></ul><p>{TAIL}", f"{' '.join(LONG.split())} {TAIL}"),
    (f"<article><p>in<b>li</b>ne {TAIL}</i></p></b><p>{TAIL} &am", f"inline {TAIL} {TAIL} &am"),
    (f"<table><tr><td class=sidebar>{LONG}<td><p>{LONG}<tr><td>x</table>", f"{' '.join(LONG.split())}"),
])
def test_odd_pages(page, want):
    assert main_text(page) == want


P5, P8 = "x" * 49 + " " + "y" * 450, "z" * 70 + " " + "y" * 9


@pytest.mark.parametrize("page, want", [
    ("<body>" + f"<p>{P5}" * 5 + "<p>A last one.", f"{P5} " * 5 + "A last one."),
    ("<body><p>First." + f"<p>{P5}" * 5, "First." + f" {P5}" * 5),
    (f"<body><ul><li>one<li>two</ul><p>{P5}<p>{P5}<p>{P5}<p>{P5}", f"one two {P5} {P5} {P5} {P5}"),
    (f"<body><div class=content><div class=intro><p>{P8}</div><div class=story><p>{P5}<p>{P5}</div></div><div><a>Home</a></div>", f"{P8} {P5} {P5}"),
    (f"<body><div class=content><div class=intro><p>Intro.</div><div class=story><p>{P5}<p>{P5}<p>{P5}</div></div><div><a>Home</a></div>", f"Intro. {P5} {P5} {P5}"),
    (f"<body><section><h2>A</h2><p>{P5}<p>{P5}<p>{P5}</section><section><h2>B</h2><p>Short.</section>", f"A {P5} {P5} {P5} B Short."),
    (f"<body><div><p>Before.<blockquote><p>{P5}<p>{P5}</blockquote><p>After.</div>", f"Before. {P5} {P5} After."),
    (f"<body><table><tr><td><p>{P5}<p>{P5}<p>{P5}<tr><td>A short last cell</table>", f"{P5} {P5} {P5} A short last cell"),
    (f"<body><div><h1>T</h1><details>{P5}</details><p>End.</div>", f"T {P5} End."),
    (f"<body><div><a>Home</a></div><div><p>{P5}<p>{P5}<p>{P5}</div><div>Imprint</div>", f"{P5} {P5} {P5}"),
])
def test_pages_without_article_keep_their_short_parts(page, want):
    assert main_text(page) == want


CELL = "many words that make up a paragraph of the story told here, one after the other. "


@pytest.mark.parametrize("page, want", [
    # a class or id that only mentions a word drops no article text
    (f"<article><p>{TAIL}</p><section id='discussion'><p>{LONG}</p></section><div class='search-results'><p>{TAIL}</p></div>"
     f"<div class='legal-analysis'><p>Short.</p></div><div class='related'><a>x</a><a>y</a></div></article>", f"{TAIL} {' '.join(LONG.split())} {TAIL} Short."),
    (f"<main><p>Intro</p><article><h1>T</h1><p>{LONG}<p>{LONG}</article></main>", f"Intro T {' '.join(LONG.split())} {' '.join(LONG.split())}"),
    (f"<body><article><p>{LONG}</article><article><p>{LONG}</article><div>Imprint</div>", f"{' '.join(LONG.split())} {' '.join(LONG.split())}"),
    (f"<article><div class='article-header'><h1>Title</h1></div><p>{LONG}</article>", f"Title {' '.join(LONG.split())}"),
    (f"<article><div class='share-price-analysis'><p>{TAIL}</div><div class='share-bar'>Tell</div><p>{LONG}</article>", f"{TAIL} {' '.join(LONG.split())}"),
    # without article or main the ratios decide on it
    (f"<body><div class=discussion><p>{CELL * 4}<p>{CELL * 3}</div><div class=related-reading><a>x</a> <a>y</a></div>", " ".join((CELL * 7).split())),
    (f"<body><div><p>{CELL * 4}<p>{CELL * 3}</div><div class=popular-today><div>One</div><div>Two</div></div>", " ".join((CELL * 7).split())),
])
def test_words_of_a_class_are_a_doubt_and_no_more(page, want):
    assert main_text(page) == want


def test_the_clusters_decide_without_an_article(monkeypatch):
    story = f"<p>{CELL}</p><p>{CELL * 4}</p><p>{CELL * 4}</p><p>{CELL * 4}</p><p>{CELL}</p>"
    text = " ".join((CELL * 14).split())
    pages = [f"<body><div><div>Home</div><div>News</div><div>Shop</div></div><div>{story}</div><div><div>Imprint</div><div>Jobs</div></div>",
             f"<body><table><tr><td>Home</td><td>Shop</td></tr></table><div><h1>T</h1>{story}<p>End.</p></div><div><div>Top</div></div>"]
    want = [text, f"T {text} End."]
    assert [main_text(p) for p in pages] == want
    monkeypatch.setattr(html_text, "threshold", min)  # every line content
    off = [main_text(p) for p in pages]
    assert all("Home" in t and t != w for t, w in zip(off, want, strict=True))


def test_smoothing_and_clusters_by_definition():
    rng = random.Random(7)
    for _ in range(60):
        values = [rng.choice([1.0, 5.0, 40.0, 90.0]) * rng.random() for _ in range(rng.randrange(1, 25))]
        for i, got in enumerate(html_text.smoothed(values)):
            w = {j: math.exp(-((i - j) ** 2) / 2) for j in range(len(values)) if abs(i - j) <= 2}
            assert got == pytest.approx(sum(w[j] * values[j] for j in w) / sum(w.values()))
        cut = html_text.threshold(values)
        below, above = [v for v in values if v < cut], [v for v in values if v >= cut]
        if below:  # every value is nearer to the centre of its own cluster
            a, b = sum(below) / len(below), sum(above) / len(above)
            assert cut == pytest.approx((a + b) / 2) and all(abs(v - a) <= abs(v - b) for v in below) and all(abs(v - b) <= abs(v - a) for v in above)


def test_rows(spark):
    pages = spark.createDataFrame([(1, None, "x"), (2, "<p>" + "many words here " * 50_000, "x"), (2, "<p>a", None), (None, "<p>a", None)], "page_id long, html string, text string")
    got = html_text.extract_text(pages).collect()
    assert sorted((str(r.page_id), len(r.text)) for r in got) == [("1", 0), ("2", 1), ("2", 799_999), ("None", 1)]
    assert html_text.extract_text(pages.limit(0)).collect() == []


def test_smoothing_and_threshold():
    assert html_text.smoothed([3.0] * 7) == pytest.approx([3.0] * 7)
    assert 2 < html_text.threshold([1, 2, 1, 50, 60, 2]) < 50
    assert html_text.threshold([4.0]) == 4.0
