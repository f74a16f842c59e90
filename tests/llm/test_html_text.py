import random
import time

import pytest

from ledgerloom.llm import html_text
from ledgerloom.llm.html_text import extract, main_text

LONG = "A paragraph of some length, with commas, that is clearly part of the article itself"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("no markup at all", "no markup at all"),
        ("<article><p>ab</p></article>", "ab"),
        (f"<nav><a>menu</a></nav><article><h1>T &amp; t</h1><p>{LONG}.<p>{LONG}!</article><footer>f</footer>", f"T & t\n{LONG}.\n{LONG}!"),
        (f"<div class='sidebar'><p>{LONG} side</p></div><div id=c><p>{LONG}</p></div>", LONG),
        (f"<div><p>{LONG}</p><div class='ad'><p>{LONG} buy</p></div><p>b < a, &lt;b&gt; &#233;&eacute;&am</p></div>", f"{LONG}\nb < a, <b> éé&am"),
        (f"<main><p>{LONG}<br>x\n\n  y&nbsp;z</p><section id='comments'><p>{LONG} reader</p></section></main>", f"{LONG} x y z"),
        (f"<div><ul><li>{LONG} one<li>{LONG} two</ul></div>", f"{LONG} one\n{LONG} two"),
        (f"<article><p>{LONG}</p><script>var a='</p>';</script><!-- <p>no</p> --><style>p{{}}</style><p>end</p></article>", f"{LONG}\nend"),
        (f"<article><p>{LONG}</p><form><p>{LONG} form</p></form><p hidden>{LONG} hid</p></article><p", LONG),
        (f'<article><p title="a > b">{LONG}</p><p title="unclosed>{LONG} x</p></article>', f"{LONG}\n{LONG} x"),
        (f"<div><p>{LONG}</p><p><a href=x>{LONG} {LONG}</a></p></div>", f"{LONG}\n{LONG} {LONG}"),
        (f"<div class=links><p><a>{LONG} {LONG} {LONG}</a></p></div><div><p>{LONG}</p></div>", LONG),
        ("<p>unclosed <b>bold<p>next</b> one", "unclosed bold\nnext one"),
        (f"<ARTICLE><P>{LONG}</P></ARTICLE>", LONG),
        ("<!DOCTYPE html><html><head><title>t</title></head><body></body></html>", ""),
    ],
)
def test_main_text(html, text):
    assert main_text(html) == text


def test_sibling_with_points_is_kept_and_one_without_is_not():
    two = f"<p>{LONG}</p><p>{LONG}</p>"
    page = f"<body><div>{two}{two}</div><div>{two}</div><div>short</div></body>"
    assert main_text(page) == "\n".join([LONG] * 6)


def test_deep_and_broken_pages_end():
    deep = "<div>" * 3000 + f"<p>{LONG}</p>"
    assert main_text(deep) == LONG
    assert main_text("<" * 50_000).startswith("<")
    assert main_text("<a b='" * 2000) == ""
    assert main_text("</p>" * 1000 + "<td>" * 500) == ""


def plain_article(page):
    """The same choice over the same tree, every block climbing to the root on its own."""

    def above(element):
        while element > 0:
            yield element
            element = page.parents[element]

    points, size = {}, {}
    for element, text, linked in page.blocks:
        for e in above(element):
            size[e] = (size.get(e, (0, 0))[0] + len(text), size.get(e, (0, 0))[1] + linked)
        if len(text) >= 25 and (element or len(page.names) > 1):
            first = page.parents[element] if page.names[element] in html_text.PARAGRAPHS else element
            for level, e in enumerate(above(first)):
                share = [1, 2][level] if level < 2 else 3 * level
                points[e] = points.get(e, 0.0) + (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text)) / share
    articles = {e for e, name in enumerate(page.names) if name in ("article", "main")}
    if not points:
        return [t for e, t, _ in page.blocks if not articles or articles & set(above(e))]
    worth = {e: p * (1 - size[e][1] / size[e][0]) for e, p in points.items()}
    best = max(worth, key=lambda e: (round(worth[e], 9), -e))
    for e in list(above(best)):
        if e in articles:
            best = e
    least = worth[best] if best in worth else 0.0
    kept = {best}
    for e in size:
        if page.parents[e] == page.parents[best] and size[e][1] < 0.25 * size[e][0]:
            enough = points.get(e, 0.0) >= max(0.2 * least, 1.0)
            if enough or page.names[e] == "p" and size[e][0] > 80 or page.names[e] in html_text.HEADINGS:
                kept.add(e)
    return [t for e, t, _ in page.blocks if kept & set(above(e))]


def test_random_pages_equal_a_plain_walk():
    chance = random.Random(8)
    tags = ["div", "p", "a", "b", "section", "article", "ul", "li", "h2", "main", "table", "tr", "td", "span"]

    def inner(depth):
        out = ""
        for _ in range(chance.randint(0, 4)):
            if depth and chance.random() < 0.7:
                tag = chance.choice(tags)
                out += f"<{tag}>{inner(depth - 1)}" + chance.choice([f"</{tag}>", ""])
            else:
                out += " ".join(chance.choice(["word", "some, words", LONG]) for _ in range(chance.randint(1, 6)))
        return out

    found = 0
    for _ in range(600):
        page = html_text.Page(inner(chance.randint(1, 7)))
        assert page.article() == plain_article(page)
        found += 0 < len(page.article()) < len(page.blocks)
    assert found > 100


@pytest.mark.parametrize(("name", "kept"), [("share-price", True), ("notice-board", True), ("lead comment", False), ("advert", False)])
def test_names_of_paragraphs_within_an_article(name, kept):
    page = f"<article><p>{LONG}</p><p class='{name}'>{LONG} too</p><div class='share-bar'>{LONG} bar</div></article>"
    assert main_text(page) == (f"{LONG}\n{LONG} too" if kept else LONG)


def test_very_deep_pages_take_time_in_proportion():
    start = time.perf_counter()
    text = main_text(f"<div>{LONG}" * 40_000)
    assert time.perf_counter() - start < 20
    assert len(text) > 0


def test_extract(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "x"), (1, "u", f"<article><p>{LONG}</p></article>", "x"), (None, None, None, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, LONG, len(LONG)), (1, LONG, len(LONG))]
    assert extract(pages.limit(0)).count() == 0
