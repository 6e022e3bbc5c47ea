import html
import random
import re
import time

import pytest

from linewise.llm.maintext import Page, extract_text, main_text

WORDS = "stone river under light paper seven window after green morning".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def page(rng, article, wrap):
    """A page with everything that is not the article around ``article`` (markup) in ``wrap``."""
    link = lambda: f'<a href="/{rng.random()}">{rng.choice(WORDS)}</a>'
    junk = [
        f"<header class=top><h2>{sentence(rng, 3)}</h2></header>", f"<nav><ul>{''.join(f'<li>{link()}' for _ in range(6))}</ul></nav>",
        f'<div class="cookie-notice" role=alert>{sentence(rng, 12)}</div>', f"<aside><p>{sentence(rng, 25)}</p></aside>", f'<div id="leftSidebar">{sentence(rng, 20)}</div>',
        f'<div class="ad banner">{sentence(rng, 9)}</div>', f"<form><label>{sentence(rng, 4)}</label><input><button>Send</button></form>",
        "<script>if (a < b && '</p>') { document.write('<p>not text</p>') }</script>", "<style>p > b { color: red }</style>", f"<noscript>{sentence(rng, 9)}</noscript>",
        f'<div style="display: none">{sentence(rng, 30)}</div>', f"<ul>{''.join(f'<li>{link()}</li>' for _ in range(8))}</ul>", f"<!-- <article>{sentence(rng, 30)}</article> -->",
    ]
    comments = f'<section class="comments"><h3>Comments</h3>{"".join(f"<article class=comment><p>{sentence(rng, 40)}</p></article>" for _ in range(12))}</section>'
    rng.shuffle(junk)
    at = rng.randint(0, len(junk))
    body = "".join(junk[:at]) + wrap.format(article) + comments + "".join(junk[at:]) + f"<footer>&copy; {sentence(rng, 30)}</footer>"
    return f"<!DOCTYPE html><html><head><title>{sentence(rng, 4)}</title></head><body class='has-sidebar'>{body}</body></html>"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><div>{}</div></main>", '<div class="post-content with-ads">{}</div>', "<table><tr><td>{}</td></tr></table>"])
def test_articles_in_pages_full_of_other_things(wrap):
    rng = random.Random(len(wrap))
    for _ in range(40):
        texts = [sentence(rng, rng.randint(25, 60)) for _ in range(rng.randint(2, 9))]
        body = "".join(f"<p>{t.replace('river', '<b>ri</b>ver').replace('seven', 'sev&#101;n')}" + rng.choice(("", "</p>")) for t in texts)
        assert main_text(page(rng, body, wrap)) == " ".join(texts)


def test_sections_without_marks_stay_together():
    rng = random.Random(3)
    for _ in range(30):
        texts = [[sentence(rng, rng.randint(30, 50)) for _ in range(rng.randint(2, 5))] for _ in range(3)]
        body = "".join(f"<section>{''.join(f'<p>{t}</p>' for t in some)}</section>" for some in texts)
        assert main_text(page(rng, body, "<div>{}</div>")) == " ".join(t for some in texts for t in some)


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), (" \n ", ""), ("plain words", "plain words"), ("<p>", ""), ("<p>a<p>b", "a b"), ("a<br>b<i>c</i>d", "a bcd"), ("1 < 2 &amp; 3 > 2", "1 < 2 & 3 > 2"),
    ("<p>a &lt;b&gt; &eacute;&nbsp;&#x263A; &am x</p>", "a <b> é ☺ &am x"), ("<p title='a > b'>x</p>", "x"), ("<p>x</p><!-- never closed <p>y</p>", "x"), ("<p>x</p><script>y", "x"),
    ("<p>x</p><a href='", "x"), ("<div hidden>x</div><p title='hidden class'>y", "y"), ("<p>x</i></div></p>y", "x y"), ("<nav><p>x</p></nav>", ""),
    ("<header><h1>x</h1></header><article><header><h1>y</h1></header>z</article>", "y z"), ("<ul><li>x<li>y</ul>", "x y"),
])
def test_small_pages(source, text):
    assert main_text(source) == text


def test_tree_of_broken_markup():
    tree = Page("<body><p><b>one<p>two</b><ul><li>a<li>b<ul><li>c</ul><li>d</ul></body>")
    assert [(tree.tags[p], t) for p, t in zip(tree.parents[1:], tree.tags[1:])] == [
        ("html", "body"), ("body", "p"), ("p", "b"), ("body", "p"), ("body", "ul"), ("ul", "li"), ("ul", "li"), ("li", "ul"), ("ul", "li"), ("ul", "li")
    ]


@pytest.mark.parametrize("unit", ["<div>", "<b>", "<a <", "<!--", "</b><b>x", "<p>x", "<a b=\"", "<script>", "&", "<td>x<table>", "<li>x<ul>", "x</p>", "<div class=comment>x"])
def test_time_grows_with_the_page(unit):
    def seconds(n):
        began = time.process_time()
        main_text(unit * n + "<p>end of it</p>")
        return time.process_time() - began

    seconds(100)
    assert seconds(60_000) < 12 * seconds(15_000) + 0.5


def test_whole_table_and_other_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in extract_text(pages).collect()}
    for r in pages.collect():
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", re.search("<article>(.*)</article>", r.html, re.S)[1])).split())
        assert got[r.page_id] == (want, len(want))
    rows = [(1, None, None, "t"), (1, "u", "<p>\U0001f600 x", "t"), (None, "u", "", "t")]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(map(tuple, extract_text(odd).collect()), key=str) == [(1, "u", "\U0001f600 x", 3), (1, None, "", 0), (None, "u", "", 0)]
    assert extract_text(odd.limit(0)).count() == 0
