"""Extraction of articles whose own elements carry attributes, with and without end tags."""

import random

import pytest

from tripweave.llm import html_wrappers

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def made(rng, i):
    """(html of a page, its article's blocks): attributes on p, li, td and span, nested lists, some ends left out."""
    loose = rng.random() < 0.5
    end = lambda tag: "" if loose and rng.random() < 0.7 else f"</{tag}>"
    text = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 6))) + f" {rng.randint(0, 10 ** 6)}"
    plain = ["", " class='lead'", " id=x1", " data-hidden=no", " class=\"has-sidebar text\"", " title='hidden'"]
    away = [" class='notice'", " hidden", " class=advert", " style='display:none'", " id=cookie-bar", " aria-hidden=true"]
    blocks = []

    def inline():
        said = text()
        if rng.random() < 0.3:
            return f"{said} <span{rng.choice(away)}>gone <b>gone</b> <span>too</span></span>", said
        if rng.random() < 0.3:
            more = text()
            return f"{said} <span{rng.choice(plain)}>{more}</span>", f"{said} {more}"
        return said, said

    def item(tag):
        if rng.random() < 0.3:
            return f"<{tag}{rng.choice(away)}>{text()}{end(tag)}"
        shown, said = inline()
        blocks.append(said)
        inside = listed() if tag == "li" and rng.random() < 0.2 else ""
        return f"<{tag}{rng.choice(plain)}>{shown}{inside}{end(tag)}"

    def listed():
        return "<ul>" + "".join(item("li") for _ in range(rng.randint(1, 3))) + "</ul>"

    def table():
        return "<table>" + "".join(f"<tr>{''.join(item('td') for _ in range(2))}{end('tr')}" for _ in range(rng.randint(1, 2))) + "</table>"

    body = "".join(rng.choice([lambda: item("p"), lambda: item("p"), listed, table, lambda: f"<div>{item('p')}</div>"])() for _ in range(rng.randint(3, 8)))
    page = (f"<html><body><nav><ul><li class=menu>Home<li>More</ul></nav><p class=notice>Site note{end('p')}<main><article>{body}</article></main>"
            f"<section id=comments><p>nice {i}</section><footer><p>end</footer></body></html>")
    return page, blocks


def test_planted_pages_give_exactly_the_article():
    rng = random.Random(11)
    for i in range(400):
        page, blocks = made(rng, i)
        assert html_wrappers.article_text(page, None) == "\n".join(blocks), page


def test_planted_pages_through_spark(spark):
    rng = random.Random(12)
    pages = [(i, f"http://h{i % 9}.example/{i}", *made(rng, i)) for i in range(180)]
    frame = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_wrappers.extract_articles(frame).collect()}
    assert got == {i: "\n".join(blocks) for i, _, _, blocks in pages}


@pytest.mark.parametrize("page, want", [
    ('<article><h1>T</h1><p class="notice">Note</p><p>Body</p><p>More</p></article>', ["T", "Body", "More"]),
    ("<article><p hidden>x</p><p>Real</p></article>", ["Real"]),
    ("<article><p class=notice>Note<p>Body<p>More</article>", ["Body", "More"]),
    ("<article><ul><li class=share>S</li><li>a<ul><li>n<li hidden>h</ul></li><li>b</ul><p>t</article>", ["a", "n", "b", "t"]),
    ("<table><tr><td hidden>h<td>c<tr><td>d</table>e", ["c", "d", "e"]),
    ('<article><p>one <span class="advert">buy</span>two <span hidden>x <b>y</b></span>three <ins class=ads>ad</ins></p></article>', ["one two three"]),
    ('<article><p>one <span class="advert">buy</p><p>two</p></article>', ["one", "two"]),
    ("<article><span hidden><p>gone</p></span><p>here</p></article>", ["here"]),
    ("<dl><dt class=ad>a<dd>b<dt>c</dl>", ["b", "c"]),
    ("<p class=ad>x<div>y</div>", ["y"]),
    ("<article><p>a <span class='header'>b</span> <time class=date>c</time></article>", ["a b c"]),
])
def test_elements_end_where_html_ends_them(page, want):
    assert html_wrappers.article_text(page, None).split("\n") == want


def test_streams_are_alike_with_and_without_end_tags():
    one = "<ul><li>a</li><li class=x>b</li></ul><p>c</p><p>d</p><table><tr><td>e</td></tr><tr><td>f</td></tr></table>"
    two = "<ul><li>a<li class=x>b</ul><p>c<p>d<table><tr><td>e<tr><td>f</table>"
    assert html_wrappers.tokens(one) == html_wrappers.tokens(two)
