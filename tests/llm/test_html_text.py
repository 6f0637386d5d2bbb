from __future__ import annotations

import math
import random
import re
from html import unescape

import duckdb
import pytest
from llm.corpus import with_clashes
from pyspark.sql import functions as F

from salesloom.llm.html_text import blocks, content_paths, extracted, main_text, smoothed

PROSE = "The harbour was quiet, and the boats lay still. Nobody spoke; the lamps were out. "


def page(*parts):
    return f"<!DOCTYPE html><html><head><title>T, t.</title></head><body>{''.join(parts)}</body></html>"


ARTICLE = f"<article><h1>Head line</h1><p>{PROSE * 3}<p>{PROSE}<b>bold</b> and <a href=x>a link</a>.</article>"
WANTED = "\n".join(["Head line", (PROSE * 3).strip(), f"{PROSE}bold and a link."])


@pytest.mark.parametrize(
    "other",
    [
        "<nav><ul><li><a href=/a>Home</a><li><a>News</a></ul></nav>",
        f"<div class='ad banner'>{PROSE * 4}</div>",
        f"<aside><p>{PROSE * 4}</p></aside>",
        f"<section id=comments-12><p>{PROSE * 4}</p></section>",
        f"<form><p>{PROSE}</p><select><option>One, two.<option>Three.</select><button>Go</button></form>",
        f"<div role=dialog>{PROSE}</div><div style='display: none'>{PROSE}</div><div hidden>{PROSE}</div>",
        f"<header><p>{PROSE}</p></header><footer>&copy; 2024 {PROSE}</footer>",
        "<script>var a = '<p>Not, a. text</p>';</script><style>p{margin:0}</style><!-- <p>Nor, this. -->",
        "<div class=x><ul><li><a href=/1>First story</a></li><li><a href=/2>Second story</a></li></ul></div>",
        f"<div class='cookie-notice'>{PROSE * 5}</div>",
    ],
)
def test_parts_that_are_not_the_article_go(other):
    for html in (page(other, ARTICLE), page(ARTICLE, other), page(ARTICLE.replace("</article>", other + "</article>"))):
        assert main_text(html) == WANTED


def test_short_parts_of_the_article_stay():
    html = page("<nav>Menu</nav>", f"<article><h2>Head</h2><p>{PROSE * 4}</p><ul><li>One<li>Two</ul>"
                f"<blockquote>Said so</blockquote><table><tr><td>1<td>2</table><pre>code  x</pre></article>")
    assert main_text(html) == "\n".join(["Head", (PROSE * 4).strip(), "One", "Two", "Said so", "1", "2", "code x"])


def test_paths_decide_where_nothing_is_named():
    menu = "".join(f"<li>Item {i}</li>" for i in range(30))
    html = page(f"<div><div><ul>{menu}</ul></div></div>", f"<div><div><div>{f'<p>{PROSE * 2}</p>' * 5}</div></div></div>")
    assert main_text(html) == "\n".join([(PROSE * 2).strip()] * 5)
    paths, found = blocks(html)
    assert len(content_paths(paths, found)) == 1


def test_references_white_space_and_broken_markup():
    assert main_text("") == "" and main_text("plain &amp; simple") == "plain & simple"
    assert main_text("<p>a\n\t b&nbsp;&#233;&lt;i&gt;<br>c</p>") == "a b é<i> c"
    assert main_text("<p>cut of<b>f</p><p") == "cut off"
    assert main_text("<p title='a > b'>x</p><p title=\"no end>y") == "x\ny"
    assert main_text("a < b, and c > d. Fine &am") == "a < b, and c > d. Fine &am"
    for html in ("<" * 20_000, "<a " + '"' * 20_001, "<div>" * 3000 + "deep, down.", "</p>" * 5000, "<!--" * 5000):
        main_text(html)


def test_given_pages_have_their_article(spark):
    rows = duckdb.sql("SELECT page_id, html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall()
    want = {}
    for page_id, html in rows:
        article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", article)
        texts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        want[page_id] = "\n".join(t for t in texts if t)
    found = extracted(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    assert {r.page_id: r.text for r in found.collect()} == want
    assert found.where(F.length("text") != F.col("n_chars")).count() == 0


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, None, page(ARTICLE)), (3, "u", page(ARTICLE)), (3, "u", page(ARTICLE))]
    pages = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = sorted((r.page_id or 0, r.text, r.n_chars) for r in extracted(pages.withColumn("n_chars", F.lit(0))).collect())
    assert found == [(0, WANTED, len(WANTED)), (1, "", 0), (2, "", 0), *[(3, WANTED, len(WANTED))] * 2]
    assert extracted(pages.limit(0)).count() == 0


def test_smoothing_counts_all_pairs_of_paths():
    for seed in range(8):
        chance = random.Random(seed)
        html, open_ = "", []
        for i in range(600):
            if open_ and chance.random() < 0.45:
                html += f"</{open_.pop()}>"
            else:
                open_.append(chance.choice(["div", "section", "ul", "article"] if i % 9 == 0 else ["div", "section", "ul"]))
                html += f"<{open_[-1]} data-n={i} class=x{chr(97 + i % 26) * (1 + i // 26)}>" + "text, " * chance.randrange(4)
        paths, found = blocks(html)
        chars = {}
        for path, text, _ in found:
            chars[path] = chars.get(path, 0) + len(text)
        scores = {p: chance.random() * 9 for p in chars}
        assert len(chars) > 200
        for p, value in smoothed(paths, chars, scores).items():
            weights = {q: n * math.exp(-(paths.distance(p, q) ** 2) / 2) for q, n in chars.items()}
            want = sum(w * scores[q] for q, w in weights.items()) / sum(weights.values())
            assert value == pytest.approx(want, rel=1e-9)


def test_headings_of_a_long_page_stay():
    def glossary(n):
        names = [chr(97 + i % 26) * (1 + i // 26) for i in range(n)]
        return page("<div>", *[f"<div class={x}q><div><h2>x</h2><p>{PROSE * (1 + i % 3)}</p></div></div>" for i, x in enumerate(names)], "</div>")

    for n in (20, 600):
        assert main_text(glossary(n)).split("\n").count("x") == n


@pytest.mark.parametrize(
    "start",
    [
        "article aria-label='Hidden costs of war'", "p title='the hidden cost'", "div data-hidden=false",
        "section data-id=share-7", "div class='content no-sidebar'", "main class=with-sidebar",
        "div id=search-result", "article class='post notice-board tags'", "div aria-hidden=false", "figure title=role=menu",
    ],
)
def test_attributes_that_do_not_mark_an_element(start):
    assert main_text(page(f"<{start}>{PROSE * 3}</{start.split()[0]}>")) == (PROSE * 3).strip()


def test_captions_formulas_and_raw_text_that_is_shown():
    article = f"<article><p>{PROSE * 3}</p><figure><figcaption>{PROSE}</figcaption></figure>{{}}</article>"
    start = f"{(PROSE * 3).strip()}\n{PROSE.strip()}\n"
    for part, text in (
        ("<p>So <math><mi>a</mi><mo>=</mo><mn>2</mn></math>, then.</p>", "So a=2, then."),
        ("<xmp>One <b>two</b>, &amp; three.</xmp>", "One <b>two</b>, &amp; three."),
        ("<p>See <svg><style>a, b.</style><text x=1>one <tspan>label</tspan></text></svg>, then.</p>", "See one label , then."),
    ):
        assert main_text(page(article.format(part))) == start + text
    assert main_text(page(f"<article class=post hidden>{PROSE}</article>", f"<p>{PROSE}</p>")) == PROSE.strip()


BODY = f"<h1>Title of it</h1><p>{PROSE * 3}</p><p>{PROSE * 4}</p>"
LINES = ["Title of it", (PROSE * 3).strip(), (PROSE * 4).strip()]
MENU = "<nav><ul><li><a href=/1>Home page</a></li><li><a href=/2>All news</a></li></ul></nav>"
END = "<footer><p>&copy; 2024 The makers. All rights reserved.</p></footer>"


@pytest.mark.parametrize(
    "html",
    [
        f"<html><head><meta charset=utf-8><link rel=x><body>{MENU}<div>{BODY}</div>{END}</body></html>",
        f"<head><script>x()</script><div>{BODY}</div>{END}",
        f"<body><form action=/all>{MENU}<div>{BODY}</div>{END}</form></body>",
        f"<body><nav><ul><li><a href=/1>Home page</a></li></ul><main>{BODY}</main>{END}</body>",
        f"<body><nav><a href=/1>Home page</a><div>{BODY}</div></body>",
        f"<body>{MENU}<main role=form>{BODY}</main>{END}</body>",
        f"<body>{MENU}<div class=sidebar><div>{BODY}</div></div>{END}</body>",
        f"<body>{MENU}<article><header><h1>Title of it</h1></header>{BODY.partition('</h1>')[2]}</article>{END}</body>",
        f"<body>{MENU}<article><div class=article-header><h1>Title of it</h1></div>{BODY.partition('</h1>')[2]}</article></body>",
    ],
)
def test_names_do_not_cost_a_whole_page(html):
    assert main_text(html).split("\n") == LINES


def test_a_raw_element_without_its_end_goes_on_as_text():
    assert main_text(f"<body><select><option>One<div>{BODY}</div>").split("\n")[-2:] == LINES[1:]
    assert main_text(f"<body><div>{BODY}</div><script>var a = 'b, c. d';") == "\n".join(LINES)


def test_names_lower_a_score_and_do_not_decide_it():
    """Comments never become the article; a page without an article has none; the rest is a matter of ratios."""
    long_comments = f"<div class=comments>{f'<p>{PROSE * 5}</p>' * 30}</div>"
    assert main_text(page(f"<div>{BODY}</div>", long_comments)).split("\n") == LINES
    assert main_text(f"<body>{MENU}{END}</body>") == ""
    words = "<p>no marks here at all</p>"
    paths, found = blocks(page(f"<div><b>{words * 3}</b></div>", f"<div class=notice><p>{PROSE * 500}</p></div>", "<div>x</div>" * 3))
    assert len(content_paths(paths, found)) >= 1


def test_pages_without_an_article_element(spark):
    """The given pages with their article in a plain element keep the same text."""
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall()
    same = sum(
        main_text(re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", html)) == main_text(html) for (html,) in rows
    )
    assert same >= 0.9 * len(rows), same
