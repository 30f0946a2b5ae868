"""Block rules of HTML extraction against pages without telling names and plain Python versions."""

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from pricetide.llm import html_text
from tests.llm.test_operators import FOLDER, database  # noqa: F401

GOOD = "It is the sort of text that a page has in the middle, and there is enough of it to be decided on its own."
OTHER = "Some of the people who read this will not agree with all that is said in it, but they may still be glad of it."
LINKS = "<div><a href=a>Start</a> <a href=b>Products and prices</a> <a href=c>About the people of the company</a></div>"
FAMILY = f"<p>{GOOD}</p><h2>Head</h2><p>{OTHER}</p>"
KEPT = f"{GOOD}\nHead\n{OTHER}"


@pytest.mark.parametrize(
    "page",
    [
        f'<body class="post has-sidebar">{FAMILY}</body>',
        f'<body><div id="content" class="layout-with-sidebar">{FAMILY}</div></body>',
        f'<body><article><section class="related-work">{FAMILY}</section></article></body>',
        f'<body><div class="sidebar">{FAMILY}</div></body>',  # the name is wrong: there is no other text
        f'<body><form id="whole-page">{LINKS}{FAMILY}</form></body>',
        f'<body>{LINKS}<div>{FAMILY}</div>{LINKS}</body>',
        f'<body><table><tr><td>{LINKS}</td><td>{FAMILY}</td></tr></table></body>',
        f'<body><article>{FAMILY}</article><div class="comment-list"><article class="comment"><p>{GOOD}</p></article></div></body>',
        f'<body><div class="ad">Buy it now, it is the best of all.<article>{FAMILY}</article></body>',
        f'<body><main>{FAMILY}</main><section class="comments"><article><p>{OTHER}</p></article></section></body>',
    ],
)
def test_rules_decide(page):
    assert html_text.main_text(page)[0] == KEPT


def test_paragraph_of_links_in_article():
    page = f'<article><p>{GOOD}</p><p><a href=x>The whole of this paragraph is a link to another page of the site</a>.</p><p>{OTHER}</p></article>'
    assert html_text.main_text(page)[0].split("\n")[1].startswith("The whole of this") and html_text.main_text(page)[2] == 3


def test_telling_names():
    for name in ("ad", "ad-slot", "AdBox", "comment-list", "commentList", "cookie-notice", "site-footer", "nav_links", "share-buttons", "related-posts"):
        assert html_text._tells(name), name
    for name in ("has-sidebar", "layout-with-sidebar", "no-ads", "related-work", "header", "shadow", "content", "cookie-recipes", "reader", ""):
        assert not html_text._tells(name), name


def plain_labels(blocks):
    """Labels by looking at every other block for each open one."""
    first = [html_text.first_pass(b) for b in blocks]
    if "good" not in first and all(b.place != "good" for b in blocks):
        for i, b in enumerate(blocks):
            if b.place == "doubtful":
                first[i] = html_text.first_pass(html_text.Block(b.text, b.linked, b.tag, b.container, ""))
    out = []
    for i, b in enumerate(blocks):
        article = b.place == "good"
        if first[i]:
            out.append(first[i])
            continue
        decided = [j for j in range(len(blocks)) if first[j]]
        near = [j for j in decided if blocks[j].container == b.container]
        if article and not near:
            out.append("good")
            continue
        near = near or decided
        left, right = [j for j in near if j < i], [j for j in near if j > i]
        if not near:
            out.append("bad")
        elif not left or not right:
            out.append(first[left[-1] if left else right[0]])
        elif first[left[-1]] == first[right[0]]:
            out.append(first[right[0]])
        elif article and b.tag in html_text.PROSE:
            out.append("good")
        elif b.tag in html_text.HEADINGS or right[0] - i < i - left[-1]:
            out.append(first[right[0]])
        else:
            out.append(first[left[-1]])
    return out


def test_labels_against_plain_python():
    dice = random.Random(7)
    texts = ["Short.", "Few words stand here", GOOD, GOOD * 3, "Xylo quartz brimstone " * 5, "Xylo quartz brimstone " * 12]
    for _ in range(3000):
        places = dice.choice([["", "bad"], ["", "doubtful"], ["doubtful", "bad"], ["", "bad", "good", "doubtful"], ["good", "bad"]])
        made = []
        for _ in range(dice.randrange(12)):
            text = dice.choice(texts)
            linked = dice.choice([0, 0, len(text) // 3, len(text)])
            made.append(html_text.Block(text, linked, dice.choice(["", "p", "h2", "li"]), dice.randrange(3), dice.choice(places)))
        expected = plain_labels([html_text.Block(b.text, b.linked, b.tag, b.container, b.place) for b in made])
        html_text.label(made)
        assert [b.label for b in made] == expected


def article(page):
    """Text of the article by cutting the page at its tags."""
    body = re.split(r"</article>|<footer", page.split("<article>", 1)[1], maxsplit=1)[0]
    body = re.sub(r"<!--.*?(-->|$)|<(script|style).*?(</\2>|$)", "", body, flags=re.S)
    parts = re.split(r"</?(?:h[1-6]|p|ul|ol|li|div|table|tr|td|blockquote)\b[^>]*>", body)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br[^>]*>", " ", p))).split()) for p in parts]
    return "\n".join(p for p in parts if p)


def test_query_against_cut_pages(spark, database):
    rows = html_text.op8_html_extraction(spark, FOLDER).collect()
    pages = dict(database.execute("SELECT page_id, html FROM pages").fetchall())
    assert {r.page_id: r.text for r in rows} == {i: article(h) for i, h in pages.items()}


def test_nesting_costs_no_more_than_length():
    n = 40000
    for page in ("<div>" * n + "</section></span>" * n, "<div><article>" * n + "</section>" * n, "<p>a" * n, "<a href='" * n):
        start = time.perf_counter()
        html_text.main_text(page)
        assert time.perf_counter() - start < 20


def test_awkward_tables(spark):
    made = [(1, "u", FAMILY), (1, "u", FAMILY), (2, None, None), (None, "v", ""), (3, "w", f"<p>{GOOD}</p>" * 3000)]
    pages = spark.createDataFrame(made, "page_id bigint, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1))
    rows = html_text.extract(pages).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in rows) == sorted((str(i), len(html_text.main_text(h)[0])) for i, _, h in made)
    assert html_text.extract(pages.limit(0)).count() == 0
