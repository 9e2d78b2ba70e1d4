"""Parts of an article whose names only sound like clutter stay; clutter in it goes."""

from __future__ import annotations

import re

import pytest

from reelspark.llm import html_extract

BLOCKS = [f"Block number {k} of the article goes on with some more words here." for k in range(7)]
PROSE = "The part in question holds a paragraph of prose like any other in it."


def page(name: str, tag: str = "div") -> str:
    inner = "".join(f"<p>{b}</p>" for b in BLOCKS[:4]) + f'<{tag} class="{name}"><p>{PROSE}</p></{tag}>' + "".join(f"<p>{b}</p>" for b in BLOCKS[4:])
    return f"<html><body><nav><a href=/>Home</a></nav><article>{inner}</article><footer><p>All rights</p></footer></body></html>"


@pytest.mark.parametrize(
    "name",
    ["article-header", "post-tags-intro", "search-results", "legal-analysis", "social-history", "menu-of-the-day", "replies-from-experts", "notice-of-award", "navigation-history", "key-banner",
     "commentary", "header-image-caption", "ad-hoc-committee", "comments-on-the-law", "related-work", "hidden-figures", "alert-level", "discussion-of-results"],
)
def test_prose_in_an_article_stays(name):
    want = "\n".join([*BLOCKS[:4], PROSE, *BLOCKS[4:]])
    for weights in (html_extract.Weights({}), html_extract.Weights({"@header": (0, 5000), "@social": (10, 9000), "p": (90_000, 3000)})):
        assert html_extract.main_text(page(name), weights) == want
        assert html_extract.main_text(page(name, "section"), weights) == want


@pytest.mark.parametrize("name", ["footer", "share", "related", "promo", "alert", "share-buttons", "related-posts", "ad-slot", "newsletter-signup", "comment-list", "social-share", "adContainer", "cookie-consent", "x sponsored"])
def test_clutter_in_an_article_goes(name):
    assert html_extract.main_text(page(name), html_extract.Weights({})) == "\n".join(BLOCKS)


def test_formulas_are_text():
    text = "<article><p>Energy is <math><mi>m</mi><mo>&middot;</mo><msup><mi>c</mi><mn>2</mn></msup></math> joules.</p><p>More <svg><text>axis</text></svg>of <object>fallback</object>it.</p></article>"
    assert html_extract.main_text(text, html_extract.Weights({})) == "Energy is m·c2 joules.\nMore of it."


def test_pages_do_not_need_their_marks(spark, data):
    """With the article tags taken from the pages the result is the same, on nearly all also with navigation and footers as plain parts with names."""
    rows = spark.read.parquet(f"{data}/pages.parquet").collect()
    weights = html_extract.fit(spark.read.parquet(f"{data}/pages.parquet"))
    same = named = 0
    for r in rows:
        want = html_extract.main_text(r["html"], weights)
        bare = re.sub(r"</?article\b[^>]*>", "", r["html"])
        same += html_extract.main_text(bare, weights) == want
        named += html_extract.main_text(re.sub(r"</(?:nav|footer)\b", "</div", re.sub(r"<(nav|footer)\b", r'<div class="site-\1"', bare)), weights) == want
    assert same == len(rows) and named >= 0.95 * len(rows)
