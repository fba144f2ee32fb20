"""Main text of pages: articles that names speak against, remarks, odd and deep pages."""

import os
import random
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from placewell.llm import html_text  # noqa: E402
from placewell.llm.workers import importable  # noqa: E402


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def sentences(rng, n):
    words = [f"w{k}ord" for k in range(300)]
    return [" ".join(rng.choices(words, k=rng.randint(12, 40))) + ", and so on." for _ in range(n)]


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


LINKS = "<ul>" + "".join(f"<li><a href=/x{k}>link {k}</a></li>" for k in range(6)) + "</ul>"


@pytest.mark.parametrize("wrapper", [
    '<div class="nav-open">', '<div class="sidebar-right layout">', '<div id="header-fixed">', '<div class="ad-free">',
    '<article class="post promo">', '<div class="comments-open">', '<main class="widget">',
])
@pytest.mark.parametrize("seed", range(3))
def test_a_name_does_not_lose_the_article(wrapper, seed):
    rng = random.Random(seed)
    texts = sentences(rng, rng.randint(2, 8))
    tag = wrapper[1:].split()[0]
    page = (f"<html><body><nav>{LINKS}</nav><div class='menu'>{LINKS}</div>{wrapper}{paragraphs(texts)}</{tag}>"
            f"<div class=sidebar><p>Short aside, here.</p></div><footer><p>Us, 2020.</p></footer></body></html>")
    assert html_text.main_text(page) == "\n".join(texts)


@pytest.mark.parametrize("remarks", [
    "<div class='comments'>{}</div>", "<section id=comments><h2>{n} replies</h2>{}</section>", "<ol class='comment-list'>{}</ol>",
    "<section><h2>{n} remarks</h2>{articles}</section>",
])
@pytest.mark.parametrize("seed", range(3))
def test_remarks_are_left_out(remarks, seed):
    rng = random.Random(seed)
    texts, other = sentences(rng, 6), sentences(rng, rng.randint(1, 12))
    inner = remarks.format(paragraphs(other), n=len(other), articles="".join(f"<article><p>{t}</p></article>" for t in other))
    for page in (f"<article><h1>Title of it</h1>{paragraphs(texts)}{inner}</article>",
                 f"<div class=ad></div><article><h1>Title of it</h1>{paragraphs(texts)}</article>{inner}"):
        if "{articles}" in remarks and not page.endswith("</article>"):
            continue  # articles beside the article are articles
        assert html_text.main_text(f"<body><header>{LINKS}</header>{page}</body>") == "\n".join(["Title of it", *texts])


def test_a_list_of_articles_is_kept():
    texts = sentences(random.Random(1), 4)
    page = "<article class=feed>" + "".join(f"<article><p>{t}</p></article>" for t in texts) + "</article>"
    assert html_text.main_text(page) == "\n".join(texts)


def test_deep_pages_take_time_in_proportion():
    def seconds(n):
        start = time.process_time()
        pages = ["<div>" * n + "some text, here</p></b>" * 20, "<p><table><tr><td>" + "<i>" * n + "</p>" * n,
                 "<li>" * n + "text", "<td>" * n + "text", "<table><tr>" * n + "<p>text", "<span>" * n + "</li>" * n + "text"]
        assert all(html_text.main_text(p) for p in pages[:1] + pages[2:])
        html_text.main_text(pages[1])
        return time.process_time() - start

    seconds(500)
    assert seconds(32_000) < 12 * max(seconds(8_000), 0.2)


def test_odd_pages_in_a_table(spark):
    text = sentences(random.Random(2), 3)
    rows = [(1, None, "u", 5), (1, "", "u", 5), (None, "<p", None, 5), (2, "plain, text  here", "u", 5),
            (3, f"<article>{paragraphs(text)}", "u", 5), (3, f"<article>{paragraphs(text)}", "u", 5),
            (4, "<p>" + "long, " * 300_000 + "</p>", "u", 5), (5, "<script>x</script><nav>a</nav>", "u", 5)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, n_chars int").repartition(2)
    found = sorted(((r.page_id, r.url, r.n_chars, r.text[:30]) for r in html_text.extract(pages).collect()), key=str)
    whole = "\n".join(text)
    assert found == sorted([
        (1, "u", 0, ""), (1, "u", 0, ""), (None, None, 0, ""), (2, "u", 16, "plain, text here"),
        (3, "u", len(whole), whole[:30]), (3, "u", len(whole), whole[:30]),
        (4, "u", 1_799_999, ("long, " * 6)[:30]), (5, "u", 0, "")], key=str)
    assert html_text.extract(pages.limit(0)).count() == 0
