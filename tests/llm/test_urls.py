"""Aliases of urls: all links that a page states, and urls that are written differently."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import connect, differences  # noqa: E402
from placewell.llm import url_filters  # noqa: E402
from placewell.llm.queries import ORACLE  # noqa: E402
from placewell.llm.workers import importable  # noqa: E402

LINK = '<link rel="canonical" href="{}">'
PAGES = [
    (1, "http://a.org/x", LINK.format("HTTP://Example.NET:80/es/1")),
    (2, "http://b.org/y", "<!-- " + LINK.format("http://example.net/es/1") + " -->"),
    (3, "http://c.org/y", "<script>'" + LINK.format("http://example.net/es/1") + "'</script >" + LINK.format("http://c.org/z#t")),
    (4, "HTTP://C.org/z", LINK.format("http://free.org/") + LINK.format("https://E.net:443/fr/9")),
    (5, "http://www.example.com/en/1", LINK.format("http://g.org/")),
    (6, "http://g.org/", '<meta http-equiv=refresh content="0;url=http://example.com/en/7">'),
    (7, "http://h.org/", "<template>" + LINK.format("http://example.net/es/1")), (8, None, LINK.format("http://example.net/es/1")),
    (9, "", None), (10, "http://a.org/x#there", "canonical"), (10, "http://a.org/x#there", "canonical"), (None, "x", "refresh"),
]


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


def test_aliases(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumnRenamed("html", "judged_html")
    pages = pages.selectExpr("page_id", "url", "judged_html AS html", "1 AS judged", "2 AS node", "3 AS tainted")
    edges = url_filters.page_edges(pages)
    found = url_filters.judge_urls(pages, edges)
    assert found.columns == ["page_id", "url", "html", "node", "tainted", "judged"]
    verdicts = {(r.page_id, r.judged.verdict) for r in found.collect()}
    assert verdicts == {(1, "block"), (2, "allow"), (3, "block"), (4, "block"), (5, "allow"), (6, "allow"), (7, "allow"),
                        (8, "allow"), (9, "allow"), (10, "block"), (None, "allow")}
    assert found.count() == len(PAGES)
    assert url_filters.judge_urls(pages.limit(0), edges.limit(0)).count() == 0


def test_sql_finds_the_same(spark):
    con = connect("/root/testdata/sf0.001")
    con.execute("DROP VIEW pages")
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    found = url_filters.judge_urls(pages.select("page_id", "url"), url_filters.page_edges(pages)).select("page_id", "judged.*")
    assert differences(found, con, ORACLE["op9_url_filters"]) == []


def test_a_page_that_very_many_point_to(spark):
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('http://s', id, '.org/') AS url")
    edges = pages.selectExpr("url AS src", "'http://example.net/es/hot' AS dst")
    assert url_filters.judge_urls(pages, edges).where("judged.verdict = 'block'").count() == 3000
