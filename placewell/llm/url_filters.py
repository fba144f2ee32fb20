"""URL filters with redirect equivalence.

Rules name a host and a path prefix. Urls that a redirect or a canonical link ties
together are aliases: the components of these edges are found by distributed joins, and a
url without a rule of its own takes the decision of its aliases, an explicit allow before
a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewell.llm.components import components

# Action, host, path prefix.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MOST_RULES = 2000  # rules are a list that the driver holds; each is tried on each url
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"^[\s\S]*?://([^/?#]*)([^?#]*)"

LINK = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
# Comments, and elements whose content is no markup; one that is left open ends with the page.
UNSEEN = r"(?i)<!--[\s\S]*?(?:-->|$)|<(?:script|style|template|noscript|textarea)\b[\s\S]*?(?:</(?:script|style|template|noscript|textarea)\s*>|$)"
SITE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
USUAL_PORT = r"^(http://[^:]*):80$|^(https://[^:]*):443$"
TARGET = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def matching_rule(host_: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of size, rank (1: allow), action and rule; else null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    found = [
        F.when(((host_ == F.lit(h)) | F.endswith(host_, F.lit("." + h))) & F.startswith(path, F.lit(p)),
               F.struct(F.lit(len(h + p)).alias("size"), F.lit(int(action == "allow")).alias("rank"),
                        F.lit(action).alias("action"), F.lit(h + p).alias("rule")))
        for action, h, p in rules]
    none = F.lit(None).cast("struct<size:int,rank:int,action:string,rule:string>")
    return F.greatest(none, none, *found)


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"#[\s\S]*$", "")


def place(url: Column) -> Column:
    """The url by which aliases meet: no fragment, scheme and host in lower case, no usual port."""
    site = F.regexp_extract(url, SITE, 0)
    plain = F.regexp_replace(F.translate(site, UPPER, LOWER), USUAL_PORT, "$1$2")
    return F.concat(plain, F.substring(without_fragment(url), F.length(site) + 1, F.length(url)))


def resolved(target: Column, page: Column) -> Column:
    """An absolute url from a link on a page; null where it names no page."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme, site = F.regexp_extract(page, r"^([^:/?#]+:)//", 1), F.regexp_extract(page, r"^([^:/?#]+://[^/?#]*)", 1)
    folder = F.regexp_extract(page, r"^([^:/?#]+://[^/?#]*[^?#]*/)", 1)
    return without_fragment(
        F.when(target == "", None)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|[?#])"), None)
        .when(folder != "", F.concat(folder, target))
        .otherwise(F.concat(site, F.lit("/"), target)))


def page_edges(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """src, dst: redirects by refresh and canonical links that the pages state, as absolute urls.

    All of a page's count but those in comments and in elements that hold no markup. Pages
    with a null url or html state none.
    """
    page, source = F.col(url_column), F.col(html_column)
    seen = F.regexp_replace(source, UNSEEN, " ")

    def targets(element: str, target: str) -> Column:
        return F.transform(F.regexp_extract_all(seen, F.lit(element), F.lit(0)), lambda x: F.regexp_extract(x, target, 1))

    stated = pages.where(source.ilike("%canonical%") | source.ilike("%refresh%")).select(
        page.alias("page"), F.explode(F.array_distinct(
            F.concat(targets(LINK, HREF), targets(REFRESH, TARGET)))).alias("target"))
    return stated.select(place(F.col("page")).alias("src"), place(resolved(F.col("target"), F.col("page"))).alias("dst")).where(
        "dst IS NOT NULL AND dst <> src")


def judge_urls(
    pages: DataFrame, edges: DataFrame | None = None, rules=RULES, url_column: str = "url"
) -> DataFrame:
    """``pages`` with a struct ``judged``: host, path, rule and verdict.

    ``edges`` (src, dst) are redirects and canonical links between absolute urls; urls that
    differ in fragment, in the case of scheme or host, or by a usual port are one. A rule fits its host and all subdomains if the path starts with the
    rule's; the longest wins, of equally long ones an allow. A url without a rule is
    blocked if an alias is blocked and none is explicitly allowed; else it is allowed.
    Null urls and urls without ``://`` have an empty host and path, no rule, and are
    allowed. Repeated rows are judged alike. Every column of ``pages`` is returned,
    whatever its name; a column named ``judged`` is replaced. No rows give no rows.
    """
    row = pages.drop("judged")
    url = F.col(url_column)
    packed = row.select(
        F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in row.columns]).alias("row"),
        place(url).alias("node"), host(url).alias("host"), url_path(url).alias("path"),
    ).withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    if edges is not None:
        found = components(edges.select(place(F.col("src")).alias("src"), place(F.col("dst")).alias("dst")))
        decided = found.withColumn(
            "action", matching_rule(host(F.col("node")), url_path(F.col("node")), rules)["action"])
        flags = decided.groupBy("component").agg(
            F.max(F.coalesce(F.col("action") == "allow", F.lit(False))).alias("allowed"),
            F.max(F.coalesce(F.col("action") == "block", F.lit(False))).alias("blocked"),
        ).where("blocked AND NOT allowed").select("component", F.lit(True).alias("tainted"))
        tainted = found.join(flags, "component").select("node", "tainted")
        packed = packed.join(tainted, "node", "left")
    else:
        packed = packed.withColumn("tainted", F.lit(None).cast("boolean"))
    verdict = F.coalesce(F.col("found.action"), F.when(F.col("tainted"), F.lit("block")), F.lit("allow"))
    return packed.select("row.*", F.struct(
        "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict")).alias("judged"))
