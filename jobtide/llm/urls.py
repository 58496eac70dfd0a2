"""URL filters over redirect equivalence, in DataFrame functions only.

A rule names a host (with its subdomains), the start of a path and a decision; the longest that
fits a URL decides.  Pages name other addresses of themselves by redirects and canonical links.
Addresses that hang together by these edges are one resource: a URL that no rule fits is blocked if
a rule blocks another address of its resource, unless a rule allows one of them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import lower_ascii, settle, workspace
from jobtide.llm.components import components

ALLOW, BLOCK = "allow", "block"
# (decision, host, path) as the query is asked with.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
_CANONICAL = r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_REFRESH = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
_TARGET = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""


def host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def address(url: Column) -> Column:
    """The URL without scheme and fragment; null if it has no ``://``."""
    place = F.when(path(url) == "", F.lit("/")).otherwise(path(url))
    whole = F.concat(host(url), place, F.regexp_extract(url, _URL, 3))
    return F.when(F.contains(url, F.lit("://")), whole)


def _suffixes(name: Column) -> Column:
    parts = F.split(name, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )


def ruled(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``places`` (distinct ``key, host, path``) that a rule fits, with ``rule`` and ``decision``.

    ``rules`` has ``decision, rule_host, rule_path``.  Of two rules of one length the allowing
    one wins, then the first by name.
    """
    tried = places.select("key", "path", F.explode(_suffixes(F.col("host"))).alias("rule_host"))
    fits = tried.join(rules, "rule_host").where(F.startswith(F.col("path"), F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = F.min(
        F.struct(
            (-F.length(rule)).alias("length"),
            (F.col("decision") != ALLOW).alias("blocks"),
            rule.alias("rule"),
            "decision",
        )
    )
    return fits.groupBy("key").agg(best.alias("b")).select("key", "b.rule", "b.decision")


def _resolved(base_url: Column, target: Column) -> Column:
    """The absolute form of a link of a page."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    folder = F.regexp_replace(path(base_url), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(F.lit("http://"), host(base_url), target))
        .when(
            F.startswith(target, F.lit("?")),
            F.concat(F.lit("http://"), host(base_url), path(base_url), target),
        )
        .otherwise(F.concat(F.lit("http://"), host(base_url), folder, target))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """``a``, ``b``: addresses that a page says are one, from ``url`` and ``html``."""
    html = F.col("html")
    marked = pages.where(html.rlike(r"(?i)canonical|http-equiv")).where(
        F.contains("url", F.lit("://"))
    )
    tags = marked.select(
        "url",
        F.explode(
            F.concat(
                F.transform(
                    F.regexp_extract_all("html", F.lit(_CANONICAL), F.lit(0)),
                    lambda tag: F.regexp_extract(tag, _HREF, 1),
                ),
                F.transform(
                    F.regexp_extract_all("html", F.lit(_REFRESH), F.lit(0)),
                    lambda tag: F.regexp_extract(tag, _TARGET, 1),
                ),
            )
        ).alias("target"),
    ).where("target <> ''")
    both = tags.select(
        address(F.col("url")).alias("a"), address(_resolved(F.col("url"), F.col("target"))).alias("b")
    )
    return both.where("a <> b").distinct()


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``pages`` needs ``page_id``, ``url`` and ``html``; ``rules`` are (decision, host, path).  A null
    URL or one without ``://`` has an empty host and path, no rule and no alias, and is allowed.
    A null text names no alias.  Repeated rows repeat; pages of one URL share its verdict.
    """
    spark = pages.sparkSession
    folder = workspace(spark)
    rules = spark.createDataFrame(list(rules), "decision string, rule_host string, rule_path string")
    pages = pages.select("page_id", "url", "html")
    edges = settle(alias_edges(pages), folder, "edges")
    linked = settle(components(edges, folder), folder, "linked")

    # Decisions on all addresses at once: those of pages, and those only linked to.
    whole = F.concat(F.lit("http://"), F.col("node"))
    places = pages.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    places = places.unionByName(
        linked.select(host(whole).alias("host"), path(whole).alias("path"))
    ).distinct()
    decided = settle(
        ruled(places.select(F.struct("host", "path").alias("key"), "host", "path"), rules).select(
            "key.host", "key.path", "rule", "decision"
        ),
        folder,
        "decided",
    )
    groups = (
        linked.select("label", host(whole).alias("host"), path(whole).alias("path"))
        .join(decided, ["host", "path"])
        .groupBy("label")
        .agg(F.bool_or(F.col("decision") == ALLOW).alias("allowed"))
    )
    spread = settle(
        linked.join(groups, "label").select(
            F.col("node").alias("address"),
            F.when(F.col("allowed"), ALLOW).otherwise(BLOCK).alias("spread"),
        ),
        folder,
        "spread",
    )
    url = F.col("url")
    seen = pages.select(
        "page_id", host(url).alias("host"), path(url).alias("path"), address(url).alias("address")
    )
    return (
        seen.join(decided, ["host", "path"], "left")
        .join(spread, "address", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("decision", "spread", F.lit(ALLOW)).alias("verdict"),
        )
    )
