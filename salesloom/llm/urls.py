"""URL filters that follow redirects.

Rules decide by host and path. Pages reach other addresses by redirects, canonical links and
tracking parameters; addresses tied like this are one component, found with distributed connected
components, and an explicit decision on one of them holds for all that have none. An explicit allow
comes before a block.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import scratch
from salesloom.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that tell where a reader comes from, not what the page is.
TRACKING = r"(?:utm_[^=&]*|ref|gclid|fbclid)(?:=[^&]*)?"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """Host, path and query of a URL: what is left without scheme and fragment; null without host."""
    # Atomic and possessive: a long address without a query is read once.
    query = F.regexp_extract(url, r"^(?>(?s:.*?)://)[^?#]*+(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), query))


def plain_address(node: Column) -> Column:
    """An address without tracking parameters."""
    head = F.regexp_extract(node, r"^[^?]*", 0)
    query = F.regexp_replace(F.regexp_extract(node, r"\?(.*)$", 1), rf"(?<=^|&){TRACKING}(?=&|$)", "")
    query = F.regexp_replace(F.regexp_replace(query, r"&{2,}", "&"), r"^&|&$", "")
    return F.when(query == "", head).otherwise(F.concat(head, F.lit("?"), query))


def page_links(url: Column, html: Column) -> Column:
    """Addresses that a page names as its own: canonical links and redirects by refresh.

    A comment, script or tag that nothing closes reaches to the page's end.
    """
    shown = F.regexp_replace(html, r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)", "")
    tags = F.regexp_extract_all(shown, F.lit(r"(?is)<(?:link|meta)\b[^>]*(?:>|\z)"), F.lit(0))

    def target(tag: Column) -> Column:
        canonical = tag.rlike(r"(?is)\brel\s*=\s*[\"']?[^\"'=>]*\bcanonical\b")
        refresh = tag.rlike(r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b")
        href = F.regexp_extract(tag, r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", 0)
        href = F.regexp_replace(href, r"(?is)^href\s*=\s*[\"']?|[\"']$", "")
        move = F.regexp_extract(tag, r"(?is)\burl\s*=\s*['\"]?([^\"'>]*)", 1)
        link = F.trim(F.replace(F.when(canonical, href).when(refresh, move), F.lit("&amp;"), F.lit("&")))
        folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
        full = (
            F.when(link.contains("://"), link)
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("/"), F.concat(F.lit("http://"), host_of(url), link))
            .when(link != "", F.concat(F.lit("http://"), host_of(url), F.coalesce(F.nullif(folder, F.lit("")), F.lit("/")), link))
        )
        return address(full)

    return F.filter(F.transform(tags, target), lambda a: a.isNotNull())


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, verdict)`` for the distinct places that a rule fits.

    A rule fits its host and all subdomains where the path starts with the rule's. The longest rule
    wins; of equally long ones an allow, then the first by name. Hosts meet rules by equality with
    one of the host's suffixes, of which as many are built as the longest rule's host has labels.
    """

    def labels(host: str) -> Column:
        return F.size(F.split(host, r"\."))

    most = rules.agg(F.max(labels("host"))).first()[0] or 1
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(labels("host"), F.lit(most))),
        lambda i: F.call_function("substring_index", "host", F.lit("."), -i),
    )
    asked = places.select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("suffix"))
    listed = rules.select(
        F.col("host").alias("suffix"), F.col("path").alias("start"), (F.col("verdict") == "allow").alias("allow")
    )
    rule = F.concat("suffix", "start")
    fits = asked.join(listed, "suffix").where(F.startswith("path", "start"))
    best = F.min(F.struct((-F.length(rule)).alias("l"), (~F.col("allow")).alias("block"), rule.alias("rule")))
    found = fits.groupBy("host", "path").agg(best.alias("best"))
    return found.select(
        "host", "path", "best.rule", F.when(F.col("best.block"), "block").otherwise("allow").alias("verdict")
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    links: DataFrame | None = None,
    default: str = "allow",
) -> DataFrame:
    """``(id_col, host, path, rule, verdict)`` for every row of ``pages``.

    ``rules(host, path, verdict)`` with verdict allow or block. ``links(source, target)`` are further
    redirects between URLs. A row that no rule fits gets its component's decision: allow if any
    address in it is allowed by a rule, else block if any is blocked, else ``default``. A URL that is
    null or has no ``://`` has an empty host and path and no aliases. Null html has no links.
    Repeated rows stay, other columns are left out.
    """
    url = F.col(url_col)
    seen = pages.select(
        F.col(id_col).alias("id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        address(url).alias("node"),
        F.coalesce(page_links(url, F.col(html_col)), F.array().cast("array<string>")).alias("targets"),
    )
    seen = scratch.materialize(seen, "addresses")
    edges = seen.select(F.col("node").alias("a"), F.explode("targets").alias("b"))
    if links is not None:
        edges = edges.union(links.select(address(F.col("source")), address(F.col("target"))))
    edges = edges.dropna()
    ends = seen.select("node").dropna().union(edges.select("b")).distinct()
    plain = ends.select(F.col("node").alias("a"), plain_address(F.col("node")).alias("b"))
    groups = connected_components(edges.union(plain))

    def place(node: str) -> list[Column]:
        # As a URL again, so that both are cut by one rule.
        whole = F.concat(F.lit("://"), F.col(node))
        return [host_of(whole).alias("host"), path_of(whole).alias("path")]

    members = groups.select("node", "component", *place("node"))
    ruled = scratch.materialize(
        match_rules(seen.select("host", "path").union(members.select("host", "path")), rules), "ruled"
    )
    decided = (
        members.join(ruled, ["host", "path"])
        .groupBy("component")
        .agg(F.max(F.col("verdict") == "allow").alias("allow"))
        .select("component", F.when(F.col("allow"), "allow").otherwise("block").alias("passed_on"))
    )
    aliases = groups.join(decided, "component").select("node", "passed_on")
    return (
        seen.drop("targets")
        .join(ruled, ["host", "path"], "left")
        .join(aliases, "node", "left")
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            "rule",
            F.coalesce("verdict", "passed_on", F.lit(default)).alias("verdict"),
        )
    )
