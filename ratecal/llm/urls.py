"""Block and allow rules for URLs, carried over redirects and canonical links.

A rule names a host and a path prefix; it fits the host and its subdomains. Pages that point to
each other by a redirect or a canonical link are one thing under several names: when a rule blocks
one name, the others that no rule of their own allows are blocked too.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecal.llm import components


def host(url) -> Column:
    """From after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_columns(host_column, path_column, rules) -> tuple[Column, Column]:
    """The longest fitting rule, as `host` + `path`, and its verdict; NULL if none fits.

    `rules` are (verdict, host, path). Of rules of the same text an `allow` wins.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2], r[0] == "allow")):
        fits = ((host_column == rule_host) | F.endswith(host_column, F.lit("." + rule_host))) & F.startswith(
            path_column, F.lit(rule_path)
        )
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _name(url) -> Column:
    """What identifies a page: its URL without the fragment, the host lower-cased."""
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    return F.concat(scheme, F.lit("://"), host(url), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1))


def _without_dots(url) -> Column:
    """An URL whose path has no `.` and `..` steps; others stay as they are, letter by letter."""
    origin, way = (F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)([^?#]*)", k) for k in (1, 2))
    steps = F.slice(F.split(way, "/"), 2, 1 << 30)
    start = F.array().cast("array<string>")
    kept = F.aggregate(
        steps, start,
        lambda held, step: F.when(step == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0))))
        .when(step == ".", held).otherwise(F.concat(held, F.array(step))),
    )
    # a last step of dots names a folder
    folder = F.when(way.rlike(r"/\.\.?$") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    whole = F.concat(origin, F.lit("/"), F.array_join(kept, "/"), folder, F.regexp_extract(url, r"(?s)^[^?#]*(.*)", 1))
    return F.when(way.rlike(r"/\.\.?(/|$)"), whole).otherwise(url)


def _absolute(base, link) -> Column:
    """A link as an URL, seen from the page `base`."""
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), link))
        .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
        .when(F.startswith(link, F.lit("?")), F.concat(F.regexp_extract(base, r"(?s)^([^?#]*)", 1), link))
        .when(F.length(link) > 0, F.concat(folder, link))
    )


# comments, and elements whose content is no markup; an unclosed one reaches to the end of the page
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title|template)\b.*?(?:</\1\s*>|\z)"


def links(pages: DataFrame) -> DataFrame:
    """(url, target) of each redirect (`meta http-equiv=refresh`) and canonical link of a page. Links in comments, scripts
    and their like are none. A relative one is seen from the page's first `base href`, if it has one."""
    text = F.col("html")
    tags = F.regexp_extract_all(F.regexp_replace(text, UNSEEN, " "), F.lit(r"(?is)(<(?:link|meta|base)\b[^>]*>)"), F.lit(1))
    # each step is kept apart from the next, which uses its result many times
    tagged = (
        pages.select("url", "html").filter(F.col("url").contains("://"))
        .filter(text.rlike(r"(?i)canonical|refresh")).select("url", F.explode(F.array(tags)).alias("tags"))
    )
    href = r"""(?is)\bhref\s*=\s*["']?\s*([^"'>\s]+)"""
    bases = F.filter("tags", lambda x: x.rlike(r"(?i)^<base\b") & x.rlike(href))
    seen_from = F.regexp_extract(F.coalesce(F.get(bases, F.lit(0)), F.lit("")), href, 1)
    tagged = tagged.select("url", seen_from.alias("base"), F.explode("tags").alias("tag"))
    tag = F.col("tag")
    refresh = F.regexp_extract(tag, r"""(?is)\bcontent\s*=\s*["']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*['"]?\s*([^"'>\s]+)""", 1)
    target = F.when(tag.rlike(r"""(?is)^<link\b.*\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""), F.regexp_extract(tag, href, 1)).when(
        tag.rlike(r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?refresh\b"""), refresh
    )
    # an attribute's character reference for the ampersand is the only one that URLs commonly hold
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    found = tagged.select("url", "base", F.explode(F.filter(F.array(target), lambda x: F.length(x) > 0)).alias("link"))
    base = F.when(F.length("base") > 0, _absolute(F.col("url"), F.col("base"))).otherwise(F.col("url"))
    found = found.select("url", "link", F.explode(F.array(base)).alias("base"))
    found = found.select("url", F.explode(F.array(_absolute(F.col("base"), F.col("link")))).alias("target"))
    return found.select("url", _without_dots(F.col("target")).alias("target")).distinct()


def judge(pages: DataFrame, rules, more_links: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of `pages` (page_id, url, html).

    A page with a fitting rule has that rule's verdict. Another is blocked if the component of its
    URL over redirects and canonical links (those in `html`, and rows url, target of `more_links`,
    such as a crawler's log) holds an URL that a rule blocks; else it is allowed. A NULL URL, or one
    without `://`, has no host, no path and no aliases. Rows that share an URL share the verdict.
    """
    edges = links(pages)
    if more_links is not None:
        edges = edges.unionByName(more_links.select("url", "target").filter("url IS NOT NULL AND target IS NOT NULL"))
    named = edges.select(_name(F.col("url")).alias("x"), _name(F.col("target")).alias("y"))
    # one row per distinct link; the names of all their ends, for the rules
    named = named.distinct().withColumns({"a": F.xxhash64("x"), "b": F.xxhash64("y")})
    groups = components.components(named)
    ends = named.select(F.col("a").alias("node"), F.col("x").alias("url")).union(named.select("b", "y")).distinct()
    _, ruling = rule_columns(host(F.col("url")), path(F.col("url")), rules)
    barred = ends.filter(ruling == "block").join(groups, "node").select("component").distinct()
    barred = groups.join(barred, "component", "left_semi").select(F.col("node").alias("_node")).distinct()

    url = F.col("url")
    rows = pages.select("page_id", "url").withColumns({"host": host(url), "path": path(url)})
    rule, ruling = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_ruling": ruling})
    # only rows that neither a rule decides nor lack a name take part in the join: the others would share one key
    named = F.coalesce(F.col("_ruling").isNull() & url.contains("://"), F.lit(False))
    decided = rows.filter(~named).select("page_id", "host", "path", "rule", F.coalesce("_ruling", F.lit("allow")).alias("verdict"))
    asked = rows.filter(named).withColumn("_alias", F.xxhash64(_name(url)))
    asked = asked.join(barred.withColumn("_barred", F.lit(True)), F.col("_alias") == F.col("_node"), "left")
    verdict = F.when(F.col("_barred"), "block").otherwise("allow")
    return decided.union(asked.select("page_id", "host", "path", "rule", verdict.alias("verdict")))
