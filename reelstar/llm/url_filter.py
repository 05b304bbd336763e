"""URL filter: prefix rules by host and path, and their spread over aliases.

A rule fits a host and its subdomains when the path starts with the rule's; the
longest wins.  Pages that no rule fits get the verdict of their aliases: URLs
connected by canonical links, by redirects (``meta refresh``) and by forms of
one address (scheme, ``www.``/``m.``, fragment, tracking parameters, dot segments,
trailing slash or ``.html``).  Any other query is part of the address: ``/go?u=1``
and ``/go?u=2`` are two.  In a component an allow rule on any address wins over a block
rule; without either the page is allowed.

DataFrame operations only.  Rules are matched by joining every page's host
suffixes and the rules' path (a few rows per page against a rule table that may
be large); aliases are connected components over distinct URLs, so an address
repeated in a third of the rows is one node.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, settled
from .components import connected_components
from .line_dedup import lower_ascii

#: The contract's rules: verdict, host, path.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

_AFTER = r"(?s)^.*?://"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(F.instr(url, "://") > 0, F.regexp_replace(url, _AFTER, ""))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(rest_of(url), r"(?s)^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def query_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))


#: Parameters that name a campaign or a click, not a page.
TRACKING = r"^(utm(_[a-z]+)?|gclid|fbclid)(=|$)"


def without_dots(path: Column) -> Column:
    """``path`` with its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    whole = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), step)
    # a path that ends in a dot segment names a folder
    out = F.concat(F.array_join(whole, "/"), F.when(path.rlike(r"/\.\.?$"), "/").otherwise(""))
    return F.when(path.rlike(r"/\.\.?(/|$)"), out).otherwise(path)


def address(host: Column, path: Column, query: Column) -> Column:
    """The form that the spellings of one address share; null without a host."""
    plain = F.regexp_replace(F.regexp_replace(without_dots(path), r"(\.html?|/)$", ""), r"/(index)?$", "")
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), plain,
                                       F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


_CANONICAL = (r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)""")
_REFRESH = (r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*['"]?([^"'\s>]+)""")


def resolved(target: Column, host: Column, path: Column) -> Column:
    """A link target as a URL; relative ones against the page."""
    folder = F.regexp_replace(path, r"[^/]*$", "")
    base = F.concat(F.lit("x://"), host)
    return (
        F.when(target == "", None)
        .when(F.instr(target, "://") > 0, target)
        .when(target.startswith("//"), F.concat(F.lit("x:"), target))
        .when(target.startswith("/"), F.concat(base, target))
        .when(target.rlike(r"^[?#]"), F.concat(base, path, target))
        .when(~target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"),
              F.concat(base, F.when(folder == "", "/").otherwise(folder), target))
    )


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, said)`` of every distinct host and path of
    ``pages`` that a rule fits: the longest rule; of two with equal text the
    allowing one."""
    spots = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda k: F.concat_ws(".", F.slice(labels, k, F.size(labels))))
    near = spots.filter("host <> ''").withColumn("suffix", F.explode(suffixes))
    r = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), F.col("verdict").alias("said"))
    fits = near.join(r, "suffix").filter(F.col("path").startswith(F.col("prefix")))
    rule = F.concat("suffix", "prefix")
    return (
        fits.groupBy("host", "path")
        .agg(F.max(F.struct(F.length(rule).alias("n"), (F.col("said") == "allow").alias("a"),
                            rule.alias("rule"), F.col("said"))).alias("best"))
        .select("host", "path", "best.rule", "best.said")
    )


def url_filter(pages: DataFrame, rules: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
               html_col: str | None = "html", links: DataFrame | None = None) -> DataFrame:
    """``(id, host, path, rule, verdict, component)`` for every row of ``pages``.

    ``host``: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; ``path``: from there up to ``?``, ``#`` or the end; both empty
    for a null URL or one without ``://`` (no rule, no alias: allow).  ``rule``
    is the longest fitting rule, host and path joined, else null.
    ``component`` is the smallest address of the page's aliases (null without
    a host).

    Edges come from the pages' HTML (if ``html_col`` is given) and from
    ``links`` (columns ``from_url``, ``to_url``: redirects known from a crawl).
    ``rules`` has columns ``verdict`` (allow or block), ``host`` and ``path``.
    Repeated rows each keep their row; empty tables give empty tables; other
    columns are not read.
    """
    spark = pages.sparkSession
    rules = rule_table(spark) if rules is None else rules
    url = F.col(quoted(url_col))
    seen = pages.select(F.col(quoted(id_col)).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
                        query_of(url).alias("query"))
    ruled = settled(matched(seen, rules))

    def of_url(to: Column) -> Column:
        return address(host_of(to), path_of(to), query_of(to))

    found = []
    if html_col:
        at = pages.select(host_of(url).alias("host"), path_of(url).alias("path"), of_url(url).alias("a"),
                          F.col(quoted(html_col)).alias("html"))
        for mark, pattern in (("canonical", _CANONICAL), ("refresh", _REFRESH)):
            has = at.filter(F.lower("html").contains(mark))
            to = has.withColumn("target", F.explode(F.regexp_extract_all("html", F.lit(pattern), 1)))
            found.append(to.select("a", of_url(resolved(F.col("target"), F.col("host"), F.col("path"))).alias("b")))
    if links is not None:
        found.append(links.select(of_url(F.col("from_url")).alias("a"), of_url(F.col("to_url")).alias("b")))
    # Spellings of one address are one node already; edges join addresses.
    nothing = spark.createDataFrame([], "a string, b string")
    parts = connected_components(reduce(DataFrame.unionByName, found, nothing))

    spot = ["host", "path", "query"]
    spots = seen.select(*spot).distinct().withColumn("node", address(*map(F.col, spot)))
    judged = spots.join(ruled, ["host", "path"]).select("node", "said")
    of_part = (
        judged.join(parts, "node", "left")
        .groupBy(F.coalesce("component", "node").alias("component"))
        .agg(F.max(F.col("said") == "allow").alias("allowed"))
    )
    known = (
        spots.join(parts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(of_part, "component", "left")
        .join(ruled, ["host", "path"], "left")
        .select(*spot, "rule", "component",
                F.coalesce("said", F.when(F.col("allowed"), "allow").when(~F.col("allowed"), "block"),
                           F.lit("allow")).alias("verdict"))
    )
    out = seen.join(known, spot, "left")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", "verdict", "component")
