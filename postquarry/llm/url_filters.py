"""URL filters: rules by host and path, carried over to aliases.

Pages that redirect to each other or name a canonical address are one group (connected components).
A page's own rule decides first. A page without one is allowed if a rule allows any alias, else
blocked if a rule blocks any alias, else allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postquarry.llm.common import components, lower_ascii

#: (verdict, host, path)
Rule = tuple[str, str, str]
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_TAGS = r"(?is)<(?:link|meta)\b[^>]*>"


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null. Rules come from the caller's list."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The last one put in front wins: the longest, of equals an allowing one.
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow")):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        best = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def resolved(target: Column, page: Column) -> Column:
    """A target as a full address, relative ones against the page's; other schemes and plain fragments give an empty text."""
    own = F.when(path_of(page) == "", F.lit("/")).otherwise(path_of(page))
    path, rest = F.regexp_extract(target, "(?s)^[^?#]*", 0), F.regexp_extract(target, "(?s)^[^?#]*(.*)$", 1)
    parts = F.split(F.when(path.startswith("/"), path).otherwise(F.concat(F.regexp_extract(own, "(?s)^.*/", 0), path)), "/")
    parts = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    folded = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"),
        lambda kept, part: F.when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(part == ".", kept).otherwise(F.concat(kept, F.array(part))),
    )
    host = F.concat(F.lit("http://"), host_of(page))
    return (
        F.when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike("^([A-Za-z][A-Za-z0-9+.-]*:|#)"), F.lit(""))
        .when(path == "", F.concat(host, own, rest))
        .otherwise(F.concat(host, F.lit("/"), F.array_join(folded, "/"), rest))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(u, v): a page's address and one that it redirects to or calls canonical, both normalised.

    An address is host, path and query; scheme and fragment do not count. Relative targets are
    resolved against the page's address. A refresh may leave out ``url=``.
    """
    page = F.col(url)
    tag = lambda t: F.when(
        t.rlike(r"(?is)^<link\b.*\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"),
        F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1),
    ).when(
        t.rlike(r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b"),
        F.coalesce(
            F.nullif(F.regexp_extract(t, r"(?is)\bcontent\s*=\s*[\"']?\s*[\d.]+\s*[;,]\s*(?:url\s*=\s*)?[\"']?([^\"'\s>]+)", 1), F.lit("")),
            F.regexp_extract(t, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1),
        ),
    )
    target = F.replace(F.col("target"), F.lit("&amp;"), F.lit("&"))
    return (
        pages.where(F.col(html).rlike("(?i)canonical|http-equiv")).select(
            url, F.explode(F.transform(F.regexp_extract_all(html, F.lit(_TAGS), F.lit(0)), tag)).alias("target")
        ).where("target <> ''")
        .select(address(page).alias("u"), address(resolved(target, page)).alias("v"))
        .where("u <> '' and v <> '' and u <> v")
    )


def address(url: Column) -> Column:
    path = path_of(url)
    return F.when(
        host_of(url) != "",
        F.concat(host_of(url), F.when(path == "", F.lit("/")).otherwise(path), F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit(""))),
    ).otherwise(F.lit(""))


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, alias (an address that decided for it, if any).

    Null addresses and such without ``://`` have empty host and path, no rule and no alias, and are
    allowed. Pages with the same address share their aliases; repeated rows stay. Null html has no links.
    """
    links = components(page_links(pages, url, html))
    ruled = links.select(
        "id", "component",
        fitting_rule(F.regexp_extract("id", "(?s)^[^/?#]*", 0), F.regexp_extract("id", "(?s)^[^/?#]*([^?#]*)", 1), rules).alias("r"),
    )
    groups = ruled.groupBy("component").agg(
        F.min(F.when(F.col("r.verdict") == "allow", F.col("id"))).alias("allows"),
        F.min(F.when(F.col("r.verdict") == "block", F.col("id"))).alias("blocks"),
    ).where("allows is not null or blocks is not null")
    said = links.join(groups, "component").select(
        F.col("id").alias("_at"), F.coalesce("allows", "blocks").alias("_alias"),
        F.when(F.col("allows").isNotNull(), "allow").otherwise("block").alias("_said"),
    )
    own = pages.select(
        F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        F.nullif(address(F.col(url)), F.lit("")).alias("_at"),
    ).withColumn("_own", fitting_rule(F.col("host"), F.col("path"), rules))
    return own.join(said, "_at", "left").select(
        key, "host", "path", F.col("_own.rule").alias("rule"),
        F.coalesce("_own.verdict", "_said", F.lit("allow")).alias("verdict"),
        F.when(F.col("_own").isNull(), F.col("_alias")).alias("alias"),
    )
