"""Which links a crawl may follow: an ordered cascade of rules, the first that fits gives the reason for denial."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import urls as U

#: Schemes that are no web page, and hosts of social media or mail (matched anywhere in the URL).
NON_WEB = ("mailto:", "tel:", "telnet:", "ftp:", "ftps:", "ssh:", "file:")
SOCIAL = ("facebook.com", "twitter.com", "linkedin.com", "instagram.com", "pinterest.com", "github.com", "calendly.com", "discord.gg", "discord.com")
#: What a denial code says.
REASONS = {
    "URL_PARSE_ERROR": "The URL could not be parsed",
    "NON_WEB_PROTOCOL": "The URL does not lead to a web page",
    "DEPTH_LIMIT": "The URL lies deeper than the crawl's limit",
    "FILE_TYPE": "The URL leads to a file",
    "SECTION_LINK": "The URL is a section of a page",
    "BACKWARD_CRAWLING": "The URL lies outside the start URL's path",
    "EXCLUDE_PATTERN": "The URL matches an exclude pattern",
    "INCLUDE_PATTERN": "The URL matches no include pattern",
    "ROBOTS_TXT": "The site's robots.txt does not allow the URL",
    "SOCIAL_MEDIA": "The URL leads to social media or mail",
    "EXTERNAL_LINK": "The URL leads to another site",
}


@dataclass(frozen=True)
class Scope:
    base_url: str
    initial_url: str
    max_depth: int = 10
    includes: tuple[str, ...] = ()
    excludes: tuple[str, ...] = ()
    regex_on_full_url: bool = False
    allow_backward: bool = False
    allow_external: bool = False
    allow_subdomains: bool = False
    disallowed: tuple[str, ...] = field(default=())  # path prefixes that robots.txt denies


def valid_patterns(patterns: tuple[str, ...]) -> list[str]:
    """Patterns that compile; the others are dropped."""
    out = []
    for p in patterns:
        try:
            re.compile(p)
            out.append(p)
        except re.error:
            pass
    return out


def invalid_patterns(patterns: tuple[str, ...]) -> list[str]:
    """For interfaces that reject a request instead."""
    return [p for p in patterns if p not in valid_patterns(patterns)]


def any_match(target: Column, patterns: list[str]) -> Column:
    return F.lit(False) if not patterns else target.rlike("|".join(f"(?:{p})" for p in patterns))


def is_section(url: Column) -> Column:
    """A fragment that is no client-side route."""
    part = F.get(F.split(url, "#"), F.lit(1))
    return F.contains(url, F.lit("#")) & ~((F.length(part) > 1) & F.contains(part, F.lit("/")))


def denial_reason(url: Column, p: Column, h: Column, scope: Scope) -> Column:
    """Of a resolved URL with its path and host; null if it may be followed."""
    base, first = F.lit(scope.base_url), F.lit(scope.initial_url)
    web = url.rlike("^https?://")
    internal = F.regexp_replace(h, r"^(www\.)+", "") == F.regexp_replace(U.host(base), r"^(www\.)+", "")
    initial_internal = F.regexp_replace(U.host(first), r"^(www\.)+", "") == F.regexp_replace(U.host(base), r"^(www\.)+", "")
    section = is_section(url)
    target = url if scope.regex_on_full_url else p
    includes, excludes = valid_patterns(scope.includes), valid_patterns(scope.excludes)
    outside = ~any_match(target, includes) if includes else F.lit(False)
    denied = F.lit(False)
    for prefix in scope.disallowed:
        denied = denied | F.startswith(p, F.lit(prefix))
    social = any_match(url, [re.escape(s) for s in SOCIAL])
    inside = (
        F.when(section, "SECTION_LINK").when(~F.lit(scope.allow_backward) & ~F.startswith(p, U.path(first)), "BACKWARD_CRAWLING")
        .when(any_match(target, excludes), "EXCLUDE_PATTERN").when(outside, "INCLUDE_PATTERN").when(denied, "ROBOTS_TXT")
    )
    content = F.lit(scope.allow_external) & initial_internal & (F.size(F.filter(F.split(p, "/"), lambda s: s != "")) > 0)
    related = F.lit(scope.allow_subdomains) & (U.registrable(h) == U.registrable(U.host(base)))
    beyond = (
        F.when(social, "SOCIAL_MEDIA").when(any_match(url, excludes), "EXCLUDE_PATTERN").when(content, None)
        .when(F.coalesce(related, F.lit(False)), F.when(outside, "INCLUDE_PATTERN")).otherwise("EXTERNAL_LINK")
    )
    return (
        F.when(url.rlike("^(" + "|".join(NON_WEB) + ")"), "NON_WEB_PROTOCOL").when(~web | (h == ""), "URL_PARSE_ERROR")
        .when(U.depth(p) > scope.max_depth, "DEPTH_LIMIT").when(U.is_file(p), "FILE_TYPE").when(internal, inside).otherwise(beyond)
    )


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that later filters and projections cannot inline, so it is computed once a row."""
    return df.withColumn(name, F.explode(F.array(value)))


def with_parts(df: DataFrame, url: Column) -> DataFrame:
    """df with __url, __path and __host."""
    return once(once(once(df, "__url", url), "__path", U.path(F.col("__url"))), "__host", U.host(F.col("__url")))


def filter_links(links: DataFrame, scope: Scope, link: str = "link", order: str | None = None, limit: int | None = None) -> DataFrame:
    """links with denial_reason; with a limit, rows after the limit-th accepted one in the given order are dropped."""
    out = with_parts(links, U.resolve(F.lit(scope.base_url), F.trim(F.col(link))))
    out = once(out, "denial_reason", denial_reason(F.col("__url"), F.col("__path"), F.col("__host"), scope)).drop("__url", "__path", "__host")
    if limit is None:
        return out
    # the cut is a place in the order, found from the accepted links alone
    last = out.where("denial_reason is null").orderBy(order).limit(limit).agg(F.max(order).alias("m"), F.count("*").alias("n")).first()
    return out if last.n < limit else out.where(F.col(order) <= F.lit(last.m))


def reason_text(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in REASONS.items():
        out = F.when(code == k, F.lit(v)).otherwise(out)
    return out


def blocked(url: Column, domains: tuple[str, ...], allow_keywords: tuple[str, ...] = (), unblocked: tuple[str, ...] = ()) -> Column:
    """Whether the URL's registrable domain is on the blocklist, lies under an entry, or bears the name of one under another suffix (names over two letters).

    Allow keywords win: plain text or `regex:` patterns whatever their case,
    `/pattern/flags` as written. A URL without a registrable domain is not blocked.
    """
    listed = [d for d in domains if d not in unblocked]
    own = U.registrable(U.host(F.trim(url)))
    name = F.substring_index(own, ".", 1)
    out = F.lit(False)
    for d in listed:
        twin = (F.length(name) > 2) & (F.lit(d.split(".")[0]) == name) & (own != d) if "." in d else F.lit(False)
        out = out | (own == d) | F.endswith(own, F.lit("." + d)) | twin
    allowed = F.lit(False)
    for k in (k.strip() for k in allow_keywords if k.strip()):
        if k.startswith("regex:"):
            pattern = k.removeprefix("regex:")
            allowed = allowed | (url.rlike("(?i)" + pattern) if valid_patterns((pattern,)) else F.lit(False))
        elif m := re.fullmatch(r"/(.+)/([dgimsuvy]*)", k):
            flags = "".join(f for f in m[2] if f in "ims")
            allowed = allowed | (url.rlike((f"(?{flags})" if flags else "") + m[1]) if valid_patterns((m[1],)) else F.lit(False))
        else:
            allowed = allowed | F.contains(F.lower(url), F.lit(k.lower()))
    return F.coalesce(out & ~allowed, F.lit(False))


def filter_url(links: DataFrame, scope: Scope, link: str = "link", page: str = "page") -> DataFrame:
    """links with allowed, url and denial_reason, for single URLs found on a page: no depth, file, include or backward rule.

    A link that does not start with http is taken relative to its page.
    """
    base = F.lit(scope.base_url)
    href = F.col(link)
    full = F.when(F.startswith(href, F.lit("http")), href).otherwise(U.resolve(F.col(page), href))
    out = with_parts(links, full)
    url, p, h = F.col("__url"), F.col("__path"), F.col("__host")

    def bare(x):
        return F.regexp_replace(x, r"^(www\.)+", "")

    internal, from_site = bare(h) == bare(U.host(base)), bare(U.host(F.col(page))) == bare(U.host(base))
    excludes = valid_patterns(scope.excludes)
    denied = F.lit(False)
    for prefix in scope.disallowed:
        denied = denied | F.startswith(p, F.lit(prefix))
    inside = F.when(is_section(url), "SECTION_LINK").when(any_match(p, excludes), "EXCLUDE_PATTERN").when(denied, "ROBOTS_TXT")
    content = from_site & F.lit(scope.allow_external) & (F.size(F.filter(F.split(p, "/"), lambda s: s != "")) > 0)
    related = F.lit(scope.allow_subdomains) & F.coalesce(U.registrable(h) == U.registrable(U.host(base)), F.lit(False))
    beyond = F.when(any_match(url, [re.escape(s) for s in SOCIAL]), "SOCIAL_MEDIA").when(any_match(url, excludes), "EXCLUDE_PATTERN").when(content | related, None).otherwise("EXTERNAL_LINK")
    scheme = F.when(url.isNull(), "URL_PARSE_ERROR").when(url.rlike("^(" + "|".join(NON_WEB) + ")"), "NON_WEB_PROTOCOL").when(~url.rlike("^https?://") | (h == ""), "URL_PARSE_ERROR")
    out = once(out, "denial_reason", F.coalesce(scheme, F.when(internal, inside).otherwise(beyond)))
    allowed = F.col("denial_reason").isNull()
    return out.withColumns({"allowed": allowed, "url": F.when(allowed, url)}).drop("__url", "__path", "__host")


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
