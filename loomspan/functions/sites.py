"""Addresses and records of particular sites, result pages, PDF verdicts."""

from __future__ import annotations

from urllib.parse import parse_qs, unquote, urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspan.functions import html as H
from loomspan.functions import urls as U

#: Projects of the encyclopedia family, and paths of a social site that are no profiles.
WIKI_PROJECTS = ("wikipedia", "wiktionary", "wikibooks", "wikinews", "wikiquote", "wikisource", "wikiversity", "wikivoyage")
NO_PROFILE = ("home", "explore", "search", "settings", "messages", "notifications", "i", "intent", "share", "hashtag", "login", "signup", "tos", "privacy")


def wiki_article(url: Column) -> Column:
    """Struct of article, language and project; null for other addresses."""
    h = U.host(url)
    lang, project = F.regexp_extract(h, r"^([a-z-]+)\.(?:m\.)?([a-z]+)\.org$", 1), F.regexp_extract(h, r"^([a-z-]+)\.(?:m\.)?([a-z]+)\.org$", 2)
    name = F.regexp_extract(U.path(url), r"^/wiki/(.+)$", 1)
    ok = project.isin(*WIKI_PROJECTS) & (name != "") & ~lang.isin("www", "")
    return F.when(ok, F.struct(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("article"), lang.alias("language"), project.alias("project")))


def social_post(url: Column) -> Column:
    """Struct of kind (post or profile), user, id and normalised address; null for other addresses."""
    h = F.regexp_replace(U.host(url), r"^(www|mobile|m)\.", "")
    user, post = F.regexp_extract(U.path(url), r"^/([A-Za-z0-9_]{1,15})(?:/status(?:es)?/(\d+))?/?", 1), F.regexp_extract(U.path(url), r"^/[A-Za-z0-9_]{1,15}/status(?:es)?/(\d+)", 1)
    alone = U.path(url).rlike(r"^/[A-Za-z0-9_]{1,15}/?$")
    ok = h.isin("x.com", "twitter.com") & (user != "") & ~F.lower(user).isin(*NO_PROFILE) & ((post != "") | alone)
    kind = F.when(post != "", "post").otherwise("profile")
    form = F.concat(F.lit("https://x.com/"), user, F.when(post != "", F.concat(F.lit("/status/"), post)).otherwise(""))
    return F.when(ok, F.struct(kind.alias("kind"), user.alias("user"), F.nullif(post, F.lit("")).alias("id"), form.alias("url")))


def is_video_page(url: Column) -> Column:
    h = F.regexp_replace(U.host(url), r"^(www|m)\.", "")
    watch = (U.path(url) == "/watch") & U.query(url).rlike(r"[?&]v=[^&]+")
    return ((h == "youtube.com") & (watch | U.path(url).rlike("^/live/[^/]+"))) | ((h == "youtu.be") & (F.length(U.path(url)) > 1))


def video_markdown(title: Column, channel: Column, views: Column, description: Column) -> Column:
    return F.concat(F.lit("# "), title, F.lit("\n\n**Channel:** "), channel, F.lit("\n**Views:** "), views.cast("string"), F.lit("\n\n## Description\n"), F.coalesce(description, F.lit("")))


def result_links(page: str) -> list[tuple[str, str, str]]:
    """(url, title, description) of a result page's entries; redirect addresses are unwrapped, repeats dropped."""
    out, seen = [], set()
    for n in H.select(H.parse(page), ".result.web-result"):
        a = next(iter(H.select(n, "a.result__a")), None)
        if a is None:
            continue
        href = a.attrs.get("href", "")
        target = parse_qs(urlsplit(href).query).get("uddg")
        href = unquote(target[0]) if target else ("https:" + href if href.startswith("//") else href)
        if href and href not in seen:
            seen.add(href)
            snippet = next(iter(H.select(n, ".result__snippet")), None)
            out.append((href, a.text().strip(), snippet.text().strip() if snippet else ""))
    return out


def pdf_ineligible(kind: Column, confidence: Column, is_complex: Column, markdown: Column) -> Column:
    """Why a PDF's own text is not good enough; null if it is."""
    return F.when(kind != "TextBased", F.concat(F.lit("pdf type is "), kind)).when(confidence < 0.95, "low confidence").when(is_complex, "complex layout").when(F.trim(F.coalesce(markdown, F.lit(""))) == "", "no text")


def pdf_route(mode: Column, reason: Column) -> Column:
    """fast never goes to recognition, ocr always, auto if the text is not good enough."""
    return F.when(mode == "ocr", "ocr").when(reason.isNull(), "text").when(mode == "fast", "refused").otherwise("ocr")
