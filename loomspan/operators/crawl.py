"""Crawling a site as a bounded loop over a link table: filter, canonical form, unseen, limit, next depth."""

from __future__ import annotations

import tempfile
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import urls as U
from loomspan.operators.link_filter import Scope, denial_reason, once, with_parts


def checkpointed(df: DataFrame) -> DataFrame:
    """In the session's shared checkpoint folder; only a local session without one gets a temporary folder."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomspan-"))
    return df.checkpoint()


def canonical(df: DataFrame, name: str, url) -> DataFrame:
    """df with one form for all URLs that are taken as the same page."""
    df = once(df, "__n", U.normalize(url))
    return once(df, name, F.get(U.permutations(F.col("__n")), F.lit(0))).drop("__n")


def scoped(edges: DataFrame, scope: Scope) -> DataFrame:
    """Edges (src, dst) whose target a crawl may follow, with canonical ends. Filtered once, for all depths."""
    e = with_parts(edges, U.resolve(F.col("src"), F.trim("dst")))
    e = once(e, "why", denial_reason(F.col("__url"), F.col("__path"), F.col("__host"), scope)).where("why is null")
    e = canonical(e.select("src", F.col("__url").alias("url")), "dst", F.col("url"))
    return canonical(e, "from", F.col("src")).select(F.col("from").alias("src"), "dst", "url").dropDuplicates(["src", "dst"])


def crawl(edges: DataFrame, seeds: DataFrame, scope: Scope, max_discovery_depth: int = 10, limit: int | None = None, cut=None) -> DataFrame:
    """url, key, depth of the pages reached from seeds (url).

    Every round keeps the unseen targets of the last one; among the ways to a
    page the smallest URL names it. With a limit, rounds stop when it is
    reached, and the last round keeps its first URLs by name. cut: what keeps a
    round; by default a checkpoint, so that plans do not grow with depth and a
    lost executor costs no earlier round.
    """
    keep = cut or checkpointed
    links = keep(scoped(edges, scope))
    seen = keep(canonical(seeds.select("url"), "key", F.col("url")).withColumn("depth", F.lit(0)).groupBy("key").agg(F.min("url").alias("url"), F.min("depth").alias("depth")).select("url", "key", "depth"))
    last, total = seen, seen.count()
    for depth in range(1, max_discovery_depth + 1):
        found = links.join(last.select(F.col("key").alias("src")), "src", "left_semi").groupBy(F.col("dst").alias("key")).agg(F.min("url").alias("url"))
        new = found.join(seen.select("key"), "key", "left_anti").select("url", "key", F.lit(depth).alias("depth"))
        if limit is not None:
            new = new.orderBy("url").limit(max(0, limit - total))
        last = keep(new)
        n = last.count()
        if not n:
            break
        total += n
        seen = seen.unionByName(last)  # a table a depth, none written twice
    return seen


def with_discovery(scope: Scope, **changes) -> Scope:
    return replace(scope, **changes)


def map_site(sources: list[DataFrame], site: str, search: str | None = None, limit: int = 5000, include_subdomains: bool = True, ignore_query: bool = True, most: int = 100_000, sitemap_only: bool = False) -> DataFrame:
    """url, title, place: the inventory of a site from several lists (url, title, pos), in their order.

    Brought to one form, kept to the site and its path, and only then cut to
    min(most, limit); ranked by the query's words, deduplicated (a titled entry
    is preferred, the first place kept), and cut again. sitemap_only: the
    sources are sitemaps alone, and their first row, the site itself, is left out.
    """
    from loomspan.operators.ranking import word_cosine

    every = None
    for k, s in enumerate(sources):
        s = s.select("url", "title", F.struct(F.lit(k).alias("a"), F.col("pos").cast("long").alias("b")).alias("at"))
        every = s if every is None else every.unionByName(s)
    base = F.lit(site)
    if sitemap_only:
        first = every.agg(F.min(F.struct("at", "url")).alias("m"))
        every = every.join(F.broadcast(first), F.struct("at", "url") != F.col("m")).drop("m")  # one row
    every = every.withColumn("given", F.col("url")).withColumn("url", F.trim(U.for_map(F.col("url"), ignore_query)))
    every = every.where(U.same_domain(F.col("url"), base))
    if not include_subdomains:
        every = every.where(U.bare_host(F.col("url")) == U.bare_host(base))
    path = site.split("://", 1)[-1].partition("/")[2]
    if path:
        every = every.where(F.startswith(U.path(F.col("url")), F.lit("/" + path)))
    every = every.orderBy("at", "given").limit(min(most, limit))
    if search:
        every = every.withColumn("at", F.struct((-F.round(word_cosine(F.col("given"), search.lower()), 9)).alias("s"), "at"))
    best = F.min(F.struct(F.col("title").isNull().alias("blank"), "at", "title"))
    return every.groupBy("url").agg(best.alias("b"), F.min("at").alias("at")).orderBy("at").limit(limit).select("url", "b.title", "at")


def map_urls(urls: DataFrame, site: str, search: str | None = None, limit: int = 5000, include_subdomains: bool = True) -> DataFrame:
    """url, place: the inventory of a site from plain URLs (url, pos): ranked by the query's words as they are given, then one of each page's forms kept."""
    from loomspan.operators.ranking import word_cosine

    base = F.lit(site)
    u = urls.select(F.trim(F.col("url")).alias("url"), F.col("pos").cast("long").alias("pos")).where(U.same_domain(F.col("url"), base))
    if not include_subdomains:
        u = u.where(U.bare_host(F.col("url")) == U.bare_host(base))
    u = u.withColumn("place", F.struct((-F.round(word_cosine(F.col("url"), search.lower()), 9) if search else F.lit(0.0)).alias("s"), "pos"))
    return distinct_urls(u, "place").orderBy("place").limit(limit)


def distinct_urls(urls: DataFrame, order: str, url: str = "url") -> DataFrame:
    """url, order: of the forms of a URL (scheme, www.) the one with https and without www., at the first place of any."""
    u = F.col(url)
    key = F.regexp_replace(F.regexp_replace(u, "^https?://", ""), r"^www\.", "")
    best = F.min(F.struct((~u.rlike("^https://")).alias("a"), u.rlike(r"://www\.").alias("b"), order, url))
    return urls.groupBy(key.alias("__key")).agg(best.alias("__best"), F.min(order).alias(order)).select(F.col(f"__best.{url}").alias(url), order)


def reconciled(redirects: DataFrame, visited: DataFrame, scope: Scope, domains: tuple[str, ...] = ()) -> DataFrame:
    """What a crawl does with pages that were redirected: same, denied, blocked, raced (another page has the target), or locked.

    redirects: source_url, url, at; visited: key, as crawl() names pages. Of
    several pages that lead to one target the first, by at, locks it.
    """
    from loomspan.operators.link_filter import blocked, filter_url

    r = redirects.withColumnRenamed("url", "__to")
    r = filter_url(r.withColumn("__page", F.col("source_url")), scope, link="__to", page="__page").drop("url", "__page")
    r = canonical(canonical(r, "__key", F.col("__to")), "__from", F.col("source_url"))
    moved = U.normalize(F.col("__to")) != U.normalize(F.col("source_url"))
    r = r.withColumn("__moved", moved).withColumn("__blocked", blocked(F.col("__to"), domains))
    free = F.when(~F.col("__moved"), "same").when(~F.col("allowed"), "denied").when(F.col("__blocked"), "blocked").when(F.col("__key") == F.col("__from"), "same")
    r = r.withColumn("action", free).join(visited.select(F.col("key").alias("__key")).distinct().withColumn("__seen", F.lit(True)), "__key", "left")
    open_ = F.col("action").isNull() & F.col("__seen").isNull()
    first = F.row_number().over(Window.partitionBy("__key", open_).orderBy("at", "source_url")) == 1
    action = F.coalesce("action", F.when(open_ & first, "locked").otherwise("raced"))
    return r.withColumn("action", action).select("source_url", F.col("__to").alias("url"), "at", "action", "denial_reason")


def seeds(origin: str, sitemaps: DataFrame, known: DataFrame, scope: Scope, most_sitemaps: int = 20) -> DataFrame:
    """url, key, kind, place: what a crawl starts from: the source page, the links of its sitemaps, known links under the origin.

    sitemaps: sitemap, url, pos (of the first most_sitemaps by name and first place);
    known: url, pos. All but the source page go through the scope; of one page's
    forms the first stands.
    """
    from loomspan.operators.link_filter import filter_links

    names = sitemaps.groupBy("sitemap").agg(F.min("pos").alias("p")).orderBy("p", "sitemap").limit(most_sitemaps).select("sitemap")
    site = sitemaps.join(F.broadcast(names), "sitemap", "left_semi").select("url", F.lit("sitemap").alias("kind"), F.struct(F.lit(1).alias("a"), F.col("pos").cast("long").alias("b")).alias("place"))
    under = known.where(F.startswith("url", F.lit(origin))).select("url", F.lit("index").alias("kind"), F.struct(F.lit(2).alias("a"), F.col("pos").cast("long").alias("b")).alias("place"))
    found = filter_links(site.unionByName(under), scope, link="url").where("denial_reason is null").drop("denial_reason")
    start = sitemaps.sparkSession.createDataFrame([(origin, "source")], "url string, kind string").select("url", "kind", F.struct(F.lit(0).alias("a"), F.lit(0).cast("long").alias("b")).alias("place"))
    every = canonical(start.unionByName(found), "key", F.col("url"))
    return every.groupBy("key").agg(F.min(F.struct("place", "url", "kind")).alias("m")).select("m.url", "key", "m.kind", "m.place")


def sitemap_pages(start: DataFrame, fetched: DataFrame, most_rounds: int | None = None, limit: int | None = None) -> DataFrame:
    """url, sitemap, round: the pages that sitemaps name, followed from sitemap to sitemap until none is new.

    start: url of the first sitemaps (the site's own, and those of robots.txt).
    fetched: url, content (bytes or text); a sitemap that is missing or broken names nothing.
    """
    from loomspan.sources.files import sitemap_actions, sitemap_rows

    parse = F.udf(sitemap_rows, "struct<kind:string,urls:array<string>,error:string>", useArrow=True)
    new, seen, pages, n = start.select("url").distinct(), None, None, 0
    while True:
        new = checkpointed(new)
        if new.isEmpty() or (most_rounds is not None and n >= most_rounds):
            break
        seen = new if seen is None else seen.unionByName(new)
        read = fetched.join(new, "url").select(F.col("url").alias("sitemap"), parse("content").alias("s")).select("sitemap", "s.kind", F.explode("s.urls").alias("url"))
        told = checkpointed(sitemap_actions(read))
        found = told.where("action = 'process'").select("url", "sitemap", F.lit(n).alias("round"))
        pages = found if pages is None else pages.unionByName(found)
        new, n = told.where("action = 'recurse'").select("url").distinct().join(seen, "url", "left_anti"), n + 1
    if pages is None:
        return start.select("url", F.col("url").alias("sitemap"), F.lit(0).alias("round")).limit(0)
    first = pages.groupBy("url").agg(F.min(F.struct("round", "sitemap")).alias("m")).select("url", "m.sitemap", "m.round")
    return first if limit is None else first.orderBy("round", "sitemap", "url").limit(limit)


def site_prompt(base: str, urls: DataFrame, site: str = "site", url: str = "url", place: str = "place", shown: int = 120) -> DataFrame:
    """site, prompt: a request with how many URLs a site has and the first of them."""
    w = Window.partitionBy(site)
    ranked = urls.withColumn("__n", F.row_number().over(w.orderBy(place, url))).withColumn("__all", F.count("*").over(w)).where(F.col("__n") <= shown)
    g = ranked.groupBy(site).agg(F.max("__all").alias("n"), F.sort_array(F.collect_list(F.struct("__n", url))).alias("l"))
    lines = F.array_join(F.transform("l", lambda x: x[url]), "\n")
    return g.select(site, F.concat(F.lit(f"{base}\n\nThe site has "), F.col("n").cast("string"), F.lit(" URLs, the first "), F.size("l").cast("string"), F.lit(" of which are:\n"), lines).alias("prompt"))
