"""Composite queries: site inventory, crawl, sitemaps, search, extract, llms.txt, batch scrape, triage."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomspan.functions import text as X
from loomspan.functions import urls as U
from loomspan.operators import access, crawl, ranking, records
from loomspan.operators.link_filter import Scope
from loomspan.operators.page_columns import links_fast, page_columns
from loomspan.operators.tallies import search_credits
from loomspan.sources import files

from .registry import Registry, table

Q = Registry()


@Q.query("""WITH s AS (SELECT 0 AS a, page_id AS b, url, CASE WHEN page_id % 3 = 0 THEN 't' || page_id END AS title FROM pages UNION ALL SELECT 1, page_id, url || CASE WHEN page_id % 5 = 0 THEN '/more' ELSE '' END, 's' || page_id FROM pages),
u AS (SELECT a, b, title, url AS given, trim(regexp_replace(split_part(url, '?', 1), '/$', '')) AS url FROM s), k AS (SELECT * FROM u WHERE regexp_extract(url, '^[^:]*://([^/?#:]*)', 1) LIKE '%example.com' ORDER BY a, b, given LIMIT 100000),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY title IS NULL, a, b) AS n FROM k) SELECT url, title FROM r WHERE n = 1""")
def map_site_inventory(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    index = p.select("url", F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("t"), F.col("page_id").cast("string"))).alias("title"), F.col("page_id").alias("pos"))
    more = F.concat("url", F.when(F.col("page_id") % 5 == 0, "/more").otherwise(""))
    sitemap = p.select(more.alias("url"), F.concat(F.lit("s"), F.col("page_id").cast("string")).alias("title"), F.col("page_id").alias("pos"))
    return crawl.map_site([index, sitemap], "https://example.com/", limit=100_000).select("url", "title")


@Q.query()
def map_site_search(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("url", F.lit(None).cast("string").alias("title"), F.col("page_id").alias("pos"))
    return crawl.map_site([p], "https://example.com/en", search="en docs", limit=1000).select("url", "title")


#: A site of pages in a tree of ten branches, with links back, out and to files.
GRAPH = """SELECT 'https://site.example.com/p' || page_id AS src, CASE page_id % 10 WHEN 7 THEN 'https://other.org/x' WHEN 8 THEN '/a' || page_id || '.png' ELSE '/p' || (page_id * 3 + 1) END AS dst FROM pages
UNION ALL SELECT 'https://site.example.com/p' || page_id, 'https://www.site.example.com/p' || (page_id * 3 + 2) || '/' FROM pages WHERE page_id % 10 <> 9 UNION ALL SELECT 'https://site.example.com/p' || page_id, '/p0#top' FROM pages"""


@Q.query("""WITH RECURSIVE e AS (SELECT page_id AS s, page_id * 3 + 1 AS d FROM pages WHERE page_id % 10 NOT IN (7, 8) UNION ALL SELECT page_id, page_id * 3 + 2 FROM pages WHERE page_id % 10 <> 9),
w(id, depth) AS (SELECT CAST(0 AS BIGINT), 0 UNION SELECT e.d, w.depth + 1 FROM w JOIN e ON e.s = w.id WHERE w.depth < 10) SELECT id, min(depth) AS depth FROM w GROUP BY id""")
def crawl_site(spark, sf_dir):
    graph = spark.sql(GRAPH.replace("FROM pages", "FROM {pages}"), pages=table(spark, sf_dir, "pages"))
    scope = Scope("https://site.example.com/", "https://site.example.com/", allow_backward=True)
    seeds = spark.createDataFrame([("https://site.example.com/p0",)], "url string")
    seen = crawl.crawl(graph, seeds, scope)
    return seen.select(F.regexp_extract("url", r"/p(\d+)/?$", 1).cast("long").alias("id"), "depth")


@Q.query("""WITH l AS (SELECT page_id, 'https://example.com/' || CASE page_id % 4 WHEN 0 THEN 'more-' || page_id || '.xml' WHEN 1 THEN 'pic-' || page_id || '.png' ELSE 'page-' || page_id END AS url FROM pages)
SELECT page_id, url, CASE WHEN page_id % 4 = 0 THEN 'recurse' ELSE 'process' END AS action FROM l WHERE page_id % 4 <> 1 AND page_id % 9 <> 0""")
def sitemap_instructions(spark, sf_dir):
    i = F.col("page_id")
    name = F.when(i % 4 == 0, F.concat(F.lit("more-"), i.cast("string"), F.lit(".xml"))).when(i % 4 == 1, F.concat(F.lit("pic-"), i.cast("string"), F.lit(".png"))).otherwise(F.concat(F.lit("page-"), i.cast("string")))
    end = F.when(i % 9 == 0, "</urls").otherwise("</loc></url></urlset>")  # some are cut off
    xml = F.concat(F.lit("<urlset><url><loc> https://example.com/"), name, F.lit(" "), end)
    parse = F.udf(files.sitemap_rows, "struct<kind:string,urls:array<string>,error:string>", useArrow=True)
    s = table(spark, sf_dir, "pages").select("page_id", parse(xml).alias("s")).select("page_id", "s.kind", F.explode("s.urls").alias("url"))
    return files.sitemap_actions(s).select("page_id", "url", "action")


@Q.query("""WITH r AS (SELECT CASE WHEN page_id % 3 = 0 THEN 'news' ELSE 'web' END AS kind, page_id, url, row_number() OVER (PARTITION BY page_id % 3 = 0 ORDER BY page_id) AS place FROM pages), k AS (SELECT * FROM r WHERE place <= 20), n AS (SELECT count(*) AS n FROM k)
SELECT kind, page_id, CAST(place AS INT) AS place, CASE WHEN page_id % 2 = 0 THEN 'scraped ' || page_id END AS markdown, CAST(ceil(n / 10.0) * 2 AS BIGINT) AS credits FROM k, n""")
def search_with_content(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.when(F.col("page_id") % 3 == 0, "news").otherwise("web").alias("kind"), "page_id", "url")
    k = ranking.top_per_group(p, ["kind"], ["page_id"], 20)
    docs = p.where("page_id % 2 = 0").select(F.col("url").alias("u"), F.concat(F.lit("scraped "), F.col("page_id").cast("string")).alias("markdown"))
    n = F.count("*").over(Window.partitionBy())  # at most 20 results of each kind
    return k.join(docs, F.col("url") == F.col("u"), "left").select("kind", "page_id", "place", "markdown", search_credits(n, F.lit(False)).alias("credits"))


@Q.query("""WITH r AS (SELECT p_brand AS brand, max(p_size) AS size, any_value(p_brand) AS name FROM part WHERE p_size IS NOT NULL GROUP BY p_brand) SELECT brand, '{"brand": "' || brand || '", "kind": "k", "note": "n"}' AS record FROM r""")
def extract_merge(spark, sf_dir):
    """Three partial records of each brand that complete one another."""
    p = table(spark, sf_dir, "part").select("p_brand").distinct()
    partial = [(0, '{{"brand": "{}", "kind": null}}'), (1, '{{"brand": "{}", "kind": "k"}}'), (2, '{{"brand": "{}", "note": "n", "kind": "null"}}')]
    rows = None
    for n, t in partial:
        r = p.select(F.col("p_brand").alias("brand"), F.lit(n).alias("n"), F.replace(F.lit(t.format("@")), F.lit("@"), F.col("p_brand")).alias("record"))
        rows = r if rows is None else rows.unionByName(r)
    return records.merge_records(rows, ["brand"], "n")


@Q.query("""WITH h AS (SELECT regexp_extract(url, '^[^:]*://([^/?#]*)', 1) AS host, url, page_id, row_number() OVER (PARTITION BY regexp_extract(url, '^[^:]*://([^/?#]*)', 1) ORDER BY page_id) AS n FROM pages)
SELECT host, '# ' || host || ' llms.txt' || chr(10) || chr(10) || string_agg('- [page ' || page_id || '](' || url || ')', chr(10) ORDER BY page_id) AS llmstxt FROM h WHERE n <= 20 GROUP BY host""")
def llms_txt(spark, sf_dir):
    h = table(spark, sf_dir, "pages").select(F.regexp_extract("url", r"^[^:]*://([^/?#]*)", 1).alias("host"), "url", "page_id")
    h = ranking.top_per_group(h, ["host"], ["page_id"], 20)
    line = F.concat(F.lit("- [page "), F.col("page_id").cast("string"), F.lit("]("), F.col("url"), F.lit(")"))
    g = h.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("page_id", line.alias("line")))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    return g.select("host", F.concat(F.lit("# "), F.col("host"), F.lit(" llms.txt\n\n"), X.without_page_marks(body)).alias("llmstxt"))


@Q.query("""WITH u AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'not a url' WHEN page_id % 11 = 0 THEN 'https://blocked.example.net/' || page_id ELSE url END AS url FROM pages)
SELECT page_id, url, CASE WHEN url = 'not a url' THEN 'invalid' WHEN url LIKE 'https://blocked.%' THEN 'blocked' ELSE 'scrape' END AS verdict, CASE WHEN count(*) OVER () > 1000 THEN 20 ELSE 10 END AS priority FROM u""")
def batch_scrape(spark, sf_dir):
    i = F.col("page_id")
    u = table(spark, sf_dir, "pages").select("page_id", F.when(i % 7 == 0, "not a url").when(i % 11 == 0, F.concat(F.lit("https://blocked.example.net/"), i.cast("string"))).otherwise(F.col("url")).alias("url"))
    verdict = F.when(~F.col("url").rlike(r"^https?://[^\s/?#]+\.[A-Za-z]{2,}"), "invalid").when(U.matches_domain(U.host(F.col("url")), "blocked.example.net"), "blocked").otherwise("scrape")
    large = u.count() > 1000
    return u.select("page_id", "url", verdict.alias("verdict"), F.lit(20 if large else 10).alias("priority"))


@Q.query("""SELECT o_orderkey AS id, 'failed' AS kind, o_orderpriority AS error FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_orderkey, 'robots_blocked', NULL FROM orders WHERE o_orderkey % 50 = 0""")
def crawl_errors(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    failed = o.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"), F.lit("failed").alias("kind"), F.col("o_orderpriority").alias("error"))
    robots = o.where("o_orderkey % 50 = 0").select(F.col("o_orderkey").alias("id"), F.lit("robots_blocked").alias("kind"), F.lit(None).cast("string").alias("error"))
    return failed.unionByName(robots)


@Q.query("""WITH p AS (SELECT page_id, regexp_extract(url, '^[^:]*://([^/?#:]*)', 1) AS h, regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS pa FROM pages) SELECT page_id FROM p WHERE regexp_replace(h, '^www\\.', '') = (SELECT regexp_replace(h, '^www\\.', '') FROM p WHERE page_id = 2) AND pa LIKE '/en/%'""")
def index_by_prefix(spark, sf_dir):
    """Known pages under a URL prefix, by the hash of that level of their path."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    first = p.where("page_id = 2").first().url
    want = p.where("page_id = 2").select(F.sha2(F.element_at(U.splits(F.col("url")), 2), 256).alias("h"))
    level = p.select("page_id", F.sha2(F.get(U.splits(F.col("url")), F.lit(1)), 256).alias("h"))
    return level.join(want, "h", "left_semi").select("page_id") if first else level.limit(0).select("page_id")


@Q.query(f"""WITH q AS (SELECT source, CASE WHEN regexp_matches(lower(coalesce(text, '')), '{'|'.join(access.BLOCK)}') THEN 'blocked' WHEN length(coalesce(text, '')) < 800 THEN 'low_content' ELSE 'ok' END AS quality FROM documents)
SELECT source, quality, count(*) AS n, quality <> 'ok' AS escalate FROM q GROUP BY ALL""")
def triage(spark, sf_dir):
    q = table(spark, sf_dir, "documents").select("source", access.quality(F.col("text"), 800).alias("quality"))
    return q.groupBy("source", "quality").agg(F.count("*").alias("n")).withColumn("escalate", F.col("quality") != "ok")


@Q.query()
def scrape_pages(spark, sf_dir):
    """The transformer stack: metadata, links, images, Markdown, in one parse of each page."""
    p = page_columns(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "title", "language", "links", "images", "markdown")
    return p.select("page_id", U.normalize(F.col("url")).alias("url"), "title", "language", F.size("links").alias("n_links"), F.size("images").alias("n_images"), "markdown")


@Q.query("""WITH e AS (SELECT regexp_extract(url, '^([^:]*://[^/?#]*)', 1) AS site, unnest(regexp_extract_all(html, '<a[^>]*\\shref="([^"]*)"', 1)) AS href FROM pages) SELECT site, count(*) AS edges, count(DISTINCT href) AS targets FROM e GROUP BY site""")
def link_graph(spark, sf_dir):
    e = table(spark, sf_dir, "pages").select(F.regexp_extract("url", r"^([^:]*://[^/?#]*)", 1).alias("site"), F.explode(links_fast(F.col("html"))).alias("href"))
    return e.groupBy("site").agg(F.count("*").alias("edges"), F.countDistinct("href").alias("targets"))
