"""Queries of what the service keeps and hands out: robots rules, redirects, seeds, sitemaps, leases, facts, blobs, artifacts, schemas."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomspan.functions import schema as J
from loomspan.functions import text as X
from loomspan.functions import urls as U
from loomspan.operators import crawl, queues, robots, sinks, snapshots
from loomspan.operators import page_columns as P
from loomspan.operators.link_filter import Scope, filter_links

from .registry import Registry, table

Q = Registry()


def over(spark, sf_dir, sql, *names):
    """SQL over the tables, without views of their names in the session."""
    for n in names:
        sql = sql.replace(f"FROM {n}", f"FROM {{{n}}}").replace(f"JOIN {n}", f"JOIN {{{n}}}")
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


#: Every host has a robots.txt: all may not read /de/ and /p?, one agent may, but not what ends in .html.
ROBOTS = "# rules\\nUser-agent: *\\nDisallow: /de/\\nAllow: /de/1\\nDisallow:\\nDisallow: /*?page\\n\\nUser-agent: Other\\nUser-agent: Loom\\nDisallow: /*.html$ # files\\nDisallow: /en/\\nAllow: /en/4\\n"


@Q.query(r"""WITH p AS (SELECT page_id, regexp_extract(url, '^[^:]*://[^/?#]*([^#]*)', 1) AS t FROM pages), s AS (SELECT page_id, t, CASE WHEN t LIKE '%/' THEN t ELSE t || '/' END AS u FROM p)
SELECT page_id, NOT (t LIKE '/de/%' AND t NOT LIKE '/de/1%') AND NOT regexp_matches(t, '^/.*\?page') AS for_all, NOT (t LIKE '/en/%' AND t NOT LIKE '/en/4%') AND t NOT LIKE '%.html' AS for_loom FROM s""")
def robots_rules(spark, sf_dir):
    """Whether a URL may be read: by the rules for all, and by those of an agent that has its own."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    held = p.select(U.host(F.col("url")).alias("host")).distinct().withColumn("robots_txt", F.lit(ROBOTS.replace("\\n", "\n")))
    all_ = robots.with_robots(p, robots.rules(held), name="for_all")
    return robots.with_robots(all_, robots.rules(held, ("loom",)), name="for_loom").select("page_id", "for_all", "for_loom")


@Q.query(r"""WITH l AS (SELECT page_id, 'https://' || CASE page_id % 3 WHEN 0 THEN 'example.com' WHEN 1 THEN 'x.example.com' ELSE 'example.org' END || regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS url FROM pages)
SELECT page_id, CASE WHEN page_id % 3 = 2 THEN 'EXTERNAL_LINK' WHEN page_id % 3 = 0 AND regexp_matches(url, 'com/de/([^1]|$)') THEN 'ROBOTS_TXT' END AS denial_reason FROM l""")
def robots_in_links(spark, sf_dir):
    """The link cascade, then the robots.txt of the crawled site from a table."""
    site = F.when(F.col("page_id") % 3 == 0, "example.com").when(F.col("page_id") % 3 == 1, "x.example.com").otherwise("example.org")
    li = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("https://"), site, U.path(F.col("url"))).alias("url"))
    kept = filter_links(li, Scope("https://example.com/", "https://example.com/", allow_backward=True, allow_subdomains=True), link="url")
    held = robots.rules(spark.createDataFrame([("example.com", ROBOTS.replace("\\n", "\n"))], "host string, robots_txt string"))
    return robots.denied_by_robots(kept, held, "https://example.com/").select("page_id", "denial_reason")


#: Pages of a crawl that were redirected: to themselves, to another form, out of scope, to a blocked site, to pages of others.
MOVED = """SELECT page_id AS pos, 'https://example.com/p' || page_id AS source_url, CASE page_id % 7 WHEN 0 THEN 'https://example.com/p' || page_id WHEN 1 THEN 'http://www.example.com/p' || page_id || '/' WHEN 2 THEN 'https://other.org/p' || page_id WHEN 3 THEN 'https://example.com/t' || page_id % 5 WHEN 4 THEN 'https://example.com/new' || page_id WHEN 5 THEN 'https://example.com/admin/' || page_id ELSE 'https://example.com/seen' || page_id % 9 END AS url FROM pages"""


@Q.query(f"""WITH m AS ({MOVED}), a AS (SELECT *, CASE pos % 7 WHEN 0 THEN 'same' WHEN 1 THEN 'same' WHEN 2 THEN 'denied' WHEN 5 THEN 'denied' WHEN 4 THEN 'locked' WHEN 6 THEN CASE WHEN pos % 9 < 5 THEN 'raced' END END AS known, CASE pos % 7 WHEN 2 THEN 'EXTERNAL_LINK' WHEN 5 THEN 'EXCLUDE_PATTERN' END AS denial_reason FROM m)
SELECT source_url, url, denial_reason, coalesce(known, CASE WHEN row_number() OVER (PARTITION BY url ORDER BY pos) = 1 THEN 'locked' ELSE 'raced' END) AS action FROM a""")
def crawl_redirects(spark, sf_dir):
    m = over(spark, sf_dir, MOVED, "pages").withColumnRenamed("pos", "at")
    seen = crawl.canonical(spark.range(5).select(F.concat(F.lit("https://www.example.com/seen"), F.col("id").cast("string")).alias("url")), "key", F.col("url"))
    scope = Scope("https://example.com/", "https://example.com/", excludes=("/admin",))
    return crawl.reconciled(m, seen, scope, ("blocked.net",)).select("source_url", "url", "denial_reason", "action")


@Q.query("""WITH s AS (SELECT 'https://www.example.com/s' || page_id || CASE WHEN page_id % 6 = 0 THEN '.png' ELSE '' END AS url, 'm' || lpad((page_id % 30)::VARCHAR, 2, '0') AS sitemap, page_id AS pos FROM pages), n AS (SELECT sitemap FROM s GROUP BY sitemap ORDER BY min(pos), sitemap LIMIT 20),
f AS (SELECT 1 AS a, pos AS b, url, 'sitemap' AS kind, 's' || pos AS key FROM s SEMI JOIN n USING (sitemap) WHERE url NOT LIKE '%.png' UNION ALL SELECT 2, page_id, 'https://example.com/' || CASE WHEN page_id % 2 = 0 THEN 's' ELSE 'k' END || page_id, 'index', CASE WHEN page_id % 2 = 0 THEN 's' ELSE 'k' END || page_id FROM pages WHERE page_id % 5 <> 0 UNION ALL SELECT 0, 0, 'https://example.com/', 'source', ''),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY a, b) AS n FROM f) SELECT url, kind FROM r WHERE n = 1""")
def crawl_seeds(spark, sf_dir):
    i = F.col("page_id")
    p = table(spark, sf_dir, "pages")
    maps = p.select(F.concat(F.lit("https://www.example.com/s"), i.cast("string"), F.when(i % 6 == 0, ".png").otherwise("")).alias("url"), F.concat(F.lit("m"), F.lpad((i % 30).cast("string"), 2, "0")).alias("sitemap"), i.alias("pos"))
    known = p.select(F.concat(F.when(i % 5 == 0, "https://example.net/").otherwise("https://example.com/"), F.when(i % 2 == 0, "s").otherwise("k"), i.cast("string")).alias("url"), i.alias("pos"))
    return crawl.seeds("https://example.com/", maps, known, Scope("https://example.com/", "https://example.com/")).select("url", "kind")


@Q.query("""WITH RECURSIVE w(id, round) AS (SELECT 0::BIGINT, 0 UNION SELECT e.d, w.round + 1 FROM w JOIN (SELECT page_id AS s, page_id * 4 + 1 AS d FROM pages UNION ALL SELECT page_id, page_id * 4 + 2 FROM pages) e ON e.s = w.id WHERE w.id % 11 <> 5 AND w.id <= (SELECT max(page_id) FROM pages))
SELECT 'https://example.com/page-' || w.id || '-' || k AS url, 'https://example.com/map-' || w.id || '.xml' AS sitemap, w.round FROM w JOIN pages ON page_id = w.id, (VALUES ('a'), ('b')) t(k) WHERE w.id % 11 <> 5""")
def sitemap_recursion(spark, sf_dir):
    """Sitemaps that name pages and further sitemaps, as far as they lead; some are broken."""
    i = F.col("page_id")

    def loc(*parts):
        return F.concat(F.lit("<url><loc>https://example.com/"), *parts, F.lit("</loc></url>"))

    n, id_ = F.lit("map-"), i.cast("string")
    inner = F.concat(loc(F.lit("page-"), id_, F.lit("-a")), loc(F.lit("page-"), id_, F.lit("-b")), loc(F.lit("pic"), id_, F.lit(".png")), loc(n, (i * 4 + 1).cast("string"), F.lit(".xml")), loc(n, (i * 4 + 2).cast("string"), F.lit(".xml")))
    xml = F.concat(F.lit("<urlset>"), inner, F.when(i % 11 == 5, "</ur").otherwise("</urlset>"))
    fetched = table(spark, sf_dir, "pages").select(F.concat(F.lit("https://example.com/map-"), id_, F.lit(".xml")).alias("url"), xml.alias("content"))
    return crawl.sitemap_pages(spark.createDataFrame([("https://example.com/map-0.xml",)], "url string"), fetched)


@Q.query("""WITH u AS (SELECT page_id AS pos, url FROM pages UNION ALL SELECT page_id + 1000000, replace(url, 'http://', 'https://') FROM pages), k AS (SELECT pos, url, regexp_replace(regexp_replace(url, '^https?://', ''), '^www\\.', '') AS key FROM u WHERE regexp_extract(url, '^[^:]*://([^/?#:]*)', 1) LIKE '%example.com'),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY url LIKE 'https://%' DESC, url LIKE '%://www.%', pos) AS n FROM k) SELECT url FROM r WHERE n = 1""")
def map_plain_urls(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("url", F.col("page_id").alias("pos"))
    every = p.unionByName(p.select(F.replace("url", F.lit("http://"), F.lit("https://")).alias("url"), (F.col("pos") + 1_000_000).alias("pos")))
    return crawl.map_urls(every, "https://example.com/", limit=10_000_000).select("url")


@Q.query("""WITH s AS (SELECT page_id AS b, trim(regexp_replace(split_part(url, '?', 1), '/$', '')) AS url FROM pages WHERE page_id > (SELECT min(page_id) FROM pages)) SELECT url, min(b) AS pos FROM s WHERE regexp_extract(url, '^[^:]*://([^/?#:]*)', 1) LIKE '%example.com' GROUP BY url""")
def map_sitemap_only(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("url", F.lit(None).cast("string").alias("title"), F.col("page_id").alias("pos"))
    return crawl.map_site([p], "https://example.com/", limit=100_000, sitemap_only=True).select("url", F.col("at.b").alias("pos"))


@Q.query("""WITH s AS (SELECT lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)) AS site, url, page_id FROM pages), r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY page_id) AS n, count(*) OVER (PARTITION BY site) AS c FROM s)
SELECT site, 'Crawl it' || chr(10) || chr(10) || 'The site has ' || max(c) || ' URLs, the first ' || count(*) || ' of which are:' || chr(10) || string_agg(url, chr(10) ORDER BY n) AS prompt FROM r WHERE n <= 5 GROUP BY site""")
def site_prompts(spark, sf_dir):
    s = table(spark, sf_dir, "pages").select(U.host(F.col("url")).alias("site"), "url", F.col("page_id").alias("place"))
    return crawl.site_prompt("Crawl it", s, shown=5)


QUEUE = "SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'P' THEN 'active' ELSE 'completed' END AS status, CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority, o_orderdate AS created_at, CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS locked_at, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS done_at FROM orders"
NOW = "TIMESTAMP '1998-01-01 00:00:00'"


@Q.query(f"""WITH j AS ({QUEUE}), n AS (SELECT id FROM j WHERE status = 'queued' ORDER BY priority, created_at, id LIMIT 300) SELECT j.id, CASE WHEN n.id IS NOT NULL THEN 'active' ELSE status END AS status, CASE WHEN n.id IS NOT NULL THEN {NOW} ELSE locked_at END AS locked_at FROM j LEFT JOIN n ON j.id = n.id""")
def queue_dequeue(spark, sf_dir):
    return queues.dequeue(over(spark, sf_dir, QUEUE, "orders"), 300, F.expr(NOW)).select("id", "status", "locked_at")


@Q.query(f"""WITH j AS ({QUEUE}) SELECT id, done_at FROM j WHERE done_at <= TIMESTAMP '1996-01-01' ORDER BY done_at, id LIMIT 500 OFFSET 20""")
def queue_done_ordered(spark, sf_dir):
    return queues.finished_until(over(spark, sf_dir, QUEUE, "orders"), F.expr("TIMESTAMP '1996-01-01'"), 20, 500).select("id", "done_at")


@Q.query("""WITH m AS (SELECT max(ts) AS now FROM events), held AS (SELECT user_id % 20 AS team_id, event_id AS holder_id, ts AS renewed_at FROM events WHERE event_id % 2 = 0), asked AS (SELECT user_id % 20 AS team_id, event_id AS holder_id, 12 AS lim, ts AS asked_at FROM events WHERE event_id % 2 = 1 OR event_id % 10 = 0),
alive AS (SELECT held.* FROM held, m WHERE renewed_at > now - INTERVAL 10 DAY), b AS (SELECT team_id, count(*) AS busy FROM alive GROUP BY team_id), j AS (SELECT coalesce(a.team_id, q.team_id) AS team_id, coalesce(a.holder_id, q.holder_id) AS holder_id, a.renewed_at AS had, asked_at, lim FROM alive a FULL JOIN asked q ON a.team_id = q.team_id AND a.holder_id = q.holder_id),
n AS (SELECT j.*, coalesce(busy, 0) AS busy, sum((had IS NULL)::INT) OVER (PARTITION BY j.team_id ORDER BY asked_at NULLS FIRST, holder_id) AS place FROM j LEFT JOIN b ON j.team_id = b.team_id), g AS (SELECT *, had IS NOT NULL OR busy + place <= lim AS granted FROM n)
SELECT team_id, holder_id, granted, CASE WHEN asked_at IS NOT NULL AND granted THEN (SELECT now FROM m) ELSE had END AS renewed_at FROM g""")
def queue_leases(spark, sf_dir):
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("team_id"), i.alias("holder_id"), "ts", i.alias("event_id"))
    now = e.agg(F.max("ts").alias("m")).first().m
    held = e.where("event_id % 2 = 0").select("team_id", "holder_id", F.col("ts").alias("renewed_at"))
    asked = e.where("event_id % 2 = 1 or event_id % 10 = 0").select("team_id", "holder_id", F.lit(12).alias("limit"), F.col("ts").alias("asked_at"))
    return queues.leases(held, asked, F.lit(now), ttl_ms=10 * 86_400_000)


LOGGED = """SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN 'preview' WHEN 1 THEN 'preview_' || user_id ELSE 'team' || user_id END AS team_id, 'https://e.com/' || event_id AS url, props AS options, 'text ' || event_type AS content, event_id % 3 = 0 AS zero_data_retention, event_id % 5 = 0 AS is_parse, CASE event_id % 2 WHEN 0 THEN 'scrape' ELSE 'search' END AS kind FROM events"""


@Q.query(f"""WITH l AS ({LOGGED}) SELECT id, CASE WHEN zero_data_retention THEN '<redacted due to zero data retention>' ELSE url END AS url, CASE WHEN starts_with(team_id, 'preview') THEN 'preview' ELSE team_id END AS team_id, CASE WHEN NOT zero_data_retention THEN options END AS options, CASE WHEN NOT zero_data_retention THEN content END AS content,
CASE WHEN kind = 'scrape' THEN CASE WHEN is_parse THEN 'parses' ELSE 'scrapes' END ELSE 'searches' END AS "table" FROM l""")
def fact_rows(spark, sf_dir):
    j = over(spark, sf_dir, LOGGED, "events").withColumn("content", F.concat("content", F.lit("\0")))
    return sinks.fact_rows(j).withColumn("table", sinks.fact_table(j)).select("id", "url", "team_id", "options", "content", "table")


@Q.query("""SELECT CASE event_id % 3 WHEN 0 THEN 'scrape' WHEN 1 THEN 'search' ELSE 'map' END AS kind, event_id || '.json' AS name, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS body FROM events""")
def result_blobs(spark, sf_dir):
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").select(F.when(i % 3 == 0, "scrape").when(i % 3 == 1, "search").otherwise("map").alias("kind"), i.alias("job_id"), "event_type", "user_id")
    return sinks.result_blobs(e)


@Q.query("""WITH l AS (SELECT page_id, url, regexp_extract_all(html, '<a[^>]*\\shref="([^"]*)"', 1) AS l FROM pages) SELECT url AS discovery_url, CAST(len(list_distinct(l)) AS INT) AS links, list_aggregate(list_sort(list_distinct(l)), 'string_agg', chr(10)) AS joined FROM l WHERE page_id % 4 NOT IN (0, 1) AND page_id % 7 <> 0""")
def forwarded_links(spark, sf_dir):
    i = F.col("page_id")
    team = F.when(i % 4 == 0, "x-sitemap").when(i % 4 != 1, "team")
    p = table(spark, sf_dir, "pages").select("url", P.links_fast(F.col("html")).alias("links"), team.alias("team_id"), (i % 7 == 0).alias("is_parse"))
    f = sinks.forwarded_links(p, 1.0)
    joined = F.nullif(F.array_join(F.array_sort("urls"), "\n"), F.lit(""))
    return f.select("discovery_url", F.size("urls").alias("links"), joined.alias("joined"))


@Q.query("""WITH e AS (SELECT event_id, user_id, event_type AS a, lag(event_type) OVER w AS pa, lag(event_id) OVER w AS pid FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT 't/' || user_id || '/c/' || event_id || '.json' AS key, '{"diff_status":"changed","diff_kind":"json","diff_json":{"a":{"previous":"' || pa || '","current":"' || a || '"}}}' AS body FROM e WHERE pid IS NOT NULL AND a <> pa""")
def diff_artifacts(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.create_map(F.lit("a"), F.col("event_type")).alias("json"))
    e = e.withColumns({"previous_id": F.lag("event_id").over(w), "previous_json": F.lag("json").over(w), "was_removed": F.lit(False), "markdown": F.lit("m"), "previous_markdown": F.lit("m")})
    d = snapshots.page_diff(e, ("json",)).select(F.lit("t").alias("team_id"), F.col("user_id").alias("monitor_id"), F.lit("c").alias("check_id"), F.col("event_id").alias("page_id"), "diff_status", "diff_kind", "diff_json")
    return sinks.diff_artifacts(d).select("key", "body")


@Q.query("""WITH i AS (SELECT o_custkey % 40 AS run_id, o_orderkey AS item_id, CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'P' THEN CASE WHEN o_custkey % 40 % 3 = 0 THEN 'error' ELSE 'ok' END ELSE CASE WHEN o_custkey % 40 % 2 = 0 THEN 'ok' END END AS status FROM orders), g AS (SELECT run_id, count(*) AS items, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'error') AS failed FROM i GROUP BY run_id)
SELECT *, CASE WHEN ok + failed < items THEN 'running' WHEN failed > 0 THEN 'completed_with_errors' ELSE 'completed' END AS status FROM g""")
def bulk_runs(spark, sf_dir):
    run, s = F.col("o_custkey") % 40, F.col("o_orderstatus")
    status = F.when(s == "F", "ok").when(s == "P", F.when(run % 3 == 0, "error").otherwise("ok")).when(run % 2 == 0, "ok")
    runs, _ = sinks.run_tables(table(spark, sf_dir, "orders").select(run.alias("run_id"), F.col("o_orderkey").alias("item_id"), status.alias("status")))
    return runs


SCHEMA = {"type": "object", "properties": {"site": {"type": "string", "minLength": 1}, "box": {"type": "object", "properties": {"parts": {"type": "array", "maxItems": 9, "items": {"type": "object", "properties": {"name": {"type": "string", "pattern": "x"}, "size": {"type": "number", "default": 1}}}}}}}}


@Q.query("""WITH d AS (SELECT DISTINCT p_brand AS brand, p_type AS name, p_size % 4 AS size FROM part WHERE p_size % 7 <> 0)
SELECT p_brand AS brand, '{"box": {"parts": [' || coalesce((SELECT string_agg('{"name": "' || name || '", "size": ' || size || '}', ', ' ORDER BY name, size) FROM d WHERE d.brand = p_brand), '') || ']}}' AS record FROM (SELECT DISTINCT p_brand FROM part)""")
def gather_by_schema(spark, sf_dir):
    """Partial results of many pages as one object a brand: items with all properties, without repeats."""
    p, s = table(spark, sf_dir, "part"), F.col("p_size")
    size = F.when(s % 7 == 0, F.lit('"no number"')).otherwise((s % 4).cast("string"))
    one = F.concat(F.lit('{"box": {"parts": [{"name": "'), F.col("p_type"), F.lit('", "size": '), size, F.lit('}, {"name": "unfinished"}]}}'))
    grouped = p.select(F.col("p_brand").alias("brand"), one.alias("r")).distinct().groupBy("brand").agg(F.sort_array(F.collect_set("r")).alias("all"))

    def run(records):
        out = J.gather(SCHEMA, [json.loads(r) for r in records])
        out["box"]["parts"].sort(key=lambda x: (x["name"], x["size"]))
        return json.dumps(out)

    return grouped.select("brand", F.udf(run, "string", useArrow=True)("all").alias("record"))


@Q.query("""SELECT p_partkey AS id, p_size % 2 = 0 AS recursive, '{"type": "object", "properties": {"a": {"type": "array", "items": {"type": "object", "properties": {"n": {"type": "string"}}, "required": ["n"], "additionalProperties": false}}' || CASE WHEN p_size % 2 = 0 THEN ', "b": {"$ref": "#/$defs/x"}' ELSE '' END || '}, "required": ["a"' || CASE WHEN p_size % 2 = 0 THEN ', "b"' ELSE '' END || '], "additionalProperties": false}' AS schema FROM part""")
def strict_schemas(spark, sf_dir):
    i, s = F.col("p_partkey"), F.col("p_size")
    given = F.concat(F.lit('{"type": "object", "minProperties": 1, "properties": {"a": {"type": "array", "maxItems": '), s.cast("string"), F.lit(', "items": {"type": "object", "properties": {"n": {"type": "string", "default": "'), i.cast("string"), F.lit('"}}}}'), F.when(s % 2 == 0, ', "b": {"$ref": "#/$defs/x"}').otherwise(""), F.lit("}}"))

    def run(text):
        schema = json.loads(text)
        return J.is_recursive(schema), json.dumps(J.strict(J.without_keywords(schema)))

    found = F.udf(run, "struct<recursive:boolean,schema:string>", useArrow=True)(given)
    return table(spark, sf_dir, "part").select(i.alias("id"), found.alias("s")).select("id", "s.*")


#: A page of images in every form, one frame in its own address, and elements that repeat on the site.
PAGE = """'<html><head><base href="https://cdn.example.com/x/"><meta property="og:image" content="/og' || p_partkey || '.png"><link rel="shortcut icon" href="fav.ico"></head><body><div class="promo">Buy ' || p_size || '</div><img src="a' || p_partkey || '.png" srcset="b.png 2x, c' || p_size || '.png 1x"><img data-src="//h.org/d.png"><img src="javascript:x"><video poster="v.jpg"></video><p style="background: url(bg.gif)">Text ' || p_partkey || '. Two!</p><ul><li>One</li><li>Two <b>bold</b></li></ul><iframe src="data:text/html,%3Ca%20href%3D%22/in' || p_partkey || '%22%3Ex%3C/a%3E"></iframe></body></html>'"""


def made_pages(spark, sf_dir):
    part = P.spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    return spark.sql(f"SELECT p_partkey AS page_id, 'https://site.example.com/' || p_partkey AS url, {PAGE} AS html FROM {{part}}", part=part)


@Q.query("""SELECT p_partkey AS page_id, list_sort(list_distinct(['https://cdn.example.com/og' || p_partkey || '.png', 'https://cdn.example.com/x/fav.ico', 'https://cdn.example.com/x/a' || p_partkey || '.png', 'https://cdn.example.com/x/b.png', 'https://cdn.example.com/x/c' || p_size || '.png', 'https://h.org/d.png', 'https://cdn.example.com/x/v.jpg', 'https://cdn.example.com/x/bg.gif'])) AS images, ['https://site.example.com/in' || p_partkey] AS frame_links FROM part""")
def html_images_and_frames(spark, sf_dir):
    return P.page_columns(made_pages(spark, sf_dir), "images", "frame_links").select("page_id", F.array_sort("images").alias("images"), "frame_links")


@Q.query("""SELECT p_partkey AS page_id, 'Text ' || p_partkey || '. Two!' || chr(10) || chr(10) || '- One' || chr(10) || '- Two **bold**' AS markdown FROM part""")
def html_without_repeated(spark, sf_dir):
    """Markdown of pages without the elements that repeat on their site."""
    p = made_pages(spark, sf_dir).withColumn("site", U.host(F.col("url")))
    p = p.withColumn("html", F.regexp_replace("html", r"<(img|video|iframe)[^>]*>(</\w+>)?", ""))
    known = P.repeated_signatures(P.page_columns(p, "signatures").select("site", "signatures"))
    return P.page_columns(P.with_repeated(p, known), "markdown", repeated="repeated").select("page_id", "markdown")


@Q.query("""SELECT p_partkey AS page_id, CAST(pos AS INT) AS pos, text, kind FROM part, (VALUES (0, 'Text', 'text'), (1, 'Two!', 'text'), (2, '- One - Two **bold**', 'text')) t(pos, text0, kind), LATERAL (SELECT CASE pos WHEN 0 THEN 'Text ' || p_partkey || '.' ELSE text0 END AS text)""")
def html_sentences_made(spark, sf_dir):
    from loomspan.functions import html as H

    p = made_pages(spark, sf_dir).withColumn("html", F.regexp_replace(F.regexp_replace("html", r"<(img|video|iframe)[^>]*>(</\w+>)?", ""), r'<div class="promo">.*?</div>', ""))
    cut = F.udf(H.sentences, "array<struct<text:string,kind:string,block:int,header:boolean>>", useArrow=True)
    return P.page_columns(p, "markdown").select("page_id", F.posexplode(cut("markdown")).alias("pos", "s")).select("page_id", "pos", "s.text", "s.kind")


@Q.query("""WITH m AS (SELECT p_partkey AS id, p_size AS s FROM part) SELECT id, path, previous, current FROM m, LATERAL (SELECT unnest([{'path': 'a.b[1]', 'previous': (s)::VARCHAR, 'current': (s + 1)::VARCHAR, 'keep': true}, {'path': 'c', 'previous': '"x"', 'current': '{"k": 1}', 'keep': s % 2 = 0}, {'path': 'd', 'previous': 'true', 'current': 'null', 'keep': s % 3 = 0}], recursive := true)) t WHERE keep""")
def json_leaf_diff_made(spark, sf_dir):
    s = F.col("p_size")
    diff = F.udf(X.json_diff, "array<struct<path:string,previous:string,current:string>>", useArrow=True)
    before = F.concat(F.lit('{"a": {"b": [0, '), s.cast("string"), F.lit(']}, "c": "x", "e": "same  text"'), F.when(s % 3 == 0, ', "d": true').otherwise(""), F.lit("}"))
    after = F.concat(F.lit('{"e": "same text", "c": '), F.when(s % 2 == 0, '{"k": 1}').otherwise('"x"'), F.lit(', "a": {"b": [0, '), (s + 1).cast("string"), F.lit("]}}"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.explode(diff(before, after)).alias("d")).select("id", "d.*")


@Q.query(r"""SELECT p_partkey AS id, p_size % 3 = 0 AS is_pdf, CASE p_size % 5 WHEN 0 THEN 'odt' WHEN 1 THEN 'rtf' WHEN 2 THEN 'xlsx' WHEN 3 THEN 'doc' ELSE 'docx' END AS document_type FROM part""")
def document_sniff_made(spark, sf_dir):
    from loomspan.sources.files import document_type

    s, i = F.col("p_size"), F.col("p_partkey").cast("string")
    end = F.when(s % 5 == 0, ".odt").when(s % 5 == 1, ".RTF?x").when(s % 5 == 2, ".xls").when(s % 5 == 3, ".doc").otherwise("")
    body = F.concat(F.lit("junk " * 20), F.when(s % 3 == 0, "%PDF-1.4").otherwise("% PDF"), F.repeat(F.lit("x"), F.lit(1200)), F.lit("%PDF"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), X.is_pdf(body.cast("binary")).alias("is_pdf"), document_type(F.concat(F.lit("https://e.com/f"), i, end)).alias("document_type"))
