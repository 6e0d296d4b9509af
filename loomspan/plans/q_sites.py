"""Queries of site records, PDF routing, logos, engine races, concurrency."""

from pyspark.sql import functions as F

from loomspan.functions import sites as S
from loomspan.operators import brand as B

from .registry import Registry, table

Q = Registry()
URL = "CASE page_id % 8 WHEN 0 THEN 'https://en.wikipedia.org/wiki/Page%20' || page_id WHEN 1 THEN 'https://x.com/user' || page_id % 9 || '/status/' || page_id WHEN 2 THEN 'https://www.twitter.com/user' || page_id % 9 WHEN 3 THEN 'https://www.youtube.com/watch?v=a' || page_id WHEN 4 THEN 'https://youtube.com/live/b' || page_id WHEN 5 THEN 'https://x.com/home' WHEN 6 THEN 'https://de.m.wiktionary.org/wiki/W' || page_id ELSE url END"


@Q.query("""SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'Page ' || page_id WHEN 6 THEN 'W' || page_id END AS article, CASE page_id % 8 WHEN 0 THEN 'wikipedia' WHEN 6 THEN 'wiktionary' END AS project, CASE page_id % 8 WHEN 1 THEN 'post' WHEN 2 THEN 'profile' END AS kind,
CASE page_id % 8 WHEN 1 THEN 'https://x.com/user' || page_id % 9 || '/status/' || page_id WHEN 2 THEN 'https://x.com/user' || page_id % 9 END AS normalized, page_id % 8 IN (3, 4) AS video FROM pages""")
def site_records(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.expr(URL).alias("u"))
    p = p.select("page_id", S.wiki_article(F.col("u")).alias("w"), S.social_post(F.col("u")).alias("x"), S.is_video_page(F.col("u")).alias("video"))
    return p.select("page_id", "w.article", "w.project", "x.kind", F.col("x.url").alias("normalized"), "video")


@Q.query("""SELECT page_id, 'https://t.org/' || page_id AS url, 'T' || page_id AS title FROM pages""")
def search_result_page(spark, sf_dir):
    i = F.col("page_id").cast("string")
    block = F.concat(F.lit('<div class="result web-result"><a class="result__a" href="//d.com/l/?uddg=https%3A%2F%2Ft.org%2F'), i, F.lit('&rut=1">T'), i, F.lit('</a><a class="result__snippet">s</a></div>'))
    read = F.udf(S.result_links, "array<struct<url:string,title:string,description:string>>", useArrow=True)
    return table(spark, sf_dir, "pages").select("page_id", F.explode(read(F.concat(block, block))).alias("r")).select("page_id", "r.url", "r.title")


@Q.query("""WITH p AS (SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'Scanned' ELSE 'TextBased' END AS kind, 0.9 + p_size % 10 / 100.0 AS confidence, p_size % 7 = 0 AS cx, CASE p_size % 3 WHEN 0 THEN 'fast' WHEN 1 THEN 'auto' ELSE 'ocr' END AS mode, p_size AS pages FROM part),
r AS (SELECT *, CASE WHEN kind <> 'TextBased' THEN 'pdf type is ' || kind WHEN confidence < 0.95 THEN 'low confidence' WHEN cx THEN 'complex layout' END AS reason FROM p) SELECT id, reason, CASE WHEN mode = 'ocr' THEN 'ocr' WHEN reason IS NULL THEN 'text' WHEN mode = 'fast' THEN 'refused' ELSE 'ocr' END AS route, least(pages, 20) AS pages FROM r""")
def pdf_routing(spark, sf_dir):
    s = F.col("p_size")
    # hundredths as decimals: 0.95 is on the good side
    reason = S.pdf_ineligible(F.when(s % 4 == 0, "Scanned").otherwise("TextBased"), F.expr("0.90 + (p_size % 10) * 0.01"), s % 7 == 0, F.lit("text"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), reason.alias("reason"), F.when(s % 3 == 0, "fast").when(s % 3 == 1, "auto").otherwise("ocr").alias("mode"), F.least(s, F.lit(20)).alias("pages"))
    return p.select("id", "reason", S.pdf_route(F.col("mode"), F.col("reason")).alias("route"), "pages")


#: Candidates of the pages: files repeat, and places lie apart, so that a file is an image.
LOGOS = """SELECT p_brand AS page, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS INT) AS idx, 'https://s/' || p_type || '-' || p_size % 4 || '.png?' || p_partkey AS src, CASE WHEN p_size % 11 = 0 THEN p_type || ' ' || p_partkey END AS alt, CASE p_size % 4 WHEN 0 THEN 'header' WHEN 1 THEN 'footer' ELSE 'body' END AS location,
25 * row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS top, p_size * 20 AS left, p_size * 12 AS width, p_size * 7 AS height, p_size % 3 <> 0 AS visible, CASE WHEN p_size % 5 <> 0 THEN '/' END AS href, p_size % 7 = 0 AS home_link, p_size % 4 = 0 AND p_size % 8 = 0 AS in_header, p_size % 11 = 0 AS alt_match, p_size % 13 = 0 AS src_match, p_size % 6 = 0 AS class_match, p_size % 9 = 0 AS is_svg, p_type AS brand FROM part"""


@Q.query(f"""WITH c AS ({LOGOS}), f AS (SELECT *, regexp_extract(split_part(src, '?', 1), '([^/]*)$', 1) AS file FROM c), l AS (SELECT page, file, count(DISTINCT location) > 1 AS repeated, count(*) > 1 AS variants FROM f GROUP BY ALL), t AS (SELECT page, min(top) AS highest FROM f GROUP BY page),
b AS (SELECT f.*, l.repeated, l.variants, t.highest, row_number() OVER (PARTITION BY f.page, f.file ORDER BY NOT visible, NOT in_header, top, NOT home_link, idx) AS n FROM f JOIN l ON f.page = l.page AND f.file = l.file JOIN t ON f.page = t.page),
s AS (SELECT page, idx, 15 * repeated::INT + 8 * variants::INT + CASE WHEN home_link AND in_header THEN 50 WHEN home_link THEN 35 WHEN in_header THEN 25 ELSE 0 END - CASE WHEN href IS NULL THEN 15 ELSE 0 END + CASE WHEN location = 'header' THEN 20 ELSE 0 END + CASE WHEN visible THEN 15 ELSE -25 END + CASE WHEN top < 100 AND "left" < 300 THEN 10 ELSE 0 END + CASE WHEN top = highest AND top < 200 THEN 12 ELSE 0 END
+ 8 * alt_match::INT + 5 * src_match::INT + 5 * class_match::INT + CASE WHEN alt IS NULL THEN 0 WHEN lower(alt) = lower(brand) THEN 20 WHEN contains(lower(alt), lower(brand)) THEN 12 ELSE 0 END + CASE WHEN contains(lower(src), lower(brand)) THEN 6 ELSE 0 END
+ CASE WHEN width * height > 1000 AND width * height < 50000 THEN 5 WHEN width * height < 500 THEN -8 WHEN width * height BETWEEN 50000 AND 200000 THEN -10 WHEN width * height > 200000 THEN -20 ELSE 0 END - CASE WHEN abs(width - height) < 5 AND (width < 40 OR height < 40) THEN 12 ELSE 0 END + 3 * is_svg::INT - CASE location WHEN 'footer' THEN 15 WHEN 'body' THEN CASE WHEN in_header THEN 0 ELSE 10 END ELSE 0 END AS score FROM b WHERE n = 1),
r AS (SELECT *, row_number() OVER w AS n, coalesce(lead(score) OVER w, 0) AS second FROM s WINDOW w AS (PARTITION BY page ORDER BY score DESC, idx))
SELECT page, idx, CAST(score AS INT) AS score, CASE WHEN score >= 60 AND score - second >= 20 THEN 0.9 WHEN score >= 45 AND score - second >= 15 THEN 0.75 WHEN score >= 30 THEN 0.6 ELSE 0.4 END::DOUBLE AS confidence FROM r WHERE n = 1""")
def logo_choice(spark, sf_dir):
    c = spark.sql(LOGOS.replace("FROM part", "FROM {part}").replace(" AS left", " AS `left`"), part=table(spark, sf_dir, "part"))
    return B.pick_logo(c, brand="brand")


@Q.query("""WITH a AS (SELECT event_id // 4 AS url, event_id % 4 AS rank, 'engine' || event_id % 4 AS engine, event_id % 3 <> 0 AS ok FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY rank) AS n FROM a WHERE ok) SELECT url, rank, engine FROM r WHERE n = 1""")
def engine_race(spark, sf_dir):
    i = F.col("event_id")
    a = table(spark, sf_dir, "events").select(F.floor(i / 4).alias("url"), (i % 4).alias("rank"), F.concat(F.lit("engine"), (i % 4).cast("string")).alias("engine"), (i % 3 != 0).alias("ok"))
    return B.first_success(a, "url")


NOW = "TIMESTAMP '1996-06-01'"


@Q.query(f"""WITH q AS (SELECT o_orderkey AS id, o_custkey % 30 AS owner, CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority, o_orderdate AS created_at, o_orderdate + INTERVAL 90 DAY AS times_out_at, CASE WHEN o_custkey % 30 = 3 THEN 5 ELSE 0 END AS delay, 400 AS lim FROM orders WHERE o_orderstatus = 'O'),
a AS (SELECT o_custkey % 30 AS owner, count(*) AS busy FROM orders WHERE o_orderstatus = 'P' AND o_orderdate > {NOW} GROUP BY 1), r AS (SELECT q.id, q.owner, CASE WHEN delay > 0 THEN 1 ELSE lim END - coalesce(busy, 0) AS room, row_number() OVER (PARTITION BY q.owner ORDER BY priority, created_at, id) AS n FROM q LEFT JOIN a USING (owner) WHERE times_out_at > {NOW})
SELECT id, owner FROM r WHERE n <= room""")
def concurrency_next(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    owner = (F.col("o_custkey") % 30).alias("owner")
    q = o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"), owner, F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), F.col("o_orderdate").alias("created_at"), F.expr("o_orderdate + interval 90 days").alias("times_out_at"), F.when(F.col("o_custkey") % 30 == 3, 5).otherwise(0).alias("delay"), F.lit(400).alias("lim"))
    a = o.where("o_orderstatus = 'P'").select(owner, F.col("o_orderdate").alias("expires_at"))
    return B.next_allowed(q, a, "owner", "lim", F.expr(NOW)).select("id", "owner")


@Q.query("""WITH r AS (SELECT page_id % 40 AS query, 0 AS provider, page_id, url FROM pages WHERE page_id % 40 < 10 UNION ALL SELECT page_id % 40, 1, page_id, url FROM pages WHERE page_id % 40 < 25 UNION ALL SELECT page_id % 40, 2, page_id, url FROM pages), f AS (SELECT query, min(provider) AS provider FROM r GROUP BY query) SELECT r.* FROM r JOIN f ON r.query = f.query AND r.provider = f.provider""")
def search_fallback(spark, sf_dir):
    """Results of the first provider that has any."""
    p = table(spark, sf_dir, "pages").select((F.col("page_id") % 40).alias("query"), "page_id", "url")
    r = None
    for k, most in enumerate((10, 25, 40)):
        x = p.where(F.col("query") < most).withColumn("provider", F.lit(k))
        r = x if r is None else r.unionByName(x)
    return r.join(r.groupBy("query").agg(F.min("provider").alias("provider")), ["query", "provider"]).select("query", "provider", "page_id", "url")
