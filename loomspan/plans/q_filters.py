"""Queries of predicates and filters."""

from pyspark.sql import functions as F

from loomspan.functions import urls as U
from loomspan.operators import access
from loomspan.operators.link_filter import REASONS, Scope, blocked, filter_links, filter_url, reason_text

from .registry import Registry, table

Q = Registry()

#: A page's URL, or one of the forms that crawls meet.
LINK = """CASE page_id % 12 WHEN 0 THEN 'mailto:a@example.com' WHEN 1 THEN '/en/' || page_id || '/a.png' WHEN 2 THEN '/en/docs/' || page_id WHEN 3 THEN '/fr/' || page_id WHEN 4 THEN 'https://twitter.com/x' || page_id
WHEN 5 THEN 'https://other.org/' WHEN 6 THEN 'https://other.org/page/' || page_id WHEN 7 THEN 'https://sub.example.com/en/' || page_id WHEN 8 THEN '/en/a/b/c/d/e/f/g' WHEN 9 THEN '/en/' || page_id || '#top' WHEN 10 THEN '/en/private/' || page_id ELSE 'https://example.com/en/admin/' || page_id END"""
SCOPE = Scope("https://www.example.com/", "https://www.example.com/en/", max_depth=5, excludes=("/admin", "[bad"), allow_subdomains=True, disallowed=("/en/private/",))
CASCADE = """CASE page_id % 12 WHEN 0 THEN 'NON_WEB_PROTOCOL' WHEN 1 THEN 'FILE_TYPE' WHEN 2 THEN NULL WHEN 3 THEN 'BACKWARD_CRAWLING' WHEN 4 THEN 'SOCIAL_MEDIA' WHEN 5 THEN 'EXTERNAL_LINK' WHEN 6 THEN 'EXTERNAL_LINK'
WHEN 7 THEN NULL WHEN 8 THEN 'DEPTH_LIMIT' WHEN 9 THEN 'SECTION_LINK' WHEN 10 THEN 'ROBOTS_TXT' ELSE 'EXCLUDE_PATTERN' END"""


def links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.expr(LINK).alias("link"))


@Q.query(f"SELECT page_id, {LINK} AS link, {CASCADE} AS denial_reason FROM pages")
def filter_links_cascade(spark, sf_dir):
    return filter_links(links(spark, sf_dir), SCOPE)


@Q.query(f"WITH d AS (SELECT page_id, {CASCADE} AS r FROM pages), a AS (SELECT page_id, row_number() OVER (ORDER BY page_id) AS n FROM d WHERE r IS NULL) SELECT page_id, r AS denial_reason FROM d WHERE page_id <= coalesce((SELECT page_id FROM a WHERE n = 20), 9223372036854775807)")
def filter_links_limited(spark, sf_dir):
    return filter_links(links(spark, sf_dir), SCOPE, order="page_id", limit=20).select("page_id", "denial_reason")


REASON_ROWS = ", ".join(f"('{k}', '{v.replace(chr(39), chr(39) * 2)}')" for k, v in REASONS.items())


@Q.query(f"WITH d AS (SELECT {CASCADE} AS r FROM pages), t(r, reason) AS (VALUES {REASON_ROWS}) SELECT d.r AS denial_reason, reason, count(*) AS n FROM d JOIN t ON d.r = t.r GROUP BY ALL")
def filter_links_denials(spark, sf_dir):
    d = filter_links(links(spark, sf_dir), SCOPE).where("denial_reason is not null").withColumn("reason", reason_text(F.col("denial_reason")))
    return d.groupBy("denial_reason", "reason").agg(F.count("*").alias("n"))


@Q.query("""WITH h AS (SELECT page_id, url, lower(regexp_extract(lower(regexp_extract(url, '^[^:]*://([^/?#:]*)', 1)), '([^.]+\\.[^.]+)$', 1)) AS d FROM pages)
SELECT page_id, (d = 'example.net' OR d = 'adult-x.example' OR split_part(d, '.', 1) = 'example' AND d <> 'example.net') AND NOT contains(lower(url), 'de/4') AND NOT regexp_matches(url, 'S/') AND NOT regexp_matches(lower(url), 'www\\.') AND NOT regexp_matches(url, '^https') AS blocked FROM h""")
def filter_blocklist(spark, sf_dir):
    # by registrable domain, and by its name under another suffix; a keyword and patterns lift the block
    keywords = ("DE/4", "/S\\//", "regex:WWW\\.", "/^https/g", "regex:(")
    return table(spark, sf_dir, "pages").select("page_id", blocked(F.col("url"), ("example.net", "adult-x.example", "lifted.org"), keywords, unblocked=("lifted.org",)).alias("blocked"))


@Q.query(f"""WITH l AS (SELECT page_id, {LINK} AS link FROM pages) SELECT page_id, link, CASE page_id % 12 WHEN 0 THEN 'NON_WEB_PROTOCOL' WHEN 4 THEN 'SOCIAL_MEDIA' WHEN 5 THEN 'EXTERNAL_LINK' WHEN 9 THEN 'SECTION_LINK' WHEN 10 THEN 'ROBOTS_TXT' WHEN 11 THEN 'EXCLUDE_PATTERN' END AS denial_reason,
CASE page_id % 12 WHEN 6 THEN link WHEN 7 THEN link WHEN 1 THEN 'https://www.example.com' || link WHEN 2 THEN 'https://www.example.com' || link WHEN 3 THEN 'https://www.example.com' || link WHEN 8 THEN 'https://www.example.com' || link END AS url FROM l""")
def filter_url_single(spark, sf_dir):
    from dataclasses import replace

    found = links(spark, sf_dir).withColumn("page", F.lit("https://example.com/fr/start"))
    base = F.when(F.startswith("link", F.lit("/")), F.lit("https://www.example.com/x")).otherwise(F.col("page"))
    return filter_url(found.withColumn("page", base), replace(SCOPE, allow_external=True)).select("page_id", "link", "denial_reason", "url")


@Q.query("SELECT page_id, regexp_extract(url, '^[^:]*://([^/?#:]*)', 1) LIKE '%example.%' AND NOT regexp_matches(url, '/es/') AS blocked FROM pages")
def filter_blocklist_label(spark, sf_dir):
    # the same name under other suffixes counts; a pattern lifts the block
    return table(spark, sf_dir, "pages").select("page_id", blocked(F.col("url"), ("example.xyz",), ("/\\/es\\//",)).alias("blocked"))


@Q.query("""WITH h AS (SELECT page_id, url, lower(regexp_extract(url, '^[^:]*://([^/?#:]*)', 1)) AS h, regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS p FROM pages)
SELECT page_id, url FROM h WHERE h LIKE '%example.com' AND p LIKE '/en%'""")
def filter_map_scope(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").where(U.same_domain(u, F.lit("https://example.com/en")) & F.startswith(U.path(u), F.lit("/en"))).select("page_id", "url")


@Q.query("""WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[^:]*://([^/?#:]*)', 1)) AS h, regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS p FROM pages)
SELECT page_id, CASE WHEN p LIKE '%.pdf' THEN 'pdf' WHEN h = 'github.com' OR h LIKE '%.github.com' THEN 'github' WHEN h = 'example.org' OR h LIKE '%.example.org' THEN 'research' WHEN h = 'example.net' OR h LIKE '%.example.net' THEN 'docs' END AS category FROM h""")
def filter_site_category(spark, sf_dir):
    h, p = U.host(F.col("url")), F.lower(U.path(F.col("url")))
    c = F.when(F.endswith(p, F.lit(".pdf")), "pdf").when(U.matches_domain(h, "github.com"), "github").when(U.matches_domain(h, "example.org"), "research").when(U.matches_domain(h, "example.net"), "docs")
    return table(spark, sf_dir, "pages").select("page_id", c.alias("category"))


BLOCK, LOGIN = "|".join(access.BLOCK), "|".join(access.LOGIN)


@Q.query(f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN doc_id % 17 = 0 THEN 404 ELSE 200 END AS s FROM documents),
a AS (SELECT *, CASE WHEN regexp_matches(lower(t), '{BLOCK}') THEN 'blocked' WHEN regexp_matches(lower(t), '{LOGIN}') THEN 'login-gated' ELSE 'accessible' END AS access FROM d),
q AS (SELECT *, CASE WHEN access = 'blocked' THEN 'blocked' WHEN length(t) < 500 THEN 'low_content' ELSE 'ok' END AS quality FROM a)
SELECT doc_id, access, CASE WHEN s <> 200 THEN 'error' WHEN t = '' THEN 'empty' WHEN access = 'blocked' THEN 'blocked' WHEN access = 'login-gated' THEN CASE WHEN length(t) > 5000 THEN 'partial' ELSE 'login-gated' END WHEN length(t) > 1000 THEN 'accessible' ELSE 'minimal' END AS graded, quality,
CASE WHEN quality = 'blocked' THEN 0.0 WHEN quality = 'low_content' THEN 0.35 WHEN length(t) >= 8000 THEN 0.95 WHEN length(t) >= 3000 THEN 0.85 ELSE 0.72 END::DOUBLE AS confidence FROM q""")
def filter_access(spark, sf_dir):
    t = F.col("text")
    status = F.when(F.col("doc_id") % 17 == 0, 404).otherwise(200)
    return table(spark, sf_dir, "documents").select("doc_id", access.simple(t).alias("access"), access.graded(t, status).alias("graded"), access.quality(t, 500).alias("quality"), access.confidence(t, 500).alias("confidence"))


@Q.query("""SELECT doc_id, text FROM documents WHERE (doc_id % 3 = 0) OR trim(coalesce(text, '')) <> ''""")
def filter_with_content(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("listed", F.col("doc_id") % 3 == 0)
    return d.where("listed or trim(coalesce(text, '')) <> ''").select("doc_id", "text")


ENGINES = [("index", 1000, 5, "cache"), ("browser", 20, 60, "js"), ("browser", 20, 60, "shot"), ("tls", 10, 40, "stealth"), ("fetch", 5, 20, "plain"), ("pdf", 1, 10, "pdf")]


@Q.query("""WITH e(engine, quality, priority, feature) AS (VALUES ('index', 1000, 5, 'cache'), ('browser', 20, 60, 'js'), ('browser', 20, 60, 'shot'), ('tls', 10, 40, 'stealth'), ('fetch', 5, 20, 'plain'), ('pdf', 1, 10, 'pdf')),
s AS (SELECT engine, max(quality) AS quality, sum(CASE WHEN feature IN ('js', 'shot', 'stealth') THEN priority ELSE 0 END) AS support FROM e GROUP BY engine)
SELECT engine, quality, CAST(support AS BIGINT) AS support, CAST(row_number() OVER (ORDER BY support DESC, quality DESC) AS INT) AS place FROM s WHERE support >= 20 OR support * 2 >= 160""")
def filter_engine_selection(spark, sf_dir):
    wanted = {"js", "shot", "stealth"}
    e = spark.createDataFrame(ENGINES, "engine string, quality int, priority int, feature string")
    s = e.groupBy("engine").agg(F.max("quality").alias("quality"), F.sum(F.when(F.col("feature").isin(*wanted), F.col("priority")).otherwise(0)).alias("support"))
    from pyspark.sql import Window

    return s.where("support >= 20 or support * 2 >= 160").withColumn("place", F.row_number().over(Window.orderBy(F.desc("support"), F.desc("quality"))))


@Q.query("""WITH i AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '10.' || page_id % 256 || '.0.1' WHEN 1 THEN '192.168.1.' || page_id % 256 WHEN 2 THEN '8.8.' || page_id % 256 || '.8' WHEN 3 THEN '172.' || page_id % 64 || '.0.9' ELSE '127.0.0.1' END AS ip FROM pages)
SELECT page_id, ip, ip LIKE '10.%' OR ip LIKE '192.168.%' OR ip LIKE '127.%' OR (ip LIKE '172.%' AND CAST(split_part(ip, '.', 2) AS INT) BETWEEN 16 AND 31) OR ip LIKE '0.%' AS private FROM i""")
def filter_private_address(spark, sf_dir):
    ip = F.expr("CASE page_id % 5 WHEN 0 THEN '10.' || page_id % 256 || '.0.1' WHEN 1 THEN '192.168.1.' || page_id % 256 WHEN 2 THEN '8.8.' || page_id % 256 || '.8' WHEN 3 THEN '172.' || page_id % 64 || '.0.9' ELSE '127.0.0.1' END")
    own = F.col("ip").rlike(r"^(0|10|127)\.|^169\.254\.|^192\.168\.|^172\.(1[6-9]|2[0-9]|3[01])\.|^100\.(6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\.|^(22[4-9]|2[3-5][0-9])\.")
    return table(spark, sf_dir, "pages").select("page_id", ip.alias("ip")).withColumn("private", own)
