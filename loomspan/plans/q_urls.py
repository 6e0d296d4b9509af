"""Queries of the URL algebra over `pages.url`."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from loomspan.functions import urls as U

from .registry import Registry, table

Q = Registry()

#: SQL: the parts of a URL.
PARTS = r"""
p AS (
  SELECT page_id, url, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1)) AS sch,
    lower(regexp_extract(url, '^[^:]*://([^/?#:]*)', 1)) AS host,
    CASE WHEN regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) END AS path,
    regexp_extract(url, '(\?[^#]*)', 1) AS q, regexp_extract(url, '(#.*)$', 1) AS f
  FROM pages)
"""
ROUTE = "CASE WHEN length(f) > 2 AND regexp_matches(f, '^#!?/') THEN f ELSE '' END"
INDEXED = "'https://' || regexp_replace(host, '^www\\.', '') || CASE WHEN regexp_replace(regexp_replace(path, '/index\\.(html|php|htm|shtml|xml)$', '/'), '/$', '') = '' THEN '/' ELSE regexp_replace(regexp_replace(path, '/index\\.(html|php|htm|shtml|xml)$', '/'), '/$', '') END || q || " + ROUTE


@Q.query(f"WITH {PARTS} SELECT page_id, sch || '://' || host || path || q || {ROUTE} AS normalized, sch || '://' || host || path || {ROUTE} AS without_query FROM p")
def url_normalize(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", U.normalize(u).alias("normalized"), U.normalize(u, True).alias("without_query"))


@Q.query(f"""WITH {PARTS}, s AS (SELECT *, regexp_replace(host, '^www\\.', '') AS h, regexp_replace(regexp_replace(path, '/index\\.(html|php)$', '/'), '/$', '') AS stem FROM p),
v AS (SELECT page_id, unnest(['www.', '']) AS w, h, stem, q || f AS tail FROM s), v2 AS (SELECT *, unnest(['http', 'https']) AS sc FROM v),
v3 AS (SELECT *, unnest([stem || '/index.html', stem || '/index.php', stem || '/', CASE WHEN stem = '' THEN '/' ELSE stem END]) AS pa FROM v2)
SELECT DISTINCT page_id, sc || '://' || w || h || pa || tail AS permutation FROM v3""")
def url_permutations(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(U.permutations(F.col("url"))).alias("permutation"))


@Q.query(f"WITH {PARTS}, i AS (SELECT page_id, {INDEXED} AS index_url FROM p) SELECT page_id, index_url, '\\x' || sha256(index_url) AS url_hash FROM i")
def url_index_key(spark, sf_dir):
    i = table(spark, sf_dir, "pages").select("page_id", U.normalize_for_index(F.col("url")).alias("index_url"))
    return i.withColumn("url_hash", U.hash_url(F.col("index_url")))


@Q.query(f"""WITH {PARTS}, a AS (SELECT *, string_split(path, '/') AS parts FROM p),
b AS (SELECT page_id, host, unnest(range(1, len(parts) + 1)) AS i, parts FROM a),
c AS (SELECT page_id, regexp_replace(array_to_string(parts[1:i], '/'), '/index\\.(html|php|htm|shtml|xml)$', '/') AS path, host FROM b),
d AS (SELECT page_id, 'https://' || regexp_replace(host, '^www\\.', '') || CASE WHEN regexp_replace(path, '/$', '') = '' THEN '/' ELSE regexp_replace(path, '/$', '') END AS split FROM c
UNION ALL SELECT page_id, {INDEXED} FROM p) SELECT DISTINCT page_id, split FROM d""")
def url_splits(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(U.splits(F.col("url"))).alias("split"))


@Q.query(f"""WITH {PARTS}, l AS (SELECT page_id, string_split(host, '.') AS l FROM p),
e AS (SELECT page_id, l, CASE WHEN len(l) = 3 AND l[1] = 'www' THEN [2] ELSE range(2, len(l) + 1) END AS ks FROM l),
x AS (SELECT page_id, l, unnest(ks) AS k FROM e)
SELECT page_id, CAST(k - 2 AS INT) AS level, array_to_string(l[len(l) - k + 1:], '.') AS domain FROM x""")
def url_domain_splits(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(U.domain_splits(U.host(F.col("url")))).alias("level", "domain"))


@Q.query(f"""WITH {PARTS} SELECT page_id, regexp_matches(url, '^https?://') AS has_protocol, len(string_split(split_part(url, '.', 1), ':')) = 2 AS one_protocol,
regexp_matches(url, '^https?://[^\\s/?#]+\\.[A-Za-z]{{2,}}([/?#:]|$)') AS valid FROM p""")
def url_validate(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", u.rlike("^https?://").alias("has_protocol"), U.one_protocol(u).alias("one_protocol"), u.rlike(r"^https?://[^\s/?#]+\.[A-Za-z]{2,}([/?#:]|$)").alias("valid"))


@Q.query(f"""WITH {PARTS}, l AS (SELECT page_id, string_split(host, '.') AS l FROM p)
SELECT page_id, array_to_string(l[greatest(len(l) - 1, 1):], '.') = 'example.com' AS same_domain, (len(l) = 2 OR (len(l) = 3 AND l[1] = 'www')) AS base_host,
array_to_string(l[greatest(len(l) - 1, 1):], '.') AS registrable FROM l""")
def url_domain_tests(spark, sf_dir):
    u, h = F.col("url"), U.host(F.col("url"))
    base = F.lit("https://www.example.com/")
    return table(spark, sf_dir, "pages").select("page_id", U.same_domain(u, base).alias("same_domain"), F.coalesce(U.registrable(h) == U.bare_host(u), F.lit(False)).alias("base_host"), U.registrable(h).alias("registrable"))


@Q.query("SELECT page_id, regexp_replace(url, '/$', '') AS map_url, regexp_replace(split_part(url, '?', 1), '/$', '') AS map_url_no_query, regexp_replace(regexp_replace(regexp_replace(url, '^https?://', ''), '^www\\.', ''), '/$', '') AS canonical FROM pages")
def url_map_form(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", U.for_map(u).alias("map_url"), U.for_map(u, True).alias("map_url_no_query"), U.canonical(u).alias("canonical"))


@Q.query(f"""WITH {PARTS}, v AS (SELECT page_id AS pos, url FROM pages UNION ALL SELECT page_id + 1000000, replace(url, 'http://', 'https://') FROM pages UNION ALL SELECT page_id + 2000000, replace(url, '://www.', '://') FROM pages),
k AS (SELECT pos, url, regexp_replace(regexp_replace(url, '^https?://', ''), '^www\\.', '') AS key FROM v),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY url LIKE 'https://%' DESC, url LIKE '%://www.%', pos) AS n, min(pos) OVER (PARTITION BY key) AS first_pos FROM k)
SELECT first_pos, url FROM r WHERE n = 1""")
def url_remove_duplicates(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), "url")
    forms = p.union(p.select(F.col("pos") + 1000000, F.replace("url", F.lit("http://"), F.lit("https://")))).union(p.select(F.col("pos") + 2000000, F.replace("url", F.lit("://www."), F.lit("://"))))
    u = F.col("url")
    key = F.regexp_replace(F.regexp_replace(u, "^https?://", ""), r"^www\.", "")
    best = F.min(F.struct((~u.rlike("^https://")).alias("a"), u.rlike(r"://www\.").alias("b"), "pos", "url"))
    return forms.groupBy(key.alias("key")).agg(best.alias("best"), F.min("pos").alias("first_pos")).select("first_pos", "best.url")


@Q.query(f"""WITH {PARTS} SELECT page_id, CAST(len(list_filter(string_split(path, '/'), lambda s: s NOT IN ('', 'index.php', 'index.html'))) AS INT) AS depth,
CAST(3 + len(list_filter(string_split(path, '/'), lambda s: s NOT IN ('', 'index.php', 'index.html'))) AS INT) AS adjusted_max_depth, regexp_extract(path, '(\\.[^.]*)$', 1) AS extension, regexp_matches(path, '\\.(png|jpg|jpeg|gif|css|js|ico|svg|tiff|zip|exe|dmg|mp4|mp3|wav|pptx|xlsx|avi|flv|woff|ttf|woff2|webp|inc)$') AS is_file FROM p""")
def url_depth_and_file(spark, sf_dir):
    p = U.path(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", U.depth(p).alias("depth"), (U.depth(p) + 3).alias("adjusted_max_depth"), U.extension(p).alias("extension"), U.is_file(p).alias("is_file"))


SHARED = "CASE page_id % 6 WHEN 0 THEN 'https://docs.google.com/document/d/a-' || page_id || '/edit' WHEN 1 THEN 'https://docs.google.com/spreadsheets/d/s' || page_id || '/edit#gid=' || page_id WHEN 2 THEN 'http://docs.google.com/presentation/d/p_' || page_id || '/pub' WHEN 3 THEN 'https://drive.google.com/file/d/f' || page_id || '/view' WHEN 4 THEN 'https://docs.google.com/document/d/e/x' || page_id || '/pub' ELSE url END"


@Q.query("""SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'https://docs.google.com/document/d/a-' || page_id || '/export?format=html' WHEN 1 THEN 'https://docs.google.com/spreadsheets/d/s' || page_id || '/gviz/tq?tqx=out:html&gid=' || page_id
WHEN 2 THEN 'https://docs.google.com/presentation/d/p_' || page_id || '/export?format=html' WHEN 3 THEN 'https://drive.google.com/uc?export=download&id=f' || page_id END AS rewritten FROM pages""")
def url_rewrite(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.expr(SHARED).alias("u")).select("page_id", U.rewrite(F.col("u")).alias("rewritten"))


@Q.query(f"""WITH {PARTS}, t AS (SELECT page_id, host, sch || '://' || host || CASE WHEN regexp_replace(path, '/+$', '') = '' THEN '/' ELSE regexp_replace(path, '/+$', '') END || q AS u FROM p)
SELECT host, count(*) AS n, sha256(string_agg(DISTINCT u, chr(10) ORDER BY u)) AS signature FROM t GROUP BY host""")
def url_tracking_signature(spark, sf_dir):
    t = table(spark, sf_dir, "pages").select(U.host(F.col("url")).alias("host"), U.tracking_form(F.col("url")).alias("u"))
    return t.groupBy("host").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_set("u")), "\n"), 256).alias("signature"))


FORCED = (("*.example.org", "tls"), ("example.net", "browser"), ("blog.example.com", "never"), ("example.com", "fetch"))


@Q.query(f"""WITH {PARTS} SELECT page_id, CASE WHEN host LIKE '%.example.org' THEN 'tls' WHEN host = 'example.net' OR host LIKE '%.example.net' THEN 'browser'
WHEN host = 'blog.example.com' OR host LIKE '%.blog.example.com' THEN 'never' WHEN host = 'example.com' OR host LIKE '%.example.com' THEN 'fetch' END AS engine FROM p""")
def url_engine_forcing(spark, sf_dir):
    engine = F.lit(None).cast("string")
    for pattern, name in reversed(FORCED):  # the first pattern wins
        engine = F.when(U.matches_domain(U.host(F.col("url")), pattern), F.lit(name)).otherwise(engine)
    return table(spark, sf_dir, "pages").select("page_id", engine.alias("engine"))


@Q.query("""WITH r AS (SELECT page_id, url AS source, 'https://moved.example.com/' || page_id AS target FROM pages WHERE page_id % 5 = 0)
SELECT p.page_id, coalesce(r.target, p.url) AS resolved, r.target IS NOT NULL AS redirected FROM pages p LEFT JOIN r ON p.url = r.source AND p.page_id = r.page_id""")
def url_resolve_redirects(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    moved = p.where("page_id % 5 = 0").select(F.col("page_id").alias("id"), F.col("url").alias("source"), F.concat(F.lit("https://moved.example.com/"), F.col("page_id").cast("string")).alias("target"))
    j = p.join(moved, (p.url == moved.source) & (p.page_id == moved.id), "left")
    return j.select("page_id", F.coalesce("target", "url").alias("resolved"), F.col("target").isNotNull().alias("redirected"))
